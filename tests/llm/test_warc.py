"""WARC bundles: exact round trips, the seek table by the format's own rules, revisits by brute force."""

from __future__ import annotations

import base64
import collections
import hashlib
import struct

import pytest
import zstandard

from lodestar.llm import warc

PAGES = [
    (1, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>two</p>"), (5, "http://a/5", "<p>one</p>"), (9, None, "<p>one</p>"), (9, "http://b", "<p>two</p>"),
    (3, "http://x y\r\nEvil: 1", ""), (4, "http://e", None), (6, "é", "é 日本語 😀"), (None, "http://n", "alone"), (None, "http://n", "<p>one</p>"),
    (7, "http://rep", "again"), (7, "http://rep", "again"), (8, "http://long", "x" * 3_000_000), (10, "http://head", "WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n\r\n"),
    (None, None, "nulls"), (None, None, "nulls"),
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(*p, "key", 3, b"z") for p in PAGES]
    return spark.createDataFrame(rows, "page_id long, url string, html string, key string, last int, payload binary").repartition(3)


def expected() -> collections.Counter:
    out = []
    for i, _, html in PAGES:
        data = (html or "").encode()
        last = max((j for j, _, h in PAGES if (h or "") == (html or "") and j is not None), default=None)
        copies = sum((h or "") == (html or "") for _, _, h in PAGES)
        again = copies > 1 and last is not None and (i is None or i < last)
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", last if again else None))
    return collections.Counter(out)


def rows_of(df) -> collections.Counter:
    return collections.Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in df.collect())


@pytest.mark.parametrize("frame,bundle", [(1, 1 << 28), (700, 900), (1 << 20, 1 << 28)])
def test_round_trip(pages, tmp_dir, frame, bundle):
    index = warc.write_archives(pages, f"{tmp_dir}/w", frame, bundle)
    assert rows_of(warc.read_pages(index, f"{tmp_dir}/w")) == expected()
    payloads = {(r["page_id"], bytes(r["payload"])) for r in warc.read_records(index, f"{tmp_dir}/w").collect() if r["type"] == "response"}
    assert {p for _, p in payloads} == {(h or "").encode() for _, _, h in PAGES}


def test_shuffled_decisions_give_the_same(pages, tmp_dir, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 0)
    index = warc.write_archives(pages, f"{tmp_dir}/w")
    assert rows_of(warc.read_pages(index, f"{tmp_dir}/w")) == expected()


def test_small_payloads_are_written_anew(pages, tmp_dir):
    index = warc.write_archives(pages, f"{tmp_dir}/w", min_bytes=8)
    kinds = {(r["page_id"], r["payload_bytes"]): r["record_type"] for r in warc.read_pages(index, f"{tmp_dir}/w").collect()}
    assert kinds[1, 10] == "revisit" and kinds[3, 0] == "response"


def test_bundle_is_a_plain_zstd_file_with_a_seek_table(spark, pages, tmp_dir):
    index = warc.write_archives(pages.coalesce(1), f"{tmp_dir}/w", 700)
    rows = index.collect()
    name = rows[0]["bundle"]
    data = open(f"{tmp_dir}/w/{name}", "rb").read()
    n, flags, magic = struct.unpack("<IBI", data[-9:])
    assert magic == 0x8F92EAB1 and flags == 0 and n > 2
    sizes = [struct.unpack_from("<II", data, len(data) - 9 - 8 * (n - k)) for k in range(n)]
    assert struct.unpack_from("<II", data, sum(a for a, _ in sizes)) == (0x184D2A5E, 8 * n + 9)
    plain, at = b"", 0
    for packed, size in sizes:  # every frame opens on its own
        plain += (one := zstandard.ZstdDecompressor().decompress(data[at:at + packed]))
        assert len(one) == size
        at += packed
    assert plain.count(b"WARC-Record-ID: ") == len(PAGES) and plain.startswith(b"WARC/1.1\r\n")
    whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert whole == plain
    assert b"\r\nEvil" not in plain  # a URL never makes a header line of its own
    starts = [sum(s for _, s in sizes[:r["frame"]]) + r["offset"] for r in rows]
    assert all(plain[s:s + r["length"]].startswith(b"WARC/1.1") and f"<{r['record_id']}>".encode() in plain[s:s + r["length"]] for s, r in zip(starts, rows, strict=True))


def test_single_records_by_identifier(spark, pages, tmp_dir):
    index = warc.write_archives(pages, f"{tmp_dir}/w", 700)
    asked = spark.createDataFrame([("urn:page:6",), ("urn:page:none",), ("urn:page:6",)], "record_id string")
    got = warc.fetch(index, f"{tmp_dir}/w", asked).collect()
    assert [(r["page_id"], bytes(r["payload"]).decode()) for r in got] == [(6, "é 日本語 😀")]


def test_a_reader_reads_one_frame_only(tmp_dir):
    w = warc.BundleWriter(f"{tmp_dir}/b.warc.zst", frame_bytes=100)
    places = [w.add(bytes([65 + k]) * 60) for k in range(4)]
    w.close()
    r = warc.BundleReader(f"{tmp_dir}/b.warc.zst")
    asked, real = [], r.source.read

    class Source:
        def seek(self, at):
            r_source.seek(at)

        def read(self, n):
            asked.append(n)
            return real(n)

    r_source, r.source = r.source, Source()
    assert places == [(0, 0, 60), (1, 0, 60), (2, 0, 60), (3, 0, 60)]
    assert r.frame(2) == b"C" * 60 and asked == [r.places[2][1]]


def test_broken_files_and_records_raise(tmp_dir):
    open(f"{tmp_dir}/x.zst", "wb").write(b"\0" * 40)
    with pytest.raises(ValueError):
        warc.BundleReader(f"{tmp_dir}/x.zst")
    whole = warc.record(1, "u", b"abc", None)
    for bad in (whole[:-1], whole.replace(b"abc", b"abcd"), whole[1:], b""):
        with pytest.raises(ValueError):
            warc.parsed(bad)


def test_no_pages(pages, tmp_dir):
    index = warc.write_archives(pages.where("false"), f"{tmp_dir}/w")
    assert index.count() == 0 and warc.read_pages(index, f"{tmp_dir}/w").count() == 0
