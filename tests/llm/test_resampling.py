"""Importance resampling against a brute-force version, chunk by chunk and as a whole."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from lodestar.llm import resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(LOWER))


def slow_buckets(text: str | None) -> list[int]:
    w = words_of(text)
    return [zlib.crc32(" ".join(w[i:i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def slow(rows, target) -> collections.Counter:
    s = collections.Counter(b for _, t in rows for b in slow_buckets(t))
    t = collections.Counter(b for x in target for b in slow_buckets(x))
    s_all, t_all = sum(s.values()) + 10000, sum(t.values()) + 10000
    out = []
    for i, text in rows:
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * float(s_all) / ((s[b] + 1) * float(t_all)))) for b in slow_buckets(text))
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(slow_buckets(text)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    long = sorted((x for x, r in zip(out, rows, strict=True) if len(words_of(r[1])) >= 20), key=lambda x: (-x[3], -1 if x[0] is None else x[0], x[1]))
    for k, x in enumerate(long[:5 * len(long) // 100]):
        x[4] = k + 1
    return collections.Counter(map(tuple, out))


def texts() -> list[tuple]:
    rng = random.Random(3)
    pool = ["alpha", "Beta", "g4mma", "été", "日本語", "ÀÉ", "x" * 200, "10", "the"]
    rows = [(i, " ".join(rng.choice(pool) for _ in range(rng.randint(0, 80)))) for i in range(160)]
    same = " ".join(["Same text, more than twenty words:"] * 5)
    rows += [(7, same), (7, same), (200, same), (None, same), (None, None), (201, None), (202, ""), (203, " \n\t!"), (204, "one")]
    rows += [(205, "a-b_c\x7fd\x00e "), (206, "x" * 6000 + " y " + "é" * 3000), (207, " ".join(str(k % 301) for k in range(30000)))]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, 1, "s", -5, "w") for i, t in texts()]
    return spark.createDataFrame(rows, "doc_id long, text string, rank int, score string, n_words long, row string").repartition(5)


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([(1, "alpha Beta g4mma the the alpha"), (2, None), (3, "")], "item_id long, text string")


def rows_of(df) -> collections.Counter:
    return collections.Counter((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in df.collect())


def test_resample_matches_brute_force(docs, target):
    assert rows_of(resampling.resample(docs, target)) == slow(texts(), ["alpha Beta g4mma the the alpha", None, ""])


def test_empty_target_and_empty_table(docs, target):
    assert rows_of(resampling.resample(docs, target.where("false"))) == slow(texts(), [])
    assert resampling.resample(docs.where("false"), target).count() == 0


def test_drawn_documents_keep_their_columns(docs, target):
    got = resampling.drawn_documents(docs, target)
    assert got.columns == docs.columns
    want = {(r[0]) for r in slow(texts(), ["alpha Beta g4mma the the alpha"]) if r[4]}
    assert {r["doc_id"] for r in got.collect()} == want and {r["rank"] for r in got.collect()} == {1}


@pytest.mark.parametrize("size", [5, 64, 1 << 20])
def test_features_at_any_chunk_size(monkeypatch, size):
    monkeypatch.setattr(resampling, "CHUNK_BYTES", size)
    sample = [t for _, t in texts()[-9:]] + [t for _, t in texts()[:30]]
    got = [[] for _ in sample]
    n_words = np.zeros(len(sample), dtype=int)
    for bucket, owner, word in resampling.features([(t or "").encode() for t in sample]):
        for b, k in zip(bucket.tolist(), owner.tolist(), strict=True):
            got[k].append(b)
        n_words += np.bincount(word, minlength=len(sample))
    assert [sorted(g) for g in got] == [sorted(slow_buckets(t)) for t in sample]
    assert n_words.tolist() == [len(words_of(t)) for t in sample]


def test_shift_appends_zero_bytes():
    rng = random.Random(1)
    for n in [0, 1, 2, 63, 64, 65, 100, 4097]:
        a, b = rng.randbytes(9), rng.randbytes(n)
        whole = resampling.shifted(np.array([zlib.crc32(a)], dtype=np.uint32), np.array([n]))[0] ^ np.uint32(zlib.crc32(b))
        assert whole == zlib.crc32(a + b)
