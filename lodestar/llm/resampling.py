"""Target-distribution importance resampling over hashed word n-grams.

A text's words are runs of ASCII letters and digits and non-ASCII characters,
``A-Z`` lower-cased; its features are all runs of one to three words. A
feature's bucket is the CRC-32 of its UTF-8 bytes modulo ``BUCKETS``. No feature
is ever built as a string:

1. the distinct words of a chunk of text, each between two blanks, are the
   patterns of an Aho-Corasick automaton; a pattern carries its word's CRC and
   byte length;
2. one scan of the chunk emits these payloads in order. Adjacent payloads are
   composed: ``crc(a b) = shift(crc(a), len b) xor crc(b)``, where ``shift``
   appends zero bytes to a CRC (linear, by table);
3. the buckets of raw and target texts are counted over all rows, a bucket's
   gain is the floored log-ratio of its smoothed shares, a document's weight is
   the sum of its features' gains, and Gumbel noise from the document's id turns
   the weight into a score. The highest scores are a draw without replacement.

A word of more than ``LONG`` bytes is known to the automaton by a short stand-in
with the long word's payload, so the automaton stays small whatever the words
are. Chunks are cut between words; runs of words that cross a cut are composed
from the payloads carried over. Only the ``BUCKETS`` counts reach the driver.

Null and empty texts have no words (weight 0); rows with equal doc_id and text
are rows of their own with equal scores, ranked one after the other; a null
doc_id draws its noise as the empty string and goes first among ties; empty
tables give an empty result, an empty target counts 0 everywhere. Only
``doc_id`` and ``text`` are read, so further columns never clash.
"""

from __future__ import annotations

import functools
import itertools
import math
import re
import zlib
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.text import slices
from lodestar.session import checkpoint_dir

BUCKETS = 10_000
MIN_WORDS, PERCENT, SEED = 20, 5, 42
#: Texts are scanned in chunks of about so many bytes, each with an automaton of its own words.
CHUNK_BYTES = 4 << 20
LONG = 64
#: Stands for the end of a text; the byte can't occur in a word.
_END = b"\x02"
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_LONG_RUN = re.compile(rb"[^ ]{%d,}" % (LONG + 1))
_BYTE = np.uint32(255)
_BLANK_CRC = np.uint32(zlib.crc32(b" "))


def _shift_tables() -> np.ndarray:
    """[n, byte of the CRC, its value]: that byte's share of a CRC after ``n`` zero bytes, ``n`` up to LONG."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & np.uint32(1), (step >> np.uint32(1)) ^ np.uint32(0xEDB88320), step >> np.uint32(1))
    out = np.empty((LONG + 1, 4, 256), dtype=np.uint32)
    out[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(LONG):
        out[n + 1] = (out[n] >> np.uint32(8)) ^ step[out[n] & _BYTE]
    return out


_SHIFT = _shift_tables()


def _applied(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return table[0][crc & _BYTE] ^ table[1][(crc >> np.uint32(8)) & _BYTE] ^ table[2][(crc >> np.uint32(16)) & _BYTE] ^ table[3][crc >> np.uint32(24)]


@functools.lru_cache(maxsize=512)
def _shift_table(n: int) -> np.ndarray:
    """The table of ``n`` zero bytes, by doubling."""
    if n <= LONG:
        return _SHIFT[n]
    half = _shift_table(n // 2)
    both = _applied(half, half)
    return _applied(_SHIFT[1], both) if n % 2 else both


def shifted(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Each CRC after its number of zero bytes."""
    near = np.minimum(n, LONG)
    out = (_SHIFT[near, 0, crc & _BYTE] ^ _SHIFT[near, 1, (crc >> np.uint32(8)) & _BYTE]
           ^ _SHIFT[near, 2, (crc >> np.uint32(16)) & _BYTE] ^ _SHIFT[near, 3, crc >> np.uint32(24)])
    for size in np.unique(n[n > LONG]).tolist():
        at = np.flatnonzero(n == size)
        out[at] = _applied(_shift_table(size), crc[at])
    return out


def _payload(word: bytes) -> int:
    return zlib.crc32(word) | len(word) << 32


def scan(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(CRC, byte length) of each word of folded text, in order; a text's end has length 0."""
    words = set(data.split())
    payloads = {}
    if any(len(w) > LONG for w in words):
        stand_in: dict[bytes, bytes] = {}
        data = _LONG_RUN.sub(lambda m: stand_in.setdefault(m[0], b"\x01%x" % len(stand_in)), data)
        words = {w for w in words if len(w) <= LONG}
        payloads = {short: _payload(w) for w, short in stand_in.items()}
    payloads |= {w: _payload(w) for w in words}
    payloads[_END] = 0
    automaton = ahocorasick.Automaton()
    for w, payload in payloads.items():
        automaton.add_word(f" {w.decode('latin-1')} ", payload)
    automaton.make_automaton()
    found = np.fromiter(itertools.chain.from_iterable(automaton.iter(data.decode("latin-1"))), dtype=np.int64)[1::2]
    return (found & 0xFFFFFFFF).astype(np.uint32), found >> 32


def _chunks(texts: Iterable[bytes]) -> Iterator[bytes]:
    """Folded text in chunks that begin and end with a blank, cut between words, with a mark at the end of each text."""
    held, size = [], 0
    for text in texts:
        t, at = text.translate(_FOLD), 0
        while len(t) - at > CHUNK_BYTES:
            cut = t.find(b" ", at + CHUNK_BYTES)
            if cut < 0:
                break
            yield b" ".join([b"", *held, t[at:cut], b""])
            held, size, at = [], 0, cut
        held += [t[at:], _END]
        size += len(t) - at
        if size >= CHUNK_BYTES:
            yield b" ".join([b"", *held, b""])
            held, size = [], 0
    if held:
        yield b" ".join([b"", *held, b""])


def features(texts: Iterable[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each chunk: (bucket of every feature, index of its text, index of the text of every word)."""
    crc, size, done = np.zeros(2, dtype=np.uint32), np.zeros(2, dtype=np.int64), 0
    for chunk in _chunks(texts):
        new_crc, new_size = scan(chunk)
        crc, size = np.r_[crc[-2:], new_crc], np.r_[size[-2:], new_size]
        owner = done + np.cumsum(size[2:] == 0)
        done = int(owner[-1]) if len(owner) else done
        word = size[2:] > 0
        pair = word & (size[1:-1] > 0)
        triple = pair & (size[:-2] > 0)
        first = _applied(_SHIFT[1], crc[:-1]) ^ _BLANK_CRC  # each word with a blank behind it
        two = shifted(first[1:], size[2:]) ^ crc[2:]
        inner = shifted(first[:-1], size[1:-1]) ^ crc[1:-1]
        three = shifted(_applied(_SHIFT[1], inner) ^ _BLANK_CRC, size[2:]) ^ crc[2:]
        bucket = np.concatenate([crc[2:][word], two[pair], three[triple]]) % np.uint32(BUCKETS)
        yield bucket, np.concatenate([owner[word], owner[pair], owner[triple]]), owner[word]


def _bytes(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def bucket_counts(docs: DataFrame) -> np.ndarray:
    """How many features of all texts fall in each bucket: ``BUCKETS`` numbers."""

    def count(parts):
        total = np.zeros(BUCKETS, dtype=np.int64)
        for part in parts:
            for b in slices(part):
                for bucket, _, _ in features(_bytes(b)):
                    total += np.bincount(bucket, minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], names=["bucket", "n"])

    out = np.zeros(BUCKETS, dtype=np.int64)
    for r in docs.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Each bucket's floored log-ratio of target to raw share, in thousandths."""
    s_all, t_all = float(raw.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all))) for s, t in zip(raw.tolist(), target.tolist(), strict=True)], dtype=np.int64)


def scored(docs: DataFrame, gain: np.ndarray, seed: int = SEED, payload: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, row), one row per row of ``docs``; ``row`` holds the columns of ``payload``."""

    def weigh(parts):
        for part in parts:
            for b in slices(part):
                n = b.num_rows
                words, counts, weight = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
                for bucket, owner, word_owner in features(_bytes(b)):
                    words += np.bincount(word_owner, minlength=n)
                    counts += np.bincount(owner, minlength=n)
                    np.add.at(weight, owner, gain[bucket])
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(words), pa.array(counts), pa.array(weight), b.column("row")], names=["doc_id", "n_words", "n_features", "weight", "row"])

    kept = F.struct(*[F.col(c) for c in payload]) if payload else F.lit(True)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", kept.alias("row"))
    kind = rows.schema["row"].dataType.simpleString()
    out = rows.mapInArrow(weigh, f"doc_id long, n_words long, n_features long, weight long, row {kind}")
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    return out.withColumn("score", F.col("weight") + noise.cast("long"))


def _ranked(rows: DataFrame, n_drawn: int) -> DataFrame:
    """``rows`` with ``rank`` (1 for the highest score), null beyond ``n_drawn``.

    A global sort writes its partitions to the checkpoint folder; a row's rank is
    its place there plus the sizes of the partitions before.
    """
    spark = rows.sparkSession
    # partition numbers are in the high bits of the id, so it grows along the order
    order = rows.orderBy(F.desc("score"), F.asc("doc_id"), "n_features").withColumn("_at", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("_at", 33).cast("int")
    sizes = sorted((r["p"], r["n"]) for r in order.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())  # one number a partition
    before, at = [], 0
    for p, n in sizes:
        before.append((p, at))
        at += n
    offsets = F.broadcast(spark.createDataFrame(before or [(0, 0)], "_p int, _before long"))
    rank = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return order.withColumn("_p", part).join(offsets, "_p").withColumn("rank", F.when(rank <= n_drawn, rank)).drop("_p", "_at", "_before")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED, payload: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank, row): ``rank`` numbers the ``percent`` of the documents with ``min_words`` that are drawn."""
    checkpoint_dir(docs.sparkSession)
    gain = gains(bucket_counts(docs), bucket_counts(target))
    rows = scored(docs, gain, seed, payload).checkpoint()
    long_enough = F.col("n_words") >= min_words
    n = rows.where(long_enough).count()
    drawn = _ranked(rows.where(long_enough), percent * n // 100)
    return drawn.unionByName(rows.where(~long_enough).withColumn("rank", F.lit(None).cast("long")))


def drawn_documents(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns."""
    names = docs.columns
    out = resample(docs, target, percent, min_words, seed, tuple(names)).where("rank is not null")
    return out.select(*[F.col("row").getField(c).alias(c) for c in names])
