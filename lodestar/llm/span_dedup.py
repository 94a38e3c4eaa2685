"""Substring dedup by sliding sentence spans.

A text is cut into sentences (after ``.!?`` before white space, after ``。！？``,
and at line ends). A sentence of more than ``LONG`` words is cut further, after
``,;:`` and ``，、；：`` and before words that a hash of the letters around the
gap picks. These cuts don't depend on what stands farther off, so the long
sentences of a passage are cut alike in any surroundings. A word is a run
without white space, or one Chinese or Japanese character. At every sentence
the shortest run of two or more consecutive
sentences that holds ``MIN_WORDS`` words begins, and another one ends; every
longer run is covered by such spans. Spans are hashed over lower-case words
(characters up to U+3000 are lowered), grouped globally, and every sentence covered by a span that occurred before is
removed. The first occurrence is the one in the smallest doc_id, and in it the
first.

Rows with equal doc_id count as one document, rows without an id as one last
document, whatever their texts: they don't remove each other's spans. A null
text stays null; empty texts and texts without a span stay as they are; a text
may lose all its sentences. Texts are read whole; an empty table gives an empty
result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.text import mixed, slices, texts_of

MIN_SENTENCES, MIN_WORDS, LONG = 2, 14, 9
#: One gap in so many is a cut of a long sentence.
GAPS = 3
#: Texts are cut and hashed in slices of so many bytes, each as one array of characters that stays in a core's cache.
SLICE = 256 << 10
#: A task compares so many spans among themselves before it sends them.
CHUNK_SPANS = 2_000_000
NO_ID = 2**63 - 1
_STEP = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_BACK = pow(_STEP, -1, 2**64)

_STOPS, _WIDE_STOPS = ".!?", "。！？"
_RESTS, _WIDE_RESTS = ",;:", "，、；："
_TABLE = 0x3001
_WHITE = np.array([chr(c).isspace() for c in range(_TABLE)])
_LOWER = np.array([ord(chr(c).lower()) if len(chr(c).lower()) == 1 else c for c in range(_TABLE)], dtype=np.uint32)
_NEAR = 3
_SEEDS = mixed(np.arange(1, 2 * _NEAR + 1, dtype=np.uint64)) | np.uint64(1)


#: Characters that are words of their own; the second form splits a text into words.
WIDE = re.compile(r"[\u3005-\u3007\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
_APART = re.compile(rf"{WIDE.pattern}|(?:(?!{WIDE.pattern})\S)+")


def words_of(text: str) -> list[str]:
    """The lower-case words."""
    return text.lower().split() if text.isascii() or not WIDE.search(text) else _APART.findall(text.lower())


def _is_wide(c: np.ndarray) -> np.ndarray:
    """Characters that are words of their own."""
    return (c >= 0x3005) & (c <= 0x3007) | (c >= 0x3040) & (c <= 0x30FF) | (c >= 0x3400) & (c <= 0x4DBF) | (c >= 0x4E00) & (c <= 0x9FFF) | (c >= 0xF900) & (c <= 0xFAFF) | (c >= 0x20000) & (c <= 0x3FFFF)


def _among(c: np.ndarray, chars: str) -> np.ndarray:
    out = c == ord(chars[0])
    for ch in chars[1:]:
        out |= c == ord(ch)
    return out


class _Letters:
    """Some texts as one array of characters, a line end behind each.

    ``c``: lower-case codes; ``white``: by character; ``first``, ``last``: of each
    word; ``start``, ``stop``: of each text.
    """

    def __init__(self, texts: list[str]):
        whole = "\n".join([*texts, ""])
        ascii_only = whole.isascii()
        raw = np.frombuffer(whole.encode(), dtype=np.uint8) if ascii_only else np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        near = raw if ascii_only else np.minimum(raw, _TABLE - 1)
        self.white = _WHITE[near] if ascii_only else _WHITE[near] & (raw < _TABLE)
        self.c = _LOWER[near] if ascii_only else np.where(raw < _TABLE, _LOWER[near], raw)
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        self.stop = np.cumsum(sizes + 1) - 1
        self.start = self.stop - sizes
        lead, tail = ~self.white, ~self.white
        lead[1:] &= self.white[:-1]
        tail[:-1] &= self.white[1:]
        self.wide = not ascii_only and bool((raw >= 0x3000).any())
        if self.wide:
            wide = _is_wide(raw)
            beside = wide[1:] | wide[:-1]
            lead[1:] |= beside & ~self.white[1:]
            tail[:-1] |= beside & ~self.white[:-1]
        self.first, self.last = np.flatnonzero(lead), np.flatnonzero(tail)
        self.solid = np.flatnonzero(~self.white)

    def after(self, at: np.ndarray) -> np.ndarray:
        """From each place on the next character that is not white, at most the end of its text."""
        k = np.searchsorted(self.solid, at)
        following = np.append(self.solid, len(self.c))[k]
        return np.minimum(following, self.stop[np.searchsorted(self.stop, at - 1)])

    def marks(self, narrow: str, broad: str) -> np.ndarray:
        """Places behind a mark: ``narrow`` ones before white space, ``broad`` ones at the end of their run."""
        at = np.flatnonzero(_among(self.c, narrow))
        found = [at[self.white[at + 1]]]  # a text's last character has its line end behind it
        if self.wide:
            broad_at = _among(self.c, broad)
            at = np.flatnonzero(broad_at)
            found.append(at[~broad_at[at + 1]])
        return self.after(np.concatenate(found) + 1)


def _picked(x: _Letters, k: np.ndarray) -> np.ndarray:
    """Of the words ``k``, the starts of those before which the letters on both sides of the gap tell to cut."""
    value = np.zeros(len(k), dtype=np.uint64)
    first, last = x.first, x.last
    with np.errstate(over="ignore"):
        for j in range(_NEAR):
            for at, inside, seed in ((last[k - 1] - j, last[k - 1] - j >= first[k - 1], _SEEDS[j]), (first[k] + j, first[k] + j <= last[k], _SEEDS[_NEAR + j])):
                value += np.where(inside, x.c[np.where(inside, at, 0)], 0).astype(np.uint64) * seed
    return first[k][mixed(value) % np.uint64(GAPS) == 0]


def _cut(x: _Letters) -> np.ndarray:
    """Ends of the sentences of all texts, in order; a text without characters has none."""
    is_end = np.zeros(len(x.c) + 1, dtype=bool)
    is_end[x.marks(_STOPS, _WIDE_STOPS)] = True
    lines = x.c == 10
    lines[x.stop] = False
    is_end[x.after(np.flatnonzero(lines) + 1)] = True
    is_end[x.stop[x.stop > x.start]] = True
    ends = np.flatnonzero(is_end)
    if not len(ends):
        return ends
    upto = np.searchsorted(x.first, ends)
    long = np.diff(upto, prepend=0) > LONG
    if long.any():
        inside = np.repeat(long, np.diff(upto, prepend=0))  # by word
        lead = np.searchsorted(x.first, x.start)
        inside[lead[lead < len(inside)]] = False  # before a text's first word there is no gap
        is_end[_picked(x, np.flatnonzero(inside))] = True
        pauses = x.marks(_RESTS, _WIDE_RESTS)
        pauses = pauses[pauses < x.stop[np.searchsorted(x.stop, pauses - 1)]]
        is_end[pauses[long[np.searchsorted(ends, pauses, side="right")]]] = True
        ends = np.flatnonzero(is_end)
    return ends


def sentences(text: str) -> list[str]:
    """The sentences with the white space behind them; joined they are the text."""
    if not text:
        return []
    ends = _cut(_Letters([text])).tolist()
    return [text[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


def _runs(items: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run ``items[lo:hi]``, wherever it stands."""
    with np.errstate(over="ignore"):
        upto = np.zeros(len(items) + 1, dtype=np.uint64)
        np.cumsum(items * _powers(_STEP, len(items)), out=upto[1:])
        value = (upto[hi] - upto[lo]) * _powers(_BACK, len(items) + 1)[lo]
        return mixed(value ^ mixed((hi - lo).astype(np.uint64)))


def spans_of(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ends of the sentences of each text, owner, first sentence, end sentence, hash of every span)."""
    x = _Letters(texts)
    ends = _cut(x)
    n = len(ends)
    owner = np.searchsorted(x.stop, ends)
    sizes = np.bincount(owner, minlength=len(texts)) if n else np.zeros(len(texts), dtype=np.int64)
    bounds = np.r_[0, np.cumsum(sizes)]
    apart = [ends[a:b] - s for a, b, s in zip(bounds[:-1], bounds[1:], x.start, strict=True)]
    if not n:
        none = np.empty(0, dtype=np.int64)
        return apart, none, none, none, np.empty(0, dtype=np.uint64)
    words = np.r_[0, np.searchsorted(x.first, ends)]
    base, stop = bounds[owner], bounds[owner + 1]
    at = np.arange(n)
    end = np.maximum(at + MIN_SENTENCES, np.searchsorted(words, words[:-1] + MIN_WORDS, side="left"))
    begin = np.minimum(at + 1 - MIN_SENTENCES, np.searchsorted(words, words[1:] - MIN_WORDS, side="right") - 1)
    ahead, back = end <= stop, begin >= base
    back &= end[np.maximum(begin, 0)] != at + 1  # a run that is the shortest from both sides counts once
    start, end = np.r_[at[ahead], begin[back]], np.r_[end[ahead], at[back] + 1]
    order = np.lexsort((end, start))
    start, end = start[order], end[order]
    key = _runs(mixed(x.c.astype(np.uint64) + np.uint64(1)), x.first, x.last + 1)
    value = _runs(key, words[start], words[end]) ^ mixed((end - start).astype(np.uint64))
    return apart, owner[start], start - base[start], end - base[start], value


def _first_seen(owner: np.ndarray, value: np.ndarray) -> np.ndarray:
    """True for the first span of each hash in each text."""
    order = np.lexsort((np.arange(len(owner)), value, owner))
    o, v = owner[order], value[order]
    out = np.zeros(len(owner), dtype=bool)
    out[order] = np.r_[True, (o[1:] != o[:-1]) | (v[1:] != v[:-1])][:len(owner)]
    return out


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_key, hashes): for each document the spans whose first occurrence is in another one.

    A task first compares its own documents: of those that share a span only the
    first asks who else has it, the others know already that they are late (their
    rows carry the hash in ``late``). So a span of a third of all documents sends
    one row a chunk to the task of its hash, and late rows are dealt out by
    document and hash.
    """

    def hashes(parts):
        held, n = [], 0

        def told():
            value, key = np.concatenate([v for v, _ in held]), np.concatenate([k for _, k in held])
            late, fresh = np.zeros(len(key), dtype=bool), np.ones(len(key), dtype=bool)
            order = np.argsort(value)
            same = value[order[1:]] == value[order[:-1]]
            shared = order[np.r_[False, same] | np.r_[same, False]]
            shared = shared[np.lexsort((key[shared], value[shared]))]
            v, k = value[shared], key[shared]
            again = np.r_[False, v[1:] == v[:-1]][:len(v)]
            late[shared] = k[np.maximum.accumulate(np.where(again, 0, np.arange(len(k))))] != k
            fresh[shared] = ~(again & np.r_[False, k[1:] == k[:-1]][:len(k)])  # a document asks once
            at = np.where(late, mixed(value ^ mixed(key.view(np.uint64))), value)[fresh].view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(at), pa.array(key[fresh]), pa.array(value[fresh].view(np.int64), mask=~late[fresh])], names=["at", "doc_key", "late"])

        for part in parts:
            for b in slices(part, limit=SLICE):
                _, owner, _, _, value = spans_of(texts_of(b))
                held.append((value, b.column("doc_key").to_numpy(zero_copy_only=False)[owner]))
                n += len(value)
                if n >= CHUNK_SPANS:
                    yield told()
                    held, n = [], 0
        if n:
            yield told()

    spans = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_key"), "text").mapInArrow(hashes, "at long, doc_key long, late long")
    # One shuffle of the spans; rows of a hash, at most one a chunk, go through a buffer that spills.
    first = F.min(F.when(F.col("late").isNull(), F.col("doc_key"))).over(Window.partitionBy("at"))
    asked = spans.withColumn("first", first).where(F.col("late").isNotNull() | (F.col("doc_key") != F.col("first")))
    return asked.groupBy("doc_key").agg(F.collect_set(F.coalesce("late", "at")).alias("hashes"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text, n_sentences, n_removed, removed), one row per row of ``docs``.

    ``removed``: start:end of the removed stretches, in code points, comma-joined.
    """
    marks = repeated_spans(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_key"))
    rows = rows.join(marks, "doc_key", "left").select("doc_id", "text", "hashes")

    def prune(parts):
        for part in parts:
            for b in slices(part, limit=SLICE):
                texts = texts_of(b)
                ends, owner, first, end, value = spans_of(texts)
                late = ~_first_seen(owner, value)
                bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
                elsewhere, was = b.column("hashes"), b.column("text").is_null()
                rows = []
                for i, t in enumerate(texts):
                    a, z, n = bounds[i], bounds[i + 1], len(ends[i])
                    hit = late[a:z]
                    if elsewhere[i].is_valid:
                        hit = hit | np.isin(value[a:z].view(np.int64), elsewhere[i].values.to_numpy())
                    if not hit.any():
                        rows.append((None if was[i].as_py() else t, n, 0, ""))
                        continue
                    step = np.zeros(n + 1, dtype=np.int64)
                    np.add.at(step, first[a:z][hit], 1)
                    np.add.at(step, end[a:z][hit], -1)
                    gone = np.cumsum(step[:-1]) > 0
                    turn = np.r_[0, ends[i]][np.flatnonzero(np.diff(np.r_[False, gone, False]))].tolist()
                    kept = "".join(t[x:y] for x, y in zip([0, *turn[1::2]], [*turn[::2], len(t)], strict=True))
                    rows.append((kept, n, int(gone.sum()), ",".join(f"{x}:{y}" for x, y in zip(turn[::2], turn[1::2], strict=True))))
                text, n, removed, where = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(text, pa.string()), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(where, pa.string())], names=["doc_id", "text", "n_sentences", "n_removed", "removed"])

    return rows.mapInArrow(prune, "doc_id long, text string, n_sentences long, n_removed long, removed string")
