"""Byte-level BPE by batched numpy merge rounds.

A slice of texts is cut into words (pre-tokens) by vectorised character classes,
equal words are encoded once, and the words' symbols lie in one flat array. Each
round looks up every adjacent pair by binary search in the sorted pair keys,
takes each word's lowest rank, and merges all occurrences of that pair from left
to right; words without a known pair leave the array. Decoding gathers the bytes
of the ids.

The vocabulary file (tokenizers JSON: byte-level BPE without normaliser) is a
path; each worker process reads it once. The text of an added special token is
that token, as in the file's library.

A null text is empty and gives no ids; a text of any length is encoded whole
(slices are bounded by bytes, one text larger than that is a slice of its own);
repeated rows each get their result; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.text import slices, texts_of

OTHER, LETTER, NUMBER, BLANK = 0, 1, 2, 3
#: Unicode White_Space.
BLANKS = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
TAILS = ("re", "ve", "ll", "s", "t", "m", "d")
SHIFT = np.uint64(32)
#: Bytes of text encoded at once; the arrays of a slice take some sixty times as much.
SLICE_BYTES = 1 << 20


@lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    """Class of every code point: letter, number, blank or other."""
    by = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((by.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)), dtype=np.uint8, count=sys.maxunicode + 1)
    out[list(BLANKS)] = BLANK
    return out


def byte_chars() -> dict[str, int]:
    """The printable character that stands for each byte in the file, inverted."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Pair keys sorted for binary search, with the ranks and results of their merges, and the bytes of each id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, chars = spec["model"]["vocab"], byte_chars()
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], dtype=np.uint64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)  # by rank
        self.first = np.zeros(256, dtype=np.int64)
        for ch, b in chars.items():
            self.first[b] = vocab[ch]
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*vocab.values(), *self.added.values()]) + 1
        spelled = [b""] * size
        for token, i in vocab.items():
            spelled[i] = bytes(chars[c] for c in token)
        for token, i in self.added.items():
            spelled[i] = token.encode()
        self.bytes = pa.array(spelled, pa.large_binary())
        self.digits = pa.array([f"{i}," for i in range(size)], pa.large_binary())
        self.special = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def word_starts(points: np.ndarray, cls: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """True where a word begins. ``ends``: one past the last point of each piece of text.

    Words are runs of letters, of numbers or of other marks, with one space before
    them if there is one; contractions (``'s 't 're 've 'm 'll 'd``); and white
    space, of which the last character before a word stands alone unless it is
    that space.
    """
    n = len(points)
    if n == 0:
        return np.zeros(0, dtype=bool)
    head = np.zeros(n, dtype=bool)
    head[0] = True
    head[ends[:-1][ends[:-1] < n]] = True
    tail = np.zeros(n, dtype=bool)
    tail[ends[ends > 0] - 1] = True
    blank = cls == BLANK
    prev_cls, prev_space = np.roll(cls, 1), np.roll((points == 32), 1)
    next_word = np.roll(~blank, -1) & ~tail
    start = np.where(blank, (prev_cls != BLANK) | next_word, (cls != prev_cls) & ~prev_space)
    start |= head
    for i in np.flatnonzero(start & (points == 39) & ~tail):
        stop = int(ends[np.searchsorted(ends, i, side="right")])
        after = "".join(map(chr, points[i + 1:min(i + 3, stop)]))
        t = next((t for t in TAILS if after.startswith(t)), None)
        if t:
            start[i + 1:i + 1 + len(t)] = False
            if i + 1 + len(t) < n:  # a letter goes on as a word of its own; else a word starts here as it is
                start[i + 1 + len(t)] |= cls[i + 1 + len(t)] == LETTER
    return start


def merge_words(words: pa.Array, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words, first id of each word plus the end)."""
    n = len(words)
    offsets = np.frombuffer(words.buffers()[1], dtype=np.int64, count=n + 1 + words.offset)[words.offset:]
    data = np.frombuffer(words.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]] if words.buffers()[2] else np.empty(0, dtype=np.uint8)
    ids = v.first[data]
    word = np.repeat(np.arange(n), np.diff(offsets))
    done_ids, done_words = [], []
    while len(ids):
        joined = word[1:] == word[:-1]
        keys = (ids[:-1].astype(np.uint64) << SHIFT) | ids[1:].astype(np.uint64)
        at = np.minimum(np.searchsorted(v.keys, keys), len(v.keys) - 1)
        rank = np.where(joined & (v.keys[at] == keys), v.ranks[at], np.iinfo(np.int64).max)
        heads = np.flatnonzero(np.r_[True, ~joined])
        low = np.minimum.reduceat(np.r_[rank, np.iinfo(np.int64).max], heads)
        sizes = np.diff(np.r_[heads, len(ids)])
        still = np.repeat(low < np.iinfo(np.int64).max, sizes)
        if not still.all():
            done_ids.append(ids[~still])
            done_words.append(word[~still])
            ids, word, rank = ids[still], word[still], np.r_[rank, np.iinfo(np.int64).max][still][:-1]
            low, sizes = low[low < np.iinfo(np.int64).max], sizes[low < np.iinfo(np.int64).max]
            if not len(ids):
                break
        hit = np.flatnonzero(rank == np.repeat(low, sizes)[:-1])  # a word's last symbol has no rank
        run = np.r_[True, np.diff(hit) > 1]  # in a run of overlapping pairs (aaaa) every second one merges
        first = np.maximum.accumulate(np.where(run, np.arange(len(hit)), 0))
        hit = hit[(np.arange(len(hit)) - first) % 2 == 0]
        ids[hit] = v.made[rank[hit]]
        keep = np.ones(len(ids), dtype=bool)
        keep[hit + 1] = False
        ids, word = ids[keep], word[keep]
    ids = np.concatenate([*done_ids, ids]) if done_ids else ids
    word = np.concatenate([*done_words, word]) if done_words else word
    order = np.argsort(word, kind="stable")
    first = np.zeros(n + 1, dtype=np.int64)
    np.cumsum(np.bincount(word, minlength=n), out=first[1:])
    return ids[order], first


def encode_texts(texts: list[str], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, first id of each text plus the end)."""
    pieces, owner, special = [], [], []
    for i, t in enumerate(texts):
        at = 0
        for m in v.special.finditer(t) if v.special and any(s in t for s in v.added) else ():
            if m.start() > at:
                pieces.append(t[at:m.start()])
                owner.append(i)
            special.append((len(pieces), i, v.added[m[0]]))
            at = m.end()
        if t[at:]:
            pieces.append(t[at:])
            owner.append(i)
    raw = "".join(pieces)
    ids, first = np.empty(0, dtype=np.int64), np.zeros(1, dtype=np.int64)
    if raw:
        points = np.frombuffer(raw.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        ends = np.cumsum([len(p) for p in pieces])
        start = np.flatnonzero(word_starts(points, char_classes()[points], ends))
        utf8 = raw.encode("utf-8", "replace")
        width = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
        at = np.zeros(len(points) + 1, dtype=np.int64)
        np.cumsum(width, out=at[1:])
        offsets = np.append(at[start], at[-1])
        words = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(utf8)])
        coded = words.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        word_ids, word_first = merge_words(coded.dictionary, v)
        sizes = np.diff(word_first)[codes]
        stop = np.cumsum(sizes)
        ids = word_ids[np.arange(stop[-1]) - np.repeat(stop - sizes, sizes) + np.repeat(word_first[codes], sizes)]
        piece_words = np.searchsorted(start, np.r_[0, ends])
        first = np.r_[0, stop][piece_words]
    if special:
        parts, owners, k = [], [], 0
        for p in range(len(pieces) + 1):
            while k < len(special) and special[k][0] == p:
                parts.append(np.array([special[k][2]]))
                owners.append(special[k][1])
                k += 1
            if p < len(pieces):
                parts.append(ids[first[p]:first[p + 1]])
                owners.append(owner[p])
        ids = np.concatenate(parts)
        counts = np.bincount(owners, weights=[len(p) for p in parts], minlength=len(texts)).astype(np.int64)
    else:
        counts = np.bincount(owner, weights=np.diff(first), minlength=len(texts)).astype(np.int64) if owner else np.zeros(len(texts), dtype=np.int64)
    upto = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(counts, out=upto[1:])
    return ids, upto


def _gathered(ids: np.ndarray, table: pa.Array) -> tuple[memoryview, np.ndarray]:
    """(the bytes of the ids one after another, offset of each id plus the end)."""
    out = table.take(pa.array(ids))
    if not len(ids):
        return memoryview(b""), np.zeros(1, dtype=np.int64)
    return memoryview(out.buffers()[2]), np.frombuffer(out.buffers()[1], dtype=np.int64, count=len(ids) + 1)


def decode_ids(ids: np.ndarray, upto: np.ndarray, v: Vocabulary) -> list[str]:
    """The texts of runs of ids; bytes that aren't UTF-8 become U+FFFD."""
    data, at = _gathered(ids, v.bytes)
    return [bytes(data[at[a]:at[b]]).decode("utf-8", "replace") for a, b in zip(upto[:-1], upto[1:], strict=True)]


def encode(docs: DataFrame, path: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, ids) or, for checks, (doc_id, n_tokens, ids_sha256, decoded_sha256)."""

    def digests(ids, upto, v):
        data, at = _gathered(ids, v.digits)
        listed = [hashlib.sha256(data[at[a]:max(at[a], at[b] - 1)]).hexdigest() for a, b in zip(upto[:-1], upto[1:], strict=True)]
        back = [hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in decode_ids(ids, upto, v)]
        return [pa.array(np.diff(upto)), pa.array(listed, pa.string()), pa.array(back, pa.string())]

    def run(parts):
        v = vocabulary(path)
        for part in parts:
            for b in slices(part, limit=SLICE_BYTES):
                ids, upto = encode_texts(texts_of(b), v)
                if with_ids:
                    cols, names = [pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), pa.array(ids.astype(np.int32)))], ["ids"]
                else:
                    cols, names = digests(ids, upto, v), ["n_tokens", "ids_sha256", "decoded_sha256"]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), *cols], names=["doc_id", *names])

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return kept.mapInArrow(run, "doc_id long, ids array<int>" if with_ids else "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids, text), one row per row of ``docs``; the text is decoded from the ids."""

    def run(parts):
        v = vocabulary(path)
        for part in parts:
            for b in slices(part, limit=SLICE_BYTES):
                ids, upto = encode_texts(texts_of(b), v)
                lists = pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.diff(upto)), lists, pa.array(decode_ids(ids, upto, v), pa.string())], names=["doc_id", "n_tokens", "ids", "text"])

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return kept.mapInArrow(run, "doc_id long, n_tokens long, ids array<int>, text string")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); null ids are an empty text."""

    def run(parts):
        v = vocabulary(path)
        for b in parts:
            lists = pc.fill_null(b.column("ids"), pa.scalar([], pa.list_(pa.int32())))
            upto = np.zeros(len(lists) + 1, dtype=np.int64)
            np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), out=upto[1:])
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(decode_ids(ids, upto, v), pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")
