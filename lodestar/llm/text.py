"""Batch helpers shared by the Arrow-based operators.

All helpers work on one bounded slice of rows at a time. A slice is cut by
bytes, so that very long texts never pile up in one numpy buffer; a single text
larger than the bound forms a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 6 << 20
#: ASCII white space: the characters between words.
BLANKS = b"\t\n\x0b\x0c\r "
#: Trimmed off both ends of a word before it is compared.
EDGES = ".,;:!?\"'()[]{}<>*#$%&|-_/\\=+~`^@…“”‘’«»¡¿"

_IS_BLANK = np.zeros(256, dtype=bool)
_IS_BLANK[list(BLANKS)] = True


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts hold about ``limit`` bytes."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    start, n = 0, batch.num_rows
    while start < n:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts; null counts as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def split_words(texts: list[str], lower: bool = True) -> tuple[np.ndarray, pa.Array]:
    """(first word of each text plus the end, all words as one Arrow string array).

    A word is a maximal run without ASCII white space; it is never cut.
    """
    raw = [(t.lower() if lower else t).encode("utf-8", "replace") for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
    ends = np.cumsum([len(r) + 1 for r in raw], dtype=np.int64)
    blank = _IS_BLANK[data]
    edge = np.diff(blank.astype(np.int8), prepend=np.int8(1))
    first, last = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    offsets = np.zeros(len(first) + 1, dtype=np.int64)
    np.cumsum(last - first, out=offsets[1:])
    words = pa.Array.from_buffers(pa.large_string(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(data[~blank].tobytes())])
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    starts[1:] = np.searchsorted(first, ends)
    return starts, words


def word_codes(words: pa.Array, trim: bool = True) -> tuple[np.ndarray, list[str]]:
    """(code of each word, the distinct words), trimmed of punctuation at both ends.

    Distinct spellings that trim to the same word keep their own codes; hash the
    returned strings to compare them.
    """
    coded = words.dictionary_encode()
    distinct = coded.dictionary
    if trim:
        distinct = pc.utf8_trim(distinct, characters=EDGES)
    return coded.indices.to_numpy(zero_copy_only=False), distinct.to_pylist()


def hashed(strings: list[str], seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each string."""
    h = xxhash.xxh64_intdigest
    return np.fromiter((h(s, seed) for s in strings), dtype=np.uint64, count=len(strings))


def word_hashes(texts: list[str], seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(first word of each text plus the end, hash of each lower-case trimmed word).

    Words that are punctuation only are left out.
    """
    starts, words = split_words(texts)
    if len(words) == 0:
        return starts, np.empty(0, dtype=np.uint64)
    codes, distinct = word_codes(words)
    table = hashed(distinct, seed)
    keep = np.fromiter((s != "" for s in distinct), dtype=bool, count=len(distinct))[codes]
    upto = np.zeros(len(codes) + 1, dtype=np.int64)
    np.cumsum(keep, out=upto[1:])
    return upto[starts], table[codes[keep]]


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def batches(arrays: dict[str, pa.Array], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([arrays[n] for n in names], names=names)
