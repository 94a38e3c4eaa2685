"""Secret scan: rule matches plus sliding-window Shannon entropy.

Base rules (kinds ``assign``, ``access``, ``hex``) are leftmost, non-overlapping
per kind. The entropy scan adds spans of kind ``entropy``: a candidate is a run
of 20 or more characters of a secret's alphabet that no base span touches. A
window of 20 characters slides over it; the counts of its characters are updated
by the one that enters and the one that leaves, per character class (``hex``,
``upper`` for capitals and digits, ``mixed`` for the rest), and so is
``sum c*log2(c)``. A candidate is reported when some window reaches the class's
threshold and no allow-list rule holds.

A null text is empty; empty texts have no spans; texts of any length are read
whole; repeated rows each get their result. Offsets count code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.text import slices, texts_of

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = re.compile(r"""(?ai:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # runs are maximal, so shorter ones fail as a whole
CANDIDATE = re.compile(r"[A-Za-z0-9+/=_-]{20,}")
WINDOW = 20
#: Bits a character, by class, over a window of 20 (at most log2(20) = 4.32; 4 for hex).
THRESHOLDS = {"hex": 3.2, "upper": 3.6, "mixed": 3.8}
#: Candidates that are not secrets however random they look.
ALLOW = (
    re.compile(r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"),  # UUID
    re.compile(r"^[A-Za-z]+([-_/=+][A-Za-z]+)*$"),  # words, paths and identifiers without digits
    re.compile(r"^[0-9+/=_-]+$"),  # numbers, dates, rules of punctuation
    re.compile(r"(?i)example|sample|dummy|placeholder|x{6}|0{8}|1234567"),
)

_CLOGC = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]


def char_class(s: str) -> str:
    if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", s):
        return "hex"
    return "upper" if re.fullmatch(r"[A-Z0-9]+", s) else "mixed"


def peak_entropy(s: str, window: int = WINDOW) -> float:
    """The largest Shannon entropy of a window of ``s``, by incremental counts."""
    counts: dict[str, int] = {}
    total, best = 0.0, 0.0
    for i, ch in enumerate(s):
        c = counts.get(ch, 0)
        counts[ch] = c + 1
        total += _CLOGC[c + 1] - _CLOGC[c]
        if i >= window:
            c = counts[s[i - window]]
            counts[s[i - window]] = c - 1
            total += _CLOGC[c - 1] - _CLOGC[c]
        if i >= window - 1:
            best = max(best, math.log2(window) - total / window)
    return best


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, rank of the kind, end) of the base rules' matches."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 12] if ":" in text or "=" in text else []
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    return found + [(m.start(), 2, m.end()) for m in HEX.finditer(text)]


def entropy_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    out, taken, k = [], sorted((s, e) for s, _, e in base), 0
    for m in CANDIDATE.finditer(text):
        s, e = m.span()
        while k < len(taken) and taken[k][1] <= s:
            k += 1
        j = k
        while j < len(taken) and taken[j][0] < e and taken[j][1] <= s:
            j += 1
        if j < len(taken) and taken[j][0] < e:
            continue
        if not any(a.search(m[0]) for a in ALLOW) and peak_entropy(m[0]) >= THRESHOLDS[char_class(m[0])]:
            out.append((s, 3, e))
    return out


def spelled(spans: list[tuple[int, int, int]], kinds: tuple[str, ...] = KINDS) -> str:
    return ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in sorted(spans))


def scan_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_spans, n_entropy, spans), one row per row of ``docs``."""

    def scan(parts):
        for part in parts:
            for b in slices(part):
                rows = []
                for t in texts_of(b):
                    base = base_spans(t)
                    more = entropy_spans(t, base)
                    n = [sum(k == x for _, k, _ in base) for x in range(3)]
                    rows.append((*n, spelled(base), len(more), spelled(base + more)))
                cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string()), pa.array(cols[4], pa.int64()), pa.array(cols[5], pa.string())],
                    names=["doc_id", "n_assign", "n_access", "n_hex", "base_spans", "n_entropy", "spans"])

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return kept.mapInArrow(scan, "doc_id long, n_assign long, n_access long, n_hex long, base_spans string, n_entropy long, spans string")


def redact_secrets(text: str, mark: str = "[SECRET]") -> str:
    """The text with every span of either kind replaced."""
    base = base_spans(text)
    out, at = [], 0
    for s, _, e in sorted(base + entropy_spans(text, base)):
        if e <= at:
            continue
        out += [text[at:s], mark] if s >= at else []
        at = e
    return "".join([*out, text[at:]])


def digest(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()
