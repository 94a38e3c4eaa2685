"""Leaf-wise histogram trees on Spark (the tree step of LTR-03).

* Features become small integers once: ``quantile_edges`` reads all of them in
  one aggregate (a mergeable quantile summary per feature), ``binned`` replaces
  a value by the number of edges below it.
* Gradients and hessians are fixed-point integers (2^-24), so the sums of a
  histogram are exact and a tree is the same under any partitioning and after
  any retry.
* A tree always splits the open leaf of the largest gain, until it has exactly
  ``num_leaves`` leaves or no split is allowed. A histogram job serves all open
  leaves that may still be split: with m leaves to go only the m best can be, so
  their children are measured together and a tree of 31 leaves takes about as
  many jobs as it is deep. Only the smaller child of a leaf is read; the larger
  one is parent minus sibling.

The driver holds at most 2 * ``num_leaves`` histograms of features x bins x 3
integers (4 MB at 31 leaves, 10 features, 256 bins), whatever the row count; a
task hands on at most leaves x features x bins rows, already summed.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCALE = 2 ** 24        # fixed point of gradients and hessians
MIN_HESSIAN = 1e-3     # smallest hessian sum of a leaf
BIN_STEPS = 256        # quantile steps, so at most 256 bins


def quantile_edges(frame: DataFrame, cols: list[str], steps: int = BIN_STEPS, accuracy: int = 10000) -> dict[str, list[float]]:
    """Ascending distinct quantiles of each column below its maximum; bin b holds values up to edge b.

    One aggregate over the frame. The rank error of a quantile is rows/``accuracy``;
    nulls take no part, a constant or empty column has no edges.
    """
    p = [k / steps for k in range(1, steps)]
    row = frame.agg(*[F.percentile_approx(c, p, accuracy).alias(f"q{i}") for i, c in enumerate(cols)],
                    *[F.max(c).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    return {c: sorted({float(x) for x in (row[f"q{i}"] or []) if x < row[f"m{i}"]}) for i, c in enumerate(cols)}


def binned(frame: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    """The frame with each column of ``edges`` replaced by its bin: the number of edges below the value."""
    schema = T.StructType([T.StructField(f.name, T.ShortType()) if f.name in edges else f for f in frame.schema])
    arrays = {c: np.array(e, dtype=np.float64) for c, e in edges.items()}

    def run(batches):
        for pdf in batches:
            yield pdf.assign(**{c: np.searchsorted(e, pdf[c].to_numpy(dtype=np.float64), side="left").astype(np.int16) for c, e in arrays.items()})

    return frame.mapInPandas(run, schema)


def fixed_point(value: Column) -> Column:
    """``value`` in units of 2^-24, rounded to a long."""
    return F.floor(value * F.lit(float(SCALE)) + F.lit(0.5)).cast("bigint")


@dataclass
class Split:
    feature: int
    bin: int
    gain: float            # in units of 2^-24
    left: np.ndarray       # sums (gradient, hessian, rows) of the left child
    right: np.ndarray


@dataclass
class Leaf:
    sums: np.ndarray                       # gradient, hessian, rows
    hist: np.ndarray | None = None         # features x bins x 3
    split: Split | None = None
    children: tuple[Leaf, Leaf] | None = None   # measured, not yet part of the tree
    grown: bool = False
    number: int = 0

    @property
    def value(self) -> float:
        """The Newton step of the leaf."""
        return -float(self.sums[0]) / float(self.sums[1]) if self.sums[1] > 0 else 0.0


def best_split(hist: np.ndarray, min_rows: int) -> Split | None:
    """The split of the largest positive gain; ties go to the first feature, then the lowest bin."""
    left = hist.cumsum(axis=1)[:, :-1]
    if left.shape[1] == 0:
        return None
    total = hist[0].sum(axis=0)
    right = total - left
    least = MIN_HESSIAN * SCALE
    ok = (left[..., 2] >= min_rows) & (right[..., 2] >= min_rows) & (left[..., 1] >= least) & (right[..., 1] >= least)
    if not ok.any():
        return None
    lg, lh, rg, rh = (x.astype(np.float64) for x in (left[..., 0], left[..., 1], right[..., 0], right[..., 1]))
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (lg * lg / lh + rg * rg / rh) - float(total[0]) * float(total[0]) / float(total[1])
    gain = np.where(ok, gain, -np.inf)
    f, b = np.unravel_index(int(np.argmax(gain)), gain.shape)
    if not gain[f, b] > 0:
        return None
    return Split(int(f), int(b), float(gain[f, b]), left[f, b].copy(), right[f, b].copy())


@dataclass
class HistTree:
    cols: list[str]
    root: Leaf
    splits: list[tuple] = field(default_factory=list)  # (split no, leaf number, feature, bin, gain, left sums, right sums)

    def nodes(self, edges: dict[str, list[float]]) -> dict:
        """Nested {feature, threshold, left, right} / {value} over the raw features."""
        return self._nested(self.root, lambda f, b: edges[self.cols[f]][b])

    def bin_nodes(self) -> dict:
        """The same tree over the binned features."""
        return self._nested(self.root, lambda f, b: b)

    def _nested(self, leaf: Leaf, at) -> dict:
        if not leaf.grown:
            return {"value": leaf.value}
        s = leaf.split
        return {"feature": self.cols[s.feature], "threshold": at(s.feature, s.bin),
                "left": self._nested(leaf.children[0], at), "right": self._nested(leaf.children[1], at)}

    def gains(self) -> dict[str, float]:
        """Summed gain per feature."""
        out = {c: 0.0 for c in self.cols}
        for _, _, f, _, gain, _, _ in self.splits:
            out[self.cols[f]] += gain / SCALE
        return out


def _send(route, bins: list[np.ndarray], rows: np.ndarray, out: np.ndarray) -> None:
    """Write into ``out`` the number that ``route`` gives each of ``rows``; None leaves a row out."""
    if route is None:
        return
    if isinstance(route, int):
        out[rows] = route
        return
    feature, cut, inside, outside = route
    low = bins[feature][rows] <= cut
    _send(inside, bins, rows[low], out)
    _send(outside, bins, rows[~low], out)


def _count(cells: np.ndarray, g: np.ndarray, h: np.ndarray, bins: list[np.ndarray], route, n_bins: int) -> None:
    """Add the rows that ``route`` numbers to ``cells``: features x (nodes x bins) x (gradient, hessian, rows)."""
    node = np.full(len(g), -1, dtype=np.int64)
    _send(route, bins, np.arange(len(g)), node)
    at = np.flatnonzero(node >= 0)
    for i, x in enumerate(bins):
        cell = node[at] * n_bins + x[at]
        for k, w in enumerate((g[at], h[at], None)):
            cells[i, :, k] += np.bincount(cell, weights=w, minlength=cells.shape[1]).astype(np.int64)


def _histograms(data: DataFrame, cols: list[str], route, n_nodes: int, n_bins: int) -> np.ndarray:
    """nodes x features x bins x (gradient, hessian, rows) of the rows that ``route`` numbers.

    Each task counts its rows into one array and hands on the cells in use; one
    aggregate adds them up. The plan is the same for every tree, so Spark
    compiles it once. Batch sums go through doubles and stay below 2^53.
    """
    def run(batches):
        cells = np.zeros((len(cols), n_nodes * n_bins, 3), dtype=np.int64)
        for batch in batches:
            g, h, *bins = (x.to_numpy(zero_copy_only=False) for x in batch.columns)
            _count(cells, g, h, bins, route, n_bins)
        f, cell = np.nonzero(cells[..., 2])
        sums = cells[f, cell]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in ((cell // n_bins).astype(np.int32), f.astype(np.int32), (cell % n_bins).astype(np.int32),
                                                                sums[:, 0], sums[:, 1], sums[:, 2])], names=["n", "f", "b", "g", "h", "c"])

    t = (data.select("_g", "_h", *cols).mapInArrow(run, "n int, f int, b int, g bigint, h bigint, c bigint")
         .groupBy("n", "f", "b").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("c").alias("c"))).toArrow()
    n, f, b, g, h, c = (t.column(i).to_numpy() for i in range(6))
    out = np.zeros((n_nodes, len(cols), n_bins, 3), dtype=np.int64)
    out[n, f, b] = np.stack([g, h, c], axis=1)
    return out


def _measure(histograms, root: Leaf, wanted: list[Leaf], min_rows: int) -> None:
    """Give every wanted leaf its two children, with histograms: the smaller read, the larger subtracted."""
    index = {id(leaf): i for i, leaf in enumerate(wanted)}

    def route(leaf: Leaf):
        s = leaf.split
        if leaf.grown:
            return s.feature, s.bin, route(leaf.children[0]), route(leaf.children[1])
        if id(leaf) not in index:
            return None
        own = index[id(leaf)]
        return (s.feature, s.bin, own, None) if s.left[2] <= s.right[2] else (s.feature, s.bin, None, own)

    small = histograms(route(root), len(wanted))
    for leaf, hist in zip(wanted, small):
        s = leaf.split
        pair = (hist, leaf.hist - hist) if s.left[2] <= s.right[2] else (leaf.hist - hist, hist)
        leaf.children = tuple(Leaf(sums, x, best_split(x, min_rows)) for sums, x in zip((s.left, s.right), pair))
        leaf.hist = None


def grow_tree(data: DataFrame, cols: list[str], num_leaves: int, min_rows: int, n_bins: int = BIN_STEPS) -> HistTree:
    """The best-first tree over ``data``: binned feature columns ``cols`` and fixed-point ``_g``, ``_h``.

    An empty ``data`` gives a single leaf of value 0. ``data`` is read once a
    histogram job; persist it.
    """
    return grow(cols, lambda route, n_nodes: _histograms(data, cols, route, n_nodes, n_bins), num_leaves, min_rows)


def grow(cols: list[str], histograms, num_leaves: int, min_rows: int, first: np.ndarray | None = None) -> HistTree:
    """The best-first tree over rows that ``histograms(route, nodes)`` counts: nodes x features x bins x 3.

    ``first`` is the histogram of all rows, where it is known already.
    """
    hist = first if first is not None else histograms(0, 1)[0]
    root = Leaf(hist[0].sum(axis=0), hist, best_split(hist, min_rows))
    tree, leaves = HistTree(cols, root), [root]
    while len(leaves) < num_leaves:
        ready = sorted((x for x in leaves if x.split), key=lambda x: (-x.split.gain, x.number))
        if not ready:
            break
        best, left_to_go = ready[0], num_leaves - len(leaves)
        if best.children is None and left_to_go == 1:
            best.children = (Leaf(best.split.left), Leaf(best.split.right))
        elif best.children is None:
            _measure(histograms, root, [x for x in ready[:left_to_go] if x.children is None], min_rows)
        s = best.split
        tree.splits.append((len(tree.splits), best.number, s.feature, s.bin, s.gain, s.left, s.right))
        best.grown = True
        inside, outside = best.children
        inside.number, outside.number = best.number, len(leaves)
        leaves[best.number] = inside
        leaves.append(outside)
    return tree
