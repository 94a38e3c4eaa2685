"""N-gram Jaccard self-join by chosen paths.

Documents are sets of five-word shingles (lower-case words, trimmed of
punctuation; fewer than five words are one shingle). Equal texts are one vertex.
Vertices are linked when the Jaccard similarity of their sets is 0.8 or more.

1. Each vertex gets ``T`` minimum-hash values: two vertices share each of these
   tokens with probability equal to their similarity.
2. In each of ``RUNS`` runs a node starts with all vertices and is split: one or
   two token positions (1/0.8 = 1.25 on average) are drawn from a hash of the
   node, and its vertices go on to one child for each value there. Two vertices
   of similarity 0.8 thus share one child of a shared node on average. All nodes
   are split twice; larger ones than ``BUCKET`` vertices further, until they are
   small or ``MAX_DEPTH`` deep; a node whose split would leave most of it
   together stays whole. Each deeper split is repeated with other draws (``REPEATS``), so that depth costs
   next to no pairs. All runs draw from the same ``T`` values; averaged over how
   many of these agree (``miss_rate``), a pair of similarity 0.8 is missed once
   in 52,000 at two levels and at most once in ``TARGET`` at any depth, more
   similar ones less often.
3. Each final bucket is compared pair by pair: a bucket larger than ``BUCKET``
   in square blocks, each its own task unit. A pair belongs to the smallest
   bucket that both are in and is judged only there: first by its minimum hashes
   (a filter so wide that a link fails it once in a million), then exactly on
   the shingle sets, which only the vertices that still have a partner bring. A
   block of more than ``SLICE`` shingles takes them in slices of the hashes and
   adds up what its pairs share in each, so long texts need no larger memory.
4. A block counts each vertex's links and gives a spanning forest of them, so
   rows never grow with the square of a group. Connected components over the
   forests (star contraction) are the classes.

A null text is empty. Texts without words have no links, but equal texts are one
class. ``class_id`` is the smallest doc_id of the class (null when it has none);
a null id is a document like any other; repeated rows each get their row. Texts
are read whole; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.text import mixed, slices, texts_of, word_hashes
from lodestar.session import checkpoint_dir

N = 5
SIMILARITY = 0.8
T = 64
RUNS = 10
SEED = 97
BUCKET = 1024
MAX_DEPTH = 6
#: At most one pair of similarity 0.8 in so many is missed, whatever the depth.
TARGET = 40_000
#: Splits of a node at levels 3, 4, 5 and 6, each with draws of its own.
REPEATS = (4, 2, 1, 2)
#: Of ``T`` values so many must agree: for similarity 0.8 fewer do once in a million.
MIN_AGREEING = 36
#: Shingles of a block that are compared at once.
SLICE = 1 << 20
#: A block counts shared shingles by matrix products of so many columns at most.
COLUMNS = 2048
#: Vertex lists are joined by broadcast up to so many rows, else by a shuffle.
BROADCAST_ROWS = 200_000
NO_ID = 2**63 - 1

_rng = np.random.default_rng(SEED)
_MULTIPLIERS = _rng.integers(1, 2**63, size=T, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = _rng.integers(1, 2**63, size=N, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(first shingle of each text plus the end, hashes of the shingles, repeated ones too)."""
    starts, words = word_hashes(texts)
    n_words = np.diff(starts)
    n_out = np.where(n_words >= N, n_words - N + 1, (n_words > 0).astype(np.int64))
    upto = np.r_[0, np.cumsum(n_out)]
    if not upto[-1]:
        return upto, np.empty(0, dtype=np.uint64)
    at = np.arange(upto[-1]) - np.repeat(upto[:-1] - starts[:-1], n_out)
    size = np.repeat(np.minimum(n_words, N), n_out)
    out = mixed(size.astype(np.uint64) + np.uint64(SEED))
    with np.errstate(over="ignore"):
        for k in range(N):
            word = words[np.minimum(at + k, len(words) - 1)]
            out = out + np.where(k < size, mixed(word * _PLACES[k]), np.uint64(0))
    return upto, mixed(out)


def signatures(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(numbers of the texts with a shingle, their numbers of shingles, their minimum hashes as 16-bit values)."""
    upto, s = shingle_hashes(texts)
    some = np.flatnonzero(np.diff(upto))
    out = np.empty((len(some), T), dtype=np.uint16)
    if len(some):
        heads = upto[:-1][some]
        with np.errstate(over="ignore"):
            for i in range(T):
                out[:, i] = (mixed(np.minimum.reduceat((s * _MULTIPLIERS[i]) >> np.uint64(20), heads)) & np.uint64(0xFFFF)).astype(np.uint16)
    return some, np.diff(upto)[some], out


def children(nodes: np.ndarray, sigs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, child node) of every vertex row for each token position drawn by its node."""
    u = mixed(nodes ^ np.uint64(SEED))
    one = (u % np.uint64(T)).astype(np.int64)
    two = ((u >> np.uint64(16)) % np.uint64(T)).astype(np.int64)
    two = np.where(two == one, (two + 1) % T, two)
    both = np.flatnonzero((u >> np.uint64(40)) % np.uint64(1024) < np.uint64(round(1024 * (1 / SIMILARITY - 1))))
    row = np.r_[np.arange(len(nodes)), both]
    place = np.r_[one, two[both]]
    token = sigs[row, place].astype(np.uint64) * np.uint64(T) + place.astype(np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        return row, mixed(nodes[row] * np.uint64(0x9E3779B97F4A7C15) + mixed(token))


def repeated(nodes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, node) of the repeats of every row's node that make the split to level ``depth``."""
    salts = mixed(np.arange(REPEATS[depth - 3], dtype=np.uint64) + np.uint64(SEED * depth))
    with np.errstate(over="ignore"):
        return np.tile(np.arange(len(nodes)), len(salts)), mixed(nodes[None, :] + salts[:, None]).ravel()


def kept_apart(agreement: float, depth: int) -> float:
    """Probability that no run puts two vertices in one bucket that agree in this share of the values."""
    both = round(1024 * (1 / SIMILARITY - 1)) / 1024

    def split(lost: float) -> float:
        child = 1 - agreement + agreement * lost
        return (1 - both) * child + both * child * child

    lost = 0.0
    for level in range(depth, 0, -1):
        lost = split(lost) ** (REPEATS[level - 3] if level > 2 else 1)
    return lost ** RUNS


def miss_rate(depth: int, similarity: float = SIMILARITY) -> float:
    """Share of the pairs of a similarity that no bucket has whose nodes all are split to ``depth``."""
    return sum(math.comb(T, a) * similarity**a * (1 - similarity)**(T - a) * kept_apart(a / T, depth) for a in range(T + 1))


def _sig_column(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), dtype=np.uint16).reshape(-1, T)


def _vertices(docs: DataFrame) -> DataFrame:
    """(k, sig, n): one row per text with a shingle, known by its hash; its shingles, repeated ones too, are ``n``."""

    def sign(parts):
        for part in parts:
            for b in slices(part):
                keys, at = np.unique(b.column("k").to_numpy(), return_index=True)
                texts = texts_of(b)
                some, n, sig = signatures([texts[i] for i in at])
                yield pa.RecordBatch.from_arrays([pa.array(keys[some]), pa.array([r.tobytes() for r in sig], pa.binary()), pa.array(n)], names=["k", "sig", "n"])

    return docs.select("k", "text").mapInArrow(sign, "k long, sig binary, n long").groupBy("k").agg(F.first("sig").alias("sig"), F.first("n").alias("n"))


def _first_nodes(vertices: DataFrame) -> DataFrame:
    """(node, k): where each vertex is after two splits of every run."""

    def walk(parts):
        for b in parts:
            if not b.num_rows:
                continue
            sigs, keys = _sig_column(b.column("sig")), b.column("k").to_numpy()
            rows = np.tile(np.arange(len(keys)), RUNS)
            nodes = np.repeat(mixed(np.arange(1, RUNS + 1).astype(np.uint64) * np.uint64(SEED)), len(keys))
            for _ in range(2):
                at, nodes = children(nodes, sigs[rows])
                rows = rows[at]
            yield pa.RecordBatch.from_arrays([pa.array(nodes.view(np.int64)), pa.array(keys[rows])], names=["node", "k"])

    return vertices.mapInArrow(walk, "node long, k long")


def _split(members: DataFrame, vertices: DataFrame, depth: int) -> DataFrame:
    """(node, k, parent, parent_size): the children, at level ``depth``, of ``members`` (node, k, size)."""

    def walk(parts):
        for b in parts:
            if not b.num_rows:
                continue
            rows, nodes = repeated(b.column("node").to_numpy().view(np.uint64), depth)
            at, nodes = children(nodes, _sig_column(b.column("sig"))[rows])
            take = pa.array(rows[at])
            yield pa.RecordBatch.from_arrays([pa.array(nodes.view(np.int64)), b.column("k").take(take), b.column("node").take(take), b.column("size").take(take)], names=["node", "k", "parent", "parent_size"])

    return members.join(vertices, "k").select("node", "k", "size", "sig").mapInArrow(walk, "node long, k long, parent long, parent_size long")


def buckets(vertices: DataFrame) -> DataFrame:
    """(bucket, k, size) of all final buckets with two or more vertices."""
    nodes = _first_nodes(vertices)
    nodes, done = nodes.join(nodes.groupBy("node").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "node").checkpoint(), None
    as_bucket = lambda d: d.select(F.col("node").alias("bucket"), "k", "size")
    for depth in range(2, MAX_DEPTH + 1):
        final = F.col("size") <= BUCKET
        ready = as_bucket(nodes if depth == MAX_DEPTH else nodes.where(final))
        done = ready if done is None else done.unionByName(ready)
        more = nodes.where(~final).select("node", "k", "size")  # without the parent of its own, which the next level's would clash with
        if depth == MAX_DEPTH or more.isEmpty():
            break
        nodes = _split(more, vertices, depth + 1)
        nodes = nodes.join(nodes.groupBy("node").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "node").checkpoint()
        whole = nodes.where(2 * F.col("size") >= F.col("parent_size")).select("parent").distinct().checkpoint()
        done = done.unionByName(as_bucket(more.join(whole, F.col("node") == F.col("parent"), "left_semi")))
        nodes = nodes.join(whole, "parent", "left_anti")
    return done


def _blocked(members: DataFrame) -> DataFrame:
    """Rows of ``members`` (bucket, size, k, ...) for each block of their bucket: (bucket, a, b, own, ...).

    A bucket of m vertices has ceil(m / BUCKET) chunks; block (a, b) compares chunk a with chunk b.
    """
    chunks = F.ceil(F.col("size") / F.lit(BUCKET)).cast("int")
    d = members.withColumn("own", F.pmod(F.xxhash64("k"), chunks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
    return d.withColumn("a", F.least("own", "other")).withColumn("b", F.greatest("own", "other")).drop("other", "size")


_BLOCK = ["bucket", "a", "b"]


def _by_block(rows: DataFrame, *order: str) -> DataFrame:
    return rows.repartition(*_BLOCK).sortWithinPartitions(*_BLOCK, *order)


def _groups(parts: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.Table]:
    """The runs of equal ``by`` of a sorted partition; at most two chunks of vertices each."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in parts:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(c).to_numpy() for c in by], axis=1)
        heads = np.r_[0, np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1, len(key)]
        for s, e in zip(heads[:-1], heads[1:], strict=True):
            now = tuple(key[s])
            if held and now != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(s, e - s))
            last = now
    if held:
        yield pa.Table.from_batches(held)


def _owned(group: pa.Table) -> np.ndarray:
    """Matrix of the pairs (row < column) that this block must judge: no smaller bucket has both."""
    n, bucket = group.num_rows, group.column("bucket")[0].as_py()
    out = np.triu(np.ones((n, n), dtype=bool), 1)
    if group.column("a")[0].as_py() != group.column("b")[0].as_py():
        own = group.column("own").to_numpy()
        out &= own[:, None] != own[None, :]
    lists = group.column("buckets").combine_chunks()
    flat, owner = lists.flatten().to_numpy(), np.repeat(np.arange(n), np.diff(lists.offsets.to_numpy()))
    less = flat < bucket
    flat, owner = flat[less], owner[less]
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    heads = np.r_[0, np.flatnonzero(flat[1:] != flat[:-1]) + 1, len(flat)] if len(flat) else np.zeros(1, dtype=np.int64)
    for s, e in zip(heads[:-1], heads[1:], strict=True):
        if e - s > 1:
            both = owner[s:e]
            out[np.ix_(both, both)] = False
    return out


def _agreeing(group: pa.Table) -> np.ndarray:
    sigs = _sig_column(group.column("sig").combine_chunks())
    out = np.zeros((len(sigs), len(sigs)), dtype=np.uint8)
    for i in range(T):
        out += sigs[:, i, None] == sigs[None, :, i]
    return out


def _with_partner(rows: DataFrame) -> DataFrame:
    """(bucket, a, b, own, k, slices) of the rows that may have a link to find in their block, to be compared in so many slices."""

    def keep(parts):
        for g in _groups(parts, _BLOCK):
            if g.num_rows > 1:
                pairs = np.triu(_agreeing(g) >= MIN_AGREEING, 1)
                if pairs.any():  # few blocks, most of them of a common passage, must look up who judges a pair
                    pairs &= _owned(g)
                    left = np.flatnonzero(pairs.any(axis=0) | pairs.any(axis=1))
                    if len(left):
                        slices = slices_of(int(g.column("n").to_numpy()[left].sum()), SLICE)
                        out = g.select([*_BLOCK, "own", "k"]).take(pa.array(left))
                        yield from out.append_column("slices", pa.array(np.full(len(left), slices))).combine_chunks().to_batches()

    return _by_block(rows, "k").mapInArrow(keep, "bucket long, a int, b int, own int, k long, slices long")


def slices_of(n: int, most: int) -> int:
    """The power of two that cuts ``n`` shingles into slices of ``most`` or fewer."""
    return 1 << max(0, (n - 1) // most).bit_length()


def _root(parent: np.ndarray, i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


class _Block:
    """The pairs of one block and the shingles they share, as far as its slices have come."""

    def __init__(self, group: pa.Table):
        """``group``: the rows of the first slice, one or more for each vertex."""
        head = group.select([*_BLOCK, "own", "buckets", "k", "size"]).filter(pa.array(self._heads(group)))
        self.key = [head.column(c)[0] for c in _BLOCK]
        self.k, self.size = head.column("k").to_numpy(), head.column("size").to_numpy()
        self.pairs = _owned(head) & (np.minimum(self.size[:, None], self.size[None, :]) >= SIMILARITY * np.maximum(self.size[:, None], self.size[None, :]) - 1e-9)
        self.common = np.zeros(self.pairs.shape, dtype=np.int32)

    @staticmethod
    def _heads(group: pa.Table) -> np.ndarray:
        k = group.column("k").to_numpy()
        return np.r_[True, k[1:] != k[:-1]]

    def add(self, group: pa.Table) -> None:
        """Count what the pairs share in one slice."""
        if not self.pairs.any():
            return
        n, lists = len(self.k), group.column("shingles").combine_chunks()
        flat, owner = lists.flatten().to_numpy(), np.repeat(np.cumsum(self._heads(group)) - 1, np.diff(lists.offsets.to_numpy()))
        order = np.argsort(flat, kind="stable")  # equal shingles side by side, their owners in order
        flat, owner = flat[order], owner[order]
        heads = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]][: len(flat)])
        held = np.diff(np.r_[heads, len(flat)])
        heads, held = heads[held > 1], held[held > 1]
        if not len(heads):
            return
        # Shingles of the very same vertices are one column that weighs as many.
        marks = mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        at = np.arange(held.sum()) - np.repeat(np.cumsum(held) - held - heads, held)
        with np.errstate(over="ignore"):
            same = np.add.reduceat(marks[owner[at]], np.cumsum(held) - held)
        _, first, weight = np.unique(same, return_index=True, return_counts=True)
        heads, held = heads[first], held[first]
        at = np.arange(held.sum()) - np.repeat(np.cumsum(held) - held - heads, held)
        column, vertex = np.repeat(np.arange(len(heads)), held), owner[at]
        own = np.bincount(vertex, minlength=n)
        # One by one a pair costs its columns, at some 8 ns each; in products all pairs cost all columns, at some 0.1 ns.
        if 8 * float((self.pairs @ own.astype(np.float32)).sum()) > 0.1 * n * n * len(heads):
            self._by_products(column, vertex, weight)
        else:
            self._one_by_one(column, vertex, weight, own)

    def _by_products(self, column: np.ndarray, vertex: np.ndarray, weight: np.ndarray) -> None:
        for start in range(0, len(weight), COLUMNS):  # ``column`` is sorted
            x, y = np.searchsorted(column, [start, start + COLUMNS])
            w = weight[start:start + COLUMNS]
            has = np.zeros((len(self.k), len(w)), dtype=np.float32)
            has[vertex[x:y], column[x:y] - start] = 1
            self.common += ((has * w.astype(np.float32)) @ has.T).astype(np.int32)  # below 2^24, so exact

    def _one_by_one(self, column: np.ndarray, vertex: np.ndarray, weight: np.ndarray, own: np.ndarray) -> None:
        column = column[np.argsort(vertex, kind="stable")]
        first, mark = np.r_[0, np.cumsum(own)], np.zeros(len(weight), dtype=np.int64)
        for i in np.flatnonzero(self.pairs.any(axis=1)):
            js = np.flatnonzero(self.pairs[i])
            mine = column[first[i]:first[i + 1]]
            mark[mine] = weight[mine]
            stop = np.cumsum(own[js])
            at = np.arange(stop[-1]) - np.repeat(stop - own[js] - first[js], own[js])
            upto = np.r_[0, np.cumsum(mark[column[at]])]
            self.common[i, js] += (upto[stop] - upto[stop - own[js]]).astype(np.int32)
            mark[mine] = 0

    def found(self) -> Iterator[pa.RecordBatch]:
        """(k, root, n_links) of the vertices with a link."""
        n, size = len(self.k), self.size
        links, parent = np.zeros(n, dtype=np.int64), np.arange(n)
        for i in np.flatnonzero(self.pairs.any(axis=1)):
            js = np.flatnonzero(self.pairs[i])
            common = self.common[i, js]
            hit = js[common >= SIMILARITY * (size[i] + size[js] - common) - 1e-9]
            links[i] += len(hit)
            links[hit] += 1
            for j in hit:
                x, y = _root(parent, i), _root(parent, j)
                parent[max(x, y)] = min(x, y)
        some = np.flatnonzero(links)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(self.k[some]), pa.array(self.k[[_root(parent, i) for i in some]]), pa.array(links[some])], names=["k", "root", "n_links"])


def _judged(rows: DataFrame) -> DataFrame:
    """(k, root, n_links): exact links found in each block, with a spanning forest's root."""

    def judge(parts):
        block = None
        for g in _groups(parts, [*_BLOCK, "slice"]):
            if block is None or block.key != [g.column(c)[0] for c in _BLOCK]:
                if block is not None:
                    yield from block.found()
                block = _Block(g)
            block.add(g)
        if block is not None:
            yield from block.found()

    return _by_block(rows, "slice", "k", "cut").mapInArrow(judge, "k long, root long, n_links long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): root is the smallest node of its component.

    Alternating star contraction: every round is a grouped minimum and a join on
    it, on a table of at most as many rows as there are edges.
    """
    both = lambda e: e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    total = lambda e: e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    edges = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().checkpoint()
    before = total(edges)
    while True:
        near = both(edges)
        low = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = near.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*").where("u != v").distinct()
        edges = small.checkpoint()
        after = total(edges)
        if after == before:
            break
        before = after
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))


def _few(df: DataFrame) -> bool:
    return df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def linked_vertices(texts: DataFrame) -> DataFrame:
    """(k, root, n_links) of the vertices with a link; ``texts``: (k, id, text), many rows a vertex."""
    checkpoint_dir(texts.sparkSession)
    vertices = _vertices(texts).checkpoint()
    members = buckets(vertices)
    own = members.groupBy("k").agg(F.collect_list("bucket").alias("buckets"), F.collect_list("size").alias("sizes")).checkpoint()
    each = own.select("k", "buckets", F.explode(F.arrays_zip("buckets", "sizes")).alias("m")).select("k", "buckets", F.col("m.buckets").alias("bucket"), F.col("m.sizes").alias("size"))
    left = _with_partner(_blocked(each.join(vertices, "k"))).checkpoint()

    need = left.groupBy("k").agg(F.max("slices").alias("_cuts")).join(texts.groupBy("k").agg(F.min("id").alias("id")), "k")
    need = need.select(F.col("k").alias("_k"), F.col("id").alias("_id"), "_cuts").checkpoint()
    need = F.broadcast(need) if _few(need) else need

    def collect(parts):
        for part in parts:
            for b in slices(part):
                upto, s = shingle_hashes(texts_of(b))
                lists, offsets, cut, row = [], [0], [], []
                for i, cuts in enumerate(b.column("_cuts").to_pylist()):
                    held = np.unique(s[upto[i]:upto[i + 1]])
                    lists.append(held)
                    edges = np.arange(1, cuts, dtype=np.uint64) << np.uint64(64 - cuts.bit_length() + 1) if cuts > 1 else np.empty(0, np.uint64)
                    offsets.extend(offsets[-1] + np.r_[np.searchsorted(held, edges), len(held)])
                    cut.extend(range(cuts))
                    row.extend([i] * cuts)
                size = pa.array(np.array([len(x) for x in lists], dtype=np.int64)[row])
                shingles = pa.ListArray.from_arrays(pa.array(np.array(offsets, dtype=np.int32)), pa.array(np.concatenate(lists).view(np.int64)))
                yield pa.RecordBatch.from_arrays([b.column("k").take(pa.array(row)), b.column("_cuts").take(pa.array(row)), pa.array(cut, pa.int64()), size, shingles], names=["k", "cuts", "cut", "size", "shingles"])

    wanted = texts.join(need, (F.col("k") == F.col("_k")) & (F.col("id") == F.col("_id"))).select("k", "text", "_cuts")
    sets = wanted.mapInArrow(collect, "k long, cuts long, cut long, size long, shingles array<long>").repartition("k").dropDuplicates(["k", "cut"])
    # A vertex is cut as finely as its largest block asks for; the others take several cuts as one slice.
    rows = left.join(own.select("k", "buckets"), "k").join(sets, "k").withColumn("slice", F.expr("cut * slices div cuts"))
    judged = _judged(rows.withColumn("buckets", F.when(F.col("cut") == 0, F.col("buckets"))).drop("slices", "cuts")).checkpoint()
    classes = components(judged.select(F.col("k").alias("u"), F.col("root").alias("v")))
    links = judged.groupBy("k").agg(F.sum("n_links").alias("n_links"))
    return links.join(classes.withColumnRenamed("node", "k"), "k", "left").select("k", F.coalesce("root", "k").alias("root"), "n_links")


def _texts(docs: DataFrame, *more) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.xxhash64(text).alias("k"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), text.alias("text"), *more)


def classes_of(docs: DataFrame) -> DataFrame:
    """(k, class_key, class_id, n_links, n_copies) for every distinct text of ``docs``."""
    texts = _texts(docs)
    linked = linked_vertices(texts).checkpoint()
    copies = texts.groupBy("k").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n_copies"))
    every = copies.join(linked, "k", "left").withColumn("class_key", F.coalesce("root", "k"))
    first = every.where("root is not null").groupBy("class_key").agg(F.min("id").alias("first"))
    every = every.join(first, "class_key", "left").withColumn("first", F.coalesce("first", "id"))
    return every.select("k", "class_key", F.nullif("first", F.lit(NO_ID)).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "n_copies")


def join_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, n_links, n_copies), one row per row of ``docs``.

    ``n_links`` counts the different texts linked to this one, ``n_copies`` the rows with this very text.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("k"))
    return keyed.join(classes_of(docs), "k").select("doc_id", "class_id", "n_links", "n_copies")


def first_of_each(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each class, with all its columns: that of the smallest doc_id.

    Rows without an id come last; of several rows left in a class the one with
    the smallest text hash stays, of repeated rows any one.
    """
    names = docs.columns
    best = classes_of(docs).select("k", "class_key", "class_id").checkpoint()
    # The vertex that holds the class's first id; a class without ids keeps its smallest vertex.
    ids = _texts(docs).groupBy("k").agg(F.min("id").alias("id")).join(best, "k")
    pick = ids.where(F.col("id") == F.coalesce("class_id", F.lit(NO_ID))).groupBy("class_key").agg(F.min("k").alias("k"), F.min("id").alias("id")).select(F.col("k").alias("_pk"), F.col("id").alias("_pid")).checkpoint()
    pick = F.broadcast(pick) if _few(pick) else pick
    d = docs.select(F.struct(*[F.col(c) for c in names]).alias("_row"))
    d = d.withColumn("_k", F.xxhash64(F.coalesce(F.col("_row.text"), F.lit("")))).withColumn("_i", F.coalesce(F.col("_row.doc_id").cast("long"), F.lit(NO_ID)))
    kept = d.join(pick, (F.col("_k") == F.col("_pk")) & (F.col("_i") == F.col("_pid"))).dropDuplicates(["_k"])
    return kept.select(*[F.col("_row").getField(c).alias(c) for c in names])
