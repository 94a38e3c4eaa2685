"""Hybrid retrieval over a table of queries: BM25 top-k, exact cosine top-k, RRF fusion,
enrichment, rerank/fallback ranking and the ranking log.

Scale notes
* BM25: documents are dealt out by id, tokenised once and kept as counts of the
  query terms. Up to a measured number of query terms, each partition multiplies its
  counts with the terms' weights in tiles and sends at most k rows per query; beyond
  it postings and weights are joined. Counts of ids that repeat are put together
  first, as the joins do. A hot term is no hot task.
* Vector top-k: the corpus stays partitioned; each partition scores the query
  vectors in tiles and emits at most k rows per query, ties cut by id; two
  levels of per-query top-k merge the partial lists. Queries are broadcast after
  a check of their measured size; larger query tables meet the corpus in cogroups.
* Per-query ranks are windows partitioned by ``query_id`` on pools bounded by k.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions.vocab import (FEATURE_COLS, MIN_FUSED_POOL, MISSING_RANK, POOL_PER_RETRIEVER,
                                      RRF_K)

FILTER_COLUMNS = ["max_rent", "layout", "max_walk_min", "pet_ok", "max_age"]
BM25_K1 = 1.2
BM25_B = 0.75
TOKEN_PATTERN = r"[\p{L}\p{N}]+"
# Han, Hiragana and Katakana with the long-vowel mark, which belongs to no script of its own
CJK_PATTERN = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}ー]+"
# full-width forms of the printable ASCII characters
WIDE = "".join(chr(c + 0xFEE0) for c in range(0x21, 0x7F))
NARROW = "".join(chr(c) for c in range(0x21, 0x7F))
# CJK scripts and full-width forms lie above this point: texts without such characters need no folding and no bigrams
EASTERN = r"[\x{2E80}-\x{10FFFF}]"
RANK_DECIMALS = 9  # scores are rounded before ranking so engines agree on ties
MAX_BROADCAST_QUERY_BYTES = 64 * 1024 * 1024
MAX_BROADCAST_TERMS = 500_000  # (query, term) rows; above it they meet the postings in a shuffle


def search_documents(cleaned: DataFrame) -> DataFrame:
    """SRC-04: filterable {rent, walk_min, age_years, layout, pet_ok}, searchable {title, description, layout}.

    area_m2 rides along for candidate enrichment."""
    return cleaned.select(
        "property_id", "title", "description", "layout", "rent", "walk_min", "age_years", "pet_ok", "area_m2",
        F.concat_ws(" ", "title", "description", "layout").alias("searchable_text"))


def tokenize(text: Column) -> Column:
    """Lower-cased runs of letters and digits of any script, full-width forms folded to ASCII;
    runs of CJK characters become overlapping bigrams (a single one stays)."""
    return F.when(text.rlike(EASTERN), _tokens_folded(text)).otherwise(F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), 0))


def _tokens_folded(text: Column) -> Column:
    folded = F.lower(F.translate(text, WIDE, NARROW))
    words = F.regexp_extract_all(F.regexp_replace(folded, CJK_PATTERN, " "), F.lit(TOKEN_PATTERN), 0)
    runs = F.regexp_extract_all(folded, F.lit(CJK_PATTERN), 0)
    bigrams = F.flatten(F.transform(runs, lambda r: F.when(
        F.length(r) < 2, F.array(r)).otherwise(
        F.transform(F.sequence(F.lit(1), F.length(r) - 1), lambda i: F.substring(r, i, 2)))))
    return F.concat(words, bigrams)


def facet_predicate(listing_prefix: str = "", query_prefix: str = "") -> Column:
    """PRJ-02: five optional constraints; a null constraint accepts everything.

    A listing value that is null fails any constraint that is set.
    """
    p, q = listing_prefix, query_prefix

    def c(name):
        return F.col(f"{q}{name}")

    def lv(name):
        return F.col(f"{p}{name}")
    parts = [
        c("max_rent").isNull() | (lv("rent") <= c("max_rent")),
        c("layout").isNull() | (lv("layout") == c("layout")),
        c("max_walk_min").isNull() | (lv("walk_min") <= c("max_walk_min")),
        c("pet_ok").isNull() | (lv("pet_ok") == c("pet_ok")),
        c("max_age").isNull() | (lv("age_years") <= c("max_age")),
    ]
    out = parts[0]
    for x in parts[1:]:
        out = out & x
    return F.coalesce(out, F.lit(False))


def normalize_filters(queries: DataFrame) -> DataFrame:
    """Q-3: an empty layout means no constraint (both retrievers)."""
    return queries.withColumn("layout", F.when(F.trim(F.col("layout")) == "", None).otherwise(F.col("layout")))


def facet_filter(candidates: DataFrame, listings: DataFrame, queries: DataFrame) -> DataFrame:
    """PRJ-02 / JOIN-05: candidate (query_id, property_id) pairs that pass their query's filters.

    Left join to listings: a candidate without a listing survives only when
    its query sets no filter.
    """
    lcols = ["rent", "layout", "walk_min", "pet_ok", "age_years"]
    facets = listings.select("property_id", *[F.col(c).alias(f"_l_{c}") for c in lcols])
    f = normalize_filters(queries).select("query_id", *[F.col(c).alias(f"_q_{c}") for c in FILTER_COLUMNS])
    j = candidates.join(facets, "property_id", "left").join(f, "query_id", "left")
    return j.filter(facet_predicate("_l_", "_q_")).drop(*[f"_l_{c}" for c in lcols],
                                                         *[f"_q_{c}" for c in FILTER_COLUMNS])


# ---------------------------------------------------------------- BM25 (RET-01)
def spread_by_id(docs: DataFrame) -> DataFrame:
    """Listings dealt out by id, in a number of parts that isn't merged back: what comes after is
    work on every token, and a listing's terms, scores and facets then meet without a further shuffle."""
    spark = docs.sparkSession
    parts = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return docs.repartition(parts, "property_id")


def small_side(side: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """``side`` marked for a broadcast if the query terms it comes from (``of``) are few enough, by their measured number."""
    return F.broadcast(side) if (of if of is not None else side).count() <= MAX_BROADCAST_TERMS else side


def query_terms(queries: DataFrame) -> DataFrame:
    """(query_id, term): a query's terms are a set."""
    return queries.select("query_id", F.explode(F.array_distinct(tokenize(F.col("query_text")))).alias("term"))


def bm25_scores(docs: DataFrame, queries: DataFrame, k1: float = BM25_K1, b: float = BM25_B) -> DataFrame:
    """(query_id, property_id, bm25) for every document sharing a term with the query.

    idf = ln(1 + (N - df + 0.5) / (df + 0.5)); term score = idf * tf * (k1 + 1) /
    (tf + k1 * (1 - b + b * dl / avgdl)); query terms are a set.
    """
    found = _counted(docs, queries, k1, b, [])
    if found is None:
        return _joined_scores(docs, queries, k1, b)
    counts, weights = found
    side = docs.sparkSession.sparkContext.broadcast(weights)

    def score(batches):
        for batch in batches:
            ids = batch.column("property_id")
            for first, rows, scores in _tiles(batch, side.value):
                q, r = np.nonzero(scores)
                yield pa.RecordBatch.from_arrays([pa.array(side.value.ids[first + q], pa.string()), ids.take(pa.array(rows[r])), pa.array(scores[q, r])], ["query_id", "property_id", "bm25"])
    return counts.mapInArrow(score, "query_id string, property_id string, bm25 double")


def _joined_scores(docs: DataFrame, queries: DataFrame, k1: float, b: float) -> DataFrame:
    """The scores by joins of postings and weights: for any number of query terms."""
    # tokenised once: the corpus size, the mean length and the postings all read it
    toks = spread_by_id(docs).select("property_id", tokenize(F.col("searchable_text")).alias("tokens")) \
        .persist(StorageLevel.MEMORY_AND_DISK)
    n_docs = toks.agg(F.count(F.lit(1))).scalar()
    avgdl = toks.agg(F.avg(F.size("tokens"))).scalar()
    qterms = query_terms(queries)
    vocab = small_side(qterms.select("term").distinct())
    hits = (toks.select("property_id", F.size("tokens").alias("dl"), F.explode("tokens").alias("term"))
            .join(vocab, "term", "left_semi"))
    tf = hits.groupBy("property_id", "dl", "term").agg(F.count(F.lit(1)).alias("tf"))
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(F.lit(1.0) + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weights = small_side(df.join(qterms, "term").select("query_id", "term", idf.alias("idf")), qterms)
    norm = F.col("tf") + k1 * (F.lit(1.0 - b) + b * F.col("dl") / avgdl)
    scored = tf.join(weights, "term").select("query_id", "property_id", (F.col("idf") * F.col("tf") * (k1 + 1) / norm).alias("s"))
    return scored.groupBy("query_id", "property_id").agg(F.sum("s").alias("bm25"))


COUNT_ROWS = 1024         # listings whose tokens are counted at a time
TILE_CELLS = 1024 * 1024  # cells of a tile of listings by terms, and of terms by queries (8 MB)
NEAR = 2e-9               # scores at this distance may be equal after rounding to RANK_DECIMALS


@dataclass
class _Weights:
    """What every task knows of the queries: their ids, and (query, term, idf) by number in the order of queries."""

    ids: np.ndarray
    query: np.ndarray
    term: np.ndarray
    idf: np.ndarray
    n_terms: int
    avgdl: float
    k1: float
    b: float

    def tiles(self):
        """(first query, its terms, terms x queries) of as many queries as TILE_CELLS and QUERY_TILE let stand together."""
        starts = np.searchsorted(self.query, np.arange(len(self.ids) + 1))
        first = 0
        while first < len(self.ids):
            last, terms = first + 1, np.unique(self.term[starts[first]:starts[first + 1]])
            while last < len(self.ids) and last - first < QUERY_TILE:
                more = np.union1d(terms, self.term[starts[last]:starts[last + 1]])
                if len(more) * (last + 1 - first) > TILE_CELLS:
                    break
                last, terms = last + 1, more
            yield first, last, terms, slice(starts[first], starts[last])
            first = last


def _counted(docs: DataFrame, queries: DataFrame, k1: float, b: float, carry: list[str]) -> tuple[DataFrame, _Weights] | None:
    """Listings (property_id, dl, ``carry``) with their counts of the query terms, kept, and the terms' weights.

    None where there are no or too many query terms to send to every task, or a query's id is null or repeats.
    Where a listing's id is null or repeats, ``_by_id`` puts the counts together.
    """
    spark = docs.sparkSession
    qterms = query_terms(queries)
    ids = queries.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("query_id").alias("n_ids")).first()
    if not ids.n or ids.n != ids.n_ids or not 0 < qterms.count() <= MAX_BROADCAST_TERMS or ids.n > MAX_BROADCAST_TERMS:
        return None
    pairs = qterms.toPandas()  # of the number just checked
    terms, names = np.unique(pairs["term"].to_numpy().astype(object)), np.unique(pairs["query_id"].to_numpy().astype(object))
    toks = spread_by_id(docs).select("property_id", *carry, tokenize(F.col("searchable_text")).alias("tokens")).withColumn("dl", F.size("tokens"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in toks.drop("tokens").schema)
    counts = toks.mapInArrow(_count(spark.sparkContext.broadcast(terms)), f"{kept}, terms array<int>, tfs array<int>").persist(StorageLevel.MEMORY_AND_DISK)
    n_docs, avgdl = counts.agg(F.count(F.lit(1)), F.avg("dl")).first()
    again = counts.groupBy("property_id").count().filter((F.col("count") > 1) | F.col("property_id").isNull()).select("property_id")
    listings = counts
    if not again.isEmpty():
        counts = _by_id(counts, again, carry).persist(StorageLevel.MEMORY_AND_DISK)
    df = counts.select(F.explode("terms").alias("term")).groupBy("term").count().toPandas()  # at most the query terms
    idf = np.zeros(len(terms))
    idf[df["term"].to_numpy(dtype=np.int64)] = np.log(1.0 + (n_docs - df["count"].to_numpy(dtype=np.float64) + 0.5) / (df["count"].to_numpy(dtype=np.float64) + 0.5))
    query, term = np.searchsorted(names, pairs["query_id"].to_numpy().astype(object)), np.searchsorted(terms, pairs["term"].to_numpy().astype(object))
    order = np.lexsort((term, query))
    if counts is not listings:
        both = counts.filter("_again").drop("_again", *carry)
        counts = counts.filter(~F.col("_again")).drop("_again").unionByName(both.join(listings.select("property_id", *carry), "property_id", "left") if carry else both)
    return counts, _Weights(names, query[order], term[order], idf[term[order]], len(terms), avgdl or 1.0, k1, b)


def _by_id(counts: DataFrame, again: DataFrame, carry: list[str]) -> DataFrame:
    """``counts`` with one row for an id of ``again`` (marked ``_again``, without its ``carry``): as in the joins, a term counts
    once for each length of the id's texts. ``dl`` becomes a list beside ``terms``."""
    def met(how):
        return counts.join(again.withColumnRenamed("property_id", "_id"), F.col("property_id").eqNullSafe(F.col("_id")), how)

    once = met("left_anti").withColumns({"dl": F.array_repeat("dl", F.size("terms")), "_again": F.lit(False)})
    tf = met("left_semi").select("property_id", "dl", F.explode(F.arrays_zip("terms", "tfs")).alias("c"))
    tf = tf.groupBy("property_id", "dl", F.col("c.terms").alias("term")).agg(F.sum("c.tfs").cast("int").alias("tf"))
    both = tf.groupBy("property_id").agg(F.collect_list(F.struct("dl", "term", "tf")).alias("c"))  # the terms of an id's texts
    both = both.select("property_id", F.col("c.dl").alias("dl"), F.col("c.term").alias("terms"), F.col("c.tf").alias("tfs"), F.lit(True).alias("_again"))
    return once.unionByName(both, allowMissingColumns=True)


def _count(side):
    """Arrow body: tokens of a listing -> the numbers of the query terms among them and how often each occurs."""
    def count(batches):
        for batch in batches:
            for s in range(0, batch.num_rows, COUNT_ROWS):
                part = batch.slice(s, COUNT_ROWS)
                tokens = part.column("tokens")
                flat = tokens.flatten()
                code = pc.index_in(flat, value_set=pa.array(side.value, flat.type))
                row = np.repeat(np.arange(part.num_rows), pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False))
                hit = code.is_valid().to_numpy(zero_copy_only=False)
                found, tf = np.unique(row[hit] * len(side.value) + code.drop_null().to_numpy(), return_counts=True)
                at, term = np.divmod(found, len(side.value))
                ends = pa.array(np.searchsorted(at, np.arange(part.num_rows + 1)).astype(np.int32))
                rest = [n for n in part.schema.names if n != "tokens"]
                yield pa.RecordBatch.from_arrays([*[part.column(n) for n in rest], pa.ListArray.from_arrays(ends, pa.array(term.astype(np.int32))),
                                                  pa.ListArray.from_arrays(ends, pa.array(tf.astype(np.int32)))], [*rest, "terms", "tfs"])
    return count


def _tiles(batch, w: _Weights):
    """(first query, rows, queries x rows scores) of a batch of counted listings; a score is 0 where no term is shared."""
    terms, tfs = batch.column("terms"), batch.column("tfs")
    size = pc.list_value_length(terms).to_numpy(zero_copy_only=False)
    term, tf, row = terms.flatten().to_numpy(), tfs.flatten().to_numpy().astype(np.float64), np.repeat(np.arange(batch.num_rows), size)
    dl = batch.column("dl")
    dl = (dl.flatten() if pa.types.is_list(dl.type) else dl.take(pa.array(row))).to_numpy(zero_copy_only=False).astype(np.float64)
    part = tf * (w.k1 + 1) / (tf + w.k1 * ((1.0 - w.b) + w.b * dl / w.avgdl))
    place = np.empty(w.n_terms, dtype=np.int64)
    for first, last, mine, span in w.tiles():
        place[:] = -1
        place[mine] = np.arange(len(mine))
        weight = np.zeros((len(mine), last - first))
        weight[place[w.term[span]], w.query[span] - first] = w.idf[span]
        col = place[term]
        held = np.flatnonzero(col >= 0)
        rows, at = np.unique(row[held], return_inverse=True)
        step = max(1, TILE_CELLS // len(mine))
        for s in range(0, len(rows), step):
            lo, hi = np.searchsorted(at, [s, s + step])
            some = held[lo:hi]
            shape = min(step, len(rows) - s), len(mine)
            tile = np.bincount((at[lo:hi] - s) * len(mine) + col[some], weights=part[some], minlength=shape[0] * shape[1]).reshape(shape)
            yield first, rows[s:s + step], np.ascontiguousarray((tile @ weight).T)


class _Leaders:
    """Running best rows of each query by (rounded score desc, id), cut by the score as it is.

    Rows nearer than NEAR to the k-th are kept, of equal scores the k smallest
    ids, so the rank after rounding finds all it can need. Memory: about 4 k rows a query.
    """

    def __init__(self, n: int, k: int):
        self.k, self.limit = k, np.full(n, np.nextafter(0.0, 1.0))
        self.score, self.ids = [np.empty(0)] * n, [np.empty(0, dtype=object)] * n

    def add(self, i: int, scores: np.ndarray, ids: np.ndarray) -> None:
        near = np.flatnonzero(scores >= self.limit[i])
        if len(near):
            self.score[i], self.ids[i] = np.r_[self.score[i], scores[near]], np.r_[self.ids[i], ids[near]]
            if len(self.score[i]) > 4 * self.k:
                self.cut(i)

    def cut(self, i: int) -> None:
        d, p = self.score[i], self.ids[i]
        if len(d) <= self.k:
            return
        kth = np.partition(d, len(d) - self.k)[len(d) - self.k]
        self.limit[i] = max(kth - NEAR, self.limit[i])
        keep = list(np.flatnonzero(d > kth + NEAR))
        seen: dict[float, int] = {}
        for j in sorted(np.flatnonzero(np.abs(d - kth) <= NEAR), key=lambda j: (p[j] is not None, p[j] or "")):  # nulls first, as Spark has them
            seen[d[j]] = seen.get(d[j], 0) + 1
            if seen[d[j]] <= self.k:
                keep.append(j)
        self.score[i], self.ids[i] = d[keep], p[keep]


@dataclass
class _Filters:
    """The queries' filters as arrays: per listing column the bound or the code, and whether it is set."""

    bounds: dict
    layouts: list

    @staticmethod
    def of(queries: DataFrame, ids: np.ndarray) -> _Filters:
        q = {r["query_id"]: r for r in normalize_filters(queries).select("query_id", *FILTER_COLUMNS).collect()}  # as many as were checked
        layouts = sorted({r["layout"] for r in q.values()} - {None})
        bounds = {}
        for listing, name in zip(["rent", "walk_min", "age_years", "layout", "pet_ok"], ["max_rent", "max_walk_min", "max_age", "layout", "pet_ok"], strict=True):
            v = [q[i][name] for i in ids]
            code = [layouts.index(x) if x is not None else 0 for x in v] if name == "layout" else [int(x) if x is not None else 0 for x in v]
            bounds[listing] = np.array(code, dtype=np.int64), np.array([x is not None for x in v], dtype=bool)
        return _Filters(bounds, layouts)

    def listing(self, batch) -> dict:
        """The batch's facets as numbers, and where they are known."""
        out = {}
        for name in self.bounds:
            c = batch.column(name)
            if name == "layout":
                c = pc.index_in(c, value_set=pa.array(self.layouts, c.type))
            out[name] = pc.fill_null(c.cast(pa.int64()), 0).to_numpy(zero_copy_only=False), c.is_valid().to_numpy(zero_copy_only=False)
        return out

    def passing(self, listing: dict, rows: np.ndarray, i: int) -> np.ndarray:
        """``facet_predicate`` of query ``i`` for some rows of a batch."""
        ok = np.ones(len(rows), dtype=bool)
        for name, (bound, asked) in self.bounds.items():
            if asked[i]:
                value, known = listing[name][0][rows], listing[name][1][rows]
                ok &= known & ((value == bound[i]) if name in ("layout", "pet_ok") else (value <= bound[i]))
        return ok


def _lead(side, k: int):
    """Arrow body: the best listings of a partition for each query, among those that pass its filters."""
    def lead(batches):
        w, filters = side.value
        best = _Leaders(len(w.ids), k)
        for batch in batches:
            ids, listing = batch.column("property_id").to_numpy(zero_copy_only=False), filters.listing(batch)
            for first, rows, scores in _tiles(batch, w):
                for q in range(len(scores)):
                    some = np.flatnonzero(scores[q] >= best.limit[first + q])
                    some = some[filters.passing(listing, rows[some], first + q)]
                    best.add(first + q, scores[q][some], ids[rows[some]])
        for i, name in enumerate(w.ids):
            best.cut(i)
            if len(best.score[i]):
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(best.score[i]), pa.string()), pa.array(best.ids[i], pa.string()), pa.array(best.score[i])],
                                                 ["query_id", "property_id", "bm25"])
    return lead


FACETS = ["rent", "layout", "walk_min", "pet_ok", "age_years"]


def _whole_numbers(docs: DataFrame, queries: DataFrame) -> bool:
    """Whether facets and filters are of the types that ``_Filters`` compares."""
    types = dict(docs.dtypes) | {f"q {c}": t for c, t in queries.dtypes}
    whole = {"tinyint", "smallint", "int", "bigint", "boolean"}
    return types["layout"] == types["q layout"] == "string" and all(types[c] in whole for c in ["rent", "walk_min", "pet_ok", "age_years"] + [f"q {c}" for c in FILTER_COLUMNS if c != "layout"])


def bm25_topk(docs: DataFrame, queries: DataFrame, k: int = POOL_PER_RETRIEVER) -> DataFrame:
    """RET-01 + WIN-02: lexical top-k per query, facet filters applied before the cut.

    Blank ids are ranked (they take a position) and then dropped.
    """
    found = _counted(docs, queries, BM25_K1, BM25_B, FACETS) if _whole_numbers(docs, queries) else None
    if found is None:
        s = facet_filter(_joined_scores(docs, queries, BM25_K1, BM25_B), docs, queries)
    else:
        counts, weights = found
        side = docs.sparkSession.sparkContext.broadcast((weights, _Filters.of(queries, weights.ids)))
        s = counts.mapInArrow(_lead(side, k), "query_id string, property_id string, bm25 double")
    w = Window.partitionBy("query_id").orderBy(F.round("bm25", RANK_DECIMALS).desc(), F.col("property_id"))
    ranked = s.withColumn("lexical_rank", F.row_number().over(w).cast("bigint")).filter(F.col("lexical_rank") <= k)
    return ranked.filter(F.col("property_id").isNotNull() & (F.trim(F.col("property_id")) != ""))


# ----------------------------------------------------------- vectors (RET-02/03)
QUERY_TILE, ROW_TILE = 256, 4096


def _unit(rows) -> np.ndarray:
    m = np.stack(rows).astype(np.float64)
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)


class _Best:
    """Running top-k of a block of queries, ordered by (rounded distance, id).

    A row enters when its rounded distance is not above the k-th so far; the
    lists are cut only by the full order, so ties at the cut go by id whatever
    the partitioning. Memory: tiles of QUERY_TILE x ROW_TILE distances, and at
    most k + ROW_TILE rows a query before it is cut again.
    """

    def __init__(self, n: int, k: int):
        self.k, self.limit = k, np.full(n, np.inf)
        self.dist = [np.empty(0)] * n
        self.raw = [np.empty(0)] * n
        self.ids = [np.empty(0, dtype=object)] * n

    def add(self, first: int, raw: np.ndarray, ids: np.ndarray) -> None:
        dist = np.round(raw, RANK_DECIMALS)
        for q in range(dist.shape[0]):
            i = first + q
            near = np.flatnonzero(dist[q] <= self.limit[i])
            if not len(near):
                continue
            d, p, x = np.r_[self.dist[i], dist[q][near]], np.r_[self.ids[i], ids[near]], np.r_[self.raw[i], raw[q][near]]
            if len(d) > self.k:
                top = np.partition(d, self.k - 1)[self.k - 1]
                keep = np.flatnonzero(d <= top)
                order = keep[sorted(range(len(keep)), key=lambda j: (d[keep[j]], p[keep[j]]))][:self.k]
                d, p, x, self.limit[i] = d[order], p[order], x[order], top
            self.dist[i], self.ids[i], self.raw[i] = d, p, x


def _scan(qids: np.ndarray, qmat: np.ndarray, frames, k: int):
    best = _Best(len(qids), k)
    for pdf in frames:
        for s in range(0, len(pdf), ROW_TILE):
            part = pdf.iloc[s:s + ROW_TILE]
            rows, ids = _unit(part["embedding"].to_numpy()), part["property_id"].to_numpy().astype(object)
            for q in range(0, len(qids), QUERY_TILE):
                best.add(q, 1.0 - qmat[q:q + QUERY_TILE] @ rows.T, ids)
    for i, qid in enumerate(qids):
        if len(best.dist[i]):
            yield pd.DataFrame({"query_id": qid, "property_id": best.ids[i], "cosine_distance": best.raw[i], "_rounded": best.dist[i]})


def _meet(k: int):
    """Cogroup body: a block of queries against a chunk of vectors."""
    def meet(left, right):
        if len(left) and len(right):
            found = list(_scan(left["query_id"].to_numpy(), _unit(left["query_vector"].to_numpy()), [right], k))
            if found:
                return pd.concat(found, ignore_index=True)
        return pd.DataFrame({"query_id": pd.Series(dtype=str), "property_id": pd.Series(dtype=str), "cosine_distance": pd.Series(dtype=float), "_rounded": pd.Series(dtype=float)})
    return meet


def usable_vectors(df: DataFrame, vector: str, dim: int) -> DataFrame:
    """Rows whose vector has ``dim`` finite elements; VAL-06 reports the others."""
    v = F.col(vector)
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x))
    return df.filter(v.isNotNull() & (F.size(v) == dim) & ~odd)


def vector_topk(queries: DataFrame, corpus: DataFrame, k: int = POOL_PER_RETRIEVER) -> DataFrame:
    """RET-02 (no filters): exact cosine top-k per query over the whole corpus.

    ``queries``: (query_id, query_vector); ``corpus``: (property_id, embedding).
    Distances are rounded to RANK_DECIMALS; ties go to the smaller id. Rows of
    either side without an id, or whose vector is null, has a null or NaN or
    another length than the queries' longest, take no part.

    Queries of a measured size up to MAX_BROADCAST_QUERY_BYTES are broadcast and
    each corpus partition sends its own top-k. Beyond it, corpus chunks meet query
    blocks in cogroups. The partial lists are merged in two levels.
    """
    spark = corpus.sparkSession
    queries = queries.filter(F.col("query_id").isNotNull() & F.col("query_vector").isNotNull())
    n, dim = queries.agg(F.count(F.lit(1)), F.max(F.size("query_vector"))).first()
    result = "query_id string, property_id string, cosine_distance double"
    schema = f"{result}, _rounded double"
    if not n:
        return spark.createDataFrame([], result)
    queries = usable_vectors(queries, "query_vector", dim).select("query_id", "query_vector")
    rows = usable_vectors(corpus.filter(F.col("property_id").isNotNull()), "embedding", dim).select("property_id", "embedding")
    size = n * (8 * dim + 64)
    if size <= MAX_BROADCAST_QUERY_BYTES:
        pdf = queries.toPandas()  # of the size just checked
        if pdf.empty:
            return spark.createDataFrame([], result)
        side = spark.sparkContext.broadcast((pdf["query_id"].to_numpy(), _unit(pdf["query_vector"].to_numpy())))
        cand = rows.mapInPandas(lambda frames: _scan(*side.value, frames, k), schema)
    else:
        blocks, chunks = -(-size // (MAX_BROADCAST_QUERY_BYTES // 8)), max(1, rows.rdd.getNumPartitions())
        q = queries.withColumn("_b", F.pmod(F.xxhash64("query_id"), F.lit(blocks))).withColumn("_c", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
        r = rows.withColumn("_c", F.pmod(F.xxhash64("property_id"), F.lit(chunks)).cast("int")).withColumn("_b", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))

        cand = q.groupBy("_b", "_c").cogroup(r.groupBy("_b", "_c")).applyInPandas(_meet(k), schema)
    return _merged(cand, k)


def _merged(cand: DataFrame, k: int) -> DataFrame:
    """The k best of each query out of partial lists, in two levels."""
    order = [F.col("_rounded"), F.col("property_id")]
    first = Window.partitionBy("query_id", "_g").orderBy(*order)
    cand = cand.withColumn("_g", F.pmod(F.spark_partition_id(), F.lit(32))).withColumn("_r", F.row_number().over(first)).filter(F.col("_r") <= k)
    last = Window.partitionBy("query_id").orderBy(*order)
    return cand.withColumn("_r", F.row_number().over(last)).filter(F.col("_r") <= k).drop("_r", "_g", "_rounded")


def semantic_rank(hits: DataFrame, listings: DataFrame, queries: DataFrame) -> DataFrame:
    """JOIN-05 + WIN-01: post-filter the top-k hits (may return fewer), rank by distance,
    me5_score = 1 - distance (Q-7 fixed: a perfect match scores 1)."""
    kept = facet_filter(hits, listings, queries)
    w = Window.partitionBy("query_id").orderBy(F.round("cosine_distance", RANK_DECIMALS), F.col("property_id"))
    return (kept.withColumn("semantic_rank", F.row_number().over(w).cast("bigint"))
            .withColumn("me5_score", F.when(F.col("cosine_distance").isNull(), 0.0)
                        .otherwise(1.0 - F.col("cosine_distance"))))


def vector_topk_filtered(queries: DataFrame, qvecs: DataFrame, corpus: DataFrame, listings: DataFrame,
                         k: int = POOL_PER_RETRIEVER) -> DataFrame:
    """RET-02: top-k before facet filters, then the filters (post-filter)."""
    hits = vector_topk(qvecs, corpus, k)
    return semantic_rank(hits, listings, queries)


ANN_SAMPLE_ROWS = 8192   # vectors that the lists are fitted and the probes calibrated on
ANN_MAX_LISTS = 4096
ANN_CHUNK_ROWS = 20_000  # a longer list is searched in chunks of so many vectors
ANN_QUERY_BLOCK = 4096
ANN_RECALL = 0.9


@dataclass
class VectorLists:
    """An inverted file: unit centroids, and how many nearest lists a query probes."""

    centroids: np.ndarray
    n_probe: int


def fit_lists(corpus: DataFrame, dim: int, k: int = POOL_PER_RETRIEVER, recall: float = ANN_RECALL, seed: int = 7) -> VectorLists:
    """k-means lists and the number of probes, from at most ANN_SAMPLE_ROWS vectors (the first by id hash).

    The probes are the fewest for which 64 sampled vectors, searched in the
    sample, find ``recall`` of their exact neighbours at the same depth.
    """
    usable = usable_vectors(corpus, "embedding", dim)
    total = usable.count()
    x = _unit(usable.orderBy(F.xxhash64("property_id"), "property_id").limit(ANN_SAMPLE_ROWS).select("embedding").toPandas()["embedding"].to_numpy())
    rng = np.random.default_rng(seed)
    n = max(1, min(ANN_MAX_LISTS, int(total**0.5), len(x) // 4))
    c = x[rng.choice(len(x), n, replace=False)]
    for _ in range(10):
        at = (x @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, at, x)
        c = np.where(np.bincount(at, minlength=n)[:, None] > 0, sums, c)
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-300)
    at, probe = (x @ c.T).argmax(axis=1), x[rng.choice(len(x), min(64, len(x)), replace=False)]
    depth = max(1, min(len(x), max(10, -(-k * len(x) // total))))
    near = np.argsort(-(probe @ x.T), axis=1, kind="stable")[:, :depth]
    rank = np.empty((len(probe), n), dtype=np.int64)
    np.put_along_axis(rank, np.argsort(-(probe @ c.T), axis=1, kind="stable"), np.arange(n)[None, :], axis=1)
    needed = np.sort(np.take_along_axis(rank, at[near], axis=1).ravel()) + 1
    return VectorLists(c, int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)]))


def vector_topk_ann(queries: DataFrame, corpus: DataFrame, k: int = POOL_PER_RETRIEVER,
                    recall: float = ANN_RECALL, lists: VectorLists | None = None) -> DataFrame:
    """RET-03: approximate top-k by an inverted file; every vector is in its nearest list.

    A query is compared exactly with all vectors of the lists it probes. Long
    lists are cut in chunks and many queries in blocks, so no task holds a whole
    list; there is no distance or candidate cut. Unusable vectors as in vector_topk.
    """
    spark = corpus.sparkSession
    result = "query_id string, property_id string, cosine_distance double"
    queries = queries.filter(F.col("query_id").isNotNull() & F.col("query_vector").isNotNull())
    n, dim = queries.agg(F.count(F.lit(1)), F.max(F.size("query_vector"))).first()
    rows = usable_vectors(corpus.filter(F.col("property_id").isNotNull()), "embedding", dim or 0).select("property_id", "embedding")
    if not n or rows.isEmpty():
        return spark.createDataFrame([], result)
    lists = lists or fit_lists(rows, dim, k, recall)
    side = spark.sparkContext.broadcast(lists.centroids)  # at most ANN_MAX_LISTS vectors

    def place(frames):
        for pdf in frames:
            for s in range(0, len(pdf), ROW_TILE):
                part = pdf.iloc[s:s + ROW_TILE]
                yield part.assign(_list=(_unit(part["embedding"].to_numpy()) @ side.value.T).argmax(axis=1).astype("int32"))

    def probes(frames):
        for pdf in frames:
            if len(pdf):
                near = np.argsort(-(_unit(pdf["query_vector"].to_numpy()) @ side.value.T), axis=1, kind="stable")[:, :lists.n_probe]
                yield pdf.assign(_list=list(near.astype("int32")))

    blocks = -(-n // ANN_QUERY_BLOCK)
    placed = rows.mapInPandas(place, "property_id string, embedding array<double>, _list int")
    chunks = placed.groupBy("_list").agg(F.ceil(F.count(F.lit(1)) / ANN_CHUNK_ROWS).cast("int").alias("_chunks"))
    r = (placed.join(chunks, "_list").withColumn("_c", F.pmod(F.xxhash64("property_id"), F.col("_chunks")).cast("int")).drop("_chunks")
         .withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(int(blocks) - 1)))))
    q = usable_vectors(queries, "query_vector", dim).select("query_id", "query_vector").mapInPandas(probes, "query_id string, query_vector array<double>, _list array<int>")
    q = (q.withColumn("_list", F.explode("_list")).join(chunks, "_list").withColumn("_c", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1))).drop("_chunks")
         .withColumn("_b", F.pmod(F.xxhash64("query_id"), F.lit(int(blocks))).cast("int")))
    key = ["_list", "_c", "_b"]
    return _merged(q.groupBy(*key).cogroup(r.groupBy(*key)).applyInPandas(_meet(k), f"{result}, _rounded double"), k)


# ------------------------------------------------------------------ fusion (RET-04)
def ranked_lists_merge(lexical: DataFrame, semantic: DataFrame) -> DataFrame:
    """JOIN-11: one row per (query, listing) present in either list."""
    lex = lexical.select("query_id", "property_id", "lexical_rank",
                         F.lit(None).cast("bigint").alias("semantic_rank"), F.lit(None).cast("double").alias("me5_score"))
    sem = semantic.select("query_id", "property_id", F.lit(None).cast("bigint").alias("lexical_rank"),
                          "semantic_rank", "me5_score")
    return lex.unionByName(sem).groupBy("query_id", "property_id").agg(
        F.min("lexical_rank").alias("lexical_rank"), F.min("semantic_rank").alias("semantic_rank"),
        F.max("me5_score").alias("me5_score"))


def rrf_fuse(lexical: DataFrame, semantic: DataFrame, queries: DataFrame, k: int = RRF_K,
             min_pool: int = MIN_FUSED_POOL) -> DataFrame:
    """RET-04 + WIN-03 + TOP-02: RRF score, fused rank (ties: lexical list order, then
    semantic), keep the first max(top_k, 100) per query."""
    m = ranked_lists_merge(lexical, semantic)
    rrf = (F.coalesce(F.lit(1.0) / (F.lit(k) + F.col("lexical_rank")), F.lit(0.0))
           + F.coalesce(F.lit(1.0) / (F.lit(k) + F.col("semantic_rank")), F.lit(0.0)))
    m = m.withColumn("rrf_score", rrf)
    w = Window.partitionBy("query_id").orderBy(F.col("rrf_score").desc(), F.col("lexical_rank").asc_nulls_last(),
                                               F.col("semantic_rank").asc_nulls_last())
    pool = F.greatest(F.coalesce(F.col("top_k"), F.lit(0)), F.lit(min_pool))
    return (m.withColumn("rrf_rank", F.row_number().over(w).cast("bigint"))
            .join(queries.select("query_id", "top_k"), "query_id", "left")
            .filter(F.col("rrf_rank") <= pool).drop("top_k"))


def enrich_candidates(fused: DataFrame, listings: DataFrame, features: DataFrame) -> DataFrame:
    """JOIN-06 + JOIN-07: fused ids left join listings and the latest feature day.

    Missing ranks become 10000 and a missing me5 score 0.0; RRF order is kept
    as ``rrf_rank``. Listing features stay nullable (not zero-filled).
    """
    from lodestar.operators.features import latest_partition
    latest = latest_partition(features).select("property_id", "ctr", "fav_rate", "inquiry_rate")
    li = listings.select("property_id", "rent", "walk_min", "age_years", "area_m2")
    e = fused.join(li, "property_id", "left").join(latest, "property_id", "left")
    return e.select(
        "query_id", "property_id", "rrf_rank", "rrf_score",
        F.coalesce(F.col("lexical_rank"), F.lit(MISSING_RANK)).cast("bigint").alias("lexical_rank"),
        F.coalesce(F.col("semantic_rank"), F.lit(MISSING_RANK)).cast("bigint").alias("semantic_rank"),
        F.coalesce(F.col("me5_score"), F.lit(0.0)).alias("me5_score"),
        "rent", "walk_min", "age_years", "area_m2", "ctr", "fav_rate", "inquiry_rate")


def hybrid_candidates(docs: DataFrame, queries: DataFrame, qvecs: DataFrame, corpus: DataFrame,
                      features: DataFrame) -> DataFrame:
    """RET-05: lexical + semantic -> RRF pool -> enriched candidates (one job, all queries)."""
    lex = bm25_topk(docs, queries)
    sem = vector_topk_filtered(queries, qvecs, corpus, docs)
    fused = rrf_fuse(lex, sem, queries)
    return enrich_candidates(fused, docs, features)


def candidate_features(cands: DataFrame) -> DataFrame:
    """The 10-feature vector of each candidate (listing features null -> 0.0)."""
    from lodestar.operators.ltr import ranker_features
    return ranker_features(cands.withColumns({
        "rent": F.col("rent").cast("double"), "walk_min": F.col("walk_min").cast("double"),
        "age_years": F.col("age_years").cast("double"), "area_m2": F.col("area_m2").cast("double")}))


def final_rank_rerank(scored: DataFrame) -> DataFrame:
    """WIN-04: rank by model score desc, stable on the pool (RRF) order."""
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("rrf_rank"))
    return scored.withColumn("final_rank", F.row_number().over(w).cast("bigint")) \
        .withColumn("display_rank", F.col("final_rank"))


def final_rank_fallback(cands: DataFrame) -> DataFrame:
    """WIN-05: final_rank := lexical_rank value (10000 when absent); display order stable on RRF order."""
    w = Window.partitionBy("query_id").orderBy(F.col("lexical_rank"), F.col("rrf_rank"))
    return (cands.withColumn("final_rank", F.col("lexical_rank"))
            .withColumn("score", F.lit(None).cast("double"))
            .withColumn("display_rank", F.row_number().over(w).cast("bigint")))


def topk_results(ranked: DataFrame, queries: DataFrame) -> DataFrame:
    """TOP-01: the first top_k rows per query in display order."""
    return (ranked.join(queries.select("query_id", "top_k"), "query_id")
            .filter(F.col("display_rank") <= F.col("top_k")).drop("top_k"))


def linear_scorer(weights: dict[str, float] | None = None):
    """UDF-02 slot example: score = sum(w_i * feature_i) on the 10-feature vector (JVM-side)."""
    wts = weights or {"me5_score": 1.0, "ctr": 0.5, "lexical_rank": -0.001, "semantic_rank": -0.0005}

    listing = {"rent", "walk_min", "age_years", "area_m2", "ctr", "fav_rate", "inquiry_rate"}

    def feature(c):
        x = F.col(c).cast("double")
        return F.coalesce(x, F.lit(0.0)) if c in listing else x

    def score(cands: DataFrame) -> DataFrame:
        s = F.lit(0.0)
        for c in FEATURE_COLS:
            if c in wts:
                s = s + F.lit(wts[c]) * feature(c)
        return cands.withColumn("score", s)   # a projection: no join, no shuffle
    return score


def hybrid_search(cands: DataFrame, queries: DataFrame, reranker=None, model_path: str | None = None,
                  as_of: str | None = None):
    """RET-06: (ranking_log rows for the full pool, top_k results).

    With a reranker (DataFrame -> DataFrame adding ``score``) ranks by score;
    without one falls back to lexical rank. An empty pool yields no rows. The log's
    ``ts`` is ``as_of`` (UTC), or now where none is given.
    """
    if reranker is not None:
        ranked = final_rank_rerank(reranker(cands))
        path = F.lit(model_path)
    else:
        ranked = final_rank_fallback(cands)
        path = F.lit(None).cast("string")
    now = F.lit(as_of) if as_of else F.current_timestamp()
    log = emit_ranking_log(ranked.withColumn("model_path", path), now.cast("timestamp_ntz"))
    return log, topk_results(ranked, queries)


def emit_ranking_log(ranked: DataFrame, ts: Column | None = None) -> DataFrame:
    """SNK-06: one row per pool candidate, schema_version 2, nested nullable features."""
    feats = F.struct(
        *[F.col(c).cast("double").alias(c) for c in ["rent", "walk_min", "age_years", "area_m2",
                                                      "ctr", "fav_rate", "inquiry_rate"]],
        F.col("me5_score").cast("double").alias("me5_score"),
        F.col("lexical_rank").cast("double").alias("lexical_rank"),
        F.col("semantic_rank").cast("double").alias("semantic_rank"))
    return ranked.select(
        F.col("query_id").alias("request_id"),
        (ts if ts is not None else F.lit(None).cast("timestamp_ntz")).alias("ts"),
        "property_id", F.lit(2).cast("bigint").alias("schema_version"),
        "lexical_rank", "semantic_rank", "rrf_rank", F.col("final_rank").cast("bigint").alias("final_rank"),
        F.col("score").cast("double").alias("score"), "me5_score", feats.alias("features"),
        (F.col("model_path") if "model_path" in ranked.columns else F.lit(None).cast("string")).alias("model_path"))


def ordinality(ids: Column) -> Column:
    """JOIN-13 helper: ordered id array -> array of (property_id, pos) with pos = offset + 1."""
    return F.transform(ids, lambda x, i: F.struct(x.alias("property_id"), (i + 1).cast("bigint").alias("pos")))


# ------------------------------------------------------------- stored BM25 index
TERM_BUCKETS = 64
FILES_PER_BUCKET = 4


def term_bucket(term: Column, buckets: int = TERM_BUCKETS) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def build_bm25_index(docs: DataFrame, path: str, buckets: int = TERM_BUCKETS) -> None:
    """Tokenise the corpus once and store it for many query batches.

    ``{path}/postings``: (term_bucket, term, property_id, tf), partitioned by
    term_bucket and sorted by term inside files; ``{path}/docs``: (property_id,
    dl) plus the facet columns; ``{path}/stats``: one row (n_docs, avgdl).
    """
    toks = spread_by_id(docs).select("property_id", tokenize(F.col("searchable_text")).alias("tokens"),
                       "rent", "layout", "walk_min", "pet_ok", "age_years")
    from pyspark import StorageLevel
    toks = toks.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        postings = (toks.select("property_id", F.explode("tokens").alias("term"))
                    .groupBy("term", "property_id").agg(F.count(F.lit(1)).alias("tf"))
                    .withColumn("term_bucket", term_bucket(F.col("term"), buckets)))
        # parted by id as well, so that a term of every listing is no single task
        (postings.repartition("term_bucket", F.pmod(F.xxhash64("property_id"), F.lit(FILES_PER_BUCKET))).sortWithinPartitions("term_bucket", "term")
         .write.partitionBy("term_bucket").mode("errorifexists").parquet(f"{path}/postings"))
        dl = toks.select("property_id", F.size("tokens").alias("dl"), "rent", "layout", "walk_min", "pet_ok",
                         "age_years")
        dl.write.mode("errorifexists").parquet(f"{path}/docs")
        dl.agg(F.count(F.lit(1)).alias("n_docs"), F.avg("dl").alias("avgdl")) \
            .write.mode("errorifexists").parquet(f"{path}/stats")
    finally:
        toks.unpersist()


def bm25_search(spark, path: str, queries: DataFrame, k: int = POOL_PER_RETRIEVER,
                k1: float = BM25_K1, b: float = BM25_B, buckets: int = TERM_BUCKETS) -> DataFrame:
    """RET-01 over a stored index: only the term buckets of the batch's query terms are read
    (partition pruning on ``term_bucket``); same scores and ranks as ``bm25_topk``."""
    postings = spark.read.parquet(f"{path}/postings")
    docs = spark.read.parquet(f"{path}/docs")
    stats = spark.read.parquet(f"{path}/stats")
    n_docs = stats.select("n_docs").scalar()
    avgdl = stats.select("avgdl").scalar()
    qterms = queries.select("query_id", F.explode(F.array_distinct(tokenize(F.col("query_text")))).alias("term")) \
        .withColumn("term_bucket", term_bucket(F.col("term"), buckets))
    vocab = qterms.select("term_bucket", "term").distinct()
    # partition pruning: the batch's term buckets (at most ``buckets`` ints) become a static
    # partition filter, so the scan lists and reads only those postings folders
    needed = [r[0] for r in vocab.select("term_bucket").distinct().collect()]
    hits = postings.filter(F.col("term_bucket").isin(needed)).join(small_side(vocab), ["term_bucket", "term"], "left_semi")
    df = hits.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(F.lit(1.0) + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weights = small_side(df.join(qterms, "term").select("query_id", "term", idf.alias("idf")), qterms)
    norm = F.col("tf") + k1 * (F.lit(1.0 - b) + b * F.col("dl") / avgdl)
    # dealt out by listing once: lengths, scores and facets then meet without a shuffle of scored rows
    lengths = docs.select("property_id", "dl")
    scored = (spread_by_id(hits.select("property_id", "term", "tf")).join(lengths, "property_id").join(weights, "term")
              .select("query_id", "property_id", (F.col("idf") * F.col("tf") * (k1 + 1) / norm).alias("s"))
              .groupBy("query_id", "property_id").agg(F.sum("s").alias("bm25")))
    s = facet_filter(scored, docs, queries)
    w = Window.partitionBy("query_id").orderBy(F.round("bm25", RANK_DECIMALS).desc(), F.col("property_id"))
    return s.withColumn("lexical_rank", F.row_number().over(w).cast("bigint")).filter(F.col("lexical_rank") <= k)
