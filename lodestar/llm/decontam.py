"""Benchmark decontamination by SimHash over item-sized windows, in SQL functions only.

Texts are lower-cased runs of letters and digits; a shingle is five words (an
item of fewer words is one shingle of all of them).

1. A window as long as an item is laid wherever enough of its shingles are
   shingles of items of that length. A window with ``m`` shingles and an item with
   as many reach a similarity of 0.8 only with ``2 * m * 0.8 / 1.8`` shingles in
   common, in whatever order they stand; the windows with that many hits are read
   off the sorted places of the hits. No other window can be similar, so its
   fingerprint is never needed.
2. A window's 64-bit SimHash, weighted by how often a shingle occurs in it, is
   looked up in an index of the items' fingerprints: eight blocks of eight bits,
   each entered under every value within two bits. Two fingerprints that differ
   in at most ``RADIUS`` = 23 bits agree within two bits in some block
   (8 * 3 = 24), so the lookup misses none; the distance itself is then tested.
3. Pairs within the radius are verified by the exact weighted Jaccard similarity
   of their shingles (occurrences as weights): ``MIN_SIMILARITY`` = 0.8 or more.

Null and empty texts have no words and match nothing; so do items without words.
Rows with equal doc_id and text are looked at once, and a finding holds for each
of them. Of an item's windows in a document the most similar one is told, of
equal ones the first. Documents of any length are read whole. Empty tables give
empty results. Further columns never clash: rows are carried in a struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.session import checkpoint_dir

SHINGLE = 5
MIN_SIMILARITY = 0.8
BLOCKS, BLOCK_BITS, BLOCK_RADIUS = 8, 8, 2
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
#: The items' shingles (and the windows found) are joined by broadcast up to so many rows, else by a shuffle.
BROADCAST_ROWS = 250_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def shingles(words: Column, n: int = SHINGLE) -> Column:
    """Hash of every run of ``n`` words; an array column must be passed, not an expression."""
    size = F.size(words)
    return F.when(size >= n, F.transform(F.sequence(F.lit(0), size - n), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(n)]))).otherwise(F.array().cast("array<bigint>"))


def simhash(hashes: Column) -> Column:
    """64-bit fingerprint: each bit is the majority over the shingles, with repetitions."""
    half = F.size(hashes) / 2
    ones = F.transform(F.sequence(F.lit(63), F.lit(0), F.lit(-1)), lambda b: F.aggregate(hashes, F.lit(0), lambda a, h: a + F.call_function("shiftright", h, b).bitwiseAND(F.lit(1)).cast("int")))
    return F.aggregate(ones, F.lit(0).cast("long"), lambda acc, c: F.shiftleft(acc, 1).bitwiseOR(F.when(c > half, F.lit(1)).otherwise(F.lit(0)).cast("long")))


def weighted_jaccard(a: Column, b: Column) -> Column:
    """Sum of minima over sum of maxima of the occurrence counts."""
    def count(xs, x):
        return F.size(xs) - F.size(F.array_remove(xs, x))

    common = F.aggregate(F.array_intersect(a, b), F.lit(0), lambda acc, x: acc + F.least(count(a, x), count(b, x)))
    return common / (F.size(a) + F.size(b) - common)


def block_values(fingerprint: Column) -> Column:
    return F.transform(F.array(*[F.lit(i) for i in range(BLOCKS)]), lambda i: F.struct(i.alias("block"), F.call_function("shiftrightunsigned", fingerprint, i * BLOCK_BITS).bitwiseAND(F.lit(2**BLOCK_BITS - 1)).cast("int").alias("bits")))


def _flips() -> list[int]:
    """All masks of at most ``BLOCK_RADIUS`` bits in a block."""
    return [m for m in range(2**BLOCK_BITS) if m.bit_count() <= BLOCK_RADIUS]


def items_of(benchmark: DataFrame) -> DataFrame:
    """(item_id, n, length, shingles, fingerprint) of the items with words; ``length`` is the words in a shingle."""
    d = benchmark.select("item_id", words_of(F.col("text")).alias("w")).where(F.size("w") > 0).withColumn("n", F.size("w"))
    short = F.array(F.xxhash64(*[F.coalesce(F.get("w", F.lit(k)), F.lit("")) for k in range(SHINGLE)]))
    d = d.withColumn("length", F.least("n", F.lit(SHINGLE))).withColumn("shingles", F.when(F.col("n") < SHINGLE, short).otherwise(shingles(F.col("w"))))
    return d.drop("w").withColumn("fingerprint", simhash(F.col("shingles")))


def _grams(words: Column, length: int) -> Column:
    """Shingles of ``length`` words, hashed as ``items_of`` hashes them."""
    if length == SHINGLE:
        return shingles(words)
    return F.when(F.size(words) >= length, F.transform(F.sequence(F.lit(0), F.size(words) - length), lambda i: F.xxhash64(*[F.get(words, i + k) if k < length else F.lit("") for k in range(SHINGLE)]))).otherwise(F.array().cast("array<bigint>"))


def window_starts(at: Column, size: Column, n: Column, length: Column) -> Column:
    """Starts of the windows of ``n`` words that hold enough hits; ``at``: sorted places of the hits in a text of ``size`` words.

    A text shorter than the item is one window.
    """
    m, own = n - length + 1, F.least(n, size) - length + 1
    need = F.greatest(F.lit(1), F.ceil(MIN_SIMILARITY * (m + own) / (1 + MIN_SIMILARITY) - F.lit(1e-9))).cast("int")
    last = size - n

    def run(p, k):
        """The windows whose first hit may be ``p``: they reach the hit that makes up the number."""
        lo, hi = F.greatest(F.lit(0), F.get(at, k + need - 1) - m + 1), F.least(p, last)
        return F.when(F.get(at, k + need - 1).isNotNull() & (lo <= hi), F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))

    whole = F.when(F.size(at) >= need, F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))
    return F.when(last <= 0, whole).otherwise(F.array_distinct(F.flatten(F.transform(at, run))))


def _small(df: DataFrame) -> bool:
    return df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, start_word, n_words, hamming, similarity): the best window of each item found in each row of ``docs``."""
    spark = docs.sparkSession
    checkpoint_dir(spark)
    items = items_of(benchmark).checkpoint()
    lengths = sorted(r[0] for r in items.select("length").distinct().collect())  # at most five
    anchors = items.select("n", "length", F.explode("shingles").alias("h")).distinct()
    anchors = F.broadcast(anchors) if _small(anchors) else anchors
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    words = rows.select("doc_id", "th", words_of(F.col("text")).alias("w")).withColumn("size", F.size("w"))
    hits = None
    for length in lengths:
        grams = words.select("doc_id", "th", "size", F.posexplode(_grams(F.col("w"), length)).alias("pos", "h"))
        found = grams.join(anchors.where(F.col("length") == length), "h").select("doc_id", "th", "size", "n", "length", "pos")
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        return spark.createDataFrame([], "doc_id long, item_id long, start_word int, n_words int, hamming int, similarity double")
    # the places of a document's hits: as many as its words at most
    hit = hits.groupBy("doc_id", "th", "size", "n", "length").agg(F.sort_array(F.collect_set("pos")).alias("at"))
    starts = hit.withColumn("starts", window_starts(F.col("at"), F.col("size"), F.col("n"), F.col("length"))).where(F.size("starts") > 0)
    places = starts.groupBy("doc_id", "th").agg(F.flatten(F.collect_list(F.transform("starts", lambda x: F.struct(x.alias("start"), F.col("n").alias("n"))))).alias("places")).checkpoint()
    side = places.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), "places")
    side = F.broadcast(side) if _small(places) else side
    held = rows.join(side, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th"))).select("doc_id", "th", "text", "places").distinct()
    held = held.select("doc_id", "th", "places", words_of(F.col("text")).alias("w"))
    # The shingles of a window are a slice of the document's.
    windows = None
    for length in lengths:
        d = held.select("doc_id", "th", F.filter("places", lambda p: F.least(p["n"], F.lit(SHINGLE)) == length).alias("places"), _grams(F.col("w"), length).alias("g")).where(F.size("places") > 0)
        cut = F.transform("places", lambda p: F.struct(p["start"].alias("start"), p["n"].alias("n"), F.slice(F.col("g"), p["start"] + 1, p["n"] - length + 1).alias("shingles")))
        d = d.select("doc_id", "th", F.inline(cut))
        windows = d if windows is None else windows.unionByName(d)
    windows = windows.withColumn("fingerprint", simhash(F.col("shingles"))).checkpoint()
    probes = windows.select("doc_id", "th", "start", "n", "fingerprint", F.inline(block_values(F.col("fingerprint"))))
    index = (items.select("item_id", "n", F.col("fingerprint").alias("item_fingerprint"), F.inline(block_values(F.col("fingerprint"))))
             .withColumn("flip", F.explode(F.array(*[F.lit(m) for m in _flips()]))).withColumn("bits", F.col("bits").bitwiseXOR(F.col("flip"))).drop("flip"))
    near = (probes.join(index, ["n", "block", "bits"])
            .withColumn("hamming", F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_fingerprint"))))
            .where(F.col("hamming") <= RADIUS).select("doc_id", "th", "start", "n", "item_id", "hamming").distinct())
    w = windows.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), F.col("start").alias("_start"), F.col("n").alias("_n"), F.col("shingles").alias("window_shingles"))
    paired = near.join(w, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")) & (F.col("start") == F.col("_start")) & (F.col("n") == F.col("_n")))
    paired = paired.join(items.select("item_id", "shingles"), "item_id").withColumn("similarity", weighted_jaccard(F.col("window_shingles"), F.col("shingles")))
    best = F.max(F.struct("similarity", (-F.col("start")).alias("s"), "n", "hamming"))
    return (paired.where(F.col("similarity") >= MIN_SIMILARITY).groupBy("doc_id", "th", "item_id").agg(best.alias("b"))
            .select("doc_id", "item_id", (-F.col("b.s")).alias("start_word"), F.col("b.n").alias("n_words"), "b.hamming", "b.similarity", "th"))


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns."""
    found = leaks(docs, benchmark).select(F.col("doc_id").alias("_id"), F.col("th").alias("_th")).distinct().checkpoint()
    side = F.broadcast(found) if _small(found) else found
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(c) for c in names]).alias("_row"))
    key = F.xxhash64(F.coalesce(F.col("_row.text"), F.lit("")))
    clean = rows.join(side, F.col("_row.doc_id").eqNullSafe(F.col("_id")) & (key == F.col("_th")), "left_anti")
    return clean.select(*[F.col("_row").getField(c).alias(c) for c in names])
