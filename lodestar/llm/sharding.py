"""Uniform sharding by a hypergeometric communication matrix (law ``rows``).

Every row gets a shard and a slot in it such that the shards' row counts differ
by at most one and each assignment of rows to slots is equally likely:

1. the rows' keys are written once to the checkpoint folder, which fixes their
   partition and position whatever is lost later;
2. for partition ``p`` the numbers of rows that it sends to each shard are one
   row of a random matrix with given margins (partition sizes, shard sizes),
   drawn by splitting the partitions in halves: at each half the shards' counts
   are multivariate hypergeometric. A task derives the matrix row of its own
   partitions from the partition sizes alone, so the matrix is never gathered;
3. rows are permuted inside their partition and dealt out by these counts;
4. rows are permuted again inside their shard. A shard is ordered in ranges of
   the permuting hash, so no task holds a whole shard.

Null doc_id, null or empty text (size 8), repeated rows and any further columns
are ordinary rows; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.session import checkpoint_dir

N_SHARDS = 24
SEED = 20240607
#: Rows in one sorted range of a shard.
RANGE_ROWS = 65536
#: The matrix is joined by broadcast up to so many bytes, else by a shuffle.
BROADCAST_BYTES = 8 << 20


def shard_sizes(n_rows: int, n_shards: int) -> np.ndarray:
    """Row counts at most one apart, adding up to ``n_rows``."""
    base, more = divmod(n_rows, n_shards)
    return np.array([base + (s < more) for s in range(n_shards)], dtype=np.int64)


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Of ``n`` draws without replacement, how many are good.

    numpy draws exactly below 10^9; beyond that the normal law of the same mean
    and variance, rounded into the support, is as good as its own floats.
    """
    lo, hi = max(0, n - bad), min(n, good)
    if lo == hi:
        return lo
    if good + bad < 10**9:
        return int(rng.hypergeometric(good, bad, n))
    total = good + bad
    mean = n * (good / total)
    var = mean * (bad / total) * ((total - n) / max(1, total - 1))
    return int(min(hi, max(lo, round(rng.normal(mean, var**0.5)))))


def matrix_row(upto: np.ndarray, sizes: np.ndarray, part: int, seed: int) -> np.ndarray:
    """How many rows partition ``part`` sends to each shard.

    ``upto[p]`` counts the rows before partition ``p``. The draw at a node of the
    halving tree is seeded by the node, so all partitions agree on it.
    """
    lo, hi, room = 0, len(upto) - 1, sizes.astype(object)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        rng = np.random.default_rng([seed, lo, hi])
        left, n, rest = [], int(upto[mid] - upto[lo]), int(upto[hi] - upto[lo])
        for r in room:
            rest -= int(r)
            x = _hypergeometric(rng, int(r), rest, n)
            left.append(x)
            n -= x
        left = np.array(left, dtype=object)
        lo, hi, room = (lo, mid, left) if part < mid else (mid, hi, room - left)
    return room.astype(np.int64)


def assign_shards(docs: DataFrame, n_shards: int = N_SHARDS, seed: int = SEED, payload: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, size, text_crc32, part, shard, slot, *payload), one row per row of ``docs``.

    ``size`` is the text's UTF-8 bytes plus 8, ``part`` the sending partition.
    """
    spark = docs.sparkSession
    checkpoint_dir(spark)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id"), (F.octet_length(text).cast("long") + F.lit(8)).alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        *[F.col(c).alias(f"_payload_{c}") for c in payload], F.monotonically_increasing_id().alias("_row"),
    ).checkpoint()
    rows = rows.withColumn("part", F.shiftright("_row", 33).cast("int"))
    counts = {r["part"]: r["n"] for r in rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}  # one number a partition
    n_parts = max(counts, default=0) + 1
    upto = np.zeros(n_parts + 1, dtype=np.int64)
    np.cumsum([counts.get(p, 0) for p in range(n_parts)], out=upto[1:])
    total = int(upto[-1])
    sizes = shard_sizes(total, n_shards)

    def cuts(frames):
        for pdf in frames:
            pdf["part"] = pdf["id"].astype("int32")
            pdf["cuts"] = [np.cumsum(matrix_row(upto, sizes, int(p), seed)) for p in pdf["part"]]
            yield pdf[["part", "cuts"]]

    matrix = spark.range(n_parts).mapInPandas(cuts, "part int, cuts array<bigint>")
    if n_parts * n_shards * 8 <= BROADCAST_BYTES:
        matrix = F.broadcast(matrix)
    inside = Window.partitionBy("part").orderBy(F.xxhash64(F.lit(seed), "_row"), "_row")
    dealt = (rows.withColumn("_at", F.row_number().over(inside)).join(matrix, "part")
             .withColumn("shard", F.size(F.filter("cuts", lambda c: c < F.col("_at"))).cast("int")).drop("cuts", "_at"))

    bits = max(0, (total // (n_shards * RANGE_ROWS)).bit_length())
    second = F.xxhash64(F.lit(seed + 1), "_row")
    dealt = dealt.withColumn("_h", second).withColumn("_range", F.shiftrightunsigned("_h", 64 - bits) if bits else F.lit(0).cast("long"))
    ranges = dealt.groupBy("shard", "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("shard", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    order = Window.partitionBy("shard", "_range").orderBy(F.shiftrightunsigned("_h", 1), "_h", "_row")
    return (dealt.join(ranges, ["shard", "_range"])
            .withColumn("slot", (F.col("_before") + F.row_number().over(order) - 1).cast("long"))
            .select("doc_id", "size", "text_crc32", "part", "shard", "slot", *[F.col(f"_payload_{c}").alias(c) for c in payload]))


def write_shards(docs: DataFrame, path: str, n_shards: int = N_SHARDS, seed: int = SEED) -> None:
    """Write whole rows to ``path/shard=S``, each file sorted by slot."""
    kept = tuple(c for c in docs.columns if c not in ("doc_id", "size", "text_crc32", "part", "shard", "slot"))
    out = assign_shards(docs, n_shards, seed, payload=kept)
    out.repartition("shard", F.floor(F.col("slot") / RANGE_ROWS)).sortWithinPartitions("shard", "slot").write.partitionBy("shard").mode("overwrite").parquet(path)
