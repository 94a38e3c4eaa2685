"""Personal data: many matches in one text, overlap, masks and the graph rounds against plain loops."""

from __future__ import annotations

import collections
import random
import time

from pyspark.sql import functions as F

from lodestar.llm import pii
from lodestar.llm.queries import QUERIES
from tests.llm.test_operators import slow_pii

SPANS = "array<struct<s:int,k:int,e:int>>"


def log_file(n: int) -> str:
    rng = random.Random(n)
    return "\n".join(rng.choice([f"user{i}@mail.example.com", f"10.0.{i % 300}.{i % 256} up", f"4111 1111 1111 {1000 + i % 9000}", f"call +1 (988) 555-{1000 + i % 9000}", "ø日本 nothing"]) for i in range(n))


def test_many_matches_in_one_text(spark):
    t = log_file(4000)
    d = spark.createDataFrame([(1, t), (2, None), (3, "")], "doc_id long, text string")
    got = {r["doc_id"]: (r["b"], r["spans"]) for r in pii.extract_spans(d).select("doc_id", pii.spelled(F.col("base")).alias("b"), "spans").collect()}
    assert got[1][0] == slow_pii(t) and got[2][0] == got[3][0] == ""
    assert slow_mask(t, got[1][1]) == {r["doc_id"]: r["text"] for r in pii.mask_documents(d).collect()}[1]


def test_query_counts_every_kind(spark, tmp_dir):
    texts = {1: "a@b.c, c@d.e and 10.0.0.1", 2: "10.0.0.1 4111 1111 1111 1111 4111-1111-1111-1111", 3: "+1 (988) 555-1000, +1 (988) 555-1001, x@y.z", 4: None, 5: log_file(300)}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    for r in QUERIES["op1_pii"](spark, tmp_dir).collect():
        kinds = collections.Counter(x.split(":")[0] for x in slow_pii(texts[r["doc_id"]] or "").split(","))
        assert [r[f"n_{k}"] for k in pii.KINDS] == [kinds[k] for k in pii.KINDS]


def test_time_follows_the_length_of_a_text(spark):
    def seconds(n):
        d = spark.createDataFrame([(1, log_file(n))], "doc_id long, text string")
        start = time.monotonic()
        assert d.select(F.size(pii.base_spans(F.col("text"))).alias("n")).first()["n"] > n / 4
        return time.monotonic() - start

    seconds(1000)
    assert seconds(200_000) < 60  # growing arrays took 24 s at 16,000


def slow_mask(t, spans):
    at, out = 0, []
    for s, k, e in sorted(tuple(x) for x in spans):
        if s >= at:
            out += [t[at:s], f"<{pii.KINDS[k].upper()}>"]
        at = max(at, e)
    return "".join(out) + t[at:]


def test_overlap_and_masks_match_loops(spark):
    rng, rows = random.Random(3), []
    for i in range(60):
        def some(n):
            return sorted((s, rng.randrange(4), s + rng.randint(1, 9)) for s in (rng.randrange(2000) for _ in range(n)))
        rows.append((i, "".join(rng.choice("aé日😀 ") for _ in range(2010)), some(rng.choice([0, 1, 40, 700])), some(rng.choice([0, 1, 300]))))
    d = spark.createDataFrame(rows, f"i int, t string, base {SPANS}, found {SPANS}")
    got = {r["i"]: r for r in d.select("i", pii._clear(F.col("base"), F.col("found")).alias("clear"), pii.masked(F.col("t"), F.col("base")).alias("m")).collect()}
    for i, t, base, found in rows:
        want = [x for x in found if not any(b[0] < x[2] and x[0] < b[2] for b in base)]
        assert collections.Counter(tuple(x) for x in got[i]["clear"]) == collections.Counter(want)
        assert got[i]["m"] == slow_mask(t, base)


def slow_rounds(placed, fits):
    """value -> kind by the module's rounds, as loops over all (pattern, value) links."""
    links, seeds = collections.Counter(), {}
    for value, kind, patterns in placed:
        for p in patterns:
            links[p, value] += 1
            if kind is not None:
                seeds[value] = min(kind, seeds.get(value, kind))
    totals = collections.Counter()
    for (p, _), n in links.items():
        totals[p] += n
    known, best = {(v, k): 1.0 for v, k in seeds.items()}, {}
    for _ in range(pii.ROUNDS):
        hits, values = collections.Counter(), collections.Counter()
        for (p, v), n in links.items():
            for (w, k), score in known.items():
                if w == v:
                    hits[p, k] += n * score
                    values[p, k] += 1
        trust = {pk: hits[pk] / (totals[pk[0]] + 1) for pk in hits if values[pk] >= pii.MIN_SEEDS and hits[pk] / (totals[pk[0]] + 1) >= pii.MIN_CONFIDENCE}
        miss = {}
        for (p, v) in links:
            for k in range(4):
                if v not in seeds and k in fits[v] and (p, k) in trust:
                    miss[v, k] = miss.get((v, k), 1.0) * (1 - trust[p, k])
        found = {vk: 1 - m for vk, m in miss.items() if 1 - m >= pii.MIN_SCORE}
        known = {(v, k): 1.0 for v, k in seeds.items()} | found
        best = {}
        for (v, k), score in found.items():
            best[v] = max(best.get(v, (-1.0, 0)), (score, -k))
    return {v: -k for v, (_, k) in best.items()}


def test_rounds_match_loops(spark):
    rng, rows = random.Random(8), []
    seeds = [f"p{i}@x.org" for i in range(30)]
    hidden = [f"name{i}(at)host" for i in range(12)]
    for j in range(900):
        kind = rng.random()
        value = rng.choice(seeds) if kind < 0.8 else rng.choice(hidden) if kind < 0.97 else "12.5"
        near = [f"L mail {rng.randrange(3)}", f"R now {rng.randrange(3)}", "B to _ at"] if value != "12.5" else [f"L pay {rng.randrange(2)}", "R now 0"]
        rows.append((value, 0 if value in seeds else None, near))
    # A second ring that only the values found in the first can vouch for.
    rows += [(rng.choice(hidden), None, ["L write to"]) for _ in range(80)] + [("late(at)ring", None, ["L write to"])] * 2
    got = {r["value"]: r["kind"] for r in pii.learn_values(spark.createDataFrame(rows, "value string, kind int, patterns array<string>")).collect()}
    want = slow_rounds(rows, {v: {0} if "(at)" in v or "@" in v else set() for v, _, _ in rows})
    assert got == want and set(hidden) <= set(got) and "12.5" not in got
