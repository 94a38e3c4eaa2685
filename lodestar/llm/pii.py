"""Personal data by bootstrapped contextual extraction, in SQL functions only.

1. Base spans: the four rules (email, ip, card, phone), leftmost non-overlapping
   per kind, each rule written so that it reads any text in linear time. Spans
   come from the pieces between matches (``split``) and the matches themselves.
2. Candidates: every token with a digit, ``@``, ``(at)`` or ``[at]``, every
   phone-like run, and every run of short digit groups joined by single blanks,
   dots, dashes or brackets, as one candidate with its context. Those that are base matches as a whole are the seeds.
3. A bipartite graph links lexical patterns (two words to the left, two to the
   right, or one of each) with the values seen in them. Rounds alternate: a
   pattern's confidence for a kind is the share of its occurrences whose value
   is known to be of that kind; a value's score is the noisy-or of its trusted
   patterns. Only values of a fitting shape can get a kind.
4. Every occurrence of a value that reached ``MIN_SCORE`` and overlaps no base
   span is a further span. Base spans always stay.

Steps over the matches of one text go in blocks (``_running``), so a log file as
one document costs about its length.

Nulls and empty texts have no spans; rows with equal doc_id and text get equal
results; a null doc_id is a key like any other; ties in score go to the kind
listed first; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.session import checkpoint_dir

KINDS = ("email", "ip", "card", "phone")
_OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
#: Possessive forms of the base patterns: they match the same, without backtracking.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_NOT_IP = r"(?![0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9]))"
#: A group of a joined run: short, so that no solid number is swallowed, and not part of a word.
_GROUP = _NOT_IP + r"(?:[0-9]{1,6}+|[Xx*]{3,6}+)(?![0-9A-WYZa-wyz@*]|[Xx](?![0-9]))"
#: Groups joined by single blanks, dots, dashes or brackets, with an extension; the run ends where a token ends.
_JOINED = rf"(?<!\S)[(\[]?(?=[0-9]){_GROUP}(?:[)\]]?[\x20.-]?[(\[]?{_GROUP})++(?:[Xx][0-9]{{1,6}}+)?+(?![0-9A-Za-z@]|[^\s0-9A-Za-z@]+[0-9A-Za-z@])"
_AT = r"[(\[][Aa][Tt][)\]]"
CANDIDATE = (r"\+[0-9][\x20().0-9-]+[0-9]|" + _JOINED + rf"|(?<!\S)[A-Za-z0-9._%+-]++\x20{_AT}\x20[^\s@]++"
             + rf"|(?<!\S)(?:[^\s0-9@]*+[0-9@]|(?=\S*?{_AT}))\S*+")
#: Context words are taken from so many code points beside a candidate.
REACH = 48
ROUNDS = 3
MIN_SEEDS, MIN_CONFIDENCE, MIN_SCORE = 5, 0.8, 0.9
#: Arrays of a text's matches are gone through in blocks of so many, which keeps long texts linear.
BLOCK = 256
#: Found spans are joined by broadcast up to so many rows, else by a shuffle.
BROADCAST_ROWS = 100_000


def passes(kind: str, m: Column) -> Column:
    """Whether a match of the kind's pattern counts."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "card":
        return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    return F.length(digits).between(10, 15)


def looks_like(kind: str, value: Column) -> Column:
    """Whether a value that no rule accepts may still be of the kind."""
    n_digits = F.length(F.regexp_replace(value, "[^0-9]", ""))
    return {
        "email": value.rlike(r"^[^@]+@[^@]+$|\(at\)|\[at\]"),
        "ip": value.rlike(r"^[0-9A-Fa-f]+([.:][0-9A-Fa-f]*){2,}$") & ~value.contains("@"),
        "card": (n_digits >= 12) & value.rlike(r"^[0-9Xx* -]+$"),
        "phone": n_digits.between(6, 15) & value.rlike(r"^[+(]?[0-9][0-9().x/ -]*$"),
    }[kind]


def _once(value: Column, fn) -> Column:
    """``fn`` of a value that is computed once, however often ``fn`` names it."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def _blocks(values: Column) -> Column:
    """An array cut into arrays of ``BLOCK``; ``values`` should be bound by ``_once``."""
    last = F.floor(F.greatest(F.size(values) - 1, F.lit(0)) / BLOCK).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(values, i * BLOCK + 1, F.lit(BLOCK)))


def _running(values: Column, op) -> Column:
    """array<int>: for each element ``op`` over those before it (0 for the first). In blocks, so that no step copies a long array."""
    def short(block, first):
        zero = F.struct(first.alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(block, zero, lambda acc, x: F.struct(op(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])

    def whole(blocks):
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), op))
        return F.flatten(F.zip_with(blocks, short(totals, F.lit(0)), short))

    return _once(values, lambda v: _once(_blocks(v), whole))


def _starts(gaps: Column, lengths: Column) -> Column:
    """array<int>: starts of matches of the given lengths, each after its gap."""
    both = F.zip_with(gaps, lengths, lambda g, n: g + n)
    return F.zip_with(_running(both, lambda at, x: at + x), gaps, lambda at, g: at + g)


def _located(text: Column, pattern: str) -> Column:
    """array<struct<s int, m string>>: start (code points) and text of every match."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    pairs = F.filter(F.zip_with(found, gaps, lambda m, g: F.struct(m.alias("m"), g.alias("g"))), lambda x: x["m"].isNotNull())

    def placed(p):
        starts = _starts(F.transform(p, lambda x: x["g"]), F.transform(p, lambda x: F.length(x["m"])))
        return F.zip_with(p, starts, lambda x, at: F.struct(at.alias("s"), x["m"].alias("m")))

    return _once(pairs, placed)


def _none(kind: str = "struct<s:int,k:int,e:int>") -> Column:
    return F.array().cast(f"array<{kind}>")


def base_spans(text: Column) -> Column:
    """array<struct<s, k, e>> of the base rules, by start and then kind; ``text`` must not be null."""
    may = {"email": text.contains("@"), "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike("[0-9]{2}|[0-9][ -][0-9]"), "phone": text.contains("+")}

    def of(i, kind):
        kept = F.filter(_located(text, PATTERNS[kind]), lambda x: passes(kind, x["m"]))
        return F.when(may[kind], F.transform(kept, lambda x: F.struct(x["s"].alias("s"), F.lit(i).alias("k"), (x["s"] + F.length(x["m"])).alias("e")))).otherwise(_none())

    return F.array_sort(F.concat(*[of(i, k) for i, k in enumerate(KINDS)]))


def _words(gap: Column, from_right: bool) -> Column:
    near = F.right(gap, F.lit(REACH)) if from_right else F.left(gap, F.lit(REACH))
    return F.array_remove(F.split(F.lower(near), r"\s+"), "")


def _candidates(text: Column) -> Column:
    """array<struct<s, m, left, right>>: candidates with the pieces of text beside them."""
    found = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    gaps = F.transform(F.split(text, CANDIDATE, -1), lambda g: F.struct(F.length(g).alias("n"), F.right(g, F.lit(REACH)).alias("tail"), F.left(g, F.lit(REACH)).alias("head")))

    def placed(p):
        m, g = p["m"], p["g"]
        # The last gap has no match; its start is not used.
        lengths = F.zip_with(m, g, lambda a, _: F.coalesce(F.length(a), F.lit(0)))
        starts = _starts(F.transform(g, lambda x: x["n"]), lengths)
        right = F.slice(g, 2, F.greatest(F.size(g) - 1, F.lit(0)))
        return F.filter(F.arrays_zip(m.alias("m"), starts.alias("s"), g.alias("left"), right.alias("right")), lambda x: x["m"].isNotNull())

    return _once(F.struct(found.alias("m"), gaps.alias("g")), placed)


def occurrences(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, base, cands), one row per row of ``docs``: spans and raw candidates, without the text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", text.alias("_t"))
    cands = F.when(F.col("_t").rlike("[0-9@]|" + _AT), _candidates(F.col("_t"))).otherwise(F.lit(None))
    return d.select("doc_id", F.xxhash64("_t").alias("text_hash"), base_spans(F.col("_t")).alias("base"), cands.alias("cands"))


def _placed(occ: DataFrame) -> DataFrame:
    """One row per candidate: key, s, e, value, kind (index or null), and its patterns."""
    c = occ.select("doc_id", "text_hash", F.explode("cands").alias("c")).select("doc_id", "text_hash", "c.m", "c.s", "c.left", "c.right")
    c = c.withColumn("lead", F.length(F.regexp_extract("m", r"^[^A-Za-z0-9+(]*", 0))).withColumn("value", F.regexp_replace("m", r"^[^A-Za-z0-9+(]+|[^A-Za-z0-9)]+$", ""))
    kind = F.coalesce(*[F.when(F.col("value").rlike(f"^(?:{PATTERNS[k]})$") & passes(k, F.col("value")), F.lit(i)) for i, k in enumerate(KINDS)])
    left, right = _words(F.col("left.tail"), True), _words(F.col("right.head"), False)
    c = c.select("doc_id", "text_hash", (F.col("s") + F.col("lead")).alias("s"), F.lower("value").alias("value"), F.length("value").alias("n"), kind.alias("kind"), left.alias("l"), right.alias("r"))
    r1 = F.get("r", F.lit(0))
    l1 = F.when(F.size("l") >= 1, F.get("l", F.size("l") - 1))
    l2 = F.when(F.size("l") >= 2, F.concat_ws(" ", F.get("l", F.size("l") - 2), F.get("l", F.size("l") - 1)))
    r2 = F.when(F.size("r") >= 2, F.concat_ws(" ", F.get("r", F.lit(0)), F.get("r", F.lit(1))))
    patterns = F.array_compact(F.array(F.concat(F.lit("L "), l2), F.concat(F.lit("R "), r2), F.concat(F.lit("B "), l1, F.lit(" _ "), r1)))
    return c.where(F.col("n") > 0).select("doc_id", "text_hash", "s", (F.col("s") + F.col("n")).alias("e"), "value", "kind", patterns.alias("patterns"))


def learn_values(placed: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(value, kind): values that no rule accepts but whose patterns vouch for the kind."""
    edges = (placed.select("value", "kind", F.explode("patterns").alias("pattern"))
             .groupBy("pattern", "value").agg(F.count(F.lit(1)).alias("n"), F.min("kind").alias("seed")).checkpoint())
    totals = edges.groupBy("pattern").agg(F.sum("n").alias("total"))
    seeds = edges.where("seed is not null").select("value", F.col("seed").alias("kind"), F.lit(1.0).alias("score")).distinct()
    open_kinds = F.array_compact(F.array(*[F.when(looks_like(k, F.col("value")), F.lit(i)) for i, k in enumerate(KINDS)]))
    unknown = edges.where("seed is null").select("pattern", "value", F.explode(open_kinds).alias("kind")).checkpoint()
    found = None
    for _ in range(rounds):
        known = seeds if found is None else seeds.unionByName(found)
        scored = edges.join(known, "value").groupBy("pattern", "kind").agg(F.sum(F.col("n") * F.col("score")).alias("hits"), F.count(F.lit(1)).alias("values"))
        # One more unexplained occurrence than seen keeps rare patterns below certainty.
        trusted = (scored.join(totals, "pattern").withColumn("confidence", F.col("hits") / (F.col("total") + 1))
                   .where((F.col("values") >= MIN_SEEDS) & (F.col("confidence") >= MIN_CONFIDENCE)).select("pattern", "kind", "confidence"))
        score = F.lit(1.0) - F.exp(F.sum(F.log(F.lit(1.0) - F.col("confidence"))))
        found = unknown.join(trusted, ["pattern", "kind"]).groupBy("value", "kind").agg(score.alias("score")).where(F.col("score") >= MIN_SCORE).checkpoint()
    best = found.groupBy("value").agg(F.max(F.struct(F.col("score"), (-F.col("kind")).alias("k"))).alias("b"))
    return best.select("value", (-F.col("b.k")).alias("kind"))


def discovered(occ: DataFrame) -> DataFrame:
    """(doc_id, text_hash, found: array<struct<s,k,e>>) for the documents with further spans."""
    placed = _placed(occ)
    values = learn_values(placed)
    hits = placed.where("kind is null").join(values.withColumnRenamed("kind", "k"), "value").select("doc_id", "text_hash", "s", "k", "e").distinct()
    return hits.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list(F.struct("s", "k", "e"))).alias("found"))


def _clear(base: Column, found: Column) -> Column:
    """The found spans that overlap no base span: no base span that starts before their end ends after their start."""
    starts = F.transform(base, lambda b: F.struct(b["s"].alias("p"), F.lit(1).alias("t"), b["e"].alias("end"), b["s"].alias("s"), b["k"].alias("k")))
    ends = F.transform(found, lambda x: F.struct(x["e"].alias("p"), F.lit(0).alias("t"), F.lit(0).alias("end"), x["s"].alias("s"), x["k"].alias("k")))

    def of(events):
        reach = _running(F.transform(events, lambda x: x["end"]), lambda a, b: F.greatest(a, b))
        seen = F.zip_with(events, reach, lambda x, r: F.struct(x.alias("x"), r.alias("r")))
        return F.transform(F.filter(seen, lambda y: (y["x"]["t"] == 0) & (y["r"] <= y["x"]["s"])), lambda y: F.struct(y["x"]["s"].alias("s"), y["x"]["k"].alias("k"), y["x"]["p"].alias("e")))

    return _once(F.array_sort(F.concat(starts, ends)), of)


def _with_found(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` (doc_id, text_hash, base, ...) with ``spans``: base and the further ones that overlap none of them."""
    found = found.checkpoint()
    side = found.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_th"), "found")
    if found.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        side = F.broadcast(side)
    j = rows.join(side, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_th")), "left")
    return j.withColumn("spans", F.when(F.col("found").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", _clear(F.col("base"), F.col("found")))))).drop("_id", "_th", "found", "text_hash")


def extract_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans), one row per row of ``docs``; both array<struct<s, k, e>> sorted by start and kind."""
    checkpoint_dir(docs.sparkSession)
    occ = occurrences(docs).checkpoint()
    return _with_found(occ.drop("cands"), discovered(occ))


def spelled(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced by ``<KIND>``; of overlapping spans the first, then longest start the mask."""
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    reach = _running(F.transform(spans, lambda x: x["e"]), lambda a, b: F.greatest(a, b))
    cuts = F.filter(F.zip_with(spans, reach, lambda x, at: F.struct(at.alias("at"), x["s"].alias("s"), x["k"].alias("k"))), lambda x: x["s"] >= x["at"])

    def block(cut):
        # A piece of the text for a block of cuts, so that no cut counts code points from the start of the text.
        base = F.get(cut, F.lit(0))["at"]
        piece = F.substring(text, base + 1, F.element_at(cut, -1)["s"] - base)
        return _once(F.struct(piece.alias("t"), base.alias("b")), lambda p: F.array_join(F.transform(
            cut, lambda x: F.concat(F.substring(p["t"], x["at"] - p["b"] + 1, x["s"] - x["at"]), F.get(names, x["k"]))), ""))

    body = F.array_join(_once(cuts, lambda c: F.transform(_blocks(c), block)), "")
    rest = F.substring(text, F.array_max(F.transform(spans, lambda x: x["e"])) + 1, F.length(text))
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(body, rest))


def mask_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with all their columns and personal data masked in ``text``."""
    checkpoint_dir(docs.sparkSession)
    found = discovered(occurrences(docs).checkpoint())
    names = docs.columns
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_t"), F.struct(*[F.col(c) for c in names]).alias("_row"))
    d = d.withColumn("text_hash", F.xxhash64("_t")).withColumn("base", base_spans(F.col("_t")))
    done = _with_found(d, found).withColumn("_m", masked(F.col("_t"), F.col("spans")))
    return done.select(*[(F.when(F.col("_row.text").isNotNull(), F.col("_m")) if c == "text" else F.col("_row").getField(c)).alias(c) for c in names])
