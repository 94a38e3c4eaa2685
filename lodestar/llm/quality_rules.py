"""Quality rules: base counts and distribution divergence, in SQL functions only.

Every document gets a histogram of character classes (blanks, capitals,
punctuation, symbols, the rest; digits are left out, so that numbers in clean
prose count neither way) and one of common words.
The references are learnt from all documents whose ``lang`` names the language:
the median share of each character class (junk moves a mean, not a median) and
the mean share of each common word. A document's distance is the smallest
Jensen-Shannon distance (base 2, 0 to 1) to any reference, so a wrong ``lang``
does no harm.

A short text's histogram is far from any reference by chance alone, and that
chance shrinks with its length. So the limits are learnt as well: documents in a
listed language that the base rules keep are parted by length (bands that double
their words), and in each band a limit is the median distance plus ``SPREAD``
times the way from there to the upper quartile, ``NEAR`` at least; outliers move neither. A band of
fewer than ``MIN_REFERENCES`` takes the limit of the next shorter one, which is
wider. A document is rejected when the base rules fail, or when it is long enough
for a histogram to mean something (``MIN_CHARS``, ``MIN_WORDS``) and a distance is
above its band's limit.

Null text: no words, so base_failed. Empty table: empty result. Without any
document in a listed language only the base rules decide. Repeated rows each get
their row. Texts are read whole. Further columns never clash: rows are carried in
a struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.session import checkpoint_dir

#: Frequent function words of each language.
COMMON_WORDS = {
    "en": ("the", "of", "and", "to", "in", "is", "that", "for", "it", "with", "as", "was", "on", "are", "by", "this", "be", "at", "from", "a"),
    "fr": ("de", "la", "le", "les", "et", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par", "sur", "au", "pas", "avec"),
    "de": ("der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist", "im", "dem", "nicht", "ein", "eine", "als", "auch", "für"),
    "es": ("de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por", "un", "para", "con", "una", "su", "al", "es", "como"),
}
VOCABULARY = sorted({w for words in COMMON_WORDS.values() for w in words})
#: Blanks, capitals, punctuation, symbols, the rest.
CLASSES = 5
BLANKS = r"[\x20\x09-\x0D]"
MIN_CHARS, MIN_WORDS = 120, 30
SPREAD, MIN_REFERENCES = 7.0, 40
#: A distance up to this is never too far, however alike the reference documents are.
NEAR = 0.05
GRAM = 5
#: Rejected documents are joined by broadcast up to so many rows, else by a shuffle.
BROADCAST_ROWS = 200_000


def _without(text: Column, chars: str) -> Column:
    """How many code points of ``text`` the class ``chars`` matches."""
    return F.regexp_count(text, F.lit(f"[{chars}]"))


def measured(docs: DataFrame) -> DataFrame:
    """Base counts, both histograms (``chars`` array<double>, ``common`` array<struct<i, n>>) and the text's hash of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select(F.col("doc_id"), F.col("lang"), text.alias("_t"))
    d = d.withColumn("_w", F.array_remove(F.split("_t", BLANKS + "+"), ""))
    n = F.size("_w")
    # A window of five words is known by a 64-bit hash of them.
    grams = F.when(n >= GRAM, F.transform(F.sequence(F.lit(0), n - GRAM), lambda i: F.xxhash64(*[F.get(F.col("_w"), i + k) for k in range(GRAM)]))).otherwise(F.array().cast("array<bigint>"))
    lines = F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    chars = F.length("_t")
    d = d.select(
        "doc_id", "lang", F.xxhash64("_t").alias("text_hash"), n.cast("long").alias("n_words"), F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        _without(F.col("_t"), r"#*$%&|<>").cast("long").alias("n_symbols"), chars.cast("double").alias("_n"),
        _without(F.col("_t"), r"\p{Lu}").cast("double").alias("_upper"), _without(F.col("_t"), r"0-9").cast("double").alias("_digit"), _without(F.col("_t"), r".,;:!?'\"()-").cast("double").alias("_mark"),
        lines.alias("_lines"), grams.alias("_g"),
        F.sort_array(F.filter(F.split(F.lower("_t"), BLANKS + "+"), lambda w: w.isin(VOCABULARY))).alias("_hits"),
    )
    dup = F.size(F.array_distinct("_g")) < F.size("_g")
    d = d.withColumn("_sorted", F.when(dup, F.array_sort(F.transform("_g", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))))
    near = F.filter("_sorted", lambda x, k: F.coalesce(x["g"] == F.get(F.col("_sorted"), k - 1)["g"], F.lit(False)) | F.coalesce(x["g"] == F.get(F.col("_sorted"), k + 1)["g"], F.lit(False)))
    d = d.withColumn("_at", F.sort_array(F.transform(near, lambda x: x["i"])))
    covered = F.aggregate(F.transform("_at", lambda p, k: F.least(F.lit(GRAM), F.get(F.col("_at"), k + 1) - p)), F.lit(0), lambda a, x: a + x)
    # Hits are sorted, so a word's count is the way from its first place to the next word's.
    d = d.withColumn("_words", F.array_distinct("_hits")).withColumn("_starts", F.transform("_words", lambda w: F.array_position(F.col("_hits"), w).cast("int")))
    listed = F.array(*[F.lit(w) for w in VOCABULARY])
    common = F.transform("_words", lambda w, k: F.struct((F.array_position(listed, w) - 1).cast("int").alias("i"), (F.coalesce(F.get(F.col("_starts"), k + 1), F.size("_hits") + 1) - F.get(F.col("_starts"), k)).alias("n")))
    rest = F.greatest(F.col("_n") - F.col("_upper") - F.col("_digit") - F.col("_mark") - F.col("n_symbols") - (F.col("_n") - F.col("word_chars")), F.lit(0.0))
    return d.select(
        "doc_id", "lang", "text_hash", "n_words", "word_chars", "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"), F.col("_n").cast("long").alias("n_chars_read"),
        F.array((F.col("_n") - F.col("word_chars")).cast("double"), F.col("_upper"), F.col("_mark"), F.col("n_symbols").cast("double"), rest).alias("chars"),
        common.alias("common"),
    )


def _references_of(counts: DataFrame) -> DataFrame:
    long_enough = (F.col("n_chars_read") >= MIN_CHARS) & (F.col("n_words") >= MIN_WORDS)
    return counts.where(F.col("lang").isin(list(COMMON_WORDS)) & long_enough)


def references(counts: DataFrame) -> dict[str, dict[str, list[float]]]:
    """Reference histograms of each listed language, over all its long enough documents.

    At most ``len(COMMON_WORDS)`` times ``len(VOCABULARY) + 1`` numbers reach the driver.
    """
    d = _references_of(counts)
    total = F.aggregate("chars", F.lit(0.0), lambda a, x: a + x)
    shares = d.withColumn("_total", F.greatest(total, F.lit(1.0)))
    rows = shares.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), *[F.percentile_approx(F.get("chars", F.lit(i)) / F.col("_total"), 0.5, 1000).alias(f"c{i}") for i in range(CLASSES)]).collect()
    n_docs = {r["lang"]: r["n"] for r in rows}
    chars = {r["lang"]: [r[f"c{i}"] for i in range(CLASSES)] for r in rows}
    words = {lang: [0.0] * (len(VOCABULARY) + 1) for lang in n_docs}
    for r in d.select("lang", "n_words", F.inline("common")).groupBy("lang", "i").agg(F.sum(F.col("n") / F.col("n_words")).alias("share")).collect():
        words[r["lang"]][r["i"]] = r["share"] / n_docs[r["lang"]]
    for hist in words.values():
        hist[-1] = max(0.0, 1.0 - sum(hist))
    return {lang: {"chars": [x / max(sum(chars[lang]), 1e-12) for x in chars[lang]], "common": words[lang]} for lang in n_docs}


def _part(p: Column, r: Column) -> Column:
    """One class's share of twice the divergence; ``p`` and ``r`` are not negative."""
    m = (p + r) / 2
    return F.when(p > 0, p * F.log2(p / m)).otherwise(F.lit(0.0)) + F.when(r > 0, r * F.log2(r / m)).otherwise(F.lit(0.0))


def _distance(twice: Column) -> Column:
    return F.sqrt(F.greatest(twice / 2, F.lit(0.0)))


def js_distance(hist: Column, reference: list[float], total: Column | None = None) -> Column:
    """Jensen-Shannon distance (base 2) of a short histogram and a reference, class by class; ``total`` is its sum, where known."""
    twice = F.lit(0.0)
    total = F.aggregate(hist, F.lit(0.0), lambda a, x: a + x) if total is None else total
    for i, r in enumerate(reference):
        twice = twice + _part(F.get(hist, F.lit(i)) / F.greatest(total, F.lit(1.0)), F.lit(float(r)))
    return _distance(twice)


def js_sparse(common: Column, n_words: Column, reference: list[float]) -> Column:
    """The same for a histogram of (place, count) entries; a class with no entry adds the reference's whole share."""
    q = F.array(*[F.lit(float(r)) for r in reference])
    hits = F.aggregate(common, F.lit(0), lambda a, x: a + x["n"])
    n = F.greatest(n_words.cast("double"), F.lit(1.0))
    zero = F.struct(F.lit(0.0).alias("twice"), F.lit(0.0).alias("seen"))

    def step(acc, x):
        r = F.get(q, x["i"])
        return F.struct((acc["twice"] + _part(x["n"] / n, r)).alias("twice"), (acc["seen"] + r).alias("seen"))

    own = F.aggregate(common, zero, step, lambda a: a["twice"] + F.lit(float(sum(reference[:-1]))) - a["seen"])
    return _distance(own + _part(F.greatest(n_words - hits, F.lit(0)) / n, F.lit(float(reference[-1]))))


def distances(counts: DataFrame, refs: dict[str, dict[str, list[float]]]) -> DataFrame:
    """``counts`` with ``js_chars``, ``js_words`` (null without references) and ``base_failed``, without the histograms."""

    def nearest(of):
        found = [of(refs[lang]) for lang in sorted(refs)]
        return F.lit(None).cast("double") if not found else found[0] if len(found) == 1 else F.least(*found)

    d = counts.withColumn("_total", F.aggregate("chars", F.lit(0.0), lambda a, x: a + x))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return (d.withColumn("js_chars", nearest(lambda r: js_distance(F.col("chars"), r["chars"], F.col("_total"))))
            .withColumn("js_words", nearest(lambda r: js_sparse(F.col("common"), F.col("n_words"), r["common"])))
            .withColumn("base_failed", failed).drop("chars", "common", "_total"))


def _band() -> Column:
    """Texts of 2^b to 2^(b+1) - 1 words are in band b."""
    return F.floor(F.log2(F.greatest(F.col("n_words"), F.lit(1)).cast("double"))).cast("int")


def limits(judged: DataFrame) -> dict[str, dict[int, float]]:
    """The largest distance that is kept, by band, from the spread of the reference documents' own distances."""
    d = _references_of(judged).where(~F.col("base_failed")).groupBy(_band().alias("band"))
    quantiles = {name: F.percentile_approx(name, F.array(F.lit(0.5), F.lit(0.75)), 10000) for name in ("js_chars", "js_words")}
    rows = d.agg(F.count(F.lit(1)).alias("n"), *[q.alias(name) for name, q in quantiles.items()]).orderBy("band").collect()  # a row a band
    out: dict[str, dict[int, float]] = {"js_chars": {}, "js_words": {}}
    for r in rows:
        for name, held in out.items():
            if r["n"] >= MIN_REFERENCES:
                half, upper = r[name]
                held[r["band"]] = max(NEAR, half + SPREAD * (upper - half))
    return out


def _limit(of: dict[int, float]) -> Column:
    """A band's limit, that of the next shorter band with one, or none."""
    out = F.lit(None).cast("double")
    for band in sorted(of):
        out = F.when(_band() >= band, F.lit(of[band])).otherwise(out)
    return out


def judge(judged: DataFrame, most: dict[str, dict[int, float]]) -> DataFrame:
    """``judged`` with ``kept``."""
    far = (((F.col("n_chars_read") >= MIN_CHARS) & (F.col("js_chars") > _limit(most["js_chars"])))
           | ((F.col("n_words") >= MIN_WORDS) & (F.col("js_words") > _limit(most["js_words"]))))
    return judged.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(far, F.lit(False)))


def _judged(docs: DataFrame) -> DataFrame:
    """The texts are read once: counts and histograms go to the checkpoint folder, and so do the distances."""
    checkpoint_dir(docs.sparkSession)
    counts = measured(docs).checkpoint()
    judged = distances(counts, references(counts)).checkpoint()
    return judge(judged, limits(judged))


def apply_rules(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang, counts, distances, base_failed, kept."""
    return _judged(docs).drop("text_hash")


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns.

    Equal texts fare alike, so the rejected are known by id and text hash.
    """
    gone = _judged(docs).where("not kept").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_th")).distinct().checkpoint()
    if gone.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(c) for c in names]).alias("_row"))
    key = F.xxhash64(F.coalesce(F.col("_row.text"), F.lit("")))
    kept = rows.join(gone, F.col("_row.doc_id").eqNullSafe(F.col("_id")) & (key == F.col("_th")), "left_anti")
    return kept.select(*[F.col("_row").getField(c).alias(c) for c in names])
