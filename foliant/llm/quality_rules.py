"""Quality rules: base repetition rules plus a hashed n-gram log-likelihood ratio.

Two multinomials over hashed word uni- and bigrams are counted, one of the
trusted target and one of the whole raw corpus. The score of a document is the
sum of its n-grams' log ratios divided by their number, and a fixed threshold on
it decides about every document. DataFrame functions only.

Defined results: a null text has no words; a row without words scores 0 and
fails the base rules; equal rows each yield their own row with equal figures; a
null doc_id is kept as null; an empty table gives an empty result; columns that
only other tables use (``lang``, ``source``, a clashing ``kept`` ...) are never
read. Log ratios are whole millionths, so sums do not depend on their order.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.llm.text import WHITE

#: Buckets of the two multinomials; bounds the ratio table in the plan.
BUCKETS = 10_000
#: The target's ids are broadcast up to so many; more are joined by exchange.
BROADCAST_IDS = 2_000_000
#: Keep documents whose mean log ratio (natural logarithm) is at least this.
THRESHOLD = -0.12
MIN_WORDS, REPEAT_PCT, WINDOW = 10, 20, 5


def split_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` without a lambda per word."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[ \t-\r]+"))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _pairs(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda x, y: F.xxhash64(x, y))


def _head(array: Column, less: int) -> Column:
    return F.slice(array, 1, F.greatest(F.size(array) - less, F.lit(0)))


def _from(array: Column, at: int) -> Column:
    return F.slice(array, at + 1, F.size(array) + 1)


def with_grams(words: DataFrame) -> DataFrame:
    """Add hashes of the words (``_h``) and of the pairs of neighbours (``_p``)."""
    return words.withColumn("_h", F.transform("_words", lambda w: F.xxhash64(w))) \
        .withColumn("_p", _pairs(_head(F.col("_h"), 1), _from(F.col("_h"), 1)))


def repeat_words(hashes: Column, pairs: Column, k: int = WINDOW) -> Column:
    """Words inside 5-word windows that occur twice or more, the first included.

    Windows are compared by 64-bit hash. Only texts with an equal pair pay for
    the sort that finds the positions.
    """
    fours = _pairs(_head(pairs, 2), _from(pairs, 2))
    fives = _pairs(_head(fours, 1), _from(hashes, 4))

    def covered(a: Column) -> Column:
        def positions(s: Column) -> Column:
            def twice(x, i):
                return (F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
                        | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))
            return F.array_sort(F.transform(F.filter(s, twice), lambda x: x["i"]))

        pairs_at = F.array_sort(F.transform(a, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return _let(_let(pairs_at, positions), lambda p: F.aggregate(
            p, F.struct(F.lit(-k).alias("last"), F.lit(0).alias("n")),
            lambda acc, x: F.struct(x.alias("last"), (acc["n"] + F.least(F.lit(k), x - acc["last"])).alias("n")),
            lambda acc: acc["n"]))

    return _let(fives, lambda a: F.when(F.size(F.array_distinct(a)) == F.size(a), F.lit(0)).otherwise(covered(a)))


def log_ratios(docs: DataFrame, target_ids: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """For each bucket millionths of ln(p_target / p_raw), both with add-one smoothing.

    ``target_ids`` (``doc_id``) names the trusted rows of ``docs``, however many.
    """
    trusted = target_ids.select(F.col("doc_id").alias("_tid")).where("_tid is not null").distinct()
    trusted = trusted.hint("broadcast" if trusted.count() <= BROADCAST_IDS else "merge")
    words = docs.select("doc_id", "text").join(trusted, F.col("doc_id") == F.col("_tid"), "left") \
        .select(F.col("_tid").isNotNull().cast("long").alias("_t"), split_words(F.col("text")).alias("_words"))
    # explode_outer: the plain form would cut and hash every text twice, once to drop empty arrays
    grams = with_grams(words).select("_t", F.explode_outer(F.concat("_h", "_p")).alias("_g"))
    counts = grams.groupBy(F.pmod("_g", F.lit(buckets)).cast("int").alias("bucket")) \
        .agg(F.count("_g").alias("raw"), F.sum("_t").alias("target")).where("bucket is not null")
    stored = counts.collect()  # at most ``buckets`` rows
    raw = sum(r["raw"] for r in stored) + buckets
    target = sum(r["target"] for r in stored) + buckets
    seen = {r["bucket"]: (r["raw"], r["target"]) for r in stored}
    return [round((math.log((t + 1) / target) - math.log((n + 1) / raw)) * 1_000_000)
            for n, t in (seen.get(b, (0, 0)) for b in range(buckets))]


def good_ids(labels: DataFrame) -> DataFrame:
    """Ids of all documents labelled as good."""
    return labels.where(F.col("quality") == 1).select("doc_id").where("doc_id is not null").distinct()


def quality_rules(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, threshold: float = THRESHOLD) -> DataFrame:
    """Figures and verdict of every row of ``docs`` (``doc_id, text``).

    ``labels`` (``doc_id, quality``) names the trusted target. Rows out:
    ``doc_id``, the base figures, ``llr`` (mean log ratio), ``base_failed``
    and ``kept``, in the order of ``docs`` and with its other columns left out.
    """
    ratios = log_ratios(docs, good_ids(labels), buckets)
    return _judged(docs, ratios, threshold, []).select(*RESULT)


RESULT = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "llr", "base_failed", "kept"]


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    threshold = options.pop("threshold", THRESHOLD)
    ratios = log_ratios(docs, good_ids(labels), **options)
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "doc_id", "text")
    # a plain filter on the verdict would be pushed below the steps that it rests on, and
    # repeat their cutting and hashing for every use of a column; a generator stops that
    kept = _judged(row, ratios, threshold, ["_row"]).select(F.explode_outer(F.when(F.col("kept"), F.array("_row"))).alias("_row"))
    return kept.where("_row is not null").select("_row.*")


def _judged(docs: DataFrame, ratios: list[int], threshold: float, carry: list[str]) -> DataFrame:
    buckets, table = len(ratios), F.lit(ratios)
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    rows = with_grams(docs.select(*carry, "doc_id", text.alias("_text"), split_words(F.col("text")).alias("_words"),
                                  lines.alias("_lines")))
    total = F.aggregate(F.concat("_h", "_p"), F.lit(0).cast("long"),
                        lambda acc, g: acc + F.get(table, F.pmod(g, F.lit(buckets)).cast("int")))
    rows = rows.select(
        *carry, "doc_id", F.size("_words").cast("long").alias("n_words"),
        (F.char_length("_text") - F.regexp_count("_text", F.lit(r"[ \t-\r]"))).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("_h"), F.col("_p")).cast("long").alias("n_repeat_words"),
        total.alias("_sum"), F.size(F.concat("_h", "_p")).alias("_n"))
    llr = F.when(F.col("_n") > 0, F.col("_sum") / F.col("_n") / 1_000_000).otherwise(F.lit(0.0))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PCT * F.col("n_words"))
    rows = rows.withColumn("llr", llr).withColumn("base_failed", failed)
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= F.lit(threshold)))
