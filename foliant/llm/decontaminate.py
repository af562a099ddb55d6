"""Benchmark decontamination as a prefix-filtered set join.

Every benchmark item gives windows of 10 consecutive words (a shorter item one
window of all its words). The tokens of a window are its 3-word shingles (a
window of one or two words is its own token). A document holds a window only if
it holds all of the window's tokens, so the prefix that must be joined is one
token: the rarest over all documents. Each of its occurrences fixes where the
window would have to start; starts outside the text are dropped and the rest
is verified token by token, on the words themselves. DataFrame functions only.

One pass cuts the documents into words and stores, beside a header row for each
document, the places where benchmark tokens stand (the token list of the
benchmark is broadcast only while its row count keeps it small). Rarity,
candidates and verification read that table.

Defined results: null texts have no words; repeated rows each yield their own
row; null doc_ids stay null; a null item_id counts as an item named by the empty
string; equal item_ids count once; empty tables give empty results or rows
without hits; further columns of either table are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foliant.llm.text import lower_az
from foliant.session import materialize, release

WINDOW, TOKEN = 10, 3
#: Tokens of the benchmark up to which their table (16 bytes a row) is broadcast.
BROADCAST_TOKENS = 1_000_000


def item_words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased."""
    cut = F.split(lower_az(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.filter(cut, lambda w: w != "")


def _shingles(hashes: Column, k: int) -> Column:
    """Hashes of the k-word shingles of an array of word hashes."""
    out = hashes
    for j in range(1, k):
        out = F.zip_with(F.slice(out, 1, F.greatest(F.size(hashes) - j, F.lit(0))),
                         F.slice(hashes, j + 1, F.size(hashes) + 1), lambda x, y: F.xxhash64(x, y))
    return out


def _word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``item, win`` (array of words), distinct."""
    words = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                             item_words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    return words.select("item", F.explode(F.transform(starts, lambda i: F.slice(F.col("w"), i, size))).alias("win")) \
        .distinct()


def tokens(wins: DataFrame, k: int = TOKEN) -> DataFrame:
    """``wid, len, k, off, g, gw``: tokens of the distinct windows, by offset, with their words."""
    one = wins.select("win").distinct().select(
        F.array_join("win", " ").alias("wid"), "win", F.size("win").alias("len"),
        F.least(F.size("win"), F.lit(k)).alias("k"))
    each = one.withColumn("off", F.explode(F.sequence(F.lit(0), F.col("len") - F.col("k")))) \
        .withColumn("t", F.slice("win", F.col("off") + 1, F.col("k")))
    hashed = F.coalesce(*[F.when(F.col("k") == n, F.get(_shingles(_word_hashes(F.col("t")), n), F.lit(0)))
                          for n in range(1, k + 1)])
    return each.select("wid", "len", "k", "off", hashed.alias("g"), F.array_join("t", " ").alias("gw"))


def places(docs: DataFrame, toks: DataFrame, broadcast_tokens: int = BROADCAST_TOKENS) -> DataFrame:
    """Header row (``pos`` null) of every document and the places of benchmark tokens.

    Columns ``rid, doc_id, hash, n_words, k, pos, g, gw``; ``hash`` is the text's.
    """
    sizes = sorted(r["k"] for r in toks.select("k").distinct().collect())  # at most TOKEN rows
    # the hash alone, so that the lookup has one long key; the words are compared later
    known = toks.select(F.col("g").alias("_g")).distinct()
    small = known.count() <= broadcast_tokens
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.xxhash64("text").alias("hash"),
                       item_words(F.col("text")).alias("w")) \
        .withColumn("h", _word_hashes(F.col("w")))
    lists, k_of, pos_of, first = [F.array(F.lit(None).cast("bigint"))], F.lit(0), F.lit(None).cast("int"), F.lit(1)
    for k in sizes:
        lists.append(_shingles(F.col("h"), k))
        k_of = F.when(F.col("i") >= first, F.lit(k)).otherwise(k_of)
        pos_of = F.when(F.col("i") >= first, F.col("i") - first).otherwise(pos_of)
        first = first + F.greatest(F.size("w") - (k - 1), F.lit(0))
    # outer: the plain form would compute the array twice, once to drop empty ones
    each = rows.select("rid", "doc_id", "hash", "w", F.posexplode_outer(F.concat(*lists)).alias("i", "g")) \
        .select("rid", "doc_id", "hash", "w", k_of.alias("k"), pos_of.alias("pos"), "g")
    gw = F.when(F.col("pos").isNotNull(), F.array_join(F.slice("w", F.col("pos") + 1, F.col("k")), " ")).alias("gw")
    narrow = ["rid", "doc_id", "hash", F.size("w").alias("n_words"), "k", "pos", "g", gw]
    if small:
        found = each.join(F.broadcast(known), F.col("g") == F.col("_g"), "left").where(F.col("_g").isNotNull() | F.col("pos").isNull())
        return found.select(*narrow)
    # beyond the bound the rows are exchanged, with their own words only; header rows stay apart
    rows = each.select(*narrow)
    return rows.where("pos is null").unionByName(
        rows.where("pos is not null").join(known, F.col("g") == F.col("_g"), "left_semi"))


def hits(found: DataFrame, toks: DataFrame) -> DataFrame:
    """``rid, start, len, wid``: every occurrence of a window in a document."""
    at = found.where("pos is not null")
    # rarity: occurrences over all documents; a window with a token that never occurs can't occur
    counts = at.groupBy("k", "gw").agg(F.count(F.lit(1)).alias("n"))
    ranked = toks.join(counts, ["k", "gw"], "left").groupBy("wid", "len", "k").agg(
        F.count(F.lit(1)).alias("n_tokens"),
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "off", "gw")).alias("best"))
    prefix = ranked.where("best.n > 0").select("wid", "len", "k", "n_tokens", F.col("best.off").alias("off"),
                                               F.col("best.gw").alias("gw"))
    # length and positional bounds: the place of the rare token fixes where the window starts
    candidates = at.join(prefix, ["k", "gw"]) \
        .select("rid", (F.col("pos") - F.col("off")).alias("start"), "len", "wid", "n_tokens", "n_words") \
        .where((F.col("start") >= 0) & (F.col("start") + F.col("len") <= F.col("n_words")))
    # verification: every token of the window stands at its place
    wanted = candidates.select("rid", "start", "len", "wid", "n_tokens") \
        .join(toks.select("wid", "k", "off", "gw"), "wid") \
        .withColumn("pos", F.col("start") + F.col("off"))
    same = wanted.join(at.select("rid", "pos", "k", "gw"), ["rid", "pos", "k", "gw"])
    return same.groupBy("rid", "start", "len", "wid", "n_tokens").agg(F.count(F.lit(1)).alias("n")) \
        .where(F.col("n") == F.col("n_tokens")).select("rid", "start", "len", "wid")


def decontaminate(docs: DataFrame, benchmark: DataFrame, broadcast_tokens: int = BROADCAST_TOKENS) -> DataFrame:
    """``doc_id, hash, n_words, n_hit, n_items, items, contaminated`` of every row of ``docs``.

    ``items`` is the sorted array of the ids of the items with occurring windows.
    """
    wins = materialize(windows(benchmark))
    toks = materialize(tokens(wins))
    found = materialize(places(docs.select("doc_id", "text"), toks, broadcast_tokens))
    occurring = materialize(hits(found, toks))
    names = wins.select("item", F.array_join("win", " ").alias("wid"))

    by_start = Window.partitionBy("rid").orderBy("start", "len")
    before = by_start.rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("len")
    fresh = F.greatest(F.lit(0), end - F.greatest("start", F.coalesce(F.max(end).over(before), F.lit(0))))
    covered = occurring.select("rid", "start", "len").distinct().withColumn("fresh", fresh) \
        .groupBy("rid").agg(F.sum("fresh").alias("n_hit"))
    items = occurring.select("rid", "wid").distinct().join(names, "wid").groupBy("rid") \
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    heads = found.where("pos is null").select("rid", "doc_id", "hash", "n_words")
    out = materialize(
        heads.join(covered, "rid", "left").join(items, "rid", "left").select(
            "doc_id", "hash", F.col("n_words").cast("long").alias("n_words"),
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"))
        .withColumn("contaminated", F.col("n_hit") > 0))
    release(wins, toks, found, occurring)
    return out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark window, with all their columns."""
    hit = decontaminate(docs, benchmark).where("contaminated") \
        .select(F.col("doc_id").alias("_id"), F.col("hash").alias("_hash")).distinct()
    # the hint keeps the plan the same at every size
    return docs.join(hit.hint("merge"), docs["doc_id"].eqNullSafe(hit["_id"]) & (F.xxhash64(docs["text"]) == hit["_hash"]), "left_anti")


def digest(result: DataFrame) -> DataFrame:
    """The contract's columns from the operator's rows."""
    return result.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                         F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


_AZ = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(" + _AZ + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL = f"""
WITH dw AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS.format('text')} AS w FROM documents),
bw AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_WORDS.format('text')} AS w FROM benchmark),
win AS (SELECT DISTINCT item, least(len(w), 10) AS l, array_to_string(w[i:i + 9], ' ') AS g
        FROM bw, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT l FROM win),
grams AS (SELECT rid, i, l, array_to_string(w[i:i + l - 1], ' ') AS g
          FROM dw, sizes, unnest(range(1, len(w) - l + 2)) AS t(i) WHERE len(w) >= l),
hit AS (SELECT grams.rid, grams.i, grams.l, win.item FROM grams JOIN win ON grams.g = win.g AND grams.l = win.l),
covered AS (SELECT rid, count(DISTINCT p) AS n_hit FROM hit, unnest(range(i, i + l)) AS t(p) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS sha
          FROM (SELECT DISTINCT rid, item FROM hit) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(sha, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN covered USING (rid) LEFT JOIN items USING (rid)
"""
