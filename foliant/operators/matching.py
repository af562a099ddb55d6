"""Report names -> master names -> client folders.

Two halves:

* The request/response path of an external matching model: distinct report
  names, request batches of 100, request payloads, parsing of the fenced JSON
  answer, merge of per-batch answers (later wins), roll-up of GRUPO
  sub-folders and resolution of folder names to folder rows.
* A deterministic, distributed matcher that replaces the model call:
  normalised names, candidate pairs by prefix filtering on rare tokens and by
  segments, cut where names differ, that small edits leave unchanged (together
  exact), a score
  ``greatest(edit similarity, token Jaccard)``, best folders per name and name
  clusters by connected components.
"""

from __future__ import annotations

import math
from functools import lru_cache
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.functions import strip_all
from foliant.operators.components import connected_components, spanning_forest
from foliant.operators.hierarchy import with_parent_id
from foliant.operators.positional import with_global_index
from foliant.session import REQUEST_BATCH_SIZE, materialize

# --- report names ----------------------------------------------------------


def report_client_column(report: DataFrame) -> str | None:
    """The client column is the 4th column; a report with 3 or fewer has none."""
    return report.columns[3] if len(report.columns) > 3 else None


def report_clients(report: DataFrame, order_col: str, keep_blank: bool = False) -> DataFrame:
    """Distinct stripped client names with their first position in the report."""
    col = report_client_column(report)
    spark = report.sparkSession
    if col is None:
        return spark.createDataFrame([], "name string, ord long")
    names = report.select(strip_all(F.coalesce(F.col(col), F.lit(""))).alias("name"),
                          F.col(order_col).cast("long").alias("ord"))
    if not keep_blank:
        names = names.where(F.col("name") != "")
    return names.groupBy("name").agg(F.min("ord").alias("ord"))


def new_client_names(names: DataFrame, name_map: DataFrame) -> DataFrame:
    """Names not yet in the consolidation map (``raw_name`` column)."""
    return names.join(name_map.select(F.col("raw_name").alias("name")).distinct(), "name", "left_anti")


def name_batches(names: DataFrame, size: int = REQUEST_BATCH_SIZE) -> DataFrame:
    """Cut the name list (order: first position, then name) into batches."""
    idx = with_global_index(names, ["ord", "name"], out="idx")
    return idx.withColumn("batch_no", F.floor(F.col("idx") / F.lit(size)).cast("long"))


def request_folders(inventory: DataFrame, candidates: DataFrame) -> DataFrame:
    """Folders offered to the matcher in list order: each candidate followed by
    its direct child folders when it is a GRUPO folder. ``sort_key`` orders."""
    groups = candidates.where(F.startswith(F.upper("name"), F.lit("GRUPO"))) \
        .select(F.col("id").alias("parent_id"), F.col("name").alias("group_name"),
                F.col("path").alias("group_path"))
    children = with_parent_id(inventory).where(F.col("mime_type") == "application/vnd.google-apps.folder") \
        .join(groups, "parent_id")
    base = candidates.select("id", "name", "path", F.lit(None).cast("string").alias("group_name"),
                             F.struct(F.col("path").alias("a"), F.lit(0).alias("b"),
                                      F.col("path").alias("c")).alias("sort_key"))
    kids = children.select("id", "name", "path", "group_name",
                           F.struct(F.col("group_path").alias("a"), F.lit(1).alias("b"),
                                    F.col("path").alias("c")).alias("sort_key"))
    return base.unionByName(kids)


def match_requests(batches: DataFrame) -> DataFrame:
    """Payload per request batch: its bulleted names (a batch is bounded by its
    size). Every request refers to the one folder list (``request_folder_lines``)."""
    return batches.groupBy("batch_no").agg(
        F.count(F.lit(1)).alias("n_names"),
        F.expr("listagg(concat('- ', name), '\\n') within group (order by idx)").alias("names_block"))


def request_folder_lines(folders: DataFrame) -> DataFrame:
    """The bulleted folder list as lines in list order: ``pos, line``."""
    rows = folders.select("sort_key", "id", F.concat(F.lit("- "), "name").alias("line"))
    return with_global_index(rows, ["sort_key", "id"], "pos").select("pos", "line")


# --- responses -------------------------------------------------------------

RESPONSE_SCHEMA = T.StructType([
    T.StructField("consolidation_map", T.MapType(T.StringType(), T.StringType())),
    T.StructField("match_map", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
])
# Fixed value: the fenced block pattern of a model answer (lazy, across lines).
FENCE_PATTERN = r"```json\s*([\s\S]+?)\s*```"


def parse_responses(responses: DataFrame, text_col: str = "response") -> DataFrame:
    """``batch_no, ok, parsed``: the first fenced JSON block parsed; blocked,
    unfenced or invalid answers have ``ok = false`` (their names stay new). The block
    must be one strict JSON object (no single quotes), whose two maps, where present,
    are objects of the expected shape."""
    block = F.regexp_extract(F.col(text_col), FENCE_PATTERN, 1)
    # one JSON value and nothing behind it, and that an object
    whole = F.startswith(F.trim(block), F.lit("{")) & (F.json_array_length(F.concat(F.lit("["), block, F.lit("]"))) == 1)
    block = F.when(F.coalesce(whole, F.lit(False)), block)
    parsed = F.from_json(block, RESPONSE_SCHEMA, {"mode": "PERMISSIVE", "allowSingleQuotes": "false"})
    out = responses.select("batch_no", parsed.alias("parsed"), block.alias("_block"))
    maps = ("consolidation_map", "match_map")
    some = F.col("parsed.consolidation_map").isNotNull() | F.col("parsed.match_map").isNotNull()
    shaped = [F.get_json_object("_block", f"$.{m}").isNull() | F.col(f"parsed.{m}").isNotNull() for m in maps]
    ok = F.col("parsed").isNotNull() & some & shaped[0] & shaped[1]
    return out.withColumn("ok", ok).drop("_block")


def consolidation_entries(parsed: DataFrame) -> DataFrame:
    return parsed.where("ok").select(
        "batch_no", F.explode(F.coalesce("parsed.consolidation_map",
                                         F.create_map().cast("map<string,string>")))
        .alias("raw_name", "master"))


def match_entries(parsed: DataFrame) -> DataFrame:
    """``batch_no, master, pos, folder_name``: answers' folder lists (dups kept)."""
    m = parsed.where("ok").select(
        "batch_no", F.explode(F.coalesce("parsed.match_map",
                                         F.create_map().cast("map<string,array<string>>")))
        .alias("master", "folders"))
    return m.select("batch_no", "master", F.posexplode("folders").alias("pos", "folder_name"))


def match_masters(parsed: DataFrame) -> DataFrame:
    """``batch_no, master``: every master of the answers, also those with an empty list."""
    return parsed.where("ok").select("batch_no", F.explode(F.map_keys(F.coalesce(
        "parsed.match_map", F.create_map().cast("map<string,array<string>>")))).alias("master"))


def rejected_responses(responses: DataFrame, text_col: str = "response") -> DataFrame:
    """The answers that gave no result, whole, to be looked at or asked again."""
    bad = parse_responses(responses, text_col).where(~F.col("ok")).select("batch_no")
    return responses.join(bad, "batch_no", "left_semi")


def merge_last_wins(df: DataFrame, key: str, value: str, priority: str) -> DataFrame:
    """One value per key: the one with the highest priority (a later update wins)."""
    return df.groupBy(key).agg(F.max_by(F.col(value), F.col(priority)).alias(value))


def merge_match_lists(entries: DataFrame) -> DataFrame:
    """Concatenate each master's lists over batches in batch order (ordering key)."""
    return entries.select("master", "batch_no", "pos", "folder_name")


def rollup_to_group(entries: DataFrame, folders: DataFrame) -> DataFrame:
    """Replace a GRUPO sub-folder name by its GRUPO folder name; dedupe per master.

    ``folders``: the request folder list with ``group_name`` (last wins by
    list order when a child name repeats).
    """
    child_map = folders.where(F.col("group_name").isNotNull()).groupBy(F.col("name").alias("folder_name")) \
        .agg(F.max_by("group_name", "sort_key").alias("group_name"))
    rolled = entries.join(child_map, "folder_name", "left") \
        .select("master", F.coalesce("group_name", "folder_name").alias("folder_name"))
    return rolled.distinct()


def resolve_folders(rolled: DataFrame, folders: DataFrame) -> DataFrame:
    """Folder names -> folder rows (last wins by list order); unknown names drop."""
    lookup = folders.groupBy(F.col("name").alias("folder_name")).agg(
        F.max_by(F.struct("id", "path"), "sort_key").alias("f"))
    return rolled.join(lookup, "folder_name").select(
        F.col("master").alias("client"), F.col("f.id").alias("folder_id"),
        F.col("folder_name"), F.col("f.path").alias("folder_path"))


def client_folder_table(resolved: DataFrame) -> DataFrame:
    """``client, pos, folder_*``: list position by folder path (fixed order)."""
    from pyspark.sql import Window
    w = Window.partitionBy("client").orderBy("folder_path", "folder_id")
    return resolved.withColumn("pos", (F.row_number().over(w) - 1).cast("int"))


def incremental_merge(old_map: DataFrame, new_map: DataFrame, key: str,
                      new_keys: DataFrame | None = None, on_conflict: str = "replace") -> DataFrame:
    """``{**old, **new}``: a key present in the new map replaces all old rows
    of that key, even when its new list is empty (``new_keys`` lists the keys
    of the new map; default: the keys that have rows). With ``on_conflict='union'``
    a key keeps its old rows and takes the new ones that it does not have yet."""
    if on_conflict == "union":
        return old_map.unionByName(new_map).distinct()
    if on_conflict != "replace":
        raise ValueError("on_conflict must be 'replace' or 'union'")
    keys = (new_keys if new_keys is not None else new_map).select(key).distinct()
    keep_old = old_map.join(keys, key, "left_anti")
    return keep_old.unionByName(new_map)


# --- deterministic matcher ---------------------------------------------------

# Legal-form tokens and the group marker dropped from names,
# and the accent folding table.
STOP_TOKENS = ["LTDA", "SA", "ME", "EPP", "INC", "CORP", "CORPORATION", "GRUPO"]
ACCENTS_FROM = "ÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑ"
ACCENTS_TO = "AAAAAEEEEIIIIOOOOOUUUUCN"
THRESHOLD_PCT = 85


def normalize_names(df: DataFrame, col: str, out: str = "norm") -> DataFrame:
    """Upper case, fold accents, punctuation to space, drop legal forms
    (including the pair ``S A``) and ``GRUPO``, collapse spaces. A name of which
    nothing is left keeps its stripped raw text, so every name gets a master."""
    s = F.translate(F.upper(F.col(col)), ACCENTS_FROM, ACCENTS_TO)
    s = F.regexp_replace(s, r"[^A-Z0-9]+", " ")
    s = F.regexp_replace(F.concat(F.lit(" "), s, F.lit(" ")), r" S A ", " ")
    stop = F.array(*[F.lit(t) for t in STOP_TOKENS])
    toks = F.filter(F.split(F.trim(s), " +"), lambda t: (t != "") & ~F.array_contains(stop, t))
    raw = F.array(strip_all(F.col(col)))
    toks = F.when(F.size(toks) > 0, toks).otherwise(raw)
    return df.withColumn("tokens", F.array_sort(F.array_distinct(toks))) \
        .withColumn(out, F.array_join(toks, " ")).where(F.col(out) != "")


def _prefix_tokens(sets: DataFrame, token_rank: DataFrame, key: str) -> DataFrame:
    """Rarest ``|x| - ceil(t|x|) + 1`` tokens of each set (exact Jaccard filter)."""
    ex = sets.select(key, F.size("tokens").alias("_n"), F.explode("tokens").alias("token")) \
        .join(token_rank.hint("merge"), "token")
    ex = ex.withColumn("_keep", F.col("_n") - F.expr(f"({THRESHOLD_PCT} * _n + 99) div 100") + 1)
    from pyspark.sql import Window
    w = Window.partitionBy(key).orderBy("_df", "token")
    return ex.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= F.col("_keep")) \
        .select(key, "token")


def _within_edits(a_norm, b_norm):
    """Do two names differ by no more edits than the longer one allows?"""
    return F.call_function("levenshtein", a_norm, b_norm, _edits(F.greatest(F.length(a_norm), F.length(b_norm)))) >= 0


def _score(a_norm, b_norm, a_tok, b_tok):
    inter = F.size(F.array_intersect(a_tok, b_tok))
    union = F.size(F.array_union(a_tok, b_tok))
    jac = inter.cast("double") / union.cast("double")
    longest = F.greatest(F.length(a_norm), F.length(b_norm))
    # stops at the allowed edits (-1 beyond them)
    edits = F.call_function("levenshtein", a_norm, b_norm, _edits(longest))
    lev = F.when(edits >= 0, F.lit(1.0) - edits.cast("double") / longest.cast("double")).otherwise(F.lit(0.0))
    return F.greatest(lev, jac)


def token_frequencies(*sides: DataFrame) -> DataFrame:
    toks = None
    for s in sides:
        t = s.select(F.explode("tokens").alias("token"))
        toks = t if toks is None else toks.unionByName(t)
    return toks.groupBy("token").agg(F.count(F.lit(1)).alias("_df"))


def _edits(length):
    """Edits that a pair may differ by whose longer name has this length."""
    return F.floor(F.lit(100 - THRESHOLD_PCT) * length / 100).cast("int")


def place_weights(names: DataFrame) -> DataFrame:
    """``n, t, p, w``: what each place of the names of a length tells apart, with the edits of that length.

    A place weighs as much as its letter says beyond the two letters before it, over all names of
    that length (the logarithm of the ratio of collision rates of letter pairs and letter triples there).
    """
    from pyspark.sql import Window
    sized = names.select("norm", F.length("norm").alias("n")).withColumn("t", _edits(F.col("n"))).where("t > 0")
    places = sized.select("n", "t", "norm", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("p"))

    def collisions(width, out):
        gram = F.col("norm").substr(F.greatest(F.lit(1), F.col("p") + (2 - width)), F.least(F.lit(width), F.col("p") + 1))
        counts = places.groupBy("n", "t", "p", gram.alias("g")).agg(F.count(F.lit(1)).cast("double").alias("c"))
        # pairs of different names; half a pair more, so that the rate is never zero
        return counts.groupBy("n", "t", "p").agg(((F.sum(F.col("c") * (F.col("c") - 1)) + 0.5) / (F.sum("c") * (F.sum("c") - 1) + 1)).alias(out))

    before = collisions(2, "c2").select("n", (F.col("p") + 1).alias("p"), "c2")
    weight = F.greatest(F.log(F.coalesce("c2", F.lit(1.0)) / F.col("c3")), F.lit(0.0)) + F.lit(0.02)
    return collisions(3, "c3").join(before, ["n", "p"], "left").select("n", "t", "p", weight.alias("w"))


def cut_table(names: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """``n, t, k, s, z``: start and length of the ``t + 1`` segments of names of length ``n``.

    The cuts follow what the places of a name tell apart (``place_weights``, computed here when not given).
    So a long ending that many names share lies in one segment together with letters
    that differ, and no segment is common to them all. The segments in the middle, which
    may have moved farther, get more weight than those at the ends. Any cut into
    ``t + 1`` non-empty pieces is complete; the weights only choose between them.
    """
    from pyspark.sql import Window
    rows = place_weights(names) if weights is None else weights
    sized = rows.select("n", "t").distinct()
    by_place, whole = Window.partitionBy("n").orderBy("p"), Window.partitionBy("n")
    # segment i may stand at 2 min(i, t - i) + 1 places of the other name, so it needs that much more weight
    places_of = lambda i: F.log(2 * F.least(i, F.col("t") - i) + 1)
    spent = lambda last: F.aggregate(F.sequence(F.lit(0), last), F.lit(0.0), lambda acc, i: acc + places_of(i))
    each = F.greatest((F.sum("w").over(whole) - spent(F.col("t"))) / (F.col("t") + 1), F.lit(0.01))
    rows = rows.withColumn("_each", each).withColumn("_mid", F.sum("w").over(by_place) - F.col("w") / 2)
    ends = F.transform(F.sequence(F.lit(1), F.col("t")), lambda j: j * F.col("_each") + spent(j - 1))
    rows = rows.withColumn("j", F.size(F.filter(ends, lambda x: x <= F.col("_mid"))))
    rows = rows.withColumn("_j", F.coalesce(F.lag("j").over(by_place), F.lit(-1))).where("j > _j")
    reached = rows.select("n", F.explode(F.sequence(F.col("_j") + 1, F.col("j"))).alias("k"), "p")
    wanted = sized.select("n", "t", F.explode(F.sequence(F.lit(0), F.col("t"))).alias("k"))
    starts = wanted.join(reached, ["n", "k"], "left").withColumn("p", F.coalesce("p", "n"))
    by_cut = Window.partitionBy("n").orderBy("k")
    start = F.least(F.max(F.col("p") - F.col("k")).over(by_cut) + F.col("k"), F.col("n") - (F.col("t") + 1 - F.col("k")))
    starts = starts.withColumn("s", start)
    return starts.select("n", "t", "k", "s", (F.coalesce(F.lead("s").over(by_cut), F.col("n")) - F.col("s")).alias("z"))


def _edit_candidates(short: DataFrame, long: DataFrame, cuts: DataFrame, own_list: bool = False) -> DataFrame:
    """``a, b``: pairs with ``|a| <= |b|`` that are within the edits of ``b``; within one list
    (``own_list``) no pair of equal names, and a pair of one length once.

    ``b`` is cut into one segment more than the edits allow (``cut_table``), so one of
    them stands unchanged in ``a``. Counting the edits from both ends, for the first
    segment ``k`` with at most ``k`` edits up to its end there are ``k`` edits before it and
    at most ``t - k`` behind, which bounds its place in ``a`` from the left and from the
    right. Exact equi-joins on (length of b, segment number, segment text). The edits are
    counted where the join meets the pair, so only pairs that pass are exchanged to be
    made distinct. Only the cuts are broadcast: a row for each length and segment.
    """
    return _edit_rows(short, long, cuts, own_list).select("a", "b").distinct()


def _side(names: DataFrame, side: str, *more) -> DataFrame:
    """The names as column ``side`` (their numbers, where they have any, as ``side_id``)."""
    ids = [F.col("id").alias(f"{side}_id")] if "id" in names.columns else []
    return names.select(F.col("norm").alias(side), *ids, *more)


def _edit_rows(short: DataFrame, long: DataFrame, cuts: DataFrame, own_list: bool) -> DataFrame:
    """The pairs of ``_edit_candidates`` as often as they have segments in common."""
    cuts = F.broadcast(materialize(cuts))
    own = _side(long, "b", F.length("norm").alias("n")).join(cuts, "n")
    index = own.select(*[c for c in own.columns if c.startswith("b")], "n", "k", F.col("b").substr(F.col("s") + 1, F.col("z")).alias("seg"))
    probe = _side(short, "a", F.length("norm").alias("m"))
    ids = [c for c in probe.columns if c.startswith("a")]
    reach = F.ceil(F.col("m") * 100 / F.lit(THRESHOLD_PCT)).cast("int")
    probe = probe.withColumn("n", F.explode(F.sequence(F.col("m"), F.greatest(reach, F.col("m"))))) \
        .where(F.col("n") - _edits(F.col("n")) <= F.col("m")).join(cuts, "n")
    right = F.col("s") + F.col("m") - F.col("n")
    probe = probe.withColumn("lo", F.greatest(F.lit(0), F.col("s") - F.col("k"), right - (F.col("t") - F.col("k")))) \
        .withColumn("hi", F.least(F.col("m") - F.col("z"), F.col("s") + F.col("k"), right + (F.col("t") - F.col("k")))).where("lo <= hi") \
        .withColumn("seg", F.explode(F.array_distinct(F.transform(F.sequence("lo", "hi"), lambda p: F.col("a").substr(p + 1, F.col("z")))))) \
        .select(*ids, "n", "k", "seg")
    met = probe.join(index.hint("merge"), ["n", "k", "seg"])
    if own_list:
        met = met.where((F.length("a") < F.col("n")) | (F.col("a") < F.col("b")))
    return met.where(_within_edits(F.col("a"), F.col("b"))).drop("n", "k", "seg")


# --- many names of one length: several segments at once ---

# Measures of work by which the number of segments is chosen: of a row that looks for its like, and of a pair that meets.
ROW_COST, PAIR_COST = 1.5, 0.3
MOST_EDITS, MOST_LOOKUPS = 8, 1000


def _equal_cuts(weights: list[float], parts: int) -> list[tuple[int, int]]:
    """``parts`` non-empty pieces (start, length) of a name that weigh about the same."""
    starts, spent, n = [0], 0.0, len(weights)
    for p, w in enumerate(weights):
        middle = spent + w / 2
        if p > starts[-1] and len(starts) < parts and (middle >= len(starts) * sum(weights) / parts or n - p <= parts - len(starts)):
            starts.append(p)
        spent += w
    return [(s, e - s) for s, e in zip(starts, [*starts[1:], n])]


@lru_cache(maxsize=None)
def _moves(gaps: tuple[int, ...], last: int) -> list[tuple[int, ...]]:
    """How far each chosen segment may have moved: between two of them by at most the
    segments left out there, and ``last`` behind them all."""
    if len(gaps) == 1:
        return [()] if abs(last) <= gaps[0] else []
    return [(d, *(d + x for x in rest)) for d in range(-gaps[0], gaps[0] + 1) for rest in _moves(gaps[1:], last - d)]


def _lookups(cuts: list[tuple[int, int]], kept: int, m: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """``set, pieces``: where ``kept`` segments of a longer name may stand in one of length ``m``.

    Of ``t + kept`` segments, ``t`` edits leave ``kept`` unchanged. Count up by one at an unchanged
    segment and down by its edits less one at any other; the segments where the count first reaches
    1, 2, .. are chosen. Up to each of them there are as many edits as segments left out, so also between
    two of them, and behind the last at most as many: this bounds how far they move against each other.
    """
    n, out = sum(z for _, z in cuts), []
    for number, chosen in enumerate(combinations(range(len(cuts)), kept)):
        gaps = tuple(b - a - 1 for a, b in zip((-1, *chosen), (*chosen, len(cuts))))
        for moves in _moves(gaps, m - n):
            pieces = [(cuts[i][0] + d, cuts[i][1]) for i, d in zip(chosen, moves)]
            ends = [0, *(p + z for p, z in pieces)]
            if all(p >= e for (p, _), e in zip(pieces, ends)) and ends[-1] <= m:
                out.append((number, pieces))
    return out


def _dense_cuts(weights: DataFrame, names: DataFrame) -> dict[int, tuple[int, list[tuple[int, int]]]]:
    """``length -> segments to share, cuts`` for the lengths at which so many names share one of ``t + 1``
    segments that it costs less to ask for several of more segments at once. Any choice is complete."""
    longest = max(n for n in range(1, 1000) if n * (100 - THRESHOLD_PCT) // 100 <= MOST_EDITS)
    sizes = dict(names.groupBy(F.length("norm").alias("n")).count().where(F.col("n") <= longest).collect())
    places: dict[int, dict[int, float]] = {}
    for n, p, w in weights.where(F.col("n") <= longest).select("n", "p", "w").collect():
        places.setdefault(n, {})[p] = w
    found = {}
    for n, by_place in places.items():
        t = n * (100 - THRESHOLD_PCT) // 100
        w = [by_place.get(p, 0.0) for p in range(n)]
        asking = sum(sizes.get(m, 0) for m in range(n - t, n + 1))
        best = None
        for kept in range(1, min(6, n - t) + 1):
            if kept > 1 and math.comb(t + kept, kept) > 150:
                break
            cuts = _equal_cuts(w, t + kept)
            looks = _lookups(cuts, kept, n)
            if kept > 1 and len(looks) > MOST_LOOKUPS:
                break
            says = [sum(w[s: s + z]) for s, z in cuts]
            shared = [math.exp(-sum(says[i] for i in chosen)) for chosen in combinations(range(len(cuts)), kept)]
            cost = asking * (ROW_COST * len(looks) + PAIR_COST * sizes[n] * sum(shared[number] for number, _ in looks))
            if best is None or cost < best[0]:
                best = cost, kept, cuts
        if best[1] > 1:
            found[n] = best[1:]
    return found


def _letters(norm):
    """Which letters a name has and how often (up to 3 times), as bits: 21 classes of letters, 3 bits each."""
    def more(held, letter):
        at = F.pmod(F.ascii(letter), F.lit(21)) * 3
        bits = F.call_function("shiftright", held, at).bitwiseAND(F.lit(7).cast("long"))
        return held.bitwiseOR(F.call_function("shiftleft", (bits * 2 + 1).bitwiseAND(F.lit(7).cast("long")), at))
    return F.aggregate(F.split(norm, ""), F.lit(0).cast("long"), lambda held, x: F.when(x == "", held).otherwise(more(held, x)))


def _dense_rows(names: DataFrame, dense: dict[int, tuple[int, list[tuple[int, int]]]]) -> DataFrame:
    """The same pairs of one numbered list for the lengths (of the longer name) in ``dense``, some of them several times.

    Names meet that have all pieces of a set of segments in common (a hash of them; the edits
    are counted for each pair). An edit changes one letter at most, so pairs of names whose letters differ
    by more are left before that, and a common ending is not compared again.
    """
    spark = names.sparkSession
    most = max(kept for kept, _ in dense.values())
    pad = lambda pieces: [x for p, z in [*pieces, *[(0, 0)] * (most - len(pieces))] for x in (p + 1, z)]
    parts = ", ".join(f"p{i} int, z{i} int" for i in range(most))
    own, looks = [], []
    for n, (kept, cuts) in sorted(dense.items()):
        t = len(cuts) - kept
        own += [(n, number, t, cuts[-1][1] - 1, *pad([cuts[i] for i in chosen]))
                for number, chosen in enumerate(combinations(range(len(cuts)), kept))]
        looks += [(n, number, cuts[-1][1] - 1, m, *pad(pieces)) for m in range(n - t, n + 1) for number, pieces in _lookups(cuts, kept, m)]
    own = F.broadcast(materialize(spark.createDataFrame(own, f"n int, chosen int, t int, tail int, {parts}")))
    looks = F.broadcast(materialize(spark.createDataFrame(looks, f"n int, chosen int, tail int, m int, {parts}")))

    key = F.xxhash64("n", "chosen", *[F.col("norm").substr(F.col(f"p{i}"), F.col(f"z{i}")) for i in range(most)]).alias("key")
    stored = materialize(names.select("norm", "id", F.length("norm").alias("m"), _letters(F.col("norm")).alias("bits")))

    def side(rows, out):
        size = F.col("m") - F.col("tail")
        return rows.select(key, F.col("id").alias(f"{out}_id"), F.col("bits").alias(f"{out}_bits"), F.col("norm").substr(F.lit(1), size).alias(f"{out}_head"),
                           F.col("norm").substr(size + 1, F.col("tail")).alias(f"{out}_tail"), *[c for c in ("same", "t") if c in rows.columns])

    index = side(stored.join(own, F.col("m") == F.col("n")), "b")
    probe = side(stored.join(looks, "m").withColumn("same", F.col("m") == F.col("n")), "a")
    met = probe.join(index.hint("merge"), "key").where(~F.col("same") | (F.col("a_id") < F.col("b_id")))
    lost = lambda x, y: F.bit_count(F.col(x).bitwiseAND(F.bitwise_not(F.col(y)))) <= F.col("t")
    met = met.where(lost("a_bits", "b_bits") & lost("b_bits", "a_bits"))
    a, b = F.concat("a_head", "a_tail"), F.concat("b_head", "b_tail")
    edits = F.when(F.col("a_tail") == F.col("b_tail"), F.call_function("levenshtein", F.col("a_head"), F.col("b_head"), F.col("t"))) \
        .otherwise(F.call_function("levenshtein", a, b, F.col("t")))
    return met.where(edits >= 0).select(a.alias("a"), b.alias("b"), "a_id", "b_id")


def _shared_tokens(left: DataFrame, right: DataFrame) -> DataFrame:
    freq = token_frequencies(left, right)
    return _prefix_tokens(left, freq, "norm").join(
        _prefix_tokens(right, freq, "norm").withColumnRenamed("norm", "other").hint("merge"), "token").select("norm", "other")


def _candidates(left: DataFrame, right: DataFrame) -> DataFrame:
    """``norm, other``: every pair that can pass the threshold by tokens or by edits."""
    up = _edit_candidates(left, right, cut_table(right)).select(F.col("a").alias("norm"), F.col("b").alias("other"))
    down = _edit_candidates(right, left, cut_table(left)).select(F.col("b").alias("norm"), F.col("a").alias("other"))
    return _shared_tokens(left, right).unionByName(up).unionByName(down).distinct()


def _self_edits(u: DataFrame) -> DataFrame:
    """``a, b`` (and their numbers) within the edits, of one list; a pair may come several times, in one order or the other."""
    weights = materialize(place_weights(u))
    dense = _dense_cuts(weights, u)
    pairs = _edit_rows(u, u, cut_table(u, weights.where(~F.col("n").isin(*dense)) if dense else weights), own_list=True)
    return pairs.unionByName(_dense_rows(u, dense)) if dense else pairs


def _scored(candidates: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    pairs = candidates.join(left.select("norm", F.col("tokens").alias("_ta")).hint("merge"), "norm") \
        .join(right.select(F.col("norm").alias("other"), F.col("tokens").alias("_tb")).hint("merge"), "other")
    score = _score(F.col("norm"), F.col("other"), F.col("_ta"), F.col("_tb"))
    return pairs.select("norm", "other", score.alias("score")).where(F.col("score") * 100 >= THRESHOLD_PCT - 1e-9)


def _distinct_forms(names: DataFrame) -> DataFrame:
    """``norm, tokens`` of the distinct normal forms, stored once and dealt over all tasks. Joins with
    them are merge joins: by the size of the files that they come from they could pass for small tables."""
    n = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(names.select("norm", "tokens").distinct().repartition(n, "norm"))


def match_pairs(names: DataFrame, folders: DataFrame) -> DataFrame:
    """Scored (name, folder) pairs with score >= threshold, all of them.

    ``names``: ``name, norm, tokens``; ``folders``: ``folder_id, folder_name,
    folder_path, norm, tokens``. Distinct normal forms are scored once.
    """
    left, right = _distinct_forms(names), _distinct_forms(folders)
    scored = _scored(_candidates(left, right), left, right)
    return scored.join(names.select("name", "norm").hint("merge"), "norm") \
        .join(folders.select("folder_id", "folder_name", "folder_path", F.col("norm").alias("other")).hint("merge"), "other") \
        .select("name", "folder_id", "folder_name", "folder_path", "score")


def match_best(pairs: DataFrame) -> DataFrame:
    """Per name every folder tied on the best score (list order: folder path)."""
    best = pairs.groupBy("name").agg(F.max("score").alias("_best"))
    return pairs.join(best, "name").where(F.col("score") == F.col("_best")).drop("_best")


def _numbered_forms(names: DataFrame) -> DataFrame:
    """``norm, tokens, id`` of the distinct normal forms, stored once; the numbers follow the order of the forms."""
    n = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    forms = names.select("norm", "tokens").distinct().repartitionByRange(n, "norm").sortWithinPartitions("norm")
    return materialize(forms.withColumn("id", F.monotonically_increasing_id()))


def _edge_rows(u: DataFrame) -> DataFrame:
    """``a, b, a_id, b_id``: normal forms that match each other. Pairs within the edits pass the threshold by
    their edits; those with a common rare token are scored."""
    shared = _shared_tokens(u, u).where("norm < other").distinct()
    tokens = _scored(shared, u, u).select(F.col("norm").alias("a"), F.col("other").alias("b"))
    for side in ("a", "b"):
        tokens = tokens.join(u.select(F.col("norm").alias(side), F.col("id").alias(f"{side}_id")).hint("merge"), side)
    return _self_edits(u).unionByName(tokens)


def name_edges(names: DataFrame) -> DataFrame:
    """Edges ``norm, other`` (norm the smaller) between normal forms that match each other."""
    return _edge_rows(_numbered_forms(names)).select(F.least("a", "b").alias("norm"), F.greatest("a", "b").alias("other")).distinct()


def connected_labels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``norm, label`` = smallest node of its component."""
    found = connected_components(edges, "norm", "other")
    own = nodes.select("norm").distinct()
    return own.join(found.hint("merge"), own["norm"] == found["id"], "left").select("norm", F.coalesce("component", "norm").alias("label"))


def consolidate_names(names: DataFrame) -> DataFrame:
    """``name -> master``: master = smallest normalised name of the cluster. The clusters are found on the
    numbers of the names; of the edges only as many as connect the names are exchanged."""
    u = _numbered_forms(names)
    edges = spanning_forest(_edge_rows(u).select(F.col("a_id").alias("norm"), F.col("b_id").alias("other")), "norm", "other")
    labels = connected_labels(u.select(F.col("id").alias("norm")), edges).select(F.col("norm").alias("id"), F.col("label").alias("_least"))
    masters = labels.join(u.select("id", "norm").hint("merge"), "id") \
        .join(u.select(F.col("id").alias("_least"), F.col("norm").alias("master")).hint("merge"), "_least").select("norm", "master")
    return names.select("name", "norm").join(masters.hint("merge"), "norm").select("name", "master")
