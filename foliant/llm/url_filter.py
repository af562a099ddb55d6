"""URL filter: host and path rules, then a list of URLs through a blocked Bloom filter.

1. Rules (``verdict, host, path``): a rule fits its host and all subdomains, where
   the url's path starts with the rule's; the longest rule that fits decides.
2. Other urls are looked up by their canonical form in a list of canonical URLs. The
   list's blocked Bloom filter is a table of blocks, eight 32-bit words each: a URL's
   hash chooses one block and one bit in each word, and ``bit_or`` by block builds it.
   Urls whose eight bits are all set are possible hits and go through an exact hash
   join with the list, which removes false positives; the others skip it.

The filter has ``BITS`` bits for each listed URL. Up to ``BROADCAST_BLOCKS`` blocks
(about 8 MB, counted before) it is broadcast; beyond, the urls are hash joined with
the blocks. Only built-in functions run.

The canonical form has the host (A-Z lower-cased, without ``www.``, without port 80 or
443), the path without trailing slashes, and the query without ``utm_*`` and ``ref``
parameters; scheme and fragment are dropped.

Defined results: null urls, and those without ``://``, have empty host and path, fit no
rule that names a host, and are on no list; rows that repeat a page_id or have none
are judged one by one; empty tables give an empty result, an empty list blocks
nothing; null urls of a list are ignored; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.llm.text import lower_az
from foliant.session import materialize, release

#: verdict, host, path
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
WORDS, BITS = 8, 12
BROADCAST_BLOCKS = 100_000
#: One odd factor for each word of a block; the product's top five bits choose the bit.
_FACTORS = [0x2F0B4C47 + 0x1B873594 * k | 1 for k in range(WORDS)]


def _rest(url: Column) -> Column:
    """What follows the first ``://`` (null and urls without it: empty)."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return lower_az(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """The canonical form of a url, null where it has no ``://``."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r":(80|443)\z", ""), r"^www\.", "")
    path = F.regexp_replace(path_of(url), r"/+\z", "")
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    query = F.regexp_replace(F.regexp_replace(query, r"(^|&)(utm_[^&=]*|ref)=[^&]*", ""), r"^&+", "")
    joined = F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))
    return F.when(F.locate("://", url) > 0, joined)


def _deciding(rules: list[tuple[str, str, str]], host: Column, path: Column) -> Column:
    """``rule, verdict`` of the longest rule that fits (null: none does)."""
    out = None
    for verdict, name, start in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        one = F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, one) if out is None else out.when(fits, one)
    return F.lit(None).cast("struct<rule:string,verdict:string>") if out is None else out


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.shiftright(F.xxhash64(url), 32), F.lit(blocks))


def _masks(url: Column) -> list[Column]:
    low = F.xxhash64(url).bitwiseAND(F.lit(0x7FFFFFFF))
    bits = [F.shiftright((low * F.lit(f)).bitwiseAND(F.lit(0xFFFFFFFF)), 27).cast("int") for f in _FACTORS]
    return [F.call_function("shiftleft", F.lit(1).cast("bigint"), bit) for bit in bits]


def bloom_blocks(listed: DataFrame, blocks: int) -> DataFrame:
    """``block, w0..w7`` of the distinct URLs ``url``; blocks without any are left out."""
    masks = [m.alias(f"m{k}") for k, m in enumerate(_masks(F.col("url")))]
    return listed.select(_block(F.col("url"), blocks).alias("block"), *masks).groupBy("block") \
        .agg(*[F.bit_or(f"m{k}").alias(f"w{k}") for k in range(WORDS)])


def with_possible(urls: DataFrame, bloom: DataFrame, blocks: int, broadcast: bool) -> DataFrame:
    """Rows of ``urls`` with ``possible``: all eight bits of their ``canonical_url`` are set."""
    url = F.col("canonical_url")
    probe = urls.withColumn("_block", _block(url, blocks))
    table = bloom.withColumnRenamed("block", "_block")
    both = probe.join(F.broadcast(table) if broadcast else table.hint("shuffle_hash"), "_block", "left")
    hit = reduce(lambda a, b: a & b, [F.col(f"w{k}").bitwiseAND(m) != 0 for k, m in enumerate(_masks(url))])
    return both.withColumn("possible", F.coalesce(hit, F.lit(False))).select(*urls.columns, "possible")


def url_filter(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]] = RULES,
               broadcast_blocks: int = BROADCAST_BLOCKS) -> DataFrame:
    """``page_id, host, path, rule, verdict, canonical_url`` of every row of ``pages``
    (``page_id, url``). ``listed``: the urls (``url``) to block where no rule decides."""
    cut = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                       canonical(F.col("url")).alias("canonical_url"))
    judged = materialize(cut.withColumn("_by", _deciding(rules, F.col("host"), F.col("path"))).select("*", "_by.*").drop("_by"))
    names = materialize(listed.select(canonical(F.col("url")).alias("url")).where("url is not null").distinct())
    blocks = max(1, -(-names.count() * BITS // (32 * WORDS)))
    is_open = F.col("rule").isNull() & F.col("canonical_url").isNotNull()
    probed = with_possible(judged.where(is_open), bloom_blocks(names, blocks), blocks, blocks <= broadcast_blocks)
    on_list = names.select(F.col("url").alias("canonical_url"), F.lit("block").alias("_listed")).hint("shuffle_hash")
    hits = probed.where("possible").drop("possible").join(on_list, "canonical_url", "left")
    others = judged.where(~is_open).unionByName(probed.where("not possible").drop("possible"))
    return others.withColumn("_listed", F.lit(None).cast("string")).unionByName(hits).select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", "_listed", F.lit("allow")).alias("verdict"), "canonical_url")


# -- query ----------------------------------------------------------------------

def broken_pages(pages: DataFrame) -> DataFrame:
    """The list of the registered query: urls of pages whose html is broken by runs of
    symbols, whatever other spelling of the url they stand under."""
    return pages.where(F.contains("html", F.lit("***")) & F.contains("html", F.lit("###"))).select("url")


SQL = r"""
WITH p AS (SELECT page_id, url, html, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
c AS (SELECT *, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*\?([^#]*)', 1) AS q FROM p),
k AS (SELECT *, regexp_replace(regexp_replace(q, '(^|&)(utm_[^&=]*|ref)=[^&]*', '', 'g'), '^&+', '') AS kept FROM c),
u AS (SELECT page_id, html, host, path, CASE WHEN contains(url, '://') THEN regexp_replace(regexp_replace(host, ':(80|443)\z', ''), '^www\.', '')
             || regexp_replace(path, '/+\z', '') || CASE WHEN kept <> '' THEN '?' || kept ELSE '' END END AS canonical_url FROM k),
listed AS (SELECT DISTINCT canonical_url AS url FROM u WHERE contains(html, '***') AND contains(html, '###') AND canonical_url IS NOT NULL),
r AS (SELECT page_id, host, path, canonical_url, CASE
        WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM u)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/de/', 'net/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' WHEN listed.url IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
       canonical_url
FROM r LEFT JOIN listed ON listed.url = r.canonical_url
"""
