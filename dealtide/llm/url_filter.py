"""URL filter: host rules first, then a list of URLs behind a blocked Bloom filter.

Everything is a DataFrame expression. A listed URL sets one bit in each of the eight
32-bit lanes of one block, so a probe reads one row of the filter. Possible hits go on
to an exact hash join with the list, which removes the false positives; all other rows
never meet the list.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealtide.llm.common import fold, table

# The rules of the query, as (verdict, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
# Host labels of the listed sites, and host labels that name no site of their own.
LISTED_LABELS = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
MIRRORS = "^(www|m|blog)[.]"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LANES = 8
_BITS_PER_KEY = 16
# A filter of more bytes than this is joined by its block number instead of broadcast.
BROADCAST_BYTES = 32 << 20


def parsed(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for null and for a URL without ``://``."""
    host = F.translate(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """One form of the addresses of a page: no mirror label, page suffix, closing slash, query or fragment."""
    return F.concat(F.regexp_replace(host, MIRRORS, ""), F.regexp_replace(path, "([.]html|/)$", ""))


def ruled(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Rule and verdict of the longest rule that fits host or superdomain and the start of the path."""
    rule = verdict = None
    for decision, site, start in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == site) | host.endswith("." + site)) & path.startswith(start)
        rule = F.when(fits, site + start) if rule is None else rule.when(fits, site + start)
        verdict = F.when(fits, decision) if verdict is None else verdict.when(fits, decision)
    return (F.lit(None).cast("string"), F.lit(None).cast("string")) if rule is None else (rule, verdict)


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("block")), F.lit(blocks))


def _masks(key: Column) -> list[Column]:
    """Of each lane the one bit that the key sets."""
    bits = F.xxhash64(key, F.lit("bits"))
    return [F.call_function("shiftleft", F.lit(1), F.shiftrightunsigned(bits, 5 * i).bitwiseAND(31).cast("int")) for i in range(_LANES)]


def bloom(listed: DataFrame, column: str, keys: int) -> tuple[DataFrame, int]:
    """The blocked filter (block, lane0 .. lane7) of a column, and its number of blocks."""
    blocks = max(1, -(-keys * _BITS_PER_KEY // (32 * _LANES)))
    key = F.col(column)
    rows = listed.select(_block(key, blocks).alias("block"), *[m.alias(f"m{i}") for i, m in enumerate(_masks(key))])
    return rows.groupBy("block").agg(*[F.bit_or(f"m{i}").alias(f"lane{i}") for i in range(_LANES)]), blocks


def maybe_listed(df: DataFrame, column: str, filter_rows: DataFrame, blocks: int) -> DataFrame:
    """``df`` with ``_maybe``: false only where the list surely lacks the key; a null key is not listed."""
    small = blocks * (8 + 4 * _LANES) <= BROADCAST_BYTES
    side = F.broadcast(filter_rows) if small else filter_rows
    hit = reduce(lambda a, b: a & b, [F.col(f"lane{i}").bitwiseAND(m) == m for i, m in enumerate(_masks(F.col(column)))])
    joined = df.join(side, _block(F.col(column), blocks) == F.col("block"), "left")
    return joined.select(*df.columns, F.coalesce(hit, F.lit(False)).alias("_maybe"))


def filter_urls(
    pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, keep: Sequence[str] = ("page_id",)
) -> DataFrame:
    """``keep``, host, path, canonical, rule, verdict and listed of every page row.

    ``listed`` has a column ``canonical``; repeated and null entries are allowed. The verdict
    is the rule's, else ``block`` for a listed URL, else ``allow``. A null URL, or one without
    ``://``, has an empty host and path and is allowed unless the empty URL is listed. Repeated
    page rows stay apart; other columns of ``pages`` are ignored. Empty tables give no rows,
    and an empty list lists nothing.
    """
    keys = fold(listed.select("canonical").where("canonical IS NOT NULL").distinct(), "listed")
    count = keys.count()
    host, path = parsed(F.col("url"))
    rows = pages.select(*keep, host.alias("host"), path.alias("path"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", canonical(F.col("host"), F.col("path")).alias("canonical"), rule.alias("rule"), verdict.alias("_ruled"))
    filter_rows, blocks = bloom(keys, "canonical", count)
    probed = maybe_listed(rows, "canonical", filter_rows, blocks)
    exact = keys.withColumn("_in", F.lit(True)).hint("shuffle_hash")
    # a hot URL is many probing rows with one listed key: AQE splits that side
    hits = probed.where("_maybe").join(exact, "canonical", "left").select(*probed.columns, "_in")
    rest = probed.where("NOT _maybe").withColumn("_in", F.lit(False))
    found = F.coalesce(F.col("_in"), F.lit(False))
    listed_verdict = F.when(found, "block").otherwise("allow")
    return hits.unionByName(rest).select(
        *keep, "host", "path", "canonical", "rule", F.coalesce("_ruled", listed_verdict).alias("verdict"), found.alias("listed")
    )


def listed_sites(pages: DataFrame, labels: Sequence[str] = LISTED_LABELS) -> DataFrame:
    """The URLs of the table that lie on a listed site, in canonical form."""
    host, path = parsed(F.col("url"))
    site = F.regexp_replace(host, MIRRORS, "")
    return pages.where(F.substring_index(site, ".", 1).isin(*labels)).select(canonical(host, path).alias("canonical"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return filter_urls(pages, listed_sites(pages)).select("page_id", "host", "path", "rule", "verdict")


SQL = r"""
WITH parsed AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
named AS (
  SELECT *, regexp_replace(host, '^(www|m|blog)[.]', '') AS site,
    regexp_replace(host, '^(www|m|blog)[.]', '') || regexp_replace(path, '([.]html|/)$', '') AS canonical,
    CASE WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
         WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
         WHEN (host = 'org' OR suffix(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
         WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parsed),
listed AS (
  SELECT DISTINCT canonical FROM named
  WHERE split_part(site, '.', 1) IN ('adult-x', 'ads-track', 'casino-win', 'cheap-pills', 'free-bets', 'spam-farm'))
SELECT page_id, host, path, rule,
  CASE rule WHEN 'example.net/en/' THEN 'allow' WHEN 'example.com/de/' THEN 'block' WHEN 'org/fr/' THEN 'allow'
    WHEN 'net/' THEN 'block'
    ELSE CASE WHEN canonical IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END END AS verdict
FROM named
"""
