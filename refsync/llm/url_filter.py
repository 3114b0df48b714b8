"""URL filter: a blocked Bloom filter of listed canonical URLs, then an exact hash join of the possible hits.

The filter is a table of 256-bit blocks (block, eight 32-bit words). A canonical URL sets one bit in each word of the
block that its hash picks, so a test reads one row. Blocks are built by a bitwise-or aggregate that combines before the
shuffle. The block table is broadcast only if its size, known from the number of blocks, is below a bound; otherwise it
is joined by block number. Rows that miss a bit are certainly not listed and skip the join; the others are joined with the
listed URLs exactly, which removes the
false positives. All of it is DataFrame expressions.

Host and path rules come first: a rule fits its host and all subdomains if the URL's path starts with the rule's path;
the longest fitting rule decides. Only where no rule fits does the list decide.

Nulls: a null URL, or one without `://`, has empty host and path, fits no rule and is not listed: verdict `allow`.
Repeated rows are judged one by one; an empty table gives an empty result; other columns of the table are kept unless
they have the name of an output column, which then wins. A null in the list is ignored, an empty list blocks nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refsync.sources.storage import stage

WORDS = 8
BITS_PER_URL = 16  # a false positive rate of about 0.1 %
BLOCK_BYTES = 48
BROADCAST_BYTES = 64 << 20

#: (host, path, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: First host labels (without www., m. and blog.) whose pages make up the sample list.
LISTED_HOSTS = ("free-bets", "cheap-pills", "spam-farm", "ads-track")


def _ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _rest(url: Column) -> Column:
    """What follows the first `://`; null without one."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url)))


def host_of(url: Column) -> Column:
    """From after `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://`."""
    return F.coalesce(_ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to `?`, `#` or the end; empty without `://`."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without `www.`, path without a last `/`; scheme, query and fragment dropped; null without a host."""
    host = F.regexp_replace(host_of(url), r"^www\.", "")
    return F.nullif(F.concat(host, F.regexp_replace(path_of(url), r"/+$", "")), F.lit(""))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).alias("block")


def _bit(key: Column, word: int) -> Column:
    """The bit of a word that a key sets, from a second hash."""
    return F.call_function("shiftleft", F.lit(1), F.pmod(F.xxhash64(F.lit(word + 1), key), F.lit(32)).cast("int"))


def bloom_blocks(listed: DataFrame, blocks: int) -> DataFrame:
    """(block, w0 .. w7) of the listed keys in column `canonical`."""
    key = F.col("canonical")
    words = listed.select(_block(key, blocks), *[_bit(key, i).alias(f"w{i}") for i in range(WORDS)])
    return words.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def filter_urls(
    pages: DataFrame,
    listed_urls: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    url: str = "url",
    bits_per_url: int = BITS_PER_URL,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """`pages` with host, path, rule, verdict, and `maybe_listed` (the filter's answer) and `listed` (the join's).

    `listed_urls` has the listed URLs in its first column, in any spelling.
    """
    spark: SparkSession = pages.sparkSession
    source = F.col(listed_urls.columns[0])
    listed = stage(listed_urls.select(canonical(source).alias("canonical")).filter("canonical IS NOT NULL").distinct(), "listed-urls")
    blocks = max(1, -(-listed.count() * bits_per_url // (32 * WORDS)))
    bloom = bloom_blocks(listed, blocks)
    if blocks * BLOCK_BYTES <= broadcast_bytes:
        bloom = F.broadcast(bloom)

    outputs = {"host", "path", "rule", "verdict", "maybe_listed", "listed"}
    clash = {"canonical", "block", *[f"w{i}" for i in range(WORDS)], "listed_url"} & set(pages.columns)
    if clash:  # names this plan needs for itself
        pages = pages.withColumnsRenamed({c: f"__own_{c}" for c in clash})
        url = f"__own_{url}" if url in clash else url
    kept = [c for c in pages.columns if c not in outputs]
    of = F.col(url) if url in kept else None
    if of is None:
        pages, of = pages.withColumnRenamed(url, "__own_url"), F.col("__own_url")
    host, path = F.col("host"), F.col("path")
    judged = pages.select(*kept, host_of(of).alias("host"), path_of(of).alias("path"), canonical(of).alias("canonical"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, says in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):  # the longest ends outermost
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        rule, verdict = F.when(fits, F.lit(rule_host + rule_path)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    judged = judged.withColumns({"rule": rule, "by_rule": verdict, "block": F.when(F.col("canonical").isNotNull(), _block(F.col("canonical"), blocks))})

    hit = F.lit(True)
    for i in range(WORDS):
        bit = _bit(F.col("canonical"), i)
        hit = hit & (F.col(f"w{i}").bitwiseAND(bit) == bit)
    tested = judged.join(bloom, "block", "left").withColumn("maybe_listed", F.coalesce(hit, F.lit(False)))
    tested = tested.drop("block", *[f"w{i}" for i in range(WORDS)])
    missed = tested.filter(~F.col("maybe_listed")).withColumn("listed", F.lit(False))
    exact = tested.filter("maybe_listed").join(listed.select(F.col("canonical").alias("listed_url")), F.col("canonical") == F.col("listed_url"), "left")
    hits = exact.withColumn("listed", F.col("listed_url").isNotNull()).drop("listed_url")
    says = F.coalesce("by_rule", F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow")))
    result = hits.unionByName(missed).select(*kept, "host", "path", "rule", says.alias("verdict"), "maybe_listed", "listed")
    return result.withColumnsRenamed({f"__own_{c}": c for c in clash})


def sample_list(pages: DataFrame) -> DataFrame:
    """URLs of the pages on hosts known for spam: the list of the query."""
    label = F.regexp_extract(host_of(F.col("url")), r"^(?:www\.|m\.|blog\.)?([^.]*)", 1)
    return pages.filter(label.isin(*LISTED_HOSTS)).select("url")


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the rules, then by the list."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return filter_urls(pages, sample_list(pages)).select("page_id", "host", "path", "rule", "verdict", "listed")


_HOST = "coalesce(translate(CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*') END, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '')"
_PATH = "coalesce(CASE WHEN strpos(url, '://') > 0 THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) END, '')"
SQL = {
    "op7_url_filters": f"""
WITH parts AS (SELECT page_id, {_HOST} AS host, {_PATH} AS path FROM pages),
keyed AS (SELECT *, nullif(regexp_replace(host, '^www\\.', '') || regexp_replace(path, '/+$', ''), '') AS canonical FROM parts),
listed AS (
  SELECT DISTINCT canonical FROM keyed
  WHERE regexp_extract(host, '^(?:www\\.|m\\.|blog\\.)?([^.]*)', 1) IN ('free-bets', 'cheap-pills', 'spam-farm', 'ads-track')),
judged AS (
  SELECT keyed.*, listed.canonical IS NOT NULL AS listed,
    CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
         WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
         WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
         WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
  FROM keyed LEFT JOIN listed ON keyed.canonical = listed.canonical)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
       WHEN listed THEN 'block' ELSE 'allow' END AS verdict, listed
FROM judged""",
}
QUERIES = {"op7_url_filters": op7_url_filters}
