"""URL filters: a blocked Bloom filter of the listed canonical URLs passes possible hits to an exact join.

The filter is a table of blocks of four 64-bit words.  A URL's first hash chooses the block, its second one bit in each
word; blocks are made by a bit_or aggregate, which Spark combines before the shuffle.  Its size follows from the number
of listed URLs (about 16 bits each), so it is known before it is used: up to ``BROADCAST_BYTES`` it is broadcast, beyond
that it is joined by block.  Possible hits are joined with the list by the canonical URL itself, which removes the false
positives.  A list of at most ``BROADCAST_ROWS`` URLs of ``BROADCAST_CHARS`` characters in all is broadcast (it is counted
first), so that join moves no row; with a longer one only possible hits are shuffled for it, and all other rows pass it by.

Rules (host, path) come first: a rule fits its host and all subdomains, for paths that start with the rule's; the
longest rule wins, of equally long ones a blocking one.  A null URL, or one without ``://``, has empty host and path, and
is never listed; such rows are spread over blocks that the filter doesn't have.  Null and repeated list entries count once
or not at all; an empty list blocks nothing.  Repeated rows are judged each.  Columns may have any names: one in keep that is
named like a column of the result is left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, masked, table

BROADCAST_BYTES = 8 << 20
BLOCK_BYTES = 40
BROADCAST_ROWS, BROADCAST_CHARS = 1 << 17, 8 << 20
NULL_SPREAD = 1024
# The rules that the query's contract names (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise("")


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without a leading www., then the path without slashes at its end; null without a host.  Scheme, query and fragment don't count."""
    name = F.regexp_replace(host(url), r"^www\.", "")
    return F.when(name != "", F.concat(name, F.regexp_replace(path(url), r"/+$", "")))


def _marks(url: Column) -> list[Column]:
    second = F.xxhash64(F.lit(7), url)
    return [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(second, 6 * j).bitwiseAND(F.lit(63)).cast("int")) for j in range(4)]


def bloom(listed: DataFrame, url: str, count: int) -> tuple[DataFrame, int]:
    """The filter's blocks (block, w0..w3) and how many bits choose a block."""
    bits = max(4, (max(1, count) * 16 // 256).bit_length())
    marks = _marks(F.col(url))
    rows = listed.select(F.shiftrightunsigned(F.xxhash64(url), 64 - bits).alias("block"), *[m.alias(f"w{j}") for j, m in enumerate(marks)])
    return rows.groupBy("block").agg(*[F.bit_or(f"w{j}").alias(f"w{j}") for j in range(4)]), bits


def listed_rows(df: DataFrame, url: str, listed: DataFrame, listed_url: str) -> DataFrame:
    """df with a boolean column ``listed``: whether the canonical URL in column url stands in listed."""
    entries = cut(listed.select(F.col(listed_url).alias("__entry")).filter("__entry is not null").distinct())
    size = entries.agg(F.count("*").alias("n"), F.sum(F.length("__entry")).alias("chars")).first()
    filter_rows, bits = bloom(entries, "__entry", size["n"])
    filter_rows = filter_rows.toDF("__block", *[f"__w{j}" for j in range(4)])
    if (BLOCK_BYTES << bits) <= BROADCAST_BYTES:
        filter_rows = F.broadcast(filter_rows)
    named, c = masked(df)
    own = c[url]
    nowhere = -1 - F.pmod(F.xxhash64(*c.values()), F.lit(NULL_SPREAD))
    probe = named.withColumn("__block", F.when(F.col(own).isNull(), nowhere).otherwise(F.shiftrightunsigned(F.xxhash64(own), 64 - bits)))
    possible = F.lit(True)
    for j, m in enumerate(_marks(F.col(own))):
        possible = possible & (F.col(f"__w{j}").bitwiseAND(m) == m)
    tried = probe.join(filter_rows, "__block", "left").withColumn("__maybe", F.col(own).isNotNull() & F.coalesce(possible, F.lit(False)))
    tried = tried.select(*c.values(), "__maybe")
    same = F.col(own) == F.col("__entry")
    if size["n"] <= BROADCAST_ROWS and (size["chars"] or 0) <= BROADCAST_CHARS:
        out = tried.join(F.broadcast(entries), same & F.col("__maybe"), "left").select(*c.values(), F.col("__entry").isNotNull())
    else:
        exact = tried.filter("__maybe").join(entries, same, "left").select(*c.values(), F.col("__entry").isNotNull().alias("__listed"))
        out = exact.unionByName(tried.filter("not __maybe").select(*c.values(), F.lit(False).alias("__listed")))
    return out.toDF(*df.columns, "listed")


def judge(df: DataFrame, listed: DataFrame, *, url_col: str = "url", listed_col: str = "canonical", rules: Sequence[tuple[str, str, str]] = RULES, keep: Sequence[str] = ()) -> DataFrame:
    """The columns in keep, host, path, rule, verdict and listed, for each row of df.  listed holds canonical URLs."""
    keep = [k for k in keep if k not in ("host", "path", "rule", "verdict", "listed")]
    inner = {f"__k{i}": k for i, k in enumerate(keep)}
    own = F.col(url_col)
    parts = df.select(*[F.col(k).alias(x) for x, k in inner.items()], host(own).alias("host"), path(own).alias("path"), canonical(own).alias("__canonical"))
    rows = listed_rows(parts, "__canonical", listed, listed_col)
    rule, verdict = F.lit(None).cast("string"), F.when(F.col("listed"), "block").otherwise("allow")
    for what, name, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "block", r[1] + r[2])):  # the last one set wins
        fits = ((F.col("host") == name) | F.col("host").endswith("." + name)) & F.col("path").startswith(start)
        rule, verdict = F.when(fits, name + start).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rows.select(*[F.col(x).alias(k) for x, k in inner.items()], "host", "path", rule.alias("rule"), verdict.alias("verdict"), "listed")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list stands in for a blocklist: the canonical URLs of pages whose MD5 starts with a zero byte (one in 256)."""
    pages = table(spark, sf_dir, "pages")
    listed = pages.select(canonical(F.col("url")).alias("canonical")).filter(F.md5(F.col("canonical").cast("binary")).startswith("00"))
    return judge(pages, listed, keep=("page_id",))


QUERIES = {"op9_url_filter": op9_url_filter}
ORACLE = {
    "op9_url_filter": r"""
WITH rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
canon AS (SELECT *, CASE WHEN regexp_replace(host, '^www\.', '') <> '' THEN regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '') END AS c FROM parts),
listing AS (SELECT DISTINCT c FROM canon WHERE md5(c) LIKE '00%'),
rules(what, name, start) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fits AS (SELECT page_id, c, what, name || start AS rule,
                row_number() OVER (PARTITION BY page_id ORDER BY length(name || start) DESC, what DESC, name || start DESC) AS k
         FROM canon JOIN rules ON (host = name OR host LIKE '%.' || name) AND starts_with(path, start)),
best AS (SELECT page_id, rule, what FROM fits WHERE k = 1)
SELECT canon.page_id, canon.host, canon.path, best.rule,
       coalesce(best.what, CASE WHEN listing.c IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, listing.c IS NOT NULL AS listed
FROM canon LEFT JOIN best ON canon.page_id = best.page_id LEFT JOIN listing ON canon.c = listing.c
"""
}
