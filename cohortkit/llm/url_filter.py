"""URL filter: host and path rules, then a list of canonical URLs behind a blocked Bloom filter.

The filter is a table of 256-bit blocks, four words each, made by ``bit_or``
over the listed URLs of a block. A URL reads one block and passes when all its
bits are set there. Only URLs that pass go on to the exact hash join with the
list, which removes the false positives. All of it is DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import checked_broadcast
from . import common

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The rules of the query, and the names that mark the hosts whose pages it lists.
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
LISTED_HOSTS = ["spam-farm", "cheap-pills", "casino", "click-bait", "malware"]

_BITS_PER_KEY, _HASHES, _BLOCK_BITS = 16, 6, 256


def host(url: Column) -> Column:
    """After the first ://, up to /, ?, # or the end, A-Z lower-cased; empty for null or without ://."""
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """One spelling for URLs that name the same page: no scheme, default port,
    ``www.``, fragment, tracking parameters or closing slash, parameters
    sorted. Null when there is no host."""
    name = F.regexp_replace(F.regexp_replace(host(url), ":(80|443)?$", ""), r"^www\.", "")
    params = F.split(F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1), "&")
    kept = F.sort_array(F.filter(params, lambda p: (p != "") & ~p.rlike("^(utm_[a-z]+|ref|gclid|fbclid)(=|$)")))
    query = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(host(url) != "", F.concat(name, F.regexp_replace(path(url), "/+$", ""), query))


def rule_of(host_col: Column, path_col: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule ``host/path`` that fits the host or a subdomain of it, and the path's start; else null."""
    out = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host_col == name) | host_col.endswith("." + name)) & path_col.startswith(slash + rest)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def _masks(url: Column) -> list[Column]:
    """The four words of the URL's bits."""
    h = F.xxhash64(url, F.lit(2))
    bits = [F.shiftrightunsigned(h, 8 * i).bitwiseAND(F.lit(_BLOCK_BITS - 1)).cast("int") for i in range(_HASHES)]
    words = []
    for w in range(_BLOCK_BITS // 64):
        word = F.lit(0).cast("long")
        for b in bits:
            one = F.call_function("shiftleft", F.lit(1).cast("long"), b.bitwiseAND(F.lit(63)))
            word = word.bitwiseOR(F.when(F.shiftright(b, 6) == w, one).otherwise(F.lit(0).cast("long")))
        words.append(word)
    return words


def _block(url: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(url, F.lit(1)), F.lit(n_blocks).cast("long"))


def bloom_blocks(listed: DataFrame, n_blocks: int) -> DataFrame:
    """(block, w0..w3) of the column ``canonical``."""
    rows = listed.select(_block(F.col("canonical"), n_blocks).alias("block"),
                         *[m.alias(f"w{i}") for i, m in enumerate(_masks(F.col("canonical")))])
    return rows.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(4)])


def filter_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str]] = (), id_col: str = "page_id",
                url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict, maybe_listed) per row of ``pages``.

    ``listed`` has the URLs to block in its column ``url``. A rule decides
    where one fits; else a URL is blocked if its canonical form is listed, and
    allowed if not. Null urls and urls without :// have an empty host and
    path, fit no rule and are never listed; repeated rows are each judged, an
    empty list blocks nothing, an empty table gives no row, other columns are
    not read.
    """
    listed = listed.select(canonical(F.col("url")).alias("canonical")).dropna().distinct()
    n_blocks = max(1, -(-listed.count() * _BITS_PER_KEY // _BLOCK_BITS))
    blocks = bloom_blocks(listed, n_blocks)
    url = F.col(url_col)
    rows = (pages.select(F.col(id_col), host(url).alias("host"), path(url).alias("path"),
                         canonical(url).alias("canonical"))
            .withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
            .withColumn("canonical", F.when(F.col("rule").isNull(), F.col("canonical"))))
    probe = F.coalesce(F.col("canonical"), F.concat_ws(" ", F.lit(""), F.col("host"), F.col("path")))
    rows = rows.withColumn("block", _block(probe, n_blocks))  # spread also where there is nothing to look up
    inside = [F.col(f"w{i}").bitwiseAND(m) == m for i, m in enumerate(_masks(F.col("canonical")))]
    seen = (rows.join(checked_broadcast(blocks), "block", "left")
            .withColumn("maybe_listed", F.coalesce(inside[0] & inside[1] & inside[2] & inside[3], F.lit(False))))
    hits = seen.filter("maybe_listed").join(listed.withColumn("exact", F.lit(True)), "canonical", "left")
    out = hits.unionByName(seen.filter("NOT maybe_listed").withColumn("exact", F.lit(None).cast("boolean")))
    blocked_rules = [r for action, r in rules if action == "block"]
    verdict = (F.when(F.col("rule").isNotNull(), F.col("rule").isin(blocked_rules))
               .otherwise(F.col("exact").isNotNull()))
    return out.select(id_col, "host", "path", "rule", F.when(verdict, "block").otherwise("allow").alias("verdict"),
                      "maybe_listed")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict; listed are the URLs of hosts under a name of LISTED_HOSTS."""
    pages = common.table(spark, sf_dir, "pages")
    name = "(^|[.])(" + "|".join(LISTED_HOSTS) + ")[.]"
    return filter_urls(pages, pages.filter(host(F.col("url")).rlike(name)).select("url"), RULES)
