"""URL filters: a blocked Bloom filter of listed keys in front of an exact hash join.

Listed are canonical URLs and rules (host and path prefix). A rule fits a host and its subdomains, so a
URL is looked up under every suffix of its host with every path prefix that has the length of some rule's
path, and once under its canonical form. Each key sets one bit in each of the eight lanes of one block;
a lookup touches one block. What passes may be a false positive, so it goes on to a hash join with the
listed keys themselves. DataFrame expressions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import keep
from .common import begin, lower_ascii

LANES = 8
BLOCK_BYTES = 8 * (LANES + 1)
SEND_BYTES = 32 << 20  # a side of a join is broadcast only if its measured size is below this


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, "://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host without a leading www. or m., path without a trailing slash or ``.html``."""
    return F.concat(F.regexp_replace(host, "^(www|m)[.]", ""), F.regexp_replace(path, "(/|[.]html)$", ""))


def _lane_bits(key: Column) -> list:
    h = F.xxhash64(key, F.lit(1))
    return [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(h, 5 * j).bitwiseAND(F.lit(31)).cast("int")) for j in range(LANES)]


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def bloom_blocks(keys: DataFrame, blocks: int) -> DataFrame:
    """``(block, lane0 .. lane7)`` of the keys in column ``key``."""
    bits = _lane_bits(F.col("key"))
    return keys.groupBy(_block(F.col("key"), blocks).alias("block")).agg(*[F.bit_or(b).alias(f"lane{j}") for j, b in enumerate(bits)])


def may_contain(probes: DataFrame, bloom: DataFrame, blocks: int) -> DataFrame:
    """The rows of ``probes`` whose ``key`` may be in the filter."""
    side = F.broadcast(bloom) if blocks * BLOCK_BYTES <= SEND_BYTES else bloom
    ok = None
    for j, b in enumerate(_lane_bits(F.col("key"))):
        test = F.col(f"lane{j}").bitwiseAND(b) != 0
        ok = test if ok is None else ok & test
    found = probes.withColumn("block", _block(F.col("key"), blocks)).join(side, "block").where(ok)
    return found.drop("block", *[f"lane{j}" for j in range(LANES)])


def judge(pages: DataFrame, listed: DataFrame, rules: list, id_col: str = "page_id", url_col: str = "url",
          bits_per_key: int = 16) -> DataFrame:
    """``(id, host, path, rule, verdict, listed)`` of every row.

    ``rules``: (verdict, host, path prefix); ``listed``: canonical URLs to block, in column ``canon``. The
    longest fitting rule decides (on equal lengths the longer host); without a
    rule a listed URL is blocked and any other allowed. A null URL, or one without ``://``, has empty host and
    path and is allowed unless listed so. Repeated rows and null ids stay; other columns are not read; an
    empty table gives an empty result. Every distinct URL is looked up once."""
    begin(pages.sparkSession)
    spark = pages.sparkSession
    lengths = sorted({len(p) for _, _, p in rules})
    rule_rows = [(f"r:{h}{p}", f"{h}{p}", v, len(h + p), len(h)) for v, h, p in rules]
    schema = "key string, rule string, verdict string, length int, host_length int"
    none = [F.lit(None).cast(t) for t in ("string", "int", "int")]
    entries = keep(spark.createDataFrame(rule_rows, schema).unionByName(
        listed.where(F.col("canon").isNotNull()).select(F.concat(F.lit("u:"), "canon").alias("key")).distinct()
        .select("key", none[0].alias("rule"), F.lit("block").alias("verdict"), none[1].alias("length"), none[2].alias("host_length"))))
    n, size = entries.agg(F.count(F.lit(1)), F.sum(F.octet_length("key") + 64)).first()
    blocks = max(1, math.ceil(n * bits_per_key / (32 * LANES)))
    bloom = bloom_blocks(entries.select("key"), blocks)

    url = F.col("url")
    urls = (pages.select(F.col(url_col).alias("url")).where(url.isNotNull()).distinct()
            .select("url", host_of(url).alias("host"), path_of(url).alias("path")))
    labels = F.split("host", "[.]")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.filter(F.array(*[F.when(F.length("path") >= k, F.substring("path", 1, k)) for k in lengths]), lambda p: p.isNotNull())
    rule_keys = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(F.lit("r:"), s, p))))
    keys = F.array_append(rule_keys, F.concat(F.lit("u:"), canonical(F.col("host"), F.col("path"))))
    probes = urls.select("url", F.explode(F.array_distinct(keys)).alias("key"))
    exact = F.broadcast(entries) if (size or 0) <= SEND_BYTES else entries.hint("shuffle_hash")
    hits = may_contain(probes, bloom, blocks).join(exact, "key")
    rank = F.struct("length", "host_length")
    best = hits.groupBy("url").agg(
        F.max_by(F.struct("rule", "verdict"), F.when(F.col("rule").isNotNull(), rank)).alias("best"),
        F.bool_or(F.col("rule").isNull()).alias("listed"))
    out = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("url")).join(best, "url", "left")
    hit = F.coalesce("listed", F.lit(False))
    verdict = F.coalesce(F.col("best.verdict"), F.when(hit, "block").otherwise("allow"))
    return out.select(F.col("_id").alias(id_col), host_of(url).alias("host"), path_of(url).alias("path"),
                      F.col("best.rule").alias("rule"), verdict.alias("verdict"), hit.alias("listed"))


def canonical_urls(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Distinct canonical URLs ``(canon)`` of a table of raw URLs."""
    u = F.col(url_col)
    return pages.where(u.isNotNull()).select(canonical(host_of(u), path_of(u)).alias("canon")).distinct()
