"""URL rules through a blocked Bloom filter and an exact join, on DataFrame operations only.

A rule is a canonical URL start: a host, which stands for its subdomains too, and a
path prefix.  A URL is probed under each of its host suffixes and path prefixes whose
size some rule has.  A probe first meets the filter, where each listed key sets one
bit in each lane of a single block; the few probes that pass are joined exactly to the
list, which removes the false positives.  The longest fitting rule decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelens.llm.store import columns_first

LANES = 4  # 64-bit words of a block; a key sets one bit in each
KEYS_PER_BLOCK = 16  # 16 bits per key: about one probe in 1,000 passes wrongly
BROADCAST_BLOCKS = 1 << 20  # a filter of up to 1M blocks (40 MB) is sent to all tasks, a larger one is joined
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.char_length(raw) + 1, F.char_length(rest)), r"^[^?#]*", 0)
    return F.translate(F.coalesce(raw, F.lit("")), _UPPER, _LOWER), F.coalesce(path, F.lit(""))


def _block(key_hash: Column, blocks: int) -> Column:
    return F.pmod(F.shiftright(key_hash, 24), F.lit(blocks)).cast("int")


def _bit(key_hash: Column, lane: int) -> Column:
    """The bit of one lane: six bits of the hash that the block does not use."""
    place = F.shiftrightunsigned(key_hash, 6 * lane).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def bloom_blocks(keys: DataFrame, blocks: int) -> DataFrame:
    """(block, lane0, lane1, ...) of the keys' hashes ``h``; blocks without a key are left out."""
    return keys.groupBy(_block(F.col("h"), blocks).alias("block")).agg(
        *[F.bit_or(_bit(F.col("h"), j)).alias(f"lane{j}") for j in range(LANES)])


def judge_urls(spark: SparkSession, pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """(id, host, path, rule, verdict) of every row of ``pages``; ``rules``: (host, path, verdict).

    A rule fits its host and all subdomains if the URL's path starts with the rule's.  The
    longest fitting rule (host and path together) decides; of equally long ones, block wins,
    then the one that sorts first.  ``rule`` is its host and path, null if none fits, and
    then the verdict is ``default``: the URL is not listed.

    Null URL, or one without ``://``: empty host and path, which no rule fits.  Null and
    repeated ids are passed through.  Other columns are ignored.  Rules with a null are
    ignored, repeated rules count once.  An empty table gives no rows; without rules every
    URL gets ``default``.
    """
    listed = columns_first(rules, host="host", path="path", verdict="verdict").dropna().distinct() \
        .select(F.concat("host", "path").alias("key"), F.size(F.split("host", r"\.")).alias("labels"),
                F.char_length("path").alias("prefix"), "verdict").withColumn("h", F.xxhash64("key"))
    # Sizes that some rule has: at most as many as a host has labels and a path characters.
    sizes = listed.agg(F.count("*").alias("n"), F.array_sort(F.collect_set("labels")).alias("labels"),
                       F.array_sort(F.collect_set("prefix")).alias("prefixes")).first()
    blocks = 1 << max(0, (max(sizes["n"], 1) // KEYS_PER_BLOCK).bit_length())
    bloom = bloom_blocks(listed, blocks)
    if blocks <= BROADCAST_BLOCKS:
        bloom = F.broadcast(bloom)

    host, path = host_and_path(F.col("url"))
    rows = columns_first(pages, id=id_col, url=url_col).withColumn("url", F.col("url").cast("string"))
    urls = rows.where("url is not null").select("url").distinct() \
        .select("url", host.alias("host"), path.alias("path")).where("host <> ''")
    no_size = F.array().cast("array<int>")
    labels = F.array(*[F.lit(x) for x in sizes["labels"]]) if sizes["labels"] else no_size
    prefixes = F.array(*[F.lit(x) for x in sizes["prefixes"]]) if sizes["prefixes"] else no_size
    probes = urls.withColumn("k", F.explode(F.filter(labels, lambda x: x <= F.size(F.split("host", r"\."))))) \
        .withColumn("l", F.explode(F.filter(prefixes, lambda x: x <= F.char_length("path")))) \
        .select("url", F.concat(F.expr("substring_index(host, '.', -k)"), F.expr("substring(path, 1, l)")).alias("key")) \
        .withColumn("h", F.xxhash64("key")).withColumn("block", _block(F.col("h"), blocks))
    passed = probes.join(bloom, "block")
    for j in range(LANES):
        passed = passed.where(F.col(f"lane{j}").bitwiseAND(_bit(F.col("h"), j)) != 0)
    hits = passed.select("url", "key").join(listed.select("key", "verdict"), "key")
    best = hits.groupBy("url").agg(F.min(F.struct(
        (-F.char_length("key")).alias("shorter"), (F.col("verdict") != "block").alias("mild"), "key", "verdict")).alias("best"))
    return rows.join(best, "url", "left").select(
        F.col("id").alias(id_col), host.alias("host"), path.alias("path"), F.col("best.key").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
