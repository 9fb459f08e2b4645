"""URL filters: a blocked Bloom filter of listed canonical URLs, then an exact hash join.

A listed URL (host and path prefix) fits its host and all subdomains, if a url's path starts with its
path. What can fit a url are pairs of a host suffix and a path prefix; only the shapes (labels, path
length) that the list has are made. Each distinct (host, path head) is judged once. The filter has one
row of four 64-bit words per block; a key hashes to one block and to one bit in each word. Blocks are
limited to `MAX_BLOCKS` (2.5 MB), so the filter can be broadcast whatever the size of the list: a
longer list only lets more false hits through, and the exact join removes them all. Of several listed
URLs that fit, the longest wins (of equal lengths, the longer host).

Only DataFrame functions are used. Defined cases: a null url, or one without `://`, has an empty host and
path; a listed URL with a null or empty host is ignored, a null path counts as empty; of doubled
entries with different verdicts, `block` wins; with an empty list every url gets the default. Repeated
and extra columns of the input stay; columns named like an added one are replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wareflow.llm.arrays import quoted, set_aside

MAX_BLOCKS = 1 << 16
KEYS_PER_BLOCK = 16
_WORDS = ("w0", "w1", "w2", "w3")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _key(host: Column, path: Column) -> Column:
    return F.xxhash64(host, path)


def _bits(key: Column) -> list[Column]:
    """One bit for each word of a block, from parts of the hash that do not choose the block."""
    return [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(key, 16 + 6 * i).bitwiseAND(63).cast("int")) for i in range(len(_WORDS))]


def bloom_blocks(keys: DataFrame, blocks: int) -> DataFrame:
    """(block, w0..w3): the filter of the column `key`."""
    placed = keys.select(F.pmod("key", F.lit(blocks)).alias("block"), *[b.alias(w) for b, w in zip(_bits(F.col("key")), _WORDS, strict=True)])
    return placed.groupBy("block").agg(*[F.bit_or(w).alias(w) for w in _WORDS])


def passing(rows: DataFrame, keys: DataFrame, blocks: int) -> DataFrame:
    """`rows` whose `key` may be among `keys`; every one that is passes. The filter has `blocks` rows at most."""
    bloom = F.broadcast(bloom_blocks(keys, blocks))
    set_bits = reduce(lambda a, b: a & b, [F.col(w).bitwiseAND(b) != 0 for w, b in zip(_WORDS, _bits(F.col("key")), strict=True)])
    return rows.withColumn("block", F.pmod("key", F.lit(blocks))).join(bloom, "block").where(set_bits)


def listed_urls(rules: DataFrame) -> DataFrame:
    """(host, path, verdict, labels, path_length, key), each listed URL once."""
    named = rules.select(ascii_lower(F.col("host")).alias("host"), F.coalesce(F.col("path"), F.lit("")).alias("path"), "verdict").where("host <> ''")
    once = named.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # 'block' after 'allow'
    return once.withColumns({"labels": F.size(F.split("host", r"\.")), "path_length": F.char_length("path"), "key": _key(F.col("host"), F.col("path"))})


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """`pages` with host, path, rule (host and path of the longest that fits, else null) and verdict.

    `rules` has host, path and verdict (allow or block).
    """
    listed = listed_urls(rules)
    # shapes are at most (labels of a host) x (lengths of a path) rows
    size = listed.agg(F.count("*").alias("n"), F.collect_set(F.struct("labels", "path_length")).alias("shapes")).first()
    added = ("host", "path", "rule", "verdict")
    kept = [c for c in pages.columns if c.lower() not in added]
    given, names = set_aside(pages)
    own = [F.col(names[c]).alias(c) for c in kept]
    split = given.select(*[names[c] for c in kept], url_host(F.col(names[url])).alias("host"), url_path(F.col(names[url])).alias("path"))
    if not size["n"]:
        return split.select(*own, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    longest = max(s["path_length"] for s in size["shapes"])
    head = F.substring("path", 1, longest)
    heads = split.select(F.col("host"), head.alias("head")).distinct()

    labels = F.split("host", r"\.")
    options = [
        F.when(
            (F.size("labels") >= s["labels"]) & (F.char_length("head") >= s["path_length"]),
            F.struct(F.array_join(F.slice("labels", -s["labels"], s["labels"]), ".").alias("host"), F.substring("head", 1, s["path_length"]).alias("path")),
        )
        for s in sorted(size["shapes"])
    ]
    candidates = heads.withColumn("labels", labels).select("host", "head", F.explode(F.array_compact(F.array(*options))).alias("c"))
    candidates = candidates.withColumn("key", _key(F.col("c.host"), F.col("c.path")))
    blocks = 1
    while blocks < MAX_BLOCKS and blocks * KEYS_PER_BLOCK < size["n"]:
        blocks *= 2
    hits = passing(candidates, listed.select("key"), blocks).select("host", "head", "c")
    exact = listed.select(F.struct("host", "path").alias("c"), "verdict")
    rank = F.struct(F.char_length("c.host") + F.char_length("c.path"), F.char_length("c.host"))
    judged = hits.join(exact, "c").groupBy("host", "head").agg(F.max_by(F.struct(F.concat("c.host", "c.path").alias("rule"), "verdict"), rank).alias("j"))
    joined = split.withColumn("head", head).join(judged, ["host", "head"], "left")
    return joined.select(*own, "host", "path", F.col("j.rule").alias("rule"), F.coalesce("j.verdict", F.lit(default)).alias("verdict"))
