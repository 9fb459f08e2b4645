"""Grouping of variants into products: brand blocks, similar names, first seed wins.

A row joins the earliest seed of its brand that it is similar to; a row similar to no earlier seed
is a seed itself. The work is done on distinct (brand, name) pairs, in turns. Each turn takes the first
undecided names of every brand, twice as many as the turn before (``BLOCK`` at first), so the turns are
as many as the doublings from ``BLOCK`` to the names of the largest brand.

1. The names of a turn are settled. In the first turn, where they are at most ``BLOCK`` a brand, in one
   bounded task per brand; later ones in rounds over an index of similar names: a name with a seed among
   its earlier matches is a member, a name without an undecided one among them is a seed.
2. The seeds found are earlier than every other undecided name of their brand, so each of those is
   looked up among them and joins the earliest match. Names still undecided go to the next turn.

Names are compared by ``similar_names`` alone, so what a turn compares are names that share a rare word
or character triple, and packs of base names of like length. Every comparison is exact.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wareflow.functions import names as n
from wareflow.functions.text import strip, title_case
from wareflow.operators.ordering import rank_in_key, running
from wareflow.operators.shared import shared_folder, stored
from wareflow.operators.similar_names import first_names, ratio_matches, ratio_reaches, text_matches

THRESHOLD = 0.7
BLOCK = 500


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Share of characters in common matching blocks; the order of the arguments matters."""
    return pd.Series([SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype="float64")


def name_nodes(products: DataFrame) -> DataFrame:
    """Distinct (brand, name) with the first row number and all that the comparisons need."""
    base = n.base_name_key(F.col("name"))
    return (
        products.groupBy(strip(F.col("brand")).alias("brand"), "name")
        .agg(F.min("row_no").alias("node_no"))
        .select("brand", "name", "node_no", F.lower("name").alias("name_key"), base.alias("base_key"))
    )


def _settle_block(threshold: float):
    """Greedy pass over one brand's block of at most ``BLOCK`` names."""
    stop_words = frozenset(n.STOP_WORDS)

    def settle(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("node_no")
        seeds: list[tuple[int, str, frozenset]] = []
        known: dict[tuple[str, str], bool] = {}
        chosen = []
        for node_no, name, base in zip(block["node_no"], block["name_key"], block["base_key"]):
            name_words = frozenset(name.split())
            for seed_no, seed_base, seed_words in seeds:
                if seed_base in name or (len(seed_words) >= 2 and seed_words <= name_words):
                    break
                pair = (seed_base, base)
                if pair not in known:
                    known[pair] = ratio_reaches(seed_base, base, threshold)
                if known[pair]:
                    break
            else:
                seed_no = node_no
                seeds.append((node_no, base, frozenset(base.split()) - stop_words))
            chosen.append(seed_no)
        return pd.DataFrame(
            {"brand": block["brand"], "node_no": block["node_no"], "seed_no": chosen, "base_key": block["base_key"]}
        )

    return settle


def _earliest(matches: DataFrame, sources: DataFrame, keys: list[str], least: dict[str, str]) -> DataFrame:
    """For each target of `matches` (by `keys`) the least of some columns over its sources."""
    met = matches.join(sources, ["brand", "source"])
    return met.groupBy(*keys).agg(*[F.min(c).alias(name) for name, c in least.items()])


def _joined_to(names: DataFrame, seeds: DataFrame, threshold: float) -> DataFrame:
    """``names`` with ``seed_no``: the earliest of the given (earlier) seeds each is similar to, or NULL."""
    sources = seeds.groupBy("brand", F.col("base_key").alias("source")).agg(F.min("seed_no").alias("seed_no"))
    bases = names.select("brand", F.col("base_key").alias("target")).distinct()
    by_ratio = _earliest(ratio_matches(sources, bases, threshold), sources, ["brand", "target"], {"_by_ratio": "seed_no"})
    by_text = _earliest(text_matches(sources, names), sources, ["node_no"], {"_by_text": "seed_no"})
    return (
        names.join(by_ratio.withColumnRenamed("target", "base_key"), ["brand", "base_key"], "left")
        .join(by_text, "node_no", "left")
        .withColumn("seed_no", F.least("_by_ratio", "_by_text"))
        .drop("_by_ratio", "_by_text")
    )


def _settled_in_rounds(heads: DataFrame, threshold: float, folder: str, log: list | None) -> DataFrame:
    """(brand, node_no, seed_no, base_key) of all ``heads``, none of which has an earlier seed outside them.

    Base names stand for the names that have them: per base name, its earliest undecided name and its
    earliest seed are all that other names ask for.
    """
    heads = heads.select("brand", "node_no", "name_key", "base_key")
    sources = heads.select("brand", F.col("base_key").alias("source")).distinct()
    by_ratio = stored(ratio_matches(sources, sources.withColumnRenamed("source", "target"), threshold), folder, "by-ratio")
    by_text = stored(text_matches(sources, heads), folder, "by-text")
    state = heads.select("brand", "node_no", "base_key", F.lit(None).cast("boolean").alias("seed"))

    def seen(state: DataFrame) -> DataFrame:
        """With the earliest undecided name (open) and the earliest seed (first) among a name's matches."""
        own = {"open": F.when(F.col("seed").isNull(), F.col("node_no")), "first": F.when(F.col("seed"), F.col("node_no"))}
        base = state.groupBy("brand", F.col("base_key").alias("source")).agg(*[F.min(c).alias(name) for name, c in own.items()])
        ratio = _earliest(by_ratio, base, ["brand", "target"], {"open_r": "open", "first_r": "first"}).withColumnRenamed("target", "base_key")
        text = _earliest(by_text, base, ["node_no"], {"open_t": "open", "first_t": "first"})
        joined = state.join(ratio, ["brand", "base_key"], "left").join(text, "node_no", "left")
        return joined.select(*state.columns, *[F.least(f"{name}_r", f"{name}_t").alias(name) for name in own])

    turn, left = 0, 1
    while left:
        member, waits = F.col("first") < F.col("node_no"), F.col("open") < F.col("node_no")
        decided = F.when(F.col("seed").isNotNull(), F.col("seed")).when(member, False).when(~F.coalesce(waits, F.lit(False)), True)
        state = stored(seen(state).withColumn("seed", decided).drop("open", "first"), folder, f"state-{turn}")
        left = state.where("seed IS NULL").count()
        turn += 1
        if log is not None:
            log.append((turn, left))
    leader = F.when(F.col("seed"), F.col("node_no")).otherwise(F.col("first"))
    return stored(seen(state).select("brand", "node_no", leader.alias("seed_no"), "base_key"), folder, "settled")


def name_leaders(nodes: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK, log: list | None = None) -> DataFrame:
    """(node_no, seed_no) for every node of ``name_nodes``. Runs the turns, so it is not lazy.

    ``log`` gets (round, names still undecided) of every round of the later turns.
    """
    folder = shared_folder(nodes.sparkSession)
    schema = "brand string, node_no bigint, seed_no bigint, base_key string"
    undecided = stored(nodes.select("brand", "node_no", "name_key", "base_key"), folder, "nodes")
    decided = []
    turn = 0
    while True:
        heads = first_names(undecided, block << turn, block)
        if turn:
            heads = stored(heads, folder, f"heads-{turn}")
            settled = _settled_in_rounds(heads, threshold, f"{folder}/turn-{turn}", log)
        else:
            settled = stored(heads.groupBy("brand").applyInPandas(_settle_block(threshold), schema), folder, "settled")
        decided.append(settled.select("node_no", "seed_no"))
        rest = undecided.join(settled.select("node_no"), "node_no", "left_anti")
        if rest.isEmpty():
            break
        rest = stored(rest, folder, f"rest-{turn}")
        joined = stored(_joined_to(rest, settled.where("node_no = seed_no"), threshold), folder, f"joined-{turn}")
        decided.append(joined.where("seed_no IS NOT NULL").select("node_no", "seed_no"))
        undecided = joined.where("seed_no IS NULL").drop("seed_no")
        if undecided.isEmpty():
            break
        turn += 1
    leaders = decided[0]
    for part in decided[1:]:
        leaders = leaders.unionByName(part)
    return leaders


def leader_groups(products: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK, written: bool = False) -> DataFrame:
    """Products with ``group_no`` (row number of the group's first row) and ``base_name``.

    ``written`` tells that ``products`` are read from a table already.
    """
    # read twice: for the names, and for the rows in the end
    folder = shared_folder(products.sparkSession)
    products = products if written else stored(products, folder, "products")
    nodes = stored(name_nodes(products), folder, "names")
    leaders = name_leaders(nodes, threshold, block)
    base = nodes.select(F.col("node_no").alias("seed_no"), title_case(F.col("base_key")).alias("base_name"))
    by_name = (
        nodes.select(F.col("brand").alias("_brand"), F.col("name").alias("_name"), "node_no")
        .join(leaders, "node_no")
        .join(base, "seed_no")
        .select("_brand", "_name", F.col("seed_no").alias("group_no"), "base_name")
    )
    # written, so that Spark knows how few names there are and does not shuffle all rows to meet them
    by_name = stored(by_name, folder, "by-name")
    same = (strip(F.col("brand")) == F.col("_brand")) & (F.col("name") == F.col("_name"))
    return products.join(by_name, same).drop("_brand", "_name")


def group_label(brand, base_name_):
    """Readable group label; not unique, ``group_no`` is the key."""
    return F.replace(F.lower(F.concat_ws("_", brand, base_name_)), F.lit(" "), F.lit("_"))


def variant_positions(members: DataFrame) -> DataFrame:
    """Members with ``variant_idx``, 0 for the primary variant."""
    ranked = rank_in_key(members, ["group_no"], "row_no", "variant_idx")
    return ranked.withColumn("variant_idx", F.col("variant_idx") - 1)


def group_rollup(members: DataFrame) -> DataFrame:
    """One row per group: label, variant count, code and price of the primary variant."""
    primary = F.col("row_no") == F.col("group_no")

    def of_primary(name: str):
        return F.max(F.when(primary, F.col(name))).alias(f"primary_{name}")

    return (
        members.groupBy("group_no", "brand", "base_name")
        .agg(F.count("*").alias("n_variants"), of_primary("upc"), of_primary("name"), of_primary("price"))
        .withColumn("group_id", group_label(F.col("brand"), F.col("base_name")))
    )


def group_images(members: DataFrame) -> DataFrame:
    """(group_no, position, url): all images of a group in order, each once; one row per image."""
    images = members.select("group_no", "row_no", F.posexplode("images").alias("_i", "url")).where("url <> ''")
    first = images.groupBy("group_no", "url").agg(F.min(F.struct("row_no", "_i")).alias("_at"))
    # the list below holds images of a single row only
    by_row = first.groupBy("group_no", F.col("_at.row_no").alias("row_no")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("_at._i").alias("_i"), "url"))).alias("_urls")
    )
    placed = running(by_row, "row_no", "_upto", ["group_no"], value=F.size("_urls").cast("bigint"))
    return placed.select("group_no", (F.col("_upto") - F.size("_urls")).alias("_before"), F.posexplode("_urls").alias("_k", "_u")).select(
        "group_no", (F.col("_before") + F.col("_k") + 1).alias("position"), F.col("_u.url").alias("url")
    )


def group_index(groups: DataFrame) -> DataFrame:
    """Groups (group_no, brand, ...) with ``group_index``: brands as first seen, then seeds in order."""
    in_brand = rank_in_key(groups, ["brand"], "group_no", "_rank")
    brands = groups.groupBy("brand").agg(F.min("group_no").alias("_first"), F.count("*").alias("_groups"))
    placed = running(brands, "_first", "_upto", value=F.col("_groups")).select(
        "brand", (F.col("_upto") - F.col("_groups")).alias("_offset")
    )
    return (
        in_brand.join(placed, "brand")
        .withColumn("group_index", F.col("_offset") + F.col("_rank"))
        .drop("_rank", "_offset")
    )


def grouping_stats(members: DataFrame) -> DataFrame:
    per_group = members.groupBy("group_no").agg(F.count("*").alias("_n"))
    return per_group.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_variants"),
        F.count("*").alias("total_groups"),
        (F.sum("_n") / F.count("*")).alias("variants_per_group"),
    )
