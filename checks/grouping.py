"""Base names, similarity, groups and their summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.parsing import Query
from checks.views import base_key_sql, duck, products, ratio_ctes, text_rule, title_sql, view
from wareflow.functions import names as n
from wareflow.operators import grouping as g
from wareflow.operators.similar_names import ratio_matches, text_matches


def members(s, d):
    return view(s, d, "members")


def _simple(s, d):
    return view(s, d, "groups")


def _close_pairs(s, d):
    """Base names of a brand with the later ones whose match ratio reaches the limit."""
    bases = g.name_nodes(products(s, d)).groupBy("brand", "base_key").agg(F.min("node_no").alias("first"))
    named = bases.select("brand", F.col("base_key").alias("source"))
    close = ratio_matches(named, named.withColumnRenamed("source", "target"), g.THRESHOLD)
    of = lambda column, first: bases.select("brand", F.col("base_key").alias(column), F.col("first").alias(first))
    pairs = close.join(of("source", "_a"), ["brand", "source"]).join(of("target", "_b"), ["brand", "target"]).where("_a < _b")
    pairs = pairs.select(F.col("source").alias("x"), F.col("target").alias("y")).distinct()
    return pairs.select("x", "y", F.round(g.sequence_ratio("x", "y"), 9).alias("ratio"))


_BASE_PAIRS_DUCK = """SELECT DISTINCT a.base_key AS x, b.base_key AS y FROM
  (SELECT brand, base_key, min(row_no) AS n FROM based GROUP BY ALL) a JOIN
  (SELECT brand, base_key, min(row_no) AS n FROM based GROUP BY ALL) b ON a.brand = b.brand AND a.n < b.n"""


def _text_pairs(s, d):
    """First name of each group with the later names of its brand that the text rules join to it."""
    nodes = g.name_nodes(products(s, d))
    seeds = members(s, d).select(F.col("group_no").alias("node_no")).distinct().join(nodes, "node_no")
    seeds = seeds.select("brand", F.col("node_no").alias("seed_no"), F.col("base_key").alias("source"))
    met = text_matches(seeds.select("brand", "source").distinct(), nodes)
    return met.join(seeds, ["brand", "source"]).where("node_no > seed_no").select("seed_no", "node_no")


def _ordered_groups(s, d):
    groups = members(s, d).groupBy("group_no", "brand").agg(F.count("*").alias("n_variants"))
    return g.group_index(groups)


QUERIES: dict[str, Query] = {
    "base_name": (
        lambda s, d: view(s, d, "part").select("p_partkey", n.base_name(F.col("p_name")).alias("base_name")),
        f"SELECT p_partkey, {title_sql(base_key_sql('p_name'))} AS base_name FROM part".replace("{{", "{").replace("}}", "}"),
    ),
    "catalog_base_names": (
        lambda s, d: products(s, d).select("row_no", n.base_name(F.col("name")).alias("base_name")),
        duck("SELECT row_no, base_name FROM based", "based"),
    ),
    "sequence_ratio_pairs": (
        _close_pairs,
        duck(
            "WITH " + ratio_ctes(_BASE_PAIRS_DUCK).format() + f" SELECT x, y, round(ratio, 9) AS ratio FROM ratios WHERE round(ratio, 9) >= {g.THRESHOLD}",
            "based",
            recursive=True,
        ),
    ),
    "similar_pairs": (
        _text_pairs,
        duck(
            f"""WITH nodes AS (SELECT brand, name, min(row_no) AS node_no, any_value(base_key) AS bk FROM based GROUP BY brand, name),
            seeds AS (SELECT brand, node_no AS seed_no, bk AS base FROM nodes WHERE node_no IN (SELECT group_no FROM members))
            SELECT seed_no, node_no FROM nodes JOIN seeds USING (brand) WHERE node_no > seed_no AND {text_rule('base', 'lower(name)')}""",
            "based", "members",
        ),
    ),
    "leader_groups": (
        lambda s, d: members(s, d).select("row_no", "group_no", "base_name"),
        duck("SELECT row_no, group_no, base_name FROM members", "members"),
    ),
    "variant_positions": (
        lambda s, d: g.variant_positions(_simple(s, d)).select("row_no", "group_no", "variant_idx"),
        duck("SELECT row_no, group_no, row_number() OVER (PARTITION BY group_no ORDER BY row_no) - 1 AS variant_idx FROM groups", "groups"),
    ),
    "group_rollup": (
        lambda s, d: g.group_rollup(_simple(s, d)),
        duck(
            """SELECT group_no, brand, base_name, count(*) AS n_variants, arg_min(upc, row_no) AS primary_upc, arg_min(name, row_no) AS primary_name,
            any_value(price) FILTER (row_no = group_no) AS primary_price, replace(lower(brand || '_' || base_name), ' ', '_') AS group_id
            FROM groups GROUP BY group_no, brand, base_name""",
            "groups",
        ),
    ),
    "group_images": (
        lambda s, d: g.group_images(_simple(s, d)),
        duck(
            """WITH flat AS (SELECT group_no, row_no, unnest(images) AS url, generate_subscripts(images, 1) AS i FROM groups),
            firsts AS (SELECT group_no, url, min(row_no * 1000 + i) AS seen FROM flat GROUP BY group_no, url)
            SELECT group_no, row_number() OVER (PARTITION BY group_no ORDER BY seen) AS position, url FROM firsts""",
            "groups",
        ),
    ),
    "group_index": (
        _ordered_groups,
        duck(
            """WITH g AS (SELECT group_no, brand, count(*) AS n_variants, min(group_no) OVER (PARTITION BY brand) AS first FROM members GROUP BY group_no, brand)
            SELECT group_no, brand, n_variants, row_number() OVER (ORDER BY first, group_no) AS group_index FROM g""",
            "members",
        ),
    ),
    "grouping_stats": (
        lambda s, d: g.grouping_stats(members(s, d)),
        duck(
            "SELECT count(*) AS total_variants, count(DISTINCT group_no) AS total_groups, count(*) / count(DISTINCT group_no) AS variants_per_group FROM members",
            "members",
        ),
    ),
}
