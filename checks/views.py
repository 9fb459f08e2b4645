"""Input views derived from the given tables, for Spark and for DuckDB.

A view is either one SQL text both engines understand, or a pair: a Spark function (the operators
under test) and a DuckDB text written independently of it. ``{name}`` refers to a table or view.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wareflow.functions.names import base_name
from wareflow.functions.text import number_text
from wareflow.operators.cleaning import parse_catalog
from wareflow.operators.grouping import leader_groups

MISSING = (
    "'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', "
    "'<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'"
)


def filled(col: str) -> str:
    """DuckDB: stripped text or NULL."""
    return f"CASE WHEN {col} NOT IN ({MISSING}) AND trim({col}) <> '' AND lower(trim({col})) <> 'nan' THEN trim({col}) END"


def image_list(*cells: str) -> str:
    """DuckDB: URLs of multi-line image cells."""
    lines = " || ".join(f"coalesce(string_split({c}, chr(10)), [])" for c in cells)
    cleaned = (
        f"list_transform({lines}, lambda l: CASE WHEN trim(l) LIKE '- %' THEN trim(substr(trim(l), 3)) ELSE trim(l) END)"
    )
    return f"list_filter({cleaned}, lambda u: u LIKE 'http%')"


CAT = """
SELECT p_partkey AS row_no,
  CASE WHEN p_partkey % 53 = 0 THEN NULL WHEN p_partkey % 47 = 0 THEN ' ' || p_brand || ' ' ELSE p_brand END AS brand,
  CASE WHEN p_partkey % 41 = 0 THEN '' WHEN p_partkey % 43 = 0 THEN 'nan'
       ELSE CAST(100000 + p_partkey - CASE WHEN p_partkey % 11 = 0 THEN 1 ELSE 0 END AS STRING) END AS upc,
  CASE WHEN p_partkey % 37 = 0 THEN ''
       WHEN p_partkey % 8 = 1 THEN 'Hair ' || p_name || ' #' || CAST(p_size AS STRING)
       WHEN p_partkey % 8 = 2 THEN p_name || ' & bolt (' || CAST(p_size AS STRING) || ' pack)'
       WHEN p_partkey % 8 = 3 THEN p_name || ' ' || CAST(p_size AS STRING) || ' grams'
       WHEN p_partkey % 8 = 4 THEN p_name
       WHEN p_partkey % 8 = 5 THEN upper(p_name) || ' light-rose'
       WHEN p_partkey % 8 = 7 THEN p_name || ' cream - mint'
       ELSE p_name || ' ' || CAST(p_size AS STRING) || 'ml' END AS name,
  CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE 'منتج ' || CAST(p_partkey AS STRING) END AS name_ar,
  CASE p_partkey % 5 WHEN 0 THEN '0' WHEN 1 THEN 'x' WHEN 2 THEN '2.7' WHEN 3 THEN NULL ELSE CAST(p_size AS STRING) END AS qty,
  CASE WHEN p_partkey % 17 = 0 THEN '-1' WHEN p_partkey % 19 = 0 THEN 'abc' WHEN p_partkey % 23 = 0 THEN NULL
       ELSE CAST(p_retailprice AS STRING) END AS cost,
  CASE p_partkey % 4 WHEN 0 THEN 'TAX 15%' WHEN 1 THEN '5.5 %' WHEN 2 THEN 'EXEMPT' ELSE NULL END AS tax,
  CASE p_partkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'Oral Care' WHEN 2 THEN 'Health & Beauty > Hair Care'
       WHEN 3 THEN 'Home > Tools > ' || lower(p_type) WHEN 4 THEN '' ELSE ' Bath ' END AS category,
  CASE p_partkey % 10 WHEN 0 THEN NULL WHEN 1 THEN 'N/A' ELSE lower(p_type) END AS sub_category,
  CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE 'https://img.example.com/' || CAST(p_partkey AS STRING) || '/a.jpg' END AS image_1,
  CASE p_partkey % 7 WHEN 1 THEN '- https://img.example.com/' || CAST(p_partkey AS STRING) || '/b.jpg' || chr(10) || '- https://img.example.com/' || CAST(p_partkey AS STRING) || '/c.jpg'
       WHEN 2 THEN 'ftp://img.example.com/x.jpg' ELSE NULL END AS image_2,
  CASE WHEN p_partkey % 7 IN (3, 4) THEN ' https://img.example.com/shared/' || CAST(p_partkey % 5 AS STRING) || '.png' ELSE '' END AS image_3
FROM {part}
"""

PROD_DUCK = f"""
SELECT row_no, coalesce({filled('brand')}, 'Unknown') AS brand, code AS upc, {filled('name')} AS name,
  CASE WHEN trunc(try_cast(qty AS DOUBLE)) > 0 THEN CAST(trunc(try_cast(qty AS DOUBLE)) AS INTEGER) ELSE 1 END AS quantity,
  c * 1.65 * (1.0 + vat / 100.0) AS price,
  coalesce({filled('tax')}, 'No tax info') AS tax,
  CAST(vat AS VARCHAR) || '%' AS vat_percentage,
  c * 1.65 * (1.0 + vat / 100.0) AS total_with_vat,
  coalesce({filled('category')}, {filled('sub_category')}, '') AS category,
  {image_list('image_1', 'image_2', 'image_3')} AS images
FROM (
  SELECT *, row_number() OVER (PARTITION BY code ORDER BY row_no) AS nth,
    CASE WHEN {filled('cost')} IS NULL THEN NULL WHEN try_cast(cost AS DOUBLE) >= 0 THEN try_cast(cost AS DOUBLE) ELSE 0.0 END AS c,
    coalesce(try_cast(regexp_extract(tax, '(\\d+(\\.\\d+)?)\\s*%', 1) AS DOUBLE), 0.0) AS vat
  FROM (SELECT *, {filled('upc')} AS code FROM {{cat}})
) WHERE code IS NOT NULL AND nth = 1 AND {filled('name')} IS NOT NULL
"""

FILE_CAT = """
SELECT row_no, brand, upc, CASE WHEN row_no % 5 = 0 AND name <> '' THEN name || ' é' ELSE name END AS name, name_ar, qty, cost, tax,
  category, sub_category, image_1, image_2, image_3 FROM {cat}
"""

# What is cut from names, one deletion after the other, in the order of the rules
_MARKS = [
    r"\d+\s*(ml|g|oz|kg|l|mg|lb|fl\.oz)", r"\d+\s*pack", r"#?\d+",
    r"\b(black|white|red|blue|green|yellow|pink|purple|brown|gray|grey|beige|nude|clear)\b",
    r"\b(small|medium|large|xl|xxl|s|m|l)\b",
    r"\b(vanilla|chocolate|mint|rose|lavender|coconut|lemon|berry|fruit)\b",
    r"\b(light|medium|dark|fair|deep)\b", r"\b(matte|glossy|shimmer|metallic|satin)\b",
    r"\([^)]*\)", r"-\s*\w+$",
]


def base_key_sql(name: str) -> str:
    """DuckDB: lower-case base name."""
    out = f"trim(lower({name}))"
    for mark in _MARKS:
        out = f"regexp_replace({out}, '{mark.replace('{', '{{').replace('}', '}}')}', '', 'g')"
    out = f"trim(regexp_replace(trim(regexp_replace({out}, '\\s+', ' ', 'g')), '[^\\w\\s]', '', 'g'))"
    three = f"lower(array_to_string(regexp_split_to_array(trim({name}), '\\s+')[1:3], ' '))"
    return f"CASE WHEN length({out}) < 3 THEN {three} ELSE {out} END"


def title_sql(text: str) -> str:
    """DuckDB: upper-case every letter that follows a non-letter."""
    return (
        f"array_to_string(list_transform(regexp_extract_all({text}, '[a-z]+|[^a-z]+'), "
        "lambda r: upper(r[1:1]) || substr(r, 2)), '')"
    )


BASED_DUCK = f"""
SELECT *, {title_sql('base_key')} AS base_name FROM (SELECT *, {base_key_sql('name')} AS base_key FROM {{prod}})
"""

SIMPLE_GROUPS = """
SELECT p.*, g.group_no FROM {based} p JOIN (
  SELECT brand, base_name, min(row_no) AS group_no FROM {based} GROUP BY brand, base_name
) g ON p.brand = g.brand AND p.base_name = g.base_name
"""

# The match ratio in SQL: find the longest common block (leftmost first), go on left and right of it.
_BLOCK = """list_max(flatten(list_transform(range(al, ah), lambda i: list_transform(range(bl, bh), lambda j:
  {{'k': CASE WHEN x[i+1] <> y[j+1] THEN 0 ELSE list_max(list_transform(range(1, least(ah - i, bh - j) + 1),
     lambda n: CASE WHEN x[i+1:i+n] = y[j+1:j+n] THEN n ELSE 0 END)) END, 'i': -i, 'j': -j}}))))"""


def ratio_ctes(pairs: str) -> str:
    """DuckDB CTEs ``blocks`` and ``ratios(x, y, ratio)`` over a query giving distinct (x, y).

    Only pairs whose shared letters allow a ratio of 0.7 are scored.
    """
    return f"""
pairs AS MATERIALIZED (SELECT x, y FROM ({pairs}) WHERE 2.0 * list_sum(list_transform(list_distinct(string_split(x, '')),
  lambda c: least(length(x) - length(replace(x, c, '')), length(y) - length(replace(y, c, ''))))) / (length(x) + length(y)) >= 0.7),
blocks AS (
  SELECT x, y, al, ah, bl, bh, {_BLOCK} AS m FROM (SELECT x, y, 0 AS al, length(x) AS ah, 0 AS bl, length(y) AS bh FROM pairs)
  UNION ALL
  SELECT x, y, al, ah, bl, bh, {_BLOCK} AS m FROM (
    SELECT x, y, al, -m.i AS ah, bl, -m.j AS bh FROM blocks WHERE m.k > 0
    UNION ALL
    SELECT x, y, -m.i + m.k AS al, ah, -m.j + m.k AS bl, bh FROM blocks WHERE m.k > 0
  ) WHERE al < ah AND bl < bh
),
ratios AS MATERIALIZED (SELECT x, y, 2.0 * sum(m.k) / (length(any_value(x)) + length(any_value(y))) AS ratio FROM blocks GROUP BY x, y)"""


STOP = "['the','a','an','of','for','with','and','or']"


def text_rule(base: str, name: str) -> str:
    """DuckDB: base inside the name, or at least two key words all inside it."""
    wanted = f"list_filter(list_distinct(regexp_split_to_array({base}, '\\s+')), lambda w: NOT list_contains({STOP}, w))"
    return f"(contains({name}, {base}) OR (len({wanted}) >= 2 AND list_has_all(regexp_split_to_array({name}, '\\s+'), {wanted})))"


MEMBERS_DUCK = f"""
WITH RECURSIVE nodes AS MATERIALIZED (
  SELECT brand, name, min(row_no) AS node_no, lower(name) AS nk, any_value(base_key) AS bk, any_value(base_name) AS bn
  FROM {{based}} GROUP BY brand, name
), {ratio_ctes('''SELECT DISTINCT a.bk AS x, b.bk AS y FROM nodes a JOIN nodes b ON a.brand = b.brand AND a.node_no < b.node_no
   WHERE a.bk <> b.bk AND 2.0 * least(length(a.bk), length(b.bk)) / (length(a.bk) + length(b.bk)) >= 0.7''')},
edges AS MATERIALIZED (
  SELECT b.brand, b.node_no, list(a.node_no ORDER BY a.node_no) AS earlier
  FROM nodes a JOIN nodes b ON a.brand = b.brand AND a.node_no < b.node_no
  LEFT JOIN ratios r ON r.x = a.bk AND r.y = b.bk
  WHERE a.bk = b.bk OR r.ratio >= 0.7 OR {text_rule('a.bk', 'b.nk')}
  GROUP BY b.brand, b.node_no
),
seeds AS MATERIALIZED (
  SELECT brand, list_reduce(list({{{{'no': n.node_no, 'earlier': coalesce(earlier, CAST([] AS BIGINT[]))}}}} ORDER BY n.node_no),
    lambda found, node: {{{{'no': node.no, 'earlier': CASE WHEN list_has_any(found.earlier, node.earlier) THEN found.earlier ELSE list_append(found.earlier, node.no) END}}}},
    {{{{'no': CAST(0 AS BIGINT), 'earlier': CAST([] AS BIGINT[])}}}}).earlier AS seeds
  FROM nodes n LEFT JOIN edges e USING (brand, node_no) GROUP BY brand
),
leaders AS (
  SELECT n.brand, n.name, n.node_no, CASE WHEN list_contains(s.seeds, n.node_no) THEN n.node_no
     ELSE list_min(list_intersect(s.seeds, e.earlier)) END AS seed_no
  FROM nodes n JOIN seeds s ON s.brand = n.brand LEFT JOIN edges e ON e.node_no = n.node_no
)
SELECT p.* EXCLUDE (base_key, base_name), l.seed_no AS group_no, s.bn AS base_name
FROM {{based}} p JOIN leaders l ON l.brand = p.brand AND l.name = p.name JOIN nodes s ON s.node_no = l.seed_no
"""

IMG = """
SELECT p_partkey AS page_id, 'http' || CASE WHEN p_partkey % 13 = 0 THEN '' ELSE 's' END || '://shop.example.com/p/' || CAST(p_partkey AS STRING) AS url, p_name AS product_name,
  '<html><body><h1>' || p_name || '</h1>'
  || '<img src="https://cdn.example.com/' || CAST(p_partkey AS STRING) || '/' || CASE p_partkey % 3 WHEN 0 THEN 'main' WHEN 1 THEN 'view' ELSE 'product' END || CASE p_partkey % 4 WHEN 0 THEN '_200x200.jpg' WHEN 1 THEN '.png' WHEN 2 THEN '.webp' ELSE '.gif' END
  || '" alt="' || p_name || ' product" class="Hero-Image" width="' || CAST(p_size * 20 AS STRING) || '" height="' || CAST(p_size * 18 AS STRING) || '">'
  || '<IMG data-src=''https://images-na.ssl-images-amazon.com/images/I/' || CAST(p_partkey AS STRING) || '._AC_UL116_SR116,116_.' || CASE WHEN p_partkey % 2 = 0 THEN 'jpg' ELSE 'bmp' END || ''' alt="' || upper(p_name) || '" width=' || CAST(100 + p_size * 10 AS STRING) || ' height=90/>'
  || '<img class="x" alt="no source">'
  || '<img src="https://cdn.shopify.com/s/files/' || CAST(p_partkey AS STRING) || '/image_' || CAST(p_size AS STRING) || 'x' || CAST(p_size AS STRING) || CASE WHEN p_partkey % 2 = 0 THEN '@2x' ELSE '' END || '.jpg" alt="' || CASE p_partkey % 5 WHEN 0 THEN 'Logo' ELSE 'red ring gear' END || '" width="640" height="480">'
  || CASE WHEN p_partkey % 2 = 0 THEN '<img src="http://plain.example.com/a.jpg" width="900" height="900">' ELSE '<img src="https://media.example.com/thumbs/' || CAST(p_partkey AS STRING) || '.jpg" width="900" height="900">' END
  || CASE WHEN p_partkey % 3 = 0 THEN '<img src="https://shop.example.com/detail/' || CAST(p_partkey AS STRING) || '-' || CASE WHEN p_partkey % 6 = 0 THEN 'mini' ELSE 'big' END || '-view.jpeg" class="gallery main" alt="">' ELSE '' END
  || '</body></html>' AS html
FROM {part}
"""

HITS = """
SELECT md5(lower(p_brand) || '|' || lower(p_name) || '|' || CAST(p_partkey AS STRING)) AS product_key, query_rank, result_rank,
  CASE (p_partkey + 3 * query_rank + 7 * result_rank) % 9
    WHEN 0 THEN 'https://shop.example.com/login?next=' || CAST(p_partkey AS STRING)
    WHEN 1 THEN 'https://shop.example.com/Category/' || CAST(p_partkey AS STRING)
    WHEN 2 THEN 'ftp://shop.example.com/' || CAST(p_partkey AS STRING)
    WHEN 3 THEN 'https:///' || CAST(p_partkey AS STRING)
    WHEN 4 THEN 'http://shop.example.com/cart'
    WHEN 5 THEN ''
    WHEN 6 THEN 'https://[broken/' || CAST(p_partkey AS STRING)
    WHEN 7 THEN 'https://shop.example.com/search?q=' || CAST(p_partkey AS STRING)
    ELSE 'https://shop.example.com/p/' || CAST(p_partkey AS STRING) || '/' || CAST(query_rank AS STRING) || '/' || CAST(result_rank AS STRING) END AS url
FROM {ranked_parts}
"""

# a page for most results; hosts and fragments are spelled in several ways, and one page is a hit of many products
SHOP_DUCK = """SELECT CASE WHEN no % 3 = 0 THEN replace(url, 'https://shop.example', 'HTTPS://Shop.Example') ELSE url END
  || CASE WHEN no % 5 = 0 THEN '#top' ELSE '' END AS url, html
FROM (SELECT h.url, min(i.page_id) AS no, min_by(i.html, i.page_id) AS html
  FROM {hits} h JOIN (SELECT md5(lower(p_brand) || '|' || lower(p_name) || '|' || CAST(p_partkey AS STRING)) AS product_key, p_partkey FROM {part}) p
  ON h.product_key = p.product_key JOIN {img} i ON i.page_id = p.p_partkey GROUP BY h.url) WHERE no % 11 <> 0"""

# answers to the batch and option questions of the products: plain, fenced, broken, wrong types, none
RESP = """
SELECT 'batch|' || brand || '|' || name || '|' || coalesce(price_text, 'None') AS cache_key, 'batch' AS kind,
  CASE row_no % 7
    WHEN 0 THEN '{{"cleaned_name": "Nice ' || name || '", "description": "**Bold** `text` for ' || brand || '", "category": "Health & Beauty > Hair Care", "tags": ["a-tag", "b-tag", "' || lower(brand) || '"], "benefits": "* one", "ingredients": "x", "good_for": "y", "suggested_usage": "z", "allergy_info": "w"}}'
    WHEN 1 THEN 'Sure:' || chr(10) || '```json' || chr(10) || '{{"cleaned_name": "Fenced ' || name || '",' || chr(10) || '"category": "Home > ' || brand || '", "tags": ["t1"]}}' || chr(10) || '```'
    WHEN 2 THEN '{{"cleaned_name": "Broken ' || name || '"'
    WHEN 3 THEN '{{"cleaned_name": null, "tags": null, "benefits": "```only`` this"}}'
    WHEN 4 THEN '[1, 2]'
    WHEN 5 THEN '{{"category": "Plain"}} and {{"category": "Other"}}'
    ELSE '{{"cleaned_name": "Twin", "category": "Oral Care", "tags": []}}' END AS response
FROM (SELECT min(row_no) AS row_no, brand, name, price_text FROM {keys} GROUP BY brand, name, price_text) WHERE row_no % 11 <> 0
UNION ALL
SELECT DISTINCT 'variants|' || name AS cache_key, 'variants' AS kind,
  CASE length(name) % 5
    WHEN 0 THEN '[{{"name": "Color/Shade", "value": "' || name || '"}}, {{"name": "Size", "value": "' || CAST(length(name) AS STRING) || '"}}]'
    WHEN 1 THEN '```' || chr(10) || '[{{"name": "Finish", "value": "Matte"}}, {{"name": "Size/Volume", "value": 5}}, {{"name": "Scent", "value": ""}}]' || chr(10) || '```'
    WHEN 2 THEN '[]'
    WHEN 3 THEN '{{"name": "Color", "value": "Red"}}'
    ELSE '[{{"name": "Colour", "value": "A"}}, {{"name": "Shade", "value": "B"}}, {{"name": "gender/Age", "value": " Men "}}, {{"value": "x"}}, "y"]' END AS response
FROM {keys} WHERE length(name) % 13 <> 0
"""

# product rows under the name the requests use, prices as key text
KEYS_DUCK = "SELECT row_no, brand, name, price, category, CAST(price AS VARCHAR) AS price_text FROM {prod}"

OPTS = """
SELECT row_no, group_no, brand, base_name, upc, name, price, images, w1, w2, n1, n2, n3 FROM (
  SELECT g.*, CAST(row_no % 97 AS STRING) AS w1, CAST(row_no % 5 AS STRING) AS w2,
    CASE row_no % 3 WHEN 0 THEN 'Color/Shade' WHEN 1 THEN ' colour ' ELSE 'Flavor' END AS n1,
    CASE row_no % 4 WHEN 0 THEN 'Size' WHEN 1 THEN 'Finish' WHEN 2 THEN 'gender/Age' ELSE '/x' END AS n2,
    CASE row_no % 10 WHEN 0 THEN 'Fabric' WHEN 1 THEN 'design' WHEN 2 THEN 'Shade' ELSE '' END AS n3
  FROM {groups} g)
"""

IMP = """
SELECT p_partkey AS row_no,
  CASE WHEN p_partkey % 61 = 0 THEN '' ELSE lower(p_brand) || '-' || replace(p_name, ' ', '-') END AS `Handle`,
  CASE WHEN p_partkey % 5 = 1 THEN '' ELSE p_name END AS `Title`,
  CASE WHEN p_partkey % 59 = 0 THEN '' ELSE p_brand END AS `Vendor`,
  CASE p_partkey % 9 WHEN 0 THEN '' WHEN 1 THEN p_type ELSE 'Health & Beauty > ' || p_type END AS `Product Category`,
  CASE WHEN p_partkey % 31 = 0 THEN 'Size' WHEN p_partkey % 7 = 0 THEN '' ELSE 'Color' END AS `Option1 Name`,
  split_part(p_name, ' ', 1) AS `Option1 Value`,
  CASE WHEN p_partkey % 67 = 0 THEN 'Size' ELSE '' END AS `Option2 Name`,
  CASE WHEN p_partkey % 29 = 0 THEN CAST(p_size AS STRING) ELSE '' END AS `Option2 Value`,
  '' AS `Option3 Name`,
  CASE WHEN p_partkey % 71 = 0 THEN 'stray, "quoted"' || chr(10) || 'line' ELSE '' END AS `Option3 Value`,
  CASE WHEN p_partkey % 73 = 0 THEN '' ELSE CAST(p_retailprice AS STRING) END AS `Variant Price`,
  'https://img.example.com/a/rather/long/path/to/the/image/of/' || CAST(p_partkey AS STRING) || '.jpg' AS `Image Src`
FROM {part}
"""


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_catalog(view(spark, sf_dir, "cat"))


def _based(spark, sf_dir):
    return products(spark, sf_dir).withColumn("base_name", base_name(F.col("name")))


def _keys(spark, sf_dir):
    return keys_of(products(spark, sf_dir))


def keys_of(parsed: DataFrame) -> DataFrame:
    return parsed.select(
        "row_no", "brand", "name", "price", "category", number_text(F.col("price")).alias("price_text")
    )


def _shop(spark, sf_dir):
    """The first product of each URL is found by numbers alone, then its page joined: no HTML is grouped, none goes through the driver.

    Spark takes a page made from a part for as small as the part, and would broadcast all pages; so the join is a merge.
    """
    hits = spark.sql(HITS.replace("AS product_key", "AS product_key, p_partkey"), ranked_parts=view(spark, sf_dir, "ranked_parts"))
    firsts = hits.where("product_key IS NOT NULL").groupBy("url").agg(F.min("p_partkey").alias("no")).where("no % 11 <> 0")
    pages = view(spark, sf_dir, "img").select(F.col("page_id").alias("no"), "html")
    spelled = F.when(F.col("no") % 3 == 0, F.replace("url", F.lit("https://shop.example"), F.lit("HTTPS://Shop.Example"))).otherwise(F.col("url"))
    return firsts.join(pages.hint("merge"), "no").select(
        F.concat(spelled, F.when(F.col("no") % 5 == 0, F.lit("#top")).otherwise(F.lit(""))).alias("url"), "html"
    )


VIEWS: dict[str, str | tuple[Callable[[SparkSession, str], DataFrame], str]] = {
    "cat": CAT,
    # the same dirty catalogue with one row per sale: many rows, few distinct names
    "sales": """SELECT l_orderkey * 8 + l_linenumber AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey""",
    "wide": CAT.replace("{part}", "{sales}"),
    "wide_imp": IMP.replace("{part}", "{sales}"),
    "prod": (products, PROD_DUCK),
    # the catalogue as files hold it: some names with a letter beyond ASCII
    "fcat": FILE_CAT,
    "fprod": (lambda spark, sf_dir: parse_catalog(view(spark, sf_dir, "fcat")), PROD_DUCK.replace("{cat}", "{fcat}")),
    "based": (_based, BASED_DUCK),
    "groups": SIMPLE_GROUPS,
    "members": (lambda spark, sf_dir: leader_groups(products(spark, sf_dir)), MEMBERS_DUCK),
    "img": IMG,
    # five queries with three results each
    "ranked_parts": (
        lambda spark, sf_dir: view(spark, sf_dir, "part")
        .withColumn("query_rank", F.explode(F.array(*[F.lit(i) for i in range(5)])))
        .withColumn("result_rank", F.explode(F.array(*[F.lit(i) for i in range(3)]))),
        "SELECT *, unnest(range(0, 3)) AS result_rank FROM (SELECT *, unnest(range(0, 5)) AS query_rank FROM {part})",
    ),
    "hits": HITS,
    "shop": (_shop, SHOP_DUCK),
    "keys": (_keys, KEYS_DUCK),
    "resp": RESP,
    "opts": OPTS,
    "imp": IMP,
}
_REFERENCE = re.compile(r"(?<!\{)\{(\w+)\}(?!\})")


# rows of a table that one task takes, where pages, search results or products are made of each of them
DEALT = {"part": ("p_partkey", 5000)}
# tasks enough for any of our clusters: beyond them a task takes more rows, up to so many times as many
ENOUGH_TASKS, MORE_ROWS = 64, 10


def dealt(df: DataFrame, key: str, rows: int) -> DataFrame:
    """A table dealt out by ``key``, about ``rows`` rows to a task, or more where that makes many tasks.

    Spark cuts files by bytes, so a file of a few MB is one task, whatever is made of its rows after that.
    A shuffle writes a file for each pair of a task and a partition, so tasks are no more than they need to be.
    """
    count = df.count()
    tasks = min(-(-count // rows), max(ENOUGH_TASKS, -(-count // (rows * MORE_ROWS))))
    return df.repartition(tasks, key) if tasks > 1 else df


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in VIEWS:
        table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        return dealt(table, *DEALT[name]) if name in DEALT else table
    definition = VIEWS[name]
    if not isinstance(definition, str):
        return definition[0](spark, sf_dir)
    needed = set(_REFERENCE.findall(definition))
    return spark.sql(definition, **{n: view(spark, sf_dir, n) for n in needed})


def _duck_text(name: str) -> str:
    definition = VIEWS[name]
    text = definition if isinstance(definition, str) else definition[1]
    return re.sub("AS `([^`]+)`", r'AS "\1"', text)


def duck(body: str, *views: str, recursive: bool = False) -> str:
    """DuckDB query: the named views (and those they need) as CTEs in front of ``body``."""
    order: list[str] = []

    def need(name: str) -> None:
        if name in order or name not in VIEWS:
            return
        for other in sorted(set(_REFERENCE.findall(_duck_text(name)))):
            need(other)
        order.append(name)

    for name in views:
        need(name)
    texts = []
    for name in order:
        text = _duck_text(name)
        refs = {n: n for n in _REFERENCE.findall(text)}
        texts.append(f"{name} AS MATERIALIZED ({text.format(**refs)})")
    head = f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(texts)}" if texts else ""
    if body.lstrip().upper().startswith("WITH "):
        body = body.lstrip()[5:]
        return f"{head}, {body}" if head else f"WITH {body}"
    return f"{head} {body}"
