"""Search results and page images."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.parsing import Query
from checks.views import duck, view
from wareflow.functions import images as im
from wareflow.functions import urls as u
from wareflow.operators.search import pick_url, query_rows
from wareflow.operators.shared import shared_folder
from wareflow.plans.search import with_page_images
from wareflow.sources.tables import read_pages


def _part(s, d):
    return view(s, d, "part").withColumn("upc", F.col("p_partkey").cast("string"))


def _as_products(s, d):
    return _part(s, d).select(F.col("p_brand").alias("brand"), F.col("p_name").alias("name"), "upc")


_KEY = "replace(replace(lower(p_brand), ' ', ''), '-', '')"
_QUERIES_DUCK = f"""[
  'site:' || {_KEY} || '.com "' || p_name || '"', 'site:' || {_KEY} || '.sa "' || p_name || '"', 'site:' || {_KEY} || '.ae "' || p_name || '"',
  'site:iherb.sa OR site:iherb.com "' || p_brand || '" "' || p_name || '"',
  '"' || p_brand || '" "' || p_name || '" site:amazon.sa OR site:noon.com OR site:namshi.com']"""
_DOMAINS_DUCK = (
    f"concat_ws(',', {_KEY} || '.com', {_KEY} || '.sa', {_KEY} || '.ae', {_KEY} || '.co', "
    "'iherb.sa', 'sa.iherb.com', 'iherb.com', 'amazon.sa', 'noon.com', 'namshi.com', 'amazon.ae')"
)
_UNWANTED = "regexp_matches(lower(url), 'login|signin|account|cart|checkout|register|/shop/|/category/|/collection/|/search|/brands/')"
_HOST = "regexp_extract(url, '^https?://([^/?#]*)', 1)"
_VALID = f"({_HOST} <> '' AND contains({_HOST}, '[') = contains({_HOST}, ']'))"

# one row per image tag with a source
TAGS_DUCK = """
SELECT page_id, url, product_name, pos, trim(regexp_extract(tag, '(?:src|data-src)=["'']([^"'']+)["'']', 1, 'i')) AS src,
  lower(regexp_extract(tag, 'alt=["'']([^"'']*)["'']', 1, 'i')) AS alt, lower(regexp_extract(tag, 'class=["'']([^"'']*)["'']', 1, 'i')) AS css,
  coalesce(try_cast(regexp_extract(tag, 'width=["'']?(\\d+)', 1, 'i') AS BIGINT), 0) AS w, coalesce(try_cast(regexp_extract(tag, 'height=["'']?(\\d+)', 1, 'i') AS BIGINT), 0) AS h
FROM (SELECT page_id, url, product_name, unnest(tags) AS tag, generate_subscripts(tags, 1) - 1 AS pos
      FROM (SELECT *, regexp_extract_all(html, '<img([^>]+)>', 1, 'i') AS tags FROM img))
WHERE regexp_extract(tag, '(?:src|data-src)=["'']([^"'']+)["'']', 1, 'i') <> ''
"""
_SKIP = "|".join(im.SKIP_WORDS)
_THUMB = "|".join(w.replace(".", r"\.") for w in im.THUMBNAIL_WORDS)
_MAIN = "|".join(w.replace(".", r"\.") for w in im.MAIN_WORDS)
SCORES_DUCK = f"""
SELECT *, CASE WHEN w > 0 AND h > 0 THEN CASE WHEN greatest(w, h) >= 800 THEN 50 WHEN greatest(w, h) >= 500 THEN 35 WHEN greatest(w, h) >= 300 THEN 20 WHEN greatest(w, h) >= 150 THEN 5 ELSE -20 END ELSE 0 END
  + CASE WHEN regexp_matches(lower(src), '{_MAIN}') THEN 30 ELSE 0 END + CASE WHEN regexp_matches(css, '{_MAIN}') THEN 20 ELSE 0 END
  + 5 * CASE WHEN alt = '' THEN 0 ELSE len(list_filter(string_split(lower(product_name), ' '), lambda k: contains(alt, k))) END
  + CASE WHEN contains(alt, 'product') THEN 5 ELSE 0 END
  + CASE WHEN regexp_matches(lower(src), '\\.jpe?g$') THEN 10 WHEN lower(src) LIKE '%.png' THEN 8 WHEN lower(src) LIKE '%.webp' THEN 6 ELSE 0 END
  + CASE WHEN regexp_matches(lower(src), 'cdn|images|assets|s3|cloudfront|media') THEN 10 ELSE 0 END
  + CASE WHEN contains(lower(src), 'product') THEN 15 ELSE 0 END AS score
FROM ({TAGS_DUCK})
WHERE src LIKE 'https://%' AND NOT regexp_matches(lower(src), '{_SKIP}') AND NOT regexp_matches(alt, '{_SKIP}') AND NOT regexp_matches(css, '{_SKIP}')
  AND NOT regexp_matches(src, '(gif|1x1|pixel)$') AND NOT regexp_matches(lower(src), '{_THUMB}') AND NOT regexp_matches(css, '{_THUMB}')
"""


def _full_size_sql(url: str) -> str:
    # Size marks in image addresses
    market, store, other = url, url, url
    for mark in (r"\._AC_[A-Z0-9,_]+", r"\._SR[0-9,_]+", r"\._UL[0-9,_]+", r"\._SL[0-9,_]+", r"\._UX[0-9,_]+", r"\._UY[0-9,_]+", r"\._UF[0-9,_]+"):
        market = f"regexp_replace({market}, '{mark}', '', 'g')"
    for mark in (r"_\d+x\d+(@\dx)?\.", r"_small\.", r"_medium\.", r"_thumb\."):
        store = f"regexp_replace({store}, '{mark}', '.', 'g')"
    for mark in (r"[-_](thumb|small|thumbnail|mini|tiny|icon|preview)[-_\.]", r"[-_]\d+x\d+[-_\.]"):
        other = f"regexp_replace({other}, '{mark}', '.', 'g')"
    return (
        f"CASE WHEN contains({url}, 'amazon.com') OR contains({url}, 'ssl-images-amazon') THEN CASE WHEN regexp_matches({market}, '\\.(jpg|jpeg|png|webp)$') THEN {market} ELSE {market} || '.jpg' END "
        f"WHEN contains({url}, 'shopify.com') OR contains({url}, 'cdn.shopify') THEN {store} ELSE {other} END"
    )


RANKED_DUCK = f"SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY score DESC, pos) AS nth FROM ({SCORES_DUCK})"


def _candidates(s, d):
    return view(s, d, "img").withColumn("candidates", im.img_attributes(im.img_tags(F.col("html"))))


def _images(s, d):
    """One row per image. Exploded as it is made: for a column, Spark would first make it once more to filter by its size."""
    return view(s, d, "img").select("page_id", F.explode(im.img_attributes(im.img_tags(F.col("html")))).alias("c"))


def _sources(s, d):
    return _images(s, d).select("page_id", F.col("c.pos").alias("pos"), F.col("c.src").alias("src"))


def _stored_page_images(s, d):
    """Pages written as a table with more columns, read back as (url, html)."""
    path, pages = f"{shared_folder(s)}/pages", view(s, d, "img")
    pages.write.parquet(path)
    return (
        read_pages(s, path)
        .join(pages.select("url", "product_name").hint("merge"), "url")
        .select(
            "url",
            F.size(im.img_attributes(im.img_tags(F.col("html")))).alias("n_images"),
            F.array_join(im.extract_images(F.col("url"), F.col("html"), F.col("product_name")), "|").alias("images"),
        )
    )


def _searched(s, d):
    """Products with an image of their own for every fourth."""
    own = F.when(F.col("p_partkey") % 4 == 0, F.array(F.concat(F.lit("https://own.example.com/"), "upc"))).otherwise(F.array().cast("array<string>"))
    return _part(s, d).select(F.col("p_partkey").alias("row_no"), F.col("p_brand").alias("brand"), F.col("p_name").alias("name"), "upc", own.alias("images"))


def _catalogue_images(s, d):
    """Image rows of all products: own images, then those of the page that the search results lead to."""
    found = with_page_images(_searched(s, d), view(s, d, "hits"), view(s, d, "shop"))
    return found.select("row_no", "url", F.posexplode_outer("images").alias("position", "image"))


_CANONICAL = "lower(regexp_extract({0}, '^[^:/?#]+://[^/?#]*')) || regexp_extract({0}, '^[^:/?#]+://[^/?#]*([^#]*)', 1)"
_CATALOGUE_IMAGES_DUCK = f"""WITH picked AS (SELECT product_key, arg_min(url, query_rank) FILTER ({_VALID}) AS url FROM (
    SELECT product_key, query_rank, arg_min(url, CASE WHEN {_UNWANTED} THEN 1000 ELSE 0 END + result_rank) AS url FROM hits GROUP BY product_key, query_rank) GROUP BY product_key),
  wanted AS (SELECT p_partkey, p_name, url FROM part LEFT JOIN picked ON product_key = md5(lower(p_brand) || '|' || lower(p_name) || '|' || CAST(p_partkey AS VARCHAR))),
  found AS (SELECT p_partkey AS page_id, w.url, p_name AS product_name, s.html FROM wanted w
    JOIN (SELECT {_CANONICAL.format('url')} AS page, arg_min(html, url) AS html FROM shop GROUP BY page) s ON s.page = {_CANONICAL.format('w.url')}),
  listed AS (SELECT page_id AS row_no, nth AS k, {_full_size_sql('src')} AS image FROM ({RANKED_DUCK.replace('FROM img)', 'FROM found)')}) WHERE nth <= 3
    UNION ALL SELECT p_partkey, 0, 'https://own.example.com/' || p_partkey FROM part WHERE p_partkey % 4 = 0),
  single AS (SELECT row_no, image, min(k) AS k FROM listed GROUP BY row_no, image)
SELECT w.p_partkey AS row_no, w.url, CASE WHEN image IS NOT NULL THEN CAST(row_number() OVER (PARTITION BY w.p_partkey ORDER BY k) - 1 AS INTEGER) END AS position, image
FROM wanted w LEFT JOIN single s ON s.row_no = w.p_partkey"""


QUERIES: dict[str, Query] = {
    "catalogue_images": (_catalogue_images, duck(_CATALOGUE_IMAGES_DUCK, "hits", "shop")),
    "search_queries": (
        lambda s, d: query_rows(_as_products(s, d)),
        f"""SELECT product_key, generate_subscripts(q, 1) - 1 AS query_rank, unnest(q) AS query FROM (
          SELECT md5(lower(p_brand) || '|' || lower(p_name) || '|' || p_partkey) AS product_key, {_QUERIES_DUCK} AS q FROM part)""",
    ),
    "priority_domains": (
        lambda s, d: view(s, d, "part").select("p_partkey", F.array_join(u.priority_domains(F.col("p_brand")), ",").alias("domains")),
        f"SELECT p_partkey, {_DOMAINS_DUCK} AS domains FROM part",
    ),
    "search_key": (
        lambda s, d: _part(s, d).select(
            "p_partkey",
            u.search_key(F.col("p_brand"), F.col("p_name"), F.when(F.col("p_partkey") % 3 > 0, F.col("upc"))).alias("search_key"),
        ),
        "SELECT p_partkey, md5(lower(p_brand) || '|' || lower(p_name) || CASE WHEN p_partkey % 3 > 0 THEN '|' || p_partkey ELSE '' END) AS search_key FROM part",
    ),
    "wanted_urls": (
        lambda s, d: view(s, d, "hits").select("product_key", "query_rank", "result_rank", u.is_unwanted_url(F.col("url")).alias("unwanted")),
        duck(f"SELECT product_key, query_rank, result_rank, {_UNWANTED} AS unwanted FROM hits", "hits"),
    ),
    "valid_urls": (
        lambda s, d: view(s, d, "hits").select("url").unionByName(view(s, d, "pages").select("url")).select("url", u.is_valid_url(F.col("url")).alias("valid")),
        duck(f"SELECT url, {_VALID} AS valid FROM (SELECT url FROM hits UNION ALL SELECT url FROM pages)", "hits"),
    ),
    "pick_url": (
        lambda s, d: pick_url(view(s, d, "hits")),
        duck(
            f"""SELECT product_key, arg_min(url, query_rank) FILTER ({_VALID}) AS url FROM (
              SELECT product_key, query_rank, arg_min(url, CASE WHEN {_UNWANTED} THEN 1000 ELSE 0 END + result_rank) AS url FROM hits GROUP BY product_key, query_rank)
            GROUP BY product_key""",
            "hits",
        ),
    ),
    "img_tags": (
        lambda s, d: view(s, d, "img").select("page_id", im.img_tags(F.col("html")).alias("t")).select("page_id", F.posexplode("t").alias("pos", "tag")),
        duck(
            "SELECT page_id, generate_subscripts(t, 1) - 1 AS pos, unnest(t) AS tag FROM (SELECT page_id, regexp_extract_all(html, '<img([^>]+)>', 1, 'i') AS t FROM img)",
            "img",
        ),
    ),
    "img_attributes": (
        lambda s, d: _images(s, d).select(
            "page_id", "c.pos", "c.src", F.lower("c.alt").alias("alt"), F.col("c.class").alias("css"), F.col("c.width").alias("w"), F.col("c.height").alias("h")
        ),
        duck(f"SELECT page_id, pos, src, alt, css, w, h FROM ({TAGS_DUCK})", "img"),
    ),
    "image_score": (
        lambda s, d: _candidates(s, d)
        .select("page_id", F.explode(im.scored_images(F.col("candidates"), F.col("product_name"))).alias("i"))
        .select("page_id", "i.pos", "i.src", "i.score"),
        duck(f"SELECT page_id, pos, src, score FROM ({SCORES_DUCK})", "img"),
    ),
    "top_images": (
        lambda s, d: _candidates(s, d).select("page_id", F.array_join(im.top_images(F.col("candidates"), F.col("product_name")), "|").alias("images")),
        duck(
            f"SELECT i.page_id, coalesce(string_agg(src, '|' ORDER BY nth), '') AS images FROM img i LEFT JOIN ({RANKED_DUCK}) r ON r.page_id = i.page_id AND nth <= 3 GROUP BY i.page_id",
            "img",
        ),
    ),
    "full_size_url": (
        lambda s, d: _sources(s, d).withColumn("full_size", im.full_size_url(F.col("src"))),
        duck(f"SELECT page_id, pos, src, {_full_size_sql('src')} AS full_size FROM ({TAGS_DUCK})", "img"),
    ),
    "extract_images": (
        lambda s, d: view(s, d, "img").select(
            "url", F.array_join(im.extract_images(F.col("url"), F.col("html"), F.col("product_name")), "|").alias("images")
        ),
        duck(
            f"SELECT i.url, coalesce(string_agg({_full_size_sql('src')}, '|' ORDER BY nth), '') AS images FROM img i LEFT JOIN ({RANKED_DUCK}) r ON r.page_id = i.page_id AND nth <= 3 GROUP BY i.page_id, i.url",
            "img",
        ),
    ),
    "page_images": (
        _stored_page_images,
        duck(
            f"""WITH counted AS (SELECT page_id, CAST(count(*) AS INTEGER) AS n FROM ({TAGS_DUCK}) GROUP BY page_id)
            SELECT i.url, coalesce(any_value(c.n), 0) AS n_images, coalesce(string_agg({_full_size_sql('src')}, '|' ORDER BY nth), '') AS images
            FROM img i LEFT JOIN counted c USING (page_id) LEFT JOIN ({RANKED_DUCK}) r ON r.page_id = i.page_id AND nth <= 3 GROUP BY i.page_id, i.url""",
            "img",
        ),
    ),
}
