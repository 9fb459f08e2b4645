"""From search results and pages to the images of products, in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wareflow.functions import images as im
from wareflow.functions import urls as u
from wareflow.operators.search import pick_url


def page_candidates(pages: DataFrame) -> DataFrame:
    """(page, candidates) of pages (url, html): the images found on each page, under its canonical URL.

    Made where the pages lie, so no HTML is shuffled. Of pages with one canonical URL the one with the
    least URL text counts.
    """
    found = pages.select(u.canonical_url(F.col("url")).alias("page"), "url", im.img_attributes(im.img_tags(F.col("html"))).alias("candidates"))
    return found.where("page IS NOT NULL").groupBy("page").agg(F.min_by("candidates", "url").alias("candidates"))


def with_page_images(products: DataFrame, results: DataFrame, pages: DataFrame, k: int = 3) -> DataFrame:
    """``products`` (row_no, brand, name, upc, images, ...) with ``url``, the page picked from ``results``, and with at
    most ``k`` of its images behind their own; each image once.

    Products without a result, or whose page is not among ``pages``, keep their images. Scores depend on
    the product's name, so a page's images are scored once for each product that picked it.
    """
    key = u.search_key(F.col("brand"), F.col("name"), F.col("upc"))
    # both sides grow with the products, and Spark's guess of an aggregate's size may be far too low: never a broadcast
    chosen = pick_url(results).withColumnRenamed("product_key", "_key").hint("merge")
    picked = products.withColumn("_key", key).join(chosen, "_key", "left")
    # products without a page are spread; a page that many products picked is split by AQE
    page = F.coalesce(u.canonical_url(F.col("url")), F.concat(F.lit("none "), F.col("row_no").cast("string")))
    found = page_candidates(pages).withColumnRenamed("page", "_page").hint("merge")
    joined = picked.withColumn("_page", page).join(found, "_page", "left")
    own = F.coalesce("images", F.array().cast("array<string>"))
    images = F.array_distinct(F.concat(own, im.page_images(F.col("url"), F.col("candidates"), F.col("name"), k)))
    return joined.withColumn("images", images).drop("_key", "_page", "candidates")
