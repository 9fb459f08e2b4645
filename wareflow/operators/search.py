"""Choosing a product page from a table of search results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wareflow.functions import urls as u


def query_rows(products: DataFrame) -> DataFrame:
    """(product_key, query_rank, query): the queries to run for each product."""
    return products.select(
        u.search_key(F.col("brand"), F.col("name"), F.col("upc")).alias("product_key"),
        F.posexplode(u.search_queries(F.col("brand"), F.col("name"))).alias("query_rank", "query"),
    )


def pick_url(results: DataFrame) -> DataFrame:
    """(product_key, url) from (product_key, query_rank, result_rank, url); NULL where none fits.

    Per query the first wanted result, else the first result; an invalid choice ends the query.
    Then the first query with a choice. Two mergeable aggregations, no sort of a product's results.
    """
    per_query = results.groupBy("product_key", "query_rank").agg(
        F.min_by("url", F.struct(u.is_unwanted_url(F.col("url")), "result_rank")).alias("url")
    )
    chosen = F.when(u.is_valid_url(F.col("url")), F.struct("query_rank", "url"))
    return per_query.groupBy("product_key").agg(F.min(chosen)["url"].alias("url"))
