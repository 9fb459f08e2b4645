"""From raw catalogue rows to products: parse, first-wins dedupe, rejects."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wareflow.functions import cleaning as c


Watch = Callable[[str, DataFrame], DataFrame]


def unwatched(step: str, df: DataFrame) -> DataFrame:
    return df


def first_by_upc(df: DataFrame, key: str = "upc", order: str = "row_no") -> DataFrame:
    """First row per key. Only the first row of a key leaves each map task, so hot keys are harmless."""
    first = Window.partitionBy(key).orderBy(order)
    return (
        df.where(F.col(key).isNotNull())
        .withColumn("_n", F.row_number().over(first))
        .where("_n = 1")
        .drop("_n")
    )


def _upc_rows(raw: DataFrame) -> DataFrame:
    return raw.withColumn("upc", c.null_if_missing(F.col("upc")))


def parse_catalog(raw: DataFrame, multi_image: bool = True, watch: Watch = unwatched) -> DataFrame:
    """Products from raw rows. A nameless row still takes its code away from later rows.

    ``watch`` may observe the steps: rows read (``read``), first rows of a code (``first``), ``products``.

    Every product passes ``is_valid_product``: codes and names are there, quantities are at least
    one and costs never negative.
    """
    first = watch("first", first_by_upc(watch("read", _upc_rows(raw))))
    cells = ("brand", "name", "qty", "cost", "tax", "category", "sub_category")
    kept = first.withColumns({n: c.null_if_missing(F.col(n)) for n in cells}).where("name IS NOT NULL")
    images = c.image_cells_multi if multi_image else c.image_cells_strict
    vat = kept.select(
        "row_no",
        c.brand_or_unknown(F.col("brand")).alias("brand"),
        "upc",
        "name",
        c.parse_quantity(F.col("qty")).alias("quantity"),
        c.parse_cost(F.col("cost")).alias("_cost"),
        c.vat_percent(F.col("tax")).alias("_vat"),
        c.tax_label(F.col("tax")).alias("tax"),
        c.pick_category(F.col("category"), F.col("sub_category")).alias("category"),
        images(F.col("image_1"), F.col("image_2"), F.col("image_3")).alias("images"),
    )
    priced = c.price(F.col("_cost"), F.col("_vat"))
    products = vat.select(
        "row_no",
        "brand",
        "upc",
        "name",
        "quantity",
        priced.alias("price"),
        "tax",
        c.percent_label(F.col("_vat")).alias("vat_percentage"),
        priced.alias("total_with_vat"),
        "category",
        "images",
    )
    return watch("products", products)


def parse_rejects(raw: DataFrame) -> DataFrame:
    """(row_no, reason) of the rows ``parse_catalog`` leaves out.

    First rows come from a map-side minimum; the join back is on the unique row number, so a code
    shared by most rows does not end up in one task.
    """
    rows = _upc_rows(raw).select("row_no", "upc", c.null_if_missing(F.col("name")).isNull().alias("_nameless"))
    firsts = (
        rows.where("upc IS NOT NULL").groupBy("upc").agg(F.min("row_no").alias("row_no"))
        .select("row_no", F.lit(True).alias("_first"))
    )
    reason = (
        F.when(F.col("upc").isNull(), "incomplete")
        .when(F.col("_first").isNull(), "duplicate")
        .when(F.col("_nameless"), "incomplete")
    )
    return (
        rows.join(firsts, "row_no", "left")
        .select("row_no", reason.alias("reason"))
        .where("reason IS NOT NULL")
    )


def parse_stats(raw: DataFrame) -> DataFrame:
    """One row: read, kept, duplicate, incomplete and failed rows; one aggregation per code first."""
    rows = _upc_rows(raw).select("row_no", "upc", c.null_if_missing(F.col("name")).isNull().alias("_nameless"))
    per_code = rows.groupBy("upc").agg(
        F.count("*").alias("_rows"),
        # lowest row number with its flag in the last bit: a plain BIGINT, so it hash-aggregates
        (F.min(F.col("row_no") * 2 + F.col("_nameless").cast("int")) % 2 == 1).alias("_nameless"),
    )
    has_code = F.col("upc").isNotNull()
    nameless = F.when(has_code & F.col("_nameless"), 1).otherwise(0)
    total = F.coalesce(F.sum("_rows"), F.lit(0))
    return per_code.agg(
        total.alias("total_rows_read"),
        F.count(F.when(has_code & ~F.col("_nameless"), 1)).alias("valid_products"),
        F.coalesce(F.sum(F.when(has_code, F.col("_rows") - 1)), F.lit(0)).alias("skipped_duplicates"),
        F.coalesce(F.sum(F.when(has_code, nameless).otherwise(F.col("_rows"))), F.lit(0)).alias("skipped_incomplete"),
        F.lit(0).cast("bigint").alias("parsing_errors"),
    )
