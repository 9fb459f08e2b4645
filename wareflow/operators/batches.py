"""Batches of groups, output files of limited size, resuming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wareflow.operators.ordering import running

GROUPS_PER_BATCH = 100
ROWS_PER_FILE = 1000


def block_number(position: Column, size: int) -> Column:
    """1-based number of the block of ``size`` that a 1-based position falls into."""
    return (F.floor((position - 1) / F.lit(size)) + 1).cast("bigint")


def assign_batches(groups: DataFrame, size: int = GROUPS_PER_BATCH) -> DataFrame:
    """Groups (with ``group_index``) get ``batch_no``: consecutive blocks of ``size`` groups."""
    return groups.withColumn("batch_no", block_number(F.col("group_index"), size))


def limit_batches(df: DataFrame, max_batches: int | None) -> DataFrame:
    return df if not max_batches else df.where(F.col("batch_no") <= max_batches)


def pending_batches(df: DataFrame, done: DataFrame) -> DataFrame:
    """Rows of the batches that are not in ``done`` yet."""
    return df.join(done.select("batch_no").distinct(), "batch_no", "left_anti")


def group_rows(rows: DataFrame) -> DataFrame:
    """(batch_no, group_index, _rows): import rows of each group."""
    return rows.groupBy("batch_no", "group_index").agg(F.count("*").alias("_rows"))


def rows_in_batches(rows: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Import rows (batch_no, group_index, line_no, ...) with ``batch_row``, 1.. within the batch, and ``batch_rows``.

    Works on counts per group, so a batch with a huge group is no hot spot. ``counts`` may hold ``group_rows``
    of the rows as a table, since they are read several times.
    """
    groups = group_rows(rows) if counts is None else counts
    sizes = groups.groupBy("batch_no").agg(F.sum("_rows").alias("batch_rows"))
    placed = running(groups, "group_index", "_upto", ["batch_no"], value=F.col("_rows")).join(sizes, "batch_no").select(
        "group_index", (F.col("_upto") - F.col("_rows")).alias("_before"), "batch_rows"
    )
    return (
        rows.join(placed, "group_index").withColumn("batch_row", F.col("_before") + F.col("line_no")).drop("_before")
    )


def split_files(
    rows: DataFrame,
    max_rows: int = ROWS_PER_FILE,
    name: str = "products",
    all_batches: DataFrame | None = None,
) -> DataFrame:
    """Rows with ``batch_row`` get ``file_no`` and ``file_name``; each batch is cut on its own.

    A batch that fits into one file has no part number; a single batch has no batch number either,
    unless it must be cut. ``all_batches`` (with ``batch_no``) tells the number of batches where
    ``rows`` holds only some of them; a column ``n_batches`` of ``rows`` tells it as well. A column
    ``batch_rows`` tells the rows of each batch; without it they are counted.
    """
    if "batch_rows" in rows.columns:
        sized = rows.withColumn("_rows", F.col("batch_rows"))
    else:
        sized = rows.join(rows.groupBy("batch_no").agg(F.count("*").alias("_rows")), "batch_no")
    if "n_batches" in rows.columns and all_batches is None:
        n_batches = F.col("n_batches")
    else:
        n_batches = (rows if all_batches is None else all_batches).agg(F.max("batch_no")).scalar()
    single = (n_batches == 1) & (F.col("_rows") <= max_rows)
    tag = F.when(single, F.lit("")).otherwise(F.concat(F.lit("_batch"), three_digits(F.col("batch_no"))))
    out = sized.withColumn("file_no", block_number(F.col("batch_row"), max_rows))
    part = F.when(F.col("_rows") > max_rows, part_label(F.col("file_no"))).otherwise(F.lit(""))
    return out.withColumn("file_name", F.concat(F.lit(name), tag, part, F.lit(".csv"))).drop("_rows")


def three_digits(number: Column) -> Column:
    """At least three digits."""
    text = number.cast("string")
    return F.when(number > 999, text).otherwise(F.lpad(text, 3, "0"))


def part_label(number: Column) -> Column:
    return F.concat(F.lit("_part"), three_digits(number))


def split_catalogue(rows: DataFrame, order: str, max_rows: int = ROWS_PER_FILE, name: str = "products") -> DataFrame:
    """The whole table cut into files, whatever the batches."""
    total = rows.agg(F.count("*")).scalar()
    placed = running(rows, order, "file_row").withColumn("file_no", block_number(F.col("file_row"), max_rows))
    part = F.when(total > max_rows, part_label(F.col("file_no"))).otherwise(F.lit(""))
    return placed.withColumn("file_name", F.concat(F.lit(name), part, F.lit(".csv")))


def file_plan(totals: DataFrame, max_rows: int = ROWS_PER_FILE) -> DataFrame:
    """(file_no, first_row, last_row, n_rows) for a one-row table with ``total_rows``."""
    files = F.ceil(F.col("total_rows") / F.lit(max_rows)).cast("bigint")
    numbered = totals.where("total_rows > 0").select(
        "total_rows", F.explode(F.sequence(F.lit(1).cast("bigint"), files)).alias("file_no")
    )
    first = (F.col("file_no") - 1) * max_rows + 1
    last = F.least(F.col("file_no") * max_rows, F.col("total_rows"))
    return numbered.select(
        "file_no", first.alias("first_row"), last.alias("last_row"), (last - first + 1).alias("n_rows")
    )
