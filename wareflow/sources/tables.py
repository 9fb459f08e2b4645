"""Tables kept between runs: answers, pages, finished batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wareflow.operators.requests import RESPONSE_SCHEMA, with_status


RESPONSE_COLUMNS = ["cache_key", "kind", "response", "status", "error", "run_no"]


def write_responses(responses: DataFrame, path: str) -> None:
    """Append answers; one folder per kind, so reading one kind skips the others."""
    with_status(responses).select(*RESPONSE_COLUMNS).write.mode("append").partitionBy("kind").parquet(path)


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RESPONSE_SCHEMA).parquet(path).select(*RESPONSE_COLUMNS)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(url, html) from any Parquet table that has these columns."""
    return spark.read.parquet(path).select("url", "html")


def write_batches(df: DataFrame, path: str) -> None:
    """Finished batches, one folder per batch; writing a batch again replaces it."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_no")
        .parquet(path)
    )


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("batch_no", F.col("batch_no").cast("bigint"))
