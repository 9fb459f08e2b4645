"""Price lists arriving as files: each is parsed once, codes seen before are left out.

The stream lists files and no more; a delivery is the list of those that came since the last one (at most
``max_files``). Its files are read inside its own step, so one that cannot be read fails its delivery
and no other. Deliveries are kept as file paths: a failed one is read again from its files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wareflow.functions.cleaning import null_if_missing
from wareflow.operators.cleaning import first_by_upc, parse_catalog
from wareflow.sources.catalog import read_products

Reader = Callable[[SparkSession, list[str], int], DataFrame]
Process = Callable[[DataFrame, str, int], None]
_LISTING = "path string, modificationTime timestamp, length bigint, content binary"
_DELIVERY = "path string, file_no bigint"


def price_lists(spark: SparkSession, paths: list[str], first_file: int) -> DataFrame:
    """Raw rows of CSV price lists of either layout; row numbers go on from the files before."""
    return read_products(spark, paths, first_file)


def raw_tables(schema) -> Reader:
    """Reader of Parquet files that hold raw rows with their own ``row_no``."""
    return lambda spark, paths, first_file: spark.read.schema(schema).parquet(*paths)


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(f"{schema}, batch_id bigint").parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], f"{schema}, batch_id bigint")


def _done(spark: SparkSession, target: str) -> DataFrame:
    """Deliveries all of whose tables are written; rows of others count for nothing."""
    return _table(spark, f"{target}/done", "finished boolean").select("batch_id").distinct()


def _earlier(spark: SparkSession, target: str, batch_id: int, schema: str) -> DataFrame:
    """Codes of other finished batches. A batch repeated after a crash must not see its own rows."""
    done = _done(spark, target).where(F.col("batch_id") != batch_id)
    return _table(spark, f"{target}/codes", schema).join(done, "batch_id", "left_semi")


def ingested_products(spark: SparkSession, target: str) -> DataFrame:
    """The products of all finished deliveries."""
    return spark.read.parquet(f"{target}/products").join(_done(spark, target), "batch_id", "left_semi").drop("batch_id")


def failed_deliveries(spark: SparkSession, target: str) -> DataFrame:
    """(batch_id, message) of the deliveries that are recorded and not run again with success."""
    return _table(spark, f"{target}/errors", "message string").join(_done(spark, target), "batch_id", "left_anti")


def delivered_files(spark: SparkSession, target: str) -> DataFrame:
    """(batch_id, path, file_no) of all files that were ever delivered, in the order of their numbers."""
    return _table(spark, f"{target}/deliveries", _DELIVERY)


def _replace_batch(df: DataFrame, path: str, batch_id: int) -> None:
    (
        df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


def ingest_batch(raw: DataFrame, target: str, batch_id: int) -> None:
    """Add the new products of one delivery to ``target/products`` and its codes to ``target/codes``.

    A code is taken by its first row even if that row is rejected, so codes are kept apart from
    products. The codes of the delivery are looked up in the history, not the other way round: the
    history is filtered where it lies as long as a delivery's codes fit a broadcast.
    """
    spark = raw.sparkSession
    rows = first_by_upc(raw.withColumn("upc", null_if_missing(F.col("upc"))))
    known = _earlier(spark, target, batch_id, "upc string")
    seen = known.join(rows.select("upc"), "upc", "left_semi").select("upc").distinct()
    new = rows.join(seen, "upc", "left_anti").persist()
    try:
        _replace_batch(parse_catalog(new), f"{target}/products", batch_id)
        _replace_batch(new.select("upc"), f"{target}/codes", batch_id)
        # last: from here on, and only from here on, the delivery counts
        _replace_batch(spark.createDataFrame([(True,)], "finished boolean"), f"{target}/done", batch_id)
    finally:
        new.unpersist()


def _attempt(spark: SparkSession, target: str, batch_id: int, read: Reader, process: Process) -> bool:
    """Reads and processes a listed delivery; a failure is recorded."""
    files = delivered_files(spark, target).where(F.col("batch_id") == batch_id).orderBy("file_no").collect()
    try:
        process(read(spark, [r["path"] for r in files], files[0]["file_no"]), target, batch_id)
    except Exception as error:  # noqa: BLE001 - any failure of one delivery
        _replace_batch(spark.createDataFrame([(str(error),)], "message string"), f"{target}/errors", batch_id)
        return False
    return True


def incremental_ingest(
    spark: SparkSession,
    incoming: str,
    target: str,
    checkpoint: str,
    read: Reader = price_lists,
    process: Process = ingest_batch,
    max_files: int = 1000,
    files: str = "*",
) -> StreamingQuery:
    """Run all waiting deliveries of the folder ``incoming`` through ``process`` and stop.

    ``read`` makes raw rows of the paths of a delivery. A delivery that cannot be read or processed is
    recorded in ``target/errors`` and does not hold up the next one; ``rerun_failed`` runs it again.
    ``files`` is a pattern of the names of the files that count.
    """

    def one_delivery(listed: DataFrame, batch_id: int) -> None:
        session = listed.sparkSession
        paths = sorted(r["path"] for r in listed.select("path").collect())  # at most max_files
        if not paths:
            return
        earlier = delivered_files(session, target).where(F.col("batch_id") < batch_id).agg(F.max("file_no")).first()[0]
        first = 0 if earlier is None else earlier + 1
        numbered = session.createDataFrame([(p, first + i) for i, p in enumerate(paths)], _DELIVERY)
        _replace_batch(numbered, f"{target}/deliveries", batch_id)
        _attempt(session, target, batch_id, read, process)

    listing = spark.readStream.format("binaryFile").schema(_LISTING).option("recursiveFileLookup", True)
    return (
        listing.option("pathGlobFilter", files).option("maxFilesPerTrigger", max_files).load(incoming)
        .select("path")
        .writeStream.foreachBatch(one_delivery)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def rerun_failed(spark: SparkSession, target: str, read: Reader = price_lists, process: Process = ingest_batch) -> list[int]:
    """Run the recorded deliveries again, oldest first; returns those that still fail."""
    waiting = [r["batch_id"] for r in failed_deliveries(spark, target).select("batch_id").distinct().orderBy("batch_id").collect()]
    return [batch_id for batch_id in waiting if not _attempt(spark, target, batch_id, read, process)]
