"""Tables written in the middle of a job: they cut the lineage and survive lost executors."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one the cluster names; in local mode alone, a local one where none is named.

    On several machines a local folder would lose rows without a message, so there it is an error.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = os.path.join(tempfile.gettempdir(), "wareflow")
    return f"{root.rstrip('/')}/wareflow-{uuid.uuid4().hex}"


def stored(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write once as Parquet, read back: exact sizes for the optimiser, no recomputation."""
    path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
COMPILED_BYTES = 8000


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Jobs inside run no generated method that the JVM only interprets, as it does beyond 8000 bytes.

    Rules for many columns make one method of a stage longer than that; Spark then splits the stage by its
    operators and their expressions. The rows are the same; the session's own limit is set again in the end.
    """
    before = spark.conf.get(METHOD_LIMIT)
    spark.conf.set(METHOD_LIMIT, min(int(before), COMPILED_BYTES))
    try:
        yield
    finally:
        spark.conf.set(METHOD_LIMIT, before)


def drop_tables(spark: SparkSession, folder: str, names: list[str]) -> None:
    """Removes tables below a ``shared_folder`` that nothing reads any more."""
    java = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for name in names:
        path = java(f"{folder}/{name}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
