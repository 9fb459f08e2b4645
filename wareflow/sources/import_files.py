"""Import files (CSV) out and in."""

from __future__ import annotations

import re
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wareflow.sources.named_files import FORMAT, NamedFiles, file_system
from wareflow.sources.numbering import number_rows

_WRITE = {
    "header": True,
    "escape": '"',
    "emptyValue": "",
    "nullValue": "",
    "lineSep": "\n",
    "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_import_csv(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """UTF-8 CSV with header, quoted only where needed, empty cells for missing values."""
    rows.write.mode(mode).options(**_WRITE).csv(path)


def write_import_files(rows: DataFrame, path: str, order: list[str], mode: str = "errorifexists") -> None:
    """One CSV file per ``file_name`` in the folder ``path``, rows in order; ``file_name`` and ``order`` are not written.

    Each file is bounded by the split, so one task per file is enough, and files spread by name. ``mode``
    is append, overwrite or errorifexists; files that are not written again go only with overwrite.
    """
    spark = rows.sparkSession
    if mode not in ("append", "overwrite", "errorifexists"):
        raise ValueError(f"unknown mode {mode}")
    system, target = file_system(path)
    if mode == "errorifexists" and any(i.is_file for i in system.get_file_info(fs.FileSelector(target, allow_not_found=True))):
        raise FileExistsError(f"{path} holds files already")
    data = [c for c in rows.columns if c not in {*order, "batch_no", "batch_row", "file_no", "file_name"}]
    placed = rows.repartition("file_name").sortWithinPartitions("file_name", *order)
    texts = [F.col(f"`{c}`").cast("string").alias(c) for c in data]
    spark.dataSource.register(NamedFiles)
    writer = placed.select("file_name", *texts).write.format(FORMAT).mode("overwrite" if mode == "overwrite" else "append")
    writer.option("path", path).option("staging", f"_staging-{uuid.uuid4().hex}").save()


def read_import_file(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A finished import file as texts (empty for missing), with ``row_no`` in file order."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    texts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns]
    # the file list writes file:///x where row metadata has file:/x
    files = sorted(re.sub("^file:/+", "file:/", f) for f in df.inputFiles())
    return number_rows(df, files).select("row_no", *texts)
