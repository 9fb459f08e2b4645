"""Row numbers in file order for files that one task reads from start to end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# the low bits of a generated id count the rows of one task
_ROW_BITS = 33


def number_rows(df: DataFrame, files: list[str], first_file: int = 0) -> DataFrame:
    """``df``, freshly read, with ``row_no``: files in the given order, rows as they stand.

    ``files`` are metadata paths; a row of a file that is not among them is an error, never left out.
    A multi-line file is never split, so its rows get rising ids. Files are counted from ``first_file`` on.
    """
    in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    placed = df.select("*", F.col("_metadata.file_path").alias("_file"), in_task.alias("_row"))
    numbers = df.sparkSession.createDataFrame(list(zip(files, range(first_file, first_file + len(files)))), "_file string, _file_no bigint")
    unknown = F.raise_error(F.concat(F.lit("not in the list of files: "), "_file")).cast("bigint")
    number = F.when(F.col("_file_no").isNull(), unknown).otherwise(F.shiftleft("_file_no", _ROW_BITS) + F.col("_row"))
    return placed.join(numbers, "_file", "left").withColumn("row_no", number).drop("_file", "_file_no", "_row")
