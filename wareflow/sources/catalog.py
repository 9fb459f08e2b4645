"""Price lists (CSV) as raw catalogue rows: every cell STRING, ``row_no`` in file order."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wareflow.sources.numbering import number_rows

# Canonical name -> column of a price list.
BASE = {"brand": "PIM | Brand", "upc": "UPC Code"}
LAYOUTS = [
    {"name": "English Description", "cost": "COST"},
    {"name": "Name", "cost": "PRICE"},
]
OPTIONAL = {
    "qty": "qty",
    "tax": "TAX  ",
    "category": "Category",
    "sub_category": "Sub Category",
    "image_1": "Image 1 URL",
    "image_2": "Image 2 URL",
    "image_3": "Image 3 URL",
}
ARABIC_NAME = {"name_ar": "Arabic Description"}
RAW_COLUMNS = ["row_no", "brand", "upc", "name", "qty", "cost", *list(OPTIONAL)[1:]]


def _file_flags(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, utf8, header): a file is UTF-8 if all its lines are. Lines are checked where they lie."""
    place = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"), "value", F.is_valid_utf8("value").alias("ok"), place.alias("place")
    )
    return lines.groupBy("file").agg(F.bool_and("ok").alias("utf8"), F.min_by("value", "place").alias("header"))


def _read(spark: SparkSession, files: list[str], encoding: str, all_files: list[str], first_file: int) -> DataFrame:
    df = (
        spark.read.option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .option("enforceSchema", False)
        .option("encoding", encoding)
        .csv([unquote(f) for f in files])  # metadata paths are URL-encoded
    )
    return number_rows(df, all_files, first_file)


def _parts(spark: SparkSession, path: str | list[str], first_file: int = 0) -> list[DataFrame]:
    """One table for each header and encoding, rows numbered over all files."""
    paths = [path] if isinstance(path, str) else list(path)
    flags = _file_flags(spark, paths).collect()
    if not flags:
        raise ValueError(f"no rows in {paths}")
    alike: dict[tuple[bool, str], list[str]] = {}
    for row in sorted(flags, key=lambda r: r["file"]):
        alike.setdefault((row["utf8"], row["header"]), []).append(row["file"])
    all_files = sorted(row["file"] for row in flags)
    return [_read(spark, files, "UTF-8" if utf8 else "ISO-8859-1", all_files, first_file) for (utf8, _), files in alike.items()]


def _together(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_catalog(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All columns of one price list or of several, plus ``row_no``; files may differ in their columns.

    UTF-8 with or without mark; files with other bytes are read as ISO-8859-1, which takes any byte.
    Rows are numbered by file path, then by position in the file. Only the file list, the header and
    one flag per file come to the driver.
    """
    return _together(_parts(spark, path))


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def unify_layout(df: DataFrame, extra: dict[str, str] | None = None) -> DataFrame:
    """Canonical raw columns from either accepted layout; fails if neither is complete.

    Which name and cost column is used depends on the columns present, not on single rows.
    """
    present = set(df.columns)
    if not any(set(layout.values()) | set(BASE.values()) <= present for layout in LAYOUTS):
        wanted = [sorted({*BASE.values(), *layout.values()}) for layout in LAYOUTS]
        raise ValueError(f"the price list needs the columns {wanted[0]} or {wanted[1]}")
    chosen = dict(BASE)
    for layout in reversed(LAYOUTS):
        chosen.update({k: v for k, v in layout.items() if v in present})
    chosen.update({k: v for k, v in {**OPTIONAL, **(extra or {})}.items() if v in present})
    names = [*RAW_COLUMNS, *(extra or {})]
    return df.select(
        *[
            F.col("row_no") if n == "row_no"
            else (_quoted(chosen[n]) if n in chosen else F.lit(None)).cast("string").alias(n)
            for n in names
        ]
    )


def read_products(spark: SparkSession, path: str | list[str], first_file: int = 0) -> DataFrame:
    """Raw catalogue rows, ready for ``parse_catalog``; each file may have either layout.

    ``first_file`` is the number of the first file, where files were numbered before.
    """
    return _together([unify_layout(part) for part in _parts(spark, path, first_file)])


def read_direct_catalog(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw catalogue rows with the Arabic name, ready for ``direct_rows``."""
    parts = _parts(spark, path)
    for raw in parts:
        missing = {*BASE.values(), *LAYOUTS[0].values()} - set(raw.columns)
        if missing:
            raise ValueError(f"the price list lacks the columns {sorted(missing)}")
    return _together([unify_layout(raw, ARABIC_NAME) for raw in parts])
