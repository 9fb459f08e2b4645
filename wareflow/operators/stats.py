"""Counters of a whole run, as one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from wareflow.operators.cleaning import parse_stats


def run_stats(raw: DataFrame, members: DataFrame, groups: DataFrame, images: DataFrame, files: DataFrame) -> DataFrame:
    """Parse counters, groups, variants, images, answered and unanswered groups, rows and files.

    ``groups`` has ``answered``; ``images`` is ``group_images``; ``files`` are rows with batch_no,
    file_no and belongs to the written output.
    """

    def single(df: DataFrame, expr):
        return F.coalesce(df.agg(expr).scalar(), F.lit(0))

    per_file = files.groupBy("batch_no", "file_no").agg(F.count("*").alias("_rows"))
    return parse_stats(raw).select(
        "*",
        single(groups, F.count("*")).alias("total_product_groups"),
        single(members, F.count("*")).alias("total_variants"),
        single(groups, F.count_if(F.col("answered"))).alias("successfully_processed"),
        single(groups, F.count_if(~F.col("answered"))).alias("failed_enrichment"),
        single(images, F.count("*")).alias("total_images"),
        single(per_file, F.sum("_rows")).alias("csv_rows_generated"),
        single(per_file, F.count("*")).alias("output_files_generated"),
    )


class Counters:
    """Counters of the steps of a run, collected while the steps' tables are written."""

    def __init__(self, steps: dict[str, dict[str, Column]]):
        self._steps, self._observed = steps, {}

    def watch(self, step: str, df: DataFrame) -> DataFrame:
        """``df``, to be written once; its counters are known after that."""
        if step not in self._steps:
            return df
        self._observed[step] = Observation()
        return df.observe(self._observed[step], *[c.alias(name) for name, c in self._steps[step].items()])

    def __getitem__(self, name: str) -> int:
        step = next(s for s, counters in self._steps.items() if name in counters)
        return self._observed[step].get[name] or 0
