"""Positions and running values that stay parallel when one key holds most of the rows.

A window over a hot key, or over no key at all, sorts everything in one task. Here the order column
is cut into ranges of ``CHUNK`` values. Rows are counted inside a range, the ranges are summed up
(one small row per key and range), and both parts are added. No task ever holds more than ``CHUNK``
rows of a key, since order values are unique.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 65536


def running(
    df: DataFrame,
    order: str,
    out: str | dict[str, Column],
    keys: Sequence[str] = (),
    value: Column | None = None,
    largest: bool = False,
    chunk: int = CHUNK,
) -> DataFrame:
    """Add the running sum (or maximum) of ``value`` up to and including the row.

    ``order`` is a BIGINT column, unique within ``keys``; keys are not NULL. ``out`` may also map
    several new columns to their values, which are then computed in one pass.
    """
    keys = list(keys)
    values = out if isinstance(out, dict) else {out: F.lit(1).cast("bigint") if value is None else value}
    combine = F.max if largest else F.sum
    cut = df.withColumns(
        {
            "_cut": F.floor(F.col(order) / F.lit(chunk)).cast("bigint"),
            **{f"_v_{name}": v for name, v in values.items()},
        }
    )
    totals = cut.groupBy(*keys, "_cut").agg(*[combine(f"_v_{name}").alias(f"_t_{name}") for name in values])
    earlier = Window.partitionBy(*keys).orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, "_cut", *[combine(f"_t_{name}").over(earlier).alias(f"_b_{name}") for name in values]
    )
    inside = Window.partitionBy(*keys, "_cut").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)

    def result(name: str) -> Column:
        before, local = F.col(f"_b_{name}"), combine(f"_v_{name}").over(inside)
        return F.greatest(before, local) if largest else F.coalesce(before, F.lit(0)) + local

    joined = cut.join(offsets, [*keys, "_cut"])
    return joined.withColumns({name: result(name) for name in values}).drop(
        "_cut", *[f"_{part}_{name}" for name in values for part in "vb"]
    )


def rank_in_key(df: DataFrame, keys: Sequence[str], order: str, out: str, chunk: int = CHUNK) -> DataFrame:
    """1-based position of each row within its key."""
    return running(df, order, out, keys, chunk=chunk)


def global_row_index(df: DataFrame, order: str, out: str = "row_index", chunk: int = CHUNK) -> DataFrame:
    """1-based position of each row in the whole table."""
    return running(df, order, out, chunk=chunk)
