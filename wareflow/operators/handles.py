"""Unique handles, settled as if the rows were served one after the other.

Every row has an ordered list of names it may take. Serving the rows in order is the same as letting
all rows ask for their best name at once, giving each name to the earliest row that asks, and letting
the others ask for their next name, until nobody is turned away: a name only ever passes to an
earlier row, so a refusal is final. That needs few rounds, each of them one aggregation by name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wareflow.functions.text import slug
from wareflow.operators.ordering import running
from wareflow.operators.shared import shared_folder, stored


def _asks_in_order(rows: DataFrame, first_counter: int) -> DataFrame:
    """Counters grow with the row order within a base: give each row the lowest one it can hope for.

    The k-th row that needs a counter cannot get one below the k-th, nor one below its predecessor's.
    """
    counted = rows.where(F.col("level") >= first_counter)
    ranked = running(counted, "order_no", "_rank", ["base"])
    lifted = running(ranked, "order_no", "_high", ["base"], value=F.col("level") - F.col("_rank"), largest=True)
    level = F.greatest(F.col("_rank") + F.col("_high"), F.col("_rank") + (first_counter - 1))
    return rows.where(F.col("level") < first_counter).unionByName(
        lifted.withColumn("level", level).drop("_rank", "_high")
    )


def _settle(rows: DataFrame, name_at: Callable[[Column], Column], first_counter: int) -> DataFrame:
    """``rows`` (order_no, base, level, ...) with ``handle``."""
    folder = shared_folder(rows.sparkSession)
    number = 0
    asked = stored(rows.withColumn("handle", name_at(F.col("level"))), folder, "asked-0")
    while True:
        contested = (
            asked.groupBy("handle").agg(F.min("order_no").alias("_winner"), F.count("*").alias("_n")).where("_n > 1")
        )
        contested = stored(contested.drop("_n"), folder, f"contested-{number}")
        if contested.isEmpty():
            return asked
        number += 1
        refused = F.coalesce(F.col("order_no") > F.col("_winner"), F.lit(False))
        moved = (
            asked.join(contested, "handle", "left")
            .withColumn("level", F.col("level") + F.when(refused, 1).otherwise(0))
            .drop("_winner", "handle")
        )
        moved = stored(moved, folder, f"moved-{number}")
        if not moved.where(F.col("level") >= first_counter).isEmpty():
            moved = _asks_in_order(moved, first_counter)
        asked = stored(moved.withColumn("handle", name_at(F.col("level"))), folder, f"asked-{number}")


def unique_handles(groups: DataFrame) -> DataFrame:
    """(group_no, handle) from (group_no, group_index, brand, base_name, upc of the first variant).

    Names in order: slug of brand and base name; the same with the last four characters of the code;
    with the whole code; with a counter.
    """
    rows = groups.select(
        "group_no",
        F.col("group_index").alias("order_no"),
        slug(F.concat_ws("-", "brand", "base_name")).alias("base"),
        "upc",
        F.lit(0).cast("bigint").alias("level"),
    )

    def name_at(level: Column) -> Column:
        base = F.col("base")
        return (
            F.when(level == 0, base)
            .when(level == 1, F.concat(base, F.lit("-"), F.right(F.col("upc"), F.lit(4))))
            .when(level == 2, F.concat(base, F.lit("-"), F.col("upc")))
            .otherwise(F.concat(base, F.lit("-"), (level - 2).cast("string")))
        )

    # one row per base; a name made from a base has that base before one of its dashes
    rows = stored(rows, shared_folder(groups.sparkSession), "bases")
    counts = rows.groupBy("base").agg(F.count("*").alias("_n"))
    pieces = F.split("base", "-")
    heads = F.transform(F.sequence(F.lit(1), F.size(pieces) - 1), lambda k: F.array_join(F.slice(pieces, F.lit(1), k), "-"))
    longer = counts.where(F.size(pieces) > 1).select("base", F.explode(heads).alias("_head"))
    known = counts.select(F.col("base").alias("_head"))
    involved = counts.where("_n > 1").select("base").unionByName(longer.join(known, "_head", "left_semi").select("base")).distinct()
    settled = _settle_involved(rows, involved, name_at, first_counter=3)
    return settled.select("group_no", "handle")


def _settle_involved(rows: DataFrame, involved: DataFrame, name_at: Callable[[Column], Column], first_counter: int) -> DataFrame:
    """Rows whose base nobody else can reach keep the name of their level; only the others go through rounds."""
    folder = shared_folder(rows.sparkSession)
    involved = stored(involved, folder, "involved")
    alone = rows.join(involved, "base", "left_anti").withColumn("handle", name_at(F.col("level")))
    others = stored(rows.join(involved, "base", "left_semi"), folder, "others")
    return alone if others.isEmpty() else alone.unionByName(_settle(others, name_at, first_counter).select(alone.columns))


def unique_handles_counter(rows: DataFrame, base: Column, order: str = "row_no") -> DataFrame:
    """(row_no, handle): the base, then base-1, base-2 ... in row order."""
    # the base is read twice below, once to count and once to rank
    keyed = stored(rows.select(F.col(order).alias("order_no"), base.alias("base")), shared_folder(rows.sparkSession), "bases")
    ranked = running(keyed, "order_no", "level", ["base"]).withColumn("level", F.col("level") - 1)

    def name_at(level: Column) -> Column:
        return F.when(level == 0, F.col("base")).otherwise(
            F.concat(F.col("base"), F.lit("-"), level.cast("string"))
        )

    # families meet only where a base is another one and a number
    bases = keyed.select("base").distinct()
    numbered = bases.select("base", F.regexp_extract("base", r"(?s)^(.*)-[0-9]+$", 1).alias("_head")).where("_head <> ''")
    met = numbered.join(bases.withColumnRenamed("base", "_head"), "_head", "left_semi")
    involved = met.select(F.explode(F.array("base", "_head")).alias("base")).distinct()
    settled = _settle_involved(ranked, involved, name_at, first_counter=0)
    return settled.select(F.col("order_no").alias(order), "handle")
