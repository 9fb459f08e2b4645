import random

from pyspark.sql import functions as F

from wareflow.operators.ordering import global_row_index, rank_in_key, running


def test_running_values_match_a_plain_loop(spark):
    rng = random.Random(1)
    # key "hot" holds most rows and spans many ranges
    rows = [(n * 7, "hot" if rng.random() < 0.8 else rng.choice("abc"), rng.randint(0, 9)) for n in range(600)]
    df = spark.createDataFrame(rows, "n bigint, k string, v bigint").repartition(5)
    got = running(df, "n", {"total": F.col("v"), "rows": F.lit(1)}, ["k"], chunk=50)
    highest = running(df, "n", "high", ["k"], value=F.col("v"), largest=True, chunk=50)
    sums, counts, highs, want = {}, {}, {}, {}
    for n, k, v in sorted(rows):
        sums[k] = sums.get(k, 0) + v
        counts[k] = counts.get(k, 0) + 1
        highs[k] = max(highs.get(k, 0), v)
        want[n] = (sums[k], counts[k], highs[k])
    assert {r.n: (r.total, r.rows) for r in got.collect()} == {n: w[:2] for n, w in want.items()}
    assert {r.n: r.high for r in highest.collect()} == {n: w[2] for n, w in want.items()}


def test_positions_are_dense(spark):
    df = spark.range(0, 1000, 3).withColumn("k", F.col("id") % 4)
    rows = global_row_index(df, "id", chunk=64).orderBy("id").collect()
    assert [r.row_index for r in rows] == list(range(1, len(rows) + 1))
    per_key = rank_in_key(df, ["k"], "id", "n", chunk=64).groupBy("k").agg(F.max("n").alias("m"), F.count("*").alias("c"))
    assert all(r.m == r.c for r in per_key.collect())


def test_no_window_without_a_bounded_key(spark):
    plan = global_row_index(spark.range(100), "id")._jdf.queryExecution().executedPlan().toString()
    rows_in_one_task = [line for line in plan.splitlines() if "SinglePartition" in line]
    # only the per-range totals meet in one task
    assert len(rows_in_one_task) <= 1
