"""The steps that all queries of the whole conversion share: how many tasks, methods, copies and passes they take."""

import importlib

import pytest
from pyspark.sql import functions as F

from checks.views import dealt
from wareflow.operators import grouping, shared
from wareflow.plans import catalogue as plans
from wareflow.plans.catalogue import catalogue_files

SF = "/root/testdata/sf0.001"


def limit_at(spark, monkeypatch, step):
    """The limit of methods in force when a step of the plans is reached, where the run ends."""
    seen = []

    def reached(*_):
        seen.append(int(spark.conf.get(shared.METHOD_LIMIT)))
        raise InterruptedError

    monkeypatch.setattr(plans, step, reached)
    return seen


@pytest.mark.parametrize("rows, tasks", [(12_000, 3), (300_000, 60), (1_200_000, 64), (7_200_000, 144)])
def test_files_of_a_shuffle_do_not_grow_with_rows_alone(spark, rows, tasks):
    assert dealt(spark.range(rows), "id", 5000).rdd.getNumPartitions() == tasks


def test_steps_of_a_conversion_run_compiled_and_read_the_products_in_place(spark, monkeypatch):
    output = importlib.import_module("checks.output")
    before, limits, names, write = spark.conf.get(shared.METHOD_LIMIT), {}, [], shared.stored

    def noted(df, folder, name):
        limits[name] = int(spark.conf.get(shared.METHOD_LIMIT))
        names.append(name)
        return write(df, folder, name)

    for module in (output, grouping):
        monkeypatch.setattr(module, "stored", noted)
    output._conversion(spark, SF)
    assert set(limits.values()) == {8000} and {"parsed", "members", "answers", "by-name"} <= set(limits)
    assert "products" not in names
    assert spark.conf.get(shared.METHOD_LIMIT) == before


def test_the_limit_of_the_session_comes_back_after_an_error(spark):
    before = spark.conf.get(shared.METHOD_LIMIT)
    with pytest.raises(OSError), shared.compiled_methods(spark):
        raise OSError
    assert spark.conf.get(shared.METHOD_LIMIT) == before


@pytest.mark.parametrize("counted", [False, True])
def test_file_names_take_one_pass_over_the_rows(spark, tmp_path, counted):
    path = f"{tmp_path}/lines"
    group, line = (F.col("id") / 3).cast("bigint") + 1, F.col("id") % 3 + 1
    batch = ((group - 1) / 4).cast("bigint") + 1
    lines = spark.range(30).select(batch.alias("batch_no"), group.alias("group_index"), line.alias("line_no"))
    (lines.withColumn("n_batches", F.lit(9).cast("bigint")) if counted else lines).write.parquet(path)
    files = catalogue_files(spark.read.parquet(path), 5)
    assert files._jdf.queryExecution().executedPlan().toString().count(path) == 1
    assert "batch_rows" not in files.columns
    got = [(r.batch_no, r.batch_row, r.file_no, r.file_name) for r in files.orderBy("group_index", "line_no").collect()]
    want = [(b, k + 1, k // 5 + 1, f"products_batch{b:03d}_part{k // 5 + 1:03d}.csv") for b, n in ((1, 12), (2, 12), (3, 6)) for k in range(n)]
    assert got == want


def test_resumed_import_runs_compiled(spark, tmp_path, monkeypatch):
    seen = limit_at(spark, monkeypatch, "_import_parts")
    with pytest.raises(InterruptedError):
        plans.resumed_import(spark.range(1), spark.range(1), str(tmp_path))
    assert seen == [8000]


def test_counted_run_runs_compiled(spark, tmp_path, monkeypatch):
    seen = limit_at(spark, monkeypatch, "stored")
    raw = importlib.import_module("checks.views").view(spark, SF, "cat")
    with pytest.raises(InterruptedError):
        plans.counted_run(raw, spark.range(1), str(tmp_path))
    assert seen == [8000]
