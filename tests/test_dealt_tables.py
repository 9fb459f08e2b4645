"""Queries over a small file whose rows become much work: dealt over tasks, and nothing that grows with it is broadcast."""

import importlib

import pandas as pd
import pytest
from pyspark.sql import functions as F

from checks.views import DEALT, view
from wareflow.operators import requests as r

RUN = importlib.import_module("__spark_entry__").queries()
PARTS = 12_000


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("parts"))
    key = F.col("id")
    parts = spark.range(PARTS).select(
        key.alias("p_partkey"), F.concat(F.lit("gear ring "), key % 50).alias("p_name"), F.concat(F.lit("Brand#"), key % 7).alias("p_brand"),
        F.lit("ECONOMY TIN").alias("p_type"), (key % 50 + 1).cast("int").alias("p_size"), (900 + key % 100).cast("double").alias("p_retailprice"),
    )
    parts.coalesce(1).write.parquet(f"{path}/part.parquet")
    return path


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["part", "img", "hits", "cat"])
def test_a_small_file_is_many_tasks(spark, folder, name):
    rows = view(spark, folder, name)
    sizes = rows.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) >= PARTS // DEALT["part"][1]
    assert rows.count() == PARTS * (15 if name == "hits" else 1)


@pytest.mark.parametrize("name", ["extract_images", "full_size_url", "image_score", "img_attributes", "top_images"])
def test_page_queries_run_on_dealt_rows(spark, folder, name):
    assert RUN[name](spark, folder).rdd.getNumPartitions() > 1


@pytest.mark.parametrize("name", ["full_size_url", "img_attributes"])
def test_images_of_a_page_are_made_once(spark, folder, name):
    assert plan(RUN[name](spark, folder)).count("regexp_extract_all") == 1


@pytest.mark.parametrize("name", ["catalogue_images", "page_images"])
def test_pages_are_not_broadcast(spark, folder, name):
    assert "Broadcast" not in plan(RUN[name](spark, folder))


class Caught:
    """Stands for the pending requests: gives the function that Spark would run."""

    def select(self, *_):
        return self

    def mapInPandas(self, function, _):
        return function


def test_chunks_of_a_batch_are_answered_in_one_frame():
    def provider(kinds, prompts, max_tokens):
        if prompts == ["p1"]:
            raise OSError("gone")
        return [None if p == "p2" else p.upper() for p in prompts]

    asked = pd.DataFrame({"cache_key": ["k0", "k1", "k2"], "kind": "tags", "prompt": ["p0", "p1", "p2"], "max_tokens": 5}, index=[7, 8, 9])
    (frame,) = r.fill_responses(Caught(), provider, chunk=1, run_no=4)(iter([asked]))
    assert list(frame.itertuples(index=False, name=None)) == [
        ("k0", "tags", "P0", "ok", None, 4), ("k1", "tags", None, "failed", "OSError: gone", 4), ("k2", "tags", None, "miss", None, 4),
    ]


def test_a_conversion_parses_its_catalogue_once(spark, monkeypatch):
    views, output = importlib.import_module("checks.views"), importlib.import_module("checks.output")
    parsed, parse = [], views.parse_catalog
    monkeypatch.setattr(views, "parse_catalog", lambda raw: parsed.append(raw) or parse(raw))
    output._conversion(spark, "/root/testdata/sf0.001")
    assert len(parsed) == 1
