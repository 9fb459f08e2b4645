import pytest
from pyspark.sql import functions as F

from wareflow.functions import cleaning as c
from wareflow.functions import text as t
from wareflow.operators.cleaning import parse_catalog, parse_rejects, parse_stats

COLUMNS = "row_no bigint, brand string, upc string, name string, qty string, cost string, tax string, category string, sub_category string, image_1 string, image_2 string, image_3 string"


def values(spark, texts, expression):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_missing_cells(spark):
    texts = ["", "  ", "nan", " NaN ", "N/A", "null", "None", " NA ", "x ", " nanny", " y　", "\t", None]
    assert values(spark, texts, c.null_if_missing) == [
        None, None, None, None, None, None, None, "NA", "x", "nanny", "y", None, None
    ]


def test_quantity_cost_and_tax(spark):
    assert values(spark, ["2.7", "0", "x", None, "-3", "12", "1e2", "inf", "٣"], c.parse_quantity) == [2, 1, 1, 1, 1, 12, 100, 1, 3]
    assert values(spark, ["-1", "abc", None, "6.31", "1d", ".5", "٦.٥"], c.parse_cost) == [0.0, 0.0, None, 6.31, 0.0, 0.5, 6.5]
    assert values(spark, ["TAX 15%", "5.5 %", "EXEMPT", None, "7% or 9%", "١٥%"], c.vat_percent) == [15.0, 5.5, 0.0, 0.0, 7.0, 15.0]


def test_price_keeps_the_order_of_operations(spark):
    row = spark.range(1).select(c.price(F.lit(6.31), F.lit(15.0)).alias("p")).first()
    assert row.p == 6.31 * 1.65 * (1 + 15.0 / 100) == 11.973224999999998


@pytest.mark.parametrize(
    "cells, multi, strict",
    [
        (("https://a/1.jpg", None, None), ["https://a/1.jpg"], ["https://a/1.jpg"]),
        (("- https://a/1\n -  http://b/2 \r\nftp://c", " https://d ", ""), ["https://a/1", "http://b/2", "https://d"], ["https://d"]),
        (("-https://no", "x http://no", "http"), ["http"], ["http"]),
        (("https://a b\n\nhttps://c", None, "- x"), ["https://a b", "https://c"], ["https://a b\n\nhttps://c"]),
        ((None, None, None), [], []),
    ],
)
def test_image_cells(spark, cells, multi, strict):
    df = spark.createDataFrame([cells], "a string, b string, c string")
    row = df.select(c.image_cells_multi("a", "b", "c").alias("m"), c.image_cells_strict(F.col("a"), F.col("b"), F.col("c")).alias("s")).first()
    assert (row.m, row.s) == (multi, strict)


def test_nameless_first_row_blocks_its_code(spark):
    def row(n, upc, name):
        return (n, None, upc, name, None, "1", None, None, "sub", None, None, None)

    raw = spark.createDataFrame([row(1, "u1", ""), row(2, " u1", "A"), row(3, None, "B"), row(4, "007", " C "), row(5, "u1", "D")], COLUMNS)
    kept = parse_catalog(raw).collect()
    assert [(r.row_no, r.brand, r.upc, r.name, r.price, r.category) for r in kept] == [(4, "Unknown", "007", "C", 1.65, "sub")]
    assert {r.row_no: r.reason for r in parse_rejects(raw).collect()} == {1: "incomplete", 2: "duplicate", 3: "incomplete", 5: "duplicate"}
    assert tuple(parse_stats(raw).first()) == (5, 1, 2, 2, 0)


def test_slug_and_title(spark):
    texts = ["Beauty™ System® MW-Capsules", "Product (Old)", "Café Crème", "™", "  --a b--  ", "İstanbul ÅÄÖ", "x" * 300]
    assert values(spark, texts, t.slug) == [
        "beauty-system-mw-capsules", "product-old", "cafe-creme", "product", "a-b", "istanbul-aao", "x" * 255
    ]
    texts = ["women's 50ml a_b", "éCLAIR rouge", "", "o'neill-SMITH 3d"]
    assert values(spark, texts, t.title_case) == [x.title() for x in texts]


def test_number_text_is_the_shortest_decimal(spark):
    numbers = [0.0, 1.5, 1518.495, 1e7, 12345678.25, 0.0005, 999.0]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(numbers)], "i int, x double")
    assert [r[0] for r in df.orderBy("i").select(t.number_text(F.col("x"))).collect()] == [repr(x) for x in numbers]


def test_first_rows_are_cut_before_the_shuffle(spark):
    raw = spark.createDataFrame([(1, *[None] * 11)], COLUMNS)
    plan = parse_catalog(raw)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Cartesian" not in plan
