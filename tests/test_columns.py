"""Answers, images, URLs, options, batches: hand-written cases."""

import json
import re

from pyspark.sql import functions as F

from wareflow.functions import answers as a
from wareflow.functions import images as im
from wareflow.functions import options as o
from wareflow.functions import urls as u
from wareflow.operators import batches as b
from wareflow.operators import export as x
from wareflow.operators import requests as r
from wareflow.operators import validation as v


def each(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, value) for i, value in enumerate(values)], f"i int, x {kind}")
    return [row[0] for row in df.orderBy("i").select(expression(F.col("x"))).collect()]


def plain_json(text):
    """Whole text, else the widest list or object in it."""
    try:
        return json.loads(text)
    except ValueError:
        found = re.search(r"(\[.*\]|\{.*\})", text, re.DOTALL)
        try:
            return json.loads(found.group(1)) if found else None
        except ValueError:
            return None


def test_json_in_answers(spark):
    texts = [
        '{"a": 1}', 'x {"a": 1} y', '```json\n[1, 2]\n```', '{"a": 1} {"b": 2}', "5 apples [1]", '{"a": 1', "", "1,2", "1] , [2",
        '1} , {"x": 2', '[{"a": "]"}] tail ]', "  [1]  ", "text", '{"a": [1, {"b": null}]}',
    ]
    got = each(spark, texts, lambda c: F.to_json(a.json_from_text(c)))
    assert [None if g is None else json.loads(g) for g in got] == [plain_json(t) for t in texts]


def test_valid_options_need_two_texts(spark):
    texts = ['[{"name": "A", "value": "B"}, {"name": 1, "value": "B"}, {"name": "C", "value": null}, {"name": "D"}, 3, "x", [1]]', '{"name": "A", "value": "B"}', "no", None]
    assert [[tuple(p) for p in row] for row in each(spark, texts, a.valid_options)] == [[("A", "B")], [], [], []]


def test_finishers(spark):
    assert each(spark, ["x" * 501, "**a** `b`", None], lambda c: a.finish_description(c, F.lit("B"), F.lit("N"))) == [
        "x" * 497 + "...", "a b", "<p>Premium <strong>B</strong> product. N.</p>"
    ]
    assert each(spark, ['"Top > Sub"', "no arrow", None], lambda c: a.finish_category(c, F.lit("Mint Mouth Wash"))) == [
        "Top > Sub", "Health & Beauty > Oral Care", "Health & Beauty > Oral Care"
    ]
    assert each(spark, ["Chair leg", "thing"], a.category_from_keywords) == ["Health & Beauty > Hair Care", "Health & Beauty > Skin Care"]
    assert each(spark, ['"Nice"', "y" * 101, None], lambda c: a.finish_name(c, F.lit("BEAUTYSYSTEM soft  wipesPC"))) == ["Nice", "y" * 97 + "...", "Soft Wipes"]
    many = "\n".join(f"tag-{i}" for i in range(12))
    tags = each(spark, ["A b\n#x\n a B \nok-1\nbad!\nz", many, None], lambda c: a.finish_tags(c, F.lit("Beauty"), F.lit("Hair Care")))
    assert tags == [
        ["a b", "ok-1", "beauty", "hair-care", "product", "beauty"], [f"tag-{i}" for i in range(10)],
        ["beauty", "hair-care", "product", "beauty", "shop", "online"],
    ]
    assert each(spark, [" ```a** `b ", None], a.finish_metafield) == ["a `b", ""]


def test_requests(spark):
    products = spark.createDataFrame([("B", "N", 2.0, "c"), ("B", "N", 2.0, "c"), ("B", "M", 1.5, "c")], "brand string, name string, price double, category string")
    assert sorted(row.cache_key for row in r.build_requests(products, "batch").collect()) == ["batch|B|M|1.5", "batch|B|N|2.0"]
    for status, left in (("miss", ["tags|B|M"]), ("failed", ["tags|B|M", "tags|B|N"])):
        stored = spark.createDataFrame([("tags|B|N", "tags", None, status, None, 0)], r.RESPONSE_SCHEMA)
        pending = r.pending_requests(r.build_requests(products, "tags"), stored)
        assert sorted(row.cache_key for row in pending.collect()) == left

    def provider(kinds, prompts, tokens):
        if any("Product: 3\n" in p for p in prompts):
            raise RuntimeError("no answer")
        return [p.upper() for p in prompts]

    asked = spark.range(6).select(
        F.col("id").cast("string").alias("cache_key"), F.lit("tags").alias("kind"), F.concat(F.lit("Product: "), "id", F.lit("\n")).alias("prompt"), F.lit(5).alias("max_tokens")
    ).coalesce(1)
    rows = r.fill_responses(asked, provider, chunk=2).collect()
    got = {row.cache_key: row.response for row in rows}
    assert {k for k, text in got.items() if text is None} == {"2", "3"} and got["5"] == "PRODUCT: 5\n"
    assert {row.cache_key: row.error for row in rows if row.status == "failed"} == dict.fromkeys("23", "RuntimeError: no answer")


def test_images(spark):
    html = (
        '<IMG SRC="https://a/p.jpg" alt="Red Soap" width="900" height=10><img data-src=\'https://a/main.png\'>'
        '<img src="https://a/logo.png"><img alt="x"><img src="http://a/b.jpg"><img src="https://a/p.gif"><img src="https://a/q.jpg" class="Thumb">'
        '<img src="https://a/tie1.jpg"><img src="https://a/tie2.jpg">'
    )
    df = spark.createDataFrame([("https://s", html), ("ftp://s", html), ("http://s", "<p>none</p>")], "url string, html string")
    got = [row[0] for row in df.select(im.extract_images(F.col("url"), F.col("html"), F.lit("red soap bar"))).collect()]
    assert got == [["https://a/p.jpg", "https://a/main.png", "https://a/tie1.jpg"], [], []]
    assert each(spark, ["https://m.ssl-images-amazon.com/I/51IGO6BIBeL._AC_UL116_SR116,116_.jpg", "https://cdn.shopify.com/s/image_200x200.jpg", "https://x/a_thumb.jpg"], im.full_size_url) == [
        "https://m.ssl-images-amazon.com/I/51IGO6BIBeL.jpg", "https://cdn.shopify.com/s/image.jpg", "https://x/a.jpg"
    ]


def test_urls(spark):
    urls = ["https://a.b/c", "http://", "https:///x", "ftp://a", "https://[x/", "https://a b/", "HTTPS://a", "", None, "http://a?x"]
    assert each(spark, urls, u.is_valid_url) == [True, False, False, False, False, True, False, False, False, True]
    assert each(spark, ["My Brand-X"], u.priority_domains)[0][:2] == ["mybrandx.com", "mybrandx.sa"]
    assert each(spark, ["B"], lambda c: u.search_queries(c, F.lit("N")))[0][3] == 'site:iherb.sa OR site:iherb.com "B" "N"'


def test_option_names_and_values(spark):
    names = ["Flavor/Scent", "Size/Volume", "Color/Shade", "Gender/Age", " finish ", "/x", "", "skin TYPE", "tONE two"]
    assert each(spark, names, o.normal_option_name) == ["Flavor", "Size", "Color", "Gender", "Type", None, None, "Type", "Tone"]
    pairs = [[("Shade", "A"), ("Color", ""), ("colour", "B"), ("/", "C")]]
    kind = "array<struct<name:string,value:string>>"
    assert each(spark, pairs, lambda c: o.option_value(o.normal_options(c), F.lit("Color")), kind) == ["B"]


def test_standard_options_threshold(spark):
    rows = [(1, i, [("Size", "1")] + ([("Color", "r")] if i < 3 else []) + ([("Zed", "z")] if i < 2 else [])) for i in range(10)] + [(2, 99, [])]
    df = spark.createDataFrame(rows, "group_no bigint, row_no bigint, options array<struct<name:string,value:string>>")
    got = {row.group_no: (row.option1, row.option2, row.option3) for row in x.standard_options(df).collect()}
    assert got == {1: ("Color", "Size", ""), 2: ("", "", "")}


def test_file_plan(spark):
    for total, files in ((9, 1), (1000, 1), (1001, 2), (2500, 3), (7823, 8), (0, 0)):
        plan = b.file_plan(spark.createDataFrame([(total,)], "total_rows bigint")).orderBy("file_no").collect()
        assert len(plan) == files and sum(p.n_rows for p in plan) == total
        assert [p.first_row for p in plan] == [i * 1000 + 1 for i in range(files)]


def test_file_names(spark):
    rows = spark.range(30).select(
        F.col("id").alias("batch_row0"), F.when(F.col("id") < 25, 1).otherwise(2).cast("bigint").alias("batch_no"),
        F.when(F.col("id") < 25, F.col("id") + 1).otherwise(F.col("id") - 24).alias("batch_row"),
    )
    names = sorted({row.file_name for row in b.split_files(rows, 10, "p").collect()})
    assert names == ["p_batch001_part001.csv", "p_batch001_part002.csv", "p_batch001_part003.csv", "p_batch002.csv"]
    one = b.split_files(rows.where("batch_no = 1"), 25, "p").select("file_name").distinct().collect()
    assert [row.file_name for row in one] == ["p.csv"]
    limited = b.split_files(rows.where("batch_no = 1"), 25, "p", all_batches=rows).select("file_name").distinct().collect()
    assert [row.file_name for row in limited] == ["p_batch001.csv"]


def test_validation_of_a_clean_table(spark):
    columns = ["row_no", "Handle", "Title", "Vendor", "Product Category", "Variant Price", *[f"Option{i} {p}" for i in (1, 2, 3) for p in ("Name", "Value")]]
    good = spark.createDataFrame([(1, "h", "t", "v", "A > B", "1.0", *[""] * 6), (2, "h", "t", "v", "", "2.0", *[""] * 6)], columns)
    assert tuple(v.validation_report(good).first()) == (1, 2, 0, 0, True)
    bare = good.withColumn("Product Category", F.lit(""))
    assert tuple(v.validation_report(bare).first()) == (1, 2, 0, 1, True)
    assert v.check_output_sample(good.drop("Vendor")).first().passed is False
    assert v.check_output_sample(good).first().passed is True
