"""The whole conversion: resuming by content, and images of pages."""

from pathlib import Path

from pyspark.sql import functions as F

from wareflow.operators.shared import shared_folder
from wareflow.plans.catalogue import catalogue_import, grouped_products, resumed_import
from wareflow.plans.search import page_candidates, with_page_images

RAW = "row_no bigint, brand string, upc string, name string, qty string, cost string, tax string, category string, sub_category string, image_1 string, image_2 string, image_3 string"
NAMES = ["Night cream", "Rose oil", "Hand balm", "Mint wash", "Clay mask", "Hair gel", "Foot powder", "Lip stick", "Sun milk", "Eye serum"]


def catalogue(spark, names=NAMES):
    rows = [(i, f"B{i % 2}", str(100 + i), name, None, "1", None, None, None, f"https://a/{i}.jpg", None, None) for i, name in enumerate(names)]
    return grouped_products(spark.createDataFrame(rows, RAW))


def answers(spark, members, text):
    keys = members.select(F.concat_ws("|", F.lit("variants"), "name").alias("cache_key")).distinct()
    return keys.select("cache_key", F.lit("variants").alias("kind"), F.lit(text).alias("response"))


def files_of(path):
    """Part files of each batch's folder."""
    return {p.name: sorted(f.name for f in p.glob("part-*")) for p in Path(path).glob("batch_no=*")}


def rows_of(df):
    return sorted(map(repr, df.select(*[F.col(f"`{c}`") for c in sorted(df.columns)]).collect()))


def test_changed_input_remakes_exactly_the_changed_batches(spark):
    path = f"{shared_folder(spark)}/batches"
    members = catalogue(spark)
    given = first_given = answers(spark, members, '[{"name": "Size", "value": "1"}]')
    keep = ("group_no", "group_index", "batch_no", "line_no", "n_batches")

    def run(members, given, **options):
        got = resumed_import(members, given, path, groups_per_batch=3, **options)
        if given is not first_given:
            assert rows_of(got) == rows_of(catalogue_import(members, given, groups_per_batch=3, keep=keep, **options))
        return files_of(path)

    first = run(members, given, max_batches=2)
    assert sorted(first) == ["batch_no=1", "batch_no=2"]
    whole = run(members, given)
    assert sorted(whole) == [f"batch_no={k}" for k in (1, 2, 3, 4)] and all(whole[k] == v for k, v in first.items())
    # one answer changes one batch
    changed = given.withColumn("response", F.when(F.col("cache_key").endswith("Lip stick"), '[{"name": "Color", "value": "red"}]').otherwise(F.col("response")))
    after = run(members, changed)
    assert sum(after[k] != whole[k] for k in whole) == 1
    # a product less: batches that move are made again, and the last one counts no more
    fewer = run(catalogue(spark, NAMES[:9]), answers(spark, catalogue(spark, NAMES[:9]), '[{"name": "Size", "value": "1"}]'))
    assert fewer["batch_no=1"] == after["batch_no=1"]


def test_batches_of_another_size_are_not_mixed(spark):
    path = f"{shared_folder(spark)}/batches"
    members = catalogue(spark)
    given = answers(spark, members, "[]")
    resumed_import(members, given, path, groups_per_batch=2)
    got = resumed_import(members, given, path, groups_per_batch=4)
    assert got.select("batch_no").distinct().count() == 3 and got.count() == 10


def img(src):
    return f'<img src="https://cdn.example.com/{src}.jpg" width="900" height="900">'


def test_page_images(spark):
    products = spark.createDataFrame(
        [(1, "B", "One", "u1", ["https://own/1.jpg"]), (2, "B", "Two", "u2", None), (3, "B", "Three", "u3", []), (4, "B", "Four", "u4", ["https://own/4.jpg"])],
        "row_no bigint, brand string, name string, upc string, images array<string>",
    )
    results = products.where("row_no < 4").select(
        F.md5(F.lower(F.concat_ws("|", "brand", "name", "upc"))).alias("product_key"), F.lit(0).alias("query_rank"), F.lit(0).alias("result_rank"),
        F.when(F.col("row_no") < 3, F.lit("https://shop.example.com/P/1")).otherwise(F.lit("https://gone.example.com/")).alias("url"),
    )
    pages = spark.createDataFrame(
        [("HTTPS://SHOP.example.com/P/1#a", img("x") + img("y") + img("x")), ("https://shop.example.com/P/1#b", img("z")), ("https://shop.example.com/p/1", img("other")), ("no url", img("n")), (None, None), ("https://a.b/", None)],
        "url string, html string",
    )
    assert {r.page for r in page_candidates(pages).collect()} == {"https://shop.example.com/P/1", "https://shop.example.com/p/1", "https://a.b/"}
    got = {r.row_no: (r.url, r.images) for r in with_page_images(products, results, pages).collect()}
    found = ["https://cdn.example.com/x.jpg", "https://cdn.example.com/y.jpg"]
    assert got == {
        1: ("https://shop.example.com/P/1", ["https://own/1.jpg", *found]),
        2: ("https://shop.example.com/P/1", found),
        3: ("https://gone.example.com/", []),
        4: (None, ["https://own/4.jpg"]),
    }
