import pytest
from pyspark.sql import functions as F

from wareflow.operators.cleaning import parse_catalog
from wareflow.operators.shared import shared_folder
from wareflow.sources.catalog import read_catalog, read_direct_catalog, read_products, unify_layout
from wareflow.sources.import_files import read_import_file, write_import_csv, write_import_files
from wareflow.sources.tables import read_batches, read_pages, read_responses, write_batches, write_responses

HEAD = "PIM | Brand,UPC Code,Arabic Description,English Description,TAX  ,COST,Category,Sub Category,Image 1 URL,Image 2 URL\n"


def put(path, text, encoding):
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)


def test_price_lists_of_several_encodings(spark, tmp_path):
    put(tmp_path / "a é.csv", "﻿" + HEAD + 'Beauté,001,عربي,"Cream ""X"", 50ml",TAX 15%,6.31,Oral,Mint,https://a/1.jpg,"- https://a/2.jpg\n- https://a/3.jpg"\n,002,,Name,,,,,,\n', "utf-8")
    put(tmp_path / "b.csv", HEAD + "Beauté,003,,Crème,TAX 15%,1,,,,\n", "latin-1")
    rows = parse_catalog(read_products(spark, str(tmp_path))).orderBy("row_no").collect()
    assert [(r.brand, r.upc, r.name) for r in rows] == [("Beauté", "001", 'Cream "X", 50ml'), ("Unknown", "002", "Name"), ("Beauté", "003", "Crème")]
    assert rows[0].images == ["https://a/1.jpg", "https://a/2.jpg", "https://a/3.jpg"]
    assert rows[0].price == 11.973224999999998
    direct = read_direct_catalog(spark, [str(tmp_path / "a é.csv")]).orderBy("row_no").collect()
    assert [r.name_ar for r in direct] == ["عربي", None]


def test_layouts(spark):
    first = spark.createDataFrame([(1, "b", "u", "n", "5", "2")], ["row_no", "PIM | Brand", "UPC Code", "Name", "PRICE", "qty"])
    both = first.withColumn("English Description", F.lit(None).cast("string")).withColumn("COST", F.lit("7"))
    assert unify_layout(first).select("name", "cost", "qty", "tax").first() == ("n", "5", "2", None)
    # a present but empty column wins over the other layout's
    assert unify_layout(both).select("name", "cost").first() == (None, "7")
    with pytest.raises(ValueError):
        unify_layout(first.drop("PRICE"))


def test_import_files_round_trip(spark, tmp_path):
    rows = [(i, f"h{i}", 'say "hi", ok', "two\nlines", " padded ", None, 1.5) for i in range(5)]
    df = spark.createDataFrame(rows, "n bigint, Handle string, Title string, Body string, Vendor string, Empty string, Price double")
    path = str(tmp_path / "out")
    write_import_csv(df.drop("n").coalesce(1), path)
    back = read_import_file(spark, path).orderBy("row_no").collect()
    assert [tuple(r)[1:] for r in back] == [(h, t, b, v, "", "1.5") for _, h, t, b, v, _, _ in rows]
    text = next((tmp_path / "out").glob("part-*")).read_text()
    assert text.startswith("Handle,Title,Body,Vendor,Empty,Price\n") and "\r" not in text
    assert text.splitlines()[1].startswith('h0,"say ""hi"", ok","two')


def test_rows_keep_their_order_inside_each_file(spark, tmp_path):
    df = spark.range(250).select(
        "id", F.concat(F.lit("h"), "id").alias("Handle"), F.lit(1).alias("batch_no"), F.col("id").alias("batch_row"),
        (F.col("id") / 100).cast("int").alias("file_no"), F.concat(F.lit("f"), (F.col("id") / 100).cast("int"), F.lit(".csv")).alias("file_name"),
    ).repartition(7)
    path = tmp_path / "files"
    write_import_files(df, str(path), ["id"])
    assert sorted(p.name for p in path.iterdir()) == ["f0.csv", "f1.csv", "f2.csv"]
    for k in range(3):
        assert (path / f"f{k}.csv").read_text().split() == ["Handle", *[f"h{i}" for i in range(k * 100, min(k * 100 + 100, 250))]]
    with pytest.raises(FileExistsError):
        write_import_files(df, str(path), ["id"])
    write_import_files(df.where("file_no = 1").withColumn("file_name", F.lit("g.csv")), str(path), ["id"], "append")
    assert len(list(path.iterdir())) == 4
    write_import_files(df.where("file_no = 2"), f"file://{path}", ["id"], "overwrite")
    assert [p.name for p in path.iterdir()] == ["f2.csv"]
    # a failing job leaves no file and nothing beside them
    bad = df.withColumn("Handle", F.when(F.col("id") == 77, F.raise_error(F.lit("no such handle"))).otherwise(F.col("Handle")))
    with pytest.raises(Exception, match="no such handle"):
        write_import_files(bad, str(path), ["id"], "append")
    assert [p.name for p in path.iterdir()] == ["f2.csv"]


def test_named_files_are_quoted_as_by_spark(spark, tmp_path):
    rows = [(i, "x.csv", 'say "hi", ok', "two\nlines", " padded ", None, 1.5, "", "back\\slash") for i in range(3)]
    df = spark.createDataFrame(rows, "n bigint, file_name string, Handle string, Title string, `Body (HTML)` string, Empty string, Price double, Blank string, Path string")
    write_import_files(df, f"{tmp_path}/named", ["n"])
    write_import_csv(df.drop("n", "file_name").coalesce(1), f"{tmp_path}/plain")
    (plain,) = (tmp_path / "plain").glob("part-*")
    assert (tmp_path / "named" / "x.csv").read_text() == plain.read_text()
    back = read_import_file(spark, f"{tmp_path}/named/x.csv").orderBy("row_no").collect()
    assert [tuple(r)[1:] for r in back] == [('say "hi", ok', "two\nlines", " padded ", "", "1.5", "", "back\\slash")] * 3


def test_answer_and_batch_tables(spark):
    folder = shared_folder(spark)
    answers = spark.createDataFrame([("k1", "batch", "x"), ("k2", "tags", None)], "cache_key string, kind string, response string")
    write_responses(answers.where("kind = 'batch'"), f"{folder}/r")
    write_responses(answers.where("kind = 'tags'"), f"{folder}/r")
    assert sorted(map(tuple, read_responses(spark, f"{folder}/r").collect())) == [("k1", "batch", "x", "ok", None, 0), ("k2", "tags", None, "miss", None, 0)]
    groups = spark.createDataFrame([(1, 1), (2, 1), (3, 2)], "group_no bigint, batch_no bigint")
    write_batches(groups, f"{folder}/b")
    write_batches(groups.where("group_no = 3").withColumn("group_no", F.lit(9).cast("bigint")), f"{folder}/b")
    assert sorted(r.group_no for r in read_batches(spark, f"{folder}/b").collect()) == [1, 2, 9]


def test_pages(spark):
    assert read_pages(spark, "/root/testdata/sf0.001/pages.parquet").columns == ["url", "html"]


def test_row_numbers_skip_no_file(spark, tmp_path):
    for k in range(3):
        put(tmp_path / f"{k}.csv", HEAD + f"b,{k},,n{k},,1,,,,\nb,{k}x,,m{k},,1,,,,\n", "utf-8")
    rows = read_catalog(spark, [str(tmp_path / f"{k}.csv") for k in (2, 0, 1)]).orderBy("row_no").collect()
    assert [r["English Description"] for r in rows] == ["n0", "m0", "n1", "m1", "n2", "m2"]
    assert len({r.row_no for r in rows}) == 6
