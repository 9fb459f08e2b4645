import pytest
from pyspark.errors import AnalysisException

from wareflow.operators.cleaning import parse_catalog
from wareflow.operators.shared import shared_folder
from wareflow.sources.catalog import read_products
from wareflow.streaming.ingest import delivered_files, failed_deliveries, incremental_ingest, ingest_batch, ingested_products, raw_tables, rerun_failed

SCHEMA = "row_no bigint, brand string, upc string, name string, qty string, cost string, tax string, category string, sub_category string, image_1 string, image_2 string, image_3 string"


def rows(*entries):
    return [(n, "b", upc, name, None, "1", None, None, None, None, None, None) for n, upc, name in entries]


FIRST = rows((1, "u1", ""), (2, "u2", "A"), (3, "u2", "B"))
SECOND = rows((4, "u1", "late"), (5, "u3", "C"), (6, "u2", "D"))


def ingest(spark, folder, **options):
    incremental_ingest(spark, f"{folder}/in", f"{folder}/target", f"{folder}/progress", raw_tables(SCHEMA), files="*.parquet", **options).awaitTermination()


def kept(spark, folder):
    return sorted((r.row_no, r.upc) for r in spark.read.parquet(f"{folder}/target/products").collect())


def test_deliveries_equal_one_batch_run(spark):
    folder = shared_folder(spark)
    for part in (FIRST, SECOND):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        ingest(spark, folder)
    whole = parse_catalog(spark.createDataFrame(FIRST + SECOND, SCHEMA)).collect()
    assert kept(spark, folder) == sorted((r.row_no, r.upc) for r in whole) == [(2, "u2"), (5, "u3")]


def test_a_repeated_delivery_changes_nothing(spark):
    folder = shared_folder(spark)
    for batch_id, part in ((0, FIRST), (1, SECOND), (1, SECOND), (0, FIRST)):
        ingest_batch(spark.createDataFrame(part, SCHEMA), f"{folder}/target", batch_id)
    assert kept(spark, folder) == [(2, "u2"), (5, "u3")]


def test_a_failing_delivery_is_recorded_and_skipped(spark):
    folder = shared_folder(spark)

    def fails_first(raw, target, batch_id):
        if batch_id == 0:
            raise ValueError("broken delivery")
        ingest_batch(raw, target, batch_id)

    for part in (FIRST, SECOND):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    ingest(spark, folder, process=fails_first, max_files=1)
    errors = spark.read.parquet(f"{folder}/target/errors").collect()
    assert [r.message for r in errors] == ["broken delivery"]
    assert len(kept(spark, folder)) >= 1


def test_files_that_cannot_be_read_hold_up_nothing(spark, tmp_path):
    """Good, broken, good: both good ones count at once, and the broken one after it was mended."""
    folder = tmp_path
    (folder / "in").mkdir()
    third = rows((7, "u4", "E"))
    for name, part in (("0", FIRST), ("1", None), ("2", SECOND)):
        if part is None:
            (folder / "in" / "1.parquet").write_text("no table at all")
        else:
            spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        ingest(spark, folder)
    assert sorted((r.row_no, r.upc) for r in ingested_products(spark, f"{folder}/target").collect()) == [(2, "u2"), (5, "u3")]
    assert [r.batch_id for r in failed_deliveries(spark, f"{folder}/target").collect()] == [1]
    assert rerun_failed(spark, f"{folder}/target", raw_tables(SCHEMA)) == [1]
    spark.createDataFrame(third, SCHEMA).coalesce(1).write.parquet(f"{folder}/mended")
    (mended,) = (folder / "mended").glob("part-*")
    (folder / "in" / "1.parquet").write_bytes(mended.read_bytes())
    for crc in (folder / "in").glob(".1.parquet.crc"):
        crc.unlink()
    assert rerun_failed(spark, f"{folder}/target", raw_tables(SCHEMA)) == []
    assert sorted(r.upc for r in ingested_products(spark, f"{folder}/target").collect()) == ["u2", "u3", "u4"]
    assert failed_deliveries(spark, f"{folder}/target").count() == 0


def test_price_lists_as_deliveries_equal_one_read(spark, tmp_path):
    """Layouts, encodings and columns differ from file to file; a list without rows and one without a layout fail alone."""
    (tmp_path / "in").mkdir()
    lists = {
        "a.csv": ("PIM | Brand,UPC Code,English Description,COST\nB,1,One,1\nB,2,,2\n", "utf-8-sig"),
        "b.csv": ("PRICE,Name,UPC Code,PIM | Brand,qty\n5,Crème,3,B,2\n6,Again,1,B,2\n", "latin-1"),
        "c.csv": ("no,such,columns\n1,2,3\n", "utf-8"),
        "d.csv": ('PIM | Brand,UPC Code,English Description,COST\nB,2,Late,2\n"B\nC",4,"Fo""ur",4\n', "utf-8"),
    }
    for name, (text, encoding) in lists.items():
        (tmp_path / "in" / name).write_text(text, encoding=encoding)
        incremental_ingest(spark, f"{tmp_path}/in", f"{tmp_path}/target", f"{tmp_path}/progress").awaitTermination()
    good = [f"{tmp_path}/in/{n}" for n in ("a.csv", "b.csv", "d.csv")]
    want = parse_catalog(read_products(spark, good)).orderBy("row_no").drop("row_no").collect()
    got = ingested_products(spark, f"{tmp_path}/target").orderBy("row_no")
    assert got.drop("row_no").select(want[0].__fields__).collect() == want
    assert [(r.batch_id, r.file_no) for r in delivered_files(spark, f"{tmp_path}/target").orderBy("file_no").collect()] == [(i, i) for i in range(4)]
    assert [r.batch_id for r in failed_deliveries(spark, f"{tmp_path}/target").collect()] == [2]


def test_no_files_no_deliveries(spark, tmp_path):
    (tmp_path / "in").mkdir()
    ingest(spark, tmp_path)
    with pytest.raises(AnalysisException):
        ingested_products(spark, f"{tmp_path}/target")
