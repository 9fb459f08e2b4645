"""The full conversion: price list -> products -> groups -> enriched groups -> import rows."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wareflow.operators import batches as b
from wareflow.operators.cleaning import Watch, parse_catalog, unwatched
from wareflow.operators.export import import_projection
from wareflow.operators.grouping import group_images, group_index, group_rollup, leader_groups
from wareflow.operators.handles import unique_handles
from wareflow.operators.layouts import IMPORT_COLUMNS
from wareflow.operators.requests import apply_enrichment, build_requests
from wareflow.operators.shared import compiled_methods, shared_folder, stored
from wareflow.operators.stats import Counters
from wareflow.sources.import_files import write_import_files
from wareflow.sources.tables import read_batches, write_batches


def grouped_products(raw: DataFrame) -> DataFrame:
    """Parsed products with their groups, written once: several later steps start from here."""
    return stored(leader_groups(parse_catalog(raw)), shared_folder(raw.sparkSession), "members")


def groups_of(members: DataFrame) -> DataFrame:
    """One row per group with order, code and price of its primary variant."""
    rollup = group_rollup(members).select(
        "group_no",
        "brand",
        "base_name",
        "n_variants",
        F.col("primary_upc").alias("upc"),
        F.col("primary_price").alias("price"),
    )
    return group_index(rollup)


def catalogue_requests(members: DataFrame) -> DataFrame:
    """Everything to ask for a catalogue: one batch per group, one option list per name."""
    groups = groups_of(members).select("brand", F.col("base_name").alias("name"), "price")
    return build_requests(groups, "batch").unionByName(build_requests(members, "variants"))


def _import_parts(
    members: DataFrame, responses: DataFrame, groups_per_batch: int, max_batches: int | None, watch: Watch = unwatched
) -> tuple[DataFrame, DataFrame]:
    """(variants, groups) that ``import_projection`` makes rows of; groups have batch_no, n_batches and handle."""
    folder = shared_folder(members.sparkSession)
    with compiled_methods(members.sparkSession):
        # both are read several times below: the roll-up and the parsed options are made once
        groups, variants = apply_enrichment(stored(groups_of(members), folder, "index"), members, responses)
        batched = stored(watch("groups", b.assign_batches(groups, groups_per_batch)), folder, "batched")
        # handles follow the enriched title, and are unique over the whole catalogue
        wanted = b.limit_batches(batched, max_batches).withColumn("n_batches", batched.agg(F.max("batch_no")).scalar())
        handles = unique_handles(wanted.withColumn("base_name", F.col("title")))
        if max_batches:
            variants = variants.join(wanted.select("group_no"), "group_no", "left_semi")
        variants = variants.select("row_no", "group_no", "brand", "upc", "name", "price", "images", "options")
        return stored(variants, folder, "variants"), wanted.join(handles, "group_no")


def catalogue_import(
    members: DataFrame,
    responses: DataFrame,
    groups_per_batch: int = b.GROUPS_PER_BATCH,
    max_batches: int | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Import rows of all groups (or of the first batches), see ``import_projection``.

    ``keep`` may name group_no, group_index, batch_no, line_no and n_batches (of the whole catalogue,
    whatever the limit).
    """
    return import_projection(*_import_parts(members, responses, groups_per_batch, max_batches), keep)


KEPT = ("group_no", "group_index", "batch_no", "line_no", "n_batches")


def batch_prints(groups: DataFrame, variants: DataFrame) -> DataFrame:
    """(batch_no, print): a number that tells whether anything that a batch's rows are made of has changed.

    The sum of a hash of every group and every variant of the batch, so one aggregate each, in any order.
    The number of batches alone changes no row and does not count.
    """
    columns = [c for c in groups.columns if c != "n_batches"]
    of_groups = groups.select("batch_no", F.xxhash64(F.lit("group"), *columns).alias("h"))
    of_variants = variants.join(groups.select("group_no", "batch_no"), "group_no").select("batch_no", F.xxhash64(F.lit("variant"), *variants.columns).alias("h"))
    # sums of halves cannot overflow before 2**31 rows of a batch
    halves = of_groups.unionByName(of_variants).groupBy("batch_no").agg(
        F.sum(F.shiftright("h", 32)).alias("high"), F.sum(F.col("h").bitwiseAND(0xFFFFFFFF)).alias("low"), F.count("*").alias("n")
    )
    return halves.select("batch_no", F.xxhash64("high", "low", "n").alias("print"))


def resumed_import(
    members: DataFrame,
    responses: DataFrame,
    path: str,
    groups_per_batch: int = b.GROUPS_PER_BATCH,
    max_batches: int | None = None,
) -> DataFrame:
    """``catalogue_import`` with the columns ``KEPT``, batch by batch in the table at ``path``.

    Every row there carries the print of its batch. Batches found with the print they have now are not
    made again; changed and new ones are written, and batches that are no more, or hold other rows, do
    not count. Returns the rows of this run's batches.
    """
    spark = members.sparkSession
    with compiled_methods(spark):
        variants, groups = _import_parts(members, responses, groups_per_batch, max_batches)
        folder = shared_folder(spark)
        groups = stored(groups, folder, "groups")
        prints = stored(batch_prints(groups, variants), folder, "prints")
        try:
            waiting = prints.join(read_batches(spark, path).select("batch_no", "print").distinct(), ["batch_no", "print"], "left_anti")
        except AnalysisException:
            waiting = prints
        waiting = stored(waiting, folder, "waiting")
        pending = groups.join(waiting, "batch_no")
        own = variants.join(pending.select("group_no"), "group_no", "left_semi")
        rows = import_projection(own, pending.drop("print"), tuple(k for k in KEPT if k != "n_batches")).join(waiting, "batch_no")
        write_batches(rows, path)
    n_batches = groups.agg(F.max("n_batches")).scalar()
    return read_batches(spark, path).join(prints, ["batch_no", "print"], "left_semi").drop("print").withColumn("n_batches", n_batches)


def catalogue_files(rows: DataFrame, max_rows: int = b.ROWS_PER_FILE, name: str = "products") -> DataFrame:
    """Rows of ``catalogue_import`` (kept batch_no, group_index, line_no) with file names."""
    spark = rows.sparkSession
    # one pass over the rows for all that their places and file names need
    with compiled_methods(spark):
        counts = stored(b.group_rows(rows), shared_folder(spark), "group-rows")
    placed = b.rows_in_batches(rows, counts)
    return b.split_files(placed, max_rows, name, None if "n_batches" in rows.columns else counts).drop("batch_rows")


def counted_run(raw: DataFrame, responses: DataFrame, path: str, max_rows: int = b.ROWS_PER_FILE, groups_per_batch: int = b.GROUPS_PER_BATCH) -> DataFrame:
    """The whole conversion into files below ``path``/files and a table of images, ``path``/images; returns ``run_stats``.

    Every counter is collected while a step's table is written, so none is read again for it.
    """
    spark, folder = raw.sparkSession, shared_folder(raw.sparkSession)
    rows = F.count("*")
    counters = Counters(
        {
            "read": {"rows_read": rows, "coded": F.count("upc")},
            "first": {"first_rows": rows},
            "products": {"products": rows},
            "members": {"variants": rows},
            "groups": {"groups": rows, "answered": F.count_if("answered")},
            "images": {"images": rows},
            "rows": {"lines": rows, "files": F.count_if((F.col("batch_row") - 1) % max_rows == 0)},
        }
    )
    with compiled_methods(spark):
        products = stored(parse_catalog(raw, watch=counters.watch), folder, "parsed")
        members = stored(counters.watch("members", leader_groups(products, written=True)), folder, "members")
        counters.watch("images", group_images(members)).write.mode("overwrite").parquet(f"{path}/images")
        variants, groups = _import_parts(members, responses, groups_per_batch, None, counters.watch)
        lines = catalogue_files(import_projection(variants, groups, tuple(k for k in KEPT if k != "group_no")), max_rows)
        write_import_files(counters.watch("rows", lines).drop("n_batches"), f"{path}/files", ["group_index", "line_no"])
    stats = {
        "total_rows_read": counters["rows_read"],
        "valid_products": counters["products"],
        "skipped_duplicates": counters["coded"] - counters["first_rows"],
        "skipped_incomplete": counters["rows_read"] - counters["coded"] + counters["first_rows"] - counters["products"],
        "parsing_errors": 0,
        "total_product_groups": counters["groups"],
        "total_variants": counters["variants"],
        "successfully_processed": counters["answered"],
        "failed_enrichment": counters["groups"] - counters["answered"],
        "total_images": counters["images"],
        "csv_rows_generated": counters["lines"],
        "output_files_generated": counters["files"],
    }
    return spark.createDataFrame([tuple(stats.values())], ", ".join(f"{name} bigint" for name in stats))


def import_columns(rows: DataFrame) -> DataFrame:
    return rows.select(*[F.col(f"`{c}`") for c in IMPORT_COLUMNS])
