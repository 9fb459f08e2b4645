"""Times the headline queries on $BENCH_SF_DIR and prints one JSON line.

Every query runs over whole tables into a sink that drops the rows. The wide catalogue has one row
per sale (as many as ``lineitem``), the others one per part, page or document.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from checks import output, pages, parsing  # noqa: E402
from checks.views import VIEWS, view  # noqa: E402
from wareflow.functions.text import number_text  # noqa: E402
from wareflow.operators import cleaning, direct, export, requests, validation  # noqa: E402
from wareflow.operators.grouping import leader_groups  # noqa: E402
from wareflow.operators.shared import shared_folder, stored  # noqa: E402
from wareflow.plans.catalogue import catalogue_import, groups_of, grouped_products  # noqa: E402


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        # the JVM never compiles larger methods; past this size Spark splits the code by expression
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def drop(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session()
    # the derived catalogue is input, not part of what is measured
    folder = shared_folder(spark)
    wide = stored(view(spark, sf_dir, "wide"), folder, "wide")
    wide_imp = stored(view(spark, sf_dir, "wide_imp"), folder, "wide-imp")
    html = stored(view(spark, sf_dir, "img"), folder, "img")
    hits = stored(view(spark, sf_dir, "hits"), folder, "hits")
    variants = stored(output.opts(spark, sf_dir), folder, "variants")
    keys = stored(view(spark, sf_dir, "keys"), folder, "keys")
    replies = stored(spark.sql(VIEWS["resp"], keys=keys), folder, "resp")
    to_enrich = keys.select("row_no", "brand", F.col("name").alias("base_name"), "price")

    # answers come from outside; they are made before the clock starts
    asked = groups_of(grouped_products(wide)).select(
        F.col("group_no").alias("row_no"), "brand", F.col("base_name").alias("name"), number_text(F.col("price")).alias("price_text")
    )
    answered = stored(spark.sql(VIEWS["resp"], keys=asked), folder, "replies")

    def full_import() -> DataFrame:
        return catalogue_import(grouped_products(wide), answered)

    queries = {
        "parse_catalog": lambda: cleaning.parse_catalog(wide),
        "parse_rejects": lambda: cleaning.parse_rejects(wide),
        "parse_stats": lambda: cleaning.parse_stats(wide),
        "direct_rows": lambda: direct.direct_rows(wide),
        "leader_groups": lambda: leader_groups(cleaning.parse_catalog(wide)),
        "full_import": full_import,
        "validation_report": lambda: validation.validation_report(wide_imp),
        "option_values": lambda: export.option_values(variants),
        "extract_images": lambda: html.select("url", pages.im.extract_images(F.col("url"), F.col("html"), F.col("product_name"))),
        "pick_url": lambda: pages.pick_url(hits),
        "slug": lambda: parsing.QUERIES["slug"][0](spark, sf_dir),
        "apply_batch": lambda: requests.apply_batch(to_enrich, replies),
        "incremental_ingest": lambda: output.ingest_twice(spark, wide),
    }
    drop(spark.range(1000).select(F.md5(F.col("id").cast("string"))))
    times = {}
    for name, query in queries.items():
        start = time.perf_counter()
        drop(query())
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "rows": {"wide_catalogue": wide.count(), "html_pages": html.count(), "search_results": hits.count()},
            }
        )
    )


if __name__ == "__main__":
    main()
