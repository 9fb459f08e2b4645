"""Checks of a finished import table; each returns (rule, severity, handle, row_no, detail)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REQUIRED = ["Handle", "Title", "Vendor", "Variant Price"]
# Limits of one product, and the categories known to be valid.
LIMITS = {
    "handle_max_length": 255,
    "title_max_length": 255,
    "description_max_length": 5000,
    "tag_max_length": 50,
    "tag_min_count": 6,
    "tag_max_count": 10,
    "price_min": 0,
    "price_max": 999999,
    "max_images_per_product": 3,
}
KNOWN_CATEGORIES = [
    "Health & Beauty > Hair Care", "Health & Beauty > Skin Care", "Health & Beauty > Makeup",
    "Health & Beauty > Bath & Body", "Health & Beauty > Oral Care", "Health & Beauty > Fragrance",
    "Health & Beauty > Nail Care", "Health & Beauty > Personal Care", "Home & Garden > Home Decor",
]
_SLOTS = (1, 2, 3)


def _text(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def _violation(rule: str, severity: str, handle: Column, row_no: Column, detail: Column) -> list[Column]:
    return [
        F.lit(rule).alias("rule"),
        F.lit(severity).alias("severity"),
        handle.cast("string").alias("handle"),
        row_no.cast("bigint").alias("row_no"),
        detail.alias("detail"),
    ]



def check_category_format(rows: DataFrame) -> DataFrame:
    """Distinct categories without ``>`` are errors; no category anywhere is a warning."""
    nothing = F.lit(None)
    filled = rows.select(_text("Product Category").alias("_c")).where("_c <> ''").distinct()
    wrong = filled.where(~F.contains("_c", F.lit(">"))).select(
        *_violation("category_format", "error", nothing, nothing, F.col("_c"))
    )
    none = filled.agg(F.count("*").alias("_n")).where("_n = 0").select(
        *_violation("category_format", "warning", nothing, nothing, F.lit("no product categories"))
    )
    return wrong.unionByName(none)


def _several_names(slot: int) -> Column:
    # lowest and highest differ exactly when there are two names; no set is collected
    name = F.nullif(_text(f"Option{slot} Name"), F.lit(""))
    return (F.coalesce(F.min(name) != F.max(name), F.lit(False))).alias(f"_{slot}")


def check_option_names(rows: DataFrame) -> DataFrame:
    """Handles whose rows name an option slot differently; the detail lists the slots."""
    per_handle = rows.groupBy(_text("Handle").alias("_h")).agg(*[_several_names(i) for i in _SLOTS])
    slots = F.concat_ws(",", *[F.when(F.col(f"_{i}"), F.lit(f"Option{i}")) for i in _SLOTS])
    return per_handle.where(" OR ".join(f"_{i}" for i in _SLOTS)).select(
        *_violation("option_names", "error", F.col("_h"), F.lit(None), slots)
    )


def check_option_pairs(rows: DataFrame) -> DataFrame:
    """Option values without a name, one violation per slot and row."""
    slots = F.array(
        *[
            F.when((_text(f"Option{i} Name") == "") & (_text(f"Option{i} Value") != ""), F.lit(f"Option{i}"))
            for i in _SLOTS
        ]
    )
    hits = rows.select("row_no", _text("Handle").alias("_h"), F.explode(F.array_compact(slots)).alias("_s"))
    return hits.select(*_violation("option_pairs", "error", F.col("_h"), F.col("row_no"), F.col("_s")))


def check_required(rows: DataFrame) -> DataFrame:
    """Rows with an empty required column; the detail lists the missing ones."""
    missing = F.concat_ws(", ", *[F.when(_text(c) == "", F.lit(c)) for c in REQUIRED])
    hits = rows.select("row_no", _text("Handle").alias("_h"), missing.alias("_m")).where("_m <> ''")
    return hits.select(*_violation("required", "error", F.col("_h"), F.col("row_no"), F.col("_m")))


def violations(rows: DataFrame) -> DataFrame:
    checks = [check_category_format, check_option_names, check_option_pairs, check_required]
    return reduce(DataFrame.unionByName, [check(rows) for check in checks])


def validation_report(rows: DataFrame) -> DataFrame:
    """One row: products, rows, errors, warnings, passed. A row counts once however much it lacks."""
    # one pass by handle, one by category; the single checks list what is counted here
    pairs = reduce(Column.__add__, [((_text(f"Option{i} Name") == "") & (_text(f"Option{i} Value") != "")).cast("bigint") for i in _SLOTS])
    lacking = reduce(Column.__or__, [_text(c) == "" for c in REQUIRED]).cast("bigint")
    per_handle = rows.groupBy(_text("Handle").alias("_h")).agg(
        F.count("*").alias("_rows"), F.sum(pairs + lacking).alias("_errors"), *[_several_names(i) for i in _SLOTS]
    )
    mixed = reduce(Column.__or__, [F.col(f"_{i}") for i in _SLOTS]).cast("bigint")
    categories = rows.select(_text("Product Category").alias("_c")).where("_c <> ''").distinct()
    found = categories.agg(F.struct(F.count("*").alias("n"), F.count_if(~F.contains("_c", F.lit(">"))).alias("wrong")))
    return (
        per_handle.agg(
            F.count("*").alias("products"), F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.col("_errors") + mixed), F.lit(0)).alias("_found")
        )
        .withColumn("_categories", found.scalar())
        .select("products", "rows", (F.col("_found") + F.col("_categories.wrong")).alias("errors"), F.when(F.col("_categories.n") == 0, 1).otherwise(0).cast("bigint").alias("warnings"))
        .withColumn("passed", F.col("errors") == 0)
    )


def check_output_sample(rows: DataFrame, sample: int = 10) -> DataFrame:
    """One row: are the required columns and rows there, is one of the first rows complete?"""
    missing = [c for c in REQUIRED if c not in rows.columns]
    head = rows.orderBy("row_no").limit(sample)
    complete = reduce(
        lambda a, b: a & b,
        [(_text(c) != "") if c in rows.columns else F.lit(False) for c in REQUIRED[:3]],
    )
    return head.agg(
        F.lit(not missing).alias("has_columns"),
        (F.count("*") > 0).alias("has_rows"),
        F.count(F.when(complete, 1)).alias("complete_rows"),
    ).withColumn("passed", F.col("has_columns") & F.col("has_rows") & (F.col("complete_rows") > 0))


def product_listing(rows: DataFrame) -> DataFrame:
    """All rows of the first handle, shortened for reading."""
    first = rows.orderBy("row_no").limit(1).select("Handle")

    def brief(column: str, n: int) -> Column:
        text = _text(column)
        return F.when(text == "", F.lit("EMPTY")).otherwise(F.concat(F.substring(text, 1, n), F.lit("...")))

    return rows.join(first, "Handle", "left_semi").select(
        "row_no",
        F.col("Handle").alias("handle"),
        brief("Title", 40).alias("title"),
        *[_text(f"Option{i} {p}").alias(f"option{i}_{p.lower()}") for i in _SLOTS for p in ("Name", "Value")],
        brief("Image Src", 50).alias("image"),
    )


def check_limits(products: DataFrame) -> DataFrame:
    """(product_no, rule) for each limit a product breaks.

    ``products``: product_no, handle, title, description, tags (array), price, n_images.
    """
    n_tags = F.size("tags")
    broken = {
        "handle_max_length": F.length("handle") > LIMITS["handle_max_length"],
        "title_max_length": F.length("title") > LIMITS["title_max_length"],
        "description_max_length": F.length("description") > LIMITS["description_max_length"],
        "tag_max_length": F.exists("tags", lambda t: F.length(t) > LIMITS["tag_max_length"]),
        "tag_min_count": n_tags < LIMITS["tag_min_count"],
        "tag_max_count": n_tags > LIMITS["tag_max_count"],
        "price_min": F.col("price") < LIMITS["price_min"],
        "price_max": F.col("price") > LIMITS["price_max"],
        "max_images_per_product": F.col("n_images") > LIMITS["max_images_per_product"],
    }
    rules = F.array_compact(F.array(*[F.when(test, F.lit(rule)) for rule, test in broken.items()]))
    return products.select("product_no", F.explode(rules).alias("rule"))


def check_known_category(products: DataFrame, category: str = "category") -> DataFrame:
    """Rows whose category is not one of the known ones."""
    return products.where(~F.coalesce(F.col(category), F.lit("")).isin(KNOWN_CATEGORIES))
