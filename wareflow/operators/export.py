"""Import rows of the main path: options, images and the 58-column projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wareflow.functions import options as o
from wareflow.operators.layouts import IMPORT_COLUMNS, METAFIELDS
from wareflow.operators.ordering import running

MAX_OPTIONS = 3
MIN_SHARE = 0.3


def standard_options(variants: DataFrame) -> DataFrame:
    """(group_no, option1, option2, option3): standard names used by enough variants of a group.

    A name counts once per variant and must reach 30 % of the group's variants (at least one), so
    the list collected per group stays short however large the group is.
    """
    sizes = variants.groupBy("group_no").agg(F.count("*").alias("_n"))
    counts = (
        variants.select(
            "group_no",
            F.explode(
                F.array_distinct(F.transform(o.normal_options(F.col("options")), lambda x: x["name"]))
            ).alias("_name"),
        )
        .groupBy("group_no", "_name")
        .agg(F.count("*").alias("_used"))
    )
    enough = F.col("_used") >= F.greatest(F.lit(1.0), F.col("_n") * F.lit(MIN_SHARE))
    named = (
        sizes.join(counts, "group_no", "left")
        .groupBy("group_no")
        .agg(F.sort_array(F.collect_list(F.when(enough, F.col("_name")))).alias("_names"))
    )
    return named.select(
        "group_no",
        *[F.coalesce(F.get("_names", F.lit(i)), F.lit("")).alias(f"option{i + 1}") for i in range(MAX_OPTIONS)],
    )


def option_values(variants: DataFrame, standard: DataFrame | None = None) -> DataFrame:
    """Variants with option1..3 (names) and value1..3."""
    standard = standard_options(variants) if standard is None else standard
    return _with_values(variants.join(standard, "group_no"))


def _with_values(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("_options", o.normal_options(F.col("options")))
    return rows.select(
        *[c for c in rows.columns if c != "_options"],
        *[o.option_value(F.col("_options"), F.col(f"option{i}")).alias(f"value{i}") for i in (1, 2, 3)],
    )


def image_counters(variants: DataFrame) -> DataFrame:
    """Adds ``_images`` and, over the whole group, the running numbers of images and import rows."""
    n_images = F.coalesce(F.size("images"), F.lit(0))
    counted = variants.withColumn("_images", F.when(n_images > 0, n_images).otherwise(0).cast("bigint"))
    upto = {"_image_upto": F.col("_images"), "_line_upto": F.greatest("_images", F.lit(1))}
    return running(counted, "row_no", upto, ["group_no"])


def explode_images(counted: DataFrame) -> DataFrame:
    """One row per image, see ``variant_image_rows``; takes the columns of ``image_counters``."""
    helpers = ["_images", "_image_upto", "_line_upto"]
    rows = counted.select("*", F.posexplode_outer("images").alias("_i", "image_src"))
    index = F.coalesce("_i", F.lit(0))
    position = F.col("_image_upto") - F.col("_images") + index + 1
    line = F.col("_line_upto") - F.greatest("_images", F.lit(1)) + index + 1
    return rows.select(
        *[c for c in counted.columns if c not in helpers],
        "image_src",
        F.when(F.col("image_src").isNotNull(), position.cast("int")).alias("image_position"),
        (index == 0).alias("first_row"),
        line.alias("line_no"),
    )


def variant_image_rows(variants: DataFrame) -> DataFrame:
    """One row per image of each variant, one row for a variant without images.

    Adds ``image_src``, ``image_position`` (1.. over the whole group), ``first_row`` (first row of
    its variant) and ``line_no`` (1.. over the whole group). Groups may be of any size: positions
    are running sums of image counts.
    """
    return explode_images(image_counters(variants))


def import_projection(variants: DataFrame, groups: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The 58 import columns.

    ``variants``: row_no, group_no, brand, upc, name, price, images, options.
    ``groups``: group_no, handle, title, description, category, tags and the five metafields.
    ``keep`` names further columns to carry along (``group_no``, ``line_no``, or any of ``groups``).
    """
    shared = groups.select(
        "group_no", "handle", "title", "description", "category", "tags", *METAFIELDS.values(),
        *[c for c in keep if c not in ("group_no", "line_no")],
    )
    variants = variants.select("row_no", "group_no", "brand", "upc", "name", "price", "images", "options")
    # the counters come first: they split large groups, and no later step needs a group in one place
    counted = image_counters(variants).join(shared.join(standard_options(variants), "group_no"), "group_no")
    rows = explode_images(_with_values(counted))
    primary = F.col("row_no") == F.col("group_no")
    empty = F.lit("")

    def on(condition, value):
        return F.when(condition, F.coalesce(value, empty)).otherwise(empty)

    def constant(condition, text):
        return F.when(condition, F.lit(text)).otherwise(empty)

    first = F.col("first_row")
    values = {
        "Handle": F.col("handle"),
        "Title": on(primary, F.col("title")),
        "Body (HTML)": on(primary, F.col("description")),
        "Vendor": F.col("brand"),
        "Type": o.type_from_category(F.col("category")),
        "Tags": on(primary, F.array_join("tags", ",")),
        "Published": constant(primary, "TRUE"),
        "Status": constant(primary, "active"),
        **{f"Option{i} Name": F.col(f"option{i}") for i in (1, 2, 3)},
        **{f"Option{i} Value": F.col(f"value{i}") for i in (1, 2, 3)},
        "Variant SKU": on(first, F.col("upc")),
        "Variant Inventory Tracker": constant(first, "shopify"),
        "Variant Inventory Policy": constant(first, "continue"),
        "Variant Fulfillment Service": constant(first, "manual"),
        "Variant Barcode": on(first, F.col("upc")),
        "Variant Price": F.col("price"),
        "Variant Requires Shipping": F.lit("TRUE"),
        "Variant Taxable": F.lit("TRUE"),
        "Image Src": F.coalesce("image_src", empty),
        "Image Position": F.col("image_position"),
        "Image Alt Text": F.when(F.col("image_src").isNotNull(), F.concat_ws(" ", "brand", "name")).otherwise(empty),
        "Gift Card": F.lit("FALSE"),
        **{column: on(primary, F.col(field)) for column, field in METAFIELDS.items()},
    }
    return rows.select(*keep, *[values.get(c, empty).alias(c) for c in IMPORT_COLUMNS])


def column_order(df: DataFrame, columns: list[str] = IMPORT_COLUMNS) -> DataFrame:
    """Exactly these columns in this order; missing ones are empty text."""
    present = set(df.columns)
    return df.select(*[F.col(f"`{c}`") if c in present else F.lit("").alias(c) for c in columns])
