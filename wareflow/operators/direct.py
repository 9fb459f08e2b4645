"""Import rows straight from the price list, without grouping or enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wareflow.functions import cleaning as c
from wareflow.functions.text import slug
from wareflow.operators.handles import unique_handles_counter
from wareflow.operators.layouts import DIRECT_COLUMNS
from wareflow.operators.shared import shared_folder, stored

# Columns every product row carries unchanged.
CONSTANTS = {
    "Published": "TRUE",
    "Variant Inventory Tracker": "shopify",
    "Variant Inventory Policy": "deny",
    "Variant Fulfillment Service": "manual",
    "Variant Requires Shipping": "TRUE",
    "Gift Card": "FALSE",
    "Google Shopping / Condition": "new",
    "Google Shopping / Custom Product": "FALSE",
    "Variant Weight Unit": "kg",
    "Included / International": "International",
    "Status": "active",
}


def direct_body(english: Column, arabic: Column) -> Column:
    return F.concat(
        F.lit("<p>"), english, F.lit("</p>"),
        F.coalesce(F.concat(F.lit("<p dir='rtl'>"), arabic, F.lit("</p>")), F.lit("")),
    )


def is_taxable(tax: Column) -> Column:
    text = F.upper(F.coalesce(tax, F.lit("")))
    hit = F.contains(text, F.lit("15%")) | F.contains(text, F.lit("TAX"))
    return F.when(hit, "TRUE").otherwise("FALSE")


def direct_tags(brand: Column, category: Column, sub_category: Column) -> Column:
    return F.concat_ws(", ", brand, category, sub_category)


def direct_products(raw: DataFrame) -> DataFrame:
    """Cleaned rows, one per usable price-list row; nothing is deduplicated here."""
    cells = ("brand", "upc", "name", "name_ar", "cost", "tax", "category", "sub_category")
    clean = raw.withColumns({n: c.null_if_missing(F.col(n)) for n in cells})
    return clean.select(
        "row_no",
        c.brand_or_unknown(F.col("brand")).alias("brand"),
        F.coalesce("upc", F.lit("")).alias("upc"),
        "name",
        "name_ar",
        c.number(F.col("cost")).alias("cost"),
        F.col("cost").isNotNull().alias("_has_cost"),
        "tax",
        "category",
        "sub_category",
        c.image_cells_multi(F.col("image_1"), F.col("image_2"), F.col("image_3")).alias("images"),
    )


def direct_usable(products: DataFrame) -> DataFrame:
    return products.where("name IS NOT NULL AND (cost IS NOT NULL OR NOT _has_cost)").drop("_has_cost")


def direct_rejects(raw: DataFrame) -> DataFrame:
    """(row_no, reason) of rows without a name or with an unreadable cost."""
    reason = F.when(F.col("name").isNull(), "incomplete").otherwise("bad cost")
    return direct_products(raw).where("name IS NULL OR (_has_cost AND cost IS NULL)").select("row_no", reason.alias("reason"))


def direct_handles(products: DataFrame) -> DataFrame:
    return unique_handles_counter(products, slug(F.concat_ws("-", "brand", "name")))


def direct_rows(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The 50 import columns: a full row per product, a short row for each image after the first.

    One explode makes both kinds of rows, so the price list is read once for them.
    ``keep`` may name ``row_no`` and ``image_no`` (0 for the full row).
    """
    # cleaned once, used for the handles and for the rows; the filter then reaches the stored columns
    products = direct_usable(stored(direct_products(raw), shared_folder(raw.sparkSession), "direct"))
    rows = products.join(direct_handles(products), "row_no").select(
        "*", F.posexplode_outer("images").alias("_i", "image_src")
    )
    rows = rows.withColumn("image_no", F.coalesce("_i", F.lit(0)))
    full = F.col("image_no") == 0
    empty = F.lit("")

    def once(value):
        return F.when(full, F.coalesce(value, empty)).otherwise(empty)

    def once_number(value):
        return F.when(full, value)

    image = F.coalesce("image_src", empty)
    category = F.coalesce("category", empty)
    values = {
        "Handle": F.col("handle"),
        "Title": once(F.col("name")),
        "Body (HTML)": once(direct_body(F.col("name"), F.col("name_ar"))),
        "Vendor": once(F.col("brand")),
        "Product Category": once(category),
        "Type": once(F.coalesce("sub_category", "category")),
        "Tags": once(direct_tags(F.col("brand"), F.col("category"), F.col("sub_category"))),
        "Variant SKU": once(F.col("upc")),
        "Variant Inventory Qty": once_number(F.lit(1)),
        "Variant Price": once_number(F.col("cost")),
        "Variant Taxable": once(is_taxable(F.col("tax"))),
        "Variant Barcode": once(F.col("upc")),
        "Image Src": image,
        "Image Position": F.when(F.col("image_src").isNotNull(), F.col("image_no") + 1),
        "Image Alt Text": F.col("name"),
        "SEO Title": once(F.substring("name", 1, 70)),
        "SEO Description": once(F.substring("name", 1, 160)),
        "Google Shopping / Google Product Category": once(category),
        "Google Shopping / MPN": once(F.col("upc")),
        "Google Shopping / Custom Label 0": once(F.col("brand")),
        "Google Shopping / Custom Label 1": once(category),
        "Variant Image": once(image),
        "Cost per item": once_number(F.col("cost")),
        "Price / International": once_number(F.col("cost")),
        **{name: once(F.lit(text)) for name, text in CONSTANTS.items()},
    }
    return rows.select(*keep, *[values.get(c, empty).alias(c) for c in DIRECT_COLUMNS])


def direct_projection(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The product rows alone."""
    columns = tuple(dict.fromkeys([*keep, "image_no"]))
    out = direct_rows(raw, columns).where("image_no = 0")
    return out if "image_no" in keep else out.drop("image_no")


def direct_image_rows(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The rows of images 2..n alone."""
    columns = tuple(dict.fromkeys([*keep, "image_no"]))
    out = direct_rows(raw, columns).where("image_no > 0")
    return out if "image_no" in keep else out.drop("image_no")


def convert_stats(raw: DataFrame) -> DataFrame:
    """One row: products, import rows, distinct handles and brands."""
    products = direct_usable(stored(direct_products(raw), shared_folder(raw.sparkSession), "direct"))
    rows = F.greatest(F.size("images"), F.lit(1))
    handles = direct_handles(products).agg(F.count_distinct("handle")).scalar()
    return products.agg(
        F.count("*").alias("products"),
        F.coalesce(F.sum(rows), F.lit(0)).alias("import_rows"),
        handles.alias("unique_handles"),
        F.count_distinct("brand").alias("brands"),
    )
