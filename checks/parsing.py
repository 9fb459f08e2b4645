"""Cleaning, dedupe, the direct conversion."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.views import duck, filled, image_list, products, view
from wareflow.functions import cleaning as c
from wareflow.functions.options import type_from_category
from wareflow.functions.text import slug
from wareflow.operators import cleaning, direct
from wareflow.operators.cleaning import parse_catalog
from wareflow.operators.layouts import DIRECT_COLUMNS
from wareflow.operators.ordering import global_row_index
from wareflow.operators.shared import shared_folder
from wareflow.sources.catalog import OPTIONAL, read_direct_catalog, read_products

Query = tuple[Callable[[SparkSession, str], DataFrame], str | None]


def cat(spark, sf_dir):
    return view(spark, sf_dir, "cat")


def images_as_text(df: DataFrame) -> DataFrame:
    return df.withColumn("images", F.array_join("images", "|"))


def in_order(df: DataFrame) -> DataFrame:
    """Rows with their position by ``row_no`` in its place."""
    return global_row_index(df, "row_no", "nth").drop("row_no")


PROD_COLUMNS = (
    "row_no, brand, upc, name, quantity, price, tax, vat_percentage, total_with_vat, category, "
    "array_to_string(images, '|') AS images"
)

MARKED_DUCK = f"""
SELECT row_no, code, {filled('name')} AS nm, row_number() OVER (PARTITION BY code ORDER BY row_no) AS nth
FROM (SELECT *, {filled('upc')} AS code FROM cat)
"""


def slug_sql(text: str) -> str:
    """DuckDB: handle text of any text."""
    kept = f"regexp_replace(strip_accents(lower({text})), '[^a-z0-9\\s\\-]', '', 'g')"
    out = f"left(trim(regexp_replace(regexp_replace({kept}, '\\s+', '-', 'g'), '-+', '-', 'g'), '-'), 255)"
    return f"CASE WHEN {out} = '' THEN 'product' ELSE {out} END"


DIRECT_DUCK = f"""
SELECT *, CASE WHEN nth = 1 THEN base ELSE base || '-' || (nth - 1) END AS handle FROM (
  SELECT *, row_number() OVER (PARTITION BY base ORDER BY row_no) AS nth FROM (
    SELECT *, {slug_sql("brand || '-' || name")} AS base FROM (
      SELECT row_no, coalesce({filled('brand')}, 'Unknown') AS brand, coalesce({filled('upc')}, '') AS upc,
        {filled('name')} AS name, {filled('name_ar')} AS name_ar, try_cast({filled('cost')} AS DOUBLE) AS cost,
        {filled('tax')} AS tax, {filled('category')} AS category, {filled('sub_category')} AS sub_category,
        {image_list('image_1', 'image_2', 'image_3')} AS images
      FROM cat WHERE {filled('name')} IS NOT NULL AND ({filled('cost')} IS NULL OR try_cast({filled('cost')} AS DOUBLE) IS NOT NULL))))
"""
_DIRECT = {
    "Handle": "handle", "Title": "name",
    "Body (HTML)": "'<p>' || name || '</p>' || coalesce('<p dir=''rtl''>' || name_ar || '</p>', '')",
    "Vendor": "brand", "Product Category": "coalesce(category, '')",
    "Type": "coalesce(sub_category, category, '')", "Tags": "concat_ws(', ', brand, category, sub_category)",
    "Published": "'TRUE'", "Variant SKU": "upc", "Variant Inventory Tracker": "'shopify'",
    "Variant Inventory Qty": "1", "Variant Inventory Policy": "'deny'", "Variant Fulfillment Service": "'manual'",
    "Variant Price": "cost", "Variant Requires Shipping": "'TRUE'",
    "Variant Taxable": "CASE WHEN contains(upper(coalesce(tax, '')), '15%') OR contains(upper(coalesce(tax, '')), 'TAX') THEN 'TRUE' ELSE 'FALSE' END",
    "Variant Barcode": "upc", "Image Src": "coalesce(images[1], '')",
    "Image Position": "CASE WHEN len(images) > 0 THEN 1 END", "Image Alt Text": "name", "Gift Card": "'FALSE'",
    "SEO Title": "left(name, 70)", "SEO Description": "left(name, 160)",
    "Google Shopping / Google Product Category": "coalesce(category, '')", "Google Shopping / MPN": "upc",
    "Google Shopping / Condition": "'new'", "Google Shopping / Custom Product": "'FALSE'",
    "Google Shopping / Custom Label 0": "brand", "Google Shopping / Custom Label 1": "coalesce(category, '')",
    "Variant Image": "coalesce(images[1], '')", "Variant Weight Unit": "'kg'", "Cost per item": "cost",
    "Included / International": "'International'", "Price / International": "cost", "Status": "'active'",
}
DIRECT_SELECT = ", ".join(f"""{_DIRECT.get(n, "''")} AS "{n}\"""" for n in DIRECT_COLUMNS)

_NUMERIC = {"Variant Inventory Qty", "Variant Price", "Cost per item", "Price / International"}
_IMAGE = {
    "Handle": "handle", "Image Src": "src", "Image Position": "pos", "Image Alt Text": "name",
    **{n: f"CAST(NULL AS {'INTEGER' if n.endswith('Qty') else 'DOUBLE'})" for n in _NUMERIC},
}
IMAGE_SELECT = ", ".join(f"""{_IMAGE.get(n, "''")} AS "{n}\"""" for n in DIRECT_COLUMNS)

STRICT = ", ".join(f"trim({cell})" for cell in ("image_1", "image_2", "image_3"))


def _cells(spark, sf_dir, fn):
    return cat(spark, sf_dir).select(
        "row_no", F.array_join(fn(F.col("image_1"), F.col("image_2"), F.col("image_3")), "|").alias("images")
    )


# products with some fields spoiled
SPOILED = """SELECT row_no, CASE WHEN row_no % 7 = 0 THEN '' ELSE name END AS name, CASE WHEN row_no % 11 = 0 THEN '' ELSE upc END AS upc,
  CASE WHEN row_no % 13 = 0 THEN -price ELSE price END AS price, CASE WHEN row_no % 17 = 0 THEN 0 ELSE quantity END AS quantity FROM {prod}"""


IN_ORDER_COLUMNS = "row_number() OVER (ORDER BY row_no) AS nth, " + PROD_COLUMNS.removeprefix("row_no, ")


def price_list_files(s, d, mixed: bool = True, folder: str | None = None) -> list[str]:
    """The catalogue as three sets of CSV files in row order: UTF-8, UTF-8 with mark, ISO-8859-1.

    With `mixed`, the second has the other layout and its columns in another order, and none has the
    Arabic name, which ISO-8859-1 cannot hold; without, all are UTF-8 and have it.
    """
    folder, rows = folder or shared_folder(s), view(s, d, "fcat")
    cuts = rows.select(F.expr("percentile_approx(row_no, array(0.3, 0.7))")).scalar()
    rows = rows.withColumn("_cuts", cuts)
    named = {"brand": "PIM | Brand", "upc": "UPC Code", "name": "English Description", "cost": "COST", **OPTIONAL}
    other = {"tax": "TAX  ", "upc": "UPC Code", "name": "Name", "image_1": "Image 1 URL", "cost": "PRICE", "brand": "PIM | Brand", **OPTIONAL}
    arabic = {} if mixed else {"name_ar": "Arabic Description"}
    low, high = F.col("_cuts")[0], F.col("_cuts")[1]
    parts = [
        ("a", F.col("row_no") <= low, {**named, **arabic}, "UTF-8", ""),
        ("b", (F.col("row_no") > low) & (F.col("row_no") <= high), other if mixed else {**named, **arabic}, "UTF-8", "\ufeff"),
        ("c", F.col("row_no") > high, {**named, **arabic}, "ISO-8859-1" if mixed else "UTF-8", ""),
    ]
    for name, test, columns, encoding, mark in parts:
        own = rows.where(test).repartitionByRange(2, "row_no").sortWithinPartitions("row_no")
        cells = [F.col(c).alias(mark + title if i == 0 else title) for i, (c, title) in enumerate(columns.items())]
        options = {"header": True, "escape": '"', "encoding": encoding, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        own.select(*cells).write.options(**options).csv(f"{folder}/{name}")
    return [f"{folder}/{name}" for name, *_ in parts]


QUERIES: dict[str, Query] = {
    "parse_catalog": (
        lambda s, d: images_as_text(products(s, d)),
        duck(f"SELECT {PROD_COLUMNS} FROM prod", "prod"),
    ),
    "parse_rejects": (
        lambda s, d: cleaning.parse_rejects(cat(s, d)),
        duck(
            "SELECT row_no, CASE WHEN code IS NULL THEN 'incomplete' WHEN nth > 1 THEN 'duplicate' ELSE 'incomplete' END AS reason "
            f"FROM ({MARKED_DUCK}) WHERE code IS NULL OR nth > 1 OR nm IS NULL",
            "cat",
        ),
    ),
    "parse_stats": (
        lambda s, d: cleaning.parse_stats(cat(s, d)),
        duck(
            f"""SELECT count(*) AS total_rows_read,
              count(*) FILTER (code IS NOT NULL AND nth = 1 AND nm IS NOT NULL) AS valid_products,
              count(*) FILTER (code IS NOT NULL AND nth > 1) AS skipped_duplicates,
              count(*) FILTER (code IS NULL OR (nth = 1 AND nm IS NULL)) AS skipped_incomplete,
              CAST(0 AS BIGINT) AS parsing_errors FROM ({MARKED_DUCK})""",
            "cat",
        ),
    ),
    "valid_products": (
        lambda s, d: s.sql(SPOILED, prod=products(s, d)).select(
            "row_no",
            c.is_valid_product(F.col("name"), F.col("upc"), F.col("price"), F.col("quantity")).alias("valid"),
        ),
        duck(f"SELECT row_no, name <> '' AND upc <> '' AND coalesce(price, 0) >= 0 AND quantity > 0 AS valid FROM ({SPOILED.format(prod='prod')})", "prod"),
    ),
    "read_products_files": (
        lambda s, d: in_order(images_as_text(parse_catalog(read_products(s, price_list_files(s, d))))),
        duck(f"SELECT {IN_ORDER_COLUMNS} FROM fprod", "fprod"),
    ),
    "read_direct_files": (
        lambda s, d: in_order(direct.direct_projection(read_direct_catalog(s, price_list_files(s, d, mixed=False)), ("row_no",))),
        duck(f"SELECT row_number() OVER (ORDER BY row_no) AS nth, {DIRECT_SELECT} FROM ({DIRECT_DUCK.replace('FROM cat', 'FROM fcat')})", "fcat"),
    ),
    "image_cells_strict": (
        lambda s, d: _cells(s, d, c.image_cells_strict),
        duck(f"SELECT row_no, array_to_string(list_filter([{STRICT}], lambda u: u LIKE 'http%'), '|') AS images FROM cat", "cat"),
    ),
    "image_cells_multi": (
        lambda s, d: _cells(s, d, c.image_cells_multi),
        duck(f"SELECT row_no, array_to_string({image_list('image_1', 'image_2', 'image_3')}, '|') AS images FROM cat", "cat"),
    ),
    "first_by_upc": (
        lambda s, d: cleaning.first_by_upc(cat(s, d).withColumn("upc", c.null_if_missing(F.col("upc")))).select("upc", "row_no"),
        duck(f"SELECT code AS upc, min(row_no) AS row_no FROM ({MARKED_DUCK}) WHERE code IS NOT NULL GROUP BY code", "cat"),
    ),
    "type_from_category": (
        lambda s, d: products(s, d).select("row_no", type_from_category(F.col("category")).alias("type")),
        duck(
            "SELECT row_no, CASE WHEN contains(category, '>') THEN trim(string_split(category, '>')[-1]) ELSE category END AS type FROM prod",
            "prod",
        ),
    ),
    "slug": (
        lambda s, d: view(s, d, "documents").select("doc_id", slug(F.col("text")).alias("slug")),
        f"SELECT doc_id, {slug_sql('text')} AS slug FROM documents",
    ),
    "direct_projection": (
        lambda s, d: direct.direct_projection(cat(s, d)),
        duck(f"SELECT {DIRECT_SELECT} FROM ({DIRECT_DUCK})", "cat"),
    ),
    "direct_image_rows": (
        lambda s, d: direct.direct_image_rows(cat(s, d)),
        duck(
            f"SELECT {IMAGE_SELECT} FROM (SELECT handle, name, unnest(images) AS src, generate_subscripts(images, 1) AS pos FROM ({DIRECT_DUCK})) WHERE pos > 1",
            "cat",
        ),
    ),
    "direct_rejects": (
        lambda s, d: direct.direct_rejects(cat(s, d)),
        duck(
            f"SELECT row_no, CASE WHEN {filled('name')} IS NULL THEN 'incomplete' ELSE 'bad cost' END AS reason FROM cat "
            f"WHERE {filled('name')} IS NULL OR ({filled('cost')} IS NOT NULL AND try_cast({filled('cost')} AS DOUBLE) IS NULL)",
            "cat",
        ),
    ),
    "unique_handles_counter": (
        lambda s, d: direct.direct_handles(direct.direct_usable(direct.direct_products(cat(s, d)))),
        duck(f"SELECT row_no, handle FROM ({DIRECT_DUCK})", "cat"),
    ),
    "convert_stats": (
        lambda s, d: direct.convert_stats(cat(s, d)),
        duck(
            f"SELECT count(*) AS products, CAST(sum(greatest(len(images), 1)) AS BIGINT) AS import_rows, count(DISTINCT handle) AS unique_handles, count(DISTINCT brand) AS brands FROM ({DIRECT_DUCK})",
            "cat",
        ),
    ),
}
assert all(re.fullmatch(r"[a-z_]+", name) for name in QUERIES)
