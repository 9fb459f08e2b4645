"""Cleaning rules for raw price-list cells (all STRING, NULL for missing)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wareflow.functions.text import SPACE, ascii_digits, is_ascii, strip

# Cell texts that a price list uses for "no value".
MISSING_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
MARKUP = 1.65
UNKNOWN_BRAND = "Unknown"
NO_TAX = "No tax info"

_IN_LINE_SPACE = SPACE.replace("]", "&&[^\n]]")
_URL_LINE = rf"(?dm)^{_IN_LINE_SPACE}*(?:- {_IN_LINE_SPACE}*)?(http(?:[^\n]*[^\n{SPACE[1:]})?){_IN_LINE_SPACE}*$"
_NUMBER = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?\z"


def null_if_missing(col: Column) -> Column:
    """Stripped text, or NULL for blank cells and the usual words for "no value"."""
    text = strip(col)
    return F.when(~F.lower(text).isin("", "nan") & ~col.isin(MISSING_WORDS), text)


# The functions below take cells cleaned by ``null_if_missing``; cleaning is a projection of its own,
# so that no cell is cleaned once per use.


def number(text: Column) -> Column:
    """DOUBLE of a plain decimal text, else NULL. Never NaN or infinite."""
    plain = F.regexp_extract(text, _NUMBER, 0).try_cast("double")
    other_digits = F.regexp_extract(ascii_digits(text), _NUMBER, 0).try_cast("double")
    return F.coalesce(plain, F.when(~is_ascii(text), other_digits))


def brand_or_unknown(text: Column) -> Column:
    return F.coalesce(text, F.lit(UNKNOWN_BRAND))


def parse_quantity(text: Column) -> Column:
    """Whole part of the number; anything missing, unreadable or below one counts as one."""
    return F.greatest(number(text).try_cast("int"), F.lit(1))


def parse_cost(text: Column) -> Column:
    """Missing stays NULL, unreadable or negative text becomes 0."""
    return F.when(text.isNotNull(), F.greatest(number(text), F.lit(0.0)))


def vat_percent(text: Column) -> Column:
    """First ``<number> %`` in the tax text, else 0."""
    found = F.regexp_extract(ascii_digits(text), r"([0-9]+(?:\.[0-9]+)?)" + SPACE + "*%", 1)
    return F.coalesce(found.try_cast("double"), F.lit(0.0))


def price(cost: Column, vat: Column) -> Column:
    return cost * F.lit(MARKUP) * (F.lit(1.0) + vat / F.lit(100.0))


def tax_label(text: Column) -> Column:
    return F.coalesce(text, F.lit(NO_TAX))


def percent_label(vat: Column) -> Column:
    return F.concat(vat.cast("string"), F.lit("%"))


def image_cells_strict(*cells: Column) -> Column:
    """One URL per cell, cells in order."""
    urls = [strip(c) for c in cells]
    return F.array_compact(F.array(*[F.when(F.startswith(u, F.lit("http")), u) for u in urls]))


def image_cells_multi(*cells: Column) -> Column:
    """All URLs of all cells; a cell may hold one per line, each with a leading ``- ``."""
    text = F.concat_ws("\n", *cells)
    found = F.regexp_extract_all(text, F.lit(_URL_LINE), F.lit(1))
    return F.when(F.contains(text, F.lit("http")), found).otherwise(F.array().cast("array<string>"))


def pick_category(category: Column, sub_category: Column) -> Column:
    return F.coalesce(category, sub_category, F.lit(""))


def is_valid_product(name: Column, upc: Column, price_: Column, quantity: Column) -> Column:
    """A missing price does not make a product invalid, a negative one does."""
    return (
        (F.coalesce(strip(name), F.lit("")) != "")
        & (F.coalesce(upc, F.lit("")) != "")
        & (F.coalesce(price_, F.lit(0.0)) >= 0)
        & (F.coalesce(quantity, F.lit(0)) > 0)
    )
