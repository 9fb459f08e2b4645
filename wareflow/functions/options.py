"""Variant-option and product-type rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wareflow.functions.text import contains_any, strip, words

# Option name -> words that stand for it, first match wins.
OPTION_WORDS = {
    "Flavor": ["flavor", "scent", "fragrance"],
    "Size": ["size", "volume", "weight"],
    "Color": ["color", "colour", "shade"],
    "Type": ["type", "formula", "finish"],
    "Material": ["material", "fabric"],
    "Style": ["style", "design"],
}


def normal_option_name(name: Column) -> Column:
    """Standard option name, else the first word before a slash; NULL where there is none."""
    text = strip(name)
    lower = F.lower(text)
    first = F.get(words(F.split(text, "/")[0]), F.lit(0))
    capitalised = F.concat(F.upper(F.substring(first, 1, 1)), F.lower(first.substr(F.lit(2), F.length(first))))
    out = F.when(F.lit(False), F.lit(""))
    for standard, needles in OPTION_WORDS.items():
        out = out.when(contains_any(lower, needles), F.lit(standard))
    return out.otherwise(capitalised)


def normal_options(options: Column) -> Column:
    """ARRAY<STRUCT<name,value>> with standard names; nameless entries are dropped."""
    mapped = F.transform(
        options,
        lambda o: F.struct(
            normal_option_name(o["name"]).alias("name"), F.coalesce(strip(o["value"]), F.lit("")).alias("value")
        ),
    )
    return F.filter(mapped, lambda o: o["name"].isNotNull())


def option_value(normalised: Column, name: Column) -> Column:
    """Last non-empty value under a standard name, else empty text."""
    values = F.transform(
        F.filter(normalised, lambda o: (o["name"] == name) & (o["value"] != "")), lambda o: o["value"]
    )
    return F.coalesce(F.when((name != "") & (F.size(values) > 0), F.element_at(values, -1)), F.lit(""))


def type_from_category(category: Column) -> Column:
    """Text after the last ``>``, or the whole category."""
    text = F.coalesce(category, F.lit(""))
    return F.when(
        F.contains(text, F.lit(">")), strip(F.element_at(F.split(text, ">"), -1))
    ).otherwise(text)
