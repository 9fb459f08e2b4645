"""Reading, checking and defaulting enrichment answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wareflow.functions.text import contains_any, shorten, strip, strip_markdown, title_case

# Category -> words in a product name, first match wins.
CATEGORY_WORDS = {
    "Health & Beauty > Hair Care": ["shampoo", "conditioner", "hair", "scalp", "haircare"],
    "Health & Beauty > Skin Care": [
        "face", "facial", "toner", "cleanser", "moisturizer", "serum", "cream", "mask",
        "makeup remover", "skin",
    ],
    "Health & Beauty > Oral Care": [
        "mouthwash", "mouth wash", "toothpaste", "dental", "oral", "teeth", "breath",
    ],
    "Health & Beauty > Bath & Body": [
        "body", "bath", "shower", "soap", "lotion", "feminine", "intimate", "wipes", "body wash",
    ],
    "Health & Beauty > Makeup": [
        "lipstick", "foundation", "mascara", "eyeshadow", "makeup", "cosmetic", "powder", "blush",
    ],
    "Health & Beauty > Fragrance": ["perfume", "cologne", "fragrance", "eau de", "scent"],
    "Health & Beauty > Nail Care": ["nail", "polish", "manicure", "pedicure"],
    "Health & Beauty > Personal Care": ["vitamin", "supplement", "medicine", "health", "wellness"],
}
FALLBACK_CATEGORY = "Health & Beauty > Skin Care"
OTHER_CATEGORY = "Health & Beauty > Other"
# Words that are noise in supplier names, tags every product may carry.
NOISE_WORDS = ["BEAUTYSYSTEM", "XML", "PC"]
COMMON_TAGS = ["product", "beauty"]
NO_ANSWER_TAGS = ["shop", "online"]

BATCH_TEXTS = ["description", "benefits", "ingredients", "good_for", "suggested_usage", "allergy_info"]
BATCH_FIELDS = ["cleaned_name", "category", "tags", *BATCH_TEXTS]
OPTION_TYPE = "array<struct<name:string,value:string>>"


def _strict_json(text: Column) -> Column:
    """VARIANT of a text that is one JSON value and nothing else, else NULL.

    The JSON parser stops at the end of the first value. Wrapping the text both as a list entry and
    as an object field leaves no room for trailing text: nothing can close both wrappers.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    keyed = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    alone = F.size(F.try_variant_get(listed, "$", "array<variant>")) == 1
    return F.when(alone & keyed.isNotNull(), F.try_variant_get(listed, "$[0]", "variant"))


def json_from_text(text: Column) -> Column:
    """VARIANT of the JSON in an answer: the whole text, else the widest list or object in it."""
    widest = F.regexp_extract(text, r"(?s)(\[.*\]|\{.*\})", 1)
    return F.coalesce(_strict_json(text), _strict_json(F.when(widest != "", widest)))


def default_description(brand: Column, name: Column) -> Column:
    return F.concat(
        F.lit("<p>Premium <strong>"), brand, F.lit("</strong> product. "), name, F.lit(".</p>")
    )


def batch_fields(json: Column, brand: Column, name: Column) -> Column:
    """STRUCT of the nine enrichment fields; a field that is absent or unusable gets its default.

    ``json`` is a column of ``json_from_text``, not the expression: it is used once per field.
    """

    def field(key: str, kind: str = "string") -> Column:
        return F.try_variant_get(json, f"$.{key}", kind)

    defaults = {"description": default_description(brand, name)}
    tags = F.coalesce(
        field("tags", "array<string>"), F.array(F.lower(brand), *[F.lit(t) for t in COMMON_TAGS])
    )
    return F.struct(
        F.coalesce(field("cleaned_name"), name).alias("cleaned_name"),
        F.coalesce(field("category"), F.lit(OTHER_CATEGORY)).alias("category"),
        tags.alias("tags"),
        *[
            # markdown goes from parsed answers only; a default without an answer stays as it is
            F.when(json.isNull(), defaults.get(k, F.lit("")))
            .otherwise(strip_markdown(F.coalesce(field(k), defaults.get(k, F.lit("")))))
            .alias(k)
            for k in BATCH_TEXTS
        ],
    )


def valid_options(answer: Column) -> Column:
    """ARRAY<STRUCT<name,value>> of the listed objects whose name and value are both texts."""
    listed = F.try_variant_get(json_from_text(strip(answer)), "$", "array<variant>")

    def is_text(entry: Column, key: str) -> Column:
        kind = F.schema_of_variant(F.try_variant_get(entry, f"$.{key}", "variant"))
        return F.coalesce(kind == "STRING", F.lit(False))

    kept = F.filter(listed, lambda e: is_text(e, "name") & is_text(e, "value"))
    options = F.transform(
        kept,
        lambda e: F.struct(
            F.try_variant_get(e, "$.name", "string").alias("name"),
            F.try_variant_get(e, "$.value", "string").alias("value"),
        ),
    )
    return F.coalesce(options, F.array().cast(OPTION_TYPE))


def finish_description(answer: Column, brand: Column, name: Column) -> Column:
    return F.coalesce(shorten(strip_markdown(strip(answer)), 500), default_description(brand, name))


def category_from_keywords(name: Column) -> Column:
    lower = F.lower(name)
    out = F.when(F.lit(False), F.lit(""))
    for category, needles in CATEGORY_WORDS.items():
        out = out.when(contains_any(lower, needles), F.lit(category))
    return out.otherwise(F.lit(FALLBACK_CATEGORY))


def finish_category(answer: Column, name: Column) -> Column:
    """The answer if it looks like ``top > sub``, else the keyword rule."""
    bare = strip(F.translate(answer, "\"'", ""))
    fits = F.contains(bare, F.lit(">")) & (F.length(bare) < 100)
    return F.when(F.coalesce(fits, F.lit(False)), bare).otherwise(category_from_keywords(name))


def finish_name(answer: Column, raw_name: Column) -> Column:
    """The answer without outer quotes, else the raw name without noise words in title case."""
    own = raw_name
    for word in NOISE_WORDS:
        own = F.replace(own, F.lit(word), F.lit(""))
    own = title_case(strip(F.regexp_replace(own, r"[\p{IsWhite_Space}\x1c-\x1f]+", " ")))
    return F.coalesce(shorten(F.btrim(strip(answer), F.lit("\"'")), 100), own)


def finish_tags(answer: Column, brand: Column, category: Column) -> Column:
    """ARRAY of tags: one per answer line, cleaned, distinct, filled up below six, cut at ten."""
    own = [F.lower(brand), F.replace(F.lower(category), F.lit(" "), F.lit("-"))]
    filler = F.array(*own, *[F.lit(t) for t in COMMON_TAGS])
    lines = F.filter(
        F.split(strip(answer), "\n"), lambda t: (strip(t) != "") & ~F.startswith(t, F.lit("#"))
    )
    tags = F.array_distinct(
        F.filter(
            F.transform(lines, lambda t: F.lower(strip(t))),
            lambda t: F.length(t).between(2, 50) & t.rlike("^[a-z0-9 -]+$"),
        )
    )
    # repeats within the filler itself are kept, only tags already present are left out
    filled = F.when(
        F.size(tags) < 6, F.concat(tags, F.filter(filler, lambda t: ~F.array_contains(tags, t)))
    ).otherwise(tags)
    none = F.array(*own, *[F.lit(t) for t in COMMON_TAGS + NO_ANSWER_TAGS])
    return F.when(answer.isNull(), none).otherwise(F.slice(filled, 1, 10))


def finish_metafield(answer: Column) -> Column:
    """Text of benefits, ingredients, good_for, suggested_usage or allergy; empty without answer."""
    return F.coalesce(strip_markdown(strip(answer), keep_single_backtick=True), F.lit(""))
