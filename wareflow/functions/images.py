"""Page-image rules: find ``<img>`` tags, score them, keep the best, ask for the full size.

Everything works on one array per page, so no stage needs a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wareflow.functions.text import contains_any, ends_with_any, strip, words

# Words that mark an image as decoration, as a thumbnail, as the main picture.
SKIP_WORDS = [
    "logo", "icon", "badge", "button", "arrow", "star", "rating", "banner", "header", "footer",
    "nav", "menu", "social", "facebook", "twitter", "instagram", "checkout", "cart", "search",
    "sprite", "warranty", "insurance", "bullet-point", "guarantee", "shipping", "return", "policy",
]
THUMBNAIL_WORDS = [
    "thumb", "thumbnail", "small", "mini", "tiny", "_s.", "_xs.", "_sm.", "-thumb", "-small",
    "/thumbs/", "/thumbnails/", "/small/", "icon", "preview", "swatch",
]
MAIN_WORDS = [
    "large", "main", "primary", "hero", "zoom", "_l.", "_xl.", "_lg.", "-large", "-main",
    "/large/", "/original/", "/full/", "product-image", "product_image", "detail",
]
CDN_WORDS = ["cdn", "images", "assets", "s3", "cloudfront", "media"]
TRACKER_ENDINGS = ["gif", "1x1", "pixel"]
# Points for the longer side of an image, and for its file ending.
SIZE_POINTS = [(800, 50), (500, 35), (300, 20), (150, 5)]
TINY_POINTS = -20
FORMAT_POINTS = [([".jpg", ".jpeg"], 10), ([".png"], 8), ([".webp"], 6)]
# Size marks in image URLs, by kind of host.
MARKET_SIZE_MARKS = [
    r"\._AC_[A-Z0-9,_]+", r"\._SR[0-9,_]+", r"\._UL[0-9,_]+", r"\._SL[0-9,_]+",
    r"\._UX[0-9,_]+", r"\._UY[0-9,_]+", r"\._UF[0-9,_]+",
]
STORE_SIZE_MARKS = [r"_[0-9]+x[0-9]+(@[0-9]x)?\.", r"_small\.", r"_medium\.", r"_thumb\."]
OTHER_SIZE_MARKS = [
    r"[-_](thumb|small|thumbnail|mini|tiny|icon|preview)[-_\.]", r"[-_][0-9]+x[0-9]+[-_\.]",
]


def img_tags(html: Column) -> Column:
    """Attribute text of every ``<img>`` tag, in page order."""
    return F.regexp_extract_all(html, F.lit(r"(?i)<img([^>]+)>"), F.lit(1))


def _attributes(tag: Column, pos: Column) -> Column:
    def number(pattern: str) -> Column:
        return F.coalesce(F.regexp_extract(tag, pattern, 1).try_cast("bigint"), F.lit(0).cast("bigint"))

    return F.struct(
        F.regexp_extract(tag, "(?i)(?:src|data-src)=[\"']([^\"']+)[\"']", 1).alias("src"),
        F.regexp_extract(tag, "(?i)alt=[\"']([^\"']*)[\"']", 1).alias("alt"),
        F.lower(F.regexp_extract(tag, "(?i)class=[\"']([^\"']*)[\"']", 1)).alias("class"),
        number("(?i)width=[\"']?([0-9]+)").alias("width"),
        number("(?i)height=[\"']?([0-9]+)").alias("height"),
        pos.cast("int").alias("pos"),
    )


def img_attributes(tags: Column) -> Column:
    """ARRAY of (src, alt, class, width, height, pos); tags without a source are dropped."""
    return F.filter(F.transform(tags, _attributes), lambda i: i["src"] != "")


def _prepared(candidates: Column) -> Column:
    """Candidates with the trimmed source and lower-case texts, computed once per image."""
    trimmed = F.transform(
        candidates,
        lambda i: F.struct(
            strip(i["src"]).alias("src"), F.lower(i["alt"]).alias("alt"), F.lower(i["class"]).alias("css"),
            F.greatest(i["width"], i["height"]).alias("longer"), F.least(i["width"], i["height"]).alias("shorter"),
            i["pos"].alias("pos"),
        ),
    )
    return F.transform(trimmed, lambda i: i.withField("lower", F.lower(i["src"])))


def is_product_image(img: Column) -> Column:
    """Predicate on one prepared candidate."""
    return (
        F.startswith(img["src"], F.lit("https://"))
        & ~contains_any(img["lower"], SKIP_WORDS)
        & ~contains_any(img["alt"], SKIP_WORDS)
        & ~contains_any(img["css"], SKIP_WORDS)
        & ~ends_with_any(img["src"], TRACKER_ENDINGS)
        & ~contains_any(img["lower"], THUMBNAIL_WORDS)
        & ~contains_any(img["css"], THUMBNAIL_WORDS)
    )


def image_score(img: Column, product_words: Column) -> Column:
    """INT relevance of one prepared candidate for a product whose name has the given words."""

    def points(condition: Column, n: int) -> Column:
        return F.when(condition, F.lit(n)).otherwise(F.lit(0))

    lower, alt = img["lower"], img["alt"]
    by_size = F.lit(TINY_POINTS)
    for side, n in reversed(SIZE_POINTS):
        by_size = F.when(img["longer"] >= side, F.lit(n)).otherwise(by_size)
    by_format = F.lit(0)
    for endings, n in reversed(FORMAT_POINTS):
        by_format = F.when(ends_with_any(lower, endings), F.lit(n)).otherwise(by_format)
    hits = F.size(F.filter(product_words, lambda w: F.contains(alt, w)))
    return (
        F.when(img["shorter"] > 0, by_size).otherwise(F.lit(0))
        + points(contains_any(lower, MAIN_WORDS), 30)
        + points(contains_any(img["css"], MAIN_WORDS), 20)
        + F.when(alt != "", hits * 5).otherwise(F.lit(0))
        + points(F.contains(alt, F.lit("product")), 5)
        + by_format
        + points(contains_any(lower, CDN_WORDS), 10)
        + points(F.contains(lower, F.lit("product")), 15)
    )


def scored_images(candidates: Column, product_name: Column) -> Column:
    """ARRAY of (score, pos, src) of the acceptable candidates, best first, ties in page order."""
    name_words = words(F.lower(product_name))
    kept = F.filter(_prepared(candidates), is_product_image)
    ranked = F.array_sort(
        F.transform(
            kept,
            lambda i: F.struct(
                (-image_score(i, name_words)).alias("rank"), i["pos"].alias("pos"), i["src"].alias("src")
            ),
        )
    )
    return F.transform(ranked, lambda r: F.struct((-r["rank"]).alias("score"), r["pos"].alias("pos"), r["src"].alias("src")))


def top_images(candidates: Column, product_name: Column, k: int = 3) -> Column:
    return F.transform(F.slice(scored_images(candidates, product_name), 1, k), lambda r: r["src"])


def full_size_url(url: Column) -> Column:
    """Remove size marks from an image URL."""

    def without(marks: list[str], filler: str) -> Column:
        out = url
        for mark in marks:
            out = F.regexp_replace(out, mark, filler)
        return out

    market = without(MARKET_SIZE_MARKS, "")
    market = F.when(ends_with_any(market, [".jpg", ".jpeg", ".png", ".webp"]), market).otherwise(
        F.concat(market, F.lit(".jpg"))
    )
    return (
        F.when(contains_any(url, ["amazon.com", "ssl-images-amazon"]), market)
        .when(contains_any(url, ["shopify.com", "cdn.shopify"]), without(STORE_SIZE_MARKS, "."))
        .otherwise(without(OTHER_SIZE_MARKS, "."))
    )


def page_images(url: Column, candidates: Column, product_name: Column, k: int = 3) -> Column:
    """``extract_images`` of a page whose candidates are known."""
    best = F.transform(top_images(candidates, product_name, k), full_size_url)
    empty = F.array().cast("array<string>")
    return F.when(url.rlike("^https?://"), F.coalesce(best, empty)).otherwise(empty)


def extract_images(url: Column, html: Column, product_name: Column, k: int = 3) -> Column:
    """ARRAY of at most ``k`` full-size image URLs of a page; none for a page that is not http(s)."""
    return page_images(url, img_attributes(img_tags(html)), product_name, k)
