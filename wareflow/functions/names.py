"""Product-name rules used by the grouping: base names and the native similarity rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wareflow.functions.text import SPACE, WORD, strip, title_case, words

# What counts as a variant mark in a name, deleted in this order.
SIZE_UNITS = ["ml", "g", "oz", "kg", "l", "mg", "lb", r"fl\.oz"]
COLOURS = [
    "black", "white", "red", "blue", "green", "yellow", "pink", "purple", "brown", "gray", "grey",
    "beige", "nude", "clear",
]
SIZES = ["small", "medium", "large", "xl", "xxl", "s", "m", "l"]
SCENTS = ["vanilla", "chocolate", "mint", "rose", "lavender", "coconut", "lemon", "berry", "fruit"]
SHADES = ["light", "medium", "dark", "fair", "deep"]
FINISHES = ["matte", "glossy", "shimmer", "metallic", "satin"]
STOP_WORDS = ["the", "a", "an", "of", "for", "with", "and", "or"]

_DIGIT = r"\p{Nd}"


def _whole_word(options: list[str]) -> str:
    return rf"(?<!{WORD})(?:{'|'.join(options)})(?!{WORD})"


_VARIANT_MARKS = [
    rf"{_DIGIT}+{SPACE}*(?:{'|'.join(SIZE_UNITS)})",
    rf"{_DIGIT}+{SPACE}*pack",
    rf"#?{_DIGIT}+",
    *[_whole_word(w) for w in (COLOURS, SIZES, SCENTS, SHADES, FINISHES)],
    r"\([^)]*\)",
    rf"-{SPACE}*{WORD}+$",
]


def base_name_key(name: Column) -> Column:
    """Lower-case base name: the name without sizes, numbers, colours and other variant marks."""
    base = strip(F.lower(name))
    for mark in _VARIANT_MARKS:
        base = F.regexp_replace(base, "(?iud)" + mark, "")
    base = strip(F.regexp_replace(base, SPACE + "+", " "))
    base = strip(F.regexp_replace(base, r"[^\p{L}\p{N}_\p{IsWhite_Space}\x1c-\x1f]", ""))
    first_words = F.lower(F.array_join(F.slice(words(name), 1, 3), " "))
    # one match or none, so that the chain above is written, and run, once
    long_enough = F.get(F.regexp_extract_all(base, F.lit(r"(?s)^.{3,}\z"), F.lit(0)), F.lit(0))
    return F.coalesce(long_enough, first_words)


def base_name(name: Column) -> Column:
    return title_case(base_name_key(name))


def key_words(text: Column) -> Column:
    """Distinct words without the stop words."""
    return F.array_except(words(text), F.array(*[F.lit(w) for w in STOP_WORDS]))


def similar_by_text(base_key: Column, name_lower: Column) -> Column:
    """The base occurs in the name, or all its (two or more) key words do."""
    wanted = key_words(base_key)
    return F.contains(name_lower, base_key) | (
        (F.size(wanted) >= 2) & (F.size(F.array_except(wanted, words(name_lower))) == 0)
    )


def letter_counts(text: Column) -> Column:
    """Each character with a running number, e.g. ``bob`` gives ``b1, b2, o1``.

    The overlap of two such sets is the largest number of characters two texts can have in common,
    whatever their order, which bounds the match ratio from above.
    """
    letters = F.split(text, "")
    numbered = F.transform(
        F.array_distinct(letters),
        lambda c: F.transform(
            F.sequence(F.lit(1), F.size(F.filter(letters, lambda x: x == c))),
            lambda i: F.concat(c, i.cast("string")),
        ),
    )
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.flatten(numbered))


def ratio_can_reach(a: Column, b: Column, a_counts: Column, b_counts: Column, threshold: float) -> Column:
    """False only where the match ratio of ``a`` and ``b`` is certainly below the threshold."""
    total = F.length(a) + F.length(b)
    by_length = F.lit(2.0) * F.least(F.length(a), F.length(b)) / total >= threshold
    by_letters = F.lit(2.0) * F.size(F.array_intersect(a_counts, b_counts)) / total >= threshold
    return (total == 0) | (by_length & by_letters)
