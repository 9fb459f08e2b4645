"""Text helpers shared by all stages.

Patterns spell out the character classes they mean: Java's own ``\\w`` and ``\\b`` treat combining
marks as word characters, the catalogue rules do not.
"""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE_CHARS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)
SPACE = r"[\p{IsWhite_Space}\x1c-\x1f]"
WORD = r"[\p{L}\p{N}_]"
ASCII_DIGITS = (
    "".join(chr(0x0660 + d) for d in range(10)) + "".join(chr(0x06F0 + d) for d in range(10)),
    "0123456789" * 2,
)


def _accented_letters() -> tuple[str, str]:
    """Lower-case letters whose canonical decomposition is one ASCII letter plus marks."""
    accented, plain = [], []
    for code in range(0x80, 0x3000):
        char = chr(code)
        kept = [c for c in unicodedata.normalize("NFD", char) if unicodedata.category(c) != "Mn"]
        if len(kept) == 1 and kept[0] != char and kept[0].isascii() and kept[0].islower():
            accented.append(char)
            plain.append(kept[0])
    return "".join(accented), "".join(plain)


ACCENTED, UNACCENTED = _accented_letters()


def is_ascii(col: Column) -> Column:
    return F.octet_length(col) == F.length(col)


def strip(col: Column) -> Column:
    """Remove Unicode white space from both ends.

    Trimming a set of characters is slow, so texts that start and end with visible ASCII are let
    through unchanged.
    """
    return F.when(col.rlike(r"(?s)^[!-~](?:.*[!-~])?\z"), col).otherwise(F.btrim(col, F.lit(SPACE_CHARS)))


def words(col: Column) -> Column:
    """White-space separated words; an empty text has none."""
    return F.filter(F.split(col, SPACE + "+"), lambda w: w != "")


def ascii_digits(col: Column) -> Column:
    """Arabic-Indic digits become ASCII digits."""
    return F.when(is_ascii(col), col).otherwise(F.translate(col, *ASCII_DIGITS))


def contains_any(col: Column, needles: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(col, F.lit(n)) for n in needles])


def ends_with_any(col: Column, endings: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.endswith(col, F.lit(e)) for e in endings])


def title_case(col: Column) -> Column:
    """Upper-case each letter that follows a non-letter, lower-case the others.

    ``initcap`` only looks at blanks, so ``50ml`` or ``a_b`` would stay as they are.
    """
    runs = F.regexp_extract_all(
        F.lower(col), F.lit(r"[\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+"), F.lit(0)
    )
    return F.array_join(
        F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), r.substr(F.lit(2), F.length(r)))),
        "",
    )


def slug(text: Column) -> Column:
    """Lower-case ASCII letters, digits and single hyphens, at most 255 characters."""
    lower = F.lower(text)
    plain = F.when(is_ascii(text), lower).otherwise(F.translate(lower, ACCENTED, UNACCENTED))
    kept = F.regexp_replace(plain, r"[^a-z0-9\-\p{IsWhite_Space}\x1c-\x1f]", "")
    hyphens = F.regexp_replace(kept, r"[\-\p{IsWhite_Space}\x1c-\x1f]+", "-")
    # one match or none, so that the chain above is written, and run, once
    cut = F.get(F.regexp_extract_all(F.btrim(hyphens, F.lit("-")), F.lit("^.{1,255}"), F.lit(0)), F.lit(0))
    return F.coalesce(cut, F.lit("product"))


def strip_markdown(text: Column, keep_single_backtick: bool = False) -> Column:
    """Delete code fences, asterisks and, unless told otherwise, lone backticks."""
    bare = F.regexp_replace(text, r"```|\*", "")
    return bare if keep_single_backtick else F.replace(bare, F.lit("`"), F.lit(""))


def shorten(text: Column, limit: int) -> Column:
    """Cut to ``limit`` characters, the last three being dots."""
    return F.when(
        F.length(text) > limit, F.concat(F.substring(text, 1, limit - 3), F.lit("..."))
    ).otherwise(text)


def number_text(value: Column) -> Column:
    """Shortest decimal text of a DOUBLE, without an exponent between 1e-4 and 1e16."""
    size = F.abs(value)
    plain = F.rtrim(value.cast("decimal(38,20)").cast("string"), F.lit("0"))
    plain = F.when(F.endswith(plain, F.lit(".")), F.concat(plain, F.lit("0"))).otherwise(plain)
    wide = ((size >= 1e7) & (size < 1e16)) | ((size < 1e-3) & (size >= 1e-4))
    return F.when(wide, plain).otherwise(value.cast("string"))
