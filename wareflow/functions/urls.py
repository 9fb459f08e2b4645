"""URL rules for the table of search results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wareflow.functions.text import contains_any

# Preferred sites in order, {brand} standing for the brand key.
PREFERRED_DOMAINS = [
    "{brand}.com", "{brand}.sa", "{brand}.ae", "{brand}.co",
    "iherb.sa", "sa.iherb.com", "iherb.com", "amazon.sa", "noon.com", "namshi.com", "amazon.ae",
]
# Parts of a URL that mark a page as not being a product page.
UNWANTED_PARTS = [
    "login", "signin", "account", "cart", "checkout", "register",
    "/shop/", "/category/", "/collection/", "/search", "/brands/",
]
# Query texts in order of preference.
QUERY_FORMS = [
    'site:{key}.com "{name}"',
    'site:{key}.sa "{name}"',
    'site:{key}.ae "{name}"',
    'site:iherb.sa OR site:iherb.com "{brand}" "{name}"',
    '"{brand}" "{name}" site:amazon.sa OR site:noon.com OR site:namshi.com',
]


def brand_key(brand: Column) -> Column:
    return F.translate(F.lower(brand), " -", "")


def _fill(form: str, **parts: Column) -> Column:
    """Concatenation of a form's literal text and the columns named in it."""
    pieces, rest = [], form
    while "{" in rest:
        before, rest = rest.split("{", 1)
        name, rest = rest.split("}", 1)
        pieces += [F.lit(before), parts[name]]
    return F.concat(*pieces, F.lit(rest))


def search_queries(brand: Column, name: Column) -> Column:
    """ARRAY of the five query texts for a product."""
    key = brand_key(brand)
    return F.array(*[_fill(f, key=key, brand=brand, name=name) for f in QUERY_FORMS])


def priority_domains(brand: Column) -> Column:
    key = brand_key(brand)
    return F.array(*[_fill(d, brand=key) for d in PREFERRED_DOMAINS])


def search_key(brand: Column, name: Column, upc: Column) -> Column:
    """md5 of brand, name and, where present, product code."""
    return F.md5(F.concat_ws("|", F.lower(brand), F.lower(name), F.when(upc != "", upc)))


def is_unwanted_url(url: Column) -> Column:
    return contains_any(F.lower(url), UNWANTED_PARTS)


def is_valid_url(url: Column) -> Column:
    """http(s) with a host; brackets in the host must pair up."""
    bare = F.translate(url, "\t\r\n", "")
    host = F.regexp_extract(bare, r"^https?://([^/?#]*)", 1)
    paired = F.contains(host, F.lit("[")) == F.contains(host, F.lit("]"))
    return F.coalesce(url.rlike("^https?://") & (host != "") & paired, F.lit(False))


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, without a fragment; NULL where there is no scheme."""
    head = F.regexp_extract(url, "^[^:/?#]+://[^/?#]*", 0)
    rest = F.regexp_extract(url, "^[^:/?#]+://[^/?#]*([^#]*)", 1)
    return F.when(head != "", F.concat(F.lower(head), rest))
