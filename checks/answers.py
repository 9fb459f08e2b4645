"""Enrichment requests, answers and their fall-backs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.parsing import Query
from checks.views import duck, products, view
from wareflow.functions import answers as a
from wareflow.functions.text import strip_markdown
from wareflow.operators import requests as r
from wareflow.operators.shared import shared_folder
from wareflow.sources.tables import read_responses, write_responses


def _keys(s, d):
    return view(s, d, "keys")


def _resp(s, d):
    return view(s, d, "resp")


def _all_requests(s, d) -> DataFrame:
    return r.build_requests(_keys(s, d), *r.KINDS)


def _stored_responses(s, d):
    """The answers written to and read back from a table."""
    path = f"{shared_folder(s)}/responses"
    write_responses(_resp(s, d), path)
    return read_responses(s, path)


def _shout(kinds, prompts, max_tokens):
    return [f"{k}|{len(p)}|{m}" for k, p, m in zip(kinds, prompts, max_tokens)]


def _retried(s, d):
    """One run in which two kinds of call break, a second one that asks again what is pending."""
    path = f"{shared_folder(s)}/responses"
    requests = _all_requests(s, d)

    def first(kinds, prompts, max_tokens):
        if kinds[0] in ("batch", "tags"):
            raise ConnectionError("no service")
        return _shout(kinds, prompts, max_tokens)

    def second(kinds, prompts, max_tokens):
        return [None if k == "tags" else text for k, text in zip(kinds, _shout(kinds, prompts, max_tokens))]

    write_responses(r.fill_responses(requests, first, chunk=1, run_no=1), path)
    write_responses(r.fill_responses(r.pending_requests(requests, read_responses(s, path)), second, run_no=2), path)
    return read_responses(s, path)


_STATUS = "CASE WHEN response IS NULL THEN 'miss' ELSE 'ok' END"
_KEY_PARTS = {
    kind: "'" + kind + "'" + "".join(" || '|' || " + {"price": "coalesce(price_text, 'None')"}.get(p, p) for p in parts)
    for kind, (parts, _) in r.KINDS.items()
}


def _prompt_sql(kind: str) -> str:
    lines = [f"'{r.TASKS[kind]}'", "'Brand: ' || brand", "'Product: ' || name"]
    if kind in ("batch", "description"):
        lines.append("'Price: ' || price_text")
    if kind not in ("batch", "variants", "description", "clean_name"):
        lines.append("'Category: ' || category")
    return f"concat_ws(chr(10), {', '.join(lines)})"


REQUESTS_DUCK = " UNION ALL ".join(
    f"SELECT {_KEY_PARTS[kind]} AS cache_key, '{kind}' AS kind, min({_prompt_sql(kind)}) AS prompt, {tokens} AS max_tokens FROM keys GROUP BY 1"
    for kind, (_, tokens) in r.KINDS.items()
)

# JSON of an answer: the whole text, else the widest list or object in it
_WIDEST = "nullif(regexp_extract(trim(response), '(?s)(\\[.*\\]|\\{.*\\})', 1), '')"
_JSON = f"coalesce(try_cast(trim(response) AS JSON), try_cast({_WIDEST} AS JSON))"
PARSED_DUCK = f"SELECT cache_key, kind, response, {_JSON} AS js FROM resp"


def _text(key: str) -> str:
    return f"json_extract_string(js, '$.{key}')"


_FIELDS = {
    "description": "'<p>Premium <strong>' || brand || '</strong> product. ' || name || '.</p>'",
    "benefits": "''", "ingredients": "''", "good_for": "''", "suggested_usage": "''", "allergy_info": "''",
}
# markdown goes from parsed answers only
_CLEAN = {
    k: f"CASE WHEN js IS NULL THEN {default} ELSE replace(replace(replace(replace(coalesce({_text(k)}, {default}), '```', ''), '**', ''), '*', ''), '`', '') END"
    for k, default in _FIELDS.items()
}
BATCH_DUCK = f"""
SELECT row_no, brand, name, price, response IS NOT NULL AS answered, coalesce({_text('cleaned_name')}, name) AS cleaned_name,
  coalesce({_text('category')}, 'Health & Beauty > Other') AS category,
  array_to_string(coalesce(CAST(json_extract(js, '$.tags') AS VARCHAR[]), [lower(brand), 'product', 'beauty']), '|') AS tags,
  {', '.join(f'{sql} AS {k}' for k, sql in _CLEAN.items())}
FROM keys k LEFT JOIN ({PARSED_DUCK}) p ON p.kind = 'batch' AND p.cache_key = 'batch|' || brand || '|' || name || '|' || coalesce(price_text, 'None')
"""
OPTIONS_DUCK = f"""
SELECT cache_key, list_transform(list_filter(items, lambda o: json_type(o, '$.name') = 'VARCHAR' AND json_type(o, '$.value') = 'VARCHAR'),
    lambda o: {{'name': json_extract_string(o, '$.name'), 'value': json_extract_string(o, '$.value')}}) AS options
FROM (SELECT cache_key, CASE WHEN json_type(js) = 'ARRAY' THEN CAST(js AS JSON[]) ELSE [] END AS items FROM ({PARSED_DUCK}) WHERE kind = 'variants')
"""
_OPTIONS_TEXT = "array_to_string(list_transform(options, lambda o: o.name || '=' || o.value), ';')"


def _options_text(col="options"):
    return F.array_join(F.transform(col, lambda o: F.concat(o["name"], F.lit("="), o["value"])), ";")


# free-text answers derived from the catalogue, one per product
ANSWERED_DUCK = """
SELECT row_no, brand, name, category, CASE row_no % 6
    WHEN 0 THEN NULL
    WHEN 1 THEN '"' || repeat('**' || name || '** ', 12) || '`end`"'
    WHEN 2 THEN 'Health & Beauty > "' || brand || '"'
    WHEN 3 THEN 'hair' || chr(10) || '#no' || chr(10) || ' Care-X ' || chr(10) || 'hair' || chr(10) || lower(name) || chr(10) || 'a'
    WHEN 4 THEN 'one' || chr(10) || 'two' || chr(10) || 'three' || chr(10) || 'four' || chr(10) || 'five' || chr(10) || 'six' || chr(10) || 'seven' || chr(10) || 'eight' || chr(10) || 'nine' || chr(10) || 'ten' || chr(10) || 'eleven'
    ELSE '```' || brand || ' `x` *y*```' END AS answer
FROM {prod}
"""


def _answered(s, d):
    return s.sql(ANSWERED_DUCK, prod=products(s, d))


_ANSWERED = f"(SELECT * FROM ({ANSWERED_DUCK.format(prod='prod')}))"
_BARE = "replace(replace(replace(replace(trim(answer), '```', ''), '**', ''), '*', ''), '`', '')"
_LOWER_NAME = "lower(name)"
CATEGORY_CASE = "CASE " + " ".join(
    "WHEN regexp_matches({0}, '{1}') THEN '{2}'".format(_LOWER_NAME, "|".join(w), cat)
    for cat, w in a.CATEGORY_WORDS.items()
) + " ELSE 'Health & Beauty > Skin Care' END"
_QUOTELESS = "trim(replace(replace(trim(answer), '\"', ''), '''', ''))"
_NAME = "trim(trim(answer), '\"''')"
_OWN_NAME = "trim(regexp_replace(replace(replace(replace(name, 'BEAUTYSYSTEM', ''), 'XML', ''), 'PC', ''), '\\s+', ' ', 'g'))"
_OWN_TITLE = (
    f"array_to_string(list_transform(regexp_extract_all(lower({_OWN_NAME}), '[a-z]+|[^a-z]+'), lambda r: upper(r[1:1]) || substr(r, 2)), '')"
)
TAGS_DUCK = """
SELECT row_no, array_to_string(CASE WHEN answer IS NULL THEN [b, c, 'product', 'beauty', 'shop', 'online']
  WHEN len(t) < 6 THEN (t || list_filter([b, c, 'product', 'beauty'], lambda x: NOT list_contains(t, x)))[1:10] ELSE t[1:10] END, '|') AS tags
FROM (SELECT row_no, answer, lower(brand) AS b, replace(lower(category), ' ', '-') AS c,
  coalesce(list_transform(list_filter(list_transform(p, lambda q, i: {'t': q, 'i': i}), lambda s: list_position(p, s.t) = s.i), lambda s: s.t), []) AS t
  FROM (SELECT *, list_filter(list_transform(list_filter(string_split(trim(answer), chr(10)), lambda l: trim(l) <> '' AND l NOT LIKE '#%'), lambda l: lower(trim(l))),
     lambda l: length(l) BETWEEN 2 AND 50 AND regexp_full_match(l, '[a-z0-9 -]+')) AS p FROM """ + _ANSWERED + "))"
META = ["benefits", "ingredients", "good_for", "suggested_usage", "allergy"]


def _apply_enrichment(s, d):
    groups = _keys(s, d).select("row_no", "brand", F.col("name").alias("base_name"), "price")
    enriched, variants = r.apply_enrichment(groups, _keys(s, d).select("row_no", "brand", "name", "price"), _resp(s, d))
    return enriched.select("row_no", "title", "category", "description", F.array_join("tags", "|").alias("tags")).join(
        variants.select("row_no", _options_text().alias("options")), "row_no"
    )


QUERIES: dict[str, Query] = {
    "build_requests": (_all_requests, duck(REQUESTS_DUCK, "keys")),
    "pending_requests": (
        lambda s, d: r.pending_requests(_all_requests(s, d), _stored_responses(s, d)).select("cache_key", "kind"),
        duck(f"SELECT cache_key, kind FROM ({REQUESTS_DUCK}) WHERE cache_key NOT IN (SELECT cache_key FROM resp)", "resp", "keys"),
    ),
    "read_responses": (
        _stored_responses,
        duck(f"SELECT cache_key, kind, response, {_STATUS} AS status, CAST(NULL AS VARCHAR) AS error, CAST(0 AS BIGINT) AS run_no FROM resp", "resp"),
    ),
    "retry_failed_requests": (
        _retried,
        duck(
            f"""WITH asked AS ({REQUESTS_DUCK}), late AS (SELECT kind || '|' || length(prompt) || '|' || max_tokens AS response, * EXCLUDE (max_tokens) FROM asked)
            SELECT cache_key, kind, CASE WHEN kind <> 'tags' THEN response END AS response, CASE WHEN kind <> 'tags' THEN 'ok' ELSE 'miss' END AS status,
              CAST(NULL AS VARCHAR) AS error, CAST(CASE WHEN kind IN ('batch', 'tags') THEN 2 ELSE 1 END AS BIGINT) AS run_no FROM late
            UNION ALL SELECT cache_key, kind, NULL, 'failed', 'ConnectionError: no service', 1 FROM late WHERE kind IN ('batch', 'tags')""",
            "keys",
        ),
    ),
    "fill_responses": (
        lambda s, d: r.fill_responses(_all_requests(s, d), _shout, run_no=3),
        duck(
            f"SELECT cache_key, kind, kind || '|' || length(prompt) || '|' || max_tokens AS response, 'ok' AS status, CAST(NULL AS VARCHAR) AS error, CAST(3 AS BIGINT) AS run_no FROM ({REQUESTS_DUCK})",
            "keys",
        ),
    ),
    "json_from_text": (
        lambda s, d: _resp(s, d)
        .select("cache_key", "kind", a.json_from_text(F.trim("response")).alias("v"))
        .select(
            "cache_key", "kind",
            F.when(F.col("v").isNull(), "none")
            .when(F.startswith(F.schema_of_variant("v"), F.lit("ARRAY")), "list")
            .otherwise("object").alias("found"),
            F.try_variant_get("v", "$.category", "string").alias("category"),
        ),
        duck(
            f"""SELECT cache_key, kind, CASE WHEN js IS NULL THEN 'none' WHEN json_type(js) = 'ARRAY' THEN 'list' ELSE 'object' END AS found,
            {_text('category')} AS category FROM ({PARSED_DUCK})""",
            "resp",
        ),
    ),
    "strip_markdown": (
        lambda s, d: _answered(s, d).select(
            "row_no", strip_markdown(F.col("answer")).alias("bare"), strip_markdown(F.col("answer"), True).alias("short_form")
        ),
        duck(
            f"SELECT row_no, {_BARE.replace('trim(answer)', 'answer')} AS bare, replace(replace(replace(answer, '```', ''), '**', ''), '*', '') AS short_form FROM {_ANSWERED}",
            "prod",
        ),
    ),
    "apply_batch": (
        lambda s, d: r.apply_batch(_keys(s, d).select("row_no", "brand", F.col("name").alias("base_name"), "price"), _resp(s, d))
        .withColumnRenamed("base_name", "name")
        .withColumn("tags", F.array_join("tags", "|")),
        duck(BATCH_DUCK, "resp", "keys"),
    ),
    "valid_options": (
        lambda s, d: _resp(s, d).where("kind = 'variants'").select("cache_key", a.valid_options(F.col("response")).alias("options")).select(
            "cache_key", _options_text().alias("options")
        ),
        duck(f"SELECT cache_key, {_OPTIONS_TEXT} AS options FROM ({OPTIONS_DUCK})", "resp"),
    ),
    "finish_description": (
        lambda s, d: _answered(s, d).select("row_no", a.finish_description(F.col("answer"), F.col("brand"), F.col("name")).alias("description")),
        duck(
            f"SELECT row_no, coalesce(CASE WHEN length({_BARE}) > 500 THEN left({_BARE}, 497) || '...' ELSE {_BARE} END, '<p>Premium <strong>' || brand || '</strong> product. ' || name || '.</p>') AS description FROM {_ANSWERED}",
            "prod",
        ),
    ),
    "finish_category": (
        lambda s, d: _answered(s, d).select("row_no", a.finish_category(F.col("answer"), F.col("name")).alias("category")),
        duck(
            f"SELECT row_no, CASE WHEN contains({_QUOTELESS}, '>') AND length({_QUOTELESS}) < 100 THEN {_QUOTELESS} ELSE {CATEGORY_CASE} END AS category FROM {_ANSWERED}",
            "prod",
        ),
    ),
    "category_from_keywords": (
        lambda s, d: products(s, d).select("row_no", a.category_from_keywords(F.col("name")).alias("category")),
        duck(f"SELECT row_no, {CATEGORY_CASE} AS category FROM prod", "prod"),
    ),
    "finish_name": (
        lambda s, d: _answered(s, d).select("row_no", a.finish_name(F.col("answer"), F.col("name")).alias("title")),
        duck(
            f"SELECT row_no, coalesce(CASE WHEN length({_NAME}) > 100 THEN left({_NAME}, 97) || '...' ELSE {_NAME} END, {_OWN_TITLE}) AS title FROM {_ANSWERED}",
            "prod",
        ),
    ),
    "finish_tags": (
        lambda s, d: _answered(s, d).select("row_no", F.array_join(a.finish_tags(F.col("answer"), F.col("brand"), F.col("category")), "|").alias("tags")),
        duck(TAGS_DUCK, "prod"),
    ),
    "finish_metafields": (
        lambda s, d: _answered(s, d).select("row_no", *[a.finish_metafield(F.concat(F.lit(f"{m}: "), "answer")).alias(m) for m in META]),
        duck(
            "SELECT row_no, "
            + ", ".join(f"coalesce(replace(replace(replace(trim('{m}: ' || answer), '```', ''), '**', ''), '*', ''), '') AS {m}" for m in META)
            + f" FROM {_ANSWERED}",
            "prod",
        ),
    ),
    "apply_enrichment": (
        _apply_enrichment,
        duck(
            f"""SELECT b.row_no, b.cleaned_name AS title, b.category, b.description, b.tags, coalesce({_OPTIONS_TEXT}, '') AS options
            FROM ({BATCH_DUCK}) b LEFT JOIN ({OPTIONS_DUCK}) o ON o.cache_key = 'variants|' || b.name""",
            "resp", "keys",
        ),
    ),
}
