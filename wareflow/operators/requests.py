"""Enrichment as tables: requests out, answers in.

The remote call is not part of this package. ``build_requests`` makes the table of questions,
``pending_requests`` drops those already answered, ``fill_responses`` runs a function given by the
caller over the rest, and ``apply_enrichment`` puts the answers on groups and variants.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wareflow.functions.answers import batch_fields, json_from_text, valid_options
from wareflow.functions.text import number_text, strip

# Kind -> (columns of its key, token limit).
KINDS = {
    "batch": (("brand", "name", "price"), 2000),
    "variants": (("name",), 500),
    "description": (("brand", "name"), 300),
    "category": (("name",), 50),
    "clean_name": (("name",), 100),
    "tags": (("brand", "name"), 200),
    "benefits": (("brand", "name"), 400),
    "ingredients": (("brand", "name"), 300),
    "good_for": (("brand", "name"), 200),
    "suggested_usage": (("brand", "name"), 300),
    "allergy": (("brand", "name"), 200),
}
TASKS = {
    "batch": "Write the listing of this product as one JSON object with the fields cleaned_name, "
    "description, category, tags, benefits, ingredients, good_for, suggested_usage, allergy_info.",
    "variants": "List the variant attributes found in this product name as a JSON array of "
    "objects with name and value; [] if there are none.",
    "description": "Describe this product in two or three plain sentences.",
    "category": "Give the category of this product as: Top Level > Subcategory.",
    "clean_name": "Give a readable form of this product name, seven words at most.",
    "tags": "Give six to ten lower-case search tags for this product, one per line.",
    "benefits": "Name three to five benefits of this product.",
    "ingredients": "Describe the ingredients of this product.",
    "good_for": "Say in one or two sentences what good buying this product does.",
    "suggested_usage": "Explain how to use this product.",
    "allergy": "Give the warnings that fit this product.",
}
# status: ok, miss (asked, nothing there) or failed (the call broke; error says how). A later run_no counts more.
RESPONSE_SCHEMA = "cache_key string, kind string, response string, status string, error string, run_no bigint"


def request_key(kind: str, brand: Column, name: Column, price: Column) -> Column:
    # Fixed value: how a missing price is spelled in a key
    parts = {"brand": brand, "name": name, "price": F.coalesce(number_text(price), F.lit("None"))}
    return F.concat_ws("|", F.lit(kind), *[parts[p] for p in KINDS[kind][0]])


def _prompt(products: DataFrame, kind: str) -> Column:
    category = F.col("category") if "category" in products.columns else F.lit(None).cast("string")
    facts = [
        F.concat(F.lit("Brand: "), "brand"),
        F.concat(F.lit("Product: "), "name"),
        F.concat(F.lit("Price: "), number_text(F.col("price"))) if kind in ("batch", "description") else None,
        F.concat(F.lit("Category: "), category) if kind not in ("batch", "variants", "description", "clean_name") else None,
    ]
    return F.concat_ws("\n", F.lit(TASKS[kind]), *[f for f in facts if f is not None])


def build_requests(products: DataFrame, *kinds: str) -> DataFrame:
    """(cache_key, kind, prompt, max_tokens), one row per distinct key of each kind; one pass for all kinds.

    ``products`` has brand, name, price and, for the kinds that mention it, category.
    """
    asked = [
        F.struct(
            request_key(kind, F.col("brand"), F.col("name"), F.col("price")).alias("cache_key"),
            F.lit(kind).alias("kind"),
            _prompt(products, kind).alias("prompt"),
            F.lit(KINDS[kind][1]).alias("max_tokens"),
        )
        for kind in kinds
    ]
    rows = products.select(F.explode(F.array(*asked)).alias("_r")).select("_r.*")
    # one prompt per key: a map-side minimum, so repeated names cost nothing
    least = rows.groupBy("cache_key", "kind", "max_tokens").agg(F.min("prompt").alias("prompt"))
    return least.select("cache_key", "kind", "prompt", "max_tokens")


def with_status(responses: DataFrame) -> DataFrame:
    """Responses with status, error and run_no; where a table lacks them, NULL answers are misses of run 0."""
    plain = F.when(F.col("response").isNull(), "miss").otherwise("ok")
    missing = {"status": plain, "error": F.lit(None).cast("string"), "run_no": F.lit(0).cast("bigint")}
    added = {name: value for name, value in missing.items() if name not in responses.columns}
    return responses.withColumns({**added, **({} if "status" in added else {"status": F.coalesce("status", plain)})})


def pending_requests(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Requests whose key has no stored answer; a stored miss counts as an answer, a failed call does not."""
    settled = with_status(responses).where("status <> 'failed'").select("cache_key")
    return requests.join(settled, "cache_key", "left_anti")


def fill_responses(
    pending: DataFrame,
    provider: Callable[[list[str], list[str], list[int]], list[str]],
    chunk: int = 100,
    run_no: int = 0,
) -> DataFrame:
    """Responses from ``provider(kinds, prompts, max_tokens)``, chunk by chunk.

    A chunk whose call fails is marked ``failed`` with the error, the others go on; the failed ones
    stay pending. Parallel over partitions.
    """

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            # one frame per batch: a frame per chunk takes far longer than a quick call
            asked = [batch[c].tolist() for c in ("kind", "prompt", "max_tokens")]
            responses, status, errors = [], [], []
            for start in range(0, len(batch), chunk):
                part, error = [c[start : start + chunk] for c in asked], None
                size = len(part[0])
                try:
                    texts = list(provider(*part))
                    if len(texts) != size:
                        raise ValueError("one answer per request expected")
                except Exception as broken:  # noqa: BLE001 - any failure of the caller's function
                    texts, error = [None] * size, f"{type(broken).__name__}: {broken}"
                responses += texts
                status += ["failed" if error else "miss" if t is None else "ok" for t in texts]
                errors += [error] * size
            answers = {"cache_key": batch["cache_key"], "kind": batch["kind"], "response": pd.Series(responses, batch.index, object)}
            yield pd.DataFrame({**answers, "status": status, "error": pd.Series(errors, batch.index, object), "run_no": run_no})

    return pending.select("cache_key", "kind", "prompt", "max_tokens").mapInPandas(answer, RESPONSE_SCHEMA)


def _answers(responses: DataFrame, kind: str) -> DataFrame:
    """One answer per key, the one of the last run; within a run the smallest."""
    answered = with_status(responses).where((F.col("kind") == kind) & F.col("response").isNotNull() & (F.col("status") == "ok"))
    # a minimum over (-run_no, response) is pre-aggregated like any other
    last = F.min(F.struct((-F.coalesce("run_no", F.lit(0))).alias("run"), F.col("response").alias("text")))
    return answered.groupBy(F.col("cache_key").alias("_key")).agg(last.alias("_last")).select("_key", F.col("_last.text").alias("_answer"))


def apply_batch(groups: DataFrame, responses: DataFrame) -> DataFrame:
    """Groups (brand, base_name, price) with the nine fields and ``answered``."""
    keyed = groups.withColumn("_key", request_key("batch", F.col("brand"), F.col("base_name"), F.col("price")))
    answers = _answers(responses, "batch").withColumn("_json", json_from_text(strip(F.col("_answer"))))
    joined = keyed.join(answers, "_key", "left").withColumn(
        "_fields", batch_fields(F.col("_json"), F.col("brand"), F.col("base_name"))
    )
    return joined.select(*groups.columns, F.col("_answer").isNotNull().alias("answered"), "_fields.*")


def apply_options(variants: DataFrame, responses: DataFrame) -> DataFrame:
    """Variants with ``options``, the attributes found in their names."""
    parsed = _answers(responses, "variants").select("_key", valid_options(F.col("_answer")).alias("options"))
    keyed = variants.withColumn("_key", request_key("variants", F.col("brand"), F.col("name"), F.col("price")))
    empty = F.array().cast("array<struct<name:string,value:string>>")
    return keyed.join(parsed, "_key", "left").select(
        *[c for c in variants.columns if c != "options"], F.coalesce("options", empty).alias("options")
    )


def apply_enrichment(groups: DataFrame, variants: DataFrame, responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Enriched groups, with ``title`` as the cleaned name, and variants with options."""
    enriched = apply_batch(groups, responses).withColumnRenamed("cleaned_name", "title")
    return enriched, apply_options(variants, responses)
