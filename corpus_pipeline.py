"""A training corpus from raw documents: five stages, each written and read again.

toxicity -> near copies -> repeated passages -> benchmark passages -> tokens. Every stage but the last
returns the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wareflow.llm import bpe, decontamination, jaccard_join, substring_dedup, toxicity
from wareflow.llm.arrays import set_aside
from wareflow.llm.queries import LABELLED, VOCABULARY, remainder, table
from wareflow.operators.shared import shared_folder, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
TOXIC = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the limit; fitted on the labels that are not held out."""
    labels = table(spark, sf_dir, "labels").where(remainder(F.col("doc_id"), 3) != 1)
    model = toxicity.fit(toxicity.labelled_sample(docs.select("doc_id", "text"), labels, bound=LABELLED))
    given, names = set_aside(docs)
    return toxicity.score(given, model, text=names["text"], name="_score").where(F.col("_score") < TOXIC).drop("_score").toDF(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, similarity 0.8."""
    return jaccard_join.keep_one_of_each(docs, shingle=5, similar=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of 20-word windows that also start earlier."""
    return _measured(substring_dedup.remove_repeats(docs, window=20), docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"), n=10, remove="documents")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids; the text is what the ids decode to."""
    coded = bpe.encode_and_decode(docs, VOCABULARY, decoded="text")
    return coded.withColumn("n_tokens", F.size("token_ids").cast("bigint")).select(*docs.columns, "token_ids", "n_tokens")


def _measured(docs: DataFrame, like: DataFrame) -> DataFrame:
    """n_chars as the text has it now."""
    if "n_chars" not in like.columns:
        return docs
    return docs.withColumn("n_chars", F.char_length("text").cast(like.schema["n_chars"].dataType)).select(*like.columns)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("substring dedup", cut_repeats),
    ("benchmark decontamination", drop_contaminated),
    ("BPE encoding and decoding", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    docs, folder = table(spark, sf_dir, "documents"), shared_folder(spark)
    for number, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), folder, f"stage-{number}")
    return docs


# no SQL: a fitted classifier and a tokenizer; tests compare each stage with a brute-force version
ORACLE_SQL: str | None = None
QUERIES = {"pipeline": (run, ORACLE_SQL)}
