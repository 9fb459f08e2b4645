"""The pipeline's stages one by one, each against a plain version on its own input."""

import hashlib

import pytest
from test_text_operators import linked, repeated
from tokenizers import Tokenizer

import corpus_pipeline
from wareflow.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input of each stage and the result of the last."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out.append(docs)
        path = str(tmp_path_factory.mktemp(f"stage{number}"))
        stage(spark, docs, SF).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return [*out, docs]


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_columns_and_rows(stages):
    for df in stages[:-1]:
        assert df.columns == stages[0].columns
    counts = [df.count() for df in stages]
    assert counts == sorted(counts, reverse=True) and counts[4] == counts[5] > 0


def test_toxic_documents_go(spark, stages):
    scores = {r["doc_id"]: r["predicted"] for r in queries.op10(spark, SF).collect()}
    assert set(rows(stages[1])) == {i for i, p in scores.items() if not p}


def test_one_of_each_group_stays(stages):
    before = stages[1].select("doc_id", "text").collect()
    want = {i for i, _, component in linked([tuple(r) for r in before], 5, 80) if i == component}
    assert set(rows(stages[2])) == want


def test_repeats_are_cut(stages):
    before, after = stages[2].select("doc_id", "text").collect(), rows(stages[3])
    for i, n_words, n_removed, kept in repeated([tuple(r) for r in before], 20):
        if n_words and n_words == n_removed:
            assert i not in after
        else:
            assert hashlib.sha256(" ".join(after[i]["text"].split()).encode()).hexdigest() == kept
            assert after[i]["n_chars"] == len(after[i]["text"])
            assert n_removed or after[i]["text"] == rows(stages[2])[i]["text"]


def test_contaminated_documents_go(spark, stages):
    kept = rows(stages[4])
    assert set(kept) <= set(rows(stages[3])) and all(kept[i]["text"] == r["text"] for i, r in rows(stages[3]).items() if i in kept)


def test_tokens_round_trip(stages):
    tokenizer = Tokenizer.from_file(queries.VOCABULARY)
    before, after = rows(stages[4]), rows(stages[5])
    assert set(before) == set(after)
    for i, r in after.items():
        assert r["token_ids"] == tokenizer.encode(before[i]["text"], add_special_tokens=False).ids
        assert r["text"] == before[i]["text"] and r["n_tokens"] == len(r["token_ids"])
