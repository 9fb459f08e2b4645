"""The operators over their whole tables: what each query returns is derived from the operator's result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wareflow.llm import bpe, decontamination, fingerprints, html_extraction, jaccard_join, language_id, line_dedup, periodic_runs, substring_dedup, token_alignment, token_counts, toxicity, url_filter

Query = tuple[Callable[[SparkSession, str], DataFrame], str | None]

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
TOKEN_LIMIT = 512
# Bound of the sample of labelled rows that the toxicity classifier is fitted on; see toxicity.labelled_sample
LABELLED = 50_000

RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: Column, n: int) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(n))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES) + " AS rules(host, path, verdict)")
    return url_filter.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


OP1_SQL = """
WITH split AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.org/es/', 'example.org/en/1', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM (SELECT *, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
  END AS rule FROM split)
"""


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_words(table(spark, sf_dir, "documents").select("doc_id", "text"), window=20)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 4) == 2
    model = language_id.fit(docs.where(~F.coalesce(held_out, F.lit(False))))
    return language_id.predict(docs.select("doc_id", "text", held_out.alias("held_out")), model).select("doc_id", "held_out", "lang_pred", "score")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_and_decode(table(spark, sf_dir, "documents").select("doc_id", "text"), VOCABULARY, keep=["doc_id"])
    return coded.select(
        "doc_id",
        F.size("token_ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=4, similar=85)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    found = decontamination.find_contamination(docs, benchmark, n=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_extraction.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"))
    counted = token_counts.count_tokens(docs, VOCABULARY, keep=["doc_id", "n_bytes"])
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = remainder(F.col("doc_id"), 3) == 1
    labels = table(spark, sf_dir, "labels").where(remainder(F.col("doc_id"), 3) != 1)
    model = toxicity.fit(toxicity.labelled_sample(docs, labels, bound=LABELLED))
    scored = toxicity.score(docs.withColumn("held_out", held_out), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    aligned = token_alignment.align(docs, VOCABULARY, PIECES, keep=["doc_id"])
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return token_alignment.score_links(aligned.withColumn("groups_sha256", digest).drop("groups"))


def rewound(doc_id: Column, text: Column) -> Column:
    """Text of every tenth document by hash, with the words from one on repeated from there; others as they are."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def edited(words: Column) -> Column:
        n = F.size(words)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        at = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, F.when(i >= a, a + (i - a) % p).otherwise(i).cast("int")))
        return F.when(n > 0, F.array_join(at, " "))

    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    return F.when(h % 10 == 0, F.element_at(F.transform(F.array(words), edited), 1)).otherwise(text)


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", rewound(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic_runs.find_runs(docs, shortest=24, times=3, keep=["doc_id"])
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = F.col("strongest")
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        *[best[c].alias(c) for c in ("start", "length", "period")],
        F.expr("(1000 * strongest.length) div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(listed, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = line_dedup.dedup_lines(docs, least=10, shortest=1)
    return cut.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLDED = f"translate(text, '{UPPER}', '{LOWER}')"
_PLAIN_WORDS = r"coalesce(regexp_extract_all({}, '[^\x20\x09-\x0D]+'), [])"
_LETTER_WORDS = r"coalesce(regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"

OP2_SQL = f"""
WITH d AS (SELECT doc_id, {_PLAIN_WORDS.format('text')} AS w FROM documents),
windows AS (SELECT doc_id, p, w[p:p + 19] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM d WHERE len(w) >= 20)),
later AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY g ORDER BY doc_id, p) AS nth FROM windows) WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS i FROM later),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP5_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_PLAIN_WORDS.format(_FOLDED)} AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, w[p:p + 3] AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS p FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS inboth FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM shared JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y WHERE 100 * inboth >= 85 * (s.n + t.n - inboth)),
reach(x, y) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.y) AS component_id
FROM d JOIN reach r ON r.x = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id GROUP BY d.doc_id
"""

OP6_SQL = f"""
WITH d AS (SELECT doc_id, {_LETTER_WORDS.format(_FOLDED)} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_LETTER_WORDS.format(_FOLDED)} AS w FROM benchmark),
wanted AS (SELECT DISTINCT item, w[p:p + 9] AS g FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 8, 2))) AS p FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT len(g) AS m FROM wanted),
windows AS (SELECT doc_id, m, p, w[p:p + m - 1] AS g FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM d JOIN lengths ON len(w) >= m)),
hits AS (SELECT doc_id, m, p, item FROM windows JOIN wanted USING (g)),
counted AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + m)) AS i FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN counted USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT r, unnest(l) AS line, unnest(range(len(l))) AS i FROM d),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS k FROM lines),
common AS (SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT r) >= 10),
kept AS (SELECT r, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS t FROM keyed ANTI JOIN common USING (k) GROUP BY r)
SELECT doc_id, CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - coalesce(n, 0) AS BIGINT) AS n_dropped, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""


QUERIES: dict[str, Query] = {
    "op1_url_filter": (op1, OP1_SQL),
    "op2_substring_dedup": (op2, OP2_SQL),
    "op3_language_id": (op3, None),
    "op4_bpe": (op4, None),
    "op5_jaccard_join": (op5, OP5_SQL),
    "op6_decontamination": (op6, OP6_SQL),
    "op7_html_extraction": (op7, None),
    "op8_fingerprints": (op8, None),
    "op9_token_counts": (op9, None),
    "op10_toxicity": (op10, None),
    "op11_token_alignment": (op11, None),
    "op12_periodic_runs": (op12, None),
    "op13_line_dedup": (op13, OP13_SQL),
}
