"""Periodic runs, line dedup and token alignment against brute-force versions, with odd rows."""

import random
import re
from collections import Counter, defaultdict
from fractions import Fraction
from zlib import crc32

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from test_text_operators import LOW, SCHEMA, corpus, frame, sha
from tokenizers import Tokenizer

import corpus_pipeline
from wareflow.llm import jaccard_join, language_id, line_dedup, periodic_runs, queries, token_alignment, toxicity, url_filter

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


# periodic runs


def runs_of(words, shortest=24, times=3):
    """All runs, by looking at every period and every place."""
    found = {}
    for p in range(1, len(words) // times + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(shortest, times * p) and j > i:
                found.setdefault((i, j + p), p)
            i = max(j, i + 1)
    return sorted((a, b - a, p) for (a, b), p in found.items())


def collapsed(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def periodic(seed, n=60):
    rng, texts = random.Random(seed), [None, "", " \n\t", "one", "a " * 23, "a " * 24, "a b " * 5000]
    for _ in range(n):
        words = []
        while len(words) < rng.randrange(1, 250):
            unit = [f"w{rng.randrange(rng.choice([2, 5, 80]))}" for _ in range(rng.randrange(1, 14))]
            words += unit * rng.choice([1, 1, 2, 3, 4, 9]) + (words[-20:] * rng.randrange(3) if words else [])
        texts.append("\n".join(words))
    texts += texts[-3:]
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_runs_of_odd_texts(spark, seed):
    rows = periodic(seed)
    docs = spark.createDataFrame([(i, t, "old", "old") for i, t in rows], "doc_id bigint, text string, n_words string, strongest string")
    got = {r["doc_id"]: r for r in periodic_runs.find_runs(docs).collect()}
    for i, t in rows:
        words, r = split(t), got[i]
        want = runs_of(words)
        assert r["text"] == t and r["n_words"] == len(words)
        assert [(x["start"], x["length"], x["period"]) for x in r["runs"]] == want
        assert r["collapsed"] == collapsed(words, want)
        best = max(want, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=None)
        assert (r["strongest"] and (r["strongest"]["start"], r["strongest"]["length"], r["strongest"]["period"])) == best


def test_other_limits(spark):
    rows = periodic(7)
    got = {r["doc_id"]: r["runs"] for r in periodic_runs.find_runs(frame(spark, rows), shortest=8, times=4).collect()}
    assert all([(x["start"], x["length"], x["period"]) for x in got[i]] == runs_of(split(t), 8, 4) for i, t in rows)
    with pytest.raises(ValueError):
        periodic_runs.find_runs(frame(spark, rows), times=2)


def test_runs_of_no_documents(spark):
    assert periodic_runs.find_runs(frame(spark, [(1, "a")]).where("false")).collect() == []


def test_grammar_tells_how_far_places_agree():
    rng = random.Random(4)
    for _ in range(60):
        row = np.array([1000] + [rng.randrange(rng.choice([1, 2, 6])) for _ in range(rng.randrange(2, 300))] + [1001])
        grammar = periodic_runs.Grammar(row)
        a = np.array([rng.randrange(len(row) - 1) for _ in range(50)])
        b = np.array([rng.randrange(x + 1, len(row)) for x in a])
        for way in (1, -1):
            got = grammar.agreeing(a, b, way)
            for x, y, n in zip(a, b, got, strict=True):
                k = 0
                while 0 <= x + way * k and y + way * k < len(row) and row[x + way * k] == row[y + way * k]:
                    k += 1
                assert n == k


def test_periodic_runs_query(spark):
    want = {}
    for i, t in documents(spark):
        words = split(t)
        h, n = crc32(str(i).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (k - a) % p] if k >= a else w for k, w in enumerate(words)]
        runs = runs_of(words)
        best = max(runs, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=(None, None, None))
        milli = 1000 * best[1] // best[2] if runs else None
        want[i] = (i, len(runs), *best, milli, sha("".join(f"{s},{m},{p}\n" for s, m, p in runs)), sha(collapsed(words, runs)))
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = {r["doc_id"]: tuple(r[c] for c in columns) for r in queries.op12(spark, SF).collect()}
    assert got == want and any(r[1] for r in want.values())


# line dedup


def lines_kept(texts, least, shortest):
    keys = [[line.strip(SPACE).translate(LOW) for line in (t or "").split("\n")] for t in texts]
    n = Counter(k for own in keys for k in set(own))
    gone = {k for k, c in n.items() if c >= least and len(k) >= shortest}
    return [(len(own), sum(k in gone for k in own), "\n".join(x for x, k in zip((t or "").split("\n"), own, strict=True) if k not in gone)) for t, own in zip(texts, keys, strict=True)]


def lined(seed, n=150):
    rng = random.Random(seed)
    pool = ["", " ", "Accept Cookies", "\taccept cookies\r", "ÉTÉ", "été", "日本", "x", "\x00", "a "] + [f"line {i}" for i in range(60)]
    texts = [None, "", "\n", "\n\n", "Accept Cookies", "long " * 40_000 + "\nACCEPT COOKIES"]
    return texts + ["\n".join(rng.choice(pool[: rng.choice([6, 12, 70])]) for _ in range(rng.randrange(1, 9))) for _ in range(n)]


def texts_frame(spark, texts):
    return spark.createDataFrame([(None if k % 9 == 0 else k // 2, t, k, "old") for k, t in enumerate(texts)], "doc_id bigint, text string, n_lines bigint, _row string").repartition(3)


def kept_rows(df):
    return sorted((r["n_lines"], r["n_dropped"], r["text"]) for r in df.collect())


@pytest.mark.parametrize(("least", "shortest"), [(10, 1), (2, 0), (25, 3), (1, 1)])
@pytest.mark.parametrize("filter_bytes", [line_dedup.FILTER_BYTES, 0])
def test_lines(spark, least, shortest, filter_bytes):
    texts = lined(least)
    docs = texts_frame(spark, texts)
    index = line_dedup.insert(line_dedup.empty_index(spark, least, shortest), docs)
    got = line_dedup.drop_common_lines(docs, index, filter_bytes=filter_bytes)
    assert got.columns == ["doc_id", "text", "_row", "n_lines", "n_dropped"]
    assert kept_rows(got) == sorted(lines_kept(texts, least, shortest))


@pytest.mark.parametrize("keys", [line_dedup.KEYS, 16])
def test_deletions_undo_insertions(spark, monkeypatch, keys):
    """With many shards as well as with one."""
    monkeypatch.setattr(line_dedup, "KEYS", keys)
    first, second, third = lined(1, 60), lined(2, 90), lined(3, 40)
    index = line_dedup.insert(line_dedup.empty_index(spark, 10, 1), texts_frame(spark, first))
    after_first = sorted(map(tuple, index.counts.collect()))
    index = line_dedup.insert(index, texts_frame(spark, second))
    index = line_dedup.insert(index, texts_frame(spark, third))
    assert index.shard_bits == (0 if keys > 16 else 3)
    assert kept_rows(line_dedup.drop_common_lines(texts_frame(spark, second), index)) == sorted(lines_kept(second + first + third, 10, 1)[: len(second)])
    index = line_dedup.delete(index, texts_frame(spark, second))
    left = first + third
    assert kept_rows(line_dedup.drop_common_lines(texts_frame(spark, left), index)) == sorted(lines_kept(left, 10, 1))
    index = line_dedup.delete(index, texts_frame(spark, third))
    assert sorted(map(tuple, index.counts.collect())) == after_first
    with pytest.raises(Exception, match="never inserted"):
        line_dedup.delete(index, texts_frame(spark, third))


def test_no_lines(spark):
    none = texts_frame(spark, ["a"]).where("false")
    assert line_dedup.dedup_lines(none).collect() == []
    index = line_dedup.insert(line_dedup.empty_index(spark), none)
    assert kept_rows(line_dedup.drop_common_lines(texts_frame(spark, [None]), line_dedup.insert(index, texts_frame(spark, [None])))) == [(1, 0, "")]


def test_cuckoo_filter_takes_keys_in_and_out():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 1 << 63, 50_000).astype(np.uint64)
    cuckoo = line_dedup.Cuckoo.of(keys[:20_000])
    assert cuckoo.contains(keys[:20_000]).all()
    cuckoo.remove(keys[:15_000])
    assert cuckoo.contains(keys[15_000:20_000]).all() and cuckoo.contains(keys[:15_000]).mean() < 0.001
    assert cuckoo.insert(keys[20_000:30_000]) and cuckoo.contains(keys[15_000:30_000]).all()
    cuckoo.remove(keys[15_000:30_000])
    assert not cuckoo.table.any()
    with pytest.raises(ValueError):
        cuckoo.remove(keys[:1])


# token alignment


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(queries.VOCABULARY)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)


def aligned_rows(tokenizers, rows):
    """What the alignment query returns, by definition."""
    a, b = tokenizers
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(c): c for c in printable} | {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in printable)}
    names = {i: t for t, i in a.get_vocab().items()}
    done, held = [], defaultdict(set)
    for k, (i, t) in enumerate(rows):
        ids_a, ids_b = (a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)) if t else ([], [])
        bytes_a = [bytes(letters[c] for c in names[x]) for x in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(x)[3:5], 16)]) if b.is_byte(x) else b.id_to_piece(x).replace("▁", " ").encode() for x in ids_b]
        if not t or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + t).encode():
            done.append((i, [], [], []))
            continue
        ends_a, ends_b = np.cumsum(list(map(len, bytes_a))).tolist(), np.cumsum(list(map(len, bytes_b))).tolist()
        groups, x, y = [], 0, 0
        for e in sorted(set(ends_a) & set(ends_b)):
            u, v = ends_a.index(e, x) + 1, ends_b.index(e, y) + 1
            groups.append((ids_a[x:u], ids_b[y:v]))
            x, y = u, v
        for own_a, own_b in groups:
            for p in own_a:
                for q in own_b:
                    held[p, q].add(k)
        done.append((i, ids_a, ids_b, groups))
    most = defaultdict(int)
    for (p, _), ks in held.items():
        most[p] = max(most[p], len(ks))
    out = []
    for i, ids_a, ids_b, groups in done:
        links = [(p, q) for own_a, own_b in groups for p in own_a for q in own_b]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        best = sum(len(held[link]) == most[link[0]] for link in links)
        out.append((i, len(ids_a), len(ids_b), len(groups), len(links), best, sum(len(held[link]) for link in links), text))
    return out


ODD = [None, "", " ", "   ", "\n\n  \t x", "a▁b", "<s> </s> <unk> <|endoftext|> [UNK]", "<0x41> Ġ", "naïve café​ 日本語テキスト emoji 👩‍👩‍👧 ﬁ", "\x00\x01 \x7f", "� é", "don't  we'll   THE\r\nend ", "x" * 3000, "1234567890 " * 50]


@pytest.mark.parametrize("frequent", [1 << 18, 40, 1])
def test_alignment_of_odd_texts(spark, tokenizers, frequent):
    rows = [(i, t) for i, t in enumerate(ODD)] + corpus(5, 40)
    rows += rows[-4:-1]
    docs = spark.createDataFrame([(i, t, "old", "old") for i, t in rows], "doc_id bigint, text string, n_a string, _row string").repartition(3)
    got = token_alignment.score_links(token_alignment.align(docs, queries.VOCABULARY, queries.PIECES), frequent)
    assert got.columns == ["doc_id", "text", "_row", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    assert sorted(tuple(r[c] for c in columns) for r in got.collect()) == sorted(aligned_rows(tokenizers, rows))


def test_windows_are_forgotten(spark, tokenizers, monkeypatch):
    """Results do not depend on what a worker remembers."""
    rows = corpus(6, 30)[7:]
    aligner = token_alignment._Aligner(queries.VOCABULARY, queries.PIECES)
    monkeypatch.setattr(token_alignment, "CHARACTERS", 50)
    want = [r[-1] for r in aligned_rows(tokenizers, rows)]
    assert [g for _, t in rows for g in aligner.align([t])[4]] == want


def test_no_documents_to_align(spark):
    docs = spark.createDataFrame([], SCHEMA)
    aligned = token_alignment.align(docs, queries.VOCABULARY, queries.PIECES)
    assert token_alignment.score_links(aligned).collect() == []


def test_alignment_query(spark, tokenizers):
    rows = documents(spark)
    want = sorted((*r[:7], sha(r[7]) if r[7] else "") for r in aligned_rows(tokenizers, rows))
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(tuple(r[c] for c in columns) for r in queries.op11(spark, SF).collect()) == want


def test_units_give_what_whole_texts_give():
    """As for a model that cannot be read by units."""
    texts = [t or "" for t in ODD] + ["a\n  b", "a\n b ", "a \n\n   b\x1c  c\u2028 d", " \t ", "x\n   "]
    aligner = token_alignment._Aligner(queries.VOCABULARY, queries.PIECES)
    by_units = aligner.align(texts)
    aligner.unit = re.compile("(?s).+")
    aligner.forget()
    assert all(list(x) == list(y) for x, y in zip(by_units, aligner.align(texts), strict=True))


def test_kept_column_names(spark):
    docs = frame(spark, [(1, "a b c")]).withColumn("x`y", F.lit(1))
    assert "x`y" in periodic_runs.find_runs(docs).columns and "x`y" in line_dedup.dedup_lines(docs).columns
    assert "x`y" in token_alignment.align(docs, queries.VOCABULARY, queries.PIECES).columns


INNER = ["j", "head", "labels", "key", "host", "c", "_lower", "_readable", "_lang", "_score", "_labelled", "_label", "_other", "id", "n", "y", "t"]


def with_inner_names(df):
    """`df` with columns named like those that the operators use inside."""
    return df.withColumns({c: F.lit(f"own {c}") for c in INNER if c not in df.columns})


def unharmed(df, but=()):
    return df.where(" OR ".join(f"`{c}` <> 'own {c}' OR `{c}` IS NULL" for c in INNER if c not in but)).isEmpty()


def test_columns_named_like_inner_ones_stay(spark):
    docs = with_inner_names(spark.createDataFrame([(i, f"some plain words number {i} and more of them", "en") for i in range(12)] + [(20, None, "fr"), (21, "des mots en clair", "fr")], "doc_id bigint, text string, lang string"))
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id bigint, toxic int")
    model = language_id.fit(docs)
    guessed = language_id.predict(docs, model)
    assert unharmed(guessed) and {r.doc_id: r.lang_pred for r in guessed.collect()}[21] == "fr"
    sample = toxicity.labelled_sample(docs, labels, bound=100)
    assert unharmed(sample) and sorted((r.doc_id, r.toxic) for r in sample.collect()) == [(1, 1), (2, 0), (3, 0)]
    assert unharmed(jaccard_join.keep_one_of_each(docs)) and jaccard_join.keep_one_of_each(docs).columns == docs.columns
    kept = corpus_pipeline.drop_toxic(spark, docs, SF)
    assert unharmed(kept) and kept.columns == docs.columns
    rules = spark.createDataFrame([("b.c", "/x", "block")], "host string, path string, verdict string")
    pages = with_inner_names(spark.createDataFrame([(1, "http://a.b.c/x/y"), (2, "http://q.r/")], "page_id bigint, url string"))
    for listed in (rules, rules.where("false")):
        judged = url_filter.filter_urls(pages, listed)
        assert unharmed(judged, but=("host",)) and [r.host for r in judged.orderBy("page_id").collect()] == ["a.b.c", "q.r"]
