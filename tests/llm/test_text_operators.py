"""The operators on whole texts against brute-force versions, with odd rows."""

import hashlib
import random
import re
from collections import defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wareflow.llm import bpe, decontamination, fingerprints, jaccard_join, language_id, queries, substring_dedup, token_counts, toxicity

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id bigint, text string, n_words string, score string"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def frame(spark, rows, parts=3):
    """Documents with columns whose names clash with added ones."""
    return spark.createDataFrame([(i, t, "old", "old") for i, t in rows], SCHEMA).repartition(parts)


def corpus(seed, n=120):
    """Documents with exact and near copies, shared passages, periodic texts, nulls, empty and very long texts."""
    rng = random.Random(seed)
    vocabulary = ["alpha", "Beta", "gamma,", "δέλτα", "e.", "Zeta-9", "été", "th", "x\x00y", "日本"]
    sentence = lambda k: " ".join(rng.choice(vocabulary) + str(rng.randrange(60)) for _ in range(k))
    passage, texts = sentence(45), [None, "", "  \n\t ", "one", "two words", "a " * 90, "b c " * 60]
    for _ in range(n):
        kind = rng.randrange(6)
        if kind == 0 and len(texts) > 9:
            texts.append(rng.choice(texts[7:]))
        elif kind == 1 and len(texts) > 9:
            words = rng.choice(texts[7:]).split(" ")
            for _ in range(rng.randrange(1, 3)):
                words[rng.randrange(len(words))] = "changed"
            texts.append(" ".join(words))
        elif kind == 2:
            texts.append(f"{sentence(rng.randrange(30))}\n{passage}  {sentence(rng.randrange(30))}")
        else:
            texts.append(sentence(rng.randrange(1, 150)))
    texts.append(sentence(20_000))
    ids = rng.sample(range(10_000), len(texts))
    return list(zip(ids, texts, strict=True))


def repeated(rows, window):
    first, out = set(), []
    for i, t in sorted(rows, key=lambda r: r[0]):
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        gone = [False] * len(words)
        for p in range(len(words) - window + 1):
            key = tuple(words[p : p + window])
            if key in first:
                gone[p : p + window] = [True] * window
            first.add(key)
        out.append((i, len(words), sum(gone), sha(" ".join(w for w, g in zip(words, gone, strict=True) if not g))))
    return sorted(out)


@pytest.mark.parametrize("window", [2, 7, 20])
def test_substring_dedup(spark, window):
    rows = corpus(window)
    got = substring_dedup.repeated_words(frame(spark, rows), window).collect()
    assert sorted(map(tuple, got)) == repeated(rows, window)


def test_substring_dedup_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(None, text), (5, text), (5, text), (7, "short"), (7, "short")]
    got = sorted(map(tuple, substring_dedup.repeated_words(frame(spark, rows)).collect()), key=str)
    assert [(r[0], r[1], r[2]) for r in got] == [(5, 30, 30), (5, 30, 30), (7, 1, 0), (7, 1, 0), (None, 30, 0)]
    assert substring_dedup.repeated_words(frame(spark, [])).count() == 0
    kept = substring_dedup.remove_repeats(frame(spark, [(1, text + "  tail \n"), (2, "head\n " + text + "  end")])).orderBy("doc_id")
    assert kept.columns == ["doc_id", "text", "n_words", "score"]
    assert [tuple(r) for r in kept.collect()] == [(1, text + "  tail \n", "old", "old"), (2, "head\n end", "old", "old")]


def linked(rows, length, similar):
    sets = {}
    for i, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
        sets[i] = {tuple(words[p : p + length]) for p in range(len(words) - length + 1)} or ({tuple(words)} if words else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    names = sorted(sets)
    for k, a in enumerate(names):
        for b in names[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= similar * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i)) for i, s in sets.items())


@pytest.mark.parametrize("length,similar", [(4, 85), (5, 80), (2, 66)])
def test_jaccard_join(spark, length, similar):
    rows = corpus(similar)
    # chains of close texts: far ends are no pair, so regions must be split
    base = [f"c{i}" for i in range(60)]
    rows += [(20_000 + k, " ".join([f"n{j}" for j in range(2 * k)] + base[2 * k :])) for k in range(20)]
    got = jaccard_join.link_documents(frame(spark, rows), length, similar).collect()
    assert sorted(map(tuple, got)) == linked(rows, length, similar)


def test_jaccard_signatures_are_counted_after_they_are_dealt(spark, monkeypatch):
    plans, store = {}, jaccard_join.stored
    monkeypatch.setattr(jaccard_join, "stored", lambda df, folder, name: plans.setdefault(name, df) and store(df, folder, name))
    jaccard_join.link_documents(frame(spark, corpus(5, 40))).collect()
    steps = re.findall(r"HashAggregate|Exchange|MapInArrow", plans["signatures"]._jdf.queryExecution().executedPlan().toString())
    assert steps[steps.index("MapInArrow") - 1] == "Exchange", "no task holds a table of all its signatures before the shuffle"


def test_a_worker_sends_each_signature_once(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "ROWS", 7)
    text = " ".join(f"w{i}" for i in range(90))
    docs = spark.createDataFrame([(i, text) for i in range(300, 0, -1)], "id bigint, text string").coalesce(1)
    given = jaccard_join._signatures(docs, 5, 80)
    each = given.groupBy("signature").agg(F.min("id"), F.max("id"), F.count("*")).collect()
    got = jaccard_join._signatures(docs, 5, 80, once=True).collect()
    assert sorted(map(tuple, got)) == sorted(tuple(r)[:3] for r in each)
    assert {tuple(r)[1:] for r in each} == {(1, 300, 300)}


def test_jaccard_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(None, text), (3, text), (3, text), (9, text.upper()), (4, None), (5, "")]
    got = sorted(map(tuple, jaccard_join.link_documents(frame(spark, rows)).collect()), key=str)
    assert got == [(3, 27, 3), (3, 27, 3), (4, 0, 4), (5, 0, 5), (9, 27, 3), (None, 27, None)]
    assert jaccard_join.link_documents(frame(spark, [])).count() == 0
    kept = jaccard_join.keep_one_of_each(frame(spark, rows))
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [3, 3, 4, 5, None]


def test_decontamination(spark):
    docs = corpus(3)
    words = [t for _, t in docs if t and len(t.split()) > 40]
    items = [(1, " ".join(words[0].split()[5:22])), (10, words[1].replace(" ", " -- ")), (2, "Gamma7"), (3, None), (4, "?!"), (None, "two words"), (2, "one")]
    pattern, n = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", 10
    windows = defaultdict(set)
    for i, t in items:
        own = re.findall(pattern, (t or "").translate(LOW))
        size = min(n, len(own))
        for p in range(len(own) - size + 1 if size else 0):
            windows[tuple(own[p : p + size])].add("" if i is None else str(i))
    want = []
    for i, t in docs:
        own, hit, found = re.findall(pattern, (t or "").translate(LOW)), set(), set()
        for size in {len(w) for w in windows}:
            for p in range(len(own) - size + 1):
                if tuple(own[p : p + size]) in windows:
                    hit |= set(range(p, p + size))
                    found |= windows[tuple(own[p : p + size])]
        want.append((i, len(own), len(hit), sorted(found)))
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    for block in (1_000_000, 40):  # one block, several blocks
        got = decontamination.find_contamination(frame(spark, docs), benchmark, n, block=block)
        assert sorted((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got.collect()) == sorted(want)
    clean = decontamination.decontaminate(frame(spark, docs), benchmark, n)
    assert clean.columns == ["doc_id", "text", "n_words", "score"]
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(i for i, _, hits, _ in want if not hits)
    assert {r["n_words"] for r in clean.collect()} == {"old"}
    cut = decontamination.decontaminate(frame(spark, [(1, "Keep, GAMMA7! this")]), benchmark, n, remove="spans").first()
    assert cut["text"] == "Keep, ! this"
    assert decontamination.find_contamination(frame(spark, docs), benchmark.limit(0)).where("n_hit > 0").count() == 0
    assert decontamination.find_contamination(frame(spark, []), benchmark).count() == 0


def odd_texts(seed):
    rng = random.Random(seed)
    parts = ["'", "s", "re", "ll", " ", "  ", "\n", "1", "½", "!", "é", "日", "\xa0", "a", "<|endoftext|>", "\t", "🙂", "\u088f", "\x1c", "thing"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(1500)]


def test_tokens(spark):
    tokenizer = Tokenizer.from_file(PATH)
    texts = [None, *odd_texts(1), *[t for _, t in corpus(5)], "-" * 700, " " * 900 + "x", "ab" * 3000]
    rows = list(enumerate(texts))
    docs = frame(spark, rows)
    coded = bpe.encode(docs, PATH)
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    back = {r["doc_id"]: (r["token_ids"], r["decoded"]) for r in bpe.decode(coded, PATH).collect()}
    assert [back[i][0] for i, _ in rows] == want
    assert [back[i][1] for i, _ in rows] == [tokenizer.decode(x, skip_special_tokens=False) for x in want]
    counted = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(docs, PATH).collect()}
    assert [counted[i] for i, _ in rows] == [len(x) for x in want]
    assert bpe.decode(bpe.encode(frame(spark, []), PATH), PATH).count() == token_counts.count_tokens(frame(spark, []), PATH).count() == 0


def test_caches_do_not_change_results(monkeypatch):
    texts = [t for _, t in corpus(8) if t]
    tokenizer = Tokenizer.from_file(PATH)
    want = [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]
    monkeypatch.setattr(bpe, "CACHED", 50)
    monkeypatch.setattr(token_counts, "STATES", 50)
    encoder, counter = bpe._Encoder(PATH), token_counts.Tokenizer(PATH)
    for t, n in zip(texts, want, strict=True):
        assert encoder.encode([t])[1].tolist() == [n]
        import numpy as np

        data = np.frombuffer(t.encode(), np.uint8)
        assert counter.count(data, np.array([0, len(data)])).tolist() == [n]


def test_compatible_pairs_are_exact():
    import numpy as np

    vocabulary = bpe.Vocabulary(PATH)
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 50256, 3000), rng.integers(0, 50256, 3000)
    want = [vocabulary.merge(vocabulary.bytes[x] + vocabulary.bytes[y]) == [x, y] for x, y in zip(a, b, strict=True)]
    assert vocabulary.compatible(a, b).tolist() == want


@pytest.mark.parametrize("part", [1 << 22, 2000])
def test_fingerprints(spark, part, monkeypatch):
    monkeypatch.setattr(fingerprints, "PART_BYTES", part)
    rows = sorted(corpus(6), key=lambda r: -r[0])
    got = {r["doc_id"]: r for r in fingerprints.compare_with_next(frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    for k, (i, t) in enumerate(rows):
        t, after = t or "", rows[(k + 1) % len(rows)][1] or ""
        edited = fingerprints.spliced(t, after)
        a, b, c = fingerprints.Tree(t), fingerprints.Tree(edited), fingerprints.Tree(after)
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"]) == (len(t), sha(edited), a.root, b.root)
        assert (r["near_edited"], r["near_next"]) == (fingerprints.likeness(a, b), fingerprints.likeness(a, c))
        assert 0 <= r["near_edited"] <= 1


def test_fingerprints_odd_rows(spark):
    assert fingerprints.compare_with_next(frame(spark, [])).count() == 0
    rows = [(None, "x. y."), (1, None), (1, None), (2, "a.\nb.\nc.")]
    assert fingerprints.compare_with_next(frame(spark, rows)).count() == 4
    one = fingerprints.compare_with_next(frame(spark, [(1, "abc. def. ghi.")])).first()
    assert one["near_next"] == 1.0
    roots = [r["root"] for r in fingerprints.fingerprint(frame(spark, rows)).orderBy("doc_id").collect()]
    assert len(roots) == 4 and roots[1] == roots[2] and len(set(roots)) == 3
    a, b = fingerprints.Tree("\n".join(f"line {i}." for i in range(40))), fingerprints.Tree("\n".join(f"line {i}{'!' if i == 17 else '.'}" for i in range(40)))
    assert fingerprints.edits(a, b) == [17]
    assert fingerprints.likeness(a, b) == 2 * 39 / 80


@pytest.mark.parametrize(
    "text",
    [
        " ".join(f"word{i * i % 97}" for i in range(3000)),
        " ".join(f"w{i * i % 97}" for i in range(20)),
        "".join(chr(0x4E00 + i * i % 997) for i in range(500)),
        "".join(chr(0x4E00 + i * i % 997) + ("。" if i % 9 == 8 else "") for i in range(500)),
        "".join(chr(0x0620 + i * i % 23) + ("؟ " if i % 30 == 29 else "") for i in range(300)),
        "x" * 700,
    ],
)
def test_fingerprints_of_texts_without_full_stops(text):
    other = "".join(chr(0x3041 + i * i % 83) for i in range(len(text)))
    tree = fingerprints.Tree(text)
    assert len(text) / fingerprints.LEAF <= tree.leaves <= len(text) / 2
    # two thirds of the text are kept
    kept = fingerprints.likeness(tree, fingerprints.Tree(fingerprints.spliced(text, other)))
    assert 0.3 < kept < 0.9
    assert fingerprints.likeness(tree, fingerprints.Tree(other)) == 0
    # one word put in near the beginning moves no cut of the rest
    if len(text) > 400:
        assert fingerprints.likeness(tree, fingerprints.Tree(text[:100] + " new " + text[100:])) > 0.7


def test_language_id(spark):
    rng = random.Random(2)
    words = {"en": "the and of to house water".split(), "fr": "le la et une maison été".split(), "de": "der und die ein häuser größe".split()}
    rows = [(i, " ".join(rng.choice(words[lang]) for _ in range(rng.randrange(3, 40))), lang) for i, lang in enumerate(rng.choices(list(words), k=300))]
    train = spark.createDataFrame(rows[:200] + [(900, None, "en"), (901, "the", None)], "doc_id bigint, text string, lang string")
    model = language_id.fit(train)
    odd = [(1000, None, "en"), (1001, "123 !?", "en"), (1002, "é", "xx"), (1002, "é", "xx")]
    test = spark.createDataFrame(rows[200:] + odd, "doc_id bigint, text string, score string")
    got = {r["doc_id"]: r for r in language_id.predict(test, model).collect()}
    assert all(got[i]["lang_pred"] == lang for i, _, lang in rows[200:])
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert [got[i]["lang_pred"] for i in (1000, 1001)] == ["und", "und"] and got[1002]["lang_pred"] in words
    empty = language_id.fit(train.limit(0))
    assert {r["lang_pred"] for r in language_id.predict(test, empty).collect()} == {"und"}


def test_language_of_short_texts(spark):
    rows = [(1, "Re. I go", "en"), (2, "De la vie", "fr"), (3, "A to", "en"), (4, "y no", "es")]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    short = [(1, "Re.", "en"), (2, "De.", "fr"), (3, "A", "en"), (4, "y", "es"), (5, "go", "en"), (6, "vie", "fr")]
    got = {r["doc_id"]: r for r in language_id.predict(spark.createDataFrame([r[:2] for r in short], "doc_id bigint, text string"), model).collect()}
    assert {(i, got[i]["lang_pred"]) for i in got} == {(i, lang) for i, _, lang in short}
    assert all(r["score"] > 0 for r in got.values())


def test_toxicity(spark):
    rng = random.Random(4)
    plain, bad = [f"word{i}" for i in range(80)], ["rotten", "foul"]
    rows = []
    for i in range(400):
        toxic = i % 4 == 0
        words = rng.choices(plain, k=rng.randrange(5, 60)) + (rng.choices(bad, k=2) if toxic else [])
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(toxic)))
    docs = spark.createDataFrame([(i, t, "old") for i, t, _ in rows] + [(900, None, "old"), (901, "", "old")], "doc_id bigint, text string, score string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows[:300]] + [(900, 1), (None, 1), (5, None), (0, 0)], "doc_id bigint, toxic int")
    model = toxicity.fit(toxicity.labelled_sample(docs, labels, bound=1000))
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert sum((got[i] >= 0.7) == bool(y) for i, _, y in rows[300:]) >= 98
    assert got[900] == got[901] and 0 <= got[900] < 0.5
    sample = toxicity.labelled_sample(docs, labels, bound=100).count()
    assert 40 < sample < 160
    assert toxicity.score(docs.limit(3), toxicity.fit(toxicity.labelled_sample(docs, labels.limit(0), bound=10))).select("score").first()[0] == 0.5


def test_queries_need_no_more_than_their_tables(spark):
    assert set(queries.QUERIES) == {next(q for q in queries.QUERIES if q.startswith(f"op{n}_")) for n in range(1, 11)}
    assert all(F.col(c) is not None for c in ("doc_id",))
