"""The rounds must give what the one-after-the-other loop gives."""

import random
import re
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from wareflow.functions import names as n
from wareflow.operators import grouping as g
from wareflow.operators.similar_names import ratio_matches, text_matches

STOP = {"the", "a", "an", "of", "for", "with", "and", "or"}


def similar(base, name, name_base):
    if SequenceMatcher(None, base, name_base).ratio() >= 0.7 or base in name:
        return True
    wanted = set(base.split()) - STOP
    return len(wanted) >= 2 and wanted <= set(name.split()) - STOP


def loop_leaders(rows, bases):
    """rows: (row_no, brand, name) in order; bases: name -> lower-case base name."""
    seeds, out = {}, {}
    for row_no, brand, name in sorted(rows):
        mine = seeds.setdefault(brand, [])
        for seed_no, base in mine:
            if similar(base, name.lower(), bases[name]):
                out[row_no] = seed_no
                break
        else:
            mine.append((row_no, bases[name]))
            out[row_no] = row_no
    return out


def random_rows(seed, n_rows):
    rng = random.Random(seed)
    parts = ["soap", "soaps", "silk", "milk", "oil", "balm", "hand", "and", "gel", "the", "wash", "was", "rose", "red", "10 grams", "50ml", "2 pack", "#3", "(new)", "cream"]
    return [
        (i, rng.choice(["A", "A", "A", "B", "C c"]), " ".join(rng.choice(parts) for _ in range(rng.randint(1, 4))))
        for i in range(n_rows)
    ]


def test_rounds_equal_the_loop(spark):
    for seed, block in ((1, 9), (2, 25), (3, 500)):
        rows = random_rows(seed, 150)
        df = spark.createDataFrame(rows, "row_no bigint, brand string, name string").repartition(3)
        bases = {r.name: r.base for r in df.select("name", n.base_name_key(F.col("name")).alias("base")).collect()}
        got = {r.row_no: r.group_no for r in g.leader_groups(df, block=block).collect()}
        assert got == loop_leaders(rows, bases), (seed, block)


def test_rounds_of_a_large_brand(spark):
    """Names of one brand, most of them unlike all others: equal to the loop, and few rounds a turn."""
    rng = random.Random(5)
    syllables = ["ka", "lo", "mi", "ra", "ven", "tor", "su", "bel", "na", "chi", "po", "du", "fex", "gri"]
    vocabulary = ["".join(rng.choice(syllables) for _ in range(3)) for _ in range(150)]
    names = list(dict.fromkeys(" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 5))) + f" {rng.choice([50, 250])}ml" for _ in range(430)))
    rows = [(i, "A", name) for i, name in enumerate(names)]
    df = spark.createDataFrame(rows, "row_no bigint, brand string, name string").repartition(3)
    nodes = g.name_nodes(df)
    bases = {r.name: r.base_key for r in nodes.collect()}
    log = []
    got = {r.node_no: r.seed_no for r in g.name_leaders(nodes, block=60, log=log).collect()}
    assert got == loop_leaders(rows, bases)
    assert max(turn for turn, _ in log) <= 9 and sum(left == 0 for _, left in log) in (2, 3)


def test_indexes_find_all_similar_names(spark):
    """Every pair of a base and a name, by the plain rules; odd names too."""
    rows = random_rows(11, 90)
    odd = ["a", "ab", "the of", "x" * 90 + " soap", "x" * 88 + " soaps", "Crème brûlée", "soap soap soap", "日本 石鹸", "  rose   oil "]
    names = sorted({name for _, _, name in rows} | set(odd))
    nodes = g.name_nodes(spark.createDataFrame([(i, "A" if i % 3 else "B", x) for i, x in enumerate(names)], "row_no bigint, brand string, name string"))
    plain = nodes.collect()
    sources = nodes.select("brand", F.col("base_key").alias("source")).distinct()
    text = {(r.source, r.node_no) for r in text_matches(sources, nodes).collect()}
    for pack in (3, 2048):
        ratio = {(r.brand, r.source, r.target) for r in ratio_matches(sources, sources.withColumnRenamed("source", "target"), 0.7, pack).collect()}
        bases = {(r.brand, r.base_key) for r in plain}
        assert ratio == {(p, a, b) for p, a in bases for q, b in bases if p == q and SequenceMatcher(None, a, b).ratio() >= 0.7}
    want = set()
    for brand, base in {(r.brand, r.base_key) for r in plain}:
        wanted = set(base.split()) - STOP
        want |= {(base, r.node_no) for r in plain if r.brand == brand and (base in r.name_key or (len(wanted) >= 2 and wanted <= set(r.name_key.split())))}
    assert text == want


def test_base_names(spark):
    cases = {
        "Shampoo Black 50ml": "Shampoo",
        "Lipstick Red #45": "Lipstick",
        "Cream 100g Vanilla": "Cream",
        "Honey 10 grams": "Honey Rams",
        "Salt & Pepper": "Salt  Pepper",
        "Red 5": "Red 5",
        "Soap (old) - mint": "Soap",
        "Cream-Gel": "Cream",
        "Crème Brûlée 3 pack": "Crème Brûlée",
        "Fluid ٥٠ ml": "Fluid",
    }
    df = spark.createDataFrame([(k,) for k in cases], "name string")
    got = {r.name: r.base for r in df.select("name", n.base_name(F.col("name")).alias("base")).collect()}
    assert got == cases


def test_text_rules_and_bounds_never_contradict_the_plain_rules(spark):
    rows = random_rows(9, 60)
    names = sorted({name for _, _, name in rows})
    df = spark.createDataFrame([(x,) for x in names], "name string").select("name", n.base_name_key(F.col("name")).alias("base"))
    pairs = df.select(F.col("name").alias("n1"), F.col("base").alias("b1")).join(
        df.select(F.col("name").alias("n2"), F.col("base").alias("b2")), F.col("n1") <= F.col("n2")
    )
    got = pairs.select(
        "*",
        n.similar_by_text(F.col("b1"), F.lower("n2")).alias("text"),
        n.ratio_can_reach(F.col("b1"), F.col("b2"), n.letter_counts(F.col("b1")), n.letter_counts(F.col("b2")), 0.7).alias("possible"),
        g.sequence_ratio("b1", "b2").alias("ratio"),
    ).collect()
    for r in got:
        assert r.ratio == SequenceMatcher(None, r.b1, r.b2).ratio()
        assert r.possible or r.ratio < 0.7
        wanted = set(r.b1.split()) - STOP
        assert r.text == (r.b1 in r.n2.lower() or (len(wanted) >= 2 and wanted <= set(r.n2.lower().split())))


def test_example_group(spark):
    df = spark.createDataFrame(
        [(1, "X", "Shampoo Black 50ml"), (2, "X", "Shampoo Red 50ml"), (3, "X", "Shampoo Black 100ml"), (4, "Y", "Shampoo Red 50ml")],
        "row_no bigint, brand string, name string",
    )
    assert {r.row_no: r.group_no for r in g.leader_groups(df).collect()} == {1: 1, 2: 1, 3: 1, 4: 4}


def test_group_index_follows_first_seen_brands(spark):
    df = spark.createDataFrame([(5, "B"), (1, "C"), (9, "C"), (7, "B"), (3, "A")], "group_no bigint, brand string")
    assert {r.group_no: r.group_index for r in g.group_index(df).collect()} == {1: 1, 9: 2, 3: 3, 5: 4, 7: 5}


def test_group_images_keep_first_order(spark):
    df = spark.createDataFrame(
        [(1, 1, ["a", "b"]), (1, 2, ["b", "c", "a"]), (2, 3, ["a", "a", ""]), (3, 4, [])], "group_no bigint, row_no bigint, images array<string>"
    )
    got = sorted((r.group_no, r.position, r.url) for r in g.group_images(df).collect())
    assert got == [(1, 1, "a"), (1, 2, "b"), (1, 3, "c"), (2, 1, "a")]


def test_pattern_source_has_no_java_word_class():
    assert not any(re.search(r"\\[bw]", mark) for mark in n._VARIANT_MARKS)
