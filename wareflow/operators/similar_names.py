"""Which base names are similar to which names, without comparing all names of a brand.

Two exact indexes give the pairs:

- `text_matches`: a base can only occur in a name that holds the base's rarest character triple, and
  its key words can only all stand in a name that holds the rarest of them. So each base is looked up
  under one triple and one word, and names under all of theirs; what meets is tested in full.
- `ratio_matches`: for the match ratio, base names are dealt to length classes (the ratio bounds how
  far two lengths may be apart) and, inside one, to packs of about `PACK` names. Two packs are compared
  in one vectorised step: by length, by shared letters, then by their longest common subsequence, which
  no sum of matching blocks exceeds. Only what passes all three is a pair, and is scored exactly.

Every bound is exact: it only drops pairs that cannot be similar. No pair is a row before it has passed.
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wareflow.functions import names as n
from wareflow.functions.text import words
from wareflow.operators.ordering import rank_in_key

PACK = 2048
_LETTER_BITS = 3  # words of 64 bits that the numbered letters of a base name are hashed to
_U = np.uint64


def ratio_reaches(a: str, b: str, threshold: float) -> bool:
    """Exact test of the match ratio, the cheap upper bounds first."""
    total = len(a) + len(b)
    if total and 2.0 * min(len(a), len(b)) / total < threshold:
        return False
    matcher = SequenceMatcher(None, a, b)
    return matcher.quick_ratio() >= threshold and matcher.ratio() >= threshold


def _grams(text: Column, size: int) -> Column:
    """Distinct substrings of `size` characters."""
    last = F.length(text) - size + 1
    return F.when(last < 1, F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(text, i, F.lit(size))))
    )


def _marked(mark: str, tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.concat(F.lit(mark), t))


def text_matches(bases: DataFrame, names: DataFrame) -> DataFrame:
    """(brand, source, node_no): every pair of `bases` (brand, source) and `names` (brand, node_no, name_key) of one
    brand in which the base occurs in the name, or its two or more key words all do."""
    whole = F.length("source") < 3
    # what a name must hold: for the substring rule all triples, for the word rule all key words
    triples = F.when(whole, F.array(F.concat(F.lit("s"), F.col("source")))).otherwise(_marked("s", _grams(F.col("source"), 3)))
    key_words = n.key_words(F.col("source"))
    needs = F.array(F.struct(F.lit("s").alias("rule"), triples.alias("tokens")), F.struct(F.lit("w").alias("rule"), _marked("w", key_words).alias("tokens")))
    needs = bases.select("brand", "source", F.inline(F.filter(needs, lambda x: (x["rule"] == "s") | (F.size(x["tokens"]) >= 2))))
    needs = needs.select("brand", "source", "rule", F.explode("tokens").alias("token"))
    has = F.concat(
        F.array(F.lit("s")),
        *[_marked("s", _grams(F.col("name_key"), k)) for k in (1, 2, 3)],
        _marked("w", F.array_distinct(words(F.col("name_key")))),
    )
    held = names.select("brand", "node_no", "name_key", F.explode(has).alias("token"))
    # only tokens that some base needs are counted
    held = held.join(needs.select("brand", "token").distinct(), ["brand", "token"], "left_semi")
    often = held.groupBy("brand", "token").agg(F.count("*").alias("n"))
    rated = needs.join(often, ["brand", "token"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = rated.groupBy("brand", "source", "rule").agg(F.min(F.struct("n", "token")).alias("t")).where("t.n > 0")
    rarest = rarest.select("brand", "source", F.col("t.token").alias("token")).distinct()
    met = rarest.join(held, ["brand", "token"]).where(n.similar_by_text(F.col("source"), F.col("name_key")))
    return met.select("brand", "source", "node_no").distinct()


def _length_class(text: Column, threshold: float) -> Column:
    """Lengths further apart than the threshold allows are more than one class apart."""
    apart = (2 - threshold) / threshold * 1.01
    return F.floor(F.log(F.greatest(F.length(text), F.lit(1))) / float(np.log(apart))).cast("int")


class _Pack:
    """Base names side by side: lengths, hashed numbered letters, and characters by small numbers."""

    def __init__(self, texts: list[str], alphabet: dict[str, int]):
        self.texts = texts
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.bits = np.zeros((_LETTER_BITS, len(texts)), _U)
        for k, text in enumerate(texts):
            seen: dict[str, int] = {}
            for c in text:
                seen[c] = seen.get(c, 0) + 1
                bit = hash((ord(c), seen[c])) % (64 * _LETTER_BITS)
                self.bits[bit >> 6, k] |= _U(1) << _U(bit & 63)
        self.width = int(self.sizes.max(initial=0))
        self.codes = np.zeros((len(texts), self.width), np.int32)
        for k, text in enumerate(texts):
            self.codes[k, : len(text)] = [alphabet.setdefault(c, len(alphabet) + 1) for c in text]

    def in_common(self, text: str, at: np.ndarray, alphabet: dict[str, int]) -> np.ndarray:
        """Length of the longest common subsequence of `text` (at most 64 characters) with each name of `at`."""
        where = np.zeros(len(alphabet) + 1, _U)
        for i, c in enumerate(text):
            where[alphabet[c]] |= _U(1) << _U(i)
        rest = np.full(len(at), ~_U(0))
        for column in self.codes[at].T:
            hit = rest & where[column]
            rest = (rest + hit) | (rest - hit)
        return np.bitwise_count(~rest & _U((1 << len(text)) - 1)).astype(np.int64)


def _close(sources: list[str], targets: list[str], threshold: float) -> Iterator[tuple[str, str]]:
    """Pairs whose match ratio reaches the threshold."""
    alphabet: dict[str, int] = {}
    own, other = _Pack(sources, alphabet), _Pack(targets, alphabet)
    for k, text in enumerate(sources):
        need = threshold * (len(text) + other.sizes) / 2 - 1e-9
        absent = np.bitwise_count(own.bits[:, k : k + 1] & ~other.bits).sum(axis=0, dtype=np.int64)
        foreign = np.bitwise_count(other.bits & ~own.bits[:, k : k + 1]).sum(axis=0, dtype=np.int64)
        at = np.flatnonzero(np.minimum(len(text) - absent, other.sizes - foreign) >= need)
        if len(at) and len(text) <= 64:
            at = at[other.in_common(text, at, alphabet) >= need[at]]
        for j in at.tolist():
            if ratio_reaches(text, targets[j], threshold):
                yield text, targets[j]


def ratio_matches(sources: DataFrame, targets: DataFrame, threshold: float, pack: int = PACK) -> DataFrame:
    """(brand, source, target): distinct `sources` (brand, source) and `targets` (brand, target) of one brand
    whose match ratio, in this order, reaches the threshold."""
    dealt = targets.withColumn("class", _length_class(F.col("target"), threshold))
    packs = dealt.groupBy("brand", "class").agg(F.ceil(F.count("*") / pack).cast("int").alias("packs"))
    placed = dealt.join(packs, ["brand", "class"]).withColumn("pack", F.pmod(F.xxhash64("target"), F.col("packs")).cast("int"))
    right = placed.groupBy("brand", "class", "pack").agg(F.collect_list("target").alias("targets"))
    near = F.array(*[_length_class(F.col("source"), threshold) + k for k in (-1, 0, 1)])
    wanted = sources.select("brand", "source", F.explode(near).alias("class"))
    own = wanted.groupBy("brand", "class").agg(F.ceil(F.count("*") / pack).cast("int").alias("own"))
    left = wanted.join(own, ["brand", "class"]).withColumn("own", F.pmod(F.xxhash64("source"), F.col("own")))
    left = left.groupBy("brand", "class", "own").agg(F.collect_list("source").alias("sources"))
    # each pack of targets is a key of its own, and meets the packs of sources one after the other
    left = left.join(packs, ["brand", "class"]).select("brand", "class", "sources", F.explode(F.sequence(F.lit(0), F.col("packs") - 1)).alias("pack"))
    both = left.join(right, ["brand", "class", "pack"]).select("brand", "sources", "targets")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for brand, a, b in zip(*[batch.column(i) for i in range(3)], strict=True):
                rows = [(brand.as_py(), *pair) for pair in _close(a.as_py(), b.as_py(), threshold)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], names=["brand", "source", "target"])

    return both.mapInArrow(run, "brand string, source string, target string")


def first_names(nodes: DataFrame, count: int, few: int) -> DataFrame:
    """The first `count` names of each brand; more than `few` are told without bringing a brand into one task."""
    if count > few:
        return rank_in_key(nodes, ["brand"], "node_no", "_n").where(F.col("_n") <= count).drop("_n")
    in_order = Window.partitionBy("brand").orderBy("node_no")
    return nodes.withColumn("_n", F.row_number().over(in_order)).where(F.col("_n") <= count).drop("_n")
