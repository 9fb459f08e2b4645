"""Document fingerprints: Merkle trees over sentences, paragraphs and sections.

Leaves are the sentences of a paragraph (line), each with its end marks (of Latin, Chinese, Arabic, Hindi
and other scripts) and the blanks after it. What is longer than `LEAF` characters is cut further, after
characters chosen by a hash of the last `WINDOW` ones and after `LEAF` at the latest, so every text has
leaves in proportion to its length, and cuts meet again soon after an edit. A
paragraph hashes its leaves, a section its paragraphs, the root its sections. A section ends after a
paragraph whose hash ends in two zero bits, so an edit moves no border of a later section. Hashes are
BLAKE2b of 16 bytes, of 8 for leaves. Equal texts have equal roots; where roots differ, walking down
the differing branches locates the edits. The likeness of two trees is the share of leaves they have in
common, found by that walk: 2 * common / (leaves of both), 1 for equal roots.

Defined cases: a null or empty text has a tree without leaves, whose root is the hash of nothing; two
such trees are alike (1), one such tree and another are not (0).
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wareflow.llm.arrays import map_columns, quoted

# Characters that end a sentence
MARKS = ".!?…‼‽⁇⁈⁉。．｡！？؟۔܀܁܂।॥։።፧፨။។៕᠃᠉꓿𑁇𑁈"
_SENTENCE = re.compile(rf"[^{MARKS}\n]*[{MARKS}]+[^\S\n]*|[^{MARKS}\n]+")
LEAF, LEAST, WINDOW = 32, 8, 4  # characters: longest leaf, shortest one before a chosen cut, those that choose a cut
_FACTORS = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F], np.uint32)


def _chosen_cuts(text: str) -> list[int]:
    """Positions after the characters where a leaf may end: one in eight, told by the last `WINDOW` ones."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(codes) - WINDOW + 1
    h = np.zeros(n, np.uint32)
    for i, factor in enumerate(_FACTORS):
        h += codes[i : n + i] * factor
    h = (h ^ (h >> np.uint32(15))) * _FACTORS[1]
    return (np.flatnonzero(h >> np.uint32(29) == 0) + WINDOW).tolist()


def _leaves(text: str) -> Iterator[list[bytes]]:
    """The hashes of the leaves of each line."""
    start, cuts = 0, None
    for line in text.split("\n"):
        hashes = []
        for m in _SENTENCE.finditer(line):
            at, end = m.span()
            if end - at > LEAF:
                if cuts is None:
                    cuts = _chosen_cuts(text)
                k = bisect_left(cuts, start + at + LEAST)
                while end - at > LEAF:
                    k = bisect_left(cuts, start + at + LEAST, k)
                    to = min(at + LEAF, cuts[k] - start) if k < len(cuts) else at + LEAF
                    hashes.append(blake2b(line[at:to].encode(), digest_size=8).digest())
                    at = to
            hashes.append(blake2b(line[at:end].encode(), digest_size=8).digest())
        yield hashes
        start += len(line) + 1


class Tree:
    """root; sections as (hash, [(paragraph hash, [leaf hashes])])."""

    __slots__ = ("root", "sections", "leaves")

    def __init__(self, text: str):
        self.sections: list[tuple[bytes, list[tuple[bytes, list[bytes]]]]] = []
        self.leaves = 0
        top, section = blake2b(digest_size=16), []
        for leaves in _leaves(text) if text else []:
            paragraph = blake2b(b"".join(leaves), digest_size=16).digest()
            section.append((paragraph, leaves))
            self.leaves += len(leaves)
            if paragraph[-1] & 3 == 0:
                self._close(section, top)
                section = []
        if section:
            self._close(section, top)
        self.root = top.hexdigest()

    def _close(self, section: list, top) -> None:
        name = blake2b(b"".join(p for p, _ in section), digest_size=16).digest()
        self.sections.append((name, section))
        top.update(name)


def likeness(a: Tree, b: Tree) -> float:
    """Share of common leaves; equal branches are not entered."""
    if a.root == b.root:
        return 1.0
    if not a.leaves or not b.leaves:
        return 0.0
    common = _common_leaves([(h, s) for h, s in a.sections], [(h, s) for h, s in b.sections], 2)
    return 2 * common / (a.leaves + b.leaves)


def _size(branch, depth: int) -> int:
    return 1 if depth == 0 else len(branch) if depth == 1 else sum(len(x) for _, x in branch)


def _common_leaves(a: list, b: list, depth: int) -> int:
    """Common leaves of two lists of (hash, branch); equal hashes first, then what is left a level lower."""
    if depth == 0:
        return sum((Counter(a) & Counter(b)).values())
    left = Counter(h for h, _ in b)
    shared: Counter = Counter()
    total, rest_a, rest_b = 0, [], []
    for h, branch in a:
        if shared[h] < left[h]:
            shared[h] += 1
            total += _size(branch, depth)
        else:
            rest_a += branch
    for h, branch in b:
        if shared[h] > 0:
            shared[h] -= 1
        else:
            rest_b += branch
    return total + (_common_leaves(rest_a, rest_b, depth - 1) if rest_a and rest_b else 0)


def edits(a: Tree, b: Tree) -> list[int]:
    """Numbers of the paragraphs of `b` that `a` does not have, found by walking down differing branches."""
    known_sections = {h for h, _ in a.sections}
    known = {p for h, s in a.sections for p, _ in s}
    out, at = [], 0
    for name, section in b.sections:
        if name not in known_sections:
            out += [at + i for i, (p, _) in enumerate(section) if p not in known]
        at += len(section)
    return out


def fingerprint(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with root (hex) and sections: the hashes of each section and its paragraphs."""

    def run(texts: pa.Array) -> list:
        trees = [Tree(t or "") for t in texts.to_pylist()]
        return [[t.root for t in trees], [[{"hash": h.hex(), "paragraphs": [p.hex() for p, _ in s]} for h, s in t.sections] for t in trees]]

    return map_columns(docs, run, [text], docs.columns, "root string, sections array<struct<hash:string,paragraphs:array<string>>>")


def spliced(text: str, following: str) -> str:
    """The last third of a text replaced by as much of the beginning of another one."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


PART_BYTES, MAX_PARTS, STEP = 4 << 20, 4096, 64


def _with_next(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Parts of the documents in descending order of id, each with the first row of the part after it.

    Columns part, tail (true for that extra row), id, body; rows of one id are ordered by their text.
    Borders of the parts are quantiles of the ids; only one row per part (at most `MAX_PARTS`) is looked
    up elsewhere.
    """
    named = docs.select(F.col(quoted(doc_id)).alias("id"), F.coalesce(F.col(quoted(text)), F.lit("")).alias("body"))
    total = named.agg(F.sum(F.octet_length("body")).alias("bytes"), F.max("id").alias("top")).first()
    parts = min(MAX_PARTS, max(1, math.ceil((total["bytes"] or 0) / PART_BYTES)))
    cuts = named.approxQuantile("id", [i / parts for i in range(1, parts)], 0.1 / parts) if parts > 1 and total["top"] is not None else []
    cuts = sorted({int(c) for c in cuts}, reverse=True)
    # part = number of cuts above the id, so ids fall from part to part; null ids come last
    above = lambda borders: F.size(F.filter(borders, lambda c: c > F.col("id")))
    if cuts:
        # among every STEP-th cut first, then among the cuts of that step
        base = F.greatest(above(F.lit(cuts[::STEP]).cast("array<bigint>")) - 1, F.lit(0)) * STEP
        part = base + above(F.slice(F.lit(cuts).cast("array<bigint>"), base + 1, STEP))
    else:
        part = F.lit(0)
    cut = named.withColumn("part", F.when(F.col("id").isNull(), len(cuts) + 1).otherwise(part).cast("int"))
    order = F.struct(F.col("id").isNotNull(), F.col("id"), F.xxhash64("body"))
    heads = {r["part"]: (r["h"][1], r["h"][2]) for r in cut.groupBy("part").agg(F.max(order).alias("h")).collect()}
    present = sorted(heads)
    if not present:
        return cut.withColumn("tail", F.lit(False))
    after = {p: heads[present[(i + 1) % len(present)]] for i, p in enumerate(present)}
    # the first row of a part once more, as the last row of the part before (the very first one after the very last)
    wanted = docs.sparkSession.createDataFrame([(p, *v) for p, v in after.items()], "to_part int, head_id bigint, head_hash bigint")
    tails = cut.join(F.broadcast(wanted), cut["id"].eqNullSafe(F.col("head_id")) & (F.xxhash64("body") == F.col("head_hash")))
    tails = tails.select(F.col("to_part").alias("part"), "id", "body").dropDuplicates(["part"])
    return cut.select("part", "id", "body", F.lit(False).alias("tail")).unionByName(tails.withColumn("tail", F.lit(True)))


def compare_with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """For every row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one with the next smaller id (after the last, the first); rows of one id
    stand side by side, in the order of a hash of their text. The edited text is `spliced` from both.
    """
    placed = _with_next(docs, doc_id, text)
    n = max(1, placed.select("part").distinct().count())
    sorted_parts = placed.repartitionByRange(n, "part").sortWithinPartitions("part", "tail", F.desc_nulls_last("id"), F.desc(F.xxhash64("body"))).select("part", "tail", "id", "body")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def pack(done: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, done = None, []
        for part, tail, number, body in rows(batches):
            tree = Tree(body)
            if held is not None and held[0] == part:
                _, before, old, old_tree = held
                edited = spliced(old, body)
                edited_tree = old_tree if edited == old else Tree(edited)
                done.append((before, len(old), sha256(edited.encode()).hexdigest(), old_tree.root, edited_tree.root, likeness(old_tree, edited_tree), likeness(old_tree, tree)))
                if len(done) == 2000:
                    yield pack(done)
                    done = []
            held = None if tail else (part, number, body, tree)
        if done:
            yield pack(done)

    return sorted_parts.mapInArrow(run, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
