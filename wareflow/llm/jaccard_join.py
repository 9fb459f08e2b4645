"""N-gram Jaccard join: an exact metric-space join of shingle sets, by pivots, regions and windows.

1. Equal sets form one class; its smallest id stands for it.
2. Regions. Two unrelated documents share no shingle, so their distance to every document is 1 and plain
   document pivots would leave one region of nearly everything. Pivots are therefore taken where a
   close pair must meet: the universe of shingles is cut by hash into more parts than a pair at the
   limit can differ in, so a pair within the radius agrees in one whole part that is not empty. All
   documents that agree in a part form a region; its pivot is the smallest id. The size classes and the
   ladder of finer cuts below make this hold for every pair, whatever its sizes.
3. The distance of every member to its pivot is computed. Members within the radius are linked to it.
   Regions whose members are now all in one component are done: this is how large groups of copies
   end, after one comparison for each copy.
4. The others are split again, by set size. By the triangle inequality two members x, y of the region of
   p can only link if |d(x,p) - d(y,p)| <= radius, and only if no more bits of their parity sketches
   differ than shingles may (an exact lower bound of the distance). The pairs that are left, all of
   different components, are compared in full; there are few that do not link.

Links are followed by large-star and small-star steps. No pair of equal sets and no pair inside a
finished region is ever made, and no step needs the members of a region in one task.

Defined cases: a text without words, or a null text, has an empty set and links with nothing; rows with
the same id count as one document when links are followed; a row with a null id has a null component
and links with nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wareflow.llm.arrays import FOLDED, WORD_BASE, find_words, map_columns, mix, packed_texts, quoted, range_hashes, set_aside, slices, text_chunks, unpacked
from wareflow.llm.url_filter import MAX_BLOCKS, passing
from wareflow.operators.shared import drop_tables, shared_folder, stored

GROWTH = 1.6
# signatures in one batch of rows, and those among which a worker sends each only once
ROWS, RUN = 50_000, 400_000
# shingles, and so signatures at most about, that one task counts
PER_TASK = 500_000
# tables that `link_documents` writes on its way
WORK = ["classes", "signatures", "regions", "texts", "distances", "links", "members", "open", "sketches", "split", "pairs", "found"]
_U = np.uint64


def shingle_sets(texts: pa.Array, length: int) -> Iterator[np.ndarray]:
    """The sorted hashes of each text's distinct shingles."""
    for lo, hi, data, offsets in text_chunks(texts):
        words = find_words(data, offsets, FOLDED)
        at, hashes = words.windows(length)
        edges = np.searchsorted(at, words.first)
        short = np.flatnonzero((words.counts > 0) & (words.counts < length))
        whole = dict(zip(short.tolist(), range_hashes(words.hashes, words.first[short], words.first[short + 1], WORD_BASE), strict=True))
        for k in range(hi - lo):
            yield np.array([whole[k]], np.uint64) if k in whole else np.unique(hashes[edges[k] : edges[k + 1]])


class Cuts:
    """How the universe of shingles is cut for sets of each size."""

    def __init__(self, similar: int):
        if not 65 <= similar <= 100:
            raise ValueError("a similarity of 65 to 100 percent")
        self.similar = similar
        # the smallest set of a class must have more shingles than a pair can differ in
        s = min(similar, 99) / 100
        growth = min(GROWTH, s * (1 + s) / (2 * (1 - s)) / 1.2)
        self.tops = [1]
        while self.tops[-1] < 1 << 40:
            self.tops.append(max(self.tops[-1] + 1, int(self.tops[-1] * growth)))

    def most_apart(self, size_class: int) -> int:
        """Shingles in which a pair of the class can differ at most."""
        return 2 * self.tops[size_class] * (100 - self.similar) // (100 + self.similar)

    def classes(self, n: int) -> list[int]:
        """Size classes in which a set of `n` shingles can meet another; none where only equal sets link."""
        lowest = int(np.searchsorted(self.tops, n))
        highest = int(np.searchsorted(self.tops, n * 100 // self.similar))
        return [c for c in range(lowest, highest + 1) if self.most_apart(c)] if n else []

    def signatures(self, shingles: np.ndarray) -> np.ndarray:
        """One hash for each part that is not empty.

        A pair meets in the size class of its larger set, so a set also uses the class of the largest
        set it can link with. There, a pair differs in at most k shingles. If one of the two has more
        than k parts that are not empty, one of these is equal in both; each set uses every cut up to
        the first for which it has.
        """
        out, spread = [], mix(shingles)
        for size_class in self.classes(len(shingles)):
            k = self.most_apart(size_class)
            parts, level = k + 1 + (k + 7) // 8, 0
            while True:
                part = ((shingles >> _U(32)) * _U(parts)) >> _U(32)
                first = np.flatnonzero(np.diff(part, prepend=_U((1 << 64) - 1)))
                salt = mix(part[first] + _U(size_class << 40) + _U(level << 56))
                out.append(mix(np.add.reduceat(spread, first) + salt))
                if len(first) > k:
                    break
                parts, level = parts * 2, level + 1
        return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _set_keys(docs: DataFrame, length: int) -> DataFrame:
    """(id, n, k1, k2) for every row: the size of its set, and two hashes of the set."""

    def run(texts: pa.Array) -> list:
        n, k1, k2 = [], [], []
        for s in shingle_sets(texts, length):
            n.append(len(s))
            k1.append(int(mix(s).sum(dtype=np.uint64).astype(np.int64)))
            k2.append(int(mix(s ^ _U(0xD1B54A32D192ED03)).sum(dtype=np.uint64).astype(np.int64)))
        return [n, k1, k2]

    return map_columns(docs, run, ["text"], ["id"], "n bigint, k1 bigint, k2 bigint")


def _signatures(docs: DataFrame, length: int, similar: int, once: bool = False) -> DataFrame:
    """(signature, id) of every document; with `once`, (signature, low, high): each signature once for a run of documents."""
    cuts = Cuts(similar)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in slices(batches, 2):
            for number, s in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1), length), strict=True):
                if len(s):
                    got = cuts.signatures(s)
                    held.append((number, got))
                    size += len(got)
                if size > (RUN if once else ROWS):
                    yield from _rows(held)
                    held, size = [], 0
        if held:
            yield from _rows(held)

    def _rows(held: list) -> Iterator[pa.RecordBatch]:
        ids = np.repeat([n for n, _ in held], [len(s) for _, s in held]).astype(np.int64)
        flat = np.concatenate([s for _, s in held]).view(np.int64)
        if not len(flat):
            return
        columns, names = [flat, ids], ["signature", "id"]
        if once:
            order = np.argsort(flat)
            flat, ids = flat[order], ids[order]
            first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
            columns, names = [flat[first], np.minimum.reduceat(ids, first), np.maximum.reduceat(ids, first)], ["signature", "low", "high"]
        for lo in range(0, len(columns[0]), ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(c[lo : lo + ROWS]) for c in columns], names=names)

    kind = "signature bigint, low bigint, high bigint" if once else "signature bigint, id bigint"
    return docs.where("id IS NOT NULL").mapInArrow(run, kind)


def _regions(docs: DataFrame, classes: DataFrame, length: int, similar: int, folder: str) -> DataFrame:
    """(x, pivot): members of regions, classes in place of documents.

    Few signatures are shared, so adding them up in the map tasks would only fill their memory: they are
    dealt out as they come, to so many tasks that each has about as many whatever the input.
    """
    tasks = -(-(classes.agg(F.sum("n")).first()[0] or 1) // PER_TASK)
    ranges = _signatures(docs, length, similar, once=True).repartition(tasks, "signature")
    shared = ranges.groupBy("signature").agg(F.min("low").alias("pivot"), F.max("high").alias("other")).where("pivot < other")
    shared = stored(shared.select("signature", "pivot"), folder, "signatures")
    met = _signatures(docs, length, similar).join(shared, "signature").where("id <> pivot").select("id", "pivot").distinct()
    named = classes.select("id", "rep")
    met = met.join(named, "id").select(F.col("rep").alias("x"), "pivot")
    met = met.join(named.withColumnsRenamed({"id": "pivot", "rep": "p"}), "pivot").where("x <> p").select("x", F.col("p").alias("pivot")).distinct()
    return stored(met, folder, "regions")


def _overlaps(pairs: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """`pairs` (x, pivot, ...) with both (shared shingles) and either (shingles of the union)."""

    def run(a: pa.Array, b: pa.Array) -> list:
        both, either = [], []
        for s, t in zip(shingle_sets(unpacked(a), length), shingle_sets(unpacked(b), length), strict=True):
            n = len(np.intersect1d(s, t, assume_unique=True))
            both.append(n)
            either.append(len(s) + len(t) - n)
        return [both, either]

    left = texts.withColumnsRenamed({"id": "x", "packed": "text_x"})
    right = texts.withColumnsRenamed({"id": "pivot", "packed": "text_p"})
    joined = pairs.join(left, "x").join(right, "pivot")
    return map_columns(joined, run, ["text_x", "text_p"], pairs.columns, "both bigint, either bigint")


def components(links: DataFrame, folder: str) -> DataFrame:
    """(node, component): every node of `links` (a, b) with the smallest node reachable from it."""
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges = stored(edges, folder, "edges-0")
    turn = 0
    while True:
        # large star: larger neighbours of u go to the smallest of u's neighbourhood
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.bitwise_not("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.where("b > a").select(F.bitwise_not("a").alias("u"), "b").join(least, "u").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: u and its smaller neighbours go to the smallest of them
        lower = large.groupBy("a").agg(F.min("b").alias("m")).select(F.bitwise_not("a").alias("u"), "m")
        small = large.select(F.bitwise_not("a").alias("u"), "b").join(lower, "u")
        moved = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(lower.select(F.bitwise_not("u").alias("a"), F.col("m").alias("b")))
        turn += 1
        edges = stored(moved.where("a <> b").distinct(), folder, f"edges-{turn}")
        # done when every node has one edge, and none that is pointed at points on
        below = edges.groupBy(F.bitwise_not("a").alias("u")).agg(F.count("*").alias("n"))
        pointed = edges.select(F.bitwise_not("b").alias("u")).distinct().withColumn("hit", F.lit(True))
        if below.join(pointed, "u", "left").where("n > 1 OR hit").isEmpty():
            break
    return edges.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")


def _labelled(rows: DataFrame, labels: DataFrame, column: str, name: str) -> DataFrame:
    named = labels.withColumnsRenamed({"node": column, "component": name})
    return rows.join(named, column, "left").withColumn(name, F.coalesce(name, column))


def _close(similar: int):
    return F.col("both") * 100 >= F.lit(similar) * F.col("either")


def _sketches(texts: DataFrame, length: int, similar: int) -> DataFrame:
    """(id, n, size_class, parity): for each size class of a set, the parities of its counts per hash bucket.

    Every shingle by which two sets differ flips one bit, so the bits that differ are at most the
    shingles that do. There are about as many bits as shingles in the largest set of the class.
    """
    cuts = Cuts(similar)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            rows: list[tuple] = []
            for number, s in zip(batch.column(0).to_pylist(), shingle_sets(unpacked(batch.column(1)), length), strict=True):
                for size_class in cuts.classes(len(s)):
                    bits = max(6, (cuts.tops[size_class] - 1).bit_length())
                    odd = np.bincount((s >> _U(64 - bits)).astype(np.int64), minlength=1 << bits) & 1
                    rows.append((number, len(s), size_class, np.packbits(odd.astype(np.uint8)).view(np.int64)))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()))
                columns = [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "size_class", "parity"])

    return texts.select("id", "packed").mapInArrow(run, "id bigint, n bigint, size_class int, parity array<bigint>")


def _split_regions(regions: DataFrame, texts: DataFrame, links: DataFrame, labels: DataFrame, length: int, similar: int, folder: str) -> DataFrame:
    """Follows the links between members of one region that are in different components so far; returns the new labels."""
    far = F.lit(1) - F.col("both") / F.col("either")
    pivots = regions.select("pivot").distinct().select(F.col("pivot").alias("x"), "pivot", F.lit(0.0).alias("far"))
    members = _labelled(regions.select("x", "pivot", far.alias("far")).unionByName(pivots), labels, "x", "component")
    members = stored(members, folder, "members")
    unfinished = members.groupBy("pivot").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    unfinished = stored(unfinished.select("pivot"), folder, "open")
    if unfinished.isEmpty():
        return labels
    sketches = stored(_sketches(texts, length, similar), folder, "sketches").withColumnRenamed("id", "x")
    rows = members.join(unfinished, "pivot", "left_semi").join(sketches, "x")
    rows = stored(rows.select("pivot", "size_class", "x", "n", "parity", "far", "component"), folder, "split")
    other = rows.select("pivot", "size_class", *[F.col(c).alias(f"{c}_y") for c in ("x", "n", "parity", "far", "component")])
    bits = F.aggregate(F.zip_with("parity", "parity_y", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda total, k: total + k)
    possible = (
        (F.col("x") < F.col("x_y"))
        & (F.col("component") != F.col("component_y"))
        & (F.least("n", "n_y") * 100 >= F.lit(similar) * F.greatest("n", "n_y"))
        & (F.abs(F.col("far") - F.col("far_y")) <= 1 - similar / 100 + 1e-9)
        & (bits * (100 + similar) <= (F.col("n") + F.col("n_y")) * (100 - similar))
    )
    pairs = rows.join(other, ["pivot", "size_class"]).where(possible)
    pairs = stored(pairs.select("x", F.col("x_y").alias("pivot")).distinct(), folder, "pairs")
    if pairs.isEmpty():
        return labels
    found = _overlaps(pairs, texts, length).where(_close(similar)).select(F.col("x").alias("a"), F.col("pivot").alias("b"))
    found = stored(found, folder, "found")
    if found.isEmpty():
        return labels
    return stored(components(links.unionByName(found), f"{folder}/second"), folder, "labels-2")


def link_documents(docs: DataFrame, shingle: int = 4, similar: int = 85, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles and component_id (the smallest id reachable by links).

    Two documents link when 100 * shared shingles >= `similar` * shingles of the union; `similar` is 65 to 100.
    """
    folder = shared_folder(docs.sparkSession)
    named = docs.select(F.col(quoted(doc_id)).cast("bigint").alias("id"), F.col(quoted(text)).alias("text"))
    keys = stored(_set_keys(named, shingle), folder, "keys")
    reps = keys.where("n > 0 AND id IS NOT NULL").groupBy("k1", "k2").agg(F.min("id").alias("rep"))
    turned = reps.select(F.bitwise_not("k1").alias("t1"), F.bitwise_not("k2").alias("t2"), "rep")
    rows = keys.withColumns({"t1": F.bitwise_not("k1"), "t2": F.bitwise_not("k2")}).where("n > 0 AND id IS NOT NULL")
    classes = stored(rows.join(turned, ["t1", "t2"]).select("id", "n", "rep"), folder, "classes")

    regions = _regions(named, classes, shingle, similar, folder)
    needed = regions.select("x").unionByName(regions.select(F.col("pivot").alias("x"))).distinct().withColumnRenamed("x", "id")
    # most other texts are told by a Bloom filter of bounded size before they are shuffled
    likely = passing(named.withColumn("key", F.xxhash64("id")), needed.select(F.xxhash64("id").alias("key")), MAX_BLOCKS)
    packed = packed_texts(likely, "text", ["id"])
    texts = stored(packed.join(needed, "id", "left_semi").dropDuplicates(["id"]), folder, "texts")
    regions = stored(_overlaps(regions, texts, shingle), folder, "distances")
    # rows of one id and equal sets are one document each
    links = regions.where(_close(similar)).select(F.col("x").alias("a"), F.col("pivot").alias("b"))
    links = stored(links.unionByName(classes.where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b")).distinct()), folder, "links")
    labels = stored(components(links, f"{folder}/first"), folder, "labels")
    labels = _split_regions(regions, texts, links, labels, shingle, similar, folder)
    # all that is read from here on are the keys and the labels
    drop_tables(docs.sparkSession, folder, [*WORK, "first", "second"])
    joined = _labelled(keys, labels, "id", "component_id")
    return joined.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")


def keep_one_of_each(docs: DataFrame, shingle: int = 5, similar: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` without near copies: of each component the rows of the smallest id stay, and all rows with a null id."""
    given, names = set_aside(docs)
    linked = link_documents(given, shingle, similar, names[doc_id], names[text])
    others = linked.where("doc_id <> component_id").select(F.col("doc_id").alias("_other")).distinct()
    return given.join(others, F.col(names[doc_id]) == F.col("_other"), "left_anti").toDF(*docs.columns)
