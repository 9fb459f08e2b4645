"""Substring dedup: word windows that also start earlier in the corpus, found by level-wise doubling.

Level 1 looks at windows of half the length. Of these, each full window has one that stands for it: its
smallest hash. Only the half windows that are repeated (counted over the whole corpus) are extended:
level 2 hashes the full windows they stand for, and keeps those that are repeated themselves. A window
of the full length that is repeated survives both levels, so nothing is missed. Longer repeats need no
further level, as their full windows cover the same words.

Long repeats are settled in bulk first: texts are cut at words chosen by content into chunks (about
`CHUNK_WORDS` words, each with the words its last window reaches into). All windows of a chunk that
also starts earlier are repeats, and need no row of their own.

"Earlier" is a smaller id, or an earlier start in the same document. Keys that many documents share
are counted per task before the shuffle, and the joins that follow can be split by Spark.

Defined cases: a null text has no words; fewer words than a window leave a text whole; rows with the
same id are no copies of each other at the same place; a null id comes before all others; extra columns
stay, columns with the name of an added one are replaced.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wareflow.llm.arrays import PLAIN, WORD_BASE, Words, find_words, map_columns, quoted, packed_texts, range_hashes, set_aside, slices, text_chunks, unpacked
from wareflow.operators.shared import shared_folder, stored

CHUNK_WORDS = 64
PLACES = 1023  # places are told apart by their lowest bits, so a window has at most 1,000 words
OTHER_BASE = 0x14057B7EF767814F
_LEAST = -(1 << 63)
_U = np.uint64


class _Windows:
    """Full windows of the texts of a chunk: starts, what stands for them, and the chunk they start in."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int):
        self.words: Words = find_words(data, offsets, PLAIN)
        half = window // 2
        n = len(self.words.hashes)
        last = np.repeat(self.words.first[1:], self.words.counts)
        self.at = np.flatnonzero(np.arange(window, n + window) <= last) if n else np.zeros(0, np.int64)
        self.window = window
        self.small = range_hashes(self.words.hashes, np.arange(max(0, n - half + 1)), np.arange(half, n + 1), WORD_BASE) if n >= half else np.zeros(0, np.uint64)
        self.span = window - half + 1

    def stand_ins(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each full window: the hash that stands for it, and the first and last place it was found at."""
        place = np.arange(len(self.small), dtype=np.uint64) & _U(PLACES)
        high = self.small & ~_U(PLACES)
        low, other = self._sliding_min(high | place), self._sliding_min(high | (_U(PLACES) - place))
        start = self.at.astype(np.uint64)
        first = self.at + (((low & _U(PLACES)) - start) & _U(PLACES)).astype(np.int64)
        second = self.at + ((_U(PLACES) - (other & _U(PLACES)) - start) & _U(PLACES)).astype(np.int64)
        return low & ~_U(PLACES), first, second

    def _sliding_min(self, x: np.ndarray) -> np.ndarray:
        width = 1
        while width * 2 <= self.span:
            x = np.minimum(x[:-width], x[width:])
            width *= 2
        rest = self.span - width
        if rest:
            x = np.minimum(x[:-rest], x[rest:])
        return x[self.at]

    def chunk_starts(self) -> np.ndarray:
        """For each full window: the word its chunk starts with; the cut depends on the words there alone."""
        if not len(self.at):
            return self.at
        cut = self.small[self.at] < _U((1 << 64) // CHUNK_WORDS)
        cut[np.flatnonzero(np.diff(self.words.rows(self.at), prepend=-1))] = True
        where = np.flatnonzero(cut)
        return self.at[where][np.cumsum(cut) - 1]


def _keyed(docs: DataFrame, doc_id: str, text: str, keep: list[str] | None = None) -> DataFrame:
    """(id, mark, text): a null id as the least number; mark tells texts of one id apart."""
    number = F.coalesce(F.col(quoted(doc_id)).cast("bigint"), F.lit(_LEAST))
    return docs.select(number.alias("id"), F.xxhash64(F.col(quoted(text))).bitwiseAND(0xFFFFFF).cast("int").alias("mark"), F.col(quoted(text)).alias("text"), *(keep or []))


def _small_windows(keyed: DataFrame, window: int) -> DataFrame:
    """(small, n): hashes of the half windows that stand for full ones, counted per task slice."""

    def run(batches):
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column(0)):
                hashes, first, second = (w := _Windows(data, offsets, window)).stand_ins()
                if len(hashes):
                    places = np.unique(np.concatenate([first, second]))
                    small, n = np.unique(w.small[places] & ~_U(PLACES), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(small.view(np.int64)), pa.array(n)], names=["small", "n"])

    return keyed.select("text").mapInArrow(run, "small bigint, n bigint")


def _document_windows(keyed: DataFrame, window: int) -> DataFrame:
    """(small, id, mark): the half windows that stand for full ones of each document, once each."""

    def run(batches):
        for batch in slices(batches, 3):
            ids, marks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for lo, _, data, offsets in text_chunks(batch.column(2)):
                w = _Windows(data, offsets, window)
                hashes, _, _ = w.stand_ins()
                row = w.words.rows(w.at)
                # neighbours share their stand-in, so most doubles go here
                new = np.ones(len(hashes), bool)
                new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
                row = row[new] + lo
                yield pa.RecordBatch.from_arrays([pa.array(hashes[new].view(np.int64)), pa.array(ids[row]), pa.array(marks[row])], names=["small", "id", "mark"])

    return keyed.mapInArrow(run, "small bigint, id bigint, mark int")


def _chunks(keyed: DataFrame, window: int) -> DataFrame:
    """(h1, h2, id, mark, start): chunks of every document, with a hash of their words."""

    def run(batches):
        for batch in slices(batches, 3):
            ids, marks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for lo, _, data, offsets in text_chunks(batch.column(2)):
                w = _Windows(data, offsets, window)
                starts, firsts = np.unique(w.chunk_starts(), return_index=True)
                ends = w.at[np.append(firsts[1:], len(w.at))[: len(firsts)] - 1] + window if len(starts) else starts
                row = w.words.rows(starts)
                columns = [range_hashes(w.words.hashes, starts, ends, base).view(np.int64) for base in (WORD_BASE, OTHER_BASE)]
                columns += [ids[row + lo], marks[row + lo], (starts - w.words.first[row]).astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["h1", "h2", "id", "mark", "start"])

    return keyed.mapInArrow(run, "h1 bigint, h2 bigint, id bigint, mark int, start int")


def _later(rows: DataFrame, folder: str | None = None) -> DataFrame:
    """(id, mark, start) of the rows of (h1, h2) that are not the earliest of their key.

    The earliest are counted per task before the shuffle. The join key is spelled another way than the
    grouping key, so both sides are dealt out for the join and Spark can split a hot key.
    """
    first = rows.groupBy("h1", "h2").agg(F.min(F.struct("id", "start")).alias("first"), F.count("*").alias("n")).where("n > 1")
    first = first.select(F.bitwise_not("h1").alias("k1"), F.bitwise_not("h2").alias("k2"), "first")
    if folder:
        first = stored(first, folder, "chunks")
    turned = rows.select(F.bitwise_not("h1").alias("k1"), F.bitwise_not("h2").alias("k2"), "id", "mark", "start")
    later = turned.join(first, ["k1", "k2"]).where((F.col("id") != F.col("first.id")) | (F.col("start") != F.col("first.start")))
    return later.select("id", "mark", "start")


def _candidates(joined: DataFrame, window: int) -> DataFrame:
    """(h1, h2, id, mark, start): full windows whose stand-in is repeated, outside settled chunks."""

    def run(batches):
        for batch in slices(batches, 4):
            ids, marks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for lo, hi, data, offsets in text_chunks(unpacked(batch.column(2))):
                wanted = [batch.column(3)[i].values for i in range(lo, hi)]
                if not any(x is not None and len(x) for x in wanted):
                    continue
                w = _Windows(data, offsets, window)
                hashes, _, _ = w.stand_ins()
                starts = w.chunk_starts()
                edges = np.searchsorted(w.at, w.words.first)
                keep = np.zeros(len(w.at), bool)
                for k, small in enumerate(wanted):
                    if small is not None and len(small):
                        a, b = edges[k], edges[k + 1]
                        keep[a:b] = np.isin(hashes[a:b], small.to_numpy().view(np.uint64))
                        settled = batch.column(4)[lo + k].values
                        if settled is not None and len(settled):
                            keep[a:b] &= ~np.isin(starts[a:b] - w.words.first[k], settled.to_numpy())
                at = w.at[keep]
                row = w.words.rows(at)
                h1 = range_hashes(w.words.hashes, at, at + window, WORD_BASE).view(np.int64)
                h2 = (range_hashes(w.words.hashes, at, at + window, OTHER_BASE) >> _U(32)).astype(np.uint32).view(np.int32)
                columns = [h1, h2, ids[row + lo], marks[row + lo], (at - w.words.first[row]).astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["h1", "h2", "id", "mark", "start"])

    return joined.select("id", "mark", "packed", "small", "settled").mapInArrow(run, "h1 bigint, h2 int, id bigint, mark int, start int")


def _found(keyed: DataFrame, window: int) -> DataFrame:
    """(id, mark, packed text) with settled (starts of chunks) and later (starts of windows) that also start earlier."""
    folder = shared_folder(keyed.sparkSession)
    repeated = _small_windows(keyed, window).groupBy("small").agg(F.sum("n").alias("n")).where("n > 1").select("small")
    repeated = stored(repeated, folder, "small")
    small = _document_windows(keyed, window).join(repeated, "small", "left_semi")
    settled = _later(_chunks(keyed, window), folder)
    settled = stored(settled, folder, "settled")
    none = F.lit(None).cast("int")
    marks = small.select("id", "mark", "small", none.alias("start")).unionByName(settled.withColumn("small", F.lit(None).cast("bigint")))
    marks = marks.groupBy("id", "mark").agg(F.collect_set("small").alias("small"), F.collect_set("start").alias("settled"))
    # both joins with the texts are outer ones on the same columns, so the texts are shuffled once
    texts = packed_texts(keyed, "text", ["id", "mark"])
    candidates = _candidates(texts.join(marks, ["id", "mark"], "left"), window)
    later = _later(candidates)
    spans = later.withColumn("chunk", none).unionByName(settled.select("id", "mark", none.alias("start"), F.col("start").alias("chunk")))
    spans = spans.groupBy("id", "mark").agg(F.collect_set("start").alias("later"), F.collect_set("chunk").alias("settled"))
    return texts.join(spans, ["id", "mark"], "left")


def _removed(w: _Windows, later: list, settled: list) -> np.ndarray:
    """For each word of a chunk of texts: whether a repeated window covers it."""
    starts = w.chunk_starts()
    edges = np.searchsorted(w.at, w.words.first)
    cover = np.zeros(len(w.words.hashes) + 1, np.int64)
    for k, (own, chunks) in enumerate(zip(later, settled, strict=True)):
        base = w.words.first[k]
        if own is not None and len(own):
            at = base + own.to_numpy().astype(np.int64)
            np.add.at(cover, at, 1)
            np.add.at(cover, at + w.window, -1)
        if chunks is not None and len(chunks):
            a, b = edges[k], edges[k + 1]
            at = w.at[a:b][np.isin(starts[a:b] - base, chunks.to_numpy())]
            np.add.at(cover, at, 1)
            np.add.at(cover, at + w.window, -1)
    return np.cumsum(cover)[:-1] > 0


def _apply(docs: DataFrame, window: int, doc_id: str, text: str, cut: bool) -> DataFrame:
    """(id, mark, n_words, n_removed, and kept_sha256 or kept_text) for each row."""

    def run(texts: pa.Array, later: pa.Array, settled: pa.Array) -> list:
        n_words, n_removed, out = [], [], []
        for lo, hi, data, offsets in text_chunks(unpacked(texts)):
            w = _Windows(data, offsets, window)
            gone = _removed(w, [later[i].values for i in range(lo, hi)], [settled[i].values for i in range(lo, hi)])
            totals = np.concatenate([[0], np.cumsum(gone)])
            n_words.append(w.words.counts)
            n_removed.append(totals[w.words.first[1:]] - totals[w.words.first[:-1]])
            raw = data.tobytes()
            for k in range(hi - lo):
                a, b = int(w.words.first[k]), int(w.words.first[k + 1])
                if cut:
                    out.append(_without(raw, w, a, b, gone, int(offsets[k]), int(offsets[k + 1])) if n_removed[-1][k] else raw[offsets[k] : offsets[k + 1]].decode())
                else:
                    kept = np.flatnonzero(~gone[a:b]) + a
                    parts = zip(w.words.starts[kept].tolist(), w.words.ends[kept].tolist(), strict=True)
                    out.append(sha256(b" ".join([raw[s:e] for s, e in parts])).hexdigest())
        return [np.concatenate([np.zeros(0, np.int64), *n_words]), np.concatenate([np.zeros(0, np.int64), *n_removed]), pa.array(out, pa.string())]

    keyed = _keyed(docs, doc_id, text)
    return map_columns(_found(keyed, window), run, ["packed", "later", "settled"], ["id", "mark"], "n_words bigint, n_removed bigint, result string")


def _without(raw: bytes, w: _Windows, a: int, b: int, gone: np.ndarray, lo: int, hi: int) -> str:
    """A text without its removed words and the white space after each of them."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], gone[a:b], [False]]).astype(np.int8)))
    parts, at = [], lo
    for s, e in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        parts.append(raw[at : w.words.starts[a + s]])
        at = int(w.words.starts[a + e]) if a + e < b else hi
    parts.append(raw[at:hi])
    return b"".join(parts).decode()


def repeated_words(docs: DataFrame, window: int = 20, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space)."""
    rows = _apply(docs, window, doc_id, text, cut=False)
    return rows.select(F.when(F.col("id") != _LEAST, F.col("id")).alias("doc_id"), "n_words", "n_removed", F.col("result").alias("kept_sha256"))


def remove_repeats(docs: DataFrame, window: int = 20, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` whose texts have lost every word that a repeated window covers; a text that loses all is dropped.

    A text without a repeat stays as it is, white space included.
    """
    plain, names = set_aside(docs)
    rows = _apply(plain, window, names[doc_id], names[text], cut=True).dropDuplicates(["id", "mark"])
    keyed = _keyed(plain, names[doc_id], names[text], keep=list(names.values())).drop("text")
    kept = keyed.join(rows, ["id", "mark"], "left").where("n_removed = 0 OR n_removed < n_words")
    body = F.when(F.col(names[text]).isNotNull(), F.col("result"))
    return kept.select(*[(body if c == text else F.col(n)).alias(c) for c, n in names.items()])
