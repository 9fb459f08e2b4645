"""Benchmark decontamination: hash sets of benchmark word windows, scanned over every training text.

Words are runs of letters and digits after A-Z are lower-cased (every non-ASCII character counts as a
letter). A window is `n` consecutive words of a benchmark item; an item with fewer words, but not
none, is one window. The window hashes are broadcast in blocks of at most `block` windows, a bound
that does not depend on the size of the benchmark: with a larger benchmark the scan only gets more
steps within the same stage. A hash hit counts after its words were compared one by one.

Defined cases: a null or empty text has no words and no hits; an item without words has no window;
an item whose id is null counts as the id ''; items that share an id count as one; repeated rows each
get their own result; an empty benchmark leaves every document clean. Columns of the input that have
the name of an added column are replaced.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wareflow.llm.arrays import Alphabet, Words, find_words, map_columns, quoted, set_aside, text_chunks

LETTERS = Alphabet([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)], fold_case=True)
BLOCK = 1_000_000
_BITS = 20


def _normal(data: np.ndarray, words: Words, first: int, length: int) -> bytes:
    """The folded words first .. first+length-1, joined by one space."""
    return b" ".join(data[words.starts[i] : words.ends[i]].tobytes() for i in range(first, first + length))


def item_windows(benchmark: DataFrame, n: int, item_id: str, text: str) -> DataFrame:
    """(item, length, hash, words) of every distinct window of every item."""

    def windows(texts: pa.Array) -> list:
        out: list[list] = []
        for lo, hi, data, offsets in text_chunks(texts):
            words, folded = find_words(data, offsets, LETTERS), LETTERS.folded[data]
            for row in range(hi - lo):
                a, b = words.first[row], words.first[row + 1]
                length = min(n, b - a)
                part = Words(words.starts[a:b], words.ends[a:b], np.array([0, b - a]), words.hashes[a:b])
                at, hashes = part.windows(int(length)) if length else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
                out.append([{"length": int(length), "hash": int(h), "words": _normal(folded, part, int(i), int(length))} for i, h in zip(at, hashes.view(np.int64), strict=True)])
        return [out]

    named = benchmark.select(F.coalesce(F.col(quoted(item_id)).cast("string"), F.lit("")).alias("item"), F.col(quoted(text)).alias("text"))
    rows = map_columns(named, windows, ["text"], ["item"], "windows array<struct<length:int,hash:bigint,words:binary>>")
    return rows.select("item", F.explode("windows").alias("w")).select("item", "w.*").distinct()


class _Table:
    """Windows of one block, sorted by hash, with a bit table that tells most strangers at once."""

    def __init__(self, rows: list):
        rows = sorted(rows, key=lambda r: r["hash"] % (1 << 64))
        self.hashes = np.array([r["hash"] for r in rows], np.int64).view(np.uint64)
        self.words = [bytes(r["words"]) for r in rows]
        self.items = [r["item"] for r in rows]
        self.lengths = np.array([r["length"] for r in rows], np.int32)
        self.bits = {int(m): self._bits(self.hashes[self.lengths == m]) for m in np.unique(self.lengths)}

    @staticmethod
    def _bits(hashes: np.ndarray) -> np.ndarray:
        bits = np.zeros(1 << _BITS, bool)
        bits[hashes >> np.uint64(64 - _BITS)] = True
        return bits

    def found(self, data: np.ndarray, words: Words) -> list[tuple[int, int, str]]:
        """(first word, length, item) of every occurrence, words compared."""
        hits = []
        for length, bits in self.bits.items():
            at, hashes = words.windows(length)
            near = np.flatnonzero(bits[hashes >> np.uint64(64 - _BITS)])
            at, hashes = at[near], hashes[near]
            lo, hi = np.searchsorted(self.hashes, hashes, "left"), np.searchsorted(self.hashes, hashes, "right")
            folded = LETTERS.folded[data] if (hi > lo).any() else data
            for i in np.flatnonzero(hi > lo):
                own = _normal(folded, words, int(at[i]), length)
                hits += [(int(at[i]), length, self.items[k]) for k in range(lo[i], hi[i]) if self.lengths[k] == length and self.words[k] == own]
        return hits


def _scan(docs: DataFrame, table, text: str) -> DataFrame:
    """Adds the hits of one block to those found before."""

    def scan(texts: pa.Array, spans_before: pa.Array, items_before: pa.Array) -> list:
        shared, counts, spans, items = table.value, [], [], []
        before = zip(spans_before.to_pylist(), items_before.to_pylist(), strict=True)
        for lo, hi, data, offsets in text_chunks(texts):
            words = find_words(data, offsets, LETTERS)
            counts.append(words.counts)
            own: dict[int, tuple[list, set]] = {}
            hits = shared.found(data, words)
            for (at, length, item), row in zip(hits, words.rows(np.array([h[0] for h in hits], np.int64)), strict=True):
                got = own.setdefault(int(row), ([], set()))
                got[0].append((at - int(words.first[row]), at - int(words.first[row]) + length))
                got[1].add(item)
            for row in range(hi - lo):
                old_spans, old_items = next(before)
                if row in own:
                    spans.append(_merged([(s["first"], s["last"]) for s in old_spans] + own[row][0]))
                    items.append(sorted(own[row][1].union(old_items)))
                else:
                    spans.append(old_spans)
                    items.append(old_items)
        return [np.concatenate([np.zeros(0, np.int64), *counts]), spans, items]

    keeps = [c for c in docs.columns if c not in ("hit_spans", "items", "n_words")]
    return map_columns(docs, scan, [text, "hit_spans", "items"], keeps, "n_words bigint, hit_spans array<struct<first:int,last:int>>, items array<string>")


def _merged(spans: list[tuple[int, int]]) -> list[dict]:
    """Word ranges without overlap; `last` is the word after the range."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [{"first": a, "last": b} for a, b in out]


def find_contamination(docs: DataFrame, benchmark: DataFrame, n: int = 10, text: str = "text", item_id: str = "item_id", item_text: str = "text", block: int = BLOCK) -> DataFrame:
    """`docs` with n_words, hit_spans (word ranges, merged), items (ids as strings, sorted) and n_hit."""
    spark = docs.sparkSession
    windows = item_windows(benchmark, n, item_id, item_text)
    blocks = max(1, math.ceil(windows.count() / block))
    out = docs.withColumns({"hit_spans": F.array().cast("array<struct<first:int,last:int>>"), "items": F.array().cast("array<string>")})
    for k in range(blocks):
        rows = windows.where(F.pmod("hash", F.lit(blocks)) == k).collect()
        out = _scan(out, spark.sparkContext.broadcast(_Table(rows)), text)
    hit = F.aggregate("hit_spans", F.lit(0).cast("bigint"), lambda s, x: s + x["last"] - x["first"])
    return out.withColumn("n_hit", hit)


def cut_spans(docs: DataFrame, text: str = "text", spans: str = "hit_spans") -> DataFrame:
    """`docs` whose text has lost the words of `spans`, each run with what stands between its words."""

    def cut(texts: pa.Array, ranges: pa.Array) -> list:
        out, ranges = [], ranges.to_pylist()
        done = 0
        for lo, hi, data, offsets in text_chunks(texts):
            words = find_words(data, offsets, LETTERS)
            for row in range(hi - lo):
                at, parts, base = int(offsets[row]), [], int(words.first[row])
                for s in ranges[done + row] or []:
                    parts.append(data[at : words.starts[base + s["first"]]].tobytes())
                    at = int(words.ends[base + s["last"] - 1])
                parts.append(data[at : offsets[row + 1]].tobytes())
                out.append(b"".join(parts).decode())
            done += hi - lo
        return [pa.array(out, pa.string())]

    return map_columns(docs, cut, [text, spans], [c for c in docs.columns if c != text], f"{quoted(text)} string").select(*[quoted(c) for c in docs.columns])


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = 10, remove: str = "documents", text: str = "text") -> DataFrame:
    """`docs` without contaminated documents, or without their contaminated spans (remove='spans')."""
    plain, names = set_aside(docs)
    found = find_contamination(plain, benchmark, n, names[text])
    clean = found.where("n_hit = 0") if remove == "documents" else cut_spans(found, names[text])
    return clean.select(*[F.col(n).alias(c) for c, n in names.items()])
