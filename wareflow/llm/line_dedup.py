"""Line dedup that can be undone: exact counts of documents per line, and cuckoo filters over the common ones.

A line's key is the line without white space at its ends and with A-Z in lower case. A `LineIndex` holds

- `counts`: for every key (as a 128-bit hash) the exact number of documents that hold it;
- `filters`: the keys are dealt to shards by their hash. Each shard has a cuckoo filter of its common
  keys, those found in at least `least` documents, and the list of its other keys that the filter
  lets through by chance (the shard's exact counts tell them). So for documents of the index, filter
  and list together answer exactly whether a line is common.

`insert` and `delete` add documents to the counts and take them away; only keys that become common, or
stop being so, enter or leave the filters. Deleting what was inserted gives the counts from before. A
shard is a few times `KEYS` keys at most: the number of shards follows the number of keys, and when it
changes, or a filter is too full, filters are made anew from the counts.

`drop_common_lines` reads the documents once. While all filters take at most `FILTER_BYTES` together,
they are broadcast, and texts are not shuffled at all. Beyond that, lines are joined with the exact
counts, and the lines of one document come back together; both ways give the same rows.

Defined cases: a null or empty text is one empty line; a key of fewer than `shortest` code points stays
at any count; a line that stands several times in a document counts once; rows of one id, or with a
null id, are documents of their own. Deleting documents that were never inserted is an error.
Equality of keys rests on 128-bit hashes. Kept columns may have any names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wareflow.llm.arrays import map_columns, mix, quoted, set_aside, slices
from wareflow.operators.shared import shared_folder, stored

SPACE = b" \t\n\x0b\x0c\r"
KEYS = 1 << 16  # keys of a shard when its number of shards was set
FILTER_BYTES = 32 << 20
SLOTS, TURNS, LOAD = 4, 200, 0.8
_U = np.uint64
_COUNTS = "h bigint, g bigint, n bigint"
_FILTERS = "shard int, table binary, known_h array<bigint>, known_g array<bigint>"


def line_keys(text: str, shortest: int) -> list[int]:
    """A 128-bit hash of the key of each line; -1 for keys that always stay."""
    out = []
    for line in text.encode().split(b"\n"):
        key = line.strip(SPACE).lower()
        short = len(key if shortest <= 1 else key.decode()) < shortest
        out.append(-1 if short else xxhash.xxh3_128_intdigest(key))
    return out


def _halves(keys: list[int]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(k.to_bytes(16, "little") for k in keys), np.uint64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _line_counts(docs: DataFrame, text: str, shortest: int) -> DataFrame:
    """(h, g, n): documents per key, added up in each slice of rows before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            held: Counter = Counter()
            for t in batch.column(0).to_pylist():
                held.update(set(line_keys(t or "", shortest)))
            held.pop(-1, None)
            if held:
                h, g = _halves(list(held))
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(g.view(np.int64)), pa.array(list(held.values()), pa.int64())], names=["h", "g", "n"])

    return docs.select(quoted(text)).mapInArrow(run, _COUNTS).groupBy("h", "g").agg(F.sum("n").alias("n"))


class Cuckoo:
    """A cuckoo filter of 16-bit fingerprints, four to a bucket, with insertion and deletion of many keys at once."""

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def of(cls, h: np.ndarray) -> Cuckoo:
        """A filter that holds the keys; as large as they need."""
        buckets = 1 << max(0, int(np.ceil(len(h) / (SLOTS * LOAD))) - 1).bit_length()
        while not (made := cls(np.zeros((buckets, SLOTS), np.uint16))).insert(h):
            buckets *= 2
        return made

    def _places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint, first and second bucket."""
        mark = fingerprints(h)
        first = (h & _U(len(self.table) - 1)).astype(np.int64)
        return mark, first, self._other(first, mark)

    def _other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        return bucket ^ (mix(mark.astype(np.uint64)) & _U(len(self.table) - 1)).astype(np.int64)

    def contains(self, h: np.ndarray) -> np.ndarray:
        mark, first, second = self._places(h)
        return ((self.table[first] == mark[:, None]) | (self.table[second] == mark[:, None])).any(axis=1)

    def insert(self, h: np.ndarray) -> bool:
        """False if some key found no place; the filter is of no use then."""
        mark, at, _ = self._places(h)
        for turn in range(TURNS):
            if not len(at):
                return True
            order = np.argsort(at, kind="stable")
            mark, at = mark[order], at[order]
            nth = np.arange(len(at)) - np.searchsorted(at, at)
            empty = self.table[at] == 0
            free = empty.sum(axis=1)
            # the k-th of those who want a bucket takes its k-th empty slot
            fits = nth < free
            slot = (np.cumsum(empty, axis=1) == (nth + 1)[:, None]).argmax(axis=1)
            self.table[at[fits], slot[fits]] = mark[fits]
            # the first that does not fit takes the place of another; all others try their other bucket
            takes = nth == free
            put_out = self.table[at[takes], turn % SLOTS]
            self.table[at[takes], turn % SLOTS] = mark[takes]
            mark[takes] = put_out
            mark, at = mark[~fits], at[~fits]
            at = self._other(at, mark)
        return not len(at)

    def remove(self, h: np.ndarray) -> None:
        """Takes out keys that were inserted, one fingerprint for each."""
        mark, first, second = self._places(h)
        while len(mark):
            here, there = self.table[first] == mark[:, None], self.table[second] == mark[:, None]
            bucket = np.where(here.any(axis=1), first, second)
            slot = np.where(here.any(axis=1), here.argmax(axis=1), there.argmax(axis=1))
            if not (here | there).any(axis=1).all():
                raise ValueError("a key to be removed is not in the filter")
            # keys of the same fingerprint may want one slot; they go one after the other
            _, one = np.unique(bucket * SLOTS + slot, return_index=True)
            self.table[bucket[one], slot[one]] = 0
            rest = np.ones(len(mark), bool)
            rest[one] = False
            mark, first, second = mark[rest], first[rest], second[rest]


def fingerprints(h: np.ndarray) -> np.ndarray:
    """1 to 65535, from bits that choose neither shard nor bucket."""
    return ((h >> _U(24)) % _U(65535) + _U(1)).astype(np.uint16)


@dataclass(frozen=True)
class LineIndex:
    """Exact counts (h, g, n), the filters of each shard, and what the index was made with."""

    counts: DataFrame
    filters: DataFrame
    shard_bits: int
    least: int
    shortest: int


def empty_index(spark: SparkSession, least: int = 10, shortest: int = 1) -> LineIndex:
    if least < 1 or shortest < 0:
        raise ValueError("`least` is 1 or more, `shortest` 0 or more")
    return LineIndex(spark.createDataFrame([], _COUNTS), spark.createDataFrame([], _FILTERS), 0, least, shortest)


def insert(index: LineIndex, docs: DataFrame, text: str = "text") -> LineIndex:
    """The index with the lines of `docs`."""
    return _changed(index, _line_counts(docs, text, index.shortest))


def delete(index: LineIndex, docs: DataFrame, text: str = "text") -> LineIndex:
    """The index without the lines of `docs`, which must have been inserted before."""
    return _changed(index, _line_counts(docs, text, index.shortest).withColumn("n", -F.col("n")))


def _shard(bits: int) -> Column:
    """The first `bits` bits of the hash."""
    return F.shiftrightunsigned("h", 64 - bits).cast("int") if bits else F.lit(0)


def _changed(index: LineIndex, change: DataFrame) -> LineIndex:
    spark = change.sparkSession
    folder = shared_folder(spark)
    rows = index.counts.select("h", "g", F.col("n").alias("old"), F.lit(0).cast("bigint").alias("more"))
    rows = rows.unionByName(change.select("h", "g", F.lit(0).cast("bigint").alias("old"), F.col("n").alias("more")))
    both = rows.groupBy("h", "g").agg(F.sum("old").alias("old"), F.sum("more").alias("more"))
    n = F.col("old") + F.col("more")
    n = F.when(n < 0, F.raise_error(F.lit("documents to be deleted were never inserted")).cast("bigint")).otherwise(n)
    both = stored(both.select("h", "g", "old", n.alias("n")), folder, "counts")

    bits = max(0, (both.where("n > 0").count() - 1) // KEYS).bit_length()
    if bits > 40:
        raise ValueError("more keys than shards can be told apart")
    filters = index.filters if bits == index.shard_bits else index.filters.limit(0)
    made = both.withColumn("shard", _shard(bits)).groupBy("shard").cogroup(filters.groupBy("shard")).applyInArrow(_shard_filter(index.least), _FILTERS)
    return LineIndex(both.where("n > 0").select("h", "g", "n"), stored(made, folder, "filters"), bits, index.least, index.shortest)


def _shard_filter(least: int) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    """For one shard: its filter brought up to date, or made anew, and the keys it lets through by chance."""

    def run(shard: tuple, keys: pa.Table, have: pa.Table) -> pa.Table:
        h, g = (keys.column(c).to_numpy().view(np.uint64) for c in ("h", "g"))
        old, n = keys.column("old").to_numpy(), keys.column("n").to_numpy()
        common = n >= least
        if have.num_rows:
            cuckoo = Cuckoo(np.frombuffer(have.column("table")[0].as_py(), np.uint16).reshape(-1, SLOTS).copy())
            cuckoo.remove(h[(old >= least) & ~common])
            if not cuckoo.insert(h[common & (old < least)]):
                cuckoo = Cuckoo.of(h[common])
        else:
            cuckoo = Cuckoo.of(h[common])
        chance = np.flatnonzero(~common & (n > 0))
        chance = chance[cuckoo.contains(h[chance])]
        known = [pa.array([x[chance].view(np.int64)], pa.list_(pa.int64())) for x in (h, g)]
        number = shard[0].as_py() if isinstance(shard[0], pa.Scalar) else shard[0]
        return pa.Table.from_arrays([pa.array([number], pa.int32()), pa.array([cuckoo.table.tobytes()], pa.binary()), *known], names=["shard", "table", "known_h", "known_g"])

    return run


class Filters:
    """The filters of all shards side by side, to test many keys of any shards at once."""

    def __init__(self, rows: list, bits: int):
        self.bits = bits
        self.mask, self.base = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
        tables, at = [np.zeros((1, SLOTS), np.uint16)], 1
        for row in rows:
            table = np.frombuffer(row["table"], np.uint16).reshape(-1, SLOTS)
            self.base[row["shard"]], self.mask[row["shard"]] = at, len(table) - 1
            tables.append(table)
            at += len(table)
        self.table = np.concatenate(tables)
        h, g = (np.array([x for row in rows for x in row[c]], np.int64).view(np.uint64) for c in ("known_h", "known_g"))
        order = np.argsort(h)
        self.known_h, self.known_g = h[order], g[order]
        self.same = int(np.unique(h, return_counts=True)[1].max()) if len(h) else 0

    def common(self, h: np.ndarray, g: np.ndarray) -> np.ndarray:
        shard = (h >> _U(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(h), np.int64)
        mark, base, mask = fingerprints(h), self.base[shard], self.mask[shard]
        first = (h & mask.astype(np.uint64)).astype(np.int64)
        second = first ^ (mix(mark.astype(np.uint64)) & mask.astype(np.uint64)).astype(np.int64)
        found = ((self.table[base + first] == mark[:, None]) | (self.table[base + second] == mark[:, None])).any(axis=1)
        at = np.searchsorted(self.known_h, h)
        for _ in range(self.same):
            at_most = np.minimum(at, len(self.known_h) - 1)
            found &= ~((self.known_h[at_most] == h) & (self.known_g[at_most] == g))
            at = at_most + 1
        return found


_ADDED = "n_lines bigint, n_dropped bigint, result string"


def _cut(texts: list[str | None], common: list[np.ndarray]) -> list:
    """n_lines, n_dropped and the kept lines of each text; `common` marks the lines to be dropped."""
    n_lines, n_dropped, kept = [], [], []
    for text, drop in zip((t or "" for t in texts), common, strict=True):
        n_lines.append(len(drop))
        n_dropped.append(int(drop.sum()))
        if n_dropped[-1]:
            text = "\n".join(line for line, gone in zip(text.split("\n"), drop, strict=True) if not gone)
        kept.append(text)
    return [n_lines, n_dropped, pa.array(kept, pa.string())]


def drop_common_lines(docs: DataFrame, index: LineIndex, text: str = "text", filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """`docs`, all of them documents of the index, with n_lines, n_dropped and the text without its common lines.

    Columns of `docs` named n_lines or n_dropped give way.
    """
    given, names = set_aside(docs)
    size = F.octet_length("table") + 16 * F.size("known_h")
    needed = index.filters.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0] + (16 << index.shard_bits)
    cut = _by_filters(given, names[text], index) if needed <= filter_bytes else _by_join(given, names[text], index)
    columns = [F.col("result").alias(c) if c == text else F.col(n).alias(c) for c, n in names.items() if c.lower() not in ("n_lines", "n_dropped")]
    return cut.select(*columns, "n_lines", "n_dropped")


def _by_filters(docs: DataFrame, text: str, index: LineIndex) -> DataFrame:
    shortest = index.shortest
    rows = index.filters.collect()  # at most FILTER_BYTES
    shared = docs.sparkSession.sparkContext.broadcast(Filters(rows, index.shard_bits))

    def run(texts: pa.Array) -> list:
        given = texts.to_pylist()
        keys = [line_keys(t or "", shortest) for t in given]
        edges = np.cumsum([0] + [len(k) for k in keys])
        flat = [k for own in keys for k in own]
        some = np.array([k >= 0 for k in flat], bool)
        h, g = _halves([k for k in flat if k >= 0])
        common = np.zeros(len(flat), bool)
        common[some] = shared.value.common(h, g)
        return _cut(given, [common[a:b] for a, b in zip(edges, edges[1:], strict=False)])

    return map_columns(docs, run, [text], [c for c in docs.columns if c != text], _ADDED)


def _by_join(docs: DataFrame, text: str, index: LineIndex) -> DataFrame:
    """The join key is spelled another way than the counts are dealt out, so Spark can split a hot line."""
    shortest, folder = index.shortest, shared_folder(docs.sparkSession)
    numbered = stored(docs.withColumn("_row", F.monotonically_increasing_id()), folder, "numbered")

    def lines(texts: pa.Array) -> list:
        out = []
        for t in texts.to_pylist():
            h, g = _halves([k for k in set(line_keys(t or "", shortest)) if k >= 0])
            out.append([{"h": a, "g": b} for a, b in zip(h.view(np.int64).tolist(), g.view(np.int64).tolist(), strict=True)])
        return [pa.array(out, pa.list_(pa.struct([("h", pa.int64()), ("g", pa.int64())])))]

    listed = map_columns(numbered, lines, [text], ["_row"], "keys array<struct<h:bigint,g:bigint>>").select("_row", F.inline("keys"))
    turned = [F.bitwise_not("h").alias("h"), F.bitwise_not("g").alias("g")]
    common = index.counts.where(F.col("n") >= index.least).select(*turned)
    hits = listed.select("_row", *turned).join(common, ["h", "g"]).groupBy("_row").agg(F.collect_list(F.struct(*turned)).alias("_hits"))
    joined = numbered.join(hits, "_row", "left")

    def run(texts: pa.Array, hits: pa.Array) -> list:
        given, common = texts.to_pylist(), []
        for t, own in zip(given, hits.to_pylist(), strict=True):
            drop = {(x["h"] % (1 << 64)) | (x["g"] % (1 << 64)) << 64 for x in own or []}
            common.append(np.array([k in drop for k in line_keys(t or "", shortest)], bool))
        return _cut(given, common)

    return map_columns(joined, run, [text, "_hits"], [c for c in docs.columns if c != text], _ADDED)


def dedup_lines(docs: DataFrame, least: int = 10, shortest: int = 1, text: str = "text") -> DataFrame:
    """`docs` without the lines that at least `least` of them hold; with n_lines and n_dropped."""
    return drop_common_lines(docs, insert(empty_index(docs.sparkSession, least, shortest), docs, text), text)
