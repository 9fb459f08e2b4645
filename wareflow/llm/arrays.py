"""Texts of an Arrow column as byte arrays: words, word hashes and hashes of word windows.

Arrow batches are handled in runs of rows of about `SLICE` bytes, and texts in runs of about `CHUNK`
bytes, so memory does not grow with the batch; one text is never split, whatever its length.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

SLICE = 1 << 20
CHUNK = 1 << 18
_U = np.uint64


def process_cache() -> dict:
    """A dictionary that lives as long as the worker process, for tables that are dear to build."""
    name = "wareflow_llm_process_cache"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def set_aside(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """`df` with neutral column names, so no added column can clash; and the new name of each column."""
    names = {c: f"_c{i}" for i, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def _weights(column: pa.Array) -> np.ndarray:
    """About how many bytes each value takes."""
    if pa.types.is_list(column.type):
        sizes = pc.multiply(pc.list_value_length(column), 8)
    elif pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        sizes = pc.binary_length(column)
    else:
        return np.full(len(column), 8, np.int64)
    return pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False).astype(np.int64)


def slices(batches: Iterator[pa.RecordBatch], needs: int) -> Iterator[pa.RecordBatch]:
    """The rows of `batches` in runs of about `SLICE` bytes in the first `needs` columns; none of them empty."""
    for batch in batches:
        n, lo = batch.num_rows, 0
        ends = np.cumsum(sum((_weights(batch.column(i)) for i in range(needs)), np.ones(n, np.int64)))
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(ends, SLICE + (ends[lo - 1] if lo else 0), "right")))
            yield batch.slice(lo, hi - lo)
            lo = hi


def map_columns(
    df: DataFrame,
    function: Callable[..., list],
    needs: list[str],
    keeps: list[str],
    added: str,
) -> DataFrame:
    """Columns `keeps` of `df` plus the columns `added` (DDL) that `function(*needs)` returns per batch.

    A kept column with the name of an added one gives way to it. Rows stay as they are.
    """
    new = T.StructType.fromDDL(added)
    names = {x.lower() for x in new.names}
    keeps = [k for k in keeps if k.lower() not in names]
    given = df.select(
        *[F.col(quoted(n)).alias(f"_need_{i}") for i, n in enumerate(needs)],
        *[F.col(quoted(k)).alias(f"_keep_{i}") for i, k in enumerate(keeps)],
    )
    fields = [T.StructField(k, given.schema[f"_keep_{i}"].dataType) for i, k in enumerate(keeps)]
    schema = T.StructType(fields + list(new))
    kinds = to_arrow_schema(new)
    n_needs, n_keeps = len(needs), len(keeps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, n_needs):
            columns = function(*[batch.column(i) for i in range(n_needs)])
            made = [pa.array(c, t) if not isinstance(c, pa.Array) else c.cast(t) for c, t in zip(columns, kinds.types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(n_needs + i) for i in range(n_keeps)] + made, names=schema.names)

    return given.mapInArrow(run, schema)


def packed_texts(df: DataFrame, text: str, keeps: list[str], name: str = "packed") -> DataFrame:
    """Columns `keeps` of `df` with each text compressed, for texts that must be shuffled."""

    def pack(texts: pa.Array) -> list:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        return [pa.array([None if t is None else squeeze(t.encode()) for t in texts.to_pylist()], pa.binary())]

    return map_columns(df, pack, [text], keeps, f"{name} binary")


def unpacked(column: pa.Array) -> pa.Array:
    expand = zstandard.ZstdDecompressor().decompress
    raw = pa.array([None if p is None else expand(p) for p in column.to_pylist()], pa.large_binary())
    return raw.cast(pa.large_string())


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit numbers over all bits, one to one."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Alphabet:
    """Which bytes belong to words, and the number that stands for each byte."""

    def __init__(self, separators: list[int], fold_case: bool):
        byte = np.arange(256)
        if fold_case:
            byte[65:91] += 32
        self.word = ~np.isin(byte, separators)
        self.value = mix(byte.astype(np.uint64) + _U(0x9E3779B97F4A7C15))
        self.folded = byte.astype(np.uint8)


SPACES = [0x20, *range(0x09, 0x0E)]
PLAIN = Alphabet(SPACES, fold_case=False)
FOLDED = Alphabet(SPACES, fold_case=True)


def _powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64, for i below n."""
    cache = process_cache()
    key = f"powers{base}"
    have = cache.get(key)
    if have is None or len(have[0]) < n:
        inverse = pow(base, -1, 1 << 64)
        have = tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, b, np.uint64)]), dtype=np.uint64) for b in (base, inverse))
        # those of longer texts are not kept
        if n <= 2 * CHUNK:
            cache[key] = have
    return have[0][:n], have[1][:n]


BYTE_BASE, WORD_BASE = 0x5851F42D4C957F2D, 0x2545F4914F6CDD1D


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """A 64-bit hash of each values[start:end]; equal sequences get equal hashes wherever they stand."""
    up, down = _powers(len(values) + 1, base)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def text_chunks(column: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets of the texts in them); a null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, at, data = column.buffers()
    n = len(column)
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


@dataclass
class Words:
    """Words of the texts of a chunk: byte ranges, hashes, and the index of each text's first word."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Start (word index) and hash of every run of `length` words inside one text."""
        n = len(self.hashes)
        last = np.repeat(self.first[1:], self.counts)
        at = np.flatnonzero(np.arange(length, n + length) <= last) if n else np.zeros(0, np.int64)
        return at, range_hashes(self.hashes, at, at + length, WORD_BASE)

    def rows(self, at: np.ndarray) -> np.ndarray:
        """The text of each word index."""
        return np.searchsorted(self.first, at, "right") - 1


def find_words(data: np.ndarray, offsets: np.ndarray, alphabet: Alphabet) -> Words:
    inside = alphabet.word[data]
    begin, finish = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    finish[:-1] &= ~inside[1:]
    filled = offsets[1:] > offsets[:-1]
    heads, tails = offsets[:-1][filled], offsets[1:][filled] - 1
    begin[heads], finish[tails] = inside[heads], inside[tails]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    hashes = range_hashes(alphabet.value[data], starts, ends, BYTE_BASE)
    return Words(starts, ends, np.searchsorted(starts, offsets), hashes)


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """An Arrow list column from flat values and the length of each list."""
    at = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=at[1:])
    return pa.ListArray.from_arrays(pa.array(at), pa.array(values, kind))
