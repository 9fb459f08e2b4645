"""Which tokens of two tokenizers stand for the same bytes, and how sure the corpus is of each pair.

Tokenizer A is a byte-level BPE vocabulary, B a sentencepiece model; both read the text with one blank
before it. Byte offsets at which tokens of both end cut the tokens into groups; the tokens of a group
are linked with each other.

1. Each text is tokenised whole by both. Neither has tokens across a blank that follows a character other
   than white space, so what stands between two such blanks, a unit, is tokenised alike in all texts,
   and each worker does so once. A text counts only if the bytes of both token rows are those of the text.
2. Anchors are shared ends that a token with a leading blank follows on both sides. They cut the token
   rows into windows, mostly of one word.
3. Windows with the same ids on both sides are aligned alike, so each worker aligns a window once and
   remembers it by its two tuples of ids. Units and windows are remembered up to `CHARACTERS` in all;
   beyond that all are forgotten, so memory is bounded and results do not depend on it.
4. `score_links` counts, for each pair of ids, the documents that link it. The pairs of most documents,
   at most `FREQUENT` by their share of all, are broadcast with their counts; only the others are
   shuffled, so no pair is a hot key.

Defined cases: a null or empty text, a text with U+2581, and any other whose bytes a tokenizer does not
give back has no tokens: zeros, empty `groups` and no links. Rows are documents; rows of one id count
one by one. Columns with the names of added ones give way. The two files must lie at the same paths
on all machines.
"""

from __future__ import annotations

import re
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from wareflow.llm.arrays import BYTE_BASE, WORD_BASE, lists, map_columns, mix, process_cache, quoted, range_hashes, set_aside
from wareflow.llm.bpe import PATTERN, _Encoder, _pieces
from wareflow.operators.shared import shared_folder, stored

CHARACTERS = 2_000_000
FREQUENT = 1 << 18
BLANK = "▁"


class _Bytes:
    """A byte-level BPE vocabulary: tiktoken's reading of it, where its ids are in the order of its merges.

    Texts with letters beyond U+024F, on which readers of different Unicode versions may differ, go
    through the encoder that keeps to the vocabulary's own.
    """

    def __init__(self, path: str):
        self.exact = _Encoder(path, specials=False, cached=20_000)
        known = self.exact.vocabulary
        made = known._made
        self.fast = None
        if (np.diff(made) > 0).all() and len(made) + 256 == len(known.ids):
            self.fast = tiktoken.Encoding("units", pat_str=PATTERN, mergeable_ranks=known.ids, special_tokens={})
        self.bytes = known.bytes

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of ids of each text."""
        far = [self.fast is None or not (t.isascii() or not self.exact.far.search(t)) for t in texts]
        if all(far):
            return self.exact.encode(texts)
        ids = [[] if f else self.fast.encode_ordinary(t) for t, f in zip(texts, far, strict=True)]
        if any(far):
            flat, counts = self.exact.encode([t for t, f in zip(texts, far, strict=True) if f])
            own = iter(np.split(flat, np.cumsum(counts)[:-1]))
            ids = [next(own).tolist() if f else i for i, f in zip(ids, far, strict=True)]
        return np.fromiter(chain.from_iterable(ids), np.int64), np.array([len(i) for i in ids], np.int64)


class _Pieces:
    """A sentencepiece model, and whether units can be tokenised one by one."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(path, "rb") as f:
            spec = sentencepiece_model_pb2.ModelProto.FromString(f.read())
        pieces = [p.piece for p in spec.pieces]
        rules = spec.normalizer_spec
        plain = rules.name == "identity" and rules.add_dummy_prefix and not rules.remove_extra_whitespaces
        # no piece has a blank after another character: what stands before a blank never changes what follows
        self.by_units = plain and not any(BLANK in p.lstrip(BLANK) for p in pieces)
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of ids of each text; every text begins with a blank."""
        # the model adds the first blank itself, but not to an empty text
        blank = [self.model.piece_to_id(BLANK)]
        ids = [own or blank for own in self.model.encode([t[1:] for t in texts], num_threads=1)]
        return np.fromiter(chain.from_iterable(ids), np.int64), np.array([len(own) for own in ids], np.int64)


class _Tokens:
    """The bytes of a vocabulary's tokens: all in a row, where each begins, and which begin with a blank."""

    def __init__(self, tokens: list[bytes]):
        self.data = np.frombuffer(b"".join(tokens), np.uint8)
        self.at = np.cumsum([0] + [len(t) for t in tokens])
        self.sizes = np.diff(self.at)
        self.blank = np.array([t[:1] == b" " for t in tokens])

    def bytes(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        total = np.cumsum(sizes) - sizes
        return self.data[np.repeat(self.at[ids] - total, sizes) + np.arange(sizes.sum())]


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (counts[0] of them), starts[1], ..."""
    return np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


class _Aligner:
    """Both tokenizers, and the units and windows seen so far."""

    def __init__(self, path_a: str, path_b: str):
        self.encode_a, self.encode_b = _Bytes(path_a), _Pieces(path_b)
        self.a, self.b = _Tokens(self.encode_a.bytes), _Tokens(self.encode_b.bytes)
        # a unit begins with a blank behind a character that is no white space
        self.unit = re.compile(r" \s*\S*(?:[^\S ]\s*\S*)*" if self.encode_b.by_units else r"(?s).+")
        self.forget()

    def forget(self) -> None:
        self.held = 0
        self.units: dict[str, int] = {}
        # of unit k: tokens of A and B, whether its bytes are given back, and its windows
        self.n_a, self.n_b, self.good = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        self.window_at, self.windows = np.zeros(1, np.int64), np.zeros(0, np.int64)
        self.index: dict[tuple[bytes, bytes], int] = {}
        self.n_groups = np.zeros(0, np.int64)
        # of window k: pairs[pair_at[k]:pair_at[k + 1]], and its groups as text with a ; behind each
        self.pair_at, self.pairs = np.zeros(1, np.int64), np.zeros(0, np.int64)
        self.name_at, self.names = np.zeros(1, np.int64), np.zeros(0, np.uint8)

    def align(self, texts: list[str]) -> tuple:
        """(n_a, n_b, n_groups, n_links, groups, pairs in a row, times of each, pairs per text) of each text."""
        n = len(texts)
        parts = [self.unit.findall(" " + t) if t else [] for t in texts]
        unit = self._known([u for p in parts for u in p])
        unit_text = np.repeat(np.arange(n), [len(p) for p in parts])
        bad = np.bincount(unit_text[~self.good[unit]], minlength=n) > 0
        unit, unit_text = unit[~bad[unit_text]], unit_text[~bad[unit_text]]
        of_a, of_b = (np.bincount(unit_text, x[unit], n).astype(np.int64) for x in (self.n_a, self.n_b))
        counts = self.window_at[unit + 1] - self.window_at[unit]
        window, window_text = self.windows[_spread(self.window_at[unit], counts)], np.repeat(unit_text, counts)
        sizes = self.name_at[window + 1] - self.name_at[window]
        names = self.names[_spread(self.name_at[window], sizes)].tobytes()
        cut = np.append(0, np.cumsum(np.bincount(window_text, sizes, n).astype(np.int64))).tolist()
        groups = [names[x : max(x, y - 1)].decode() for x, y in zip(cut, cut[1:], strict=False)]
        n_groups = np.bincount(window_text, self.n_groups[window], n).astype(np.int64)
        links = self.pair_at[window + 1] - self.pair_at[window]
        n_links = np.bincount(window_text, links, n).astype(np.int64)
        # windows of a text first, then their pairs, each with how often it occurs
        key, often = np.unique(window_text * max(1, len(self.n_groups)) + window, return_counts=True)
        window, window_text = key % max(1, len(self.n_groups)), key // max(1, len(self.n_groups))
        links = self.pair_at[window + 1] - self.pair_at[window]
        kinds, kind = np.unique(self.pairs[_spread(self.pair_at[window], links)], return_inverse=True)
        of_text, at = np.unique(np.repeat(window_text, links) * max(1, len(kinds)) + kind, return_inverse=True)
        times = np.bincount(at, np.repeat(often, links), len(of_text)).astype(np.int64)
        return of_a, of_b, n_groups, n_links, groups, kinds[of_text % max(1, len(kinds))], times, np.bincount(of_text // max(1, len(kinds)), minlength=n)

    def _known(self, units: list[str]) -> np.ndarray:
        """The number of each unit; new ones are tokenised, compared with their bytes and aligned first."""
        if self.held > CHARACTERS:
            self.forget()
        at = np.fromiter(map(self.units.get, units, repeat(-1)), np.int64, len(units))
        missing = np.flatnonzero(at < 0).tolist()
        if missing:
            new = list(dict.fromkeys(units[i] for i in missing))
            (a, of_a), (b, of_b) = self.encode_a.encode(new), self.encode_b.encode(new)
            a = a.astype(np.int64)
            good = self._given_back(new, a, of_a, b, of_b)
            counts, windows = self._cut(a[np.repeat(good, of_a)], np.where(good, of_a, 0), b[np.repeat(good, of_b)])
            self.units.update(zip(new, range(len(self.n_a), len(self.n_a) + len(new)), strict=True))
            self.held += sum(map(len, new))
            self.n_a, self.n_b = np.concatenate([self.n_a, of_a]), np.concatenate([self.n_b, of_b])
            self.good = np.concatenate([self.good, good])
            self.window_at = np.concatenate([self.window_at, self.window_at[-1] + np.cumsum(counts)])
            self.windows = np.concatenate([self.windows, windows])
            at[missing] = [self.units[units[i]] for i in missing]
        return at

    def _cut(self, a: np.ndarray, of_a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(windows per unit, their numbers in a row): cut where tokens with a leading blank begin on both sides."""
        sizes_a, sizes_b = self.a.sizes[a], self.b.sizes[b]
        start_a, start_b = np.cumsum(sizes_a) - sizes_a, np.cumsum(sizes_b) - sizes_b
        anchors = np.intersect1d(start_a[self.a.blank[a]], start_b[self.b.blank[b]], assume_unique=True)
        edge_a, edge_b = np.append(np.searchsorted(start_a, anchors), len(a)), np.append(np.searchsorted(start_b, anchors), len(b))
        unit = np.searchsorted(np.cumsum(of_a), edge_a[:-1], "right")
        return np.bincount(unit, minlength=len(of_a)), self._remembered(a, b, edge_a, edge_b)

    def _given_back(self, texts: list[str], a: np.ndarray, of_a: np.ndarray, b: np.ndarray, of_b: np.ndarray) -> np.ndarray:
        """Whether the bytes of both token rows are those of the text."""
        raw = [t.encode() for t in texts]
        sizes = np.array([len(r) for r in raw])
        want, good = np.frombuffer(b"".join(raw), np.uint8), sizes > 0
        for tokens, ids, counts in ((self.a, a, of_a), (self.b, b, of_b)):
            ends = np.append(0, np.cumsum(tokens.sizes[ids]))[np.append(0, np.cumsum(counts))]
            good &= np.diff(ends) == sizes
            got, at = tokens.bytes(ids), np.cumsum(sizes) - sizes
            if np.array_equal(np.diff(ends), sizes):
                differs = np.flatnonzero(got != want)
                good[np.searchsorted(at + sizes, differs, "right")] = False
            else:
                for k in np.flatnonzero(good):
                    good[k] = np.array_equal(got[ends[k] : ends[k + 1]], want[at[k] : at[k] + sizes[k]])
        return good

    def _remembered(self, a: np.ndarray, b: np.ndarray, edge_a: np.ndarray, edge_b: np.ndarray) -> np.ndarray:
        """The number of each window among those remembered; new ones are aligned first."""
        n_a, n_b = np.diff(edge_a), np.diff(edge_b)
        hashed = range_hashes(mix(a.astype(np.uint64)), edge_a[:-1], edge_a[1:], WORD_BASE)
        hashed = mix(hashed) + range_hashes(mix(b.astype(np.uint64)), edge_b[:-1], edge_b[1:], BYTE_BASE)
        _, one, kind = np.unique(hashed, return_index=True, return_inverse=True)
        like = one[kind]
        # equal hashes are only a proposal: all ids are compared
        same = (n_a == n_a[like]) & (n_b == n_b[like])
        for ids, edge, count in ((a, edge_a, n_a), (b, edge_b, n_b)):
            check = np.flatnonzero(same)
            flat = ids[_spread(edge[check], count[check])] == ids[_spread(edge[like[check]], count[check])]
            same[np.repeat(check, count[check])[~flat]] = False
        one = np.concatenate([one, np.flatnonzero(~same)])
        raw_a, raw_b = a.astype(np.int32).tobytes(), b.astype(np.int32).tobytes()
        edges = (x.tolist() for x in (4 * edge_a[one], 4 * edge_a[one + 1], 4 * edge_b[one], 4 * edge_b[one + 1]))
        keys = [(raw_a[s:t], raw_b[u:v]) for s, t, u, v in zip(*edges, strict=True)]
        missing = list(dict.fromkeys(k for k in keys if k not in self.index))
        if missing:
            self._learn(missing)
        number = np.fromiter(map(self.index.__getitem__, keys), np.int64, len(keys))
        out = np.empty(len(n_a), np.int64)
        out[:] = number[: len(keys) - int((~same).sum())][kind] if len(keys) else 0
        out[~same] = number[len(keys) - int((~same).sum()) :]
        return out

    def _learn(self, windows: list[tuple[bytes, bytes]]) -> None:
        """Aligns windows, all at once: tokens between shared ends are linked with each other."""
        a, b = (np.frombuffer(b"".join(w[i] for w in windows), np.int32).astype(np.int64) for i in (0, 1))
        window_ends = np.cumsum([len(w[0]) // 4 for w in windows])
        end_a, end_b = np.cumsum(self.a.sizes[a]), np.cumsum(self.b.sizes[b])
        # both sides of a window have the same bytes, so shared ends never reach over its border
        shared = np.intersect1d(end_a, end_b, assume_unique=True)
        cut_a, cut_b = (np.append(0, np.searchsorted(e, shared) + 1) for e in (end_a, end_b))
        n_a, n_b = np.diff(cut_a), np.diff(cut_b)
        window = np.searchsorted(window_ends, cut_a[:-1], "right")
        at = _spread(np.zeros(len(n_a), np.int64), n_a * n_b)
        owner = np.repeat(np.arange(len(n_a)), n_a * n_b)
        pairs = (a[cut_a[owner] + at // n_b[owner]] << 32) | b[cut_b[owner] + at % n_b[owner]]
        n = len(windows)
        known = len(self.index)
        self.index.update(zip(windows, range(known, known + n), strict=True))
        self.n_groups = np.concatenate([self.n_groups, np.bincount(window, minlength=n)])
        self.pair_at = np.concatenate([self.pair_at, self.pair_at[-1] + np.cumsum(np.bincount(window, n_a * n_b, n).astype(np.int64))])
        self.pairs = np.concatenate([self.pairs, pairs])
        # ids in the order of the text: a group's of A, then its of B; each with the mark behind it
        place_a = np.arange(len(a)) + np.repeat(cut_b[:-1], n_a)
        place_b = np.arange(len(b)) + np.repeat(cut_a[1:], n_b)
        ids, marks = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        ids[place_a], ids[place_b] = a, b
        marks[place_a[cut_a[1:] - 1]], marks[place_b[cut_b[1:] - 1]] = ord("|"), ord(";")
        names, ends = _written(ids, marks)
        self.names = np.concatenate([self.names, names])
        self.name_at = np.concatenate([self.name_at, self.name_at[-1] + ends[np.cumsum(np.bincount(window, n_a + n_b, n).astype(np.int64)) - 1]])


def _written(numbers: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers in decimal, each with its mark behind it; and where each mark's byte ends."""
    digits = 1 + sum((numbers >= 10**k).astype(np.int64) for k in range(1, 10))
    ends = np.cumsum(digits + 1)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    out[ends - 1] = marks
    rest, k = numbers.copy(), 0
    while k < 10:
        own = digits > k
        out[ends[own] - 2 - k] = 48 + rest[own] % 10
        rest //= 10
        k += 1
    return out, ends


def align(docs: DataFrame, path_a: str, path_b: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns `keep` (default all) of `docs` with n_a, n_b, n_groups, n_links, groups, pairs and times.

    `groups` names the ids of each group in order: `a1,a2|b1;a3|b2,b3`. `pairs` are the linked pairs of
    ids, once each, as a * 2**32 + b, and `times` how often the text links each.
    """

    def run(texts: pa.Array) -> list:
        cache, key = process_cache(), f"aligner {path_a} {path_b}"
        if key not in cache:
            cache[key] = _Aligner(path_a, path_b)
        parts = [cache[key].align(part) for part in _pieces([t or "" for t in texts.to_pylist()])]
        n_a, n_b, n_groups, n_links, _, pairs, times, counts = (np.concatenate([p[i] for p in parts]) if i != 4 else None for i in range(8))
        groups = pa.array([g for p in parts for g in p[4]], pa.string())
        return [n_a, n_b, n_groups, n_links, groups, lists(pairs, counts, pa.int64()), lists(times, counts, pa.int32())]

    added = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, pairs array<bigint>, times array<int>"
    return map_columns(docs, run, [text], docs.columns if keep is None else keep, added)


def link_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): in how many documents each pair is linked, and whether no pair of its A id is in more."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    most = F.max("n").over(Window.partitionBy(F.shiftright("pair", 32)))  # at most one row for each id of B
    return counts.select("pair", "n", (F.col("n") == most).alias("best"))


def score_links(aligned: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """`aligned` without pairs and times, with n_best (its links that are the best of their A id) and count_sum (the counts of all its links)."""
    folder = shared_folder(aligned.sparkSession)
    given, names = set_aside(aligned)
    pairs, times = names["pairs"], names["times"]
    rows = stored(given.withColumn("_row", F.monotonically_increasing_id()), folder, "aligned")
    counts = stored(link_counts(rows.select(F.col(pairs).alias("pairs"))), folder, "counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    limit = total // frequent + 1  # not more than `frequent` pairs can be in so many documents
    table = counts.where(F.col("n") >= limit).orderBy("pair").toArrow()
    frequent_rows = aligned.sparkSession.sparkContext.broadcast([table.column(c).to_numpy() for c in ("pair", "n", "best")])

    def split(row: pa.Array, pairs: pa.Array, times: pa.Array) -> list:
        known, n, best = frequent_rows.value
        flat, often = pairs.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
        owner = np.repeat(np.arange(len(row)), np.diff(pairs.offsets.to_numpy()))
        at = np.minimum(np.searchsorted(known, flat), max(0, len(known) - 1))
        hit = known[at] == flat if len(known) else np.zeros(len(flat), bool)
        sums = np.bincount(owner[hit], n[at[hit]] * often[hit], len(row)).astype(np.int64)
        bests = np.bincount(owner[hit], best[at[hit]] * often[hit], len(row)).astype(np.int64)
        rest = np.bincount(owner[~hit], minlength=len(row))
        return [bests, sums, lists(flat[~hit], rest, pa.int64()), lists(often[~hit], rest, pa.int64())]

    first = map_columns(rows, split, ["_row", pairs, times], ["_row"], "bests bigint, sums bigint, pair array<bigint>, often array<bigint>")
    # one more entry per row carries what the frequent pairs give, under a number that no pair has
    own = F.array(F.struct((-1 - F.col("_row")).alias("pair"), F.lit(0).cast("bigint").alias("often"), F.col("bests"), F.col("sums")))
    rare = F.transform(F.arrays_zip("pair", "often"), lambda x: F.struct(x["pair"].alias("pair"), x["often"].alias("often"), F.lit(0).cast("bigint").alias("bests"), F.lit(0).cast("bigint").alias("sums")))
    entries = first.select("_row", F.inline(F.concat(own, rare)))
    joined = entries.join(counts.where(F.col("n") < limit), "pair", "left")
    n_best = F.sum(F.col("bests") + F.when(F.col("best"), F.col("often")).otherwise(0))
    count_sum = F.sum(F.col("sums") + F.coalesce("n", F.lit(0)) * F.col("often"))
    scored = joined.groupBy("_row").agg(n_best.alias("n_best"), count_sum.alias("count_sum"))
    kept = [F.col(n).alias(c) for c, n in names.items() if c not in ("pairs", "times", "n_best", "count_sum")]
    return rows.drop(pairs, times).join(scored, "_row").select(*kept, "n_best", "count_sum")
