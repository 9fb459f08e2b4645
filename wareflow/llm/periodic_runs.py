"""Periodic runs of words by recompression.

A run is a stretch of consecutive words whose smallest period q is at most a third of its length and
that no neighbouring word extends with period q; only runs of at least `shortest` words are looked for.

1. Grammar. The words of many texts stand in one row, with a mark of its own before each text. Two steps
   alternate until one symbol is left: block compression puts one symbol for each maximal repetition of
   a symbol; pair compression deals the symbols into left and right ones and puts one symbol for each
   left one followed by a right one. Both depend on the symbols alone, so what is equal in the row is
   compressed alike but for its ends. Rules and parse are kept level by level; altogether they have a
   few times as many symbols as there are words.
2. Grid. A run of period p agrees with itself p words on in at least 2p places in a row, so also in two
   or more neighbouring multiples of p. For each p these are told by comparing every p-th word, which is
   n + n/2 + n/3 + ... comparisons in all. Neighbouring candidates are kept as one interval.
3. Extension. From a candidate i, the grammar tells how far the row agrees with itself p words on, to
   the right and to the left: it climbs while the symbols agree, and comes down where they differ. An
   interval's candidates that an extension covers are skipped; the others follow, each time twice as many.
4. The same stretch found for several periods is a run of the least.

The numbers of words in a row are the texts' own, so every text is handled whole, in one task; a text
needs memory in proportion to its words. Equality of words rests on 64-bit hashes.

Defined cases: a null, empty or blank text has no words and no runs; rows are handled one by one, so
equal rows get equal results; columns of `docs` with the names of added ones give way.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wareflow.llm.arrays import PLAIN, find_words, map_columns, mix, text_chunks

ROW_BYTES = 1 << 20
_U = np.uint64


def _named(letters: np.ndarray, others: np.ndarray, free: int) -> tuple[np.ndarray, int]:
    """One new symbol, from `free` on, for each distinct pair; and the next free symbol."""
    rules, symbol = np.unique((letters << 32) | others, return_inverse=True)
    return symbol + free, free + len(rules)


class Grammar:
    """A run-length grammar of a row of symbols whose ends are unique, as parse levels from the row up to one symbol.

    `symbols[k]` is level k; `first[k]` says where the parts of each symbol of level k + 1 begin in it, and
    `block[k]` whether they are blocks.
    """

    def __init__(self, row: np.ndarray):
        self.symbols, self.first, self.parent, self.block = [row], [], [], []
        free, salt = int(row.max()) + 1, 0
        while len(self.symbols[-1]) > 1:
            free = self._blocks(free)
            free = self._pairs(free, salt)
            salt += 1

    def _add(self, symbols: np.ndarray, starts: np.ndarray, block: bool) -> None:
        self.block.append(block)
        n = len(self.symbols[-1])
        self.first.append(np.append(starts, n))
        self.parent.append(np.repeat(np.arange(len(starts)), np.diff(self.first[-1])))
        self.symbols.append(symbols)

    def _blocks(self, free: int) -> int:
        row = self.symbols[-1]
        starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        if len(starts) == len(row):
            return free
        sizes = np.diff(np.append(starts, len(row)))
        out, long = row[starts], sizes > 1
        out[long], free = _named(out[long], sizes[long], free)
        self._add(out, starts, True)
        return free

    def _pairs(self, free: int, salt: int) -> int:
        row = self.symbols[-1]
        right = (mix(row.astype(_U) + _U(salt << 40)) & _U(1)).astype(bool)
        head = np.flatnonzero(~right[:-1] & right[1:])
        if not len(head):
            return free
        made, free = _named(row[head], row[head + 1], free)
        stays = np.ones(len(row), bool)
        stays[head + 1] = False
        starts = np.flatnonzero(stays)
        out = row[starts]
        out[np.searchsorted(starts, head)] = made
        self._add(out, starts, False)
        return free

    def _rest(self, level: int, x: np.ndarray, way: int) -> tuple[np.ndarray, np.ndarray]:
        """From x on, that way: symbols left in its parent, and whether x is the parent's first."""
        at = self.parent[level][x]
        low, high = self.first[level][at], self.first[level][at + 1]
        return (high - x, x == low) if way > 0 else (x - low + 1, x == high - 1)

    def agreeing(self, a: np.ndarray, b: np.ndarray, way: int) -> np.ndarray:
        """How many symbols of the row agree from places a and b (all a < b) on; `way` is 1 or -1.

        Neither block nor pair can end in the middle of what agrees on one side only, but for the first
        step of a level. So each level takes a few steps, and as many levels as the agreeing stretch needs.
        """
        n = len(a)
        x, y, differ = a.copy(), b.copy(), np.full(n, -1)
        climbing, level = np.arange(n), 0
        while len(climbing):
            symbols = self.symbols[level]
            live, up = climbing, []
            while len(live):
                p, q = x[live], y[live]
                same = symbols[p] == symbols[q]
                differ[live[~same]] = level
                live, p, q = live[same], p[same], q[same]
                (left_p, first_p), (left_q, first_q) = self._rest(level, p, way), self._rest(level, q, way)
                both = first_p & first_q
                up.append(live[both])
                # the symbols left in both parents are equal: a block has one letter, a pair is taken letter by letter
                step = np.minimum(left_p, left_q)
                live, move = live[~both], (way * step)[~both]
                x[live] += move
                y[live] += move
            climbing = np.concatenate(up)
            x[climbing], y[climbing] = self.parent[level][x[climbing]], self.parent[level][y[climbing]]
            level += 1
        for level in range(int(differ.max(initial=0)), 0, -1):
            down = np.flatnonzero(differ >= level)
            first, symbols = self.first[level - 1], self.symbols[level - 1]
            for place in (x, y):
                place[down] = first[place[down]] if way > 0 else first[place[down] + 1] - 1
            live = down
            while len(live):
                p, q = x[live], y[live]
                same = symbols[p] == symbols[q]
                live, p, q = live[same], p[same], q[same]
                step = np.minimum(self._rest(level - 1, p, way)[0], self._rest(level - 1, q, way)[0]) if self.block[level - 1] else 1
                x[live] = p + way * step
                y[live] = q + way * step
        return (x - a) * way



def _candidates(row: np.ndarray, period: int, in_a_row: int) -> tuple[np.ndarray, np.ndarray]:
    """Intervals (first, last) of k such that `in_a_row` multiples of the period from k * period on agree with the next one."""
    grid = row[::period]
    equal = np.flatnonzero(grid[1:] == grid[:-1])
    if len(equal) < in_a_row:
        return equal[:0], equal[:0]
    k = equal[: len(equal) - in_a_row + 1]
    k = k[equal[in_a_row - 1 :] - k == in_a_row - 1]
    if not len(k):
        return k, k
    new = np.flatnonzero(np.diff(k) != 1) + 1
    return k[np.append(0, new)], k[np.append(new - 1, len(k) - 1)]


def row_runs(row: np.ndarray, longest: int, shortest: int, times: int) -> np.ndarray:
    """(start, end, period) of all runs of a row of symbols whose ends are unique; no run is longer than `longest`."""
    found, intervals = [], []
    for period in range(1, longest // times + 1):
        least = max(shortest, times * period)
        if least > longest:
            break
        first, last = _candidates(row, period, (least - period) // period)
        if len(first):
            intervals.append((np.full(len(first), period), first, last))
    if not intervals:
        return np.zeros((0, 3), np.int64)
    period, k, last = (np.concatenate(c) for c in zip(*intervals, strict=True))
    grammar, ahead = Grammar(row), 1
    while len(k):
        take = np.minimum(ahead, last - k + 1)
        begin = np.cumsum(take) - take
        p = np.repeat(period, take)
        at = (np.repeat(k - begin, take) + np.arange(len(p))) * p
        right, left = grammar.agreeing(at, at + p, 1), grammar.agreeing(at - 1, at + p - 1, -1)
        runs = np.stack([at - left, at + p + right, p], axis=1)
        found.append(runs[runs[:, 1] - runs[:, 0] >= np.maximum(shortest, times * p)])
        # the first multiple of the period after the place where the agreement ended
        k = np.maximum(k + take, np.maximum.reduceat((at + right) // p + 1, begin))
        period, k, last = (x[k <= last] for x in (period, k, last))
        ahead *= 2
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    return runs[np.concatenate([np.ones(min(1, len(runs)), bool), (np.diff(runs[:, :2], axis=0) != 0).any(axis=1)])]


def _strongest(runs: list[dict]) -> dict | None:
    return max(runs, key=lambda r: (Fraction(r["length"], r["period"]), -r["start"], -r["period"]), default=None)


_RUN = "struct<start:bigint,length:bigint,period:bigint>"


def find_runs(docs: DataFrame, shortest: int = 24, times: int = 3, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns `keep` (default all) of `docs` with n_words, runs, strongest and collapsed.

    `runs` are those of at least max(`shortest`, `times` * period) words, by start and period; words are
    numbered from 0. `strongest` is the one with the greatest length by period (of equals the first),
    null without runs. `collapsed` has the words that no run holds after its first period, joined by
    one space.
    """
    if times < 3 or shortest < times:
        raise ValueError("a run has at least three periods, and `shortest` is at least `times`")

    def run(texts: pa.Array) -> list:
        n_words, runs, collapsed = [], [], []
        for lo, hi, data, offsets in text_chunks(texts, ROW_BYTES):
            words, n = find_words(data, offsets, PLAIN), hi - lo
            # a mark of its own before each text and at the end
            row = np.zeros(len(words.hashes) + n + 1, np.int64)
            marks = words.first + np.arange(n + 1)
            is_word = np.ones(len(row), bool)
            is_word[marks] = False
            row[is_word] = np.unique(words.hashes, return_inverse=True)[1]
            row[marks] = len(row) + np.arange(n + 1)
            got = row_runs(row, int(words.counts.max(initial=0)), shortest, times)
            text_of = np.searchsorted(marks, got[:, 0], "right") - 1
            start = got[:, 0] - marks[text_of] - 1
            own: list[list[dict]] = [[] for _ in range(n)]
            for k, s, length, p in zip(text_of.tolist(), start.tolist(), (got[:, 1] - got[:, 0]).tolist(), got[:, 2].tolist(), strict=True):
                own[k].append({"start": s, "length": length, "period": p})
            # a word goes if more drops have begun than ended before it
            depth = np.zeros(len(row) + 1, np.int64)
            np.add.at(depth, got[:, 0] + got[:, 2], 1)
            np.add.at(depth, got[:, 1], -1)
            kept = np.cumsum(depth)[:-1][is_word] == 0
            raw, starts, ends = data.tobytes(), words.starts.tolist(), words.ends.tolist()
            for a, b in zip(words.first, words.first[1:], strict=False):
                stays = np.flatnonzero(kept[a:b]) + a
                collapsed.append(b" ".join([raw[starts[i] : ends[i]] for i in stays.tolist()]).decode())
            n_words += words.counts.tolist()
            runs += own
        return [n_words, runs, [_strongest(r) for r in runs], collapsed]

    return map_columns(docs, run, [text], docs.columns if keep is None else keep, f"n_words bigint, runs array<{_RUN}>, strongest {_RUN}, collapsed string")
