"""Token counts from compiled finite-state tokenizers.

Two deterministic machines count the tokens of a byte-level BPE vocabulary without making them.

1. `Splitter` marks where words begin. It has 8 states over 10 kinds of characters. Texts are cut into
   chunks of `SPAN` characters; each chunk's map from entry state to exit state is made for all chunks
   at once, a parallel prefix scan composes the maps, and with its true entry state every chunk then
   marks its own word starts.
2. `Counter` reads the bytes of a word. Each transition carries the number of tokens by which the
   encoding of the longer prefix exceeds that of the shorter one (it may be negative), so the sum over a
   word is its number of tokens. A state holds what later bytes can depend on: the suffixes that a token
   can begin with and go on from and, for each, the last token of the encoding that ends where the
   suffix begins, with the difference in count. This is finite, as tokens are bounded. A token
   ends an encoded prefix exactly if it is compatible with the last token before it. Transitions are
   compiled when a text first needs them, all new ones of a step together; at `STATES` states the
   tables are emptied, so memory is bounded and results stay the same.

Defined cases: a null or empty text has no tokens; strings of special tokens count as one token each, as
the tokenizer's default is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from wareflow.llm.arrays import map_columns, process_cache, quoted, text_chunks
from wareflow.llm.bpe import LETTER, NUMBER, Vocabulary, vocabulary

SPAN = 64
STATES = 120_000

# kinds of characters; Q2 and Q3 begin a contraction of 2 or 3 characters, *_LAST stand before no space
L, N, O, Q2, Q3, S_MID, S_LAST, W_MID, W_LAST, SKIP = range(10)
START, IN_L, IN_N, IN_O, BLANK, IN_SPACE, ONE_LEFT, TWO_LEFT = range(8)
FRESH = 10  # added to a kind: the first character of a text


def _machine() -> tuple[np.ndarray, np.ndarray]:
    """(next state, whether a word begins) by kind * 8 + state."""
    step, begins = np.zeros((20, 8), np.uint8), np.zeros((20, 8), bool)
    for state in range(8):
        for kind, run in ((L, IN_L), (N, IN_N), (O, IN_O)):
            step[kind, state], begins[kind, state] = run, state not in (run, BLANK)
        if state in (ONE_LEFT, TWO_LEFT):
            step[L, state], begins[L, state] = (START if state == ONE_LEFT else ONE_LEFT), False
        for kind, left in ((Q2, ONE_LEFT), (Q3, TWO_LEFT)):
            joins = state in (IN_O, BLANK)
            step[kind, state], begins[kind, state] = (IN_O if joins else left), not joins
        for kind in (S_MID, W_MID):
            step[kind, state], begins[kind, state] = IN_SPACE, state != IN_SPACE
        step[S_LAST, state], begins[S_LAST, state] = BLANK, True
        step[W_LAST, state], begins[W_LAST, state] = START, True
        step[SKIP, state] = state
    step[FRESH:], begins[FRESH:] = step[:FRESH, :1], True
    return step.ravel(), begins.ravel()


class Splitter:
    """Where the words of a vocabulary of this format begin."""

    def __init__(self):
        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        number = lambda i: i if i < 0xD800 else i + 0x800
        self.kind = np.full(0x110000, O, np.uint8)
        for pattern, kind in ((LETTER, L), (NUMBER, N), (r"\s", W_MID)):
            for m in regex.finditer(f"(?V1){pattern}+", every):
                self.kind[[number(i) for i in range(*m.span())]] = kind
        self.kind[32] = S_MID
        self.step, self.begins = _machine()

    def word_starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Byte positions at which words begin; texts lie between `offsets`."""
        at = np.flatnonzero((data & 0xC0) != 0x80)
        if not len(at):
            return at
        code = self._codes(data, at)
        kinds = self.kind[code]
        heads = np.unique(np.searchsorted(at, offsets[:-1][offsets[1:] > offsets[:-1]]))
        self._look_ahead(kinds, code, heads)
        kinds[heads] += FRESH
        chunks = -(-len(kinds) // SPAN)
        grid = np.full(chunks * SPAN, SKIP, np.uint8)
        grid[: len(kinds)] = kinds
        grid = np.ascontiguousarray(grid.reshape(chunks, SPAN).T).astype(np.int16) * 8
        # exit state of every chunk for every entry state
        maps = np.tile(np.arange(8, dtype=np.uint8), (chunks, 1))
        for row in grid:
            maps = self.step[row[:, None] + maps]
        entry = np.concatenate([[START], self._scan(maps)[:-1, START]]).astype(np.uint8)
        marks = np.empty((SPAN, chunks), bool)
        for i, row in enumerate(grid):
            key = row + entry
            marks[i] = self.begins[key]
            entry = self.step[key]
        return at[np.flatnonzero(marks.T.ravel()[: len(kinds)])]

    @staticmethod
    def _codes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
        code = data[at].astype(np.int32)
        many = np.flatnonzero(code >= 0xC0)
        if len(many):
            lead, p = code[many], at[many]
            more = lambda i: (data[np.minimum(p + i, len(data) - 1)] & 0x3F).astype(np.int32)
            two = ((lead & 0x1F) << 6) | more(1)
            three = ((lead & 0x0F) << 12) | (more(1) << 6) | more(2)
            four = ((lead & 0x07) << 18) | (more(1) << 12) | (more(2) << 6) | more(3)
            code[many] = np.where(lead < 0xE0, two, np.where(lead < 0xF0, three, four))
        return code

    @staticmethod
    def _look_ahead(kinds: np.ndarray, code: np.ndarray, heads: np.ndarray) -> None:
        """Turns kinds into those that depend on the next characters of the same text."""
        n = len(kinds)
        last = np.zeros(n, bool)
        last[heads[1:] - 1] = True
        last[-1] = True
        space = (kinds == S_MID) | (kinds == W_MID)
        before_other = np.zeros(n, bool)
        before_other[:-1] = ~space[1:]
        kinds[space & before_other & ~last] += 1  # S_MID to S_LAST, W_MID to W_LAST
        q = np.flatnonzero((code == 39) & ~last)
        if len(q):
            one = code[q + 1]
            room = ~last[q + 1]
            two = np.where(room, code[np.minimum(q + 2, n - 1)], 0)
            kinds[q[np.isin(one, [ord(c) for c in "stmd"])]] = Q2
            long = (one == ord("r")) & (two == ord("e")) | (one == ord("v")) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
            kinds[q[long]] = Q3

    @staticmethod
    def _scan(maps: np.ndarray) -> np.ndarray:
        """maps[i] after maps[i-1] after ... maps[0], in log steps."""
        width = 1
        while width < len(maps):
            maps = np.concatenate([maps[:width], np.take_along_axis(maps[width:], maps[:-width].astype(np.intp), axis=1)])
            width *= 2
        return maps


class Counter:
    """Counts the tokens of words, a byte of all words at a time."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.child = dict(zip(vocab._edges.tolist(), vocab._children.tolist(), strict=True))
        self.token = vocab._node_token.tolist()
        self.open = np.zeros(len(self.token), bool)
        self.open[vocab._edges >> 8] = True
        self.open = self.open.tolist()  # nodes that some token goes on from
        self.forget()

    def forget(self) -> None:
        # a state: (prefix node, last token before the prefix, count there minus count here) for every
        # suffix that is an open token prefix, the empty one last
        self.states = [(0, -1, 0)]
        self.known = {self.states[0]: 0}
        self.columns = np.full(256, -1, np.int64)
        self.n_columns = 0
        self.next = np.full((1024, 64), -1, np.int32)
        self.delta = np.zeros((1024, 64), np.int8)

    def _compile(self, pairs: list[tuple[int, int]]) -> None:
        """Adds the transitions of (state, byte) pairs; one test for the candidates of all."""
        child, tokens, is_open = self.child, self.token, self.open
        plans, before, after = [], [], []
        for state, byte in pairs:
            info = self.states[state]
            longer, counts, first = [], [], len(before)
            for i in range(0, len(info), 3):
                node = child.get((info[i] << 8) | byte)
                if node is not None:
                    last, count, token = info[i + 1], info[i + 2], tokens[node]
                    if token >= 0:
                        before.append(last)
                        after.append(token)
                        counts.append(count)
                    if is_open[node]:
                        longer.append((node, last, count))
            plans.append((state, byte, longer, counts, first))
        before, after = np.array(before, np.int64), np.array(after, np.int64)
        ok = ((before < 0) | self.vocab.compatible(np.maximum(before, 0), after)).tolist()
        after = after.tolist()
        places, numbers, changes = [], [], []
        for state, byte, longer, counts, first in plans:
            k = ok.index(True, first) - first
            change = counts[k] + 1  # tokens of the longer prefix minus tokens of the shorter one
            new = tuple(x for node, last, count in longer for x in (node, last, count - change)) + (0, after[first + k], 0)
            number = self.known.get(new)
            if number is None:
                number = self.known[new] = len(self.states)
                self.states.append(new)
            places.append((state, byte))
            numbers.append(number)
            changes.append(change)
        while len(self.states) > len(self.next):
            self.next = np.concatenate([self.next, np.full_like(self.next, -1)])
            self.delta = np.concatenate([self.delta, np.zeros_like(self.delta)])
        rows, letters = np.array(places, np.int64).T
        self.next[rows, self.columns[letters]], self.delta[rows, self.columns[letters]] = numbers, changes

    def _column(self, used: np.ndarray) -> None:
        for byte in used[self.columns[used] < 0].tolist():
            self.columns[byte] = self.n_columns
            self.n_columns += 1
            if self.n_columns > self.next.shape[1]:
                self.next = np.concatenate([self.next, np.full_like(self.next, -1)], axis=1)
                self.delta = np.concatenate([self.delta, np.zeros_like(self.delta)], axis=1)

    def counts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Number of tokens of each word data[start:end]."""
        if len(self.states) > STATES:
            self.forget()
        self._column(np.flatnonzero(np.bincount(data, minlength=256)))
        letters = self.columns[data]
        lengths = ends - starts
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        n = len(starts)
        state, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
        live = n - np.searchsorted(lengths[::-1], np.arange(lengths[0] if n else 0), "right")
        for k, m in enumerate(live.tolist()):
            column = letters[starts[:m] + k]
            width = self.next.shape[1]
            key = state[:m] * width + column
            to = self.next.ravel()[key]
            unknown = np.flatnonzero(to < 0)
            if len(unknown):
                pairs = np.unique((state[unknown] << 8) | data[starts[unknown] + k])
                self._compile([(p >> 8, p & 255) for p in pairs.tolist()])
                to = self.next.ravel()[key]
            total[:m] += self.delta.ravel()[key]
            state[:m] = to
        out = np.empty(n, np.int64)
        out[order] = total
        return out


def _segments(data: np.ndarray, offsets: np.ndarray, specials: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Texts cut at special strings: (edges, whether each piece is a special string)."""
    edges, marked = set(offsets.tolist()), set()
    raw = data.tobytes()
    finder = regex.compile(b"|".join(map(regex.escape, sorted(specials, key=len, reverse=True))))
    for lo, hi in zip(offsets.tolist(), offsets[1:].tolist(), strict=False):
        for m in finder.finditer(raw, lo, hi):
            edges.update(m.span())
            marked.add(m.start())
    edges = np.array(sorted(edges), np.int64)
    return edges, np.isin(edges[:-1], np.array(sorted(marked), np.int64))


class Tokenizer:
    def __init__(self, path: str):
        vocab = vocabulary(path)
        self.specials = [s.encode() for s in vocab.specials]
        self.splitter, self.counter = Splitter(), Counter(vocab)

    def count(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text of a chunk."""
        edges, special = offsets, None
        if self.specials and any(s in data.tobytes() for s in self.specials):
            edges, special = _segments(data, offsets, self.specials)
        starts = self.splitter.word_starts(data, edges)
        ends = np.concatenate([starts[1:], [len(data)]])
        extra = np.zeros(0, np.int64)
        if special is not None and special.any():
            extra = edges[:-1][special]
            piece = np.searchsorted(edges, starts, "right") - 1
            plain = ~special[piece]
            starts, ends = starts[plain], ends[plain]
        tokens = self.counter.counts(data, starts, ends) if len(starts) else np.zeros(0, np.int64)
        at = np.searchsorted(offsets, starts, "right") - 1
        out = np.bincount(at, weights=tokens, minlength=len(offsets) - 1).astype(np.int64)
        if len(extra):
            out += np.bincount(np.searchsorted(offsets, extra, "right") - 1, minlength=len(out))
        return out


def count_tokens(docs: DataFrame, path: str, text: str = "text", name: str = "n_tokens", keep: list[str] | None = None) -> DataFrame:
    """Columns `keep` (default all) of `docs` with the number of tokens of each whole text."""

    def run(texts: pa.Array) -> list:
        cache = process_cache()
        tokenizer = cache.get(f"counter {path}") or cache.setdefault(f"counter {path}", Tokenizer(path))
        return [np.concatenate([np.zeros(0, np.int64), *(tokenizer.count(data, offsets) for _, _, data, offsets in text_chunks(texts))])]

    return map_columns(docs, run, [text], docs.columns if keep is None else keep, f"{quoted(name)} bigint")
