"""Byte-level BPE encoding and decoding: speculate, verify, repair.

A text is split into words by the vocabulary's pattern. For the distinct words of a batch, greedy
longest match proposes tokens. A sequence of tokens is the BPE encoding of its word exactly if every
adjacent pair is compatible, that is, if the two tokens together encode to themselves; all adjacent
pairs of all proposals are tested at once with array operations that undo merges along the border of
the pair. Only words with an incompatible pair are merged pair by pair, by rank. Decoding gathers the
bytes of the tokens.

Each worker keeps the encodings of up to `CACHED` words; beyond that it forgets all and starts anew, so
memory is bounded and results do not depend on it. The vocabulary is a file that the cluster has at the
given path on every machine.

Defined cases: a null or empty text has no tokens and decodes to ''; ids outside the vocabulary are
ignored in decoding; bytes that are no valid UTF-8 decode to U+FFFD.
"""

from __future__ import annotations

import heapq
import json
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from wareflow.llm.arrays import lists, map_columns, process_cache, quoted

# The split pattern of byte-level BPE vocabularies of this format
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Letters and numbers of later Unicode versions than that of the tokenizers; to them
# these are other characters
LATER = (
    "\u0558 \u058b-\u058c \u088f \u0c5c \u0cdc \u208f \u209d-\u209f \ua7ce-\ua7cf \ua7d2 \ua7d4 \ua7dd \ua7e2 \ua7f1 \uab6c-\uab6d "
    "\U000107bb-\U000107bf \U00010940-\U00010959 \U00010ec5-\U00010ec7 \U00010ed9-\U00010eee \U00011b0a \U00011db0-\U00011ddb "
    "\U00011de0-\U00011de9 \U00011df1 \U0001246f \U00012475-\U0001247f \U00012550-\U00012686 \U00016ea0-\U00016eb8 \U00016ebb-\U00016ed3 "
    "\U00016ff2-\U00016ff6 \U000187f8-\U000187ff \U00018cd6-\U00018cda \U00018d09-\U00018d20 \U00018d80-\U00018df2 \U00018e00-\U00019191 "
    "\U000191a0-\U000191d2 \U0001b123-\U0001b128 \U0001b168 \U0001d6a6 \U0001df1f-\U0001df24 \U0001df2b-\U0001df81 \U0001df90-\U0001df96 "
    "\U0001dfcd-\U0001dfff \U0001e6c0-\U0001e6de \U0001e6e0-\U0001e6e2 \U0001e6e4-\U0001e6e5 \U0001e6e7-\U0001e6ed \U0001e6f0-\U0001e6f4 "
    "\U0001e6fe-\U0001e6ff \U0002b73a-\U0002b73f \U0002b81e \U0002cea2-\U0002cead \U000323b0-\U00033479 \U0003d000-\U0003fc3f"
).replace(" ", "")
# The letters, numbers and white space up to U+024F, for the texts that have no others
NEAR_LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f"
NEAR_NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
NEAR_SPACES = "\t-\r \x85\xa0"
LETTER, NUMBER = rf"[\p{{L}}--[{LATER}]]", rf"[\p{{N}}--[{LATER}]]"
NO_MERGE = 1 << 30
CACHED = 300_000
BATCH_BYTES = 1 << 19
# proposals for longer words are made in pieces of so many bytes, as the steps of a proposal are as many as its longest piece's bytes
PIECE = 256


def byte_letters() -> dict[str, int]:
    """The vocabulary file writes each byte as one printable letter: itself if printable, else 256, 257, ..."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Tokens as bytes, merges by rank, and for each token the two it was merged from."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        letters = byte_letters()
        raw = lambda t: bytes(letters[c] for c in t)
        self.ids = {raw(t): i for t, i in file["model"]["vocab"].items()}
        self.specials = {t["content"]: t["id"] for t in file["added_tokens"]}
        size = 1 + max([*self.ids.values(), *self.specials.values()])
        self.bytes = [b""] * size
        for t, i in self.ids.items():
            self.bytes[i] = t
        for t, i in self.specials.items():
            self.bytes[i] = t.encode()
        self.longest = max(map(len, self.ids))
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        self.rank = np.full(size, -1, np.int64)
        self.left, self.right = np.arange(size), np.arange(size)
        for rank, merge in enumerate(file["model"]["merges"]):
            a, b = (raw(t) for t in (merge.split(" ") if isinstance(merge, str) else merge))
            made = self.ids[a + b]
            self.merges[self.ids[a], self.ids[b]] = (rank, made)
            if self.rank[made] < 0:
                self.rank[made], self.left[made], self.right[made] = rank, self.ids[a], self.ids[b]
        pairs = np.array([(a << 32) | b for a, b in self.merges], np.int64)
        ranks = np.array([r for r, _ in self.merges.values()], np.int64)
        order = np.argsort(pairs)
        self._pairs, self._ranks = pairs[order], ranks[order]
        self._made = np.array([made for _, made in self.merges.values()], np.int64)  # by rank
        self._byte_token = np.array([self.ids[bytes([b])] for b in range(256)], np.int64)
        # a token that its own bytes do not encode to is never part of an encoding
        self.words = {t: i for t, i in self.ids.items() if self.merge(t) == [i]}
        self._compile_prefixes()

    def _compile_prefixes(self) -> None:
        """A trie of the tokens: sorted edges (node, byte), their child nodes, and the token of each node."""
        nodes, edges = {b"": 0}, {}
        for token in sorted(self.words):
            for end in range(1, len(token) + 1):
                if token[:end] not in nodes:
                    nodes[token[:end]] = len(nodes)
                    edges[(nodes[token[: end - 1]] << 8) | token[end - 1]] = nodes[token[:end]]
        self._node_token = np.full(len(nodes), -1, np.int64)
        for token, i in self.words.items():
            self._node_token[nodes[token]] = i
        self._edges = np.array(sorted(edges), np.int64)
        self._children = np.array([edges[k] for k in self._edges.tolist()], np.int64)

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair; a huge number if there is none."""
        key = (a << 32) | b
        at = np.minimum(np.searchsorted(self._pairs, key), len(self._pairs) - 1)
        return np.where(self._pairs[at] == key, self._ranks[at], NO_MERGE)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the tokens of each pair stay apart when their bytes are encoded together.

        Undoes the later of the two merges at the border, step by step. At each step, the two pieces
        that face each other must not merge before the piece just undone was made.
        """
        ok = np.ones(len(a), bool)
        at = np.arange(len(a))
        a, b = a.astype(np.int64), b.astype(np.int64)
        # merges of at least this rank come after the pieces now at the border have become part of more
        a_limit = np.full(len(a), NO_MERGE, np.int64)
        b_limit = a_limit.copy()
        while len(at):
            rank = self.pair_rank(a, b)
            # a merge of the border happens if it comes before either piece is taken by its own side;
            # of equal ranks the left one goes first
            clash = (rank < a_limit) & (rank < b_limit) | (rank == b_limit) & (rank < a_limit)
            ok[at[clash]] = False
            ra, rb = self.rank[a], self.rank[b]
            more = ~clash & ((ra >= 0) | (rb >= 0))
            at, a, b, a_limit, b_limit, ra, rb = (x[more] for x in (at, a, b, a_limit, b_limit, ra, rb))
            undo_a = ra > rb
            # equal ranks: the right piece was made after the left one
            a_limit, b_limit = np.where(undo_a, ra, a_limit), np.where(undo_a, b_limit, rb)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
        return ok

    def greedy(self, words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Longest match over many words in step: (tokens, tokens per word); `words` are their bytes in a row."""
        n = len(ends)
        at = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        live, stop = np.arange(n), ends.astype(np.int64)
        here, node = at.copy(), np.zeros(n, np.int64)
        best, best_end = np.full(n, -1, np.int64), at.copy()
        made_word, made_token = [], []
        padded = np.concatenate([words, [0]]).astype(np.int64)
        while len(live):
            key = (node << 8) | padded[here]
            place = np.minimum(np.searchsorted(self._edges, key), len(self._edges) - 1)
            on = (self._edges[place] == key) & (here < stop)
            node = np.where(on, self._children[place], 0)
            here = np.where(on, here + 1, here)
            token = np.where(on, self._node_token[node], -1)
            best, best_end = np.where(token >= 0, token, best), np.where(token >= 0, here, best_end)
            out = ~on
            made_word.append(live[out])
            made_token.append(best[out])
            here = np.where(out, best_end, here)
            going = on | (here < stop)
            live, stop, here, node, best, best_end = (x[going] for x in (live, stop, here, node, best, best_end))
        word, tokens = np.concatenate(made_word), np.concatenate(made_token)
        order = np.argsort(word, kind="stable")
        return tokens[order], np.bincount(word, minlength=n)

    def merge(self, word: bytes) -> list[int]:
        """The encoding by definition: the merge of lowest rank first, the leftmost of equals."""
        parts: list[int] = [self.ids[bytes([b])] for b in word]
        n = len(parts)
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*self.merges[p], i, *p) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if p in self.merges]
        heap = [(rank, i, made, a, b) for rank, made, i, a, b in heap]
        heapq.heapify(heap)
        while heap:
            _, i, made, a, b = heapq.heappop(heap)
            j = following[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = made, -1
            following[i] = following[j]
            if following[i] < n:
                before[following[i]] = i
            for x in (before[i], i):
                if x >= 0 and following[x] < n and (got := self.merges.get((parts[x], parts[following[x]]))):
                    heapq.heappush(heap, (got[0], x, got[1], parts[x], parts[following[x]]))
        return [p for p in parts if p >= 0]

    def merge_many(self, words: list[bytes]) -> list[list[int]]:
        """`merge` of short words, all in step: each round does the next merge of every word."""
        n, width = len(words), max(map(len, words))
        token = np.full((n, width + 1), -1, np.int64)
        lengths = np.array([len(w) for w in words])
        inside = np.arange(width + 1) < lengths[:, None]
        token[inside] = self._byte_token[np.frombuffer(b"".join(words), np.uint8)]
        none = NO_MERGE
        after = np.tile(np.arange(1, width + 2, dtype=np.int32), (n, 1))
        before = np.tile(np.arange(-1, width, dtype=np.int32), (n, 1))
        rank = np.full((n, width + 1), none, np.int32)
        pairs = inside[:, :-1] & inside[:, 1:]
        rank[:, :-1][pairs] = self.pair_rank(token[:, :-1][pairs], token[:, 1:][pairs])
        live = np.arange(n)
        while len(live):
            i = rank[live].argmin(axis=1)
            least = rank[live, i]
            some = least < none
            live, i, least = live[some], i[some], least[some]
            j = after[live, i]
            k = after[live, j]
            token[live, i], token[live, j] = self._made[least], -1
            rank[live, j] = none
            after[live, i], before[live, np.minimum(k, width)] = k, i
            rank[live, i] = none
            right = k < lengths[live]
            rank[live[right], i[right]] = self.pair_rank(token[live[right], i[right]], token[live[right], k[right]])
            p = before[live, i]
            left = p >= 0
            rank[live[left], p[left]] = self.pair_rank(token[live[left], p[left]], token[live[left], i[left]])
        return [row[row >= 0].tolist() for row in token]

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids in a row, ids per word): proposals, one test of all adjacent pairs, exact merging of those that fail."""
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        sizes = np.array([len(w) for w in words])
        ends = np.cumsum(sizes)
        pieces = (sizes + PIECE - 1) // PIECE
        within = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        piece_ends = np.minimum(np.repeat(ends - sizes, pieces) + (within + 1) * PIECE, np.repeat(ends, pieces))
        flat, counts = self.greedy(np.frombuffer(b"".join(words), np.uint8), piece_ends)
        word = np.repeat(np.repeat(np.arange(len(words)), pieces), counts)
        counts = np.bincount(word, minlength=len(words))
        inner = np.flatnonzero(word[1:] == word[:-1])
        pairs, place = np.unique((flat[inner] << 32) | flat[inner + 1], return_inverse=True)
        bad = ~self.compatible(pairs >> 32, pairs & 0xFFFFFFFF)
        failed = np.unique(word[inner[bad[place]]])
        if not len(failed):
            return flat, counts
        repaired: dict[int, list[int]] = {}
        sizes = sizes[failed]
        for low, high in ((0, 8), (8, 16), (16, 32), (32, 64)):
            own = failed[(sizes > low) & (sizes <= high)]
            for lo in range(0, len(own), 4096):
                part = own[lo : lo + 4096]
                repaired.update(zip(part.tolist(), self.merge_many([words[i] for i in part]), strict=True))
        repaired.update((int(i), self.merge(words[i])) for i in failed[sizes > 64])
        keep = np.ones(len(words), bool)
        keep[failed] = False
        kept = keep[word]
        ids = np.concatenate([flat[kept], np.array([t for i in failed for t in repaired[int(i)]], np.int64)])
        owner = np.concatenate([word[kept], np.repeat(failed, [len(repaired[int(i)]) for i in failed])])
        order = np.argsort(owner, kind="stable")
        return ids[order], np.bincount(owner, minlength=len(words))


def token_bytes(path: str) -> list[bytes]:
    """The bytes of each token, special ones included; all that decoding needs."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    letters = byte_letters()
    raw = {i: bytes(letters[c] for c in t) for t, i in file["model"]["vocab"].items()}
    raw |= {t["id"]: t["content"].encode() for t in file["added_tokens"]}
    return [raw.get(i, b"") for i in range(1 + max(raw))]


def vocabulary(path: str) -> Vocabulary:
    cache = process_cache()
    key = f"bpe {path}"
    if key not in cache:
        cache[key] = Vocabulary(path)
    return cache[key]


class _Encoder:
    """Encodings of the words seen: one flat array, and where each word's ids begin and end."""

    def __init__(self, path: str, specials: bool = True, cached: int = CACHED):
        self.vocabulary, self.cached = vocabulary(path), cached
        near = PATTERN.replace(r"[^\s\p{L}\p{N}]", f"[^{NEAR_SPACES}{NEAR_LETTERS}{NEAR_NUMBERS}]").replace(r"\S", f"[^{NEAR_SPACES}]")
        near = near.replace(r"\p{L}", f"[{NEAR_LETTERS}]").replace(r"\p{N}", f"[{NEAR_NUMBERS}]").replace(r"\s", f"[{NEAR_SPACES}]")
        self.near_pattern, self.far = re.compile(near), re.compile("[^\x00-\u024f]")
        self.pattern, self.later = regex.compile(PATTERN), re.compile(f"[{LATER}]")
        exact = PATTERN.replace(r"[^\s\p{L}\p{N}]", r"(?:[^\s\p{L}\p{N}]|[LATER])").replace(r"\p{L}+", LETTER + "+").replace(r"\p{N}+", NUMBER + "+")
        self.exact_pattern = regex.compile("(?V1)" + exact.replace("LATER", LATER))
        special = sorted(self.vocabulary.specials, key=len, reverse=True) if specials else []
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.int32)
        self.ends = np.zeros(1 << 16, np.int64)

    def split(self, text: str) -> list[str]:
        """Words of a text; a special token is a pair ("special", its string)."""
        if text.isascii() or not self.far.search(text):
            pattern = self.near_pattern
        else:
            pattern = self.exact_pattern if self.later.search(text) else self.pattern
        if self.special is None or not any(s in text for s in self.vocabulary.specials):
            return pattern.findall(text)
        out = []
        for i, part in enumerate(self.special.split(text)):
            out += [("special", part)] if i % 2 else pattern.findall(part)
        return out

    def learn(self, new: list) -> None:
        plain = [w for w in new if isinstance(w, str)]
        special = [w for w in new if not isinstance(w, str)]
        ids, counts = self.vocabulary.encode_words([w.encode() for w in plain])
        ids = np.concatenate([ids, np.array([self.vocabulary.specials[w[1]] for w in special], np.int64)])
        new = plain + special
        n = len(self.index)
        used = int(self.ends[n - 1]) if n else 0
        ends = used + np.cumsum(np.concatenate([counts, np.ones(len(special), np.int64)]))
        while len(self.flat) < ends[-1]:
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while len(self.ends) < n + len(new):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.flat[used : ends[-1]] = ids
        self.ends[n : n + len(new)] = ends
        self.index.update(zip(new, range(n, n + len(new)), strict=True))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of ids of each text."""
        parts = [self.split(t) for t in texts]
        words = [w for p in parts for w in p]
        if len(self.index) > self.cached:
            self.forget()
        at = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(at < 0).tolist()
        if missing:
            self.learn(list(dict.fromkeys(words[i] for i in missing)))
            at[missing] = [self.index[words[i]] for i in missing]
        first = np.where(at > 0, self.ends[at - 1], 0)
        counts = self.ends[at] - first
        total = np.concatenate([[0], np.cumsum(counts)])
        ids = self.flat[np.repeat(first - total[:-1], counts) + np.arange(total[-1])]
        text_ends = np.cumsum([0] + [len(p) for p in parts])
        return ids, np.diff(total[text_ends])


def _pieces(texts: list[str]):
    """Consecutive texts of about BATCH_BYTES characters together."""
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= BATCH_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


def _encoder(path: str) -> _Encoder:
    cache = process_cache()
    key = f"encoder {path}"
    if key not in cache:
        cache[key] = _Encoder(path)
    return cache[key]


def _encoded(texts: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, and the number of ids of each text."""
    parts = [_encoder(path).encode(part) for part in _pieces(texts)]
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _letters(path: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all tokens in a row, and where each token's begin and end."""
    cache = process_cache()
    key = f"letters {path}"
    if key not in cache:
        tokens = token_bytes(path)
        cache[key] = (np.frombuffer(b"".join(tokens), np.uint8), np.cumsum([0] + [len(b) for b in tokens]))
    return cache[key]


def _decoded(ids: np.ndarray, offsets: np.ndarray, path: str) -> list[str]:
    """The text of each ids[offsets[i]:offsets[i + 1]]."""
    data, at = _letters(path)
    out, lo, n = [], 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + BATCH_BYTES // 4, "right")) - 1)
        hi = min(hi, n)
        known = ids[offsets[lo] : offsets[hi]].astype(np.int64)
        usable = (known >= 0) & (known < len(at) - 1)
        known = np.where(usable, known, 0)
        counts = np.where(usable, at[known + 1] - at[known], 0)
        total = np.concatenate([[0], np.cumsum(counts)])
        raw = data[np.repeat(at[known] - total[:-1], counts) + np.arange(total[-1])].tobytes()
        edges = total[offsets[lo : hi + 1] - offsets[lo]]
        out += [raw[a:b].decode("utf-8", "replace") for a, b in zip(edges, edges[1:], strict=False)]
        lo = hi
    return out


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "token_ids", keep: list[str] | None = None) -> DataFrame:
    """Columns `keep` (default all) of `docs` with the token ids of each whole text; special strings count as special tokens."""

    def run(texts: pa.Array) -> list:
        flat, counts = _encoded([t or "" for t in texts.to_pylist()], path)
        return [lists(flat, counts, pa.int32())]

    return map_columns(docs, run, [text], docs.columns if keep is None else keep, f"{quoted(ids)} array<int>")


def decode(coded: DataFrame, path: str, ids: str = "token_ids", text: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    """Columns `keep` (default all) of `coded` with the text that the ids stand for."""

    def run(column: pa.Array) -> list:
        return [pa.array(_decoded(column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy(), path), pa.string())]

    return map_columns(coded, run, [ids], coded.columns if keep is None else keep, f"{quoted(text)} string")


def encode_and_decode(docs: DataFrame, path: str, text: str = "text", ids: str = "token_ids", decoded: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    """`encode` and then `decode` in one pass, with one Python worker for both."""

    def run(texts: pa.Array) -> list:
        flat, counts = _encoded([t or "" for t in texts.to_pylist()], path)
        back = _decoded(flat, np.cumsum(np.concatenate([[0], counts])), path)
        return [lists(flat, counts, pa.int32()), pa.array(back, pa.string())]

    return map_columns(docs, run, [text], docs.columns if keep is None else keep, f"{quoted(ids)} array<int>, {quoted(decoded)} string")
