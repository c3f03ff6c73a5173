"""BPE encoding and decoding: speculate and verify.

For each new pre-token, greedy longest match proposes tokens; an automaton of the vocabulary
runs over all pre-tokens of a batch at once. The proposal is what merging
in rank order gives if each token is what its own bytes merge to and each adjacent pair is
compatible, that is, merging the pair's bytes keeps the cut between them. All adjacent pairs
of a batch are tested together with numpy, by undoing merges on both sides of the cut from
the latest back and looking for a merge across it that would have come earlier. Only the
pre-tokens that fail are merged exactly.

Defined cases: null text is empty and has no ids; null ids decode to an empty text. Special
strings inside a text become their own ids, as the tokenizers library does by default.
Bytes that are no UTF-8 decode to U+FFFD. Repeated rows and null ids each give a row; empty
tables give empty results; other columns are ignored. Texts of any length are taken whole,
a run of texts of about a million characters at a time.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import cached_property, lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices
from .pieces import PieceCache, in_parts, stable_pieces

# Fixed value: the pre-tokenizer's pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

NEVER = np.int64(1 << 40)
#: Stands between pre-tokens; no byte is written so.
_BETWEEN = "\u0100"
#: Latin words, of which the pattern makes one pre-token whatever version of Unicode it goes by.
_LATIN = regex.compile(r" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")
#: Pre-tokens up to so many bytes are merged by looking through their pairs again and again, longer ones with a heap.
SHORT = 32


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in vocabulary files: itself if printable, else the next free one from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Bpe:
    """Vocabulary, merges and special strings of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        to_bytes = lambda s: bytes(alphabet[c] for c in s)
        self.id_of = {to_bytes(k): v for k, v in spec["model"]["vocab"].items()}
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        size = max([*self.id_of.values(), *self.special.values()]) + 1
        self.bytes_of = [b""] * size
        for k, v in self.id_of.items():
            self.bytes_of[v] = k
        for k, v in self.special.items():
            self.bytes_of[v] = k.encode()
        self.rank, self.left, self.right = np.full(size, -1, np.int64), np.arange(size), np.arange(size)
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for r, m in enumerate(spec["model"]["merges"]):
            a, b = (self.id_of[to_bytes(x)] for x in (m.split(" ") if isinstance(m, str) else m))
            t = self.id_of[self.bytes_of[a] + self.bytes_of[b]]
            if (a, b) not in self.merge:
                self.merge[a, b] = (r, t)
            if self.rank[t] < 0:
                self.rank[t], self.left[t], self.right[t] = r, a, b
        keys = np.array([a * size + b for a, b in self.merge], np.int64)
        order = np.argsort(keys)
        self._keys, self._ranks, self.size = keys[order], np.array([r for r, _ in self.merge.values()], np.int64)[order], size
        self._merge = {a * size + b: m for (a, b), m in self.merge.items()}
        self._longest = ahocorasick.Automaton()
        for k, v in self.id_of.items():
            self._longest.add_word(k.decode("latin-1"), v)
        self._longest.add_word(_BETWEEN, -1)
        self._longest.make_automaton()
        self._byte = [self.id_of[bytes([b])] for b in range(256)]
        self._special = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        self._words = regex.compile(PATTERN)
        self._latin_special = any(_LATIN.search(s) and not regex.search(r"[^A-Za-z]", s) for s in self.special)

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._ranks[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge crosses the cut between a and b before both are complete.

        ``limit`` is the rank that a crossing merge must stay under to happen.
        """
        ok, live = np.ones(len(a), bool), np.arange(len(a))
        limit = np.full(len(a), NEVER) if limit is None else limit
        while len(live):
            crossed = self.pair_ranks(a, b) < limit
            ok[live[crossed]] = False
            last_a, last_b = self.rank[a], self.rank[b]
            go = ~crossed & ((last_a >= 0) | (last_b >= 0))
            live, a, b, last_a, last_b = live[go], a[go], b[go], last_a[go], last_b[go]
            # Of equal merges the left one comes first, so the right one is undone first.
            undo_a = last_a > last_b
            limit = np.where(undo_a, last_a, last_b + 1)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
        return ok

    @cached_property
    def whole(self) -> np.ndarray:
        """For each token, whether its own bytes merge to it."""
        made = np.flatnonzero(self.rank >= 0)
        made = made[np.argsort(self.rank[made])]
        good = np.ones(self.size, bool)
        fits = self.compatible(self.left[made], self.right[made], self.rank[made])
        for t, ok in zip(made, fits):
            good[t] = ok and good[self.left[t]] and good[self.right[t]]
        return good

    def greedy(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all words, each the longest that matches, and where each word's begin, with the end of the last."""
        joined = _BETWEEN.join(w.decode("latin-1") for w in words) + _BETWEEN
        found = np.fromiter((t for _, t in self._longest.iter_long(joined)), np.int64)
        ends = np.flatnonzero(found < 0)
        return found[found >= 0], np.concatenate([[0], ends - np.arange(len(ends))])

    def exact(self, word: bytes) -> list[int]:
        """Merge the best-ranked pair, leftmost first, until none is left."""
        ids = [self._byte[b] for b in word]
        if len(ids) <= SHORT:
            merge, size = self._merge.get, self.size
            pairs = [merge(a * size + b) for a, b in zip(ids, ids[1:])]
            while any(pairs):
                best = min(filter(None, pairs))
                at = pairs.index(best)
                ids[at : at + 2] = [best[1]]
                del pairs[at]
                if at:
                    pairs[at - 1] = merge(ids[at - 1] * size + ids[at])
                if at < len(pairs):
                    pairs[at] = merge(ids[at] * size + ids[at + 1])
            return ids
        after, before = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]
        heap = [(m[0], i, ids[i], ids[i + 1], m[1]) for i in range(len(ids) - 1) if (m := self.merge.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, t = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = t, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (m := self.merge.get((ids[x], ids[y]))):
                    heapq.heappush(heap, (m[0], x, ids[x], ids[y], m[1]))
        return [t for t in ids if t >= 0]

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each pre-token."""
        if not words:
            return []
        flat, starts = self.greedy(words)
        of = np.repeat(np.arange(len(words)), np.diff(starts))
        wrong = np.zeros(len(words), bool)
        wrong[of[~self.whole[flat]]] = True
        inside = np.flatnonzero(of[1:] == of[:-1])
        pairs, back = np.unique(flat[inside] * self.size + flat[inside + 1], return_inverse=True)
        fits = self.compatible(pairs // self.size, pairs % self.size)
        wrong[of[inside[~fits[back]]]] = True
        tokens, at = flat.tolist(), starts.tolist()
        return [self.exact(w) if bad else tokens[a:b] for w, bad, a, b in zip(words, wrong.tolist(), at, at[1:])]

    def encode_batch(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text, special strings included."""
        plan: list[list] = []
        words: dict[str, int] = {}
        for text in texts:
            if _LATIN.fullmatch(text) and not self._latin_special:
                plan.append([words.setdefault(text, len(words))])
                continue
            parts: list = []
            at = 0
            for m in [*self._special.finditer(text), None]:
                parts += [words.setdefault(w, len(words)) for w in self._words.findall(text[at : m.start() if m else len(text)])]
                if m:
                    parts.append(-1 - self.special[m[0]])
                    at = m.end()
            plan.append(parts)
        ids = self.encode_words([w.encode() for w in words])
        return [[t for p in parts for t in (ids[p] if p >= 0 else (-1 - p,))] for parts in plan]


@lru_cache(maxsize=2)
def loaded(path: str) -> tuple[Bpe, PieceCache]:
    """The vocabulary and the ids of pieces seen so far; one a Python worker, whichever tasks it runs."""
    bpe = Bpe(path)
    return bpe, PieceCache(lambda texts: [np.array(x, np.int32).tobytes() for x in bpe.encode_batch(texts)])


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (array of int) of every whole text of ``docs(doc_id, text)``."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, cache = loaded(path)
        for batch in batches:
            at = 0
            for part in in_parts([t or "" for t in batch.column(1).to_pylist()]):
                pieces = [stable_pieces(t) for t in part]
                cache.prepare(pieces)
                ids = [b"".join(cache.look_up(p)) for p in pieces]
                ends = np.cumsum([0, *(len(x) // 4 for x in ids)], dtype=np.int32)
                flat = pa.array(np.frombuffer(b"".join(ids), np.int32), pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(part)), pa.ListArray.from_arrays(pa.array(ends), flat)], ["doc_id", "ids"])
                at += len(part)

    return docs.select("doc_id", "text").mapInArrow(made, "doc_id long, ids array<int>")


@lru_cache(maxsize=2)
def token_bytes(path: str) -> pa.LargeBinaryArray:
    """The bytes of each id."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    alphabet = byte_alphabet()
    known = {v: bytes(alphabet[c] for c in k) for k, v in spec["model"]["vocab"].items()} | {a["id"]: a["content"].encode() for a in spec["added_tokens"]}
    return pa.array([known.get(i, b"") for i in range(max(known) + 1)], pa.large_binary())


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded(doc_id, ids)`` with the decoded text, special strings kept."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = token_bytes(path)
        for batch in slices(batches, 256):
            lists = batch.column(1)
            spelled = vocabulary.take(lists.flatten())
            _, offsets, data = spelled.buffers()
            ends = np.frombuffer(offsets, np.int64)[spelled.offset : spelled.offset + len(spelled) + 1]
            at = ends[np.cumsum([0, *lists.value_lengths().to_pylist()])].tolist()
            whole = memoryview(data if data is not None else b"")
            texts = [str(whole[a:b], "utf-8", "replace") for a, b in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids")).mapInArrow(made, "doc_id long, ids array<int>, decoded string")
