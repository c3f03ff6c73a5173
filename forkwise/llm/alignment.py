"""Cross-tokenizer alignment by counting token ends.

The documents of an Arrow batch are laid out one after another in bytes. The ends of both
tokenizers' tokens are counted once for each byte offset of the batch (``bincount``), and
groups are cut where both count. Between two neighbouring ends of either kind lies exactly
one pair of overlapping tokens, a link, whose tokens prefix sums over the ends number.
Differences of prefix sums at the documents' borders give each document's figures.

How many links hold a pair of ids is counted over the whole corpus. Each document keeps its
pairs with the number of its own links, so counts are summed after a partial sum in each
task. The most frequent pairs, no more than BROADCAST_PAIRS, are broadcast to be looked up;
the others are joined by a shuffle, in which no key is frequent.

Texts are encoded by pieces, of which a worker remembers the ids: neither tokenizer joins
across a single space between two characters that aren't white space (``pieces`` for the
byte-level one; the pieces of the other never hold a space behind another character, which
is checked when its model is loaded, and otherwise texts are encoded whole).

Defined cases: special strings inside texts are plain text. Texts that are null or empty, or
that one of the tokenizers doesn't give back byte for byte, have no tokens: zeros, and an
empty string in place of a digest. Repeated rows and null ids each give a row and count in the
corpus; empty tables give empty results; other columns are ignored. Texts are taken whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import token_bytes
from .common import discard, tidy_shuffles, written
from .pieces import _BOUNDARY, _UNSURE, PieceCache, in_parts

#: Pairs of ids that are broadcast with their counts (about 60 MB).
BROADCAST_PAIRS = 1_000_000
#: Characters of documents that are aligned together.
TOGETHER = 1 << 19
_BYTE = re.compile(r"<0x([0-9A-Fa-f]{2})>")


def pieces_of(text: str) -> list[str]:
    """``text`` cut before spaces that neither tokenizer joins across; a space before each piece is left out. A text with B's sign for a space stays whole."""
    if "\u2581" in text:
        return [text]
    if "  " in text or text[:1] == " " or text[-1:] == " " or _UNSURE.search(text):
        return _BOUNDARY.split(text)
    return text.split(" ")


class Tokenizers:
    """Both vocabularies, and the ids of pieces seen so far."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        spelled = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.separable = not any("▁" in p.lstrip("▁") for p in spelled)
        as_byte = [_BYTE.fullmatch(p) for p in spelled]
        self.bytes_a = token_bytes(path_a)
        self.bytes_b = pa.array([bytes([int(m[1], 16)]) if m else p.replace("▁", " ").encode() for m, p in zip(as_byte, spelled)], pa.large_binary())
        self.size_a, self.size_b = len(self.bytes_a), len(self.bytes_b)
        self.length_a, self.length_b = (np.diff(np.frombuffer(x.buffers()[1], np.int64)[: len(x) + 1]) for x in (self.bytes_a, self.bytes_b))
        #: How ids are written in a digest: A's before "," and "|", then B's before "," and ";".
        self.written = pa.array([f"{i}{mark}".encode() for marks, size in ((",|", self.size_a), (",;", self.size_b)) for mark in marks for i in range(size)], pa.large_binary())
        self.cache = PieceCache(self._learn)

    def _learn(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Ids of texts that begin with a space, which B adds itself."""
        a = self.a.encode_batch_fast(texts, add_special_tokens=False)
        b = self.b.encode([t[1:] for t in texts], num_threads=1)
        return [(np.array(x.ids, np.int32).tobytes(), np.array(y, np.int32).tobytes()) for x, y in zip(a, b)]

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[bytes]]:
        """Ids of each text by both, as bytes; empty texts have none."""
        pieces = [["", *(pieces_of(t) if self.separable else [t])] if t else [""] for t in texts]
        self.cache.prepare(pieces)
        a, b = [], []
        for p in pieces:
            known = list(self.cache.look_up(p))
            a.append(b"".join([x[0] for x in known]))
            b.append(b"".join([x[1] for x in known]))
        return a, b


@lru_cache(maxsize=1)
def loaded(path_a: str, path_b: str) -> Tokenizers:
    return Tokenizers(path_a, path_b)


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of runs of ``values`` of these lengths."""
    ends = np.concatenate([[0], np.cumsum(counts)])
    upto = np.concatenate([[0], np.cumsum(values)])
    return upto[ends[1:]] - upto[ends[:-1]]


def _flat(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(parts), np.int32).astype(np.int64), np.array([len(p) // 4 for p in parts], np.int64)


def _bytes_of(vocabulary: pa.LargeBinaryArray, ids: np.ndarray) -> np.ndarray:
    data = vocabulary.take(pa.array(ids)).buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)


def given_back(t: Tokenizers, texts: list[str], ids_a: list[bytes], ids_b: list[bytes]) -> list[bool]:
    """Whether both tokenizers give a text back byte for byte, with a space before it."""
    source = [(" " + x).encode() if x else b"" for x in texts]
    size = np.array([len(s) for s in source], np.int64)
    fits = size > 0
    for ids, vocabulary, lengths in ((ids_a, t.bytes_a, t.length_a), (ids_b, t.bytes_b, t.length_b)):
        flat, counts = _flat(ids)
        fits &= _sums(lengths[flat], counts) == size
        left = np.flatnonzero(fits)
        if len(left):
            flat, _ = _flat([ids[i] for i in left])
            said = np.frombuffer(b"".join([source[i] for i in left]), np.uint8)
            apart = np.flatnonzero(_bytes_of(vocabulary, flat)[: len(said)] != said)
            fits[left[np.unique(np.searchsorted(np.cumsum(size[left]), apart, "right"))]] = False
    return fits.tolist()


def aligned_batch(t: Tokenizers, texts: list[str]) -> dict[str, list | np.ndarray]:
    """Figures of each text, and its linked pairs of ids (a * size_b + b, ascending) with how many links hold each."""
    ids_a, ids_b = t.encode(texts)
    fits = given_back(t, texts, ids_a, ids_b)
    a, n_a = _flat([x if ok else b"" for x, ok in zip(ids_a, fits)])
    b, n_b = _flat([x if ok else b"" for x, ok in zip(ids_b, fits)])
    end_a, end_b = np.cumsum(t.length_a[a]), np.cumsum(t.length_b[b])
    total = int(end_a[-1]) if len(a) else 0
    borders = np.cumsum(np.concatenate([[0], _sums(t.length_a[a], n_a)]))  # of documents, in bytes

    ends_a, ends_b = np.bincount(end_a, minlength=total + 1), np.bincount(end_b, minlength=total + 1)
    cut, either = ends_a & ends_b, ends_a | ends_b
    cuts, links = np.cumsum(cut), np.cumsum(either)
    at = np.flatnonzero(either)
    pairs = a[(np.cumsum(ends_a) - ends_a)[at]] * t.size_b + b[(np.cumsum(ends_b) - ends_b)[at]]
    n_links = np.diff(links[borders])
    of, space = np.repeat(np.arange(len(texts)), n_links), t.size_a * t.size_b
    distinct, times = np.unique(of * space + pairs, return_counts=True)

    # Both kinds' tokens in the order in which they are written: by group, A's first.
    group_a, group_b = (cuts - cut)[end_a], (cuts - cut)[end_b]
    groups = int(cuts[-1])
    upto_a, upto_b = (np.cumsum(np.bincount(g, minlength=groups)) for g in (group_a, group_b))
    order = np.empty(len(a) + len(b), np.int64)
    order[np.arange(len(a)) + np.concatenate([[0], upto_b])[group_a]] = a + t.size_a * cut[end_a]
    order[np.arange(len(b)) + upto_a[group_b]] = 2 * t.size_a + b + t.size_b * cut[end_b]
    spelled = t.written.take(pa.array(order))
    _, offsets, data = spelled.buffers()
    text_ends = np.frombuffer(offsets, np.int64)[np.concatenate([[0], np.cumsum(n_a + n_b)])].tolist()
    whole = memoryview(data if data is not None else b"")
    return {
        "n_a": n_a, "n_b": n_b, "n_groups": np.diff(cuts[borders]), "n_links": n_links,
        "groups_sha256": [sha256(whole[x : y - 1]).hexdigest() if y > x else "" for x, y in zip(text_ends, text_ends[1:])],
        "pair": distinct % space, "times": times, "n_pairs": np.bincount(distinct // space, minlength=len(texts)),
    }


def token_links(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and arrays ``pair`` and ``times`` of every row of ``docs(doc_id, text)``."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = loaded(path_a, path_b)
        for batch in batches:
            at = 0
            for part in in_parts([x or "" for x in batch.column(1).to_pylist()], TOGETHER):
                got = aligned_batch(t, part)
                ends = pa.array(np.concatenate([[0], np.cumsum(got["n_pairs"])]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(got[c].astype(np.int64))) for c in ("pair", "times")]
                figures = [pa.array(got[c].astype(np.int64)) for c in ("n_a", "n_b", "n_groups", "n_links")]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(part)), *figures, pa.array(got["groups_sha256"]), *lists], ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pair", "times"])
                at += len(part)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(made, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pair array<bigint>, times array<bigint>")


def _listed(links: DataFrame) -> DataFrame:
    return links.select("row", F.explode(F.arrays_zip("pair", "times")).alias("x")).select("row", "x.pair", "x.times")


def frequent_from(counts: DataFrame, most: int) -> int:
    """The least step of ``_step`` from which on no more than ``most`` pairs lie."""
    steps, total, least = counts.groupBy(_step()).agg(F.count("*").alias("pairs")).collect(), 0, 1 << 20
    for r in sorted(steps, key=lambda r: -r["step"]):
        total += r["pairs"]
        if total > most:
            break
        least = r["step"]
    return least


def _step() -> F.Column:
    """Eight steps for each doubling of a count: some hundreds at any size."""
    return F.floor(F.log2("count") * 8).cast("int").alias("step")


def alignment(docs: DataFrame, path_a: str, path_b: str, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row of ``docs(doc_id, text)``.

    ``n_best`` links have a count that is the highest of their B id; ``count_sum`` adds up all
    links' counts.
    """
    with tidy_shuffles(docs.sparkSession):
        links = written(token_links(docs, path_a, path_b).withColumn("row", F.monotonically_increasing_id()), "token-links")
        size_b = loaded(path_a, path_b).size_b
        counts = written(_listed(links).groupBy("pair").agg(F.sum("times").alias("count")).withColumn("b", F.col("pair") % size_b), "pair-counts")
        best = counts.groupBy("b").agg(F.max("count").alias("highest"))  # no more rows than B has ids
        counts = counts.join(F.broadcast(best), "b").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"), _step())
        least = frequent_from(counts, broadcast_pairs)
        frequent, others = counts.filter(F.col("step") >= least).drop("step"), counts.filter(F.col("step") < least).drop("step")

        found = _listed(links).join(F.broadcast(frequent), "pair")
        if not others.isEmpty():
            rest = _listed(links).join(F.broadcast(frequent.select("pair")), "pair", "left_anti")
            found = found.unionByName(rest.join(others, "pair"))
        sums = found.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum"))
        sums = written(sums, "link-sums")
        zero = F.lit(0).cast("bigint")
        out = links.select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(sums, "row", "left")
        out = out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
        out = written(out, "aligned")
        discard(links, counts, sums)
        return out
