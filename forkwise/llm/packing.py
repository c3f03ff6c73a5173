"""Harmonic packing of token sequences.

A document's ids are cut into full sequences and a remainder. The remainder's pieces fall
into reciprocal-capacity classes: class k holds lengths from capacity // (k + 1) + 1 to
capacity // k, and k of them fill a sequence. Where k pieces of its length would leave more
than ``slack`` of a sequence empty, the piece is first cut at capacity // (k + 1), which
fills class k + 1 to the brim, and the rest is classed in turn.

Pieces of a class are numbered by shard (a hash of the document), so every worker fills its
own run of sequences once it knows how many pieces the shards before it hold. Each class
ends with fewer than k pieces that fill no sequence; these are, whatever the input, at most
a fixed number (see ``most_left_over``) and are packed together by first fit.

Defined cases: a null text is empty and consists of the end id alone. Repeated rows are
packed each; a null id is kept. Texts of any length are taken whole, about a thousand
documents at a time, and cut where sequences are full. An empty table gives an empty result.
Other columns are ignored. Tokenizers whose steps before the merges aren't those of
``STEPS`` are refused, as words might depend on each other in them.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import byte_alphabet
from .common import discard, small_enough, text_bytes, written

CAPACITY = 2048
SLACK = 0.02
#: Least number of shards, and pieces of a class that a shard has at most, about.
SHARDS, IN_SHARD = 1024, 1 << 14
#: Counts of classes and shards up to this many are broadcast (about 40 MB).
BROADCAST_COUNTS = 1_000_000


def most_left_over(capacity: int) -> int:
    """Upper bound of the pieces that fill no sequence: the sum of k - 1 over the classes."""
    return sum({capacity // r for r in range(1, capacity + 1)})


def cut(n: int, capacity: int = CAPACITY, slack: float = SLACK) -> list[int]:
    """Lengths of the pieces of a document of ``n`` ids, in order."""
    pieces = [capacity] * (n // capacity)
    rest = n % capacity
    while rest:
        k = capacity // rest
        first = rest if capacity - k * rest <= slack * capacity else capacity // (k + 1)
        pieces.append(first)
        rest -= first
    return pieces


# Fixed value: the steps before the merges that WordIds takes itself.
STEPS = {
    "normalizer": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
    "pattern": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
}
#: No white space, controls or combining marks: what these steps do to such characters is the same in every library.
_PLAIN = regex.compile(r"[!-~\u00a1-\u024f]+")


class WordIds(dict):
    """Ids, as little-endian bytes, of what stands between ASCII spaces; the tokenizer drops white space, so that words don't affect each other.

    Plain words go to the tokenizer's merges at once if its steps before them are ``STEPS``;
    other words, and those that hold a special string, take the tokenizer's whole way. Of the
    words known before the last ``limit`` only those that come again are kept.
    """

    def __init__(self, tokenizer, limit: int = 500_000):
        self.tokenizer, self.limit = tokenizer, limit
        self.old: dict[bytes, bytes] = {}
        spec = json.loads(tokenizer.to_str())
        steps = {
            "normalizer": (spec["normalizer"] or {}).get("normalizers"),
            "pattern": next((p["pattern"].get("Regex") for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", ()) if p["type"] == "Split"), None),
        }
        self.direct = steps == STEPS
        self.parts = regex.compile(STEPS["pattern"]).findall
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.spelled = {b: c for c, b in byte_alphabet().items()}

    def learn(self, words: set[bytes]) -> None:
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()
        new = words.difference(self)
        known = new.intersection(self.old)
        self.update(zip(known, map(self.old.__getitem__, known)))
        merged, others = self.tokenizer.model.tokenize, []
        for w in new - known:
            s = w.decode()
            if not self.direct or not _PLAIN.fullmatch(s) or any(x in s for x in self.special):
                others.append(w)
                continue
            s = s.lower()
            ids = [t.id for p in ((s,) if w.isalpha() else self.parts(s)) for t in merged(p if p.isascii() else p.encode().decode("latin-1").translate(self.spelled))]
            self[w] = struct.pack(f"<{len(ids)}I", *ids)
        for w, e in zip(others, self.tokenizer.encode_batch_fast([w.decode() for w in others], add_special_tokens=False)):
            self[w] = np.array(e.ids, "<u4").tobytes()


@lru_cache(maxsize=2)
def word_ids(tokenizer_path: str) -> WordIds:
    """One a Python worker, whichever tasks it runs."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    ids = WordIds(tokenizer)
    if not ids.direct:
        raise ValueError(f"{tokenizer_path}: words can't be told to be independent of each other")
    return ids


def token_pieces(docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = CAPACITY, slack: float = SLACK) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = word_ids(tokenizer_path)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):  # a few documents' words at a time
                part = [t.split() for t in batch.column(1).slice(at, 1024).to_pylist()]
                ids_of.learn(set().union(*part))
                out: list[tuple] = []
                for i, words in enumerate(part, at):
                    ids = b"".join([*map(ids_of.__getitem__, words), end])
                    start = 0
                    for n in cut(len(ids) // 4, capacity, slack):
                        out.append((i, start, n, zlib.crc32(ids[4 * start : 4 * (start + n)]), len(ids) // 4))
                        start += n
                i, start, n, crc, total = (pa.array(x, pa.int64()) for x in zip(*out))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(i), start, n, crc, total], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select("doc_id", text_bytes().alias("text")).mapInArrow(made, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def first_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, longest first, each in the first bin with room."""
    bins, offsets, room = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), np.zeros(0, np.int64)
    for i in np.argsort(-lengths, kind="stable"):
        fits = np.flatnonzero(room >= lengths[i])
        if not len(fits):
            room = np.append(room, capacity)
            fits = [len(room) - 1]
        bins[i], offsets[i] = fits[0], capacity - room[fits[0]]
        room[fits[0]] -= lengths[i]
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to ``pieces(doc_id, start, length, ...)``."""
    columns = [*pieces.columns, "sequence_id", "offset"]
    pieces = written(pieces.withColumn("k", F.floor(F.lit(capacity) / F.col("length"))).withColumn("tag", F.monotonically_increasing_id()), "pieces")
    # By the written tag, so that copies and rows without an id are spread too.
    pieces = pieces.withColumn("shard", F.pmod(F.xxhash64("tag"), F.lit(max(SHARDS, pieces.count() // IN_SHARD))))
    counts = pieces.groupBy("k", "shard").agg(F.count("*").alias("n"))
    before = Window.partitionBy("k").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("k", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"), F.sum("n").over(Window.partitionBy("k")).alias("of"))
    counts = written(counts, "shards")
    nth = F.row_number().over(Window.partitionBy("k", "shard").orderBy("doc_id", "start", "tag"))
    numbered = pieces.withColumn("nth", nth - 1).join(F.broadcast(counts) if small_enough(counts, BROADCAST_COUNTS) else counts, ["k", "shard"]).withColumn("nth", F.col("first") + F.col("nth"))
    numbered = numbered.withColumn("bin", F.floor(F.col("nth") / F.col("k")))
    numbered = written(numbered.withColumn("left_over", (F.col("bin") + 1) * F.col("k") > F.col("of")).drop("shard", "first", "of", "tag"), "numbered")

    discard(pieces, counts)

    earlier = Window.partitionBy("k", "bin").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    # Class numbers take the high bits; class 0 is what was left over.
    filled = numbered.filter("NOT left_over").withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0)))
    filled = filled.withColumn("sequence_id", F.col("k") * F.lit(1 << 48) + F.col("bin"))
    rest = numbered.filter("left_over")

    def fitted(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "start", "nth"], ascending=[False, True, True, True]).reset_index(drop=True)
        pdf["sequence_id"], pdf["offset"] = first_fit(pdf["length"].to_numpy(), capacity)
        return pdf[columns]

    filled = filled.select(*columns)
    rest = rest.withColumn("together", F.lit(0)).groupBy("together").applyInPandas(fitted, filled.schema)
    return filled.unionByName(rest)


def harmonic_packing(docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = CAPACITY, slack: float = SLACK) -> DataFrame:
    """Every document of ``docs(doc_id, text)`` cut and packed into sequences of ``capacity`` ids."""
    return pack(token_pieces(docs, tokenizer_path, end_id, capacity, slack), capacity)


