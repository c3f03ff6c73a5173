"""Token counts of whole texts by overlap resynchronisation.

A document longer than a chunk is encoded in overlapping chunks with offsets. Two
neighbouring chunks are spliced at a boundary in their overlap at which both begin a token
and which is proven stable: a single space between two characters that aren't white space
(see ``pieces``). Where the overlap holds none, it is widened, and where the whole chunk
holds none, the chunk is. So no more than a chunk, or as much of a document as has no
boundary, is encoded at a time. A document that fits into one chunk needs no splice; its
tokens are those of the pieces between its stable boundaries, of which a worker remembers
the counts.

Defined cases: null text is empty and has no tokens; a text without any boundary becomes one
chunk. Repeated rows and null ids each give a row; empty tables give empty results; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pieces import PieceCache, in_parts, stable_pieces

#: Characters.
CHUNK = 1 << 12
OVERLAP = 1 << 7

_STABLE = re.compile(r"(?<=\S) (?=\S)")


def token_from(encoding, at: int) -> int | None:
    """The token that starts at a character of what was encoded."""
    i = encoding.char_to_token(at)
    return i if i is not None and encoding.token_to_chars(i)[0] == at else None


def common_boundary(text: str, a, a_from: int, b, b_from: int, lo: int, hi: int) -> tuple[int, int, int] | None:
    """The stable boundary of ``text[lo:hi]`` nearest to its middle at which both chunks start a token, and these tokens."""
    middle = (lo + hi) // 2
    for p in sorted((m.start() for m in _STABLE.finditer(text, lo, hi)), key=lambda p: abs(p - middle)):
        i, j = token_from(a, p - a_from), token_from(b, p - b_from)
        if i is not None and j is not None:
            return p, i, j
    return None


def spliced_count(encode: Callable, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of ``text``; ``encode(part)`` gives a part's tokens with offsets."""
    total, begin, size = 0, 0, chunk
    spliced, first = 0, 0  # where the tokens of this chunk begin to count
    here = encode(text[:size])
    while (end := begin + size) < len(text):
        back = min(overlap, size)
        while True:
            after = encode(text[end - back : end - back + max(chunk, 2 * back)])
            found = common_boundary(text, here, begin, after, end - back, max(spliced, end - back) + 1, end - 1)
            if found or back == size:
                break
            back = min(2 * back, size)
        if found:
            total += found[1] - first
            begin, size, here = end - back, max(chunk, 2 * back), after
            spliced, first = found[0], found[2]
        else:
            size *= 2
            here = encode(text[begin : begin + size])
            first = token_from(here, spliced - begin) if spliced else 0
    return total + len(here) - first


@lru_cache(maxsize=2)
def loaded(path: str):
    """The library's tokenizer, and the counts of pieces seen so far; one a Python worker, whichever tasks it runs."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer, PieceCache(lambda texts: [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)])


def token_counts(docs: DataFrame, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every row of ``docs(doc_id, text)``, as the tokenizers library counts them."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, cache = loaded(path)

        def encode(part: str):
            return tokenizer.encode(part, add_special_tokens=False)

        for batch in batches:
            at = 0
            for part in in_parts([t or "" for t in batch.column(1).to_pylist()], 1 << 18):
                pieces = [stable_pieces(t) if len(t) <= chunk else [""] for t in part]
                cache.prepare(pieces)
                counts = [sum(cache.look_up(p)) if len(t) <= chunk else spliced_count(encode, t, chunk, overlap) for t, p in zip(part, pieces)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(part)), pa.array([len(t.encode()) for t in part], pa.int64()), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])
                at += len(part)

    return docs.select("doc_id", F.col("text")).mapInArrow(made, "doc_id long, n_bytes long, n_tokens long")
