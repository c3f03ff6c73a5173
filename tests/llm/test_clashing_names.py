"""Extra columns that are named as what the operators add or use within."""

from __future__ import annotations

import pytest

pytest.importorskip("public_tokenizers")

from forkwise.llm import bpe, packing, token_counts
from forkwise.llm.queries import tokenizer

TEXTS = [(1, "some words of a text"), (2, None), (None, "a null id"), (1, "some words of a text"), (3, "")]
EXTRA = "start long, length long, ids string, shard int, k int, n_tokens string, n_bytes long, sequence_id string, offset string, decoded int, doc_tokens int, ids_crc32 string"


def pair(spark):
    """The same rows with and without such columns."""
    schema = "doc_id long, text string"
    extra = (7, 8, "x", 9, 3, "n", 4, "s", "o", 1, 2, "c")
    return spark.createDataFrame(TEXTS, schema), spark.createDataFrame([(*r, *extra) for r in TEXTS], f"{schema}, {EXTRA}")


def rows(df):
    return sorted(map(repr, df.collect()))


def test_packing(spark):
    plain, clashing = pair(spark)
    path = tokenizer("word_bpe_49k.json")
    assert rows(packing.harmonic_packing(plain, path).drop("sequence_id", "offset")) == rows(packing.harmonic_packing(clashing, path).drop("sequence_id", "offset"))


def test_encoding_and_counting(spark):
    plain, clashing = pair(spark)
    path = tokenizer("byte_bpe_50k.json")
    assert rows(bpe.decode(bpe.encode(plain, path), path)) == rows(bpe.decode(bpe.encode(clashing, path), path))
    assert rows(token_counts.token_counts(plain, path)) == rows(token_counts.token_counts(clashing, path))
