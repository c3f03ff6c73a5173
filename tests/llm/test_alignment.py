"""Alignment of two tokenizers against loops over all pairs of tokens."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from forkwise.llm import alignment
from forkwise.llm.queries import tokenizer

A, B = tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    chars = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of_char = {chr(c): c for c in chars} | {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in chars)}

    def spelled(text):
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        piece = lambda p: bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("\u2581", " ").encode()
        return [(i, bytes(of_char[c] for c in a.id_to_token(i))) for i in ids_a], [(i, piece(b.id_to_piece(i))) for i in ids_b]

    return spelled


def spans(tokens):
    at, out = 0, []
    for i, said in tokens:
        out.append((i, at, at + len(said)))
        at += len(said)
    return out


def plain_version(rows, library):
    counts, docs = Counter(), []
    for doc_id, text in rows:
        a, b = library(text) if text else ([], [])
        if any(b"".join(x for _, x in t) != (" " + (text or "")).encode() for t in (a, b)):
            a = b = []
        a, b = spans(a), spans(b)
        links = [(x, y) for x, s, e in a for y, t, f in b if max(s, t) < min(e, f)]
        counts.update(links)
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups = [";".join(",".join(str(x) for x, s, e in t if lo <= s and e <= hi) for t in (a, b)).replace(";", "|") for lo, hi in zip([0, *ends], ends)]
        docs.append((doc_id, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    best = {}
    for (_, y), c in counts.items():
        best[y] = max(best.get(y, 0), c)
    return [(i, n, m, g, len(x), sum(counts[p] == best[p[1]] for p in x), sum(counts[p] for p in x), h) for i, n, m, g, x, h in docs]


TEXTS = [
    None, "", " ", "  ", "a", "The quick brown fox", "two  spaces   and more ", " leading", "tabs\tand\n newlines \n\n end", "special <|endoftext|> and </s> <s> <unk>",
    "caf\u00e9 na\u00efve \u4e2d\u6587\u5b57\u7b26 \U0001f600\U0001f468\u200d\U0001f469", "\u2581piece mark", "nul\x00 byte\x01", "\ufb01gure \u00c5 e\u0301", "a\x1c b\x85 c\u00a0 d\u2003 e", "number 12345.678 and's we'll", "\n x", "x \n", "\ufffd odd",
]


@pytest.mark.parametrize("broadcast_pairs", [1_000_000, 40, 1])
def test_against_all_pairs(spark, library, broadcast_pairs):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "The quick brown fox"), (5, "The quick brown fox")] + [(100 + i, "the same copy of a document") for i in range(9)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, pair int, groups_sha256 string").repartition(3)
    got = alignment.alignment(docs, A, B, broadcast_pairs)
    assert got.columns == list(COLUMNS)
    key = lambda r: str(r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain_version(rows, library), key=key)


def test_empty_table(spark):
    assert alignment.alignment(spark.createDataFrame([], "doc_id long, text string"), A, B).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from(list("ab The\u2581<|>s/\u00e9\u4e2d\n\t\x1c\x85\u00a0\u3000 ")), max_size=40))
def test_pieces_give_the_ids_of_the_whole(text):
    import numpy as np

    t = alignment.loaded(A, B)
    a, b = t.encode([text])
    whole_a, whole_b = t.a.encode(" " + text, add_special_tokens=False).ids, t.b.encode(text)
    if text:
        assert np.frombuffer(a[0], np.int32).tolist() == whole_a and np.frombuffer(b[0], np.int32).tolist() == whole_b


def test_long_text(spark, library):
    """A text longer than what is aligned together, next to short ones."""
    words = " ".join(f"w{i % 997}ord{'s' * (i % 3)}" for i in range(60_000))
    docs = spark.createDataFrame([(1, words), (2, "short"), (3, words[:50])], "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r for r in alignment.alignment(docs, A, B).collect()}
    a, b = map(spans, library(words))
    ends_a, ends_b = {e for *_, e in a}, {e for *_, e in b}
    assert (got[1].n_a, got[1].n_b, got[1].n_groups, got[1].n_links) == (len(a), len(b), len(ends_a & ends_b), len(ends_a | ends_b))
    assert got[2].n_a > 0 and got[3].n_groups > 0
