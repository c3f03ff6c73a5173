"""The ten operators against libraries, brute force and round trips, edge cases included."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from forkwise.llm import bpe, jaccard_join, license_scan, neighbours, packing, pii, quality_classifier, quality_rules, token_counts, warc
from forkwise.llm.common import new_folder

public_tokenizers = pytest.importorskip("public_tokenizers")

SCHEMA = "doc_id long, text string, key string, count long"
ODD = [(0, None), (1, ""), (2, "   \n\t "), (3, "a"), (None, "null id  here"), (4, "it's  1,234 <|endoftext|> über naïve 漢字 \r\n end "), (5, "x" * 3000), (5, "x" * 3000)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 1) for r in rows], SCHEMA)


def words(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 9))) for _ in range(n))


def library(name):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(str(public_tokenizers.path(name)))
    t.no_truncation()
    t.no_padding()
    return t


def test_bpe_and_counts(spark):
    rows = [*ODD, (9, words(20_000, 1)), (10, "word" * 20_000)]
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    t = library("byte_bpe_50k.json")
    want = sorted((str(i), e.ids, t.decode(e.ids, skip_special_tokens=False)) for i, e in zip((r[0] for r in rows), t.encode_batch([r[1] or "" for r in rows], add_special_tokens=False)))
    got = bpe.decode(bpe.encode(frame(spark, rows), path), path).collect()
    assert sorted((str(r.doc_id), r.ids, r.decoded) for r in got) == want
    for chunk, overlap in ((token_counts.CHUNK, token_counts.OVERLAP), (60, 4)):
        counts = token_counts.token_counts(frame(spark, rows), path, chunk, overlap).collect()
        assert sorted((str(r.doc_id), r.n_tokens) for r in counts) == sorted((i, len(x)) for i, x, _ in want)
    assert bpe.encode(frame(spark, []), path).count() == token_counts.token_counts(frame(spark, []), path).count() == 0


def test_spliced_counts():
    """Chunks and overlaps so small that boundaries are often missing, in texts of odd white space, scripts and special strings."""
    t = library("byte_bpe_50k.json")
    rng = random.Random(6)
    parts = [" ", "  ", "\n", " \t ", "word", "naïve", "漢字", "it's", "<|endoftext|>", "e\u0301", "\u00a0", "\u3000", "12,345", "!!", "🙂", "x" * 40]
    for _ in range(300):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 80)))
        want = len(t.encode(text, add_special_tokens=False))
        for chunk, overlap in ((8, 2), (20, 6), (64, 16)):
            assert token_counts.spliced_count(lambda p: t.encode(p, add_special_tokens=False), text, chunk, overlap) == want, text


def test_packing(spark):
    rows = [*ODD, *((100 + i, words(10 + 37 * i % 900, i)) for i in range(60)), (500, words(5000, 7))]
    path = str(public_tokenizers.path("word_bpe_49k.json"))
    got = packing.harmonic_packing(frame(spark, rows), path).collect()
    t = library("word_bpe_49k.json")
    ids = {r[0]: np.array([*t.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4") for r in rows}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) and r.doc_tokens == len(ids[r.doc_id])
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    copies = {i: sum(r[0] == i for r in rows) for i in ids}
    assert {i: sum(n for _, n in p) for i, p in pieces.items()} == {i: len(x) * copies[i] for i, x in ids.items()}
    for s in sequences.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= 2048
    assert packing.harmonic_packing(frame(spark, []), path).count() == 0


def test_word_ids():
    t = library("word_bpe_49k.json")
    texts = ["It's  DON'T Straße. ÀÉî,ç!? İx Σας ΑΣ e\u0301t H\u0331 \u0085a\u00a0b x\x1cy a|b || <|endoftext|>. <|ENDOFTEXT|> 12a34 --''ss 漢字 \u212bK ﬁn", words(300, 8), words(300, 9).upper()]
    for limit in (0, 500_000):
        ids = packing.WordIds(t, limit)
        for text in [*texts, *texts]:
            split = text.encode().split()
            ids.learn(set(split))
            assert ids.direct and b"".join(map(ids.__getitem__, split)) == np.array(t.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    other = library("byte_bpe_50k.json")
    assert not packing.WordIds(other).direct


def test_quality_rules(spark):
    rows = [*ODD[:6], (20, "one two three four five six seven one two three four five\nagain\nagain\n#"), (21, words(300, 2))]
    for trusted in ([], [(21,)]):
        docs = frame(spark, rows)
        weights = quality_rules.bucket_weights(docs, spark.createDataFrame(trusted, "doc_id long"))
        assert any(weights) == bool(trusted)
        out = quality_rules.quality_rules(docs, weights)
        got = {r.doc_id: r for r in out.collect()}
        assert got[0].n_words == got[1].n_words == got[2].n_words == 0 and got[0].base_failed
        assert (got[20].n_repeat_words, got[20].n_dup_lines, got[20].n_symbols) == (10, 1, 1) and got[20].base_failed
        assert got[21].kept
        assert {r.doc_id for r in out.filter("kept").select("doc_id").collect()} == {i for i, r in got.items() if r.kept}


def test_quality_classifier(spark):
    good = [(i, ". ".join(words(12, i + j) for j in range(8))) for i in range(0, 80, 2)]
    bad = [(i, "$$$ BUY | NOW !!! " * 30) for i in range(1, 80, 2)]
    docs = frame(spark, [*good, *bad, *ODD])
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(60)], "doc_id long, quality int")
    scores = {r.doc_id: r.score for r in quality_classifier.classify(docs, quality_classifier.train(docs, labels)).collect()}
    assert all((scores[i] >= 0.5) == (i % 2 == 0) for i in range(60, 80))
    assert all(0 <= s <= 1 for s in scores.values())
    untaught = quality_classifier.train(docs, labels.filter("quality = 1"))
    assert {r.score for r in quality_classifier.classify(docs, untaught).collect()} == {0.5}


def test_jaccard_components(spark):
    rng = random.Random(3)
    rows = [(0, None), (1, ""), (2, "two words"), (3, "TWO  words"), (4, "other words")]
    for base in range(6):
        text = words(60, base).split()
        for _ in range(12):
            copy = list(text)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = "edit" + str(rng.random())
            rows.append((len(rows), " ".join(copy)))

    def shingles(t):
        w = (t or "").lower().split()
        return {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set()

    sets = {i: shingles(t) for i, t in rows}
    label = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
        if _ > 3:
            break
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(frame(spark, rows)).collect()}
    assert got == {i: (len(s), label[i]) for i, s in sets.items()}


def test_nearest(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 16)) + 3 * rng.normal(size=(20, 16))[rng.integers(0, 20, 1500)]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(2000, None), (2050, [0.0] * 16), (2100, [float("nan")] * 16), (2150, [None] * 16), (2200, x[0].tolist())]
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), sample=600, split=20).collect()
    v = {i: np.array(e) for i, e in rows if e is not None and None not in e and np.isfinite(e).all() and any(e)}
    names = np.array(sorted(v))
    u = np.array([v[i] / np.linalg.norm(v[i]) for i in names])
    found, true = defaultdict(set), {}
    for r in got:
        assert r.query_id != r.vec_id and abs(r.score - u[names == r.query_id][0] @ u[names == r.vec_id][0]) < 1e-9
        found[r.query_id].add(r.vec_id)
    for q in names[names % 50 == 0]:
        near = u @ u[names == q][0]
        near[names == q] = -2
        true[q] = set(names[np.argsort(-near, kind="stable")[:5]])
    assert set(found) == set(true) and all(len(f) == 5 for f in found.values())
    assert np.mean([len(found[q] & true[q]) / 5 for q in true]) >= 0.9
    assert neighbours.nearest(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


def test_nearest_ties_and_odd_rows(spark):
    """Parallel, repeated and huge vectors, few candidates, null ids and other lengths, against brute force."""
    rng = np.random.default_rng(4)
    base = rng.integers(-8, 9, size=8).astype(float)
    rows = [(0, base.tolist()), *((i, (base * 2.0 ** (i % 7 - 3)).tolist()) for i in range(1, 31)), (31, base.tolist()), (31, base.tolist()), (None, base.tolist()), (32, [1.0, 2.0])]
    rows += [(40 + i, rng.normal(size=8).tolist()) for i in range(20)]
    rows += [(100, [1e200, -1e200] + [0.0] * 6), (150, [1e-200, 2e-200] + [0.0] * 6)]
    schema = "vec_id long, embedding array<double>, key string, leaf long, dim long"
    data = spark.createDataFrame([(*r, "k", 1, 2) for r in rows], schema)
    exact = {}
    usable = sorted({(i, tuple(v)) for i, v in rows if i is not None and len(v) == 8})

    def cosine(a, b):
        a, b = (np.ldexp(np.array(x), -np.frexp(np.abs(x).max())[1]) for x in (a, b))
        return float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())))

    for q, v in usable:
        if q % 50 == 0:
            exact[q] = sorted((-cosine(v, w), i) for i, w in usable if i != q)[:5]
    got = defaultdict(list)
    for r in neighbours.nearest(data).orderBy("query_id", "rank").collect():
        got[r.query_id].append((-r.score, r.vec_id))
    assert {q: [i for _, i in x] for q, x in got.items()} == {q: [i for _, i in x] for q, x in exact.items()}
    assert [i for _, i in got[0]] == [1, 2, 3, 4, 5]
    assert all(abs(a - b) < 1e-12 for q in exact for (a, _), (b, _) in zip(got[q], exact[q]))
    few = neighbours.nearest(data.filter("vec_id IN (0, 1, 2)")).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in few) == [(0, 1, 1), (0, 2, 2)]


def test_visits_go_on_while_leaves_hold_too_few():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 6))
    tree = neighbours.fit(neighbours._unit(x))
    held = np.ones(tree.n_leaves, np.int64)
    for leaves in tree.visits(neighbours._unit(x[:20]), 1, held, 6):
        assert len(leaves) == len(set(leaves)) == 6
    assert all(sorted(v) == list(range(tree.n_leaves)) for v in tree.visits(neighbours._unit(x[:3]), 10**6))


def test_leaves_become_subtrees():
    """Leaves of a grown tree are numbered side by side, and vectors go to one that is near."""
    rng = np.random.default_rng(3)
    x = neighbours._unit(rng.normal(size=(4000, 8)))
    tree = neighbours.fit(x[:200])
    at = tree.assign(x)
    grown = tree.with_subtrees({leaf: neighbours.fit(x[at == leaf]) for leaf in range(0, tree.n_leaves, 2)})
    assert grown.n_leaves > tree.n_leaves and sorted(grown.leaf_of[grown.leaf_of >= 0]) == list(range(grown.n_leaves))
    assert all(len(kids) != 0 or leaf >= 0 for kids, leaf in zip(grown.children, grown.leaf_of))
    for t in (tree, grown):
        node = np.argsort(np.where(t.leaf_of < 0, 10**9, t.leaf_of))[: t.n_leaves]
        best = np.argmax(x @ t.centroids[node].T, axis=1)
        assert np.mean(t.assign(x) == best) > 0.8
        assert (t.assign(x, beam=10**6) == best).all()
        near = x[:50] @ t.centroids[node].T
        for row, leaves in zip(near, t.visits(x[:50], t.n_leaves)):
            assert (np.diff(row[leaves]) < 1e-7).all()  # by their own cosines, whatever stands above them


def test_warc_round_trip(spark):
    big = "<p>" + words(60_000, 5)
    rows = [(1, "http://a/ü", big), (2, None, big), (3, "http://b", None), (4, "u", "short"), (5, "u", "short"), (None, "u", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    back = warc.read_archives(warc.write_archives(warc.chunk_table(warc.records(pages), 1 << 12), new_folder(spark, "archives")), 1 << 12).collect()
    last = {r.page_id: r for r in back if r.last}
    assert {i: r.record_type for i, r in last.items()} == {1: "revisit", 2: "response", 3: "response", 4: "response", 5: "response", None: "revisit"}
    assert last[1].refers_to == 2 and last[2].sha1_so_far == hashlib.sha1(big.encode()).hexdigest()
    chunks = sorted((r.chunk_no, bytes(r.data)) for r in back if r.page_id == 2)
    assert b"".join(d for _, d in chunks) == big.encode() and max(len(d) for _, d in chunks) <= 1 << 12


def test_license_scan(spark):
    rows = [*ODD, (30, "some text\nLicensed under the Apache License, Version 2.0.\nmore"), (31, "This file is released under the MIT License. Bye"), (32, "a license to talk about nothing")]
    got = {r.doc_id: {m["license"] for m in r.matches} for r in license_scan.license_scan(frame(spark, rows)).collect()}
    assert got[30] == {"Apache-2.0"} and got[31] == {"MIT"} and not got[32] and not got[0]


def test_pii(spark):
    rows = [*ODD, (40, "mail bob.x@example.com or 10.0.0.1 card 4111 1111 1111 1111 now"), (41, "call +1 (415) 555-2671 or 300.1.1.1 " + words(40, 3))]
    docs = frame(spark, rows)
    tagger = pii.train(docs, 50)
    found = {r.doc_id: r for r in pii.find(docs, tagger).collect()}
    text = dict(rows)
    spans = {(pii.KINDS[s["kind"]], text[40][s["start"] : s["end"]]) for s in found[40].base}
    assert spans == {("email", "bob.x@example.com"), ("ip", "10.0.0.1"), ("card", "4111 1111 1111 1111")}
    assert {pii.KINDS[s["kind"]] for s in found[41].base} == {"phone"}
    assert found[0].base == found[0].added == []
    clean = {r.doc_id: r.text for r in pii.redact(docs, tagger).collect()}
    assert "example.com" not in clean[40] and clean[0] is None and not re.search("555-2671", clean[41])
