"""The kinds' rules on whatever a network may tag."""

from __future__ import annotations

import random

import numpy as np

from forkwise.llm import pii


def test_valid_takes_any_string():
    rng = random.Random(4)
    for _ in range(20_000):
        s = "".join(rng.choice("0123456789.@/ab o:-+() ²٣é\n") for _ in range(rng.randint(0, 20)))
        for kind in pii.KINDS:
            assert pii.valid(kind, s) in (True, False)
    assert not any(pii.valid("ip", s) for s in ("", "7", "1.2", "o", "2.0b", "10.0.0.0/8", "1.2.3.4.5", "1.2.3.256", "1..2.3", "²5.1.1.1"))
    assert pii.valid("ip", "10.0.0.1") and pii.valid("ip", "010.000.00.0255")
    assert not any(pii.valid("email", s) for s in ("@", "@a1b2", "a@", "3 @ 4.50", "a@b@c.de"))
    assert all(pii.valid("email", s) for s in ("bob.x@example.com", "bób@příklad.cz", "bob @ example.com"))
    assert not pii.valid("card", "4111 words 1111 1111 1111") and pii.valid("card", "4111.1111.1111.1111")
    assert not pii.valid("phone", "in 415 and 555 of 2671") and all(pii.valid("phone", s) for s in ("(415) 555-2671", "415.555.2671", "001 (415)555-2671"))
    for kind in range(len(pii.KINDS)):
        assert all(pii.valid(pii.KINDS[kind], pii._generated(kind, np.random.default_rng(i))) for i in range(300))


class TagsAllAsIp:
    def tags(self, chars):
        tags = np.full(chars.shape, 4)
        tags[0] = 0
        tags[1] = 3
        return tags


def test_mistagged_text_adds_nothing():
    texts = [" 10.0.0.0/8 ", " o1", " version 1.2 ", " 7 "]
    assert pii.added_spans(texts, [[] for _ in texts], TagsAllAsIp()) == [[], [], [], []]


def missed(windows):
    """Windows with the spans that the base patterns don't find."""
    return [(t, {(a, k, b) for a, k, b in spans if not any(x < b and a < y for x, _, y in pii.base_spans(t))}) for t, spans in windows]


def test_added_spans_of_held_out_windows(spark):
    """Precision and recall of added spans in generated windows of another seed and other words."""
    rng = random.Random(2)
    text = " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 9))) for _ in range(300))
    docs = spark.createDataFrame([(i, f"{text[i * 7:i * 7 + 200]} v{i}.2 on 2024-0{i % 9 + 1}-11 by bob{i}@mail.example.org, call +1 415 555 26{i:02d}") for i in range(99)], "doc_id long, text string")
    tagger = pii.train(docs)
    held_out = missed(pii.generated_windows("some quite other words stand here".split(), 600, seed=99))
    texts = [t for t, _ in held_out]
    base = [pii.base_spans(t) for t in texts]
    added = pii.added_spans(texts, base, tagger)
    right = sum(len(set(a) & w) for a, (_, w) in zip(added, held_out))
    wanted, found = sum(len(w) for _, w in held_out), sum(map(len, added))
    assert wanted > 50
    print(f"added spans: recall {right / wanted:.3f}, precision {right / found:.3f} of {wanted} and {found}")
    assert right >= 0.85 * wanted and right >= 0.9 * found

    # Texts that fit into one window: decoded whole, without windows, they give the same.
    for t, own, got in zip(texts, base, added):
        spans = []
        for s, kind, e in pii.spans_in(brute_force_tags(tagger, t)):
            if pii.valid(pii.KINDS[kind], t[s:e]) and any(c.isdigit() or c == "@" for c in t[s:e]):
                spans.append((s, kind, e, float(e - s)))
        assert len(t) <= pii.WINDOW
        whole = [x for x in pii.reconcile(spans) if not any(x[0] < e and b < x[2] for b, _, e in own)]
        if len(pii.windows_of(t)) == 1 and pii.windows_of(t)[0] == (0, len(t)):
            assert got == whole, t


def brute_force_tags(tagger, text):
    """Best tags of a whole text, by a plain dynamic program over one character after another."""
    chars = np.full(pii.WINDOW, pii.PAD)
    chars[: len(text)] = pii.char_classes(text)
    e, trans = tagger.emissions(chars[:, None])[0][:, 0], tagger.p["trans"] + pii.MASK
    paths = {k: (e[0][k] + trans[-1][k], [k]) for k in range(pii.N_TAGS)}
    for row in e[1:]:
        paths = {k: max(((s + trans[j][k] + row[k], [*p, k]) for j, (s, p) in paths.items()), key=lambda x: x[0]) for k in range(pii.N_TAGS)}
    return np.array(max(paths.values(), key=lambda x: x[0])[1])[: len(text)]


def test_odd_rows(spark):
    """Clashing columns, null ids, repeated rows, long runs of digits and empty tables."""
    schema = "doc_id long, text string, base string, start int"
    rows = [(None, "mail a.b@example.org", "k", 1), (1, "7" * 50_000, "k", 1), (1, "7" * 50_000, "k", 1), (2, None, "k", 1), (3, "x 10.1.2.3 " * 3000, "k", 1), (4, "", "k", 1)]
    docs = spark.createDataFrame(rows, schema)
    tagger = pii.fit(pii.generated_windows(["word"], 60), steps=3)
    found = pii.find(docs, tagger).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in rows)
    spans = {r.doc_id: r.base for r in found}
    assert len(spans[None]) == 1 and len(spans[3]) == 3000 and not spans[1] and not spans[2] and not spans[4]
    clean = pii.redact(docs, tagger)
    assert clean.columns == docs.columns and {r.text for r in clean.collect() if r.doc_id is None} == {"mail <EMAIL>"}
    assert pii.find(docs.limit(0), tagger).count() == pii.redact(docs.limit(0), tagger).count() == 0
    assert pii.train(docs.limit(0), 10).tags(pii.char_classes("a 1")[:, None]).shape == (3, 1)
