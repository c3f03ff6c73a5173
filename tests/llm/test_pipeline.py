"""The stages of corpus_pipeline on small tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

import corpus_pipeline
from forkwise.llm import pii, quality_classifier, quality_rules

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 9))) for _ in range(n))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], SCHEMA)


def test_classifier_learns_from_documents_that_the_rules_dropped(spark, tmp_path):
    good = [(i, ". ".join(words(12, i + j) for j in range(8))) for i in range(0, 80, 2)]
    bad = [(i, "$$$ BUY | NOW !!! " * 30) for i in range(1, 80, 2)]
    passed = [(1001, "$$$ BUY | NOW !!! " * 25), (1003, "$$$ BUY | NOW !!! " * 35), (1002, ". ".join(words(11, 500 + j) for j in range(9)))]
    frame(spark, [*good, *bad, *passed]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(80)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = {r.doc_id for r in corpus_pipeline.classifier(spark, frame(spark, [*good, *passed]), str(tmp_path)).collect()}
    assert not kept & {1001, 1003} and 1002 in kept and len(kept & {i for i, _ in good}) >= 36


# --- a brute-force version of the stages ------------------------------------------

BUCKETS, SCALE = 1 << 16, 1 << 20


def split(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def buckets(text):
    h = [int(hashlib.md5(w.encode()).hexdigest()[:8], 16) for w in split(text)]
    return [x % BUCKETS for x in h] + [(x * 31 + y + 7) % BUCKETS for x, y in zip(h, h[1:])]


def passes_rules(rows, trusted):
    raw, good = Counter(), Counter()
    for i, text in rows:
        for b in buckets(text):
            raw[b] += 1
            good[b] += i in trusted
    r, g = sum(raw.values()), sum(good.values())
    weight = {b: round((math.log((good[b] + 1) / (g + BUCKETS)) - math.log((n + 1) / (r + BUCKETS))) * SCALE) if g else 0 for b, n in raw.items()}
    out = []
    for row in rows:
        w = split(row[1])
        windows = Counter(tuple(w[j : j + 5]) for j in range(len(w) - 4))
        repeated = {p for j in range(len(w) - 4) if windows[tuple(w[j : j + 5])] > 1 for p in range(j, j + 5)}
        mine = buckets(row[1])
        if len(w) >= 10 and 100 * len(repeated) <= 20 * len(w) and sum(weight[b] for b in mine) >= quality_rules.THRESHOLD * len(mine):
            out.append(row)
    return out


def passes_classifier(rows, every, labels):
    chosen = {i: q for i, q in labels.items() if zlib.crc32(str(i).encode()) % 3 != 1}
    x = sorted((i, quality_classifier.features((t or "").encode()).tolist()) for i, t in every if i in chosen)
    ranker = quality_classifier.fit(np.array([f for _, f in x]), np.array([chosen[i] for i, _ in x]))
    return [r for r in rows if ranker.scores(quality_classifier.features((r[1] or "").encode())[None])[0] >= 0.5]


def one_of_each_group(rows, k=5, t=80):
    def shingles(text):
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in split(text)]
        return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()

    sets, group = [shingles(r[1]) for r in rows], list(range(len(rows)))
    again = True
    while again:
        again = False
        for a in range(len(rows)):
            for b in range(a):
                if group[a] != group[b] and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= t * len(sets[a] | sets[b]):
                    group[a] = group[b] = min(group[a], group[b])
                    again = True
    best = {}
    for j, (i, _) in enumerate(rows):
        best.setdefault(group[j], []).append(((i is None, i or 0), j))
    return [rows[min(x)[1]] for x in best.values()]


BASE = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
)


def base_spans(text):
    def fits(kind, s):
        d = re.sub("[^0-9]", "", s)
        if kind == 1:
            return all(int(p) <= 255 for p in s.split("."))
        if kind == 2:
            return 12 <= len(d) <= 19 and sum(sum(map(int, str(int(c) * (1 + i % 2)))) for i, c in enumerate(reversed(d))) % 10 == 0
        return kind == 0 or 9 <= len(d) <= 15

    return sorted((m.start(), kind, m.end()) for kind, pattern in enumerate(BASE) for m in re.finditer(pattern, text, re.A) if fits(kind, m[0]))


VOCABULARY = sorted(set(words(80, 1).split()))


def prose(n, seed):
    return " ".join(random.Random(seed).choices(VOCABULARY, k=n))


def corpus():
    """Good, bad, odd, repeated and nearly equal rows, with ids that are null or that others have too."""
    common = [prose(12, 70_000 + j) for j in range(10)]
    good = [(i, ". ".join([*(prose(12, 100 * i + j) for j in range(8)), common[i // 2 % 10], common[(i // 2 + 3) % 10]])) for i in range(0, 120, 2)]
    bad = [(i, "$$$ BUY | NOW !!! " * (20 + i % 9)) for i in range(1, 80, 2)]
    copies = [(300 + i, good[i][1]) for i in range(4)] + [(310 + i, good[i][1].replace("a", "b", 1)) for i in range(5)]
    odd = [(400, None), (401, ""), (402, " \n\t "), (403, "few words"), (None, "few words"), (None, None)]
    same_id = [(2, ". ".join(prose(12, 9000 + j) for j in range(8))), (2, good[1][1]), (2, good[1][1])]
    mixture = ". ".join(common)
    nameless = [(None, good[20][1]), (None, mixture), (None, mixture), (None, "$$$ BUY | NOW !!! " * 30)]
    personal = [(500 + i, ". ".join([*(prose(12, 5000 + 100 * i + j) for j in range(7)), f"Mail bob.{i}@example.com or call +1 (415) 555-26{10 + i} from 10.0.0.{i} with 4111 1111 1111 1111 now"])) for i in range(6)]
    return [*good, *bad, *copies, *odd, *same_id, *nameless, *personal], {**{i: 1 for i, _ in good}, **{i: 0 for i, _ in bad}, **{i: 1 for i, _ in [*personal, *copies]}}


def shown(rows):
    return sorted((str(i), str(t)) for i, t in rows)


def test_stages_against_brute_force(spark, tmp_path):
    rows, labels = corpus()
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(labels.items()), "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, want = spark.read.parquet(f"{tmp_path}/documents.parquet"), rows
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "quality_classifier", "jaccard_join", "pii", "packing"]

    def step(name):
        stages[name](spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    docs, want = step("quality_rules"), passes_rules(rows, {i for i, q in labels.items() if q})
    assert shown((r.doc_id, r.text) for r in docs.collect()) == shown(want) and docs.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    assert {i for i, _ in want} >= {500, 2, None} and not {i for i, _ in want} & {400, 401, 402, 403}
    docs, want = step("quality_classifier"), passes_classifier(want, rows, labels)
    assert shown((r.doc_id, r.text) for r in docs.collect()) == shown(want)
    assert not any((t or "").startswith("$$$") for _, t in want)
    docs, want = step("jaccard_join"), one_of_each_group(want)
    assert shown((r.doc_id, r.text) for r in docs.collect()) == shown(want)
    assert sum(i == 2 for i, _ in want) == 2 and sum(i is None for i, _ in want) == 1

    tagger = pii.train(docs)
    docs = step("pii")
    clean = []
    for i, text in want:
        base = base_spans(text)
        assert base == pii.base_spans(text)
        clean.append((i, pii.redacted(text, base + pii.added_spans([text], [base], tagger)[0])))
    assert shown((r.doc_id, r.text) for r in docs.collect()) == shown(clean)
    assert all(r.n_chars == len(r.text) for r in docs.collect()) and not any("example.com" in t or "4111" in t for _, t in clean)
    docs = step("packing")

    from tokenizers import Tokenizer

    import public_tokenizers

    t = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    ids = sorted((str(i), len(t.encode(text, add_special_tokens=False).ids) + 1) for i, text in clean)
    packed = docs.collect()
    by_id = Counter()
    for r in packed:
        by_id[str(r.doc_id)] += r.length
    total = Counter()
    for i, n in ids:
        total[i] += n
    assert by_id == total
    held = Counter()
    for r in packed:
        held[r.sequence_id] += r.length
    assert max(held.values()) <= 2048
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(packed)


def test_stages_take_empty_tables(spark, tmp_path):
    frame(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
