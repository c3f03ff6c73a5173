"""Links that no pivot finds: pairs between components, which only the merged lists show."""

from __future__ import annotations

import random

import pytest

from forkwise.llm import jaccard_join as J


def test_meetings_of_both_directions_are_added(spark):
    """x (1) and y (11) meet in ten lists; in five of them x's component is the largest, in five y's."""
    rows = []
    for h in range(10):
        more = (2, 3) if h < 5 else (12, 13)
        rows += [(h, sid, 100, 0, 0, 1, 1 if sid < 10 else 11, 4) for sid in (1, 11, *more)]
    lists = spark.createDataFrame(rows, "h long, sid long, n long, m1 long, m2 long, weight long, component long, size long")
    assert J.least_met(100, 100, 85) == 8
    assert {(r.a, r.b) for r in J.heap_pairs(lists, 85).collect()} == {(1, 11)}


def brute(docs, k, t):
    sets = {i: set(zip(*(w[j:] for j in range(min(k, len(w)))))) for i, w in docs.items()}
    parent = {i: i for i in docs}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in docs:
        for b in docs:
            if a < b:
                both = len(sets[a] & sets[b])
                if 100 * both >= t * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
    return {i: root(i) for i in docs}


@pytest.mark.parametrize("k, t", [(1, 85), (4, 85), (5, 80)])
def test_random_chains_of_groups(spark, k, t, monkeypatch):
    """Chains in which neighbours are alike and others aren't; enough pairs are left to the merged lists for it to matter."""
    rng, docs, n = random.Random(k), {}, 0
    for chain in range(14):
        words = [f"c{chain}w{i}" for i in range(90)]
        rng.shuffle(words)
        for _ in range(rng.randint(2, 7)):
            for _ in range(rng.choice([1, 1, 3])):  # near copies of a link of the chain
                own = list(words)
                if rng.random() < 0.5:
                    own[rng.randrange(len(own))] = f"x{n}"
                docs[n], n = own, n + 1
            first = rng.randrange(90 - 14)
            for j in range(first, first + rng.randint(2, {1: 9}.get(k, 7))):  # a run of words that changes few shingles
                words[j] = f"n{n}w{j}"
    found = []
    known = J.heap_pairs
    monkeypatch.setattr(J, "heap_pairs", lambda lists, t: (found.append(None), known(lists, t))[1])
    table = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string").repartition(4)
    for rounds in (0, J.ROUNDS):  # without pivots all links are left to the lists
        monkeypatch.setattr(J, "ROUNDS", rounds)
        got = {r.doc_id: r.component_id for r in J.jaccard_components(table, k, t).collect()}
        assert got == brute(docs, k, t)
    assert len(found) == 2 and 14 <= len(set(brute(docs, k, t).values())) < n
