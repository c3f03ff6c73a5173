"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is fitted on a bounded sample (``sample`` vectors with the smallest hash), indexes
every vector and grows with the table: a leaf that holds more than ``split`` vectors becomes a
subtree, fitted in a task of its own on a bounded sample of the leaf's vectors. (From
``MAX_NODES`` nodes on leaves stay as they are and hold more.) A vector is placed by a walk
that keeps the ``BEAM`` nearest nodes of each level, as the nearest child is often not on the
way to the nearest leaf.

A query walks the tree best bin first: a priority queue holds leaves by the cosine of query and
centroid and inner nodes by the largest that a leaf below them can have, given the widest angle
between their centroid and those of their leaves; leaves are visited as they come out of it. How many leaves is calibrated: for up
to ``calibration`` queries the true neighbours are found by brute force over all vectors, and
the visits are widened until ``recall`` of them lie in visited leaves. A query whose leaves
hold too few vectors for ``k`` results visits further ones.

Queries and vectors meet by blocks of neighbouring leaves, of bounded size on both sides, so
that a query is sent once for each block and not for each leaf. Equal vectors are one entry
that keeps its ``k + 1`` smallest ids, which is all that a query can ask of it, so that a
vector repeated many times is compared once.

Neighbours of equal score come by their ids. Scores are compared after exact cosines are
taken; vectors are first scaled by powers of two, so that large and small components neither
overflow nor vanish and the result stays the same.

Defined cases: vectors that are null, zero, of another length than most of the sample or
that hold null or non-finite components take no part, and neither do null ids. Repeated rows
are one candidate. With fewer than ``k`` candidates a query gets all that are there. An empty
table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, slices, written

SAMPLE = 20_000
BRANCHES = 64
LEAF_SAMPLE = 16
SPLIT = 512
SPLIT_SAMPLE = 2048
MAX_NODES = 200_000
BEAM = 8
CALIBRATION = 200
RECALL = 0.95
BLOCK = 4096


@dataclass
class Tree:
    centroids: np.ndarray  # of all nodes, unit length; the root is row 0
    children: list[list[int]]
    leaf_of: np.ndarray  # leaf number of a node, -1 for others

    @property
    def n_leaves(self) -> int:
        return int(self.leaf_of.max()) + 1

    def assign(self, x: np.ndarray, beam: int = BEAM) -> np.ndarray:
        """Leaf of each unit vector: the nearest that a walk finds which keeps the ``beam`` nearest nodes of each level."""
        first = np.cumsum([0, *map(len, self.children)])
        kids = np.array([c for x in self.children for c in x], np.int64)
        row, node = np.arange(len(x)), np.zeros(len(x), np.int64)
        near = np.full(len(x), -2.0)
        while (inner := self.leaf_of[node] < 0).any():
            width = np.where(inner, first[node + 1] - first[node], 1)
            at = np.repeat(np.arange(len(node)), width)
            nth = np.arange(len(at)) - np.repeat(np.cumsum(width) - width, width)
            grow = inner[at]
            row, old = row[at], node[at]
            node, near = old.copy(), near[at]
            node[grow] = kids[first[old[grow]] + nth[grow]]
            near[grow] = np.einsum("ij,ij->i", x[row[grow]], self.centroids[node[grow]])
            order = np.lexsort((node, -near, row))
            row, node, near = row[order], node[order], near[order]
            kept = np.arange(len(row)) - np.searchsorted(row, row) < beam
            row, node, near = row[kept], node[kept], near[kept]
        return self.leaf_of[node[np.searchsorted(row, np.arange(len(x)))]]

    @cached_property
    def spread(self) -> np.ndarray:
        """The widest angle between a node's centroid and those of the leaves below it."""
        parent, spread = np.zeros(len(self.children), np.int64), np.zeros(len(self.children))
        for node, kids in enumerate(self.children):
            parent[kids] = node
        leaves = np.flatnonzero(self.leaf_of >= 0)
        at = parent[leaves]
        while len(at):
            angle = np.arccos(np.clip((self.centroids[at] * self.centroids[leaves]).sum(1), -1, 1))
            np.maximum.at(spread, at, angle)
            leaves, at = leaves[at != 0], parent[at[at != 0]]
        return spread

    def nearness(self, x: np.ndarray) -> np.ndarray:
        """Of each unit vector the cosine with each leaf, and for inner nodes the largest that a leaf below can have."""
        near = np.clip(x @ self.centroids.T, -1, 1)
        inner = self.leaf_of < 0
        near[:, inner] = np.cos(np.maximum(np.arccos(near[:, inner]) - self.spread[inner], 0))
        return near

    def walk(self, near: np.ndarray) -> Iterator[int]:
        """Leaves best bin first, for a query of ``nearness`` near: as inner nodes stand for the best that is below, leaves come by their own cosines."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if self.leaf_of[node] >= 0:
                yield int(self.leaf_of[node])
            for c in self.children[node]:
                heapq.heappush(queue, (-near[c], c))

    def visits(self, x: np.ndarray, n: int, held: np.ndarray | None = None, least: int = 0) -> list[list[int]]:
        """The first ``n`` leaves of each unit vector, best bin first, and further ones while they hold fewer than ``least``."""
        out = []
        for near in self.nearness(x):
            found, n_held = [], 0
            for leaf in self.walk(near):
                found.append(leaf)
                n_held += 0 if held is None else int(held[leaf])
                if len(found) >= n and n_held >= least:
                    break
            out.append(found)
        return out

    def with_subtrees(self, subtrees: dict[int, Tree]) -> Tree:
        """Leaves replaced by trees; leaves are numbered anew, neighbours side by side."""
        centroids, children = [self.centroids], [list(c) for c in self.children]
        for leaf, sub in subtrees.items():
            at, shift = int(np.flatnonzero(self.leaf_of == leaf)[0]), len(children) - 1
            children[at] = [c + shift for c in sub.children[0]]
            children += [[c + shift for c in kids] for kids in sub.children[1:]]
            centroids.append(sub.centroids[1:])
        return Tree(np.concatenate(centroids), children, numbered(children))


def numbered(children: list[list[int]]) -> np.ndarray:
    leaf_of, todo, n = np.full(len(children), -1), [0], 0
    while todo:
        node = todo.pop()
        todo += children[node]
        if not children[node]:
            leaf_of[node] = n
            n += 1
    return leaf_of


def k_means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Group of each row of ``x`` by spherical k-means."""
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    group = np.zeros(len(x), np.int64)
    for _ in range(rounds):
        group = np.argmax(x @ centres.T, axis=1)
        for g in range(len(centres)):
            total = x[group == g].sum(0)
            if (size := np.linalg.norm(total)) > 1e-12:
                centres[g] = total / size
    return group


def fit(x: np.ndarray, branches: int = BRANCHES, leaf_sample: int = LEAF_SAMPLE, seed: int = 11) -> Tree:
    """Tree over unit vectors."""
    rng = np.random.default_rng(seed)
    centroids, children = [np.zeros(x.shape[1])], [[]]
    todo = [(0, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        groups = k_means(x[rows], branches, rng) if len(rows) > leaf_sample else np.zeros(len(rows), np.int64)
        kinds = np.unique(groups)
        if len(kinds) < 2:
            continue
        for g in kinds:
            total = x[rows[groups == g]].sum(0)
            centroids.append(total / max(np.linalg.norm(total), 1e-12))
            children.append([])
            children[node].append(len(centroids) - 1)
            todo.append((len(centroids) - 1, rows[groups == g]))
    return Tree(np.array(centroids), children, numbered(children))


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows multiplied by a power of two, so that the largest component is between 1/2 and 1."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None])


def _unit(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return x / np.linalg.norm(x, axis=1)[:, None]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision; equal rows give equal results wherever they stand."""
    a, b = _scaled(a), _scaled(b)
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


def best_of(a: np.ndarray, b: np.ndarray, first_ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row of ``a`` the ``n`` rows of ``b`` of largest cosine, ties by ``first_ids``: rows of a, rows of b, scores."""
    ua, ub, out = _unit(a), _unit(b).T, []
    for at in range(0, len(a), 256):
        near = ua[at : at + 256] @ ub
        # The product is exact but for rounding; what may reach the n-th best is compared exactly.
        least = np.partition(near, len(b) - n, axis=1)[:, len(b) - n] - 1e-9
        i, j = np.nonzero(near >= least[:, None])
        for part in range(0, len(i), 1 << 14):
            x, y = i[part : part + (1 << 14)] + at, j[part : part + (1 << 14)]
            out.append((x, y, cosines(a[x], b[y])))
    i, j, score = (np.concatenate(x) for x in zip(*out))
    order = np.lexsort((first_ids[j], -score, i))
    i, j, score = i[order], j[order], score[order]
    nth = np.arange(len(i)) - np.searchsorted(i, i)
    return i[nth < n], j[nth < n], score[nth < n]


def nearest(rows: DataFrame, query_every: int = 50, k: int = 5, sample: int = SAMPLE, split: int = SPLIT, recall: float = RECALL, calibration: int = CALIBRATION) -> DataFrame:
    """query_id, rank, vec_id and score for the queries, the rows of ``rows(vec_id, embedding)`` whose id ``query_every`` divides."""
    vector = F.transform(F.col("embedding").cast("array<double>"), lambda x: x + F.lit(0.0))
    usable = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.select("vec_id", vector.alias("v")).filter("vec_id IS NOT NULL AND v IS NOT NULL").filter(F.coalesce(usable, F.lit(False)))
    key = F.concat_ws(":", F.xxhash64("v").cast("string"), F.xxhash64("v", F.lit(1)).cast("string"))
    rows = written(rows.select("vec_id", "v", key.alias("key"), F.size("v").alias("dim")), "vectors")
    chosen = rows.dropDuplicates(["key"]).orderBy(F.xxhash64("key"), "key").limit(sample).select("v").toPandas()["v"]
    if not len(chosen):
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score"))
    sizes = chosen.map(len)
    dim = int(sizes.mode()[0])
    tree = fit(_unit(np.stack(chosen[sizes == dim].to_list())))
    rows = rows.filter(F.col("dim") == dim).drop("dim")

    # One entry for each different vector, with its smallest ids.
    nth = F.row_number().over(Window.partitionBy("key").orderBy("vec_id"))
    entries = rows.select("key", "vec_id", "v").dropDuplicates(["key", "vec_id"]).withColumn("nth", nth).filter(F.col("nth") <= k + 1)
    entries = entries.groupBy("key").agg(F.first("v").alias("v"), F.array_sort(F.collect_list("vec_id")).alias("ids"))

    tree, entries, held = placed(tree, written(entries.select("key", "v", "ids"), "entries"), dim, split)
    asked = rows.filter(F.col("vec_id") % query_every == 0).select("vec_id", "key", "v").dropDuplicates(["vec_id", "key"])
    queries = written(asked.dropDuplicates(["key"]).select("key", "v"), "queries")
    n_visits = visits_needed(entries, queries, tree, dim, k, recall, calibration)
    # Neighbouring leaves make blocks of about BLOCK entries; one whose last leaf is larger is cut by keys.
    block = (np.cumsum(held) - held) // BLOCK

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                leaves = tree.visits(_unit(_matrix(part.column("v"), dim)), n_visits, held, k + 1)
                i, leaf = np.repeat(np.arange(len(leaves)), [len(x) for x in leaves]), np.concatenate(leaves)
                order = np.lexsort((leaf, i))
                i, leaf = i[order], leaf[order]
                starts = np.flatnonzero(np.r_[True, (i[1:] != i[:-1]) | (block[leaf[1:]] != block[leaf[:-1]])])
                seen = pa.ListArray.from_arrays(pa.array(np.r_[starts, len(leaf)], pa.int32()), pa.array(leaf, pa.int64()))
                of = pa.array(i[starts])
                yield pa.RecordBatch.from_arrays([part.column("key").take(of), part.column("v").take(of), pa.array(block[leaf[starts]], pa.int64()), seen], ["qkey", "q", "block", "leaves"])

    visits = written(queries.mapInArrow(walked, "qkey string, q array<double>, block long, leaves array<bigint>"), "visits")
    n_e = pd.DataFrame({"leaf": np.arange(len(held)), "block": block, "n_e": np.ceil(np.bincount(block, held) / BLOCK).astype(int)[block]})
    n_e = F.broadcast(rows.sparkSession.createDataFrame(n_e, "leaf long, block long, n_e long"))  # a row for each leaf, at most MAX_NODES
    n_q = visits.groupBy("block").agg(F.ceil(F.count("*") / BLOCK).alias("n_q"))
    blocks = F.broadcast(written(n_e.select("block", "n_e").distinct().join(n_q, "block"), "blocks"))
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    left = visits.join(blocks, "block").select("block", F.pmod(F.xxhash64("qkey"), F.col("n_q")).alias("bq"), upto("n_e").alias("be"), "qkey", "q", "leaves")
    right = entries.join(n_e.select("leaf", "block"), "leaf").join(blocks, "block").select("block", upto("n_q").alias("bq"), F.pmod(F.xxhash64("key"), F.col("n_e")).alias("be"), "leaf", "v", "ids")

    def met(q: pd.DataFrame, e: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(e):
            return pd.DataFrame({"qkey": [], "score": [], "ids": []})
        e = e.sort_values("leaf", kind="stable")
        a, b, ids, leaf = np.stack(q["q"].to_list()), np.stack(e["v"].to_list()), e["ids"].to_numpy(), e["leaf"].to_numpy()
        first_ids = e["ids"].str[0].to_numpy()
        asks, asked_leaf = np.repeat(np.arange(len(q)), q["leaves"].map(len)), np.concatenate(q["leaves"].to_list())
        order = np.argsort(asked_leaf, kind="stable")
        asks, asked_leaf, parts = asks[order], asked_leaf[order], []
        for x in np.unique(leaf):
            who = asks[slice(*np.searchsorted(asked_leaf, [x, x + 1]))]
            low, high = np.searchsorted(leaf, [x, x + 1])
            if len(who):
                i, j, score = best_of(a[who], b[low:high], first_ids[low:high], min(k + 1, high - low))
                parts.append((who[i], j + low, score))
        if not parts:
            return pd.DataFrame({"qkey": [], "score": [], "ids": []})
        i, j, score = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((first_ids[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        best = np.arange(len(i)) - np.searchsorted(i, i) <= k
        return pd.DataFrame({"qkey": q["qkey"].to_numpy()[i[best]], "score": score[best], "ids": ids[j[best]]})

    found = left.groupBy("block", "bq", "be").cogroup(right.groupBy("block", "bq", "be")).applyInPandas(met, "qkey string, score double, ids array<bigint>")
    top = F.row_number().over(Window.partitionBy("qkey").orderBy(F.desc("score"), F.col("ids")[0]))
    found = found.withColumn("nth", top).filter(F.col("nth") <= k + 1).groupBy("qkey").agg(F.collect_list(F.struct((-F.col("score")).alias("far"), "ids")).alias("near"))
    out = asked.select("vec_id", F.col("key").alias("qkey")).join(found, "qkey")
    each = F.flatten(F.transform("near", lambda g: F.transform(g["ids"], lambda i: F.struct(g["far"].alias("far"), i.alias("id")))))
    each = F.slice(F.array_sort(F.filter(each, lambda x: x["id"] != F.col("vec_id"))), 1, k)
    out = out.select(F.col("vec_id").alias("query_id"), F.posexplode(each).alias("at", "x"))
    return out.select("query_id", (F.col("at") + 1).alias("rank"), F.col("x.id").alias("vec_id"), (-F.col("x.far")).alias("score"))


def placed(tree: Tree, entries: DataFrame, dim: int, split: int) -> tuple[Tree, DataFrame, np.ndarray]:
    """The tree grown until its leaves hold at most ``split`` of ``entries(key, v, ids)``, these with their leaves, and how many each leaf holds."""
    while True:

        def place(batches: Iterator[pa.RecordBatch], tree: Tree = tree) -> Iterator[pa.RecordBatch]:
            for b in slices(batches, 256):
                yield b.append_column("leaf", pa.array(tree.assign(_unit(_matrix(b.column("v"), dim))), pa.int64()))

        out = written(entries.mapInArrow(place, "key string, v array<double>, ids array<bigint>, leaf long"), "entries")
        held = np.zeros(tree.n_leaves, np.int64)
        for r in out.groupBy("leaf").count().collect():  # at most MAX_NODES
            held[r["leaf"]] = r["count"]
        room = (MAX_NODES - len(tree.children)) // (2 * SPLIT_SAMPLE)  # a subtree has fewer nodes than twice its sample
        large = [x for x in np.argsort(-held, kind="stable")[: max(room, 0)].tolist() if held[x] > split]
        if not large:
            return tree, out, held
        # A share of each large leaf's vectors, by hashes, of about SPLIT_SAMPLE rows.
        share = pd.DataFrame({"leaf": large, "below": [int(2**20 * min(1.0, SPLIT_SAMPLE / held[x])) for x in large]})
        share = F.broadcast(out.sparkSession.createDataFrame(share, "leaf long, below long"))
        some = out.join(share, "leaf").filter(F.pmod(F.xxhash64("key", F.lit(5)), F.lit(2**20)) < F.col("below")).select("leaf", "key", "v")

        def subtree(rows: pd.DataFrame) -> pd.DataFrame:
            sub = fit(_unit(np.stack(rows.sort_values("key")["v"].to_list())))
            return pd.DataFrame({"leaf": [rows["leaf"].iloc[0]], "children": [sub.children], "centroids": [sub.centroids.ravel()]})

        made = some.groupBy("leaf").applyInPandas(subtree, "leaf long, children array<array<int>>, centroids array<double>").collect()
        subtrees = {}
        for r in made:
            centroids = np.array(r["centroids"]).reshape(-1, dim)
            if len(centroids) > 1:
                subtrees[r["leaf"]] = Tree(centroids, r["children"], numbered(r["children"]))
        if not subtrees:  # what is left can't be told apart
            return tree, out, held
        discard(out)
        tree = tree.with_subtrees(subtrees)


def visits_needed(entries: DataFrame, queries: DataFrame, tree: Tree, dim: int, k: int, recall: float, calibration: int) -> int:
    """Leaf visits after which ``recall`` of the calibration queries' true neighbours have been seen."""
    rows = queries.orderBy(F.xxhash64("key"), "key").limit(calibration).collect()
    if not rows:
        return 1
    keys, x = np.array([r["key"] for r in rows]), _unit(np.array([r["v"] for r in rows]))

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, where = np.full((len(x), k), -2.0), np.full((len(x), k), -1)
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                near = x @ _unit(_matrix(part.column("v"), dim)).T
                near[keys[:, None] == part.column("key").to_numpy(zero_copy_only=False)[None]] = -2
                near = np.concatenate([best, near], axis=1)
                leaf = np.concatenate([where, np.broadcast_to(part.column("leaf").to_numpy(), (len(x), part.num_rows))], axis=1)
                pick = np.argpartition(-near, k - 1, axis=1)[:, :k]
                best, where = np.take_along_axis(near, pick, 1), np.take_along_axis(leaf, pick, 1)
        q = np.repeat(np.arange(len(x)), k)
        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(best.ravel()), pa.array(where.ravel(), pa.int64())], ["q", "score", "leaf"])

    top = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "leaf"))
    true = entries.select("key", "v", "leaf").mapInArrow(brute, "q long, score double, leaf long").filter("leaf >= 0").withColumn("nth", top).filter(F.col("nth") <= k).collect()
    leaves, needed = [set() for _ in x], []
    for r in true:
        leaves[r["q"]].add(r["leaf"])
    for near, q_leaves, q in zip(tree.nearness(x), leaves, range(len(x))):
        at = {}
        for nth, leaf in enumerate(tree.walk(near), 1):
            if leaf in q_leaves:
                at[leaf] = nth
            if len(at) == len(q_leaves):
                break
        needed += [at[r["leaf"]] for r in true if r["q"] == q]
    needed.sort()
    return needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)] if needed else 1
