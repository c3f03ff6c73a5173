"""N-gram Jaccard self-join by T-occurrence search.

Each document is the set of hashes of its word shingles. Two documents link when the
overlap of their sets reaches T = ceil(t * (a + b) / (100 + t)), t being the threshold in
percent. A set of n members can only link with one that it meets in its n - ceil(t * n / 100)
+ 1 rarest shingles, and two sets must meet in as many of these as ``least_met`` says; the
inverted lists of the others are never read.

How rare a shingle is, is counted over all documents, within one part of the hash space, the
same for all (``counted_part``), which holds more of each set than must be merged. A
document's shingles of that part come first, by their number of documents; only small sets
with too few of them go on to others. Most shingles occur in one document only: they use up a
document's merged lists, but make no list.

As in DivideSkip, the lists that are merged are so the short ones, and the long ones, which
could only add to what must come up in the short, are left for later: arrays of the short
lists' members are joined to the documents in them, and for each document a heap merges its
arrays and counts how often another document comes up. Pairs that come up often enough, seen
from both sides together, are confirmed by binary probes of the whole sorted sets, which hold the long lists' shingles
too. Sizes, and parity masks of the sets, rule out most members of an array before it is
merged.

Groups of many similar documents would pair quadratically, so most of a group is connected
before that: in each round every list's documents meet a pivot of like size, and every
document is tried with the pivots that it meets most; confirmed links give components. Then
only pairs that lie in different components are looked for as above. Two documents already
known to be connected need no further link, so no connection is lost, whatever the rounds
have found.

Documents with equal sets are one node throughout. Shingles and sets are identified by
64-bit hashes.

Defined cases: A-Z is lower-cased and words are runs other than space and tab to carriage
return; a text of fewer words than a shingle has its whole word sequence as the one
shingle; null, empty and wordless texts have no shingles, link with nothing and have their
own id as component. Repeated rows are copies. Rows with null ids take part, but a null id
never names a component that has another. An empty table gives an empty result. Other
columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import components, discard, slices, small_enough, text_bytes, tidy_shuffles, written

#: Members of a list that are joined together, as an array; and about how many members a merge takes, beyond which a document's lists are cut by their members' ids.
BLOCK = 64
MERGED = 1 << 16
#: Ids or sets up to this many are broadcast (about 16 MB).
BROADCAST_IDS = 1_000_000
#: Most rounds of pivots, which end when one links nothing; and pivots that a document is tried with in each.
ROUNDS = 2
TRIED = 2
#: Set ids that a task remembers, so as not to write the members of equal sets again.
REMEMBERED = 200_000

_P = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: bytes, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of ``k`` words."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(k, len(h))
    n = len(h) - k + 1
    acc = h[:n] + np.uint64(k)
    for j in range(1, k):
        acc = (acc ^ (acc >> np.uint64(29))) * _P + h[j : j + n]
    acc = (acc ^ (acc >> np.uint64(32))) * _P
    return np.unique(acc ^ (acc >> np.uint64(29)))


def prefix_length(n: int, t: int) -> int:
    return n - -(-t * n // 100) + 1


def least_met(a: int, b: int, t: int) -> int:
    """In how many shingles that both merge two linking sets of these sizes meet."""
    return -(-t * (a + b) // (100 + t)) - -(-t * max(a, b) // 100) + 1


def counted_part(s: np.ndarray, t: int) -> np.ndarray:
    """The members that are counted: those in the first 3/2 * (100 - t) percent of the hash space, and as many of the next as must be merged."""
    end = min(0.99, (100 - t) * 1.5 / 100)
    return s[: max(int(np.searchsorted(s, np.uint64(end * float(1 << 63)) * np.uint64(2))), prefix_length(len(s), t))] if len(s) else s


def parity_masks(s: np.ndarray) -> np.ndarray:
    """Two 64-bit words: for each of 128 residues, whether an odd number of the set's hashes have it."""
    odd = np.bincount((s & np.uint64(127)).astype(np.int64), minlength=128) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _needed(a: Column, b: Column, t: int) -> Column:
    """Overlap that two sets of sizes a and b must have to link."""
    return F.ceil(F.lit(t) * (a + b) / F.lit(100 + t))


def may_link(x: str, y: str, t: int) -> Column:
    """False only if the sets in columns with these prefixes differ too much: the masks of two sets differ in no more bits than the sets in members."""
    apart = F.bit_count(F.col(x + "m1").bitwiseXOR(F.col(y + "m1"))) + F.bit_count(F.col(x + "m2").bitwiseXOR(F.col(y + "m2")))
    a, b = F.col(x + "n"), F.col(y + "n")
    return (apart <= a + b - 2 * _needed(a, b, t)) & (F.least(a, b) * 100 >= F.greatest(a, b) * t)


def _lists(values: list[np.ndarray | None]) -> pa.Array:
    there = [v for v in values if v is not None]
    ends = np.cumsum([0, *(0 if v is None else len(v) for v in values)], dtype=np.int32)
    flat = np.concatenate(there).view(np.int64) if there else np.empty(0, np.int64)
    missing = pa.array([v is None for v in values], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()), mask=missing)


def _set_id(s: np.ndarray) -> int | None:
    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).astype(np.int64)) if len(s) else None


def shingled(docs: DataFrame, k: int, t: int) -> DataFrame:
    """A row for each row of docs: doc_id, set id, set size, parity masks and counted part ``h``; the latter three once a task for equal sets, otherwise null."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for b in slices(batches):
            sets = [shingle_set(x, k) for x in b.column(1).to_pylist()]
            sids, new = [_set_id(s) for s in sets], []
            for sid in sids:
                new.append(sid is not None and sid not in seen)
                seen.add(sid)
            if len(seen) > REMEMBERED:
                seen.clear()
            masks = [parity_masks(s) if own else (None, None) for s, own in zip(sets, new)]
            part = _lists([counted_part(s, t) if own else None for s, own in zip(sets, new)])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sids, pa.int64()), pa.array(map(len, sets), pa.int64()), pa.array([m[0] for m in masks], pa.int64()), pa.array([m[1] for m in masks], pa.int64()), part],
                ["doc_id", "sid", "n", "m1", "m2", "h"],
            )

    return docs.select("doc_id", text_bytes().alias("text")).mapInArrow(made, "doc_id long, sid long, n long, m1 long, m2 long, h array<bigint>")


def merged_lists(rows: DataFrame, nodes: DataFrame, t: int) -> DataFrame:
    """sid, and as ``hs`` the shingles of its merged lists that other sets have too, for the sets that have any."""
    # Of the same set in several tasks one row is taken.
    again = written(nodes.filter("firsts > 1").select("sid", "keep"), "again")
    first = rows.filter("h IS NOT NULL").join(F.broadcast(again) if small_enough(again, BROADCAST_IDS) else again, "sid", "left").filter("keep IS NULL OR keep = tag")
    postings = first.select("sid", F.explode("h").alias("h"))
    counts = written(postings.groupBy("h").count().filter("count > 1"), "counts")
    shared = postings.join(counts, "h").groupBy("sid").agg(F.sort_array(F.collect_list(F.struct("count", "h"))).alias("s"))
    shared = shared.join(nodes.select("sid", "n", "counted"), "sid")
    alone = F.col("counted") - F.size("s")
    merged = F.col("n") - F.ceil(F.lit(t) * F.col("n") / 100) + 1
    left = F.greatest(F.lit(0).cast("bigint"), merged - alone).cast("int")
    out = written(shared.filter(left > 0).select("sid", F.slice("s.h", F.lit(1), left).alias("hs")), "merged")
    discard(counts, again)
    return out


def _sets(docs: DataFrame, ids: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """The whole shingle sets of the documents in ``pairs``."""
    nodes = written(pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).distinct(), "wanted")
    one = ids.join(nodes, "sid").groupBy("sid").agg(F.min("doc_id").alias("doc_id"))
    one = written(one.select("doc_id").distinct(), "wanted")
    near = F.broadcast(one) if small_enough(one, BROADCAST_IDS) else one

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            sets = [shingle_set(x, k) for x in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(map(_set_id, sets), pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["sid", "members"])

    texts = docs.select("doc_id", text_bytes().alias("text"))
    found = texts.join(near.filter("doc_id IS NOT NULL"), "doc_id", "left_semi").select("text")
    if not one.filter("doc_id IS NULL").isEmpty():  # sets that only rows without an id have
        found = found.union(texts.filter("doc_id IS NULL").select("text"))
    found = found.mapInArrow(made, "sid long, members binary").filter("sid IS NOT NULL")
    found = found.join(F.broadcast(nodes) if small_enough(nodes, BROADCAST_IDS) else nodes, "sid", "left_semi")
    out = written(found.dropDuplicates(["sid"]), "sets")
    discard(nodes, one)
    return out


def confirmed(docs: DataFrame, ids: DataFrame, pairs: DataFrame, k: int, t: int) -> DataFrame:
    """The links among ``pairs(a, b)``, a written table that is discarded: binary probes of the larger set with the smaller."""
    if pairs.isEmpty():
        return pairs
    sets = _sets(docs, ids, pairs, k)

    def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = sorted((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)), key=len)
                both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                keep.append(100 * both >= t * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left, right = (sets.select(F.col("sid").alias(c), F.col("members").alias(m)) for c, m in (("a", "x"), ("b", "y")))
    out = written(pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(probed, "a long, b long"), "links")
    discard(sets, pairs)
    return out


def star_pairs(lists: DataFrame, t: int, turn: int) -> DataFrame:
    """Documents and the pivots, among those of their lists, that they meet most and aren't connected with."""
    size = F.floor(F.log("n") / F.lit(float(np.log(100 / t)))).alias("size")
    at = [] if turn == 0 else [F.xxhash64("sid", F.lit(turn)).alias("at")]
    most = F.struct("weight", *at, "sid", "m1", "m2", "n", "component")
    pivots = lists.groupBy("h", size).agg(F.max(most).alias("p"), F.count("*").alias("m")).filter("m > 1")
    pivots = pivots.select("h", "size", *(F.col(f"p.{c}").alias("p" + c) for c in ("sid", "n", "m1", "m2", "component")))
    met = lists.select("h", size, "sid", "n", "m1", "m2", "component").join(pivots, ["h", "size"]).filter(F.col("component") != F.col("pcomponent")).filter(may_link("", "p", t))
    met = met.groupBy("sid", "psid").agg(F.count("*").alias("c"))
    best = F.slice(F.sort_array(F.collect_list(F.struct("c", "psid")), False), 1, TRIED)
    star = met.groupBy("sid").agg(best.alias("best")).select("sid", F.explode("best.psid").alias("psid"))
    return star.select(F.least("sid", "psid").alias("a"), F.greatest("sid", "psid").alias("b")).distinct()


def heap_pairs(lists: DataFrame, t: int) -> DataFrame:
    """Pairs of documents of different components that meet in enough of ``lists``, which is to hold every list's whole members.

    In some lists one document of a pair looks for the other, in some the other for it, so
    the meetings of both directions are added up before they are judged.
    """
    main = lists.groupBy("h", "component").count().groupBy("h").agg(F.max_by("component", F.struct("count", "component")).alias("main"))
    lists = written(lists.join(main, "h").withColumn("own", F.col("component") == F.col("main")), "divided")

    # Blocks of lists, and documents outside of a list's largest component, which look through them.
    blocks = F.ceil(F.col("size") / BLOCK)
    each = lists.groupBy("sid").agg(F.ceil(F.sum("size") / MERGED).alias("parts"), F.max(~F.col("own")).alias("seeks"))
    both = lists.join(each, "sid")
    member = F.struct("sid", "n", "m1", "m2", "component", "seeks")
    arrays = both.groupBy("h", "own", F.pmod(F.xxhash64("sid"), blocks).alias("block")).agg(F.collect_list(member).alias("list")).select("h", "own", "list")
    seekers = both.filter("NOT own").select("h", *(F.col(c).alias("x" + c) for c in ("sid", "n", "m1", "m2", "component")), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "parts")

    def near(y: Column) -> Column:
        bits = F.bit_count(F.col("xm1").bitwiseXOR(y["m1"])) + F.bit_count(F.col("xm2").bitwiseXOR(y["m2"]))
        alike = (F.least("xn", y["n"]) * 100 >= F.greatest("xn", y["n"]) * t) & (bits <= F.col("xn") + y["n"] - 2 * _needed(F.col("xn"), y["n"], t))
        turn = F.col("own") | (y["sid"] < F.col("xsid"))
        return turn & (y["component"] != F.col("xcomponent")) & alike & (F.pmod(F.xxhash64(y["sid"]), F.col("parts")) == F.col("part"))

    run = F.array_sort(F.transform(F.filter("list", near), lambda y: F.struct(y["sid"], y["n"], y["seeks"])))
    runs = seekers.join(arrays, "h").select("xsid", "xn", "part", F.explode(F.filter(F.array(run), lambda r: F.size(r) > 0)).alias("run"))  # without the empty ones
    runs = runs.groupBy("xsid", "xn", "part").agg(F.collect_list("run").alias("runs")).select("xsid", "xn", "runs")

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: list[tuple[int, int, int, int]] = []
            for own, n, mine in zip(*(batch.column(i).to_pylist() for i in range(2)), batch.column(2)):
                flat = mine.values
                ends = flat.offsets.to_pylist()
                members = flat.flatten()
                sids, sizes, seek = (members.field(i).to_pylist() for i in range(3))
                known = dict(zip(sids, zip(sizes, seek)))
                first = ends[0]
                for sid, run in groupby(heapq.merge(*(sids[a - first : b - first] for a, b in zip(ends, ends[1:])))):
                    met, (size, seeks) = sum(1 for _ in run), known[sid]
                    need = least_met(n, size, t)
                    if seeks or met >= need:  # one that never seeks has no meetings to add
                        out.append((min(sid, own), max(sid, own), met, need))
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in out], pa.int64()) for i in range(4)], ["a", "b", "met", "need"])

    meetings = runs.mapInArrow(merged, "a long, b long, met long, need long")
    return meetings.groupBy("a", "b").agg(F.sum("met").alias("met"), F.max("need").alias("need")).filter("met >= need").select("a", "b")


def jaccard_components(docs: DataFrame, shingle_words: int = 4, threshold: int = 85) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs(doc_id, text)``."""
    groups = jaccard_groups(docs, shingle_words, threshold)
    names = written(groups.filter("sid IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("component_id")), "names")
    named = groups.join(names, "component", "left")
    return named.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def jaccard_groups(docs: DataFrame, shingle_words: int, threshold: int) -> DataFrame:
    """doc_id, set id, set size and component (a set id) of every row of ``docs(doc_id, text)``; without shingles both ids are null."""
    with tidy_shuffles(docs.sparkSession):
        return _groups(docs, shingle_words, threshold)


def one_of_each(docs: DataFrame, groups: DataFrame, shingle_words: int) -> DataFrame:
    """The rows of ``docs`` without those that have a row of smaller id in their component; rows without shingles all stay.

    Rows are told apart by id and set, so that ids may be null or occur more than once. Of
    rows that have both in common one stays.
    """

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            sids = [_set_id(shingle_set((t or "").encode(), shingle_words)) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.StructArray.from_arrays(b.columns, b.schema.names), pa.array(sids, pa.int64())], ["row", "sid"])

    first = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "sid")
    there = groups.filter("sid IS NOT NULL").groupBy("doc_id", "sid", "component").agg(F.count("*").alias("copies"))
    kept = there.groupBy("component").agg(F.min(first).alias("first"))
    judged = written(there.join(kept, "component").select(F.col("doc_id").alias("id"), "sid", "copies", (F.col("first") == first).alias("stays")), "judged")

    def at_hand(rows: DataFrame) -> DataFrame:
        return F.broadcast(rows) if small_enough(rows, BROADCAST_IDS) else rows

    gone, again = judged.filter("NOT stays").select("id", "sid"), judged.filter("stays AND copies > 1").select("id", "sid")
    rows = docs.mapInArrow(made, StructType([StructField("row", docs.schema), StructField("sid", LongType())]))
    same = (F.col("row.doc_id").eqNullSafe(F.col("id"))) & (rows["sid"] == F.col("other"))
    rows = rows.join(at_hand(gone.withColumnRenamed("sid", "other")), same, "left_anti")
    if again.isEmpty():
        return rows.select("row.*")
    more = at_hand(again.withColumnRenamed("sid", "other"))
    once = rows.join(more, same, "left_semi").withColumn("id", F.col("row.doc_id")).dropDuplicates(["id", "sid"]).drop("id")
    return rows.join(more, same, "left_anti").unionByName(once).select("row.*")


def _groups(docs: DataFrame, k: int, t: int) -> DataFrame:
    rows = written(shingled(docs, k, t).withColumn("tag", F.monotonically_increasing_id()), "shingled")
    ids = written(rows.select("doc_id", "sid", "n"), "ids")
    there = F.col("h").isNotNull()
    nodes = rows.filter("sid IS NOT NULL").groupBy("sid").agg(
        *(F.max(c).alias(c) for c in ("n", "m1", "m2")), F.max(F.size("h")).alias("counted"), F.count("*").alias("weight"), F.min(F.when(there, F.col("tag"))).alias("keep"), F.count("h").alias("firsts")
    )
    nodes = written(nodes, "nodes")
    merged = merged_lists(rows, nodes, t)
    discard(rows)

    lists = merged.select("sid", F.explode("hs").alias("h"))
    sizes = written(lists.groupBy("h").agg(F.count("*").alias("size")).filter("size > 1"), "sizes")
    own = nodes.select("sid", "n", "m1", "m2", "weight").withColumn("component", F.col("sid"))
    lists = written(lists.join(sizes, "h").join(own, "sid"), "lists")
    discard(merged, sizes)

    # Pass one: most of each group is connected by pivots.
    links = labels = None
    for turn in range(ROUNDS):
        more = confirmed(docs, ids, written(star_pairs(lists, t, turn), "pairs"), k, t)
        if more.isEmpty():
            break
        links = more if links is None else links.union(more)
        labels = components(links)
        degrees = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("degree"))
        known = labels.join(degrees, "node").select(F.col("node").alias("sid"), F.col("component").alias("c"), "degree")
        new = lists.join(known, "sid", "left").withColumn("weight", F.col("weight") + F.coalesce("degree", F.lit(0))).withColumn("component", F.coalesce("c", "component"))
        kept, lists = lists, written(new.select(*lists.columns), "labelled")
        discard(kept)

    # Pass two: what lies in different components.
    mixed = lists.groupBy("h").agg(F.min("component").alias("p"), F.max("component").alias("q")).filter("p <> q").select("h")
    more = confirmed(docs, ids, written(heap_pairs(lists.join(mixed, "h"), t), "pairs"), k, t)
    if not more.isEmpty():
        labels = components(more if links is None else links.union(more))
    discard(lists)
    if labels is None:
        return ids.withColumn("component", F.col("sid"))

    named = nodes.select("sid").join(labels.withColumnRenamed("node", "sid"), "sid", "left").select("sid", F.coalesce("component", "sid").alias("component"))
    return ids.join(named, "sid", "left").select("doc_id", "sid", "n", "component")
