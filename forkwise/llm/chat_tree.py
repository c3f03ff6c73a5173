"""Chat formatting as a prefix tree.

Conversations that share initial turns share the nodes of a tree; a node is a turn after all
turns before it, known by a running digest. Sorted by their digests, conversations come in
the depth-first order of the tree, and each needs only the turns beyond the longest prefix
that it shares with the one before: these are emitted, once, as segments of a sequence.
A segment has its token ids, its start in the sequence, the position id of its first token
(which counts the tokens of its ancestors), and as attention intervals the spans of the
sequence in which its ancestors stand; in itself attention is causal.

Sequences hold about SEQUENCE characters of consecutive conversations. The first conversation
of a sequence states its shared turns again, marked ``repeated``, so that every sequence
stands for itself and trees of any size are spread over many. Copies of a conversation are
one path of the tree; they and a turn that many conversations begin with are dropped where
they are read, before their texts are shuffled.

The template marks turns by control strings. One inside a text or role gets a backslash after
its first character, as does one that has backslashes there already, so that taking one
away gives the text back.

``read_back`` walks the segments depth-first with the states of the current path only: each
turn's text is decoded, parsed and hashed once for all conversations that share it.

Defined cases: turns are ordered by ``turn``, nulls first, ties by role and text; repeated rows
are further turns. Null texts and roles are empty; roles other than user, assistant and system
are written out. Rows with a null conv_id are one conversation. Empty tables give empty results;
other columns are ignored. A conversation is put in order in one task, turn by turn.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bpe import token_bytes
from .common import discard, tidy_shuffles, written
from .pieces import PieceCache, stable_pieces

#: Characters that a sequence holds about.
SEQUENCE = 1 << 16
#: Of conversations, the part that copies of one must make up to be spread.
HOT_PART = 100_000
#: Rows that are sent on together.
ROWS = 512

# What stands before and after a turn's text, by role.
TURNS = {"user": ("[INST] ", " [/INST]"), "assistant": (" ", "</s>"), "system": ("<<SYS>>\n", "\n<</SYS>>\n\n")}
OTHER = ("[ROLE]", "[/ROLE] ", "</s>")
# Fixed value: a control string, perhaps broken by backslashes.
_CONTROL = r"([\[<])(\\*)(/?INST\]|/?ROLE\]|/?s>|</?SYS>>)"
_BREAK = re.compile(_CONTROL)
_MEND = re.compile(_CONTROL.replace(r"(\\*)", r"\\(\\*)"))


def escaped(text: str) -> str:
    return _BREAK.sub(r"\1\\\2\3", text)


def unescaped(text: str) -> str:
    return _MEND.sub(r"\1\2\3", text)


def formatted(role: str, text: str) -> tuple[str, str, str]:
    """What a turn is written as: before its text, the text, and after it."""
    if role in TURNS:
        before, after = TURNS[role]
        return before, escaped(text), after
    return OTHER[0] + escaped(role) + OTHER[1], escaped(text), OTHER[2]


def parsed(turn: str) -> tuple[str, str]:
    """Role and text of a written turn."""
    for role, (before, after) in TURNS.items():
        if turn.startswith(before) and turn.endswith(after) and len(turn) >= len(before) + len(after):
            return role, unescaped(turn[len(before) : len(turn) - len(after)])
    role, mark, text = turn.removeprefix(OTHER[0]).partition(OTHER[1])
    if not (turn.startswith(OTHER[0]) and mark and turn.endswith(OTHER[2])):
        raise ValueError(f"not a turn: {turn[:80]!r}")
    return unescaped(role), unescaped(text.removesuffix(OTHER[2]))


@lru_cache(maxsize=1)
def encoder(path: str) -> PieceCache:
    """Ids of pieces by the tokenizers library, special strings as plain text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    t.no_truncation()
    t.no_padding()
    return PieceCache(lambda texts: [np.array(e.ids, np.int32) for e in t.encode_batch_fast(texts, add_special_tokens=False)])


def encoded(cache: PieceCache, texts: list[str]) -> list[np.ndarray]:
    pieces = [stable_pieces(t) for t in texts]
    cache.prepare(pieces)
    return [np.concatenate([*cache.look_up(p)]) for p in pieces]


def _in_rows(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    for b in batches:
        for at in range(0, b.num_rows, ROWS):
            yield list(zip(*(c.to_pylist() for c in b.slice(at, ROWS).columns)))


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for block in _blocks(batches):
        yield from block


_TURN = pa.schema([("conv_id", pa.int64()), ("key", pa.int64()), ("depth", pa.int32()), ("node", pa.binary()), ("role", pa.string()), ("text", pa.string()), ("chars", pa.int64())])


def turns_of(rows: DataFrame) -> DataFrame:
    """Each turn with its conversation's key, its depth from 1 and its node: a digest of all turns up to it."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            key, own, depth, node = TaskContext.get().partitionId() << 33, None, 0, b""
            for conv, role, text in _each(batches):
                if not depth or conv != own:
                    key, own, depth, node = key + 1, conv, 0, b""
                said = role.encode()
                node = blake2b(node + len(said).to_bytes(8, "little") + said + text.encode(), digest_size=16).digest()
                depth += 1
                yield conv, key, depth, node, role, text, sum(map(len, formatted(role, text)))

        yield from _in_rows(each(), _TURN)

    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", text("role"), text("text")).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return rows.select("conv_id", "role", "text").mapInArrow(made, "conv_id long, key long, depth int, node binary, role string, text string, chars long")


def paths_of(turns: DataFrame) -> DataFrame:
    """conv_id, key, nodes from the root, their characters, and the last node as ``leaf`` of each conversation."""
    whole = turns.groupBy("key").agg(F.first("conv_id").alias("conv_id"), F.sort_array(F.collect_list(F.struct("depth", "node", "chars"))).alias("t"))
    return whole.select("conv_id", "key", F.col("t.node").alias("path"), F.col("t.chars").alias("chars"), F.element_at("t.node", -1).alias("leaf"))


def depth_first(paths: DataFrame, sequence: int) -> DataFrame:
    """For one conversation of each path: key, leaf, sequence, rank in it, how many turns it shares with the one before it, and how many of these the sequence holds."""
    one = paths.groupBy("leaf").agg(F.min(F.struct("key", "path", "chars")).alias("o")).select("leaf", "o.*")
    parts = written(one.repartitionByRange("path").withColumn("part", F.spark_partition_id().cast("long")), "ordered")
    ends = parts.groupBy("part").agg(F.max("path").alias("end"))  # a row for each partition
    ends = ends.select(F.lead("part").over(Window.orderBy("part")).alias("part"), F.col("end").alias("before"))
    order = Window.partitionBy("part").orderBy("path")
    rows = parts.join(F.broadcast(ends), "part", "left").withColumn("before", F.coalesce(F.lag("path").over(order), "before"))
    same = F.zip_with("before", "path", lambda x, y: x.eqNullSafe(y))
    rows = rows.withColumn("shared", F.coalesce(F.array_position(same, False) - 1, F.lit(0)).cast("int"))
    new = F.aggregate(F.slice("chars", F.col("shared") + 1, F.size("chars")), F.lit(0).cast("bigint"), lambda n, x: n + x)
    rows = rows.withColumn("new", new).withColumn("upto", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("new"))
    rows = rows.withColumn("within", F.floor(F.col("upto") / sequence))
    rows = rows.withColumn("first", F.coalesce(F.lag("within").over(order) != F.col("within"), F.lit(True)))
    return rows.select("key", "leaf", (F.col("part") * (1 << 32) + F.col("within")).alias("sequence"), F.row_number().over(order).alias("rank"), F.size("path").alias("turns"), "shared", F.when(F.col("first"), 0).otherwise(F.col("shared")).alias("held"))


_SEGMENT = pa.schema([("sequence", pa.int64()), ("segment", pa.int32()), ("ids", pa.list_(pa.int32())), ("start", pa.int64()), ("position", pa.int64()), ("loss_start", pa.int32()), ("loss_end", pa.int32()), ("ancestors", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("repeated", pa.bool_()), ("leaf", pa.binary())])
SEGMENT = "sequence long, segment int, ids array<int>, start long, position long, loss_start int, loss_end int, ancestors array<struct<start: long, end: long>>, repeated boolean, leaf binary"


def joined_spans(spans: list[tuple[int, int]], start: int, end: int) -> list[tuple[int, int]]:
    """Ascending spans with one more at their end, which may go on the last."""
    if spans and spans[-1][1] == start:
        return [*spans[:-1], (spans[-1][0], end)]
    return [*spans, (start, end)]


def segments_of(turns: DataFrame, plan: DataFrame, path: str) -> DataFrame:
    """The segments of all sequences, in depth-first order within each; ``leaf`` stands at the end of a conversation."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = encoder(path)

        def each() -> Iterator[tuple]:
            own, segment, offset = None, 0, 0
            line: list[tuple[list[tuple[int, int]], int]] = []  # of each turn on the path: spans up to it, and tokens
            for block in _blocks(batches):
                said = iter(encoded(cache, [x for _, _, role, text, *_ in block for x in formatted(role, text)]))
                for (sequence, depth, role, _, repeated, leaf), parts in zip(block, zip(said, said, said)):
                    if sequence != own:
                        own, segment, offset, line = sequence, 0, 0, []
                    del line[depth - 1 :]
                    spans, position = line[-1] if line else ([], 0)
                    ids = np.concatenate(parts)
                    begins, ends = (len(parts[0]), len(parts[0]) + len(parts[1])) if role == "assistant" else (0, 0)
                    yield sequence, segment, ids, offset, position, begins, ends, [{"start": s, "end": e} for s, e in spans], repeated, leaf
                    line.append((joined_spans(spans, offset, offset + len(ids)), position + len(ids)))
                    segment, offset = segment + 1, offset + len(ids)

        yield from _in_rows(each(), _SEGMENT)

    rows = turns.join(plan, "key").filter(F.col("depth") > F.col("held"))
    rows = rows.select("sequence", "rank", "depth", "role", "text", (F.col("depth") <= F.col("shared")).alias("repeated"), F.when(F.col("depth") == F.col("turns"), F.col("leaf")).alias("leaf"))
    rows = rows.repartition("sequence").sortWithinPartitions("sequence", "rank", "depth")
    return rows.select("sequence", "depth", "role", "text", "repeated", "leaf").mapInArrow(made, SEGMENT)


_READ = pa.schema([("leaf", pa.binary()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


class _Read:
    """What has been read of a path: its span's end in the sequence, tokens, and digests that its continuations go on from."""

    def __init__(self, before: "_Read | None" = None):
        self.end, self.tokens = 0, before.tokens if before else 0
        self.n, self.loss_chars, self.chars = (before.n, before.loss_chars, before.chars) if before else (0, 0, 0)
        self.turns, self.loss = (before.turns.copy(), before.loss.copy()) if before else (sha256(), sha256())


def read_back(segments: DataFrame, path: str) -> DataFrame:
    """Digests of each path of written ``segments``, by leaf, from tokens, loss spans and ancestors alone."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = token_bytes(path)

        def text_of(ids: list[int]) -> str:
            data = vocabulary.take(pa.array(ids, pa.int64())).buffers()[2]
            return "" if data is None else bytes(data).decode()

        def each() -> Iterator[tuple]:
            own, line = None, []
            for sequence, ids, position, begins, ends, start, ancestors, leaf in _each(batches):
                if sequence != own:
                    own, line = sequence, []
                while line and (not ancestors or line[-1].end != ancestors[-1]["end"]):
                    line.pop()
                if len(ancestors) and not line or sum(s["end"] - s["start"] for s in ancestors) != position or (line[-1].tokens if line else 0) != position:
                    raise ValueError(f"sequence {sequence}: a segment's ancestors don't lead to it")
                now = _Read(line[-1] if line else None)
                said = text_of(ids)
                role, text = parsed(said)
                learned = unescaped(text_of(ids[begins:ends]))
                now.end, now.tokens, now.n = start + len(ids), now.tokens + len(ids), now.n + 1
                now.turns.update(f"{role}\n{text}\n".encode())
                now.loss.update(learned.encode())
                now.loss_chars, now.chars = now.loss_chars + len(learned), now.chars + len(said)
                line.append(now)
                if leaf is not None:
                    yield leaf, now.n, now.turns.hexdigest(), now.loss_chars, now.loss.hexdigest(), now.chars

        yield from _in_rows(each(), _READ)

    rows = segments.repartition("sequence").sortWithinPartitions("sequence", "segment")
    return rows.select("sequence", "ids", "position", "loss_start", "loss_end", "start", "ancestors", "leaf").mapInArrow(made, "leaf binary, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def chat_segments(rows: DataFrame, path: str, sequence: int = SEQUENCE) -> tuple[DataFrame, DataFrame]:
    """The segments of ``rows(conv_id, turn, role, text)``, and which leaf is each conversation's; both are written tables."""
    with tidy_shuffles(rows.sparkSession):
        turns = written(turns_of(rows), "turns")
        paths = written(paths_of(turns), "paths")
        plan = written(depth_first(paths, sequence), "plan")
        segments = written(segments_of(turns, plan, path), "segments")
        members = written(paths.select("conv_id", "leaf"), "members")
        discard(turns, paths, plan)
        return segments, members


def of_members(members: DataFrame, read: DataFrame) -> DataFrame:
    """``read`` for each conversation. A path with more than a HOT_PART of all conversations, of which there can't be more than HOT_PART, is dealt out by salt."""
    least = members.count() // HOT_PART + 1000
    hot = members.groupBy("leaf").count().filter(F.col("count") > least).select("leaf", F.ceil(F.col("count") / least).alias("salts"))
    if hot.isEmpty():
        return members.join(read, "leaf").drop("leaf")
    hot = F.broadcast(hot)
    dealt: Column = F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("salts", F.lit(1)) - 1))
    left = members.join(hot, "leaf", "left").withColumn("salt", F.pmod(F.xxhash64("conv_id"), F.coalesce("salts", F.lit(1)))).drop("salts")
    right = read.join(hot, "leaf", "left").withColumn("salt", dealt).drop("salts")
    return left.join(right, ["leaf", "salt"]).drop("leaf", "salt")


def chat_tree(rows: DataFrame, path: str, sequence: int = SEQUENCE) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars of each conversation, read back from its segments."""
    segments, members = chat_segments(rows, path, sequence)
    with tidy_shuffles(rows.sparkSession):
        read = written(read_back(segments, path), "read")
        out = written(of_members(members, read).select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"), "conversations")
        discard(segments, members, read)
        return out
