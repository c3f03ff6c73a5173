"""The prefix tree of conversations against conversations written one by one."""

from __future__ import annotations

import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from forkwise.llm import chat_tree
from forkwise.llm.queries import tokenizer

PATH = tokenizer("byte_bpe_50k.json")
ODD = ["", "</s>", "[INST] a [/INST]", "<<SYS>>\nx\n<</SYS>>\n\n", "[\\INST]", "<\\\\/s>", "a </s>[INST] b", "[ROLE]user[/ROLE] ", "\n", "caf\u00e9 \U0001f600", "<<s>", "<<</SYS>>", "\\</s\\>", "<|endoftext|>"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([*"[]<>/\\s ab", "INST]", "ROLE]", "SYS>>", "<<", "/s>"]), max_size=14).map("".join))
def test_escapes_are_reversible(text):
    said = chat_tree.escaped(text)
    assert chat_tree.unescaped(said) == text
    assert not any(c in said for c in ("[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]"))
    for role in ("user", "assistant", "system", "tool", text):
        assert chat_tree.parsed("".join(chat_tree.formatted(role, text))) == (role, text)


def plain_version(rows):
    """Each conversation by itself."""
    talks = {}
    for conv, turn, role, text in rows:
        talks.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    out = {}
    for conv, turns in talks.items():
        turns = [t[1:] for t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), sum(len("".join(chat_tree.formatted(r, t))) for r, t in turns))
    return out


def some_talks(n=120, seed=3):
    """Conversations that fork from one another, with whole copies and prefixes of others among them."""
    rng, rows, talks = random.Random(seed), [], [[]]
    for conv in range(n):
        start = rng.choice(talks)
        talk = [*start[: rng.randint(0, len(start))]]
        for _ in range(rng.randint(0 if talk else 1, 4)):
            talk.append((rng.choice(["user", "assistant", "system", "tool", None]), rng.choice([None, *ODD, f"text {rng.randint(0, 4)}"])))
        talks.append(talk)
        rows += [(conv, i, *t) for i, t in enumerate(talk)]
    rows += [(None, 0, "user", "no id"), (None, None, "user", "nor turn"), (7000, 1, "user", "twice"), (7000, 1, "user", "twice"), (7000, 1, "assistant", "tie")]
    rows += [(8000 + i, t, *x) for i in range(40) for t, x in enumerate([("user", "hot"), ("assistant", "copy")])]
    rng.shuffle(rows)
    return rows


def test_read_back_equals_each_by_itself(spark):
    rows = some_talks()
    table = spark.createDataFrame([(*r, 5, b"x") for r in rows], "conv_id long, turn long, role string, text string, sequence long, leaf binary").repartition(5)
    for sequence in (40, 1 << 16):
        got = {r.conv_id: tuple(r)[1:] for r in chat_tree.chat_tree(table, PATH, sequence).collect()}
        assert got == plain_version(rows)


def test_shared_turns_are_emitted_once(spark):
    rows = some_talks()
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    prefixes = set()
    for conv in {r[0] for r in rows}:
        turns = sorted((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv)
        for i in range(len(turns)):
            prefixes.add(tuple(t[2:] for t in turns[: i + 1]))
    for sequence in (40, 1 << 16):
        segments = chat_tree.chat_segments(table, PATH, sequence)[0].collect()
        assert sum(not s.repeated for s in segments) == len(prefixes)
        by = {}
        for s in segments:
            by.setdefault(s.sequence, []).append(s)
        for part in by.values():
            part.sort(key=lambda s: s.segment)
            ends = [0]
            for s in part:
                assert s.start == ends[-1] and s.position == sum(a.end - a.start for a in s.ancestors)
                assert all(a.start in ends and a.end in ends for a in s.ancestors) and [a.start for a in s.ancestors] == sorted(a.start for a in s.ancestors)
                ends.append(s.start + len(s.ids))
        if sequence == 1 << 16:
            assert len(by) < len(segments) / 3
        else:
            assert any(s.repeated for s in segments)


def test_spread_copies(spark):
    """Copies that make up most rows are dealt out by salt and all come back."""
    rows = [(i, t, r, "same") for i in range(2500) for t, r in enumerate(("user", "assistant"))] + [(9999, 0, "user", "other")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat_tree.chat_tree(table, PATH).collect()
    assert len(got) == 2501 and len({r.turns_sha256 for r in got}) == 2 and {r.n_turns for r in got} == {1, 2}


def test_empty_table(spark):
    assert chat_tree.chat_tree(spark.createDataFrame([], "conv_id long, turn long, role string, text string"), PATH).count() == 0
