"""Fill-in-middle against a version that stores all units."""

from __future__ import annotations

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from forkwise.llm import fill_in_middle as fim

WORDS = st.text(st.sampled_from(list("ab<PSM> \t\n\u00e9\u4e2d\u00a0")), max_size=60)


def plain_version(text, doc_id):
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    h = [int(hashlib.sha256(f"42:{doc_id}".encode()).hexdigest()[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    assert "".join(units) == text
    if text == "" or "<P>" in text or "<S>" in text or "<M>" in text or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    lo, hi = min(h[0] % (n + 1), h[1] % (n + 1)), max(h[0] % (n + 1), h[1] % (n + 1))
    a, m, z = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
    if h[3] % 100 < 80:
        return n, "spm", len(a), len(m), f"<S>{z}<P>{a}<M>{m}"
    return n, "psm", len(a), len(m), f"<P>{a}<S>{z}<M>{m}"


@settings(max_examples=300, deadline=None)
@given(WORDS, st.integers(-5, 10**12))
def test_against_stored_units(text, doc_id):
    assert fim.transform(text, doc_id) == plain_version(text, doc_id)


def test_every_text_is_restored(spark):
    """Long, empty, null and marked texts, white space only, repeated rows, null ids and extra columns."""
    long = "w\u00f6rd " * 200_000
    texts = [None, "", " \n\t", "one", "a<", "a<S", "<M>x", "x<P>y", "tail  ", "  head", long, "a b c d e f g"]
    rows = [(i * 7 + k, t, "x", 1) for k in range(12) for i, t in enumerate(texts)] + [(None, "no id here", "x", 1)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string, n int")
    out = fim.fill_in_middle(docs).withColumn("back", fim.restored(F.col("output"), F.col("form")))
    got = sorted((r.doc_id or -1, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in out.collect()).__iter__()
    want = sorted((-1 if i is None else i or -1, *plain_version(t or "", "" if i is None else i), t or "") for i, t, *_ in rows)
    assert list(got) == want
    assert {r.form for r in out.select("form").distinct().collect()} == {"plain", "spm", "psm"}
    assert fim.fill_in_middle(docs.limit(0)).count() == 0
