"""Fill-in-middle transformation by a two-pass streaming matcher.

A text is a run of units: white space and the word after it, or white space alone. The first
pass counts the units; the ranks of both cuts follow from the count and the document's hash.
The second advances a lazy match iterator to both ranks. Neither pass stores a unit, so
beside the text and its result only a few numbers are held.

Defined cases: null text is empty, and an empty text is plain with no units. A text that
holds a marker is plain, so markers stand in an output once each or not at all. Only white
space is one unit. A null id hashes as if it had no digits. Repeated rows each give a row;
empty tables give empty results; other columns are ignored. Texts of any length are taken
whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices

# The unit's pattern and the markers before prefix, suffix and middle.
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
MARKERS = ("<P>", "<S>", "<M>")
SEED, RATE, SPM_SHARE = 42, 50, 80


def drawn(seed: int, doc_id: int | None) -> list[int]:
    """Four numbers that the seed and the id decide."""
    digest = sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def cut_offsets(text: str, low: int, high: int) -> tuple[int, int]:
    """Where unit ``low`` and unit ``high`` end, counted from 1; 0 for the text's beginning."""
    units, ends, passed = UNIT.finditer(text), [0, 0], 0
    for i, rank in enumerate((low, high)):
        if rank > passed:
            ends[i] = next(islice(units, rank - passed - 1, None)).end()
            passed = rank
        elif i:
            ends[i] = ends[0]
    return ends[0], ends[1]


def transform(text: str, doc_id: int | None, seed: int = SEED, rate: int = RATE, spm_share: int = SPM_SHARE) -> tuple[int, str, int | None, int | None, str]:
    """Units, form, characters of prefix and middle (null if plain), and the output."""
    n = sum(1 for _ in UNIT.finditer(text))
    h1, h2, h3, h4 = drawn(seed, doc_id)
    if not text or h3 % 100 >= rate or any(m in text for m in MARKERS):
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m = cut_offsets(text, low, high)
    before, suffix, middle = MARKERS
    if h4 % 100 < spm_share:
        return n, "spm", p, m - p, "".join((suffix, text[m:], before, text[:p], middle, text[p:m]))
    return n, "psm", p, m - p, "".join((before, text[:p], suffix, text[m:], middle, text[p:m]))


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_share: int = SPM_SHARE) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output of every row of ``docs(doc_id, text)``.

    ``rate`` percent of documents are cut, ``spm_share`` percent of these with the suffix first.
    """

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 256):
            rows = [transform(t or "", i, seed, rate, spm_share) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            n, form, prefix, middle, output = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.string())],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(made, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The exact text of an output, from its markers and its form.

    No marker ends as another begins, so text beside a marker can't make a further one.
    """
    before, suffix, middle = (rf"\Q{m}\E" for m in MARKERS)
    halves = F.split(output, middle, 2)
    psm, spm = F.split(halves[0], suffix, 2), F.split(halves[0], before, 2)
    own = len(MARKERS[0])
    from_psm = F.concat(F.substr(psm[0], F.lit(own + 1)), halves[1], psm[1])
    from_spm = F.concat(spm[1], halves[1], F.substr(spm[0], F.lit(own + 1)))
    return F.when(form == "psm", from_psm).when(form == "spm", from_spm).otherwise(output)
