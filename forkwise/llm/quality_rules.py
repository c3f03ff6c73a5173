"""Quality rules: base word statistics and a hashed n-gram likelihood-ratio verdict.

Every document is scored by the log-likelihood ratio of its hashed word unigrams and
bigrams between two multinomials: that of a trusted target and that of the raw corpus.
The sum is divided by the number of n-grams and compared with a fixed threshold.
Everything is a DataFrame expression.

Bucket weights are rounded to whole multiples of 2**-20, so a document's score is an exact
whole number whatever order the terms are added in, and the verdict is deterministic.

Defined cases: null text counts as none (no words, base_failed); a text of one word has one
n-gram; an empty table gives an empty result; with no trusted documents all weights are
zero and the method keeps every document. Rows are judged one by one, so repeated rows and
repeated or null ids each get their own row. Other columns of the input are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_enough

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
SCALE = 1 << 20
BUCKETS = 1 << 16
#: Least mean log-likelihood ratio of an n-gram, in multiples of 1/SCALE.
THRESHOLD = -round(0.10 * SCALE)
#: Trusted ids up to this many are broadcast (about 32 MB); more are joined by a shuffle.
BROADCAST_IDS = 2_000_000


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of ``value``, which is worked out once for the row, not again for each element that refers to it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.conv(F.substring(F.md5(w.cast("binary")), 1, 8), 16, 10).cast("bigint"))


def buckets_of(h: Column, buckets: int) -> Column:
    """Buckets of all unigrams, then of all bigrams and a null for the one that the last word doesn't begin."""
    two = F.transform(h, lambda x, i: ((x * 31 + F.get(h, i + 1) + 7) % buckets).cast("int"))
    return F.concat(F.transform(h, lambda x: (x % buckets).cast("int")), two)


def bucket_weights(docs: DataFrame, trusted_ids: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Scaled log ratio of each bucket; counts cover every document. Fixed size: one number a bucket."""
    ids = trusted_ids.select(F.col(trusted_ids.columns[0]).alias("doc_id")).filter(F.col("doc_id").isNotNull()).distinct()
    ids = ids.withColumn("trusted", F.lit(1))
    ids = F.broadcast(ids) if small_enough(ids, BROADCAST_IDS) else ids
    rows = docs.select("doc_id", "text").join(ids, "doc_id", "left")
    rows = rows.select(F.coalesce("trusted", F.lit(0)).alias("trusted"), words_of(F.col("text")).alias("words"))
    rows = rows.filter(F.size("words") > 0).select("trusted", word_hashes(F.col("words")).alias("h"))

    grams = rows.select("trusted", F.explode(let(F.col("h"), lambda h: buckets_of(h, buckets))).alias("bucket"))
    counts = grams.filter("bucket IS NOT NULL").groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("trusted").alias("good")).collect()
    raw, good = sum(r["raw"] for r in counts), sum(r["good"] for r in counts)
    weights = [0] * buckets
    if good:
        for r in counts:
            ratio = math.log((r["good"] + 1) / (good + buckets)) - math.log((r["raw"] + 1) / (raw + buckets))
            weights[r["bucket"]] = round(ratio * SCALE)
    return weights


def repeat_words(win: Column) -> Column:
    """How many words lie in windows of five that occur twice or more; ``win`` has a hash for each window."""

    def covered(s: Column) -> Column:
        def marked(x: Column, i: Column) -> Column:
            before, after = F.get(s, i - 1)["h"] == x["h"], F.get(s, i + 1)["h"] == x["h"]
            return F.struct(x["p"].alias("p"), (F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))).alias("d"))

        at = F.array_sort(F.transform(F.filter(F.transform(s, marked), lambda y: y["d"]), lambda y: y["p"]))
        start = F.struct(F.lit(-5).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(at, start, lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(5), p - acc["last"])).alias("n")), lambda acc: acc["n"])

    pairs = F.sort_array(F.transform(win, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
    return F.when(F.size(F.array_distinct(win)) == F.size(win), F.lit(0)).otherwise(let(pairs, covered))


def quality_rules(docs: DataFrame, weights: list[int], threshold: int = THRESHOLD) -> DataFrame:
    """Base statistics and verdict of every row of ``docs(doc_id, text)``.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (bigint),
    base_failed, kept, n_grams, llr_scaled.
    """
    return _judged(docs, F.col("doc_id"), "doc_id", weights, threshold)


def kept_documents(docs: DataFrame, weights: list[int], threshold: int = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    judged = _judged(docs, F.struct(*(F.col(f"`{c}`") for c in docs.columns)), "row", weights, threshold)
    # A filter would be pushed below, and work each statistic out again wherever the verdict refers to it.
    one = F.filter(F.array(F.struct("row", "kept")), lambda x: x["kept"])
    return judged.select(F.explode(one).alias("x")).select("x.row.*")


def _judged(docs: DataFrame, carried: Column, name: str, weights: list[int], threshold: int) -> DataFrame:
    buckets = len(weights)
    table = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<bigint>")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(carried.alias(name), text.alias("text"), words_of(F.col("text")).alias("words"))
    lines = F.filter(F.split(F.col("text"), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def windows(v: Column) -> Column:
        each = F.transform(v, lambda x, i: F.xxhash64(x, *(F.get(v, i + j) for j in range(1, 5))))
        return F.slice(each, 1, F.greatest(F.lit(0), F.size(v) - 4))

    rows = rows.select(
        name,
        F.size("words").alias("n_words"),
        F.char_length(F.array_join("words", "")).alias("word_chars"),
        (F.char_length("text") - F.char_length(F.regexp_replace("text", SYMBOLS, ""))).alias("n_symbols"),
        lines.alias("lines"),
        let(F.transform("words", lambda w: F.xxhash64(w)), windows).alias("win"),
        word_hashes(F.col("words")).alias("h"),
    )

    grams = let(F.col("h"), lambda h: buckets_of(h, buckets))
    score = F.aggregate(grams, F.lit(0).cast("bigint"), lambda acc, x: acc + F.coalesce(F.get(table, x), F.lit(0)))
    rows = rows.select(
        name, "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        let(F.col("win"), repeat_words).alias("n_repeat_words"),
        F.greatest(F.lit(0), 2 * F.size("h") - 1).cast("bigint").alias("n_grams"),
        score.alias("llr_scaled"),
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    good = F.col("llr_scaled") >= F.lit(threshold) * F.col("n_grams")
    return rows.select(
        name, *(F.col(c).cast("bigint").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        failed.alias("base_failed"), (~failed & good).alias("kept"), "n_grams", "llr_scaled",
    )
