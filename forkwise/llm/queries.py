"""The operators applied to the driver's tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, chat_tree, fill_in_middle, jaccard_join, license_scan, neighbours, packing, pii, quality_classifier, quality_rules, token_counts, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def fold() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string")) % 3


def trained_ranker(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality_classifier.Ranker:
    return quality_classifier.train(docs, table(spark, sf_dir, "labels").filter(fold() != 1))


def op1_bradley_terry_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scores = quality_classifier.classify(docs, trained_ranker(spark, docs, sf_dir))
    held_out = F.coalesce(fold() == 1, F.lit(False))
    return scores.select("doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op2_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.harmonic_packing(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op3_k_means_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer("byte_bpe_50k.json")
    coded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    listed = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op5_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import new_folder

    chunks = warc.chunk_table(warc.records(table(spark, sf_dir, "pages")))
    back = warc.read_archives(warc.write_archives(chunks, new_folder(spark, "archives"))).filter("last")
    revisit = F.col("record_type") == "revisit"
    return back.select(
        "page_id",
        F.when(revisit, F.col("declared_bytes")).otherwise(F.col("bytes_so_far")).alias("payload_bytes"),
        F.when(revisit, F.col("payload_digest")).otherwise(F.col("sha1_so_far")).alias("payload_digest"),
        "record_type", "refers_to",
    )


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")


def op6_ngram_llr_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules.quality_rules(docs, quality_rules.bucket_weights(docs, trusted_ids(spark, sf_dir))).drop("n_grams", "llr_scaled")


def op7_resynchronised_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.license_scan(table(spark, sf_dir, "documents"))
    shown = F.transform("matches", lambda m: F.concat_ws(":", m["license"], m["start"].cast("string"), m["end"].cast("string")))
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"])))
    different = F.aggregate("matches", F.lit(0), lambda n, m: n + F.size(m["differences"]))
    return found.select("doc_id", F.size("matches").cast("bigint").alias("n_matches"), F.concat_ws(",", names).alias("licenses"), F.concat_ws(",", shown).alias("spans"), different.alias("n_differing_words"))


def op9_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), 4, 85)


def _joined(spans: F.Column) -> F.Column:
    kinds = F.array(*map(F.lit, pii.KINDS))
    return F.concat_ws(",", F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))


def op10_bilstm_crf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.train(docs)).withColumn("all", F.concat("base", "added"))

    def n(kind: int) -> F.Column:
        return F.size(F.filter("all", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{pii.KINDS[kind]}")

    return found.select("doc_id", *map(n, range(len(pii.KINDS))), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("all")).alias("spans"))


def op11_chat_prefix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select(*planted.columns).unionByName(planted)
    return chat_tree.chat_tree(rows, tokenizer("byte_bpe_50k.json"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    back = fill_in_middle.restored(F.col("output"), F.col("form"))
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


QUERIES = {f.__name__: f for f in (op1_bradley_terry_quality, op2_harmonic_packing, op3_k_means_tree_search, op4_bpe_round_trip, op5_warc_round_trip, op6_ngram_llr_rules, op7_resynchronised_counts, op8_license_scan, op9_jaccard_components, op10_bilstm_crf_pii, op11_chat_prefix_tree, op12_tokenizer_alignment, op13_fill_in_middle)}

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

ORACLES = {
    "op5_warc_round_trip": """
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
        k AS (SELECT digest, max(page_id) AS keeper FROM p WHERE n >= 1000 GROUP BY digest HAVING count(*) > 1)
        SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
          CASE WHEN keeper IS NOT NULL AND page_id IS DISTINCT FROM keeper THEN 'revisit' ELSE 'response' END AS record_type,
          CASE WHEN keeper IS NOT NULL AND page_id IS DISTINCT FROM keeper THEN keeper END AS refers_to
        FROM p LEFT JOIN k USING (digest)""",
    "op6_ngram_llr_rules": rf"""
        WITH w AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS ws FROM documents),
        f AS (SELECT doc_id, text, ws, len(ws) AS n, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM w),
        u AS (SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM f),
        l AS (SELECT doc_id, i, x, lead(x, 1) OVER d AS x1, lead(x, 2) OVER d AS x2, lead(x, 3) OVER d AS x3, lead(x, 4) OVER d AS x4 FROM u WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
        dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x, x1, x2, x3, x4) AS c FROM l WHERE x4 IS NOT NULL) WHERE c > 1),
        rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM dup) GROUP BY doc_id),
        h AS (SELECT doc_id, i, ('0x' || substr(md5(x), 1, 8))::BIGINT AS h FROM u),
        nx AS (SELECT doc_id, h, lead(h) OVER (PARTITION BY doc_id ORDER BY i) AS h2 FROM h),
        g AS (SELECT doc_id, h % {quality_rules.BUCKETS} AS b FROM nx UNION ALL SELECT doc_id, (h * 31 + h2 + 7) % {quality_rules.BUCKETS} FROM nx WHERE h2 IS NOT NULL),
        good AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1),
        c AS (SELECT b, count(*) AS r, count(good.doc_id) AS t FROM g LEFT JOIN good USING (doc_id) GROUP BY b),
        s AS (SELECT sum(r) AS r, sum(t) AS t FROM c),
        wt AS (SELECT b, CASE WHEN s.t > 0 THEN round((ln((c.t + 1) / (s.t + {quality_rules.BUCKETS})) - ln((c.r + 1) / (s.r + {quality_rules.BUCKETS}))) * {quality_rules.SCALE})::BIGINT ELSE 0 END AS wt FROM c, s),
        llr AS (SELECT doc_id, sum(wt) AS s, count(*) AS m FROM g JOIN wt USING (b) GROUP BY doc_id),
        a AS (SELECT f.doc_id, f.n::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
            (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
            (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words, llr.s, llr.m
          FROM f LEFT JOIN rep USING (doc_id) LEFT JOIN llr USING (doc_id))
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
          n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
          NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND s >= {quality_rules.THRESHOLD} * m AS kept FROM a""",
    "op9_jaccard_components": r"""
        WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
        u AS (SELECT doc_id, len(ws) AS m, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM w),
        v AS (SELECT doc_id, m, i, concat_ws(' ', x, lead(x, 1) OVER d, lead(x, 2) OVER d, lead(x, 3) OVER d) AS g FROM u WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
        s AS (SELECT DISTINCT doc_id, g FROM v WHERE i <= greatest(1, m - 3)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
        l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
        r(a, b) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
        SELECT r.a AS doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles, min(r.b) AS component_id FROM r LEFT JOIN n ON n.doc_id = r.a GROUP BY r.a""",
    "op11_chat_prefix_tree": r"""
        WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          UNION ALL SELECT -1, i, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(i, r)),
        f AS (SELECT *, CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 5 WHEN 'system' THEN 19 ELSE 18 + length(regexp_replace(role, '([\[<])(\\*)(/?INST\]|/?ROLE\]|/?s>|</?SYS>>)', '\1\\\2\3', 'g')) END
            + length(regexp_replace(text, '([\[<])(\\*)(/?INST\]|/?ROLE\]|/?s>|</?SYS>>)', '\1\\\2\3', 'g')) AS chars FROM c)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
          coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
          sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(chars)::BIGINT AS formatted_chars
        FROM f GROUP BY conv_id""",
    "op13_fill_in_middle": r"""
        WITH u AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS us, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
        d AS (SELECT doc_id, text, us, len(us)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2, ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM u),
        f AS (SELECT doc_id, text, us, n, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
            least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi FROM d),
        p AS (SELECT doc_id, text, n, form, array_to_string(us[1:lo], '') AS a, array_to_string(us[lo + 1:hi], '') AS m, array_to_string(us[hi + 1:], '') AS z FROM f)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(a)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
          sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || a || '<S>' || z || '<M>' || m ELSE '<S>' || z || '<P>' || a || '<M>' || m END) AS output_sha256,
          sha256(text) AS restored_sha256 FROM p""",
}
