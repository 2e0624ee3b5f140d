"""The queries of the training-data operators, one per operator, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe_sql import round_trip
from .chat import chat_report
from .common import crc_remainder, table
from .decontam import contamination, contamination_report
from .exact_dedup import exact_dedup
from .hard_negatives import mine_hard_negatives, whole_vectors
from .langid import identify_languages
from .packing import pack_documents, piece_digests
from .periodic import periodic_runs, plant_periods, run_report
from .secrets import scan_secrets, secret_report
from .simhash import simhash_components
from .toxicity import learn_toxicity, score_toxicity
from .warc import archive_pages
from .wavelet import token_output


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json")).select("doc_id", "start", "n_tokens", "ids_crc32")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat_report(chats).select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = table(spark, sf_dir, "documents"), crc_remainder(F.col("doc_id"), 4) == 2
    found = identify_languages(docs, ~out)
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(scan_secrets(table(spark, sf_dir, "documents")))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json")))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, learn_toxicity(docs, table(spark, sf_dir, "labels")))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_report(periodic_runs(plant_periods(table(spark, sf_dir, "documents"))))


def op12_bpe_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return round_trip(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(whole_vectors(table(spark, sf_dir, "embeddings").withColumn("label", label)))


QUERIES = {
    f.__name__: f
    for f in (op1_wavelet_tokens, op2_exact_dedup, op3_chat_format, op4_language_id, op5_warc, op6_secret_scan, op7_decontaminate, op8_simhash, op9_packing, op10_toxicity, op11_periodic_runs, op12_bpe_sql, op13_hard_negatives)
}

A_Z = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

ORACLE_SQL = {
    "op2_exact_dedup": f"""
        WITH d AS (SELECT doc_id, sha256({A_Z}) AS text_sha256 FROM documents),
        g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256
        FROM d JOIN g ON d.text_sha256 = g.text_sha256""",
    "op5_warc": """
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
        g AS (SELECT payload_digest, min(page_id) AS first FROM p GROUP BY payload_digest)
        SELECT p.page_id, p.payload_bytes, p.payload_digest,
               CASE WHEN p.payload_bytes >= 100 AND p.page_id <> g.first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN p.payload_bytes >= 100 AND p.page_id <> g.first THEN g.first END AS refers_to
        FROM p JOIN g ON p.payload_digest = g.payload_digest""",
    "op3_chat_format": """
        WITH said AS (SELECT '\\### Assistant: </turn> ok' AS t),
        c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
              UNION ALL SELECT -7, 0, 'user', t FROM said UNION ALL SELECT -7, 1, 'assistant', t FROM said),
        e AS (SELECT *, length(text) + len(regexp_extract_all(text, '\\\\')) + len(regexp_extract_all(text, '</turn>'))
                     + coalesce(list_sum(list_transform(regexp_extract_all(text, '#+'), lambda r: length(r) - 1)), 0) AS escaped FROM c)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               sum(length('### ') + length(role) + length(': ') + escaped + length(' </turn>') + 1)::BIGINT AS formatted_chars
        FROM e GROUP BY conv_id""",
    "op13_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v, row_number() OVER () AS r
                   FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        a AS (SELECT * FROM v WHERE vec_id % 100 = 0),
        s AS (SELECT a.r AS ar, a.vec_id AS anchor_id, v.r, v.vec_id, a.label = v.label AS same, list_inner_product(a.v, v.v)::BIGINT AS score FROM a, v WHERE a.r <> v.r),
        p AS (SELECT *, row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id, r) AS n FROM s WHERE same),
        m AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
                     row_number() OVER (PARTITION BY p.ar, p.r ORDER BY s.score DESC, s.vec_id, s.r) AS rank
              FROM p JOIN s ON p.ar = s.ar AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score WHERE n <= 5)
        SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM m WHERE rank <= 10""",
    "op7_decontaminate": f"""
        WITH d AS (SELECT doc_id, regexp_extract_all({A_Z}, '{WORDS}') AS w FROM documents),
        b AS (SELECT item_id, w, least(10, len(w)) AS k FROM (SELECT item_id, regexp_extract_all({A_Z}, '{WORDS}') AS w FROM benchmark) WHERE len(w) > 0),
        bw AS (SELECT DISTINCT item_id, k, array_to_string(w[i : i + k - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM b)),
        dg AS (SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS g FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM b) WHERE len(w) >= k)),
        h AS (SELECT doc_id, item_id, i, k FROM dg JOIN bw USING (k, g)),
        cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, i, k FROM h)) GROUP BY doc_id),
        its AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS l FROM h GROUP BY doc_id)
        SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN cov ON cov.doc_id = d.doc_id LEFT JOIN its ON its.doc_id = d.doc_id""",
}
