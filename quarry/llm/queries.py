"""The registered queries of this subpackage: each applies its operator to the whole test table and
keeps the columns of the query's contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import bpe, conversations, exact_dedup, fim, htmltext, langid, near_dedup, packing, secrets, simhash, token_counts, topk, warc
from quarry.llm._common import scratch_path, table


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path).drop("payload", "target_uri")


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.exact_top_k(vectors, vectors.filter(F.pmod("vec_id", F.lit(50)) == 0), k=5)


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2, threshold=0.8)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprint_edits(table(spark, sf_dir, "documents"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), limit=512)


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract_main_text(table(spark, sf_dir, "pages"))


def fim_digests(docs: DataFrame) -> DataFrame:
    return fim.restore(fim.fill_in_middle(docs)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim_digests(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return conversations.audit_conversations(turns, conversations.damaged(turns))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"), digest_all=True)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_warc, op2_exact_topk, op3_minhash_dedup, op4_simhash, op5_bpe, op6_token_counts,
                                   op7_secrets, op8_packing, op9_language_id, op10_main_text,
                                   op11_fill_in_middle, op12_conversation_repair, op13_exact_dedup, pipeline)}

SQL = {
    "op2_exact_topk": """
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score
FROM (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score,
             row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.v, c.v) DESC, c.vec_id) AS place
      FROM (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
            WHERE vec_id % 50 = 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0) q
      JOIN (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
            WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0) c ON c.vec_id <> q.vec_id)
WHERE place <= 5""",
    "op11_fill_in_middle": """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS units,
         list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), i, 8) AS BIGINT)) AS h
  FROM documents),
c AS (SELECT *, least(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) AS a, greatest(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) AS b,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 50 THEN 'plain'
                  WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
      FROM d),
s AS (SELECT *, array_to_string(units[1:a], '') AS p, array_to_string(units[a + 1:b], '') AS m, array_to_string(units[b + 1:], '') AS s FROM c)
SELECT doc_id, CAST(len(units) AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM s""",
    "op13_exact_dedup": """
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER best = 1 AS kept, text_sha256
FROM (SELECT doc_id, length(coalesce(text, '')) AS chars,
             sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256 FROM documents)
WINDOW best AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id NULLS LAST)""",
}
