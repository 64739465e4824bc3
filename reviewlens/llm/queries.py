"""The registered queries of the thirteen operators: (spark, sf_dir) -> DataFrame over the whole table, and DuckDB SQL where it can express them."""

from __future__ import annotations

import string
from collections.abc import Callable
from fractions import Fraction

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.llm import bpe, dedup, extract, langid, lbl, manifest, mixing, ngram_join, packing, prefix_trie, repetition, sampling, sql, warc
from reviewlens.llm.common import table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
#: every 97th page's record is damaged in the copy that op4 audits
DAMAGED = "page_id % 97 = 13"


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"), 3, Fraction(9, 10)).select("doc_id", "n_shingles", "component_id")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs.select("doc_id", "source"), mixing.flattened_weights(docs)).select("row.doc_id", "source", "mix_slot", "mix_place", "mix_block", "mix_release", "mix_deadline")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.read_packed(packing.write_packed(table(spark, sf_dir, "documents"), TOKENIZER, END_ID))


def op4_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_warc(table(spark, sf_dir, "pages"))
    return warc.audit(index, warc.copy_files(index, damage=DAMAGED))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract_pages(table(spark, sf_dir, "pages"))


def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), TOKENIZER, ("n_tokens", "ids_sha256", "decoded_sha256"))


def op7_log_bilinear_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = lbl.score_documents(table(spark, sf_dir, "documents"))
    return scores.select("doc_id", (~F.col("learned_from")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_dedup(table(spark, sf_dir, "documents")).withColumnRenamed("text_digest", "text_sha256")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(docs, langid.train(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op10_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition_rules(table(spark, sf_dir, "documents")).drop("repeats")


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    altered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, manifest.lower_ascii(text)).otherwise(text)
    found = manifest.manifest(table(spark, sf_dir, "documents"), tampered={"text": altered})
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_weighted_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.fingerprint_documents(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_ngram_jaccard_join, op2_mix_sources, op3_token_files, op4_warc_fixity, op5_main_text, op6_bpe_round_trip, op7_log_bilinear_score, op8_exact_dedup, op9_language_id, op10_repetition_rules,
              op11_conversation_trie, op12_merkle_manifest, op13_weighted_fingerprints)
}

_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

ORACLE: dict[str, str] = {
    "op1_ngram_jaccard_join": rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * o >= 90 * (nx.n + ny.n - o)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id, doc_id AS id FROM documents UNION SELECT e.y, r.id FROM r JOIN e ON e.x = r.doc_id)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.id) AS component_id
FROM documents d JOIN r ON r.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id""",
    "op4_warc_fixity": rf"""
WITH r AS (
  SELECT page_id, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:x-page:' || page_id || '>' || chr(13) || chr(10)
    || 'WARC-Date: {warc.DATE}' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10)
    || 'Content-Length: ' || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10) || html || chr(13) || chr(10) || chr(13) || chr(10) AS rec FROM pages)
SELECT page_id, row_number() OVER (ORDER BY page_id) - 1 AS number,
  coalesce(sum(strlen(rec)) OVER (ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset",
  strlen(rec) AS size, sha256(rec) AS record_sha256, {DAMAGED} AS damaged FROM r""",
    "op8_exact_dedup": r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS raw, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
k AS (SELECT *, first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(raw) DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM k""",
    "op11_conversation_trie": sql.CONVERSATION_TRIE,
    "op12_merkle_manifest": sql.merkle_manifest(),
}
