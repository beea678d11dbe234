"""The queries of this folder's operators, each over its whole table."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm import (
    cover_tree,
    decontaminate,
    html_content,
    language_id,
    lexical_search,
    merkle_log,
    piecewise_hash,
    quality_fm,
    recurrent_lm,
    sentencepiece_codec,
    simhash,
    suffix_dedup,
    warc,
)
from tripmill.llm.merkle_sql import manifest_sql
from tripmill.llm.shared import fold_is, table, tokenizer_file

Query = Callable[[SparkSession, str], DataFrame]


def _held_out(modulus: int = 3) -> Column:
    return fold_is(F.col("doc_id"), modulus, 1)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    model = quality_fm.train(docs, table(spark, sf_dir, "labels"), ~_held_out())
    return quality_fm.score(docs, model).select("doc_id", _held_out().alias("held_out"), "score", "predicted")


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.train(docs, ~_held_out())
    found = language_id.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", _held_out().alias("held_out"), "lang_pred", "score")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of each document, and whether they decode to its very text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = tokenizer_file()
    coded = sentencepiece_codec.encode(docs, model, exact="round_trip")
    return coded.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", "round_trip")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_content.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.withColumn("fingerprint", simhash.hex_digits("fingerprint"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = recurrent_lm.score(docs, ~_held_out(5))
    return found.withColumn("held_out", _held_out(5))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piecewise_hash.edited_by_next(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents; of every third, by hash, the text is claimed in lower case."""
    docs = table(spark, sf_dir, "documents")
    fields = [F.col(name) for name in ("doc_id", "source", "lang", "n_chars", "text")]
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    altered = F.when(fold_is(F.col("doc_id"), 3, 0), merkle_log.leaf_digest([*fields[:-1], lowered]))
    rows = docs.select("doc_id", "lang", merkle_log.leaf_digest(fields).alias("leaf"), altered.alias("claimed"))
    manifest = merkle_log.build(rows, "doc_id", "lang", "leaf", "claimed")
    return merkle_log.proofs(manifest, "doc_id")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_quality": op1_quality,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_language_id": op3_language_id,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_html_text": op5_html_text,
    "op6_simhash": op6_simhash,
    "op7_warc": op7_warc,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_recurrent_lm": op9_recurrent_lm,
    "op10_decontaminate": op10_decontaminate,
    "op11_fingerprints": op11_fingerprints,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_lexical_search": op13_lexical_search,
}

#: DuckDB SQL, where it can express a query.
ORACLE_SQL: dict[str, str] = {
    "op12_merkle_manifest": manifest_sql(),
    "op7_warc": """
WITH marked AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), digests AS (
  SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha256(html) AS payload_digest FROM marked
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM digests
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM firsts
""",
    "op10_decontaminate": """
WITH doc_words AS (
  SELECT doc_id, [w FOR w IN regexp_split_to_array(lower(text), '[\\x20\\x09-\\x0D]+') IF w <> ''] AS words
  FROM documents WHERE text IS NOT NULL
), item_words AS (
  SELECT item_id, [w FOR w IN regexp_split_to_array(lower(text), '[\\x20\\x09-\\x0D]+') IF w <> ''] AS words
  FROM benchmark WHERE text IS NOT NULL
), item_shingles AS (
  SELECT DISTINCT item_id, unnest([array_to_string(words[i:i + 4], ' ')
    FOR i IN range(1, greatest(len(words) - 4, 1) + 1)]) AS shingle
  FROM item_words WHERE len(words) > 0
), doc_shingles AS (
  SELECT doc_id, unnest([array_to_string(words[i:i + 4], ' ')
    FOR i IN range(1, greatest(len(words) - 4, 1) + 1)]) AS shingle
  FROM doc_words WHERE len(words) > 0
), sizes AS (
  SELECT item_id, count(*) AS n FROM item_shingles GROUP BY item_id
), found AS (
  SELECT doc_id, item_id, count(DISTINCT shingle) AS n_found
  FROM doc_shingles JOIN item_shingles USING (shingle) GROUP BY doc_id, item_id
)
SELECT doc_id, item_id, CAST(floor(log2(n)) AS INTEGER) AS size_class, CAST(n AS INTEGER) AS n_shingles,
  CAST(n_found AS INTEGER) AS n_found, n_found / n AS containment
FROM found JOIN sizes USING (item_id)
WHERE n_found >= 0.8 * n - 1e-9
""",
    "op13_lexical_search": """
WITH doc_terms AS (
  SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents
), sized AS (
  SELECT doc_id, terms, len(terms) AS n FROM doc_terms WHERE len(terms) > 0
), totals AS (
  SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sized
), held AS (
  SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(terms) AS term FROM sized) GROUP BY ALL
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM benchmark
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * max(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM held, totals GROUP BY term
), scores AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM asked JOIN held USING (term) JOIN weights USING (term), totals GROUP BY item_id, doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scores WHERE score > 0
)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 50
""",
}
