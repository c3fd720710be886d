"""Registered queries of the operators; each takes a session and a folder of tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrain.llm import byte_bpe, hard_negatives, language, packing, repeated_bytes, simhash
from tillgrain.llm import spelling, suffix_matches, surrogates, token_files, toxicity, vector_tree, wrappers
from tillgrain.llm.rows import table

#: Key of the surrogates; a deployment passes a secret of its own to the operator.
SURROGATE_KEY = b"key of the registered query"

Query = Callable[[SparkSession, str], DataFrame]


def _simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"), words=3, budget=2)


def _language(spark: SparkSession, folder: str) -> DataFrame:
    """Pages by markup, address and host; documents by text and source."""
    documents = table(spark, folder, "documents")
    model = language.train(documents)
    none = F.lit(None).cast("bigint")
    pages = table(spark, folder, "pages").select(
        none.alias("doc_id"), F.col("page_id").cast("bigint").alias("page_id"), "html",
        language.host_of().alias("_host"), language.declared_language().alias("_declared"),
    )
    texts = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), none.alias("page_id"), "text",
        F.col("source").cast("string").alias("_host"), F.lit(None).cast("string").alias("_declared"),
    )
    keys = ["doc_id", "page_id"]
    return language.identify(texts, keys, "text", model).unionByName(
        language.identify(pages, keys, "html", model, markup=True)
    )


def _decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_matches.match_digests(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )
    return found.drop("hit_starts", "hit_ends")


def _toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def _byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.encoded_digests(
        table(spark, folder, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def _repeated_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of a text is given as text too: bytes that are no UTF-8 any more become U+FFFD."""
    found = repeated_bytes.with_repeats_removed(table(spark, folder, "documents"))
    return found.withColumn("text", F.make_valid_utf8(F.col("kept").cast("string"))).drop("kept")


def _neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return vector_tree.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def _main_text(spark: SparkSession, folder: str) -> DataFrame:
    return wrappers.extract_pages(table(spark, folder, "pages"))


def _surrogates(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return surrogates.pseudonymised(documents, SURROGATE_KEY).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.col("_entities").alias("n_entities")
    )


def _token_files(spark: SparkSession, folder: str) -> DataFrame:
    target = token_files.new_folder(spark)
    parts = token_files.write_tokens(
        table(spark, folder, "documents"), target, public_tokenizers.path("word_bpe_49k.json")
    )
    return token_files.read_documents(parts, target)


def _spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variant_groups(table(spark, folder, "documents"))


def _packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed_sequences(
        table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )


def _hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mined(table(spark, folder, "embeddings"), F.col("id") % 100 == 0, label)


def queries() -> dict[str, Query]:
    return {
        "op1_simhash": _simhash,
        "op2_language_id": _language,
        "op3_decontamination": _decontamination,
        "op4_toxicity": _toxicity,
        "op5_byte_bpe": _byte_bpe,
        "op6_repeated_bytes": _repeated_bytes,
        "op7_nearest_neighbours": _neighbours,
        "op8_html_main_text": _main_text,
        "op9_pii_surrogates": _surrogates,
        "op10_token_files": _token_files,
        "op11_spelling_variants": _spelling,
        "op12_best_fit_packing": _packing,
        "op13_hard_negatives": _hard_negatives,
    }


# The words of a text, windows of its items, and what they cover of each document.
DECONTAMINATION_SQL = r"""
WITH lettered AS (
  SELECT row_number() OVER () AS line, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
tests AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark WHERE item_id IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, size, array_to_string(words[i : i + size - 1], ' ') AS phrase
  FROM (SELECT item_id, words, least(13, len(words)) AS size,
               unnest(generate_series(1, len(words) - least(13, len(words)) + 1)) AS i
        FROM tests WHERE len(words) > 0)),
places AS (
  SELECT line, size, unnest(generate_series(1, len(words) - size + 1)) AS i, words
  FROM lettered, (SELECT DISTINCT size FROM windows) WHERE len(words) >= size),
hits AS (
  SELECT line, item_id, i, size
  FROM (SELECT line, size, i, array_to_string(words[i : i + size - 1], ' ') AS phrase FROM places)
       JOIN windows USING (size, phrase)),
covered AS (
  SELECT line, count(DISTINCT place) AS n_hit
  FROM (SELECT line, unnest(generate_series(i, i + size - 1)) AS place FROM hits) GROUP BY line),
named AS (
  SELECT line, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT line, CAST(item_id AS VARCHAR) AS name FROM hits) GROUP BY line)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM lettered LEFT JOIN covered USING (line) LEFT JOIN named USING (line)"""


# Integer inner products of the anchors with all rows; those of the given tables are exact as doubles.
HARD_NEGATIVES_SQL = """
WITH scaled AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, x -> floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, x -> x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
         CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM scaled a JOIN scaled r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id AND len(a.v) = len(r.v)),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10"""


def oracle_sql() -> dict[str, str]:
    """SQL for DuckDB, where it can say what an operator does at a bearable cost."""
    return {"op3_decontamination": DECONTAMINATION_SQL, "op13_hard_negatives": HARD_NEGATIVES_SQL}
