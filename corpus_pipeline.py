"""A corpus in stages: language, near-duplicates, benchmark passages, personal data, token ids.

Each stage takes (session, documents, folder of tables) and returns a DataFrame, which is
written and read again as the next stage's documents. All but the last return the columns of
``documents``; every stage works on all rows its predecessor kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrain.llm import byte_bpe, language, simhash, suffix_matches, surrogates
from tillgrain.llm.rows import packed, stored, table

#: Words in a shingle, and bits in which linked fingerprints may differ, as in ``op1_simhash``.
SHINGLE_WORDS = 3
DIFFERING_BITS = 2

#: Key of the surrogates; a deployment sets a secret of its own.
SURROGATE_KEY = b"key of the registered pipeline"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.accepted(docs, language.train(docs))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicated(docs, SHINGLE_WORDS, DIFFERING_BITS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_matches.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with surrogates; n_chars follows where a replacement changed the text."""
    found = surrogates.pseudonymised(packed(docs, "text"), SURROGATE_KEY)
    length = F.when(F.col("_entities") > 0, F.length("text")).otherwise(F.col("_row.n_chars"))
    changed = {"text": F.col("text"), "n_chars": length.cast(docs.schema["n_chars"].dataType)}
    return found.select(*[changed.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe.encoded_digests(
        docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("PII", personal_data),
    ("byte-level BPE", byte_level_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


#: No SQL: the stages fit models and walk tries; tests hold them against brute-force versions.
ORACLE_SQL = None
