"""The stages, each on its own input, and the whole run against a plain version."""

from __future__ import annotations

import public_tokenizers
import pytest

import brute
import corpus_pipeline
from tillgrain.llm import simhash, surrogates

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_stages_return_the_columns_of_documents(spark, documents):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language ID", "SimHash near-dedup", "benchmark decontamination", "PII", "byte-level BPE"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, documents, FOLDER).columns == documents.columns, name
        assert stage(spark, documents.limit(0), FOLDER).count() == 0, name
    odd = spark.createDataFrame(
        [(1, None, "en", "s", 0), (1, None, "en", "s", 0), (2, "", None, None, None), (None, "a b c d e f", "en", "s", 11)],
        documents.schema,
    )
    for _, stage in corpus_pipeline.STAGES:
        odd = stage(spark, odd, FOLDER)
    assert odd.columns[0] == "doc_id" and odd.count() == 1


def test_run_equals_the_plain_version(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    kept = {key for key, _, component in brute.simhash(rows) if key == component}
    assert {r["doc_id"] for r in corpus_pipeline.simhash_near_dedup(spark, documents, FOLDER).collect()} == kept
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    clean = {r[0] for r in brute.decontamination(rows, items) if not r[5]}
    left = [(i, t) for i, t in rows if i in kept & clean]
    made = [(i, surrogates.replace_text(t, corpus_pipeline.SURROGATE_KEY)) for i, t in left]
    wanted = brute.byte_bpe(made, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    found = {tuple(r) for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert found == wanted


def test_one_document_of_each_group_of_copies_stays(spark):
    base = [f"w{i}" for i in range(600)]
    rows = [(i, " ".join([*base[:2], f"only{i}", *base[3:]])) for i in range(300)] + [(999, "quite another text of its own")]
    rows += [(2000 + i, "one text, many times") for i in range(500)] + [(None, "one text, many times")] * 2
    wanted = {key for key, _, component in brute.simhash(rows[:-2]) if key == component}
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    found = [r["doc_id"] for r in corpus_pipeline.simhash_near_dedup(spark, df, FOLDER).collect()]
    assert len(found) == len(set(found)) and set(found) == wanted
    again = [r["doc_id"] for r in simhash.deduplicated(df.limit(0)).collect()]
    assert again == []


def test_clashing_columns_pass_through_every_stage_but_the_last(spark, documents):
    clashing = ["_entities", "_row", "body", "row", "found", "bits", "key", "_bits", "_id", "first", "print"]
    odd = documents.limit(40)
    for name in clashing:
        odd = odd.selectExpr("*", f"'x' AS `{name}`")
    odd = odd.unionByName(odd)  # every row twice
    for name, stage in corpus_pipeline.STAGES[:-1]:
        odd = stage(spark, odd, FOLDER)
        assert odd.columns == [*documents.columns, *clashing], name
    assert odd.count() == odd.select("doc_id").distinct().count() > 0
