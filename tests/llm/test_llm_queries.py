"""The registered queries: names, SQL, contracts, and the pipeline."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from checks.compare import connect, differences
from postlens.llm.registry import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, name):
    rows, found = differences(QUERIES[name](spark, SF), connect(SF), ORACLE[name])
    assert not found and rows > 0


def test_scores(spark):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name, held_out in (("op1_toxicity", "crc32(cast(doc_id AS string)) % 5 = 0"), ("op2_lm_scoring", "crc32(cast(doc_id AS string)) % 7 = 2"),
                           ("op4_language_id", "crc32(cast(doc_id AS string)) % 4 = 2")):
        found = QUERIES[name](spark, SF).cache()
        assert found.count() == n
        assert found.where(F.expr(held_out) != F.col("held_out")).count() == 0
        assert found.where("score IS NULL").count() == 0


def test_model_beats_single_tokens_on_held_out_texts(spark):
    sums = QUERIES["op2_lm_scoring"](spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert sums[0] > sums[1]


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_copies", "passages", "mixing", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SF).cache()
        assert docs.columns == before.columns and 0 < docs.count()
        if name in ("language", "near_copies", "passages"):
            assert docs.join(before.select("doc_id"), "doc_id", "left_anti").count() == 0
            assert docs.count() == docs.select("doc_id").distinct().count()
    pieces = corpus_pipeline.packing(spark, docs, SF).cache()
    sums = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert sums.where("n > 2048 OR n <> end").count() == 0


@pytest.mark.parametrize("kind", ["empty", "odd"])
def test_pipeline_on_odd_documents(spark, kind):
    text = "The cat sat on the mat. " * 20
    rows = [] if kind == "empty" else [(None, text, None, None, 3), (1, None, "en", "a", None), (2, "", None, "a", 0), (3, text, "en", None, 9),
                                       (3, text, "en", None, 9), (4, text + "and more.", "en", "a", 9), (5, "12 34", "de", "b", 5)]
    # names that the stages use themselves
    fields = "doc_id long, text string, lang string, source string, n_chars long, node string, kind int, `key` string"
    docs = spark.createDataFrame([(*r, "n", 1, "k") for r in rows], fields)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "node", "kind", "key"]
    docs = docs.cache()
    words = docs.select(F.sum(F.size(F.split("text", " ")))).first()[0] or 0
    pieces = corpus_pipeline.packing(spark, docs, SF)
    if kind == "empty":
        assert pieces.count() == 0
    else:  # the text without an id and the first of its copies with one are left, blank texts carry nothing
        assert {r["doc_id"] for r in docs.collect()} <= {None, 3, 4} and docs.count() > 0
        assert pieces.agg(F.sum("length")).first()[0] >= words
