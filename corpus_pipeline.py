"""From documents to packed training sequences: five stages, each written and read again before the next.

1. language: texts whose language can't be told go (no letter in them, or two languages as near and no label that settles it);
2. near_copies: of documents whose word 4-grams nearly agree one stays;
3. passages: a passage that documents share stays in the first one only;
4. mixing: sources are repeated or cut to their target weights;
5. packing: the mix is packed into sequences, one row per piece.

Every stage is judged on what it is given and handles all of it. All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.common import ship, staged, table
from postlens.llm.langid import UNDETERMINED, has_letter, identify_language, train_language_id
from postlens.llm.mixing import mixed_documents
from postlens.llm.ngram_join import first_of_each_component
from postlens.llm.packing import pack_documents
from postlens.llm.passages import without_repeats

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language. A null lang is filled in by the prediction; a given one stays.

    Texts without a letter go, and ambiguous ones unless their given lang is the predicted one.
    Where no row teaches a language, nothing can be told apart: all texts with a letter stay as they are.
    """
    ship(spark)
    model = train_language_id(docs.select("doc_id", "text", "lang"))
    if not model.languages:
        return docs.where(has_letter(F.col("text")))
    settled = ~F.col("__ambiguous") | F.col("lang").eqNullSafe(F.col("__lang"))
    known = identify_language(docs, model).where((F.col("__lang") != UNDETERMINED) & settled)
    filled = known.withColumn("lang", F.coalesce("lang", "__lang"))
    return filled.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return first_of_each_component(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return without_repeats(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mix; a document that the mix repeats is packed as often."""
    ship(spark)
    return pack_documents(docs, TOKENIZER)


STAGES: list[tuple[str, Stage]] = [
    ("language", identified), ("near_copies", near_copies), ("passages", passages), ("mixing", mixing), ("packing", packing)]

#: Learned languages, min-hashes and token ids are nothing that SQL can state.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
