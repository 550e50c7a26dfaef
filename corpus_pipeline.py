"""The corpus pipeline: documents in, packed sequences out.

Each stage takes (spark, docs, sf_dir), where docs is what the one before it kept, and returns a
DataFrame; all but the last return the columns of documents, extra ones included, whatever their
names. An empty table stays empty in every stage. Very long texts are read whole everywhere.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from weftline.llm import decontaminate, exactdedup, langid, packing, simhash
from weftline.llm.scratch import Scratch, clear


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised stay.

    Null texts and texts without a letter go; repeated rows are judged alike; if docs has no labels to
    learn from, all stay.
    """
    return langid.accepted(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays.

    Null counts as empty text and a null doc_id as the smallest; of rows equal in both one stays.
    """
    return exactdedup.without_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest doc_id stays.

    Null and wordless texts link as fingerprint zero; all rows with the doc_id that stays do; rows without
    a doc_id stay only if no document of their group has one.
    """
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word of a benchmark window stay.

    Null and wordless texts have none; an empty benchmark hits nothing; repeated rows are judged alike.
    """
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 ids.

    Null counts as empty text, its end id alone; null doc_ids come first; repeated rows are documents of
    their own, in the order of their texts.
    """
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("packing", pack)]

#: A trained classifier and a tokenizer take part, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each result written and read again; what a stage leaves behind is deleted."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        kept = Scratch(spark, f"pipeline-{name}")
        made = len(Scratch.made)
        docs = kept.keep(stage(spark, docs, sf_dir), name)
        clear(spark, since=made)
        if before:
            before[0].drop(before[1])
        before = kept, name
    return STAGES[-1][1](spark, docs, sf_dir)
