"""Corpus pipeline: from raw documents to a mixed training corpus.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``. All stages but the
last return the columns of ``documents``; the last adds ``mix_slot`` and
``mix_position``, by which the corpus is read in mixed order.

1. quality: documents that the co-trained classifier rejects go.
2. near-dedup: of each SimHash component (4-word shingles, 4 bits) the document
   with the smallest id stays.
3. passage dedup: bytes of 200-byte strings that occur more than once in what
   is left are cut out of the texts; every document stays, even if empty.
4. decontamination: documents with a verified benchmark item go.
5. mixing: every document gets its place by target weights of the sources.

Defined cases are those of the operators; an empty table passes all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starledger.llm import decontam, mixing, quality, simhash, suffix_dedup
from starledger.llm.common import drop_folder, new_folder, read_table, ship_package


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return quality.good_only(docs, read_table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return simhash.one_each(docs, shingle_words=4, max_bits=4)


def passage_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return suffix_dedup.cut(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return decontam.clean(docs, read_table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("quality_classifier", quality_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("suffix_array_dedup", passage_dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("source_mixing", mixing_stage),
]

#: A trained classifier, XXH64 and exact byte cuts have no SQL form; the stages
#: are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; intermediate tables go to the shared
    folder, each deleted once the next is written."""
    docs, last = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if last is not None:
            drop_folder(spark, last)
        docs, last = spark.read.parquet(path), path
    return docs
