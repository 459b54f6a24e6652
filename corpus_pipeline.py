"""Corpus preparation in five stages, each on all that its predecessor kept.

quality: documents that the quality classifier rejects go.
near_duplicates: of each group of near copies (five words, similarity 0.8 or more) the smallest doc_id stays.
passages: passages that repeat from a document with a smaller doc_id are cut out of the later texts.
leaks: documents that hold a benchmark item, within its edit budget, go.
packing: the remaining documents as token pieces in sequences of 2048.

Null doc_ids are kept by every stage but the last gives them null ids; null texts count as empty. An empty table passes
through all stages. Columns beyond those of ``documents`` are carried to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestrata.llm.common import materialize
from lodestrata.llm.decontamination import keep_uncontaminated
from lodestrata.llm.ngram_join import jaccard_groups
from lodestrata.llm.packing import pack_sequences
from lodestrata.llm.quality_classifier import keep_quality
from lodestrata.llm.substring_dedup import repeated_passages, without_passages


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = jaccard_groups(docs)
    gone = materialize(groups.where("not kept").select("doc_id"))
    return docs.join(gone.hint("merge"), "doc_id", "left_anti").select(*docs.columns)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_passages(docs, materialize(repeated_passages(docs, every_source=False)))


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_sequences(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("passages", passages), ("leaks", leaks), ("packing", packing)]
ORACLE_SQL = None  # model scores and packing have no SQL; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs)
    return docs
