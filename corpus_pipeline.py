"""A corpus made ready for training: quality, exact and near duplicates, source weights, token ids."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import bpe, chunks, jaccard, mixing, quality
from tidemark.llm.common import bounded_batches, free_name, small, table, tokenizer_path, written


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labelled rows that are not held out."""
    model = quality.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"), ~quality.held_out(F.col("doc_id")))
    name = free_name(docs, "_score")
    return quality.scored(docs, model, name=name).filter(F.col(name) >= quality.ACCEPTED).drop(name)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text: the one with the largest id, once even if its row repeats."""
    mark = free_name(docs, "_text_hash")
    named = docs.withColumn(mark, F.xxhash64(F.coalesce("text", F.lit(""))))
    decided = written(chunks.exact_duplicates(named, carry=(mark,)).select("doc_id", mark, "kept"), "copies")
    gone = small(decided.filter("not kept").select(F.col("doc_id").alias("_id"), F.col(mark).alias("_other")).distinct())
    match = F.col("l.doc_id").eqNullSafe(F.col("r._id")) & (F.col(f"l.{mark}") == F.col("r._other"))
    left = named.alias("l").join(gone.alias("r"), match, "left_anti")
    twice = decided.filter("kept").groupBy("doc_id", mark).count().filter("count > 1")
    if not twice.isEmpty():
        left = left.dropDuplicates(["doc_id", mark])
    return left.drop(mark)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the smallest id."""
    found = jaccard.near_duplicates(docs)
    gone = written(found.filter("doc_id != component_id").select("doc_id").distinct(), "near-copies")
    return docs.join(small(gone), "doc_id", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources in their target weights: a document comes once for each time that it is taken, cut to what is taken."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, and digests of the ids and of the text that they decode to."""
    coded = bpe.encode(docs, tokenizer_path(), decoded="decoded")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def _bounded(stage):
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("quality", _bounded(keep_good)),
    ("exact_duplicates", _bounded(drop_copies)),
    ("near_duplicates", _bounded(drop_near_copies)),
    ("source_mix", _bounded(mix_sources)),
    ("bpe", _bounded(encode)),
]

#: The classifier and the draws of the mix are not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each reads the table that the one before it wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
