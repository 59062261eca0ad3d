"""Training-corpus pipeline: documents in, cleaned, mixed and sharded rows out.

Every stage is ``(spark, docs, sf_dir) -> DataFrame`` and works on all rows
its predecessor kept; ``run`` writes each stage as Parquet in the cluster's
shared folder and reads it back, so a lost executor never costs more than the
running stage. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlens.llm import common, decontamination, mixing, ngram_join, quality_rules, sharding

N_SHARDS = 40
SHINGLE, SIMILARITY = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage: documents the quality rules keep, without the lines they
    remove; ``n_chars`` follows the text."""
    kept = quality_rules.quality_rules(docs, clean_text=True).where("kept")
    kept = kept.withColumn("text", F.col("text_cleaned"))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage: one row of each component, the one with the smallest doc_id,
    then text hash; rows without a doc_id come last. Rows are named by doc_id
    and text, so texts that share a doc_id are joined each for itself; rows
    without a text or a word stay, one of each doc_id and text."""
    named = docs.withColumn("_row_key", F.xxhash64(F.lit("row"), F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text"))
    parts = ngram_join.join_components(named.select(F.col("_row_key").alias("doc_id"), "text"), SHINGLE, SIMILARITY)
    parts = parts.select(F.col("doc_id").alias("_row_key"), "component_id").distinct()
    first = (named.select("_row_key", "doc_id").join(parts, "_row_key").groupBy("component_id")
             .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row_key"))["_row_key"].alias("_row_key")).select("_row_key"))
    return named.join(first, "_row_key", "left_semi").dropDuplicates(["_row_key"]).select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage: documents that hold no benchmark item."""
    return decontamination.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage: each document as often as the mix takes it (0, 1 or 2 rows)."""
    mixed = mixing.mix(docs)
    return (mixed.where("_copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
            .select(*docs.columns))


def sharding_by_kd_tree(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage: the documents with the shard each belongs to."""
    return sharding.assign_shards(docs, sharding.fit_kd_tree(docs, n_shards=N_SHARDS))


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("mixing sources to target weights", mixing_to_weights),
    ("sharding", sharding_by_kd_tree),
]

#: Latent retrieval, Pareto ranks and k-d splits have no SQL form; the stages
#: are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = common.materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
