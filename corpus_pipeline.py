"""From raw documents to packed training sequences, as stages that are written and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import exact_dedup, mixing, ngram_join, packing, quality


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    dropped = exact_dedup.exact_dedup(docs).where("not kept").select("doc_id")
    return docs.join(dropped, "doc_id", "left_anti").select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are connected by near-equal texts the one with the smallest id stays."""
    dropped = ngram_join.ngram_join(docs).where("doc_id != component_id").select("doc_id")
    return docs.join(dropped, "doc_id", "left_anti").select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, in training order. Rows that agree in id, source
    and size are taken equally often."""
    same = ["doc_id", "source", "size"]
    plan = mixing.plan_mix(docs).groupBy(*same, "source_size", "target", "slot")
    plan = plan.agg(F.floor(F.avg("epochs") + 0.5).cast("int").alias("epochs"), F.min("middle").alias("middle"))
    place = mixing.training_positions(plan, sort=False).alias("place")
    agree = (
        F.col("doc.doc_id").eqNullSafe(F.col("place.doc_id"))
        & F.col("doc.source").eqNullSafe(F.col("place.source"))
        & (mixing.word_count(F.col("doc.text")) == F.col("place.size"))
    )
    placed = docs.alias("doc").join(place, agree).orderBy("place.position", "place.doc_id", "place.epoch")
    return placed.select("doc.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every chunk of every document with its bin."""
    return packing.best_fit_packing(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack),
]

#: The classifier is learned, which SQL cannot say.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents. Each is written to the shared folder that
    spark.checkpoint.dir names and read again by the next one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    base = f"{folder.rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{number}")
        docs = spark.read.parquet(f"{base}/{number}")
    return docs
