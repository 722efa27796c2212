"""Connected components of links between numbered nodes, as DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_ROUNDS = 60


def cut(df: DataFrame) -> DataFrame:
    """Materialise in spark.checkpoint.dir, which must be a folder that all executors share."""
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def spread_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join of rows with one row for each key. A hash of the key is a second join key, so that
    both sides are shuffled for the join even where one is grouped by the key already: only then
    adaptive execution can split the rows of a large key."""
    again = F.xxhash64(key)
    return left.withColumn("_again", again).join(right.withColumn("_again", again), [key, "_again"]).drop("_again")


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every node of the links (a, b): the smallest reachable node.

    Alternating large-star and small-star rounds: each joins every node's neighbours to the
    smallest node it knows, so the number of links never grows and a long chain halves each time.
    Links are partial minima before each shuffle; a hub is one key of a plain equi-join, which
    adaptive execution splits. Null ends and loops are left out.
    """
    links = cut(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
        .distinct()
    )
    seen = None
    for _ in range(MAX_ROUNDS):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low"))
        large = (
            spread_join(both.where("b > a"), low.select("a", F.least("a", "low").alias("low")), "a")
            .select(F.col("b").alias("a"), F.col("low").alias("b"))
            .distinct()
        )
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (
            spread_join(large, low, "a")
            .select(F.explode(F.array(F.struct("b", "low"), F.struct(F.col("a").alias("b"), "low"))).alias("x"))
            .select(F.col("x.b").alias("a"), F.col("x.low").alias("b"))
            .where("a != b")
            .distinct()
        )
        links = cut(small)
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )
