"""Image archives, tables and shards."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.operators.images import distinct_image_urls
from tessella.operators.ordinals import with_ordinal


def images_from_members(members: DataFrame) -> DataFrame:
    """(url, image) from archive members `stem.jpg` and `stem.json` (archive, name, content).

    Only members whose description says success count. For an address that occurs
    several times, the last stem of the last archive wins; the winner is found on keys
    alone, and its bytes are joined afterwards.
    """
    stem = F.regexp_extract("name", "^(.*)\\.(?:jpg|json)$", 1)
    named = members.withColumn("stem", stem)
    text = F.col("content").cast("string")
    described = (
        named.filter(F.col("name").endswith(".json"))
        .select(
            "archive",
            "stem",
            F.get_json_object(text, "$.status").alias("status"),
            F.get_json_object(text, "$.url").alias("url"),
        )
        .filter((F.col("status") == "success") & F.col("url").isNotNull())
    )
    winners = described.groupBy("url").agg(F.max(F.struct("archive", "stem")).alias("last"))
    winners = winners.select("url", "last.archive", "last.stem")
    pictures = named.filter(F.col("name").endswith(".jpg")).select("archive", "stem", F.col("content").alias("image"))
    return winners.join(pictures, ["archive", "stem"]).select("url", "image")


def concat(tables: list[DataFrame], expected: int | None = None) -> DataFrame:
    """Union by name; with `expected`, the number of tables must match it."""
    if expected is not None and len(tables) != expected:
        raise ValueError(f"{len(tables)} batches instead of {expected}")
    return reduce(DataFrame.unionByName, tables)


def save(df: DataFrame, path: str, *partitions: str) -> None:
    df.write.mode("overwrite").partitionBy(*partitions).parquet(path)


def save_bucketed(df: DataFrame, table: str, buckets: int, key: str = "doc_id") -> None:
    """Keep documents bucketed by id: joining drop lists by id then moves only the lists."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def load(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def with_shards(df: DataFrame, shard_size: int, key: str = "doc_id", n_valid: int = 2) -> DataFrame:
    """Add `shard` and `split`: contiguous shards in key order, the first ones for validation.

    ceil(n / shard_size) shards; when they do not come out even, the first ones have
    one row more.
    """
    n = df.count()
    shards = max(-(-n // shard_size), 1)
    small, large = divmod(n, shards)
    ordinal = F.col("ordinal")
    border = large * (small + 1)
    shard = F.when(ordinal < border, F.floor(ordinal / (small + 1))).otherwise(
        large + F.floor((ordinal - border) / max(small, 1))
    )
    return (
        with_ordinal(df, key)
        .withColumn("shard", shard.cast("int"))
        .drop("ordinal")
        .withColumn("split", F.when(F.col("shard") < n_valid, "valid").otherwise("train"))
    )


def write_shards(df: DataFrame, path: str, shard_size: int, key: str = "doc_id") -> None:
    sharded = with_shards(df, shard_size, key)
    sharded.repartition("split", "shard").write.mode("overwrite").partitionBy("split", "shard").parquet(path)


def write_url_list(docs: DataFrame, path: str) -> None:
    """One distinct image address per line."""
    distinct_image_urls(docs).select(F.col("url").alias("value")).write.mode("overwrite").text(path)


def load_word_list(spark: SparkSession, path: str, max_words: int = 100_000) -> list[str]:
    """Words of a list file, one per line. The list becomes a literal, so its size is checked."""
    rows = spark.read.text(path).filter(F.trim("value") != "").distinct().limit(max_words + 1).collect()
    if len(rows) > max_words:
        raise ValueError(f"more than {max_words} words in {path}")
    return sorted(r["value"].strip() for r in rows)
