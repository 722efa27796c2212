"""Crawl pointers: selection, slices, resumption and success figures."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella import schema
from tessella.operators.ordinals import with_ordinal


def select_pointers(
    index: DataFrame, crawl: str, language: str, columns: list[str], status: int = 200, subset: str = "warc"
) -> DataFrame:
    """Distinct pointers of one crawl whose languages include the given one.

    The filters are plain comparisons on columns, so they reach a Parquet index scan.
    """
    return (
        index.filter(
            (F.col("crawl") == crawl)
            & (F.col("subset") == subset)
            & F.col("content_languages").contains(language)
            & (F.col("fetch_status") == status)
        )
        .select(*columns)
        .distinct()
    )


def read_pointers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema.POINTERS)


def pointer_batches(
    pointers: DataFrame, key: str, batch_size: int, skip_rows: int = 0, n_rows: int | None = None, start_batch: int = 0
) -> DataFrame:
    """Rows of a slice in key order with their batch number, from a given batch on."""
    ordered = with_ordinal(pointers, key).filter(F.col("ordinal") >= skip_rows)
    if n_rows is not None:
        ordered = ordered.filter(F.col("ordinal") < skip_rows + n_rows)
    batch = F.floor((F.col("ordinal") - skip_rows) / batch_size).cast("bigint")
    return ordered.withColumn("batch", batch).drop("ordinal").filter(F.col("batch") >= start_batch)


def is_done(payload: Column, error: Column) -> Column:
    """There is a payload and no error."""
    return payload.isNotNull() & (F.length(payload) > 0) & (F.coalesce(error, F.lit("")) == "")


def remaining(todo: DataFrame, done: DataFrame, keys: list[str], payload: str, error: str) -> DataFrame:
    """Rows to process again: those not finished in an earlier run."""
    finished = done.filter(is_done(F.col(payload), F.col(error))).select(*keys)
    return todo.join(finished, keys, "left_anti")


def resume(todo: DataFrame, done: DataFrame, keys: list[str], payload: str, error: str, process) -> DataFrame:
    """Finished rows of an earlier run together with newly processed ones."""
    finished = done.filter(is_done(F.col(payload), F.col(error)))
    return finished.unionByName(process(remaining(todo, done, keys, payload, error)))


def success_rate(df: DataFrame, error: str, *groups: str) -> DataFrame:
    """Rows, rows without an error and their share, in all or per group."""
    ok = F.count(F.when(F.coalesce(F.col(error), F.lit("")) == "", 1))
    figures = [
        F.count(F.lit(1)).alias("n"),
        ok.alias("n_ok"),
        F.round(ok / F.nullif(F.count(F.lit(1)), F.lit(0)), 6).alias("success_rate"),
    ]
    return df.groupBy(*groups).agg(*figures)


def human_bytes(size: Column) -> Column:
    """Bytes as text: plain below 1 KB, then KB to TB by 1024 with two decimals."""
    value = size.cast("double")
    plain = F.concat(F.format_string("%.1f", value), F.when(value == 1, F.lit(" Bytes")).otherwise(F.lit(" Byte")))
    decision = F.when(value < 1024, plain)
    for power, unit in ((1, "KB"), (2, "MB"), (3, "GB")):
        decision = decision.when(
            value < 1024.0 ** (power + 1), F.format_string(f"%.2f {unit}", value / F.lit(1024.0**power))
        )
    return decision.otherwise(F.format_string("%.2f TB", value / F.lit(1024.0**4)))


def volume(df: DataFrame, length: str = "warc_record_length", *groups: str) -> DataFrame:
    """Sum of record lengths, in bytes and as text."""
    return (
        df.groupBy(*groups)
        .agg(F.sum(length).alias("n_bytes"))
        .withColumn("volume", human_bytes(F.col("n_bytes")))
    )
