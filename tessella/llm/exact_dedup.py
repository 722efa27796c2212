"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX_BYTES = 512
#: Slots of the filter that tells which rows go on: a fixed 1 MB, whatever the number of rows.
FILTER_SLOTS = 1 << 23


def _slots(keys: DataFrame, columns: list[str]) -> DataFrame:
    """The keys as bitmaps of 32768 slots each, at most FILTER_SLOTS / 32768 rows of 4 KB."""
    slot = F.pmod(F.xxhash64(*columns), F.lit(FILTER_SLOTS))
    return (
        keys.select(slot.alias("slot"))
        .groupBy(F.bitmap_bucket_number("slot").alias("_bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("_bits"))
    )


def _meets(rows: DataFrame, bitmaps: DataFrame, columns: list[str], name: str) -> DataFrame:
    """Adds a flag: whether the row's key may be one of the keys (false only if it is not)."""
    slot = F.pmod(F.xxhash64(*columns), F.lit(FILTER_SLOTS))
    at = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(_at div 8 as int) + 1, 1)")), 16, 10).cast("int")
    bit = F.expr("cast(pow(2, _at % 8) as int)")
    return (
        rows.withColumns({"_bucket": F.bitmap_bucket_number(slot), "_at": at})
        .join(F.broadcast(bitmaps), "_bucket", "left")
        .withColumn(name, F.coalesce(byte.bitwiseAND(bit) != 0, F.lit(False)))
        .drop("_bucket", "_at", "_bits")
    )


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_bytes: int = PREFIX_BYTES
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per row of `docs`.

    Texts are equal when identical; null counts as empty. Of equal texts the row with the largest
    id stays. Rows are counted by length; those whose length occurs again are counted by length and
    hash of the first `prefix_bytes` bytes; only rows that still have company are grouped by the
    hash of the whole text. Between the steps the surviving keys are a bitmap of fixed size, so no
    step moves a text; a key that shares its slot with another one only costs a needless hash.

    A repeated row counts in group_size; rows that repeat the kept id are all kept. A null id never
    wins against another id, and is kept if its group has no other. Other columns are not read.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).withColumn("n_bytes", F.octet_length("text").cast("long"))

    lengths = rows.groupBy("n_bytes").agg(F.count("*").alias("n")).where("n > 1")
    rows = _meets(rows, _slots(lengths, ["n_bytes"]), ["n_bytes"], "same_length")
    head: Column = F.xxhash64(F.substring(F.col("text").cast("binary"), 1, prefix_bytes))
    rows = rows.withColumn("head", F.when(F.col("same_length"), head))

    heads = rows.where("same_length").groupBy("n_bytes", "head").agg(F.count("*").alias("n")).where("n > 1")
    rows = _meets(rows, _slots(heads, ["n_bytes", "head"]), ["n_bytes", "head"], "same_head")
    rows = rows.withColumn("same_head", F.col("same_head") & F.col("same_length"))

    full = F.sha2(F.col("text").cast("binary"), 256)
    hashed = rows.select("doc_id", "n_bytes", "same_head", full.alias("text_sha256"))
    groups = (
        hashed.where("same_head")
        .groupBy("text_sha256")
        .agg(F.count("*").alias("group_size"), F.max("doc_id").alias("keep_id"))
        .where("group_size > 1")
        .select(F.concat(F.lit("sha:"), "text_sha256").alias("key"), "group_size", "keep_id")
    )
    # A row without company gets a key of its own. The key differs from the grouping key, so the groups
    # are dealt anew and adaptive execution can split the rows of a large group.
    own = F.concat(F.lit("id:"), F.coalesce(F.col("doc_id").cast("string"), F.col("text_sha256")))
    return (
        hashed.withColumn("key", F.when(F.col("same_head"), F.concat(F.lit("sha:"), "text_sha256")).otherwise(own))
        .join(groups, "key", "left")
        .select(
            "doc_id",
            F.coalesce("keep_id", "doc_id").alias("keep_id"),
            F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
            F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
            "text_sha256",
        )
    )
