"""Global row numbers and running sums without a single-task window."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows aimed at in a piece, and pieces at most.
ROWS_PER_PIECE = 500_000
MAX_PIECES = 1000


def with_running_sum(df: DataFrame, key: str, value: str, name: str, rows_per_piece: int = ROWS_PER_PIECE) -> DataFrame:
    """Add the sum of `value` over all rows up to this one in the order of a unique numeric key.

    The key range is cut at approximate quantiles into pieces of about `rows_per_piece`
    rows; each piece is summed up on its own and shifted by the sums of the pieces before
    it. Only the bounds and one sum per piece are gathered.
    """
    pieces = min(MAX_PIECES, df.count() // rows_per_piece + 1)
    shares = [i / pieces for i in range(1, pieces)]
    bounds = df.agg(F.percentile_approx(key, shares, pieces * 10).alias("b")).first()["b"] if shares else None
    edges = F.array(*map(F.lit, sorted(set(bounds or [])))) if bounds else F.array()
    placed = df.withColumn("_piece", _piece(F.col(key), edges))
    sums = placed.groupBy("_piece").agg(F.sum(value).alias("_sum"))
    before = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_piece", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inside = F.sum(value).over(Window.partitionBy("_piece").orderBy(key).rowsBetween(Window.unboundedPreceding, 0))
    return (
        placed.join(F.broadcast(offsets), "_piece")
        .withColumn(name, inside + F.col("_before"))
        .drop("_piece", "_before")
    )


def with_ordinal(df: DataFrame, key: str, name: str = "ordinal", rows_per_piece: int = ROWS_PER_PIECE) -> DataFrame:
    """Number the rows from 0 in the order of a unique numeric key.

    Only the keys are numbered; the rows themselves are joined to their numbers.
    """
    keys = df.select(key).withColumn("_one", F.lit(1).cast("bigint"))
    numbers = with_running_sum(keys, key, "_one", name, rows_per_piece)
    return df.join(numbers.select(key, (F.col(name) - 1).alias(name)), key).select(*df.columns, name)


def _piece(key: Column, edges: Column) -> Column:
    """Number of edges at or below the key."""
    return F.array_size(F.filter(edges, lambda e: e <= key))
