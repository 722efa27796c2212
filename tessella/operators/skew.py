"""Joins that keep their balance when one key holds a large part of the rows.

A key whose row count is above `share` of all rows is split over several salts, in
proportion to its count. There can be at most 1/share such keys, so their list is
small by construction and may be broadcast; and a salted piece is no larger than
`share` of the rows or 200,000 rows, whatever the size of the table. Rows whose key is
NULL match nothing and are spread as well. Results do not depend on the salts.
"""

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 1e-4
# Keys below this many rows fit one task whatever their share is.
HOT_MIN_ROWS = 200_000
# Salts of the rows without a key.
NULL_SALTS = 10_000


def hot_keys(
    counts: DataFrame, keys: list[str], n: str = "n", share: float = HOT_SHARE, min_rows: int = HOT_MIN_ROWS
) -> DataFrame:
    """Hot keys of a table of (keys, n) with the number of salts each one needs.

    At most 1/share rows.
    """
    total = counts.agg(F.sum(n).alias("total")).scalar()
    piece = F.greatest(total * F.lit(share), F.lit(float(min_rows)))
    per_salt = F.least(piece, F.lit(float(max(min_rows, HOT_MIN_ROWS))))
    return counts.filter(F.col(n) > piece).select(*keys, F.ceil(F.col(n) / per_salt).cast("int").alias("_salts"))


def salted_join(
    left: DataFrame, right: DataFrame, keys: list[str], hot: DataFrame, spread: list[str], how: str = "inner"
) -> DataFrame:
    """Equi-join of `left` with `right` where hot keys of `left` go to several tasks.

    `spread` names columns of `left` that tell its rows apart. Only the rows of
    `right` under a hot key are repeated, once per salt.
    """
    hot = F.broadcast(hot)
    no_key = reduce(or_, [F.col(k).isNull() for k in keys])
    salts = F.coalesce("_salts", F.when(no_key, F.lit(NULL_SALTS)), F.lit(1))
    salt = F.pmod(F.xxhash64(*spread), salts.cast("bigint"))
    salted_left = left.join(hot, keys, "left").withColumn("_salt", salt).drop("_salts")
    salts = F.sequence(F.lit(0).cast("bigint"), F.coalesce("_salts", F.lit(1)).cast("bigint") - 1)
    salted_right = right.join(hot, keys, "left").withColumn("_salt", F.explode(salts)).drop("_salts")
    return salted_left.join(salted_right, [*keys, "_salt"], how).drop("_salt")


def count_rows(df: DataFrame, keys: list[str], n: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n))
