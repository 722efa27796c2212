"""Mixing sources to target weights as a time-varying curriculum.

Every source has a weight schedule over training time 0..1. Its integral gives the source's share
of the tokens; the share is capped at `max_epochs` times what the source holds, and the excess goes
to the others by weight. Inverting the source's cumulative demand turns the running token count of
its documents into training positions, by which the documents are range-sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
#: Rows that share a leading digit group of the order key: one window partition.
ROWS_PER_PIECE = 20_000
WORD = r"[^\x20\x09-\x0D]+"

#: Knots (time, factor) of the default schedules, dealt like the weights. Each factor integrates
#: to 1 over 0..1, so a schedule moves its source in time and leaves its share alone.
RISING, FALLING, FLAT = ((0.0, 0.5), (1.0, 1.5)), ((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0))
SCHEDULES = (FALLING, RISING, FLAT)


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _integral(knots: Sequence[tuple[float, float]]) -> list[float]:
    total = [0.0]
    for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False):
        total.append(total[-1] + (t1 - t0) * (w0 + w1) / 2)
    return total


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, schedules=SCHEDULES, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """(source, source_size, target, slot) from (source, source_size); one row per source.

    Sources by code point with null last are dealt weights and schedules in turn; the weight of a
    source is its weight times the integral of its schedule. Targets are water-filled: in the order
    of cap / weight, the sources up to the level are capped, the others share the rest by weight.
    The windows without a key run over this one row per source.
    """
    shares = [w * _integral(k)[-1] for w, k in zip(weights, schedules, strict=True)]
    ranked = sizes.withColumn(
        "slot",
        (F.row_number().over(Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))) - 1)
        % len(shares),
    )
    ranked = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, shares)), F.col("slot") + 1))
    ranked = ranked.withColumn("cap", F.col("source_size") * max_epochs)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    level = F.col("rest") / F.col("weights")
    ranked = ranked.withColumns(
        {
            "rest": F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("cap").over(before), F.lit(0)),
            "weights": F.sum("weight").over(after),
        }
    ).withColumns({"open": F.col("cap") > level * F.col("weight"), "place": F.row_number().over(order)})
    # The level of the first source that is not capped holds for all that follow.
    first = F.min(F.when(F.col("open"), F.struct("place", "rest", "weights"))).over(Window.partitionBy())
    target = F.when(
        F.col("place") >= first["place"], first["rest"].cast("double") * F.col("weight") / first["weights"]
    ).otherwise(F.col("cap").cast("double"))
    return ranked.select("source", "source_size", target.alias("target"), "slot")


def _position(share, slot, schedules):
    """The time at which a source's cumulative demand reaches this share of its target: within the
    segment of the schedule that holds it, the root of the quadratic that the linear weight gives."""
    cases = None
    for number, knots in enumerate(schedules):
        sums = _integral(knots)
        inverse = F.lit(1.0)
        for (t0, w0), (t1, w1), low, high in reversed(list(zip(knots, knots[1:], sums, sums[1:], strict=False))):
            need = share * sums[-1] - low
            slope = (w1 - w0) / (t1 - t0)
            root = need * 2 / (w0 + F.sqrt(F.greatest(F.lit(w0 * w0) + need * (2 * slope), F.lit(0.0))))
            inverse = F.when(share * sums[-1] <= high, F.least(F.lit(t1), t0 + root)).otherwise(inverse)
        cases = F.when(slot == number, inverse) if cases is None else cases.when(slot == number, inverse)
    return cases


def plan_mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    schedules=SCHEDULES,
    max_epochs: int = MAX_EPOCHS,
    seed: str = "mix",
    rows_per_piece: int = ROWS_PER_PIECE,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, epochs, first_position), one row per row of docs.

    The documents of a source are ordered by a hash of their id. A source with a target of q whole
    passes and a rest takes every document q times, and once more those whose middle word lies
    within the rest, so its words miss the target by half a document at most. The running count is
    taken within pieces of the hash order, whose number follows the row count, and the pieces'
    totals are added up apart: no window holds a whole source. Null texts have size 0. Rows with
    equal ids are told apart by their size; rows that agree in both have one place in the order and
    the same decision. Null ids are ordered by their size.
    """
    count = docs.count()
    digits = 1
    while 16**digits * rows_per_piece < count:
        digits += 1
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")
    )
    rows = rows.withColumn("rank", F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string")))).withColumn(
        "piece", F.substring("rank", 1, digits)
    )
    totals = rows.groupBy("source", "piece").agg(F.sum("size").alias("piece_size"))
    targets = source_targets(
        totals.groupBy("source").agg(F.sum("piece_size").alias("source_size")), weights, schedules, max_epochs
    )
    ahead = Window.partitionBy("source").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("offset", F.coalesce(F.sum("piece_size").over(ahead), F.lit(0)))
    offsets = offsets.join(
        targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))
    ).select(
        F.col("source").alias("of"), F.col("piece").alias("at"), "offset", "source_size", "target", "slot"
    )
    within = Window.partitionBy("source", "piece").orderBy("rank", "size")
    start = F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, -1))
    placed = (
        rows.withColumn("start", F.coalesce(start, F.lit(0)))
        .join(offsets, F.col("source").eqNullSafe(F.col("of")) & (F.col("piece") == F.col("at")))
        .withColumn("middle", F.col("offset") + F.col("start") + F.col("size") / 2)
    )
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.col("target") - whole * F.col("source_size")
    epochs = whole + F.when((F.col("size") > 0) & (F.col("middle") <= rest), 1).otherwise(0)
    share = F.least(F.col("middle") / F.greatest(F.col("target"), F.lit(1.0)), F.lit(1.0))
    return placed.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        F.least(epochs, F.lit(max_epochs)).cast("int").alias("epochs"),
        "middle",
        "slot",
        _position(share, F.col("slot"), schedules).alias("first_position"),
    )


def training_positions(plan: DataFrame, schedules=SCHEDULES, sort: bool = True) -> DataFrame:
    """(doc_id, source, size, epoch, position): every repeat at the time at which its source's demand
    reaches it, in training order (a range partitioning by position)."""
    repeats = plan.where("epochs > 0").withColumn("epoch", F.explode(F.sequence(F.lit(1), F.col("epochs"))))
    done = F.col("middle") + (F.col("epoch") - 1) * F.col("source_size")
    share = F.least(done / F.greatest(F.col("target"), F.lit(1.0)), F.lit(1.0))
    placed = repeats.select(
        "doc_id", "source", "size", "epoch", _position(share, F.col("slot"), schedules).alias("position")
    )
    return placed.orderBy("position", "doc_id", "epoch") if sort else placed
