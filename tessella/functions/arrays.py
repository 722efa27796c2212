"""Small array idioms on top of Spark's higher-order functions.

All of them stay inside one row, so none of them causes a shuffle.
"""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it many times in `body`.

    A column expression that is repeated inside a lambda is evaluated for every
    element; binding it as a lambda variable avoids that.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def edited(
    items: Column, edits: Column, at: Callable[[Column], Column], change: Callable[[Column, Column], Column]
) -> Column:
    """The array with some items replaced, each by an array, in one pass over both.

    `edits` is sorted by the position `at` gives, without repeats; `change` gets the item and
    its edit. What lies between two edits is taken over as a slice.
    """
    nothing = F.slice(items, 1, 0)

    def pieces(e: Column) -> Column:
        def piece(j: Column) -> Column:
            last = F.coalesce(at(F.get(e, j - 1)), F.lit(-1))
            here = F.coalesce(at(F.get(e, j)), F.size(items))
            between = F.slice(items, last + 2, F.greatest(here - last - 1, F.lit(0)))
            new = F.when(j < F.size(e), change(F.get(items, here), F.get(e, j))).otherwise(nothing)
            return F.concat(between, new)

        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(e)), piece))

    return let(edits, pieces)


def without(items: Column, positions: Column) -> Column:
    """The array without the items at these positions (sorted, without repeats)."""
    return edited(items, positions, lambda p: p, lambda item, p: F.slice(items, 1, 0))
