"""Text similarity: integer percentage from the longest common subsequence.

Spark's own edit distance counts a substitution as one edit and gives other values,
so the last step is a small function on Arrow batches.
"""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType


# Characters between two looks at the bound of a comparison.
_STRIDE = 32


def _shared_start(a: str, b: str) -> int:
    """Length of the common start, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _is_subsequence(a: str, b: str) -> bool:
    """Whether the characters of `a` stand in `b` in their order."""
    at = 0
    for ch in a:
        at = b.find(ch, at) + 1
        if not at:
            return False
    return True


def common_subsequence(a: str, b: str, least: int = 0) -> int:
    """Length of the longest common subsequence; if that is below `least`, some value below it.

    Equal ends are taken off; a text that stands in the other one is found in one pass; the rest
    takes one machine word of `a` per step, and ends when `least` is out of reach.
    """
    if len(a) > len(b):
        a, b = b, a
    start = _shared_start(a, b)
    a, b = a[start:], b[start:]
    end = _shared_start(a[::-1], b[::-1])
    a, b, same = a[: len(a) - end], b[: len(b) - end], start + end
    if same + len(a) < least:
        return same + len(a)
    if _is_subsequence(a, b):
        return same + len(a)
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    state = full
    for first in range(0, len(b), _STRIDE):
        for ch in b[first : first + _STRIDE]:
            hits = state & where.get(ch, 0)
            state = ((state + hits) | (state - hits)) & full
        if least:
            possible = same + len(a) - state.bit_count() + max(len(b) - first - _STRIDE, 0)
            if possible < least:
                return possible
    return same + len(a) - state.bit_count()


def percent(common: int, total: int) -> int:
    """round(100 * 2 * common / total), half to even, as in Python."""
    return round(100 * (2.0 * common / total))


def similarity_percent(a: str | None, b: str | None) -> int | None:
    if a is None or b is None:
        return None
    if a == b:
        return 100
    if not a or not b:
        return 0
    return percent(common_subsequence(a, b), len(a) + len(b))


@F.pandas_udf(IntegerType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([similarity_percent(x, y) for x, y in zip(a, b)], dtype="Int32")


_BUCKETS = 64


def _histogram(text: str) -> np.ndarray:
    """Character counts in 64 buckets; buckets only merge characters, so bounds stay valid."""
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    return np.bincount(points % _BUCKETS, minlength=_BUCKETS).astype(np.int32)


def later_similar(
    texts: list[str], positions: list[int], threshold: int, groups: list[int] | None = None
) -> list[int]:
    """Positions of the texts whose similarity to a text at a smaller position reaches the threshold.

    The texts must be distinct. With two values in `groups`, only pairs across them
    are compared. The shared characters bound the common subsequence from above, which
    settles most pairs without comparing the texts.
    """
    if len(texts) < 2:
        return []
    order = np.argsort(np.asarray(positions), kind="stable")
    lengths = np.array([len(texts[i]) for i in order], dtype=np.int64)
    counts = np.stack([_histogram(texts[i]) for i in order])
    side = np.zeros(len(texts), dtype=np.int64) if groups is None else np.asarray(groups)[order]
    across = len(set(side.tolist())) > 1
    # A percentage reaches the threshold from half a point below it on.
    least = (threshold - 0.5) / 100.0 - 1e-9
    found = []
    for j in range(1, len(order)):
        total = lengths[:j] + lengths[j]
        maybe = 2 * np.minimum(lengths[:j], lengths[j]) >= least * total
        if across:
            maybe &= side[:j] != side[j]
        candidates = np.flatnonzero(maybe)
        if candidates.size:
            shared = np.minimum(counts[candidates], counts[j]).sum(axis=1)
            candidates = candidates[2 * shared >= least * total[candidates]]
        for i in candidates:
            whole = int(total[i])
            # The smallest common length that may round to the threshold.
            common = common_subsequence(texts[order[i]], texts[order[j]], math.ceil(least * whole / 2))
            if whole == 0 or percent(common, whole) >= threshold:
                found.append(int(positions[order[j]]))
                break
    return found
