import random
from collections import defaultdict

import pytest

from tessella.llm import packing


@pytest.mark.parametrize("capacities", [(512, 1024, 2048, 4096), (7, 16), (5,)])
def test_bins_hold_their_items(capacities):
    rng = random.Random(1)
    lengths = [rng.randrange(1, max(capacities) + 1) for _ in range(700)]
    bins, offsets, sizes = packing.pack_lengths(lengths, capacities)
    used = defaultdict(list)
    for x, b, o in zip(lengths, bins, offsets, strict=True):
        used[b].append((o, x))
    assert sorted(used) == list(range(len(sizes)))
    for b, items in used.items():
        at = 0
        for o, x in sorted(items):
            assert o == at
            at += x
        assert sizes[b] == min(c for c in capacities if c >= at)
    # No worse than twice the least number of tokens, and better than a bin for each item.
    alone = sum(min(c for c in capacities if c >= x) for x in lengths)
    assert sum(lengths) <= sum(sizes) <= alone


def test_small_cases_are_near_the_best():
    """Against the cheapest of all partitions of a few items."""
    rng = random.Random(2)
    capacities = (4, 8, 16)

    def cheapest(items):
        if not items:
            return 0
        best = None
        for mask in range(1 << (len(items) - 1)):
            own = [items[0]] + [x for i, x in enumerate(items[1:]) if mask >> i & 1]
            if sum(own) <= 16:
                rest = [x for i, x in enumerate(items[1:]) if not mask >> i & 1]
                cost = min(c for c in capacities if c >= sum(own)) + 1 + cheapest(rest)
                best = cost if best is None else min(best, cost)
        return best

    for _ in range(30):
        items = [rng.randrange(1, 17) for _ in range(7)]
        _, _, sizes = packing.pack_lengths(items, capacities, 1)
        assert sum(sizes) + len(sizes) <= 1.3 * cheapest(items)


def test_documents_are_covered_once(spark):
    rows = [(i, "w " * (i * 37 % 900)) for i in range(400)] + [(1000, "w " * 50_000), (1001, None), (1002, ""), (1003, "a b"), (1003, "a b"), (None, "a b c")]
    rows += [(2000, "hot one")] * 300
    df = spark.createDataFrame([(a, b, 1) for a, b in rows], "doc_id long, text string, piece int")
    found = packing.best_fit_packing(df, rows_per_piece=60).collect()
    parts, bins = defaultdict(list), defaultdict(list)
    for r in found:
        parts[r["doc_id"], r["copy"]].append(r)
        if r["bin"] is not None:
            bins[r["piece"], r["bin"]].append(r)
    sizes = sorted(((i, len((t or "").split())) for i, t in rows), key=str)
    total = defaultdict(int)
    for (i, _), v in parts.items():
        total[i] += sum(r["n_tokens"] for r in v)
        at = 0
        for r in sorted(v, key=lambda r: r["chunk"]):
            assert r["start_token"] == at
            at += r["n_tokens"]
    expected = defaultdict(int)
    for i, n in sizes:
        expected[i] += n
    assert total == expected
    for items in bins.values():
        at = 0
        for r in sorted(items, key=lambda r: r["bin_offset"]):
            assert r["bin_offset"] == at
            at += r["n_tokens"]
        assert items[0]["capacity"] == min(c for c in packing.CAPACITIES if c >= at)
    assert packing.best_fit_packing(df.limit(0)).count() == 0


@pytest.mark.parametrize("length", [20, 100])
def test_short_items_fill_the_size_of_least_cost(length):
    """Bins of 4096 cost least a token, however many short items it takes to fill one."""
    lengths = [length] * (10 * (4096 // length))
    _, _, sizes = packing.pack_lengths(lengths)
    assert sizes == [4096] * 10
