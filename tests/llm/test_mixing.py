import math
import re

import pytest

from tessella.llm import mixing


def water_fill(sizes, weights, cap):
    """Targets by rounds: share the rest by weight, stop at the cap, share the excess again."""
    total, target, open_ = sum(sizes.values()), dict.fromkeys(sizes, 0.0), set(sizes)
    while open_:
        rest = total - sum(t for s, t in target.items() if s not in open_)
        level = rest / sum(weights[s] for s in open_)
        over = {s for s in open_ if level * weights[s] > cap * sizes[s]}
        if not over:
            return target | {s: level * weights[s] for s in open_}
        target |= {s: float(cap * sizes[s]) for s in over}
        open_ -= over
    return target


ROWS = (
    [(i, "w " * (1 + i * 7 % 50), f"src{i % 11}") for i in range(400)]
    + [(1000 + i, "a b c", "big") for i in range(300)]
    + [(2000, "x " * 20_000, "long"), (2001, None, "none"), (2002, "", "none"), (2003, "q w", None), (2004, "q w", None), (2004, "q w", None)]
    + [(None, "n n n", "src1"), (2005, "é\x0bé\x1cé é", "Ä"), (2006, "one two", "a")]
)


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([(a, b, c, 0) for a, b, c in ROWS], "doc_id long, text string, source string, size int")


@pytest.mark.parametrize("pieces", [20_000, 5])
def test_targets_and_taken(docs, pieces):
    rows = mixing.plan_mix(docs, rows_per_piece=pieces).collect()
    assert len(rows) == len(ROWS)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, largest = {}, {}
    for _, t, s in ROWS:
        sizes[s] = sizes.get(s, 0) + size(t)
        largest[s] = max(largest.get(s, 0), size(t))
    ranked = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    targets = water_fill(sizes, {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(ranked)}, 3)
    taken = dict.fromkeys(sizes, 0)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and math.isclose(r["target"], targets[r["source"]], rel_tol=1e-9, abs_tol=1e-9)
        assert 0 <= r["epochs"] <= 3 and (r["size"] or not r["epochs"]) and 0 <= r["first_position"] <= 1
        taken[r["source"]] += r["size"] * r["epochs"]
    assert math.isclose(sum(targets.values()), sum(sizes.values()), rel_tol=1e-9)
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= largest[s] / 2 + 1e-6
    again = mixing.plan_mix(docs.repartition(7), rows_per_piece=pieces).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_positions_follow_the_schedules(docs):
    plan = mixing.plan_mix(docs)
    rows = mixing.training_positions(plan).collect()
    assert [r["position"] for r in rows] == sorted(r["position"] for r in rows)
    assert sum(r["size"] for r in rows) == sum(r["size"] * r["epochs"] for r in plan.collect())
    # Half of the tokens of a falling schedule come before the middle of the training, more than half of it by weight.
    slots = {r["doc_id"]: r["slot"] for r in plan.collect()}
    for slot, share in ((0, 0.625), (1, 0.375), (2, 0.5)):
        own = [r for r in rows if slots[r["doc_id"]] == slot]
        early = sum(r["size"] for r in own if r["position"] <= 0.5)
        assert abs(early / sum(r["size"] for r in own) - share) < 0.05


def test_empty(spark, docs):
    assert mixing.plan_mix(docs.limit(0)).count() == 0
    assert mixing.plan_mix(docs.where("text IS NULL")).collect()[0]["epochs"] == 0
