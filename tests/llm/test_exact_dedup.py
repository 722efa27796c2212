import hashlib
from collections import defaultdict

import pytest

from tessella.llm import exact_dedup as ex


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        keep = max(ids) if ids else None
        out.append((i, keep, len(groups[t or ""]), (i == keep) if i is not None else keep is None, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = (
    [(i, f"text {i % 40}" + "x" * (i % 3)) for i in range(300)]
    + [(1000 + i, "p" * 600 + str(i % 7)) for i in range(30)]
    + [(2000 + i, "hot") for i in range(500)]
    + [(3000, None), (3001, ""), (3002, None), (3003, "é" * 400_000), (3004, "é" * 400_000), (3005, "unique")]
    + [(3006, "twice"), (3006, "twice"), (None, "twice"), (None, "no id"), (None, "no id"), (3007, "A"), (3008, "a")]
)


@pytest.mark.parametrize("slots", [1 << 23, 32768])
def test_agrees_with_brute_force(spark, slots, monkeypatch):
    monkeypatch.setattr(ex, "FILTER_SLOTS", slots)
    df = spark.createDataFrame([(a, b, 1, "k") for a, b in ROWS], "doc_id long, text string, n_bytes int, key string")
    assert sorted((tuple(r) for r in ex.exact_dedup(df).collect()), key=str) == brute(ROWS)


def test_empty_table_and_other_names(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a")], "id int, body string")
    assert ex.exact_dedup(df.limit(0), "id", "body").count() == 0
    assert sorted(r["kept"] for r in ex.exact_dedup(df, "id", "body").collect()) == [False, True]


def test_only_survivors_are_grouped_by_full_hash(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    plan = ex.exact_dedup(df)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "Python" not in plan
