import random

import numpy as np
import pytest

from tessella.llm import embedding_dedup as ed


def brute(rows):
    """{vec_id: (n_links, component)} by all pairs."""
    good = {}
    for i, v in rows:
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64))
    ids = sorted(good)
    x = np.array([good[i] for i in ids])
    linked = (x @ x.T) >= ed.THRESHOLD
    np.fill_diagonal(linked, False)
    root = {i: i for i, _ in rows}
    changed = True
    while changed:
        changed = False
        for a, b in zip(*np.nonzero(linked), strict=True):
            low = min(root[ids[a]], root[ids[b]])
            for c in (ids[a], ids[b]):
                changed |= root[c] != low
                root[c] = low
    n = dict(zip(ids, linked.sum(1).tolist(), strict=True))
    return {i: (n.get(i, 0), root[i], i == root[i]) for i, _ in rows}


def vectors(seed, n=300, dim=16):
    rng = np.random.default_rng(seed)
    centers = rng.standard_normal((25, dim))
    rows = []
    for i in range(n):
        c = centers[rng.integers(25)]
        rows.append((int(i * 7 % 1009), (c + rng.standard_normal(dim) * rng.choice([0.05, 0.25, 1.0])).tolist()))
    rows += [(2000 + i, rows[5][1]) for i in range(40)]
    rows += [(3000, [2 * x for x in rows[5][1]]), (3001, None), (3002, [0.0] * dim), (3003, [float("nan")] * dim)]
    rows += [(3004, [None] + [1.0] * (dim - 1)), (3005, [float("inf")] + [1.0] * (dim - 1)), (3006, [])]
    random.Random(seed).shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,cell_rows,chunk", [(1, 256, 4096), (2, 8, 5)])
def test_agrees_with_brute_force(spark, seed, cell_rows, chunk, monkeypatch):
    monkeypatch.setattr(ed, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(ed, "CHUNK", chunk)
    rows = vectors(seed)
    df = spark.createDataFrame([(a, b, 1) for a, b in rows], "vec_id long, embedding array<double>, label int")
    found = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in ed.near_duplicates(df).collect()}
    expected = brute(rows)
    assert found.keys() == expected.keys()
    links, all_links = (sum(v[0] for v in x.values()) for x in (found, expected))
    assert all(found[i][0] <= expected[i][0] for i in found) and links >= 0.95 * all_links
    if links == all_links:
        assert found == expected


def test_single_precision_and_edges(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.01]), (3, [0.0, 1.0]), (None, [1.0, 0.0]), (4, [1.0, 0.0, 0.0]), (1, [1.0, -0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"] or 0, r["kept"]) for r in ed.near_duplicates(df).collect())
    assert found == [(0, 0, 0, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True), (4, 0, 4, True)]
    assert ed.near_duplicates(df.limit(0)).count() == 0


def test_traversal_visits_cells_in_order():
    rng = np.random.default_rng(3)
    index = ed.MultiIndex(ed.unit_rows(rng.standard_normal((500, 8))), 20_000)
    x = ed.unit_rows(rng.standard_normal((20, 8)))
    index.visits = len(index.codes[0]) * len(index.codes[1])
    a, b = index.distances(x)
    for i, order in enumerate(index.traverse(x)):
        sums = [a[i][c // len(index.codes[1])] + b[i][c % len(index.codes[1])] for c in order]
        assert sorted(order) == list(range(index.visits)) and sums == sorted(sums) and order[0] == index.cells(x)[i]


@pytest.mark.parametrize("chunk", [4096, 40])
def test_every_length_is_searched(spark, chunk, monkeypatch):
    """Two thirds of one length and one third of another, compared plainly and by an index each."""
    monkeypatch.setattr(ed, "CELL_ROWS", 16)
    monkeypatch.setattr(ed, "CHUNK", chunk)
    rows = vectors(4, 300, 16)
    other = [(10_000 + i, v) for i, v in vectors(5, 150, 24) if i < 3000]
    odd = [(20_000, [1.0, 2.0, 3.0]), (20_001, [1.0, 2.0, 3.1])]
    df = spark.createDataFrame(rows + other + odd, "vec_id long, embedding array<double>")
    found = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in ed.near_duplicates(df).collect()}
    for part in (rows, other, odd):
        expected = brute(part)
        links = [sum(x[i][0] for i, _ in part) for x in (found, expected)]
        assert links[1] > 0 and (links[0] == links[1] if chunk == 4096 else 0.95 * links[1] <= links[0] <= links[1])
        if links[0] == links[1]:
            assert {i: found[i] for i, _ in part} == expected
