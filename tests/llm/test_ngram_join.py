import random
import re

import numpy as np
import pytest

import __spark_entry__ as entry
from tessella.llm import ngram_join as nj
from tessella.llm.components import components


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(a & sets[j])
            if a and sets[j] and 100 * shared >= 80 * (len(a) + len(sets[j]) - shared):
                root[find(i)] = find(j)
    low = {}
    for i, (doc_id, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), doc_id), doc_id)
    return sorted((d, len(s), low[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True)))


def texts(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("the of and a to in is it on".split()) if rng.random() < 0.3 else f"w{rng.randrange(4000)}"
    line = " ".join(word() for _ in range(12))
    rows, base = [], [[word() for _ in range(rng.randrange(20, 120))] for _ in range(12)]
    for i in range(260):
        words = list(rng.choice(base)) if rng.random() < 0.7 else [word() for _ in range(60)]
        for _ in range(rng.randrange(0, 4)):
            words[rng.randrange(len(words))] = word()
        text = " ".join(words)
        rows.append((i * 11 % 997, line + "\n" + text if rng.random() < 0.5 else text))
    rows += [(2000, "A b c"), (2001, "a B c"), (2002, "a b c d"), (2003, ""), (2004, None), (2005, " \n"), (2006, "x"), (2007, "a b c d e f g"), (2008, "a b c d e f g h")]
    return rows + [(2009, rows[0][1].upper()), (2009, rows[0][1].upper()), (2010, " ".join(f"w{k}" for k in range(30_000)))]


@pytest.mark.parametrize("seed,frequent,tile", [(1, 1000, 512), (2, 3, 512), (3, 3, 4)])
def test_agrees_with_brute_force(spark, seed, frequent, tile, monkeypatch):
    monkeypatch.setattr(nj, "TILE_SETS", tile)
    rows = texts(seed)
    df = spark.createDataFrame([(a, b, 0) for a, b in rows], "doc_id long, text string, fp long").repartition(3)
    assert sorted(tuple(r) for r in nj.ngram_join(df, frequent=frequent).collect()) == brute(rows)


def test_edges(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (2, None)], "doc_id long, text string")
    assert sorted((tuple(r) for r in nj.ngram_join(df).collect()), key=str) == [(1, 2, 1), (2, 0, 2), (None, None, None)]
    assert nj.ngram_join(df.limit(0)).count() == 0


def test_prefix_index_misses_no_similar_pair():
    """Every similar pair of random sets shares an index key, whatever the order of the tokens."""
    rng = np.random.default_rng(4)
    sets = []
    for _ in range(60):
        base = rng.choice(300, rng.integers(4, 40), replace=False)
        for _ in range(4):
            keep = base[rng.random(len(base)) > 0.06]
            sets.append(np.unique(np.append(keep, rng.choice(300, 1))))
    token = [np.sort(nj.mix(s.astype(np.uint64)) >> np.uint64(16)) for s in sets]
    df = {t: sum(t in set(x.tolist()) for x in token) for t in set(np.concatenate(token).tolist())}
    for frequent in (2, 10, 1000):
        rows = {"block": [], "bin": [], "counts": [], "keys": [], "ranks": []}
        ids = np.arange(len(sets))
        meta = np.stack([ids, [len(x) for x in token], ids, np.ones(len(ids), int)]).astype(np.int64)
        bins = {}
        for i, x in enumerate(token):
            for t in x.tolist():
                if df[t] > 1:
                    bins.setdefault(t >> 40, []).append((i, t & ((1 << 40) - 1), df[t]))
        rows["block"].append(0), rows["bin"].append(-1), rows["counts"].append(meta.tobytes()), rows["keys"].append(b""), rows["ranks"].append(b"")
        for b, items in bins.items():
            rows["block"].append(0)
            rows["bin"].append(b)
            rows["counts"].append(np.bincount([i for i, _, _ in items], minlength=len(ids)).astype(np.uint32).tobytes())
            rows["keys"].append(nj.pack40(np.array([t for _, t, _ in items], np.uint64)))
            rows["ranks"].append(nj._rank(np.array([n for _, _, n in items])).tobytes())
        keys = [set(k) if k else set() for k in nj._index(nj.pa.table(rows), 8, frequent)["keys"].to_pylist()]
        for i in range(len(sets)):
            for j in range(i):
                a, b = set(sets[i].tolist()), set(sets[j].tolist())
                if a != b and 100 * len(a & b) >= 80 * len(a | b):
                    assert keys[i] & keys[j]


def test_query_agrees_with_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{entry.SMOKE_DIR}/documents.parquet").collect()]
    found = entry.queries()["op5_ngram_join"](spark, entry.SMOKE_DIR).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(tuple(r) for r in found) == brute(rows)


def test_components_of_a_chain_a_star_and_a_ring(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 230)] + [(300, 301), (301, 302), (302, 300)]
    links += [(5, 5), (None, 1), (100, 101)]
    found = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    expected = {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(200, 230)]} | {i: 300 for i in (300, 301, 302)}
    assert found == expected
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
