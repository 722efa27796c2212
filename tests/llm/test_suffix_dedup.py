import hashlib
import random

import numpy as np
import pytest

import __spark_entry__ as entry
from tessella.llm import suffix_dedup as sd


def brute(rows):
    """{(doc_id, text): digest} by comparing every 50-byte string of every document."""
    first = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        for p in range(len(data) - 49):
            s = data[p : p + 50]
            first[s] = min(first.get(s, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 49):
            if first[data[p : p + 50]] < doc_id:
                gone[p : p + 50] = b"\1" * 50
        runs = [r for r in bytes(gone).split(b"\0") if r]
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out.append((doc_id, len(data), sum(gone), len(runs), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def digest(df):
    return sorted((
        (r["doc_id"], r["n_bytes"], sum(x["end"] - x["start"] for x in r["removed"]), len(r["removed"]), r["kept_sha256"])
        for r in df.collect()
    ), key=str)


def texts(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé ") for _ in range(rng.randrange(1, 9)))
    shared = [" ".join(word() for _ in range(rng.randrange(5, 40))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [rng.choice(shared) if rng.random() < 0.4 else " ".join(word() for _ in range(12)) for _ in range(rng.randrange(0, 6))]
        rows.append((i * 3 % 101, " ".join(parts)))
    rows += [(200, rows[3][1]), (201, rows[3][1] + "x"), (202, "a" * 400), (203, "a" * 51), (204, "ab" * 300), (205, "ab" * 30)]
    return rows + [(206, None), (207, ""), (208, "short"), (209, rows[5][1]), (209, rows[5][1])]


@pytest.mark.parametrize("seed", [1, 2])
def test_agrees_with_brute_force(spark, seed):
    rows = texts(seed)
    df = spark.createDataFrame([(a, b, a) for a, b in rows], "doc_id long, text string, block long")
    assert digest(sd.repeated_spans(df)) == brute(rows)


def test_hot_names_give_the_same(spark):
    rows = texts(7)
    docs, hot = {i: t for i, t in rows[:64]}, sd.HOT
    table = sorted(docs.items())
    data, offsets = sd.text_bytes(sd.pa.array([t for _, t in table]))
    names = [sd._send_names(sd.pa.table({"doc_id": [i for i, _ in part], "text": [t for _, t in part], "block": [b] * len(part)}), 8) for b, part in enumerate((table[::2], table[1::2]))]
    blocks = (table[::2], table[1::2])
    results = []
    for limit in (hot, 2):
        sd.HOT = limit
        try:
            by_bin = sd.pa.concat_tables(names)
            answers = sd.pa.concat_tables([sd._merge_names(by_bin.filter(sd.pa.compute.equal(by_bin["deal"], d))) for d in sorted(set(by_bin["deal"].to_pylist()))])
            frames = [sd.pa.table({"doc_id": [i for i, _ in p], "text": [t for _, t in p], "block": [b] * len(p)}) for b, p in enumerate(blocks)]
            sent = sd.pa.concat_tables([sd._send_spans(f, answers.filter(sd.pa.compute.equal(answers["block"], b)), 8) for b, f in enumerate(frames)])
            found = sd.pa.concat_tables([sd._find_owners(sent.filter(sd.pa.compute.equal(sent["deal"], d))) for d in sorted(set(sent["deal"].to_pylist()))])
            results.append([sd._remove(f, found.filter(sd.pa.compute.equal(found["block"], b))).to_pylist() for b, f in enumerate(frames)])
        finally:
            sd.HOT = hot
    assert results[0] == results[1]
    assert any(r["removed"] for r in results[0][0])


def test_two_stage_order_and_prefixes():
    rng = random.Random(5)
    for trial in range(20):
        alphabet = rng.choice([2, 4, 200])
        data = np.array([rng.randrange(alphabet) for _ in range(900)], np.uint8)
        data[400:520] = data[100:220]
        if trial % 4 == 0:
            data[600:800] = 9
        wanted = np.random.default_rng(trial).random(900) < 0.5
        wanted[840:] = False
        order = sd.two_stage_sort(data, wanted)
        found = [data[p : p + 50].tobytes() for p in order]
        assert len(order) == wanted.sum() and found == sorted(found)
        common = sd.common_prefixes(data, order)
        for a, b, n in zip(found, found[1:], common[1:].tolist(), strict=False):
            assert a[:n] == b[:n] and (n == 50 or a[n] != b[n])


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sd.repeated_spans(empty).count() == 0
    odd = spark.createDataFrame([(None, "n" * 80), (1, "n" * 80), (2, None)], "doc_id long, text string")
    assert [x[:4] for x in sorted(digest(sd.repeated_spans(odd)), key=str)] == [(1, 80, 0, 0), (2, 0, 0, 0), (None, 80, 0, 0)]


def test_query_agrees_with_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{entry.SMOKE_DIR}/documents.parquet").collect()]
    found = [tuple(r) for r in entry.queries()["op1_suffix_dedup"](spark, entry.SMOKE_DIR).collect()]
    assert sorted(found, key=str) == brute(rows)


def test_slices_do_not_change_the_result(spark, monkeypatch):
    rows = [(i, t or "") for i, t in texts(11)]
    data, offsets = sd.text_bytes(sd.pa.array([t for _, t in rows]))

    def windows(found):
        return {(int(s) + k, int(n)) for s, c, n in zip(*found, strict=True) for k in range(int(c))}

    whole = windows(sd.spans(data, offsets))
    assert len(whole) == sum(max(0, len(t.encode()) - 49) for _, t in rows)
    for size in (64, 300, 1000):
        monkeypatch.setattr(sd, "SLICE", size)
        assert windows(sd.spans(data, offsets)) == whole
    from tessella.llm import textkit

    starts = np.arange(0, len(data) - 60, 7)[::-1]
    expected = textkit.span_hashes(data, starts, starts + 60)
    monkeypatch.setattr(textkit, "HASH_BYTES", 500)
    assert (textkit.span_hashes(data, starts, starts + 60) == expected).all()
