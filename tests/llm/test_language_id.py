import math
import random
import zlib

import numpy as np

import __spark_entry__ as entry
from tessella.llm import language_id as li


def test_probabilities_add_up_and_agree_with_a_plain_tree():
    rng = random.Random(1)
    text = "".join(rng.choice("abca ") for _ in range(400))
    data = np.frombuffer(text.encode(), np.uint8)
    table = li.count_contexts(li.pa.table({"text": [text], "lang": ["x"]}))
    counts = [(np.frombuffer(g, np.uint64), np.frombuffer(c, np.int64)) for g, c in zip(table["grams"].to_pylist(), table["counts"].to_pylist(), strict=True)]
    tree = li.ContextTree(counts)
    padded = "    " + text
    follow = {}
    for i in range(len(text)):
        for k in range(li.ORDER + 1):
            context = padded[i + 4 - k : i + 4]
            follow.setdefault(context, {}).setdefault(padded[i + 4], 0)
            follow[context][padded[i + 4]] += 1

    def plain(context, byte):
        if context is None:
            return 1 / 256
        shorter = context[1:] if context else None
        seen = follow.get(context)
        if not seen:
            return plain(shorter, byte)
        total = sum(seen.values()) + len(seen)
        if byte in seen:
            return seen[byte] / total
        rest = 1 - sum(plain(shorter, b) for b in seen)
        return len(seen) / total / rest * plain(shorter, byte)

    for context in ("abca", "zabc", "aaaa", "qqqq"):
        assert math.isclose(sum(plain(context, chr(b)) for b in range(256)), 1, rel_tol=1e-9)
        codes = np.array([int.from_bytes((context + chr(b)).encode("latin-1"), "big") for b in range(256)], np.uint64)
        for b, bits in enumerate(tree.cost(codes)):
            assert math.isclose(2.0**-bits, plain(context, chr(b)), rel_tol=1e-9)
    model = li.Model({"x": tree})
    bits = model.code_lengths(data, np.array([0, 0, len(data)]))
    expected = sum(-math.log2(plain(padded[i : i + 4], padded[i + 4])) for i in range(len(text)))
    assert bits[0, 0] == 0 and math.isclose(bits[1, 0], expected, rel_tol=1e-4)


def test_held_out_accuracy(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()}
    rows = entry.queries()["op2_language_id"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    right = sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held)
    assert len(held) > 150 and right > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_edges(spark):
    rows = [(1, "the cat sat on the mat", "en"), (2, "le chat est sur le tapis", "fr"), (3, None, "en"), (4, "", None), (5, "12 34!", "en"), (None, "le chat", "fr"), (1, "the mat", "en")]
    df = spark.createDataFrame([(a, b, c, 0.5) for a, b, c in rows], "doc_id long, text string, lang string, score double")
    model = li.train(df)
    assert model.languages == ["en", "fr"]
    found = sorted((r["doc_id"] or 0, r["lang_pred"], r["score"] > 0) for r in li.identify(df, model).collect())
    assert found == [(0, "fr", True), (1, "en", True), (1, "en", True), (2, "fr", True), (3, "und", False), (4, "und", False), (5, "und", False)]
    none = li.train(df.where("lang IS NULL"))
    assert none is None
    assert {r["lang_pred"] for r in li.identify(df, none).collect()} == {"und"}
    assert li.identify(df.limit(0), model).count() == 0
