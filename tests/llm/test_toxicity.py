import numpy as np
from pyspark.sql import functions as F

from tessella.llm import queries as q
from tessella.llm import toxicity as tx


def test_gradients_match_finite_differences():
    net = tx.Network(3)
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, 50, n).astype(np.int32) for n in (1, 2, 5, 9)]
    tok, length = tx.pad(docs, np.arange(4))
    y = np.array([0, 1, 1, 0], np.float32)
    weight = np.array([1, 2, 2, 1], np.float32)
    grads, loss = net.gradients(tok, length, y, weight)
    params = net.params()
    for k, (x, g) in enumerate(zip(params, grads, strict=True)):
        flat = np.flatnonzero(np.abs(g) > 1e-4)[:3] if k else [int(docs[2][0]) * tx.DIM]
        for i in flat:
            old = x.flat[i]
            x.flat[i] = old + 1e-2
            up = net.gradients(tok, length, y, weight)[1]
            x.flat[i] = old - 1e-2
            down = net.gradients(tok, length, y, weight)[1]
            x.flat[i] = old
            assert abs((up - down) / 2e-2 - g.flat[i]) < 2e-2 + 0.1 * abs(g.flat[i])


def test_best_threshold_separates():
    raw = np.array([3.0, 2.0, 1.0, -1.0, -2.0])
    assert tx.best_threshold(raw, np.array([1, 1, 1, 0, 0])) == 0.0


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.01"
    got = q.op12_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").toPandas()
    y, s = got.toxic.values, got.score.values
    order = np.argsort(s)
    ranks = np.empty(len(s))
    ranks[order] = np.arange(1, len(s) + 1)
    auc = (ranks[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() + 1) / 2) / ((y == 1).sum() * (y == 0).sum())
    assert auc > 0.75
    assert ((got.score >= 0.5).astype(int) == got.predicted).all()


def test_rows_without_text_or_labels(spark, monkeypatch):
    monkeypatch.setattr(tx, "EPOCHS", 2)
    texts = ["you idiot moron", "a nice calm day", None, "", "x" * 300_000, "idiot " * 5000, "calm " * 20]
    docs = spark.createDataFrame([(i % 9, t, "en", "s", "clash") for i, t in enumerate(texts * 6)], "doc_id long, text string, lang string, source string, score string")
    labels = spark.createDataFrame([(i, int(i in (0, 5)), 0) for i in range(9)], "doc_id long, toxic int, quality int")
    held = F.lit(False)
    model = tx.train(docs, labels, held)
    out = tx.score_toxicity(docs, model).collect()
    assert len(out) == len(texts) * 6
    assert all(0.0 <= r["score"] <= 1.0 for r in out)
    assert tx.train(docs, labels.where("toxic = 0"), held) is None
    assert {r["score"] for r in tx.score_toxicity(docs, None).collect()} == {0.5}
    assert tx.score_toxicity(docs.limit(0), model).count() == 0


def test_every_labelled_row_teaches(spark, monkeypatch):
    monkeypatch.setattr(tx, "EPOCHS", 2)
    monkeypatch.setattr(tx, "SHARD_ROWS", 4)
    seen = []
    fit, calibrate = tx.fit, tx.calibrate
    monkeypatch.setattr(tx, "fit", lambda rows, counts: seen.append(rows.count()) or fit(rows, counts))
    monkeypatch.setattr(tx, "calibrate", lambda model, rows: seen.append(rows.count()) or calibrate(model, rows))
    docs = spark.range(8000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'you idiot', 'calm day') AS text", "'en' AS lang")
    labels = spark.range(8000).selectExpr("id AS doc_id", "int(id % 3 = 0) AS toxic")
    model = tx.train(docs, labels, F.lit(False))
    assert sum(seen) == 8000
    again = tx.train(docs.repartition(5), labels, F.lit(False))
    assert all((a == b).all() for a, b in zip(model.net.params(), again.net.params(), strict=True))
    assert model.common == again.common


def test_threshold_of_counted_steps():
    raw = np.array([2.0, 0.0, 1.0])
    assert tx.best_threshold(raw, np.array([1, 0, 0]), np.array([10, 50, 3]), 0.5) == 1.75
