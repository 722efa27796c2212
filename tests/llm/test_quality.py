import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tessella.llm import quality


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    held = "crc32(cast(doc_id as string)) % 4 = 1"
    model = quality.train(docs, labels.where(f"NOT {held}"))
    rows = quality.score_quality(docs, model).join(labels.where(held), "doc_id").collect()
    good = [r for r in rows if r["quality"] == 1]
    bad = [r for r in rows if r["quality"] == 0]
    assert len(good) > 200 and len(bad) > 30
    assert sum(r["kept"] for r in good) / len(good) > 0.99
    assert sum(not r["kept"] for r in bad) / len(bad) > 0.8
    assert all(0 <= r[c] <= 1 for r in rows for c in ("score", "text_score", "meta_score"))


def test_query_has_every_row(spark):
    docs = spark.read.parquet(f"{entry.SMOKE_DIR}/documents.parquet")
    assert entry.queries()["op8_quality_classifier"](spark, entry.SMOKE_DIR).count() == docs.count()


def test_edges(spark):
    docs = spark.createDataFrame(
        [(1, "A fine text, word by word.", "s", "en", 10), (2, None, None, None, None), (None, "", "s", "en", 0), (1, "A fine text, word by word.", "s", "en", 10), (3, "x" * 300_000, "s", "en", 1)],
        "doc_id long, text string, source string, lang string, n_chars long",
    )
    labels = spark.createDataFrame([(1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality.train(docs, labels) is None
    scored = quality.score_quality(docs, None)
    assert scored.count() == 5 and scored.where("kept").count() == 5
    many = spark.range(200).selectExpr(
        "id AS doc_id", "CASE WHEN id % 2 = 0 THEN concat('### $$$ ', id, ' ###') ELSE concat('plain text of number ', id) END AS text",
        "'s' AS source", "CAST(NULL AS string) AS lang", "id AS n_chars", "'extra' AS _extra",
    )
    truth = many.selectExpr("doc_id", "cast(doc_id % 2 AS int) AS quality")
    model = quality.train(many, truth.unionByName(truth))
    kept = quality.keep_good(many.withColumn("row", F.struct("doc_id")).withColumn("at", F.lit("x")), model)
    assert kept.where("doc_id % 2 = 0").count() == 0 and kept.count() == 100
    assert kept.columns == [*many.columns, "row", "at"] and kept.where("row.doc_id = doc_id").count() == 100
    assert quality.keep_good(docs, None).count() == 5
    worded = many.withColumn("n_chars", F.lit("not a number"))
    assert quality.keep_good(worded, model).count() > 0
    assert quality.score_quality(docs, model).count() == 5
    assert quality.score_quality(docs.select("doc_id", "text").limit(0), model).count() == 0


def test_cut_is_balanced_and_no_single_label_moves_it():
    rng = np.random.default_rng(1)
    p = np.concatenate([rng.beta(8, 1, 900), rng.beta(1, 4, 300)])
    good = rng.random(1200) < p
    cut = quality.balanced_cut(p, good)
    assert 0.35 < cut < 0.65
    # A few wrong labels change next to nothing.
    wrong = good.copy()
    wrong[np.argsort(p)[:3]] = True
    assert abs(quality.balanced_cut(p, wrong) - cut) < 0.05
    # Scores that are off are corrected.
    assert quality.balanced_cut(p**4, good) < 0.3
    assert quality.balanced_cut(p, np.ones(1200, bool)) == quality.BALANCED


def test_likely_bad_documents_go(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    held = "crc32(cast(doc_id as string)) % 4 = 1"
    model = quality.train(docs, labels.where(f"NOT {held}"))
    rows = quality.score_quality(docs, model).join(labels.where(held), "doc_id").collect()
    lost = [not r["kept"] for r in rows if r["quality"] == 1]
    left = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(lost) / len(lost) < 0.01 and sum(left) / len(left) < 0.04
