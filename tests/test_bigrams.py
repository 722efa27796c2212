import math
import os
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessella.functions import bigrams as B
from tessella.functions import text as T
from tessella.functions.ngrams import line_bigrams
from tessella.operators import models
from tessella.sources.storage import settle

PARTS = ["a", "bé", "</s>", "<s>", "\U0001f600", " ", " ", "\n", "\n", "\t", "￼", "\xa0", "\x85", "　", " ", "\x1c", "\x84", "7", "٣", "…", "—", "“"]


def _texts(n, seed):
    rng = random.Random(seed)
    return [None if rng.random() < 0.1 else "".join(rng.choices(PARTS, k=rng.randint(0, 14))) for _ in range(n)]


def _lines(text):
    return [] if text is None else list(line_bigrams(text))


def test_pieces_hold_the_bigrams_of_normalized_texts(spark):
    texts = _texts(400, 1)
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    want = [_lines(r.t) for r in df.select(T.normalize(F.col("t"), keep_newlines=True).alias("t")).collect()]
    piece = B.Piece.of(pa.array(["x", *texts]).slice(1))
    again, ids = B.Piece.read(piece.blob(pa.RecordBatch.from_pydict({"id": range(len(texts))})))
    assert ids["id"].to_pylist() == list(range(len(texts)))
    tokens, size = [t.decode() for t in again.tokens.to_pylist()], len(again.tokens)
    codes, counts, bucket = again.bigrams(7)
    place, of_place = again.places(7)
    named = [(tokens[c // size], tokens[c % size]) for c in codes]
    assert [[named[p] for p in place[a:b]] for a, b in zip(again.ends, again.ends[1:])] == want
    assert dict(zip(named, counts)) == Counter(g for lines in want for g in lines)
    assert (np.diff(bucket) >= 0).all() and (bucket == of_place).all() and len(set(bucket)) > 3


def test_blobs_give_back_what_they_were_given():
    parts = [b"", b"ab", np.zeros(0, np.int64), np.array([0, 255, 256, 1 << 40]), np.array([0, 0])]
    for given, got in zip(parts, B.unpack(B.pack(*parts)), strict=True):
        assert given == got if isinstance(given, bytes) else given.tolist() == got.tolist()
    assert B.unpack(B.pack()) == []


@pytest.mark.parametrize("min_count", [1, 2])
def test_bigrams_travel_as_blobs(spark, monkeypatch, min_count):
    """Every bigram of every piece was a row of its own in the shuffles, and the model and the texts had one each."""
    monkeypatch.setattr(models, "SLICES", 3)
    trained, asked = _texts(150, 2), [*_texts(500, 3), "", None]
    corpus = spark.createDataFrame([(t,) for t in trained], "text string").repartition(3)
    texts = spark.createDataFrame([(i % 450 or None, t) for i, t in enumerate(asked)], "doc_id long, text string").repartition(5)
    model = models.train_bigram_model(corpus, min_count=min_count)
    assert model.counts.count() <= model.buckets < 100
    found = {r.doc_id: r.perplexity for r in models.perplexity(texts, model, ["doc_id"]).collect()}
    norm = lambda df: df.withColumn("text", T.normalize(F.col("text"), keep_newlines=True)).collect()
    counts = Counter(g for r in norm(corpus) for g in _lines(r.text))
    v, contexts = len({b for _, b in counts}), Counter()
    for (a, _), n in counts.items():
        contexts[a] += n
    unit = lambda x: round(x * 1_000_000)
    sums = {}
    for r in norm(texts):
        score, m = sums.get(r.doc_id, (0, 0))
        for g in _lines(r.text):
            score += unit(-math.log10(v))
            score += unit(math.log10(0.1 * v) - math.log10(contexts[g[0]] + 0.1 * v)) if g[0] in contexts else 0
            score += unit(math.log10(counts[g] + 0.1) - math.log10(0.1)) if counts[g] >= min_count else 0
            m += 1
        sums[r.doc_id] = score, m
    assert set(found) == set(sums)
    for i, (score, m) in sums.items():
        assert found[i] == (pytest.approx(10 ** (-score / 1e6 / m), abs=0.11) if m else None)


def test_a_model_of_nothing(spark):
    model = models.train_bigram_model(spark.createDataFrame([], "text string"))
    texts = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert {tuple(r) for r in models.perplexity(texts, model, ["doc_id"]).collect()} == {(1, None), (2, None)}


def test_small_models_and_many_texts_share_buckets(spark):
    """The copies of a bucket answer what one of them would."""
    model = models.train_bigram_model(spark.createDataFrame([("a b",)], "text string"))
    words = [f"{i} a b {chr(97 + i % 26)}" for i in range(2000)]
    texts = spark.createDataFrame(list(enumerate(words)), "doc_id long, text string").repartition(6)
    all_in_one = {r.doc_id: r.perplexity for r in models.perplexity(texts.coalesce(1), model, ["doc_id"]).collect()}
    assert {r.doc_id: r.perplexity for r in models.perplexity(texts, model, ["doc_id"]).collect()} == all_in_one


def test_shuffle_files_go_when_a_table_is_settled(spark):
    """They stayed until the driver happened to collect its garbage."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses
    kept = blocks().size()
    table = settle(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    assert table.count() == 7 and blocks().size() <= kept + 1
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
    assert os.path.isdir(table.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0])
