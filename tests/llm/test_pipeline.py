import hashlib
from collections import Counter, defaultdict

import __spark_entry__ as entry
import corpus_pipeline
from llm.test_ngram_join import brute


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{entry.SMOKE_DIR}/documents.parquet")
    frames = [docs]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, frames[-1], entry.SMOKE_DIR)
        out.write.parquet(f"{tmp_path}/{number}")
        frames.append(spark.read.parquet(f"{tmp_path}/{number}"))
    for frame in frames[1:-1]:
        assert frame.columns == docs.columns
    rows = [[(r["doc_id"], r["text"]) for r in f.select("doc_id", "text").collect()] for f in frames[:-1]]
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{entry.SMOKE_DIR}/labels.parquet").collect()}
    kept = {i for i, _ in rows[1]}
    good = [i for i in labels if labels[i] == 1]
    assert sum(i in kept for i in good) >= 0.99 * len(good)
    assert kept < {i for i, _ in rows[0]} and len(rows[1]) == len(kept)
    last = {}
    for i, t in rows[1]:
        last[t] = max(last.get(t, i), i)
    assert sorted(rows[2]) == sorted((i, t) for t, i in last.items())
    components = {i: c for i, _, c in brute(rows[2])}
    assert sorted(i for i, _ in rows[3]) == sorted(i for i, c in components.items() if i == c)
    texts = dict(rows[3])
    times = Counter(i for i, _ in rows[4])
    assert set(times) <= set(texts) and max(times.values()) <= 3 and all(texts[i] == t for i, t in rows[4])
    packed = defaultdict(int)
    for r in frames[-1].collect():
        packed[r["doc_id"]] += r["n_tokens"]
    assert packed == {i: n * len(texts[i].split()) for i, n in times.items()}


def test_run_gives_the_same_rows_again(spark):
    def digest(df):
        return hashlib.sha256("".join(sorted(map(str, df.collect()))).encode()).hexdigest()

    run = entry.queries()["pipeline"]
    assert digest(run(spark, entry.SMOKE_DIR)) == digest(run(spark, entry.SMOKE_DIR))


def test_every_operator_is_registered_once():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))
    assert len(corpus_pipeline.STAGES) == 5


def test_odd_rows_and_empty_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, position string, size string, epoch int, kept string"
    text = "a b c d e f g h"
    rows = [(1, text, "en", "s", 5, "p", "z", 1, "k"), (1, text, "en", "s", 5, "p", "z", 1, "k"), (2, text, None, None, None, None, None, None, None)]
    rows += [(None, "no id at all", "en", "s", 1, "p", "z", 2, "k"), (3, None, "en", "s", 0, "p", "z", 3, "k"), (4, "", "en", None, 0, "p", "z", 4, "k")]
    labels = spark.createDataFrame([(1, 1, 0), (None, None, None)], "doc_id long, quality int, toxic int")
    for name, data in (("odd", rows), ("empty", [])):
        folder = f"{tmp_path}/{name}"
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/documents.parquet")
        (labels if data else labels.limit(0)).write.parquet(f"{folder}/labels.parquet")
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, folder)
            assert number == 4 or out.columns == docs.columns
            out.write.parquet(f"{folder}/out{number}")
            docs = spark.read.parquet(f"{folder}/out{number}")
        found = docs.select("doc_id", "n_tokens").collect()
        assert {r["doc_id"] for r in found} <= {1, 2, None} and bool(found) == bool(data)
