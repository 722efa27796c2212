"""Sources, sinks, ordinals and models."""

import gzip

import pytest
from pyspark.sql import functions as F

from tessella.operators import models
from tessella.operators.ordinals import with_ordinal
from tessella.operators.profile import sample_docs
from tessella.sources import pointers, records, tables
from tessella.sources.storage import checkpoint_dir


def _record(kind: str, body: bytes, http: str = "Content-Type: text/html; charset=latin-1") -> bytes:
    payload = f"HTTP/1.1 200 OK\r\n{http}\r\n\r\n".encode() + body
    return f"WARC/1.0\r\nWARC-Type: {kind}\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + payload + b"\r\n\r\n"


def test_archive_files_to_pages(spark, tmp_path):
    parts = [gzip.compress(_record("request", b"-") + _record("response", f"é{i}".encode("latin-1"))) for i in range(5)]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(parts))
    offsets = [sum(map(len, parts[:i])) for i in range(5)]
    rows = [(i, "a.warc.gz", offsets[i], len(parts[i])) for i in range(5)]
    rows += [(5, "missing.gz", 0, 10), (6, "a.warc.gz", offsets[4], 10**6)]
    wanted = spark.createDataFrame(rows, "id int, warc_filename string, warc_record_offset long, warc_record_length long")
    read = records.slice_records(wanted, tmp_path.as_uri(), partitions=3)
    pages = {r.id: (r.html, r.html_error, r.download_success) for r in records.warc_to_pages(read).collect()}
    assert [pages[i] for i in range(5)] == [(f"é{i}", "", True) for i in range(5)]
    assert pages[5] == pages[6] == ("", "no WARC", False)


@pytest.mark.parametrize(
    "data, page",
    [
        (_record("response", "ü".encode(), "Content-Type: text/html"), ("ü", "")),
        (_record("response", b"\xff", "Content-Type: text/html; charset=utf-8"), ("�", "")),
        (_record("response", b"3\r\nabc\r\n0\r\n\r\n", "Transfer-Encoding: chunked"), ("abc", "")),
        (_record("response", gzip.compress(b"z"), "Content-Encoding: gzip"), ("z", "")),
        (_record("request", b"x"), ("", "No page or encoding")),
        (b"", ("", "No page or encoding")),
        (b"garbage\r\n\r\n", ("", "not an archive record")),
    ],
)
def test_response_page(data, page):
    assert records._page(data, "") == page


def test_shards(spark):
    df = spark.range(7).select(F.col("id").alias("doc_id"))
    got = sorted((r.doc_id, r.shard, r.split) for r in tables.with_shards(df, 2).collect())
    assert [s for _, s, _ in got] == [0, 0, 1, 1, 2, 2, 3]
    assert [s for _, _, s in got] == ["valid"] * 4 + ["train"] * 3


@pytest.mark.parametrize("rows_per_piece", [2, 7, 1000])
def test_ordinals(spark, rows_per_piece):
    df = spark.range(500).select((F.col("id") * F.col("id") - 90).alias("k")).repartition(6)
    got = with_ordinal(df, "k", rows_per_piece=rows_per_piece).orderBy("k").collect()
    assert [r.ordinal for r in got] == list(range(500))
    assert with_ordinal(df.limit(0), "k").count() == 0


def test_write_and_read(spark, tmp_path, make_docs):
    docs = make_docs([(i, f"https://a.org/{i}", "w", ["t", f"@i{i % 2}"]) for i in range(5)])
    tables.write_shards(docs, str(tmp_path / "shards"), 2)
    assert tables.load(spark, str(tmp_path / "shards")).filter("split = 'valid'").count() == 4
    tables.write_url_list(docs, str(tmp_path / "urls"))
    assert sorted(tables.load_word_list(spark, str(tmp_path / "urls"))) == ["i0", "i1"]
    with pytest.raises(ValueError):
        tables.load_word_list(spark, str(tmp_path / "urls"), max_words=1)
    with pytest.raises(ValueError):
        tables.concat([docs], expected=2)


def test_success_and_volume(spark):
    df = spark.createDataFrame([("", 512), ("x", 512), (None, 1024)], "e string, warc_record_length long")
    assert pointers.success_rate(df, "e").first()["n_ok"] == 2
    assert pointers.volume(df).first()["volume"] == "2.00 KB"
    one = spark.createDataFrame([(1,)], "b long").select(pointers.human_bytes(F.col("b")))
    assert one.first()[0] == "1.0 Bytes"


def test_checkpoint_folder_is_the_configured_one(spark):
    assert spark.conf.get("spark.checkpoint.dir").split("/")[-1] in checkpoint_dir(spark)


def test_sample_depends_on_seed_only(spark):
    ids = lambda df, seed: [r.id for r in sample_docs(df, 5, seed, "id").collect()]
    assert ids(spark.range(100), 1) == ids(spark.range(100).repartition(7), 1) != ids(spark.range(100), 2)


def test_models_agree_with_and_without_broadcast(spark):
    rows = [(1, "the cat sat on the mat\nthe end", "en"), (2, "die katze sitzt dort", "de"), (3, "", "en"), (4, "zz", "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    language = models.train_language_model(docs)
    near = sorted(models.identify_language(docs, language, ["doc_id"]).collect())
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(threshold, "-1")
    far = sorted(models.identify_language(docs, language, ["doc_id"]).collect())
    spark.conf.unset(threshold)
    assert near == far and len(near) == 4
    assert [r.lang_pred for r in near[:2]] == ["en", "de"]
    assert near[2].lang_score == 0.5
    lm = models.train_bigram_model(docs)
    near = sorted(models.perplexity(docs, lm, ["doc_id"]).collect())
    spark.conf.set(threshold, "-1")
    far = sorted(models.perplexity(docs, lm, ["doc_id"]).collect())
    spark.conf.unset(threshold)
    assert near == far and len(near) == 4
    unseen = spark.createDataFrame([(1, "the cat sat"), (2, "sat the xyzzy")], "doc_id long, text string")
    seen, odd = [r.perplexity for r in sorted(models.perplexity(unseen, lm, ["doc_id"]).collect())]
    assert seen < odd
