"""Deduplication, clean-up, filters and images on small documents."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tessella.constants import END_OF_DOCUMENT as EOD
from tessella.functions.similarity import similarity_percent
from tessella.operators import cleanup, dedup, filters, images, profile
from tessella.plans import flows
from tessella.plans.options import PARAGRAPH_CHECKS, ImageChecks, TextChecks, from_mapping


def nodes(docs, step):
    return docs.withColumn("nodes", step(F.col("nodes")))


def one(make_docs, bodies, texts, step):
    return bodies(nodes(make_docs([(1, "https://a.org/x", "w", texts)]), step))[1]


def test_merge_adjacent_texts(make_docs, bodies):
    got = one(make_docs, bodies, ["t1", "t2", "", "@i", "t3", None, ""], cleanup.merge_adjacent_texts)
    assert got == ["t1\n\nt2", "@i", "t3"]
    assert one(make_docs, bodies, got, cleanup.merge_adjacent_texts) == got
    assert one(make_docs, bodies, ["", None], cleanup.merge_adjacent_texts) == []


def test_markers(make_docs, bodies):
    text = f"{EOD}\n\n {EOD} \n\nx\n\n{EOD}"
    collapsed = one(make_docs, bodies, [text], cleanup.collapse_markers)
    assert collapsed == [f"{EOD}\n\nx\n\n{EOD}"]
    assert one(make_docs, bodies, collapsed, cleanup.drop_trailing_marker) == [f"{EOD}\n\nx"]
    assert one(make_docs, bodies, [EOD], cleanup.drop_trailing_marker) == [""]
    assert one(make_docs, bodies, [f"a\n\n\n{EOD}"], cleanup.drop_trailing_marker) == [f"a\n\n\n{EOD}"]
    assert one(make_docs, bodies, [f"a\n\n{EOD}", "@i"], cleanup.drop_trailing_marker) == [f"a\n\n{EOD}", "@i"]


def test_spam_cutoff_is_strict(make_docs, bodies):
    at_cutoff = " ".join(["share"] * 3 + ["x"] * 22)  # 3 / 25 = 0.12
    below = " ".join(["share"] * 2 + ["x"] * 18)
    got = one(make_docs, bodies, [f"{at_cutoff}\n\n{below}", at_cutoff], cleanup.drop_spam_paragraphs)
    assert got == [below, ""]


def test_final_processing_filters(make_docs, bodies):
    docs = make_docs(
        [
            (1, "https://a.org/1", "w", ["text", "@i", "@i", "more"]),
            (2, "https://a.org/2", "w", [EOD, "@i"]),
            (3, "https://a.org/3", "w", ["only text"]),
            (4, "https://a.org/4", "w", ["@i"]),
        ]
    )
    assert bodies(cleanup.final_processing(docs)) == {1: ["text", "@i", "more"]}
    assert set(bodies(cleanup.final_cleaning(docs))) == {1, 2}


def test_dedup_by_url(make_docs):
    docs = make_docs([(i, "https://a.org/u", w, ["x"]) for i, w in enumerate(["c1", "c2", "c2"])])
    assert {r.doc_id for r in dedup.dedup_by_url(docs).collect()} == {1, 2}
    assert {r.doc_id for r in dedup.dedup_by_url(docs, strict=True).collect()} == {2}
    assert dedup.url_dup_stats(docs).first().asDict() == {
        "n_docs": 3,
        "n_repeated_urls": 1,
        "n_docs_in_groups": 3,
        "n_removable": 2,
    }


def test_dedup_paragraphs(make_docs, bodies):
    docs = make_docs(
        [
            (1, "https://a.org/1", "w", ["p\n\nq\n\np", EOD, "@i"]),
            (2, "https://a.org/2", "w", ["p", EOD, "q"]),
            (3, "https://b.org/1", "w", ["q", "p", EOD]),
        ]
    )
    assert bodies(dedup.dedup_paragraphs_by_domain(docs)) == {1: ["q", EOD, "@i"], 2: ["", EOD, "q"], 3: ["q", "p", EOD]}
    strict = dedup.dedup_paragraphs_by_domain(docs, min_count=2, drop_empty=True)
    assert bodies(strict) == {1: [EOD, "@i"], 2: [EOD], 3: ["q", "p", EOD]}


def test_dedup_by_image_set(make_docs):
    docs = make_docs(
        [
            (1, "https://a.org/1", "w1", ["@a", "@b"]),
            (2, "https://a.org/2", "w2", ["@b", "@a", "@a"]),
            (3, "https://a.org/3", "w0", ["no image"]),
            (4, "https://a.org/4", "w0", []),
            (5, "https://a.org/5", "w0", ["@ab"]),
        ]
    )
    kept = dedup.dedup_by_image_set(docs)
    assert {r.doc_id for r in kept.collect()} == {2, 3, 4, 5}
    assert dedup.dedup_by_image_set(kept).count() == 4


def _skewed(make_docs):
    """One image, one URL and one paragraph in a third of all rows."""
    rng = random.Random(2)
    rows = []
    for i in range(300):
        hot = i % 3 == 0
        url = "https://hot.org/x" if hot else f"https://d{i % 7}.org/{i % 50}"
        texts = ["hot paragraph" if hot else f"p{rng.randint(0, 60)}", "@hot" if hot else f"@i{rng.randint(0, 80)}", f"t{i}"]
        rows.append((i, url, f"w{i % 5}", texts))
    return make_docs(rows)


@pytest.mark.parametrize("partitions", [5])
def test_hot_keys_change_nothing(make_docs, bodies, partitions):
    docs = _skewed(make_docs).repartition(partitions)
    listed = docs.select(F.lit("hot").alias("url")).distinct()
    store = docs.select(F.explode(F.col("nodes")["src"]).alias("url")).filter("url is not null").distinct()
    store = store.select("url", F.length("url").alias("image"))
    salted = {"share": 0.01, "min_rows": 5}
    for run in (
        lambda **k: dedup.dedup_frequent_images(docs, 5, **k),
        lambda **k: dedup.dedup_by_url(docs, **k),
        lambda **k: dedup.dedup_paragraphs_by_domain(docs, **k),
        lambda **k: filters.remove_listed_images(docs, listed, **k),
        lambda **k: filters.drop_unsafe_image_docs(docs, listed, **k),
        lambda **k: images.attach_images(docs, store, **k).withColumn(
            "nodes",
            F.transform("nodes", lambda n: n.withField("src", F.coalesce(n["image"].cast("string"), n["src"]))),
        ),
    ):
        assert bodies(run(**salted)) == bodies(run())


def test_salts_spread_a_hot_key(spark):
    from tessella.operators.skew import hot_keys

    counts = spark.createDataFrame([("a", 1000), ("b", 10)], "k string, n long")
    assert [tuple(r) for r in hot_keys(counts, ["k"], share=0.01, min_rows=1).collect()] == [("a", 100)]
    assert hot_keys(counts, ["k"]).count() == 0


def test_similar_nodes_against_brute_force(make_docs, bodies):
    rng = random.Random(4)
    words = ["alpha", "beta", "gamma", "delta", "eps"]
    rows = []
    for d in range(6):
        texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 6))) for _ in range(30)]
        texts += [None, "@img", "", ""]
        rng.shuffle(texts)
        rows.append((d, f"https://a.org/{d}", "w", texts))
    rows.append((9, "https://a.org/9", "w", ["t", "t", None, "u"]))

    def expected(texts):
        real = [None if t is None or t.startswith("@") else t for t in texts]
        return {
            j
            for j in range(len(real))
            if real[j] is not None
            and any(real[i] is not None and similarity_percent(real[i], real[j]) >= 80 for i in range(j))
        }

    want = {(d, j) for d, _, _, texts in rows for j in expected(texts)}
    docs = make_docs(rows)
    for per_tile in (512, 7, 3):
        found = dedup.similar_nodes(docs, 80, per_tile)
        assert {(r.doc_id, r.pos) for r in found.collect()} == want
    assert (9, 1) in want and (9, 3) not in want


def test_filter_paragraphs(make_docs, bodies):
    good = "a perfectly normal sentence of words"
    docs = make_docs(
        [
            (1, "https://a.org/1", "w", [f"{good}\n\nno\n\n{EOD}", "no", "@i", None]),
            (2, "https://a.org/2", "w", [EOD]),
        ]
    )
    checks = PARAGRAPH_CHECKS.without_models()
    assert bodies(filters.filter_paragraphs(docs, checks)) == {1: [f"{good}\n\n{EOD}", "@i"], 2: [EOD]}
    # With newlines taken as non-printing, a text node is one paragraph.
    flat = filters.filter_paragraphs(docs, checks, keep_newlines=False)
    assert bodies(flat)[1][0] == f"{good}  no  {EOD}"


def test_checks_stop_at_the_first_failure(spark):
    checks = TextChecks(min_words=2, max_special_chars=0.5, flagged_words=("bad",), max_flagged_words=0.01)
    df = spark.createDataFrame([("x",), ("a b ...",), ("a bad b",), ("a b c",)], "t string")
    got = [r[0] for r in df.select(filters.first_failed_check(F.col("t"), checks)).collect()]
    assert got == ["number_words", "special_characters", "flagged_words", None]


def test_audit_is_a_partition(make_docs):
    docs = make_docs([(i, "https://a.org/1", "w", ["word " * i]) for i in range(12)])
    checks = TextChecks(min_words=4, max_words=9)
    audited = filters.audit(docs, checks)
    kept = {r.doc_id for r in filters.filter_documents(docs, checks).collect()}
    assert kept == {r.doc_id for r in audited.filter("failed_check is null").collect()} == set(range(4, 10))
    assert sum(r.n_docs for r in filters.audit_counts(audited).collect()) == 12


def test_image_checks(spark):
    rows = [(150, 300, None, None), (149, 300, None, None), (900, 300, None, None), (400, 400, 20, None), (400, 400, None, 50)]
    df = spark.createDataFrame(rows, "w int, h int, px int, pct int")
    rendered = filters.rendered_size(F.col("w"), F.col("px"), F.col("pct"))
    got = df.select(filters.valid_size(F.col("w"), F.col("h"), rendered, F.lit(None), ImageChecks())).collect()
    assert [r[0] for r in got] == [True, False, False, False, True]
    half = spark.createDataFrame([(25, 10), (35, 10)], "w int, p int")
    assert [r[0] for r in half.select(filters.rendered_size(F.col("w"), F.lit(None), F.col("p"))).collect()] == [2, 4]


def test_options():
    assert from_mapping(TextChecks, {"max_words": "None", "stop_words": ["a"]}) == replace(TextChecks(), stop_words=("a",))
    with pytest.raises(ValueError):
        from_mapping(TextChecks, {"nonsense": 1})


def test_attach_images_in_two_passes(make_docs, spark):
    docs = make_docs([(1, "https://a.org/1", "w", ["@a", "t", "@b", "@logo"])])
    first = spark.createDataFrame([("a", "A1"), ("logo", "L")], "url string, image string")
    second = spark.createDataFrame([("a", "A2"), ("b", "B2")], "url string, image string")
    once = images.attach_images(docs, first, banned_words=["logo"])
    assert once.select("num_found", "num_not_found").first() == (1, 2)
    twice = images.attach_images(once, second).first()
    assert [n["image"] for n in twice["nodes"]] == ["A1", None, "B2", None]
    assert (twice["num_found"], twice["num_not_found"]) == (2, 1)
    merged = images.merge_image_sets(first, second)
    assert dict(merged.collect()) == {"a": "A2", "b": "B2", "logo": "L"}


def test_histogram(spark):
    values = spark.createDataFrame([(float(i % 10),) for i in range(100)], "v double")
    got = profile.trimmed_histogram(values, "v", bins=5, low=0.1, high=0.9).collect()
    assert sum(r.n for r in got) == 80 and len(got) == 5
    assert min(r.bin_start for r in got) == 1.0


def test_curate_keeps_order_and_whole_stages(make_docs):
    docs = _skewed(make_docs)
    stages = flows.curate(docs, opted_out=docs.select(F.lit("i3").alias("url")).limit(1))
    report = {r.stage: r.n_docs for r in profile.stage_report(stages).collect()}
    assert list(stages)[0] == "input" and list(stages)[-1] == "final_processing"
    assert report["input"] == 300 >= report["url"] >= report["final_processing"] > 0


def test_views_keep_every_line(spark):
    from tessella.catalog import document_queries as D
    from tessella.catalog import page_queries as P
    from tessella.catalog import views as V

    sf_dir = "/root/testdata/sf0.001"
    whole = {r["doc_id"]: r["text"] for r in V.docs_web(spark, sf_dir).collect()}
    for markers, change in ((False, None), (True, None), (False, D.more_markers)):
        docs = V.web_docs(spark, sf_dir, markers)
        docs = change(docs) if change else docs
        for r in docs.collect():
            lines = [n["text"] for n in r["nodes"] if n["kind"] == "text" and n["text"] != D.EOD]
            assert "\n".join(lines) == whole[r["doc_id"]]
    assert all("{L}" in f for f in P.FRAGMENTS)
    assert V.images(spark, sf_dir).filter("url LIKE '%7.jpg'").count() > 0


def test_rows_without_keys_stay(spark):
    schema = "doc_id long, url string, warc_filename string"
    rows = [(1, None, "a"), (2, "u", "a"), (3, "u", None), (4, "v", None), (5, "w", "b"), (6, "w", "b"), (None, None, None)]
    docs = spark.createDataFrame(rows, schema)
    kept = lambda df: sorted((r["doc_id"] for r in df.collect()), key=str)
    assert kept(dedup.dedup_by_url(docs)) == [1, 2, 4, 5, 6, None]
    assert kept(dedup.dedup_by_url(docs, strict=True)) == [1, 2, 4, 6, None]
    node = "array<struct<kind string, text string, src string>>"
    image = [("image", None, "x")]
    docs = spark.createDataFrame(
        [(1, "a", None), (2, "a", image), (3, "b", image), (4, "c", [("text", "t", None)]), (5, None, image)],
        f"doc_id long, warc_filename string, nodes {node}",
    )
    assert kept(dedup.dedup_by_image_set(docs)) == [1, 3, 4]


def test_image_sets_have_every_address_once(spark):
    from tessella.operators import images as I

    first = spark.createDataFrame([("x", "1"), ("y", "2"), ("y", "2")], "url string, image string")
    second = spark.createDataFrame([("y", "3"), ("y", "4"), ("z", "5")], "url string, image string")
    found = I.merge_image_sets(first, second).collect()
    assert sorted(r["url"] for r in found) == ["x", "y", "z"]
    assert next(r["image"] for r in found if r["url"] == "y") in ("3", "4")


def test_missing_scores_and_models_are_errors(spark, make_docs):
    from tessella.operators import filters
    from tessella.plans import flows

    with pytest.raises(ValueError, match="no columns"):
        filters.unsafe_urls(spark.createDataFrame([("x", 0.9)], "url string, nsfw double"), {"porn": 0.5})
    docs = make_docs([(1, "https://a.org/1", "w", ["a b c d"])])
    with pytest.raises(ValueError, match="no model"):
        flows.filter_corpus(docs)


def test_a_document_of_many_nodes_is_edited_in_one_pass(spark):
    import time

    from tessella.operators import nodes as N

    n = 50_000
    docs = spark.range(1).selectExpr(
        "id AS doc_id",
        f"transform(sequence(0, {n - 1}), i -> named_struct('kind', 'text', 'text', concat('t', i, '\\n\\nu'), 'src', cast(null as string))) AS nodes",
    )
    drops = spark.range(0, n, 2).selectExpr("cast(0 as bigint) AS doc_id", "cast(id as int) AS pos")
    started = time.time()
    kept = N.drop_nodes(docs, drops).select("nodes.text").first()[0]
    assert [t.split()[0] for t in kept] == [f"t{i}" for i in range(1, n, 2)]
    pars = drops.selectExpr("doc_id", "pos AS node", "cast(0 as int) AS par")
    cut = N.drop_paragraphs(docs, pars).select("nodes.text").first()[0]
    assert cut == ["u" if i % 2 == 0 else f"t{i}\n\nu" for i in range(n)]
    assert time.time() - started < 60


def test_whole_configuration():
    from tessella.catalog.document_queries import CONFIGURATION, LISTS, PARAGRAPHS
    from tessella.plans.options import from_configuration

    checks = from_configuration(CONFIGURATION, **LISTS)
    assert checks.paragraphs == replace(PARAGRAPHS, language="ar")
    assert checks.documents == TextChecks(**LISTS) and checks.similarity is None
    values = {
        "cond_check_size_image": True,
        "original_width_min_cutoff": 100,
        "rendered_height_min_cutoff": 100,
        "aspect_ratio_max_cutoff": 3,
        "cond_check_number_images": False,
        "number_images_min_cutoff": 1,
        "cond_deduplicate_nodes_doc_level": True,
        "deduplication_max_cuttoff": 70,
        "cond_check_stopword_ratio_doc_level": True,
        "stopword_ratio_doc_level_min_cutoff": 0.4,
        "valid_formats": {"jpg"},
    }
    checks = from_configuration(values, language="en")
    assert checks.images == ImageChecks(check_size=True, min_side=100, max_aspect_ratio=3, formats=("jpg",))
    assert checks.similarity == 70 and checks.documents.min_stop_words == 0.4 and checks.documents.language == "en"
    for wrong in ({"no_such_name": 1}, {"original_width_min_cutoff": 1, "rendered_width_min_cutoff": 2}, {"cond_standardize_whitespace": False}):
        with pytest.raises(ValueError):
            from_configuration(wrong)
