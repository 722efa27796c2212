import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessella import constants as C
from tessella.functions import ngrams
from tessella.functions import text as T
from tessella.operators import models
from tessella.plans import flows
from tessella.plans.options import TextChecks

ROWS = [
    (1, "the cat sat on the mat\nthe end", "en"),
    (2, "die Katze sitzt dort, straße", "de"),
    (3, "", "en"),
    (4, None, "de"),
    (5, "zz", "de"),
    (5, "the cat", "en"),
    (None, "on the mat", None),
    (6, "\U0001f600\U0001f601\U0001f602!", "fr"),
    (7, "qqqq xxxx", None),
]


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _counts(text, n):
    flat = (text or "").lower().replace("\n", " ")
    return Counter(flat[i : i + n] for i in range(len(flat) - n + 1))


@pytest.mark.parametrize("n", [2, 3, 4])
@pytest.mark.parametrize("parts", [1, 9])
def test_a_piece_asks_once_for_a_gram(spark, n, parts):
    """Every gram of every text was a row that was shuffled to the model."""
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string").repartition(parts)
    model = models.train_language_model(docs.filter("doc_id < 7 AND text != 'zz'"), n=n)
    found = models.identify_language(docs, model, ["doc_id"])
    assert "Generate" not in _plan(found)
    profiles = {lang: Counter() for lang in model.languages}
    for doc_id, text, lang in ROWS:
        if doc_id and doc_id < 7 and text not in (None, "zz"):
            profiles[lang] += _counts(text, n)
    want = {}
    for doc_id in {r[0] for r in ROWS}:
        grams = sum((_counts(t, n) for i, t, _ in ROWS if i == doc_id), Counter())
        costs = []
        for lang, base in zip(model.languages, model.bases):
            weights = sum(c * round(math.log((profiles[lang][g] + 0.5) / 0.5) * 1_000_000) for g, c in grams.items())
            costs.append((-(sum(grams.values()) * base + weights), lang))
        costs.sort()
        want[doc_id] = (costs[0][1], round(1 / sum(math.exp((costs[0][0] - x) / 1e6) for x, _ in costs), 6))
    assert {r.doc_id: (r.lang_pred, pytest.approx(r.lang_score, abs=2e-6)) for r in found.collect()} == want


def test_pieces_may_span_batches_and_hold_nothing():
    texts, piece = pa.array(["abc", None, "abd", "ab", "", "xabc"]), pa.array([7, 7, 7, 7, 8, 9])
    batch = pa.RecordBatch.from_arrays([piece, texts], names=["_piece", "_text"])
    asked = [b.to_pydict() for b in ngrams.piece_keys(4 - 1)(iter([batch.slice(0, 2), batch.slice(2)]))]
    key = lambda s: sum(ord(c) << (21 * (2 - i)) for i, c in enumerate(s))
    assert [sorted(b["key"]) for b in asked] == [sorted(map(key, k)) for k in (["abc", "abd"], [], ["xab", "abc"])]
    assert [set(b["_piece"]) for b in asked] == [{7}, set(), {9}]
    known = pa.table({"key": pa.array([key("abc")]), "w0": pa.array([5]), "w1": pa.array([None], pa.int64())})
    rows = pa.table({"id": pa.array(np.arange(6)), "_text": texts})
    sums = ngrams.piece_sums(3, ["id"], ["w0", "w1"])
    assert sums(rows, known).to_pydict() == {"id": [0, 1, 2, 3, 4, 5], "m": [1, 0, 1, 0, 0, 2], "w0": [5, 0, 0, 0, 0, 5], "w1": [0] * 6}
    assert sums(rows, known.slice(0, 0))["w0"].to_pylist() == [0] * 6
    assert sums(rows.slice(0, 0), known).num_rows == 0


def test_stored_bigrams_are_summed_before_contexts_are_looked_up(spark):
    """Every bigram of every text was shuffled a second time, for the contexts of the few that are not stored."""
    docs = spark.createDataFrame([(1, "a b a b c"), (2, "a x\n\na b"), (3, None), (4, "")], "doc_id long, text string")
    model = models.train_bigram_model(docs, min_count=2)
    found = models.perplexity(docs, model, ["doc_id"])
    assert _plan(found).count("Aggregate") >= 2
    counts = Counter(g for _, t in docs.collect() if t is not None for g in ngrams.line_bigrams(t))
    v, contexts = len({b for _, b in counts}), Counter()
    for (a, _), c in counts.items():
        contexts[a] += c
    unit = lambda x: round(x * 1_000_000)
    base = unit(-math.log10(v))
    for r in found.collect():
        text = dict(docs.collect())[r.doc_id]
        grams = Counter(ngrams.line_bigrams(text)) if text is not None else {}
        score = sum(
            c * (base + unit(math.log10(0.1 * v) - math.log10(contexts[g[0]] + 0.1 * v)) + (counts[g] >= 2) * unit(math.log10(counts[g] + 0.1) + 1))
            for g, c in grams.items()
        )
        assert r.perplexity == (pytest.approx(10 ** (-score / 1e6 / sum(grams.values())), abs=0.11) if grams else None)


def test_perplexities_are_made_only_of_texts_in_the_language(spark, monkeypatch):
    """Texts that had failed the language check were looked up in the bigram model too."""
    docs = spark.createDataFrame([(1, "the cat sat", "en"), (2, "die katze dort", "de"), (3, "zz zz the", "en"), (4, None, None)], "doc_id long, text string, lang string")
    known = docs.filter("doc_id < 3")
    trained = flows.Models(models.train_language_model(known), models.train_bigram_model(known))
    checks = TextChecks(language="en", min_language_score=0.4, max_perplexity=8.0)
    asked = []
    monkeypatch.setattr(flows, "perplexity", lambda texts, *a: asked.append({r.doc_id for r in texts.collect()}) or models.perplexity(texts, *a))
    failed = flows.failed_by_models(docs, ["doc_id"], "text", checks, trained)
    languages = {r.doc_id: (r.lang_pred, r.lang_score) for r in models.identify_language(docs, trained.language, ["doc_id"]).collect()}
    wrong = {i for i, (lang, score) in languages.items() if lang != "en" or score < 0.4}
    high = {r.doc_id for r in models.perplexity(docs, trained.perplexity, ["doc_id"]).collect() if (r.perplexity or 0) > 8}
    assert 2 in wrong and 1 not in wrong and asked == [{1, 2, 3, 4} - wrong]
    assert {r.doc_id for r in failed.collect()} == wrong | high


def test_clean_up_of_texts_with_and_without_more_than_ascii(spark):
    texts = ["plain", " \x85a\x1cb ", "\u3000a\ufffcb\u3000", "\ufffca", "a\tb\nc\x07", "\u201cx\u201d\x84", "a\n", None, "", "\u2028x\xa0"]
    plain = lambda t: F.translate(t, C.SPACE_LIKE, " " * len(C.SPACE_LIKE))
    t = F.col("t")
    df = spark.createDataFrame([(x,) for x in texts], "t string")
    for keep in (True, False):
        pairs = df.select(
            F.array(T.strip_blanks(t), T.standardize_whitespace(t), T.clean_text(t, keep)).alias("got"),
            F.array(
                F.regexp_replace(t, f"^{T.BLANK_CLASS}+|{T.BLANK_CLASS}+$", ""), plain(t), plain(T.strip_nonprinting(t, keep))
            ).alias("want"),
        )
        assert all(r.got == r.want for r in pairs.collect())
    assert df.select(T.normalize(t)).collect()[5][0] == '"x"'
