import random
from collections import Counter
from dataclasses import replace

import pyarrow as pa
import pytest

from tessella.functions import ngrams
from tessella.functions.similarity import common_subsequence
from tessella.operators import filters, models
from tessella.plans.options import PARAGRAPH_CHECKS

ALPHABETS = ["ab", "abé\U0001f600\n", "".join(map(chr, range(32, 3000))) + "\U0010ffff"]


def _texts(alphabet):
    rng = random.Random(3)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 120))) for _ in range(60)] + [None, "", "ab" * 400]


def _grams(items, n):
    return Counter(tuple(items[i : i + n]) for i in range(len(items) - n + 1))


@pytest.mark.parametrize("alphabet", ALPHABETS)
@pytest.mark.parametrize("piece", [40, 1 << 17])
def test_grams_are_counted_exactly(monkeypatch, alphabet, piece):
    monkeypatch.setattr(ngrams, "PIECE", piece)
    texts = _texts(alphabet)
    for n in (1, 3, 5, 40):
        for ratio, found, text in zip(
            ngrams.char_ratios(pa.array(texts), n).to_pylist(), ngrams.char_counts(pa.array(texts), n).to_pylist(), texts
        ):
            want = _grams(text or "", n)
            values = sorted(want.values(), reverse=True)
            k = min(int(len(values) ** 0.5), sum(v > 1 for v in values))
            assert ratio == (sum(values[:k]) / sum(values) if values else 0)
            if n <= 3:
                keys = {sum(ord(c) << (21 * (n - 1 - i)) for i, c in enumerate(gram)): c for gram, c in want.items()}
            else:
                keys = {"".join(gram).encode("utf-32-le"): c for gram, c in want.items()}
            assert {x["key"]: x["c"] for x in found} == keys
        words = [None if t is None else list(t) for t in texts]
        for ratio, text in zip(ngrams.word_ratios(pa.array(words, pa.list_(pa.string())), n).to_pylist(), texts):
            values = _grams(text or "", n).values()
            assert ratio == (sum(v for v in values if v > 1) / sum(values) if values else 0)


def test_paragraph_checks_count_grams_outside_lambdas(make_docs, bodies):
    """Counting n-grams with array functions took microseconds a character."""
    docs = make_docs([(1, "https://a.org/1", "w", ["ab " * 40 + "\n\na fine text of words", None, "@i"]), (2, "https://a.org/1", "w", [])])
    kept = filters.filter_paragraphs(docs, replace(PARAGRAPH_CHECKS.without_models(), max_char_repetition=0.2))
    assert bodies(kept) == {1: ["a fine text of words", "@i"], 2: []}
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_models_sum_counts_before_they_group(spark):
    texts = [(i, "a b c\nc d", "x") for i in range(50)] + [(50, None, "x"), (51, "", None), (52, "zz q", "y")]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string").coalesce(1)
    model = models.train_language_model(docs.filter("lang IS NOT NULL"), n=2)
    got = {r.doc_id: r.lang_pred for r in models.identify_language(docs, model, ["doc_id"]).collect()}
    assert len(got) == 53 and got[0] == "x" and got[52] == "y"
    bigrams = models.train_bigram_model(docs, min_count=2)
    scores = {r.doc_id: r.perplexity for r in models.perplexity(docs, bigrams, ["doc_id"]).collect()}
    assert len(scores) == 53 and scores[50] is None and scores[0] == scores[49] < scores[52]


def test_subsequence_by_shortcuts_and_bounds():
    """A text against itself without some letters took quadratic time."""
    rng = random.Random(2)
    long = "".join(rng.choice("abcdefghij \n") for _ in range(150_000))
    assert common_subsequence(long, long.replace("a", "")) == len(long.replace("a", ""))
    for _ in range(300):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(0, 90))) for _ in range(2))
        exact = common_subsequence(a, b)
        for least in (1, exact, exact + 1, 70):
            got = common_subsequence(a, b, least)
            assert got == exact if exact >= least else got < least
