"""Golden cases of the scalar functions, against plain Python where it has the rule built in."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessella import constants as C
from tessella.functions import metrics as M
from tessella.functions import text as T
from tessella.functions import urls as U
from tessella.functions.similarity import common_subsequence, later_similar, similarity_percent


@pytest.fixture(scope="module")
def apply(spark):
    def run(expression, values, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
        return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]

    return run


def test_urls(apply, spark):
    page = F.lit("https://h.org/d/p")
    got = apply(lambda v: U.absolutize(page, v), ["//c.org/i.png", "../i.png", "i.png", "http://x.org/./a", "/r"])
    assert got == ["http://c.org/i.png", "https://h.org/i.png", "https://h.org/i.png", "http://x.org/./a", "https://h.org/r"]
    assert apply(U.is_valid_url, ["http://a.org/x", "http://a b", "data:image/png", "HTTPS://A.org"]) == [
        True,
        False,
        False,
        True,
    ]
    assert apply(U.filename_text, ["h/Chocolate_Berry-Bark.jpg", "h/104x403.png", "h/it?ids=9", "a/b%20c1.x.png"]) == [
        "Chocolate Berry Bark",
        "",
        "",
        "b c",
    ]
    sizes = ["120", "120px;", "50%", "12.7", "auto", "abc", "”33”", " 7 "]
    assert apply(U.size_px, sizes) == [120, 120, None, 12, None, None, 33, 7]
    assert apply(U.size_pct, sizes) == [None, None, 50, None, 100, None, None, None]
    attrs = [{"src": "a,b.jpg", "data-src": "/c.jpg"}, {"src": "x y"}, {"src2": "z", "srcset": ""}]
    assert apply(U.image_source, attrs, "map<string,string>") == ["/c.jpg", None, "z"]
    assert apply(U.domain, ["http://u@H.org:8/p?q", "//x/y", "nothing", "https://a b|/c"]) == ["u@H.org:8", "x", "", "a b|"]


def test_words_match_stripping(apply):
    special = set(C.SPECIAL_CHARACTERS)
    pool = "aB٣é \n\t.,()-_'\U0001f600“ø1上كَ​\xa0"
    rng = random.Random(3)
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 40))) for _ in range(300)]

    def expected(text):
        out = []
        for piece in text.replace("\n", " ").replace("\t", " ").split(" "):
            piece = piece.lower()
            while piece and piece[0] in special:
                piece = piece[1:]
            while piece and piece[-1] in special:
                piece = piece[:-1]
            if piece:
                out.append(piece)
        return out

    assert apply(T.words, texts) == [expected(t) for t in texts]
    assert apply(T.words, ['"Hello, (World)! ..."']) == [["hello", "world"]]


def test_special_characters_hold_every_emoji_of_one_code_point():
    import regex

    missing = [
        p
        for p in range(0x2000, 0x20000)
        if regex.match(r"\p{Emoji_Presentation}", chr(p)) and chr(p) not in C.SPECIAL_CHARACTERS
    ]
    # Left out: the letters that flags are made of, and what Unicode added after version 15.
    newer = [0x1F6D8, 0x1F6D9, *range(0x1FA89, 0x1FA90), 0x1FABE, *range(0x1FAC6, 0x1FACE), *range(0x1FADC, 0x1FAE0)]
    newer += [*range(0x1FAE9, 0x1FAF0), 0x1FAF9, 0x1FAFA]
    assert set(missing) <= set(range(0x1F1E6, 0x1F200)) | set(newer)


def _char_repetition(text, n):
    counts = Counter(text[i : i + n] for i in range(len(text) - n + 1))
    if not counts:
        return 0
    values = sorted(counts.values(), reverse=True)
    k = min(int(len(values) ** 0.5), sum(v > 1 for v in values))
    return sum(values[:k]) / sum(values)


def test_repetition_ratios(apply):
    rng = random.Random(5)
    texts = ["abababab", "", "a", "\U0001f600b\U0001f600b\U0001f600"]
    texts += ["".join(rng.choice("ab\U0001f600\n") for _ in range(rng.randint(0, 60))) for _ in range(100)]
    for n in (2, 3):
        assert apply(lambda v: M.char_repetition_ratio(v, n), texts) == pytest.approx(
            [_char_repetition(t, n) for t in texts]
        )
    assert apply(lambda v: M.char_repetition_ratio(v, 2), ["abababab"]) == [pytest.approx(4 / 7)]
    assert apply(lambda v: M.word_repetition_ratio(T.words(v), 2), ["a b a b a", "a b c", "a", ""]) == [1.0, 0.0, 0.0, 0.0]


def test_other_metrics(apply):
    assert apply(lambda v: M.punctuation_ratio(v, 10), ["a b .", "", "a, " * 10]) == [1.0, 0.0, 0.5]
    assert apply(lambda v: M.punctuation_ratio(v), ["it's a b .", "كَتب؟"]) == [0.25, pytest.approx(1 / 3)]
    assert apply(M.special_char_ratio, ["ab1.", ""]) == [0.5, 0.0]
    assert apply(lambda v: M.listed_word_ratio(T.words(v), ["a", "two words"]), ["A, b two words", ""]) == [0.25, 0.0]
    assert apply(T.strip_diacritics, ["كَتَبَ"]) == ["كتب"]
    assert apply(T.normalize, [" «a»\x07٣2… ", "\n"]) == ['"a" 00...', ""]


def test_format_text(apply):
    raw = [" a\n b\t c ", "x#BR_TAG# y #BR_TAG#z", "", " "]
    assert apply(T.format_text, raw) == [" a b c ", "x\ny\nz", "", " "]


def test_similarity_against_brute_force():
    def table(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = row[:]
            for j, y in enumerate(b):
                row[j + 1] = last[j] + 1 if x == y else max(last[j + 1], row[j])
        return row[-1]

    rng = random.Random(1)
    texts = ["".join(rng.choice("abc ") for _ in range(rng.randint(0, 30))) for _ in range(60)]
    for a, b in zip(texts, reversed(texts)):
        assert common_subsequence(a, b) == table(a, b)
    assert similarity_percent("", "a") == 0 and similarity_percent("", "") == 100
    distinct = list(dict.fromkeys(texts))
    positions = rng.sample(range(1000), len(distinct))
    for threshold in (50, 70, 80):
        expected = {
            positions[j]
            for j in range(len(distinct))
            for i in range(len(distinct))
            if positions[i] < positions[j] and similarity_percent(distinct[i], distinct[j]) >= threshold
        }
        assert set(later_similar(distinct, positions, threshold)) == expected
