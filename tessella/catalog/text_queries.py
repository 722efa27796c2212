"""Text functions and metrics over the whole texts of `documents`."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella import constants as C
from tessella.catalog import sql as S
from tessella.catalog.registry import register
from tessella.catalog.views import table
from tessella.functions import metrics as M
from tessella.functions import text as T
from tessella.functions import urls as U
from tessella.functions.similarity import similarity
from tessella.operators import models

STOP_WORDS = ["the", "of", "and", "to", "in", "de", "la", "le", "des", "que", "der", "die", "und", "el", "los"]
FLAGGED_WORDS = ["est", "sur", "nicht", "lorem", "two words"]
COMMON_WORDS = [*STOP_WORDS, "is", "by", "that", "for", "un", "une", "en", "sch", "auf"]

# Diacritics, odd blanks, marks, emoji, digits and control characters are put into the
# plain prose of the table, so that every rule has something to do.
DECORATION = [
    ("a ", "aَ "),
    ("e ", "e "),
    ("s ", "s​“ "),
    ("n ", "n\U0001f600 1٣ "),
    ("r ", "r\x07'— "),
    ("t ", "t…\t"),
]


def decorated_column(text: Column) -> Column:
    for old, new in DECORATION:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def decorated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", decorated_column(F.col("text")).alias("text"))


def _decorated_sql() -> str:
    text = "text"
    for old, new in DECORATION:
        text = f"replace({text}, {S.quoted(old)}, {S.quoted(new)})"
    return f"decorated AS (SELECT doc_id, {text} AS text FROM documents)"


DECORATED = _decorated_sql()


def _scalar(name: str, expression, sql: str, output: str = "text") -> None:
    """Register a Column -> Column function over the decorated texts."""

    @register(name, f"WITH {DECORATED} SELECT doc_id, {sql} AS {output} FROM decorated")
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return decorated(spark, sf_dir).select("doc_id", expression(F.col("text")).alias(output))


def _rounded(expression):
    return lambda text: F.round(expression(text), 6)


_NON_PRINTING = "".join(chr(p) for p in C.NON_PRINTING_CODE_POINTS if p)
_WORDS = S.words("text")
_BARE_WORDS = S.words(S.bare("text"))

_scalar("d1_diacritics", T.strip_diacritics, S.bare("text"))
_scalar(
    "d2_nonprinting",
    T.strip_nonprinting,
    f"translate(text, {S.quoted(_NON_PRINTING)}, {S.quoted(' ' * len(_NON_PRINTING))})",
)
_scalar(
    "d3_whitespace",
    T.standardize_whitespace,
    f"regexp_replace(text, '[{C.SPACE_LIKE}]', ' ', 'g')",
)
_scalar(
    "d4_split",
    lambda t: F.array_join(T.split_ws(t, newline=True, tab=True), "|"),
    "array_to_string(list_filter(string_split_regex(text, '[ \\n\\t]'), lambda x: x <> ''), '|')",
    "pieces",
)
_scalar("d5_words", lambda t: F.array_join(T.words(t), "|"), f"array_to_string({_WORDS}, '|')", "words")
_scalar("d6_num_words", T.num_words, f"len({_WORDS})", "n_words")
_scalar("d9_special", _rounded(M.special_char_ratio), f"round({S.special_ratio('text')}, 6)", "ratio")


def _lexicon(name: str, lexicon: list[str]) -> None:
    _scalar(
        name,
        _rounded(lambda t: M.listed_word_ratio(T.words(T.strip_diacritics(t)), lexicon)),
        f"round({S.listed_ratio(_BARE_WORDS, lexicon)}, 6)",
        "ratio",
    )


_lexicon("d10_stop", STOP_WORDS)
_lexicon("d11_flagged", FLAGGED_WORDS)
_lexicon("d12_common", COMMON_WORDS)
_scalar("d13_punct", _rounded(lambda t: M.punctuation_ratio(t, 10)), f"round({S.punctuation_ratio('text', 10)}, 6)", "ratio")
_scalar("d17_spam", _rounded(M.spam_word_ratio), f"round({S.listed_ratio(_WORDS, C.SPAM_WORDS)}, 6)", "ratio")


def _normalize_sql(text: str, keep_newlines: bool = False, lower: bool = True) -> str:
    chars = "".join(c for c in _NON_PRINTING if not (keep_newlines and c == "\n"))
    blanks = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0 "
    out = f"trim(translate({text}, {S.quoted(chars)}, {S.quoted(' ' * len(chars))}), {S.quoted(blanks)})"
    if lower:
        out = f"lower({out})"
    out = f"translate({out}, {S.quoted(C.SPACE_LIKE)}, {S.quoted(' ' * len(C.SPACE_LIKE))})"
    out = f"regexp_replace({out}, '\\p{{Nd}}', '0', 'g')"
    for mark, plain in C.UNICODE_PUNCTUATION.items():
        out = f"replace({out}, {S.quoted(mark)}, {S.quoted(plain)})"
    return out


_scalar("d14_normalize", lambda t: T.normalize(t, lower=True), _normalize_sql("text"))


@register(
    "d7_char_rep",
    f"""WITH {DECORATED}, bare AS (SELECT doc_id, {S.bare("text")} AS text FROM decorated),
{S.char_repetition("bare", "doc_id", "text")}
SELECT doc_id, round(coalesce(ratio, 0), 6) AS ratio FROM bare LEFT JOIN char_rep USING (doc_id)""",
)
def char_rep(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratio = M.char_repetition_ratio(T.strip_diacritics(F.col("text")))
    return decorated(spark, sf_dir).select("doc_id", F.round(ratio, 6).alias("ratio"))


@register(
    "d8_word_rep",
    f"""WITH {DECORATED}, worded AS (SELECT doc_id, {_WORDS} AS w FROM decorated),
{S.word_repetition("worded", "doc_id", "w")}
SELECT doc_id, round(coalesce(ratio, 0), 6) AS ratio FROM worded LEFT JOIN word_rep USING (doc_id)""",
)
def word_rep(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratio = M.word_repetition_ratio(T.words(F.col("text")))
    return decorated(spark, sf_dir).select("doc_id", F.round(ratio, 6).alias("ratio"))


@register(
    "d15_domain",
    "SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS domain FROM pages",
)
def domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", U.domain(F.col("url")).alias("domain"))


# A text against itself without one kind of letter: the common part is the shorter text.
_SHORT = "translate(text, 'aou', '')"


@register(
    "d16_similarity",
    f"""SELECT doc_id, CAST(CASE WHEN text = {_SHORT} THEN 100 WHEN length({_SHORT}) = 0 THEN 0
       ELSE round_even(100 * (2.0::DOUBLE * length({_SHORT}) / (length(text) + length({_SHORT}))), 0) END AS INTEGER)
       AS similarity FROM documents""",
)
def similarity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", similarity("text", F.translate("text", "aou", "")).alias("similarity"))


# --- Models ------------------------------------------------------------------------

LANGUAGE_FOLD = {"es": "fr"}
_K_LANG, _K_LM = 0.5, 0.1

LANGUAGE_SCORES = f"""
lang_texts AS (
  SELECT doc_id, CASE lang WHEN 'es' THEN 'fr' ELSE lang END AS lang,
         replace(lower(text), chr(10), ' ') AS t FROM documents),
{S.char_grams("lang_texts", "doc_id, lang", "t", 3, "lang_grams").strip()},
lang_facts AS (SELECT doc_id, lang, g, count(*) AS c FROM lang_grams GROUP BY ALL),
lang_counts AS (SELECT lang, g, sum(c) AS n FROM lang_facts GROUP BY ALL),
lang_bases AS (
  SELECT lang, CAST(round(ln({_K_LANG} / (sum(n) + {_K_LANG} *
    (SELECT count(DISTINCT g) FROM lang_counts))) * 1000000) AS BIGINT) AS base FROM lang_counts GROUP BY lang),
lang_weights AS (
  SELECT lang, g, CAST(round(ln((n + {_K_LANG}) / {_K_LANG}) * 1000000) AS BIGINT) AS w FROM lang_counts),
lang_hits AS (
  SELECT f.doc_id, m.lang, sum(f.c * m.w) AS hit FROM lang_facts f JOIN lang_weights m USING (g) GROUP BY ALL),
lang_scores AS (
  SELECT d.doc_id, b.lang, greatest(length(d.t) - 2, 0) * b.base + coalesce(h.hit, 0) AS s
  FROM lang_texts d CROSS JOIN lang_bases b LEFT JOIN lang_hits h ON h.doc_id = d.doc_id AND h.lang = b.lang),
lang_best AS (
  SELECT *, max(s) OVER (PARTITION BY doc_id) AS top,
         row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, lang) AS rk FROM lang_scores),
lang_result AS (
  SELECT doc_id, max(CASE WHEN rk = 1 THEN lang END) AS lang_pred,
         round(1 / sum(exp(CAST(s - top AS DOUBLE) / 1000000)), 6) AS lang_score
  FROM lang_best GROUP BY doc_id)"""


def language_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = models.train_language_model(docs, k=_K_LANG, fold=LANGUAGE_FOLD)
    return models.identify_language(docs, model, ["doc_id"])


@register("d18_lang_id", f"WITH {LANGUAGE_SCORES} SELECT * FROM lang_result")
def lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_table(spark, sf_dir)


@register(
    "e13_lang",
    f"""WITH {LANGUAGE_SCORES}
SELECT doc_id, lang_pred = 'fr' AND lang_score >= 0.85 AS keep FROM lang_result""",
)
def lang_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    keep = (F.col("lang_pred") == "fr") & (F.col("lang_score") >= 0.85)
    return language_table(spark, sf_dir).select("doc_id", keep.alias("keep"))


PERPLEXITY = f"""
lm_lines AS (
  SELECT doc_id, unnest(string_split({_normalize_sql("text", keep_newlines=True, lower=False)}, chr(10))) AS line
  FROM documents),
lm_tokens AS (
  SELECT doc_id, list_concat(['<s>'], list_concat(
    list_filter(string_split_regex(line, '[ \\t]+'), lambda w: w <> ''), ['</s>'])) AS t FROM lm_lines),
lm_bigrams AS (
  SELECT doc_id, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS b FROM lm_tokens),
lm_facts AS (
  SELECT doc_id, b, split_part(b, ' ', 1) AS a, count(*) AS c FROM lm_bigrams GROUP BY ALL),
lm_counts AS (SELECT b, a, sum(c) AS n FROM lm_facts GROUP BY ALL),
lm_v AS (SELECT count(DISTINCT split_part(b, ' ', 2)) AS v FROM lm_counts),
lm_two AS (
  SELECT b, CAST(round((log10(n + {_K_LM}) - log10({_K_LM})) * 1000000) AS BIGINT) AS w FROM lm_counts),
lm_one AS (
  SELECT a, CAST(round((log10({_K_LM} * (SELECT v FROM lm_v)) - log10(sum(n) + {_K_LM} * (SELECT v FROM lm_v)))
    * 1000000) AS BIGINT) AS w FROM lm_counts GROUP BY a),
lm_result AS (
  SELECT doc_id, round(pow(10.0, -CAST(sum(f.c * (two.w + one.w +
    CAST(round(-log10((SELECT v FROM lm_v)) * 1000000) AS BIGINT))) AS DOUBLE) / 1000000 / sum(f.c)), 1) AS perplexity
  FROM lm_facts f JOIN lm_two two USING (b) JOIN lm_one one USING (a) GROUP BY doc_id)"""


def perplexity_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = models.train_bigram_model(docs, k=_K_LM)
    return models.perplexity(docs, model, ["doc_id"])


@register("d19_perplexity", f"WITH {PERPLEXITY} SELECT * FROM lm_result")
def perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity_table(spark, sf_dir)


@register("e14_perplexity", f"WITH {PERPLEXITY} SELECT doc_id, perplexity <= 200 AS keep FROM lm_result")
def perplexity_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity_table(spark, sf_dir).select("doc_id", (F.col("perplexity") <= 200).alias("keep"))
