"""Checks, deduplication, clean-up and statistics over the derived web documents."""

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella import constants as C
from tessella.catalog import sql as S
from tessella.catalog.registry import register
from tessella.catalog.text_queries import COMMON_WORDS, FLAGGED_WORDS, STOP_WORDS
from tessella.catalog.views import (
    DOC_NODES,
    DOCS_WEB,
    IMAGES,
    KNOWN_IMAGES,
    MARKED_NODES,
    docs_web,
    images,
    known_images,
    table,
    web_docs,
)
from tessella.functions import metrics as M
from tessella.functions import text as T
from tessella.operators import cleanup, dedup, filters, profile
from tessella.operators import images as store
from tessella.operators.nodes import full_text, paragraph_table, render
from tessella.plans.options import DOCUMENT_CHECKS, PARAGRAPH_CHECKS, ImageChecks, from_configuration

# The lines of the driver documents are their paragraphs.
LINE = "\n"
LISTS = {"stop_words": tuple(STOP_WORDS), "flagged_words": tuple(FLAGGED_WORDS), "common_words": tuple(COMMON_WORDS)}
PARAGRAPHS = replace(PARAGRAPH_CHECKS.without_models(), **LISTS)
DOCUMENTS = replace(
    DOCUMENT_CHECKS.without_models(), max_char_repetition=0.25, max_word_repetition=0.3, min_stop_words=0.05, **LISTS
)
EOD = C.END_OF_DOCUMENT


def rendered(docs: DataFrame) -> DataFrame:
    """Documents as strings, so that order inside a document is compared too."""
    return docs.select("doc_id", F.size("nodes").alias("n_nodes"), render(F.col("nodes")).alias("body"))


def rendered_sql(nodes: str) -> str:
    """The same from a relation (doc_id, pos, text, src); documents without nodes give ''."""
    return f"""SELECT d.doc_id, count(n.pos) AS n_nodes,
       coalesce(string_agg(coalesce(n.text, '[' || n.src || ']'), chr(10) ORDER BY n.pos), '') AS body
FROM documents d LEFT JOIN {nodes} n USING (doc_id) GROUP BY d.doc_id"""


def only_present_sql(nodes: str) -> str:
    """As rendered_sql, for operators that drop whole documents."""
    return f"""SELECT doc_id, count(*) AS n_nodes,
       string_agg(coalesce(text, '[' || src || ']'), chr(10) ORDER BY pos) AS body
FROM {nodes} GROUP BY doc_id"""


# --- E: single checks ------------------------------------------------------------------

LINES = f"{DOC_NODES}, lines AS (SELECT doc_id, pos, text FROM doc_nodes WHERE kind = 'text')"
METRICS = S.metrics("lines", "doc_id, pos", STOP_WORDS, FLAGGED_WORDS, COMMON_WORDS, 10)


def _paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraph_table(web_docs(spark, sf_dir), separator=LINE).select(
        "doc_id", F.col("node").alias("pos"), F.col("paragraph").alias("text")
    )


def _check(name: str, keep, sql: str) -> None:
    @register(name, f"WITH {LINES}, worded AS (SELECT doc_id, pos, text FROM lines) SELECT doc_id, pos, {sql} AS keep FROM worded")
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _paragraphs(spark, sf_dir).select("doc_id", "pos", keep(F.col("text")).alias("keep"))


_check("e5_num_words", lambda t: T.num_words(t) >= 3, f"len({S.words('text')}) >= 3")
_check("e8_special", lambda t: M.special_char_ratio(t) <= 0.25, f"{S.special_ratio('text')} <= 0.25")
_check(
    "e9_stop",
    lambda t: M.listed_word_ratio(T.words(t), STOP_WORDS) >= 0.16,
    f"{S.listed_ratio(S.words('text'), STOP_WORDS)} >= 0.16",
)
_check(
    "e10_flagged",
    lambda t: M.listed_word_ratio(T.words(t), FLAGGED_WORDS) <= 0.01,
    f"{S.listed_ratio(S.words('text'), FLAGGED_WORDS)} <= 0.01",
)
_check("e11_punct", lambda t: M.punctuation_ratio(t, 10) >= 0.1, f"{S.punctuation_ratio('text', 10)} >= 0.1")
_check(
    "e12_common",
    lambda t: M.listed_word_ratio(T.words(t), COMMON_WORDS) >= 0.2,
    f"{S.listed_ratio(S.words('text'), COMMON_WORDS)} >= 0.2",
)


@register(
    "e6_char_rep",
    f"""WITH {LINES},{S.char_repetition("lines", "doc_id, pos", "text", 5)}
SELECT doc_id, pos, coalesce(ratio, 0) <= 0.2 AS keep FROM lines LEFT JOIN char_rep USING (doc_id, pos)""",
)
def char_rep_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratio = M.char_repetition_ratio(T.strip_diacritics(F.col("text")), 5)
    return _paragraphs(spark, sf_dir).select("doc_id", "pos", (ratio <= 0.2).alias("keep"))


@register(
    "e7_word_rep",
    f"""WITH {LINES}, worded AS (SELECT doc_id, pos, {S.words("text")} AS w FROM lines),
{S.word_repetition("worded", "doc_id, pos", "w", 2)}
SELECT doc_id, pos, coalesce(ratio, 0) <= 0.25 AS keep FROM lines LEFT JOIN word_rep USING (doc_id, pos)""",
)
def word_rep_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratio = M.word_repetition_ratio(T.words(F.col("text")), 2)
    return _paragraphs(spark, sf_dir).select("doc_id", "pos", (ratio <= 0.25).alias("keep"))


@register("e1_format", f"WITH {IMAGES} SELECT url, format IN ('jpg', 'jpeg', 'png', 'webp') AS keep FROM images")
def image_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    keep = filters.valid_format(F.col("format"), ImageChecks().formats)
    return images(spark, sf_dir).select("url", keep.alias("keep"))


@register(
    "e2_image_size",
    f"""WITH {IMAGES} SELECT url, width BETWEEN 150 AND 20000 AND height BETWEEN 150 AND 20000
      AND width / height BETWEEN 0.5 AND 2
      AND round_even(width * (height % 90) / 100.0, 0) BETWEEN 150 AND 20000 AS keep FROM images""",
)
def image_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    rendered_width = filters.rendered_size(F.col("width"), F.lit(None), (F.col("height") % 90).cast("int"))
    keep = filters.valid_size(F.col("width"), F.col("height"), rendered_width, F.lit(None), ImageChecks())
    return images(spark, sf_dir).select("url", keep.alias("keep"))


@register(
    "e3_percent_size",
    f"""WITH {IMAGES} SELECT url, CAST(round_even(width * (height % 101) / 100.0, 0) AS INTEGER) AS rendered_width
FROM images""",
)
def percent_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = filters.rendered_size(F.col("width"), F.lit(None), (F.col("height") % 101).cast("int"))
    return images(spark, sf_dir).select("url", size.alias("rendered_width"))


@register(
    "e4_num_images",
    f"""WITH {DOC_NODES}, per_doc AS (SELECT doc_id, count(src) AS n FROM doc_nodes GROUP BY doc_id)
SELECT doc_id, n FROM per_doc WHERE n BETWEEN 1 AND 10""",
)
def num_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = ImageChecks(min_images=1, max_images=10)
    none = replace(DOCUMENTS, min_words=None, max_char_repetition=None, max_word_repetition=None,
                   max_special_chars=None, min_stop_words=None, max_flagged_words=None)
    kept = filters.filter_documents(web_docs(spark, sf_dir), none, checks, LINE)
    return kept.select("doc_id", F.size(F.filter("nodes", lambda n: n["src"].isNotNull())).cast("bigint").alias("n"))


# --- E: filters ----------------------------------------------------------------------------

_PARAGRAPH_PASS = (
    "n_words >= 3 AND char_repetition <= 0.2 AND word_repetition <= 0.25 "
    "AND special_chars <= 0.25 AND flagged_words <= 0.01"
)


@register(
    "e15_filter_paragraphs",
    f"""WITH {MARKED_NODES}, lines AS (
  SELECT doc_id, pos, {S.clean("text")} AS text FROM doc_nodes WHERE kind = 'text'),{METRICS},
kept AS (
  SELECT doc_id, pos, text, NULL AS src FROM metrics WHERE text = '{EOD}' OR ({_PARAGRAPH_PASS})
  UNION ALL SELECT doc_id, pos, NULL, src FROM doc_nodes WHERE kind = 'image')
{rendered_sql("kept")}""",
)
def filter_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = web_docs(spark, sf_dir, markers=True)
    return rendered(filters.filter_paragraphs(docs, PARAGRAPHS, separator=LINE))


CONFIGURATION = {
    "cond_check_number_words_node_level": True,
    "number_words_node_level_min_cutoff": 3,
    "number_words_node_level_max_cutoff": "None",
    "cond_check_character_repetition_ratio_node_level": True,
    "character_repetition_length_node_level": 10,
    "character_repetition_node_level_max_cutoff": 0.2,
    "cond_check_word_repetition_ratio_node_level": True,
    "word_repetition_length_node_level": 4,
    "word_repetition_node_level_max_cutoff": 0.25,
    "cond_check_special_character_ratio_node_level": True,
    "special_character_ratio_node_level_max_cutoff": 0.25,
    "cond_check_stopword_ratio_node_level": False,
    "stopword_ratio_node_level_min_cutoff": 0.16,
    "cond_check_flagged_word_ratio_node_level": True,
    "flagged_word_ratio_node_level_max_cutoff": 0.01,
    "min_number_words_to_check_punctuation_ratio_node_level": 10,
    "cond_check_lang_id_node_level": False,
    "lang_id_node_level_min_cutoff": 0.5,
}


@register(
    "a12_configured_filter",
    f"""WITH {MARKED_NODES}, lines AS (
  SELECT doc_id, pos, {S.clean("text")} AS text FROM doc_nodes WHERE kind = 'text'),{METRICS},
kept AS (
  SELECT doc_id, pos, text, NULL AS src FROM metrics WHERE text = '{EOD}' OR ({_PARAGRAPH_PASS})
  UNION ALL SELECT doc_id, pos, NULL, src FROM doc_nodes WHERE kind = 'image')
{rendered_sql("kept")}""",
)
def configured_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = from_configuration(CONFIGURATION, **LISTS)
    return rendered(filters.filter_paragraphs(web_docs(spark, sf_dir, markers=True), checks.paragraphs, checks.images, LINE))


@register(
    "e15b_filter_with_images",
    f"""WITH {IMAGES}, lines AS (
  SELECT doc_id, pos, {S.clean("text")} AS text FROM doc_nodes WHERE kind = 'text'),{METRICS},
kept AS (
  SELECT doc_id, pos, text, NULL AS src FROM metrics WHERE {_PARAGRAPH_PASS}
  UNION ALL SELECT n.doc_id, n.pos, NULL, n.src FROM doc_nodes n JOIN images i ON n.src = i.url
  WHERE i.format IN ('jpg', 'jpeg', 'png', 'webp') AND i.width BETWEEN 150 AND 20000 AND i.height BETWEEN 150 AND 20000
    AND i.width / i.height BETWEEN 0.5 AND 2)
{rendered_sql("kept")}""",
)
def filter_with_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images carry their size and format, so that they are checked with the texts."""
    facts = images(spark, sf_dir).select("url", F.struct("width", "height", "format").alias("facts"))
    docs = store.attach_images(web_docs(spark, sf_dir), facts, "facts")
    none = F.lit(None).cast("int")
    meta = F.struct(*[none.alias(f"rendered_{s}_{u}") for s in ("width", "height") for u in ("px", "pct")])

    def with_facts(n):
        sized = {k: n["facts"][k] for k in ("width", "height", "format")}
        return F.struct(n["kind"].alias("kind"), n["text"].alias("text"), n["src"].alias("src"), meta.alias("meta"), *[v.alias(k) for k, v in sized.items()])

    docs = docs.withColumn("nodes", F.transform("nodes", with_facts))
    return rendered(filters.filter_paragraphs(docs, PARAGRAPHS, ImageChecks(check_format=True, check_size=True), LINE))


_JOINED = f"""{DOC_NODES}, joined AS (
  SELECT d.doc_id, coalesce(string_agg(n.text, chr(10) ORDER BY n.pos), '') AS text
  FROM documents d LEFT JOIN doc_nodes n ON n.doc_id = d.doc_id AND n.text <> '' GROUP BY d.doc_id)"""
_DOC_METRICS = S.metrics("joined", "doc_id", STOP_WORDS, FLAGGED_WORDS, COMMON_WORDS, -1)
_DOC_VERDICT = """verdict AS (
  SELECT doc_id, text, CASE
    WHEN n_words < 8 THEN 'number_words' WHEN char_repetition > 0.25 THEN 'character_repetition'
    WHEN word_repetition > 0.3 THEN 'word_repetition' WHEN special_chars > 0.23 THEN 'special_characters'
    WHEN stop_words < 0.05 THEN 'stop_words' WHEN flagged_words > 0.01 THEN 'flagged_words' END AS failed_check
  FROM metrics)"""


@register(
    "e16_filter_documents",
    f"""WITH {_JOINED},{_DOC_METRICS},{_DOC_VERDICT} SELECT doc_id, text FROM verdict WHERE failed_check IS NULL""",
)
def filter_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = filters.filter_documents(web_docs(spark, sf_dir), DOCUMENTS, separator=LINE)
    return kept.select("doc_id", full_text(F.col("nodes"), LINE).alias("text"))


@register(
    "e17_audit",
    f"""WITH {_JOINED},{_DOC_METRICS},{_DOC_VERDICT}
SELECT failed_check, count(*) AS n_docs FROM verdict GROUP BY failed_check""",
)
def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.audit_counts(filters.audit(web_docs(spark, sf_dir), DOCUMENTS, separator=LINE))


@register(
    "e18_text_and_image",
    f"""WITH {DOC_NODES}, kept AS (
  SELECT doc_id FROM doc_nodes GROUP BY doc_id
  HAVING count(CASE WHEN text <> '' THEN 1 END) > 0 AND count(src) > 0)
SELECT doc_id FROM kept""",
)
def text_and_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web_docs(spark, sf_dir).filter(cleanup.has_text_and_image(F.col("nodes"))).select("doc_id")


@register(
    "e19_marker_only",
    f"""WITH {MARKED_NODES}
SELECT doc_id FROM doc_nodes GROUP BY doc_id
HAVING count(CASE WHEN text <> '' AND trim(text) <> '{EOD}' THEN 1 END) > 0""",
)
def marker_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = web_docs(spark, sf_dir, markers=True)
    return docs.filter(~cleanup.is_marker_only(F.col("nodes"))).select("doc_id")


_UNSAFE = "unsafe AS (SELECT url FROM images WHERE score > 0.85)"


def _unsafe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.unsafe_urls(images(spark, sf_dir), {"score": 0.85})


@register("e21_unsafe_urls", f"WITH {IMAGES}, {_UNSAFE} SELECT url FROM unsafe")
def unsafe_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unsafe(spark, sf_dir)


@register(
    "e20_unsafe_docs",
    f"""WITH {IMAGES}, {_UNSAFE}, kept AS (
  SELECT * FROM doc_nodes WHERE doc_id NOT IN (
    SELECT doc_id FROM doc_nodes WHERE src IN (SELECT url FROM unsafe)))
{only_present_sql("kept")}""",
)
def unsafe_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendered(filters.drop_unsafe_image_docs(web_docs(spark, sf_dir), _unsafe(spark, sf_dir)))


@register(
    "e22_remove_listed",
    f"""WITH {IMAGES}, {_UNSAFE}, kept AS (
  SELECT * FROM doc_nodes WHERE src IS NULL OR src NOT IN (SELECT url FROM unsafe))
{rendered_sql("kept")}""",
)
def remove_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendered(filters.remove_listed_images(web_docs(spark, sf_dir), _unsafe(spark, sf_dir)))


# --- F ---------------------------------------------------------------------------------------

_IMAGE_COUNTS = "image_counts AS (SELECT src, count(*) AS n FROM doc_nodes WHERE src IS NOT NULL GROUP BY src)"


@register("f1_frequent_images", f"WITH {DOC_NODES}, {_IMAGE_COUNTS} SELECT src, n FROM image_counts WHERE n > 10")
def frequent_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.frequent_images(web_docs(spark, sf_dir))


@register(
    "f2_dedup_images",
    f"""WITH {DOC_NODES}, {_IMAGE_COUNTS}, kept AS (
  SELECT * FROM doc_nodes WHERE src IS NULL OR src NOT IN (SELECT src FROM image_counts WHERE n > 10))
{rendered_sql("kept")}""",
)
def dedup_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendered(dedup.dedup_frequent_images(web_docs(spark, sf_dir)))


# Some documents have no URL, some no file name.
_HOLES = """holed AS (
  SELECT doc_id, text, CASE WHEN doc_id % 17 <> 3 THEN url END AS url,
         CASE WHEN doc_id % 19 <> 4 AND doc_id % 40 <> 0 THEN warc_filename END AS warc_filename FROM docs_web)"""


def _holed(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    return docs_web(spark, sf_dir).select(
        "doc_id",
        "text",
        F.when(i % 17 != 3, F.col("url")).alias("url"),
        F.when((i % 19 != 4) & (i % 40 != 0), F.col("warc_filename")).alias("warc_filename"),
    )


@register(
    "f3_dedup_url",
    f"""WITH {DOCS_WEB}, {_HOLES} SELECT doc_id, url, warc_filename, text FROM holed
QUALIFY url IS NULL OR warc_filename IS NOT DISTINCT FROM max(warc_filename) OVER (PARTITION BY url)""",
)
def dedup_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.dedup_by_url(_holed(spark, sf_dir)).select("doc_id", "url", "warc_filename", "text")


@register(
    "f3b_dedup_url_strict",
    f"""WITH {DOCS_WEB}, {_HOLES} SELECT doc_id, url, warc_filename, text FROM holed
QUALIFY url IS NULL OR row_number() OVER (PARTITION BY url ORDER BY warc_filename DESC NULLS LAST, doc_id DESC) = 1""",
)
def dedup_url_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _holed(spark, sf_dir)
    return dedup.dedup_by_url(docs, strict=True).select("doc_id", "url", "warc_filename", "text")


def _stats_sql(counts: str, groups: str) -> str:
    return f"""SELECT sum(n) AS n_docs, count(CASE WHEN n > 1 THEN 1 END) AS {groups},
       sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS n_docs_in_groups,
       sum(CASE WHEN n > 1 THEN n - 1 ELSE 0 END) AS n_removable FROM ({counts})"""


@register(
    "f4_url_stats",
    f"WITH {DOCS_WEB} {_stats_sql('SELECT url, count(*) AS n FROM docs_web GROUP BY url', 'n_repeated_urls')}",
)
def url_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.url_dup_stats(docs_web(spark, sf_dir))


def _paragraph_dedup_sql(min_count: int, emptied: str) -> str:
    return f"""WITH {MARKED_NODES}, repeated AS (
  SELECT domain, text FROM doc_nodes WHERE kind = 'text' AND NOT contains(text, '{EOD}')
  GROUP BY domain, text HAVING count(*) >= {min_count}),
kept AS ({emptied})
{rendered_sql("kept")}"""


_EMPTIED = """
  SELECT n.doc_id, n.pos, CASE WHEN r.text IS NOT NULL THEN '' ELSE n.text END AS text, n.src
  FROM doc_nodes n LEFT JOIN repeated r ON n.domain = r.domain AND n.text = r.text"""


@register("f5_dedup_paragraphs", _paragraph_dedup_sql(3, _EMPTIED))
def dedup_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = web_docs(spark, sf_dir, markers=True)
    return rendered(dedup.dedup_paragraphs_by_domain(docs, separator=LINE))


@register("f5b_dedup_paragraphs_strict", _paragraph_dedup_sql(2, _EMPTIED + " WHERE r.text IS NULL AND (n.text <> '' OR n.text IS NULL)"))
def dedup_paragraphs_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = web_docs(spark, sf_dir, markers=True)
    return rendered(dedup.dedup_paragraphs_by_domain(docs, 2, drop_empty=True, separator=LINE))


# Similarity of whole documents to an earlier line has no SQL; see the tests for brute force.
@register("f6_similar_nodes")
def similar_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendered(dedup.dedup_similar_nodes(web_docs(spark, sf_dir)))


_SIGNATURES = """signatures AS (
  SELECT doc_id, warc_filename, string_agg(DISTINCT src, '|' ORDER BY src) AS sig
  FROM doc_nodes WHERE src IS NOT NULL GROUP BY doc_id, warc_filename)"""


@register(
    "f7_dedup_image_set",
    f"""WITH {DOC_NODES}, {_SIGNATURES}, losers AS (
  SELECT doc_id FROM signatures
  QUALIFY row_number() OVER (PARTITION BY sig ORDER BY warc_filename DESC, doc_id DESC) > 1),
kept AS (SELECT * FROM doc_nodes WHERE doc_id NOT IN (SELECT doc_id FROM losers))
{only_present_sql("kept")}""",
)
def dedup_image_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendered(dedup.dedup_by_image_set(web_docs(spark, sf_dir)))


@register(
    "f8_image_set_stats",
    f"""WITH {DOC_NODES}, {_SIGNATURES}
{_stats_sql('SELECT sig, count(*) AS n FROM signatures GROUP BY sig', 'n_repeated_sets')}""",
)
def image_set_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.image_set_stats(web_docs(spark, sf_dir))


_FIRST_IMAGES = """first_images AS (
  SELECT * FROM doc_nodes
  QUALIFY src IS NULL OR row_number() OVER (PARTITION BY doc_id, src ORDER BY pos) = 1)"""


@register("f9_images_in_doc", f"WITH {DOC_NODES}, {_FIRST_IMAGES} {rendered_sql('first_images')}")
def images_in_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = web_docs(spark, sf_dir)
    return rendered(docs.withColumn("nodes", dedup.dedup_images_in_doc(F.col("nodes"))))


# --- G -----------------------------------------------------------------------------------------


def merged_sql(source: str, name: str, separator: str = "chr(10)") -> str:
    """Texts between two images of `source` fused, empty ones dropped."""
    return f"""{name}_filled AS (SELECT * FROM {source} WHERE src IS NOT NULL OR text <> ''),
{name}_islands AS (
  SELECT *, count(src) OVER (PARTITION BY doc_id ORDER BY pos) AS island FROM {name}_filled),
{name} AS (
  SELECT doc_id, min(pos) AS pos, string_agg(text, {separator} ORDER BY pos) AS text, src
  FROM {name}_islands GROUP BY doc_id, island, src)"""


@register("g1_merge_texts", f"WITH {DOC_NODES}, {merged_sql('doc_nodes', 'merged')} {rendered_sql('merged')}")
def merge_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = web_docs(spark, sf_dir)
    return rendered(docs.withColumn("nodes", cleanup.merge_adjacent_texts(F.col("nodes"), LINE)))


# Boilerplate words are put into the prose for the spam rules.
SPAM_DECORATION = [("le ", "like "), ("of ", "share "), ("der ", "Cookies, ")]


def spammed(docs: DataFrame) -> DataFrame:
    def change(n):
        text = n["text"]
        for old, new in SPAM_DECORATION:
            text = F.replace(text, F.lit(old), F.lit(new))
        return n.withField("text", text)

    return docs.withColumn("nodes", F.transform("nodes", change))


def _spammed_sql() -> str:
    text = "text"
    for old, new in SPAM_DECORATION:
        text = f"replace({text}, '{old}', '{new}')"
    return f"spammed AS (SELECT doc_id, pos, {text} AS text, src FROM doc_nodes)"


_NO_SPAM = f"""no_spam AS (
  SELECT doc_id, pos, src,
         CASE WHEN src IS NULL AND {S.listed_ratio(S.words("text"), C.SPAM_WORDS)} >= 0.12 THEN '' ELSE text END AS text
  FROM %s)"""


@register("g2_spam", f"WITH {DOC_NODES}, {_spammed_sql()}, {_NO_SPAM % 'spammed'} {rendered_sql('no_spam')}")
def spam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spammed(web_docs(spark, sf_dir))
    return rendered(docs.withColumn("nodes", cleanup.drop_spam_paragraphs(F.col("nodes"), separator=LINE)))


def _doubled_sql(source: str, name: str) -> str:
    """Lines of the merged texts of `source`, with consecutive markers reduced to one."""
    return f"""{name}_lines AS (
  SELECT doc_id, pos, src, generate_subscripts(string_split(text, chr(10)), 1) AS k,
         unnest(string_split(text, chr(10))) AS line FROM {source} WHERE text IS NOT NULL),
{name}_kept AS (
  SELECT * FROM {name}_lines
  QUALIFY NOT (trim(line) = '{EOD}' AND
    coalesce(trim(lag(line) OVER (PARTITION BY doc_id, pos ORDER BY k)) = '{EOD}', false))),
{name} AS (
  SELECT doc_id, pos, string_agg(line, chr(10) ORDER BY k) AS text, NULL AS src FROM {name}_kept GROUP BY doc_id, pos
  UNION ALL SELECT doc_id, pos, NULL, src FROM {source} WHERE src IS NOT NULL)"""


# Runs of markers are put between the texts.
def more_markers(docs: DataFrame) -> DataFrame:
    def with_markers(n, i):
        marker = n.withField("text", F.lit(EOD))
        near = n["text"].isNotNull() & ((i + F.col("doc_id")) % 11 > 4)
        return F.when(near, F.array(n, marker, marker)).otherwise(F.array(n))

    return docs.withColumn("nodes", F.flatten(F.transform("nodes", with_markers)))


_MORE_MARKERS = f"""more_markers AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY node_no, part) - 1 AS pos, src, text FROM (
    SELECT doc_id, pos AS node_no, 0 AS part, src, text FROM doc_nodes
    UNION ALL
    SELECT doc_id, pos, part, NULL, '{EOD}' FROM doc_nodes, (VALUES (1), (2)) v(part)
    WHERE src IS NULL AND (pos + doc_id) % 11 > 4))"""


def _merged_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = more_markers(web_docs(spark, sf_dir))
    return docs.withColumn("nodes", cleanup.merge_adjacent_texts(F.col("nodes"), LINE))


@register(
    "g3_collapse",
    f"""WITH {DOC_NODES}, {_MORE_MARKERS}, {merged_sql("more_markers", "merged")}, {_doubled_sql("merged", "collapsed")}
{rendered_sql("collapsed")}""",
)
def collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _merged_markers(spark, sf_dir)
    return rendered(docs.withColumn("nodes", cleanup.collapse_markers(F.col("nodes"), LINE)))


def _trailing_sql(source: str, name: str) -> str:
    cut = len(EOD) + 1
    return f"""{name} AS (
  SELECT doc_id, pos, src, CASE
    WHEN pos < max(pos) OVER (PARTITION BY doc_id) THEN text WHEN text = '{EOD}' THEN ''
    WHEN ends_with(text, chr(10) || '{EOD}') THEN left(text, length(text) - {cut}) ELSE text END AS text
  FROM {source})"""


@register(
    "g4_trailing",
    f"""WITH {DOC_NODES}, {_MORE_MARKERS}, {merged_sql("more_markers", "merged")}, {_trailing_sql("merged", "cut")}
{rendered_sql("cut")}""",
)
def trailing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _merged_markers(spark, sf_dir)
    return rendered(docs.withColumn("nodes", cleanup.drop_trailing_marker(F.col("nodes"), LINE)))


_HAS_BOTH = """complete AS (
  SELECT * FROM {source} WHERE doc_id IN (
    SELECT doc_id FROM {source} GROUP BY doc_id HAVING count(CASE WHEN text <> '' THEN 1 END) > 0 AND count(src) > 0
    {extra}))"""


@register(
    "g5_final_processing",
    f"""WITH {DOC_NODES}, {_MORE_MARKERS},
spammed AS (SELECT doc_id, pos, replace(text, 'of ', 'share ') AS text, src FROM more_markers),
first_images AS (
  SELECT * FROM spammed QUALIFY src IS NULL OR row_number() OVER (PARTITION BY doc_id, src ORDER BY pos) = 1),
{_NO_SPAM % 'first_images'}, {merged_sql("no_spam", "m1")}, {_doubled_sql("m1", "m2")}, {_trailing_sql("m2", "m3")},
{merged_sql("m3", "m4")},
{_HAS_BOTH.format(source="m4", extra=f"AND count(CASE WHEN text <> '' AND trim(text) <> '{EOD}' THEN 1 END) > 0")}
{only_present_sql("complete")}""",
)
def final_processing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = more_markers(web_docs(spark, sf_dir))
    spam_like = F.transform(
        "nodes", lambda n: n.withField("text", F.replace(n["text"], F.lit("of "), F.lit("share ")))
    )
    return rendered(cleanup.final_processing(docs.withColumn("nodes", spam_like), LINE))


@register(
    "g6_final_cleaning",
    f"""WITH {DOC_NODES}, {merged_sql("doc_nodes", "merged")}, {_HAS_BOTH.format(source="merged", extra="")}
{only_present_sql("complete")}""",
)
def final_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendered(cleanup.final_cleaning(web_docs(spark, sf_dir), LINE))


# --- H -------------------------------------------------------------------------------------------


@register("h1_url_counts", f"WITH {DOC_NODES}, {_IMAGE_COUNTS} SELECT src, n FROM image_counts")
def url_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.image_url_counts(web_docs(spark, sf_dir))


_STAGE = """SELECT '{name}' AS stage, count(DISTINCT doc_id) AS n_docs, count(src) AS n_images,
  count(CASE WHEN text <> '' THEN 1 END) AS n_texts,
  count(CASE WHEN text IS NULL AND src IS NULL THEN 1 END) AS n_rejected FROM {source}"""


@register(
    "h2_stage_report",
    f"""WITH {DOC_NODES}, {_FIRST_IMAGES}, {merged_sql("first_images", "merged")},
{_HAS_BOTH.format(source="merged", extra="")}
{_STAGE.format(name="input", source="doc_nodes")} UNION ALL {_STAGE.format(name="images", source="first_images")}
UNION ALL {_STAGE.format(name="cleaned", source="complete")}""",
)
def stage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = web_docs(spark, sf_dir)
    unique = docs.withColumn("nodes", dedup.dedup_images_in_doc(F.col("nodes")))
    return profile.stage_report({"input": docs, "images": unique, "cleaned": cleanup.final_cleaning(unique, LINE)})


_PROFILE_COLUMNS = ", ".join(
    f"round({m}, 2) AS {m}"
    for m in ("char_repetition", "word_repetition", "special_chars", "stop_words", "flagged_words", "punctuation", "common_words")
)


@register(
    "h3_profile",
    f"WITH {_JOINED},{_DOC_METRICS} SELECT doc_id, n_words, {_PROFILE_COLUMNS} FROM metrics",
)
def metric_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.metric_profile(web_docs(spark, sf_dir), replace(DOCUMENTS, punctuation_min_words=-1), separator=LINE)


@register(
    "h4_histogram",
    f"""WITH {LINES}, valued AS (SELECT round({S.special_ratio("text")}, 2) AS v FROM lines),
numbered AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS o, count(*) OVER () AS t FROM valued),
kept AS (SELECT v FROM numbered WHERE o >= floor(t * 0.05) AND o < floor(t * 0.95)),
ends AS (SELECT min(v) AS lo, max(v) AS hi FROM kept),
binned AS (
  SELECT CASE WHEN hi > lo THEN least(floor((v - lo) / ((hi - lo) / 20.0)), 19) ELSE 0 END AS b, lo, hi FROM kept, ends)
SELECT CAST(b AS INTEGER) AS bin, round(lo + b * ((hi - lo) / 20.0), 6) AS bin_start, count(*) AS n
FROM binned GROUP BY ALL""",
)
def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = _paragraphs(spark, sf_dir).select(F.round(M.special_char_ratio(F.col("text")), 2).alias("v"))
    return profile.trimmed_histogram(values, "v")


@register("h5_top_scores", f"WITH {IMAGES} SELECT url, score FROM images ORDER BY score DESC, url LIMIT 50")
def top_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.top_by_score(images(spark, sf_dir).select("url", "score"), "score", 50, "url")


@register("h6_sample", "SELECT doc_id, text FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 50")
def sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.sample_docs(table(spark, sf_dir, "documents").select("doc_id", "text"), 50, seed=42)


@register(
    "h7_domains",
    f"""WITH {DOC_NODES} SELECT domain, count(DISTINCT doc_id) AS n_docs, min(doc_id) AS first_doc_id,
  max(doc_id) AS last_doc_id, count(src) AS n_images, count(CASE WHEN text <> '' THEN 1 END) AS n_texts
FROM doc_nodes GROUP BY domain""",
)
def domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.domain_counts(web_docs(spark, sf_dir))


@register("h7b_domain_positions", f"WITH {DOCS_WEB} SELECT domain, doc_id FROM docs_web")
def domain_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.domain_positions(docs_web(spark, sf_dir))


@register("h3b_paragraph_profile", f"WITH {LINES},{METRICS} SELECT doc_id, pos AS node, n_words, {_PROFILE_COLUMNS} FROM metrics")
def paragraph_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = replace(PARAGRAPHS, char_repetition_length=10, word_repetition_length=4)
    return profile.metric_profile(web_docs(spark, sf_dir), checks, "paragraph", LINE).drop("par")


@register(
    "h3c_image_profile",
    f"WITH {IMAGES} SELECT url, width, height, round(width / height, 2) AS aspect_ratio FROM images",
)
def image_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.image_profile(images(spark, sf_dir))


# --- C and the document sinks -----------------------------------------------------------------------


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return known_images(spark, sf_dir).select("url", F.col("width").alias("image"))


def attached(docs: DataFrame) -> DataFrame:
    body = F.array_join(
        F.transform("nodes", lambda n: F.coalesce(n["text"], F.coalesce(n["image"].cast("string"), F.lit("?")))), "\n"
    )
    return docs.select("doc_id", body.alias("body"), "num_found", "num_not_found")


def attached_sql(relation: str) -> str:
    """From (doc_id, pos, text, src, image)."""
    return f"""SELECT doc_id, string_agg(coalesce(text, CAST(image AS VARCHAR), '?'), chr(10) ORDER BY pos) AS body,
  count(image) AS num_found, count(src) - count(image) AS num_not_found FROM {relation} GROUP BY doc_id"""


@register(
    "c1_attach_images",
    f"""WITH {KNOWN_IMAGES}, found AS (
  SELECT n.*, i.width AS image FROM doc_nodes n LEFT JOIN known_images i ON n.src = i.url) {attached_sql("found")}""",
)
def attach_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attached(store.attach_images(web_docs(spark, sf_dir), _payloads(spark, sf_dir)))


@register(
    "c2_attach_missing",
    f"""WITH {KNOWN_IMAGES}, found AS (
  SELECT n.*, coalesce(CASE WHEN i.width % 2 = 0 THEN i.width END, i.height) AS image
  FROM doc_nodes n LEFT JOIN known_images i ON n.src = i.url) {attached_sql("found")}""",
)
def attach_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = _payloads(spark, sf_dir).filter(F.col("image") % 2 == 0)
    second = known_images(spark, sf_dir).select("url", F.col("height").alias("image"))
    docs = store.attach_images(web_docs(spark, sf_dir), first)
    return attached(store.attach_images(docs, second))


@register(
    "c3_ban_words",
    f"""WITH {KNOWN_IMAGES}, found AS (
  SELECT n.*, i.width AS image FROM doc_nodes n LEFT JOIN known_images i
    ON n.src = i.url AND NOT contains(n.src, 'hot') AND NOT contains(n.src, '11')) {attached_sql("found")}""",
)
def ban_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = web_docs(spark, sf_dir)
    return attached(store.attach_images(docs, _payloads(spark, sf_dir), banned_words=["hot", "11"]))


@register(
    "c4_merge_images",
    f"""WITH {IMAGES} SELECT url, CASE WHEN height % 3 = 0 THEN height + 1 ELSE width END AS image,
  CASE WHEN height % 3 = 0 THEN 2 ELSE 1 END AS place FROM images WHERE width % 2 = 0 OR height % 3 = 0""",
)
def merge_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = images(spark, sf_dir)
    first = base.filter(F.col("width") % 2 == 0).select("url", F.col("width").alias("image"), F.lit(1).alias("place"))
    second = base.filter(F.col("height") % 3 == 0).select("url", F.col("height").alias("image"), F.lit(1).alias("place"))
    # The second store has every address twice; the later entry counts.
    again = second.select("url", (F.col("image") + 1).alias("image"), F.lit(2).alias("place"))
    return store.merge_image_sets(first, again.unionByName(second), "place")


@register(
    "c5_restrict_store",
    f"""WITH {IMAGES}, {_IMAGE_COUNTS}
SELECT url, width, height, score, format FROM images
WHERE url IN (SELECT src FROM image_counts WHERE n > 1) AND url NOT IN (SELECT url FROM images WHERE score > 0.85)""",
)
def restrict_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    keep = dedup.frequent_images(web_docs(spark, sf_dir), 1).withColumnRenamed("src", "url")
    return store.restrict_image_store(images(spark, sf_dir), keep, _unsafe(spark, sf_dir))


@register("b23_image_urls", f"WITH {DOC_NODES} SELECT DISTINCT src AS url FROM doc_nodes WHERE src IS NOT NULL")
def image_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.distinct_image_urls(web_docs(spark, sf_dir))


@register("a13_url_list", f"WITH {DOC_NODES} SELECT DISTINCT src AS value FROM doc_nodes WHERE src IS NOT NULL")
def url_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.distinct_image_urls(web_docs(spark, sf_dir)).select(F.col("url").alias("value"))


@register(
    "a14_docs_as_urls",
    f"""WITH {DOC_NODES}
SELECT doc_id, string_agg(coalesce(src, '-'), ' ' ORDER BY pos) AS images, count(text) AS n_texts
FROM doc_nodes GROUP BY doc_id""",
)
def docs_as_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    published = store.published_documents(web_docs(spark, sf_dir))
    return published.select(
        "doc_id",
        F.array_join("images", " ", "-").alias("images"),
        F.size(F.filter("texts", lambda t: t.isNotNull())).alias("n_texts"),
    )

