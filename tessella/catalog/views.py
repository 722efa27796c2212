"""Relations derived from the driver tables, in Spark and as SQL for the comparison.

Every relation covers all rows of its base table.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.constants import END_OF_DOCUMENT


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def docs_web(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a URL (every fifth shared), a domain and an archive file name."""
    key = F.when(F.col("doc_id") % 5 == 0, F.col("doc_id") % 40).otherwise(F.col("doc_id"))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        "text",
        "lang",
        "n_chars",
        F.concat(F.lit("https://"), "source", F.lit(".example.org/p/"), key.cast("string")).alias("url"),
        F.concat("source", F.lit(".example.org")).alias("domain"),
        F.concat(
            F.lit("crawl-"), F.lpad(((F.col("doc_id") * 37) % 1000).cast("string"), 4, "0"), F.lit(".warc.gz")
        ).alias("warc_filename"),
    )


def _image_address(pos: Column) -> Column:
    hot = F.concat(F.lit("hot"), (pos % 10).cast("string"))
    cold = (F.col("doc_id") * 13 + pos * 7).cast("string")
    return F.concat(
        F.lit("https://img.example.org/"), F.when(F.col("doc_id") % 4 == 0, hot).otherwise(cold), F.lit(".jpg")
    )


def web_docs(spark: SparkSession, sf_dir: str, markers: bool = False) -> DataFrame:
    """Interleaved documents: a text for every line, and an image after about every fourth one.

    With `markers` an end-of-document marker follows some lines. No line is left out or changed.
    """

    def node(kind: str, text: Column, src: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), text.alias("text"), src.alias("src"))

    def nodes(line: Column, pos: Column) -> Column:
        none = F.lit(None).cast("string")
        parts = [node("text", line, none)]
        if markers:
            marker = node("text", F.lit(END_OF_DOCUMENT), none)
            parts.append(F.when((pos + F.col("doc_id")) % 11 == 5, marker))
        parts.append(F.when((pos + F.col("doc_id")) % 4 == 3, node("image", none, _image_address(pos))))
        return F.filter(F.array(*parts), lambda n: n.isNotNull())

    return docs_web(spark, sf_dir).select(
        "doc_id",
        "lang",
        "url",
        "domain",
        "warc_filename",
        F.flatten(F.transform(F.split("text", "\n"), nodes)).alias("nodes"),
    )


def _number_in(url: Column) -> Column:
    return F.regexp_extract(url, "([0-9]+)", 1).cast("bigint")


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image store: sizes, a format and a score for every address."""
    srcs = (
        web_docs(spark, sf_dir)
        .select(F.explode(F.filter("nodes.src", lambda s: s.isNotNull())).alias("url"))
        .distinct()
    )
    n = _number_in(F.col("url"))
    return srcs.select(
        "url",
        (100 + (n * 7) % 900).alias("width"),
        (100 + (n * 11) % 700).alias("height"),
        F.round(((n * 31) % 100) / 100.0, 2).alias("score"),
        F.element_at(F.array(*map(F.lit, ["jpg", "png", "gif", "webp", "svg"])), (n % 5 + 1).cast("int")).alias(
            "format"
        ),
    )


def known_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store in which some addresses are missing, for the operators that look images up."""
    return images(spark, sf_dir).filter(~F.col("url").like("%7.jpg"))


def crawl_pointers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs_web(spark, sf_dir).select(
        "doc_id",
        "url",
        "warc_filename",
        F.concat(F.lit("CC-"), (F.col("doc_id") % 3).cast("string")).alias("crawl"),
        F.lit("warc").alias("subset"),
        F.when(F.col("lang") == "fr", F.lit("fra,ara")).otherwise(F.col("lang")).alias("content_languages"),
        F.when(F.col("doc_id") % 9 == 0, 404).otherwise(200).alias("fetch_status"),
        (F.col("doc_id") * 1000).alias("warc_record_offset"),
        F.col("n_chars").alias("warc_record_length"),
        F.when(F.col("doc_id") % 13 == 0, F.lit("timeout")).otherwise(F.lit("")).alias("warc_error"),
    )


# --- The same relations as SQL (DuckDB) --------------------------------------

DOCS_WEB = """
docs_web AS (
  SELECT doc_id, text, lang, n_chars,
         'https://' || source || '.example.org/p/' ||
           CAST(CASE WHEN doc_id % 5 = 0 THEN doc_id % 40 ELSE doc_id END AS VARCHAR) AS url,
         source || '.example.org' AS domain,
         'crawl-' || lpad(CAST((doc_id * 37) % 1000 AS VARCHAR), 4, '0') || '.warc.gz' AS warc_filename
  FROM documents)"""

DOC_LINES = (
    DOCS_WEB
    + """,
doc_lines AS (
  SELECT doc_id, lang, url, domain, warc_filename,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos,
         unnest(string_split(text, chr(10))) AS line
  FROM docs_web)"""
)

_NODES = (
    DOC_LINES
    + """,
doc_nodes AS (
  SELECT doc_id, lang, url, domain, warc_filename,
         row_number() OVER (PARTITION BY doc_id ORDER BY line_no, part) - 1 AS pos, kind, text, src
  FROM (
    SELECT *, pos AS line_no, 0 AS part, 'text' AS kind, line AS text, NULL AS src FROM doc_lines{markers}
    UNION ALL
    SELECT *, pos, 2, 'image', NULL, 'https://img.example.org/' ||
           CASE WHEN doc_id % 4 = 0 THEN 'hot' || CAST(pos % 10 AS VARCHAR)
                ELSE CAST(doc_id * 13 + pos * 7 AS VARCHAR) END || '.jpg'
    FROM doc_lines WHERE (pos + doc_id) % 4 = 3))"""
)
DOC_NODES = _NODES.format(markers="")
MARKED_NODES = _NODES.format(
    markers=f"""
    UNION ALL
    SELECT *, pos, 1, 'text', '{END_OF_DOCUMENT}', NULL FROM doc_lines WHERE (pos + doc_id) % 11 = 5"""
)

IMAGES = (
    DOC_NODES
    + """,
images AS (
  SELECT src AS url,
         100 + (CAST(regexp_extract(src, '([0-9]+)', 1) AS BIGINT) * 7) % 900 AS width,
         100 + (CAST(regexp_extract(src, '([0-9]+)', 1) AS BIGINT) * 11) % 700 AS height,
         round(((CAST(regexp_extract(src, '([0-9]+)', 1) AS BIGINT) * 31) % 100) / 100.0, 2) AS score,
         ['jpg', 'png', 'gif', 'webp', 'svg'][CAST(regexp_extract(src, '([0-9]+)', 1) AS BIGINT) % 5 + 1] AS format
  FROM (SELECT DISTINCT src FROM doc_nodes WHERE src IS NOT NULL) t)"""
)
KNOWN_IMAGES = IMAGES + ", known_images AS (SELECT * FROM images WHERE url NOT LIKE '%7.jpg')"

CRAWL_POINTERS = (
    DOCS_WEB
    + """,
crawl_pointers AS (
  SELECT doc_id, url, warc_filename, 'CC-' || CAST(doc_id % 3 AS VARCHAR) AS crawl, 'warc' AS subset,
         CASE lang WHEN 'fr' THEN 'fra,ara' ELSE lang END AS content_languages,
         CASE WHEN doc_id % 9 = 0 THEN 404 ELSE 200 END AS fetch_status,
         doc_id * 1000 AS warc_record_offset, n_chars AS warc_record_length,
         CASE WHEN doc_id % 13 = 0 THEN 'timeout' ELSE '' END AS warc_error
  FROM docs_web)"""
)
