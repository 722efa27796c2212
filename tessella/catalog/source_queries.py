"""Pointers, records, archives, shards and single page functions."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella import constants as C
from tessella.catalog.registry import register
from tessella.catalog.views import CRAWL_POINTERS, IMAGES, crawl_pointers, images, table
from tessella.functions import text as T
from tessella.functions import urls as U
from tessella.sources import pointers as P
from tessella.sources import records, tables

POINTER_COLUMNS = ["url", "warc_filename", "warc_record_offset", "warc_record_length", "fetch_status"]


@register(
    "a1_select_pointers",
    f"""WITH {CRAWL_POINTERS} SELECT DISTINCT {", ".join(POINTER_COLUMNS)} FROM crawl_pointers
WHERE crawl = 'CC-1' AND subset = 'warc' AND content_languages LIKE '%ara%' AND fetch_status = 200""",
)
def select_pointers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.select_pointers(crawl_pointers(spark, sf_dir), "CC-1", "ara", POINTER_COLUMNS)


@register(
    "a2_batches",
    f"""WITH {CRAWL_POINTERS}, numbered AS (
  SELECT doc_id, url, row_number() OVER (ORDER BY doc_id) - 1 AS rn, count(*) OVER () AS n FROM crawl_pointers)
SELECT doc_id, url, CAST(floor((rn - 50) / 64) AS BIGINT) AS batch FROM numbered
WHERE rn >= 50 AND floor((rn - 50) / 64) >= 2""",
)
def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = crawl_pointers(spark, sf_dir).select("doc_id", "url")
    return P.pointer_batches(rows, "doc_id", 64, skip_rows=50, start_batch=2)


# The record of a page starts at its article and is as long as the page number says.
@register(
    "a3_slice_records",
    """WITH ranged AS (
  SELECT page_id, encode(html) AS content, 1 + page_id % 50 AS o, 200 + page_id % 700 AS n FROM pages)
SELECT page_id, CASE WHEN o + n <= octet_length(content) THEN hex(array_slice(content, o + 1, o + n)) ELSE '' END AS warc,
       CASE WHEN o + n <= octet_length(content) THEN '' ELSE 'short' END AS warc_error,
       o + n <= octet_length(content) AS download_success FROM ranged""",
)
def slice_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    name = F.concat(F.lit("page-"), F.col("page_id").cast("string")).alias("warc_filename")
    blobs = pages.select(name, F.encode("html", "UTF-8").alias("content"))
    wanted = pages.select(
        "page_id",
        name,
        (1 + F.col("page_id") % 50).alias("warc_record_offset"),
        (200 + F.col("page_id") % 700).alias("warc_record_length"),
    )
    sliced = records.slice_blobs(wanted, blobs)
    return sliced.select("page_id", F.hex("warc").alias("warc"), "warc_error", "download_success")


def page_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as archive records: a request record, then the response; some are broken."""
    body = F.encode("html", "UTF-8")
    head = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nServer: x\r\n\r\n")
    request = F.lit("WARC/1.0\r\nWARC-Type: request\r\nContent-Length: 14\r\n\r\nGET / HTTP/1.1\r\n\r\n")
    size = (F.length(body) + F.length(head)).cast("string")
    response = F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nContent-Length: "), size, F.lit("\r\n\r\n"))
    whole = F.concat(F.encode(request, "UTF-8"), F.encode(response, "UTF-8"), F.encode(head, "UTF-8"), body)
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.when(F.col("page_id") % 7 == 3, F.encode(request, "UTF-8")).otherwise(whole).alias("warc"),
        F.when(F.col("page_id") % 11 == 5, F.lit("timeout")).otherwise(F.lit("")).alias("warc_error"),
    )


_PAGES_FROM_WARC = """page_rows AS (
  SELECT page_id, CASE WHEN page_id % 11 = 5 OR page_id % 7 = 3 THEN '' ELSE html END AS html,
         CASE WHEN page_id % 11 = 5 THEN 'no WARC' WHEN page_id % 7 = 3 THEN 'No page or encoding' ELSE '' END
           AS html_error FROM pages)"""


@register("a4_warc_to_pages", f"WITH {_PAGES_FROM_WARC} SELECT page_id, html, html_error FROM page_rows")
def warc_to_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.warc_to_pages(page_records(spark, sf_dir)).drop("warc_error")


@register(
    "a5_resume",
    f"""WITH {CRAWL_POINTERS}
SELECT doc_id, CASE WHEN warc_error = '' AND doc_id % 2 = 0 THEN 'old' ELSE 'new' END AS run FROM crawl_pointers""",
)
def resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = crawl_pointers(spark, sf_dir)
    done = rows.filter(F.col("doc_id") % 2 == 0).select(
        "doc_id", F.encode("url", "UTF-8").alias("warc"), "warc_error", F.lit("old").alias("run")
    )

    def process(todo: DataFrame) -> DataFrame:
        return todo.select(
            "doc_id", F.encode("url", "UTF-8").alias("warc"), F.lit("").alias("warc_error"), F.lit("new").alias("run")
        )

    return P.resume(rows, done, ["doc_id"], "warc", "warc_error", process).select("doc_id", "run")


@register(
    "a6_success_rate",
    f"""WITH {CRAWL_POINTERS} SELECT warc_filename, count(*) AS n, count(CASE WHEN warc_error = '' THEN 1 END) AS n_ok,
  round(count(CASE WHEN warc_error = '' THEN 1 END) / count(*), 6) AS success_rate
FROM crawl_pointers GROUP BY warc_filename""",
)
def success_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.success_rate(crawl_pointers(spark, sf_dir), "warc_error", "warc_filename")


@register(
    "a7_volume",
    f"""WITH {CRAWL_POINTERS}, sums AS (
  SELECT crawl, content_languages, sum(warc_record_length) AS n_bytes FROM crawl_pointers GROUP BY ALL)
SELECT crawl, content_languages, n_bytes, CASE
  WHEN n_bytes < 1024 THEN printf('%.1f', n_bytes::DOUBLE) || CASE WHEN n_bytes = 1 THEN ' Bytes' ELSE ' Byte' END
  WHEN n_bytes < 1048576 THEN printf('%.2f KB', n_bytes / 1024) WHEN n_bytes < 1073741824
  THEN printf('%.2f MB', n_bytes / 1048576) ELSE printf('%.2f GB', n_bytes / 1073741824) END AS volume FROM sums""",
)
def volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.volume(crawl_pointers(spark, sf_dir), "warc_record_length", "crawl", "content_languages")


@register(
    "a8_images_from_members",
    f"""WITH {IMAGES}, members AS (
  SELECT 'https://i.example.org/' || CAST(width % 300 AS VARCHAR) AS url, 'shard-' || CAST(height % 7 AS VARCHAR) AS archive,
         CAST(1000000 + height * 1000 + width AS VARCHAR) || '-' || url AS stem, score > 0.1 AS ok, url AS content FROM images)
SELECT url, hex(encode(content)) AS image FROM members WHERE ok
QUALIFY row_number() OVER (PARTITION BY url ORDER BY archive DESC, stem DESC) = 1""",
)
def images_from_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = (1000000 + F.col("height") * 1000 + F.col("width")).cast("string")
    base = images(spark, sf_dir).select(
        F.concat(F.lit("shard-"), (F.col("height") % 7).cast("string")).alias("archive"),
        F.concat(number, F.lit("-"), "url").alias("stem"),
        F.to_json(
            F.struct(
                F.when(F.col("score") > 0.1, "success").otherwise("failed").alias("status"),
                F.concat(F.lit("https://i.example.org/"), (F.col("width") % 300).cast("string")).alias("url"),
            )
        ).alias("description"),
        F.col("url").alias("picture"),
    )
    members = base.select("archive", F.concat("stem", F.lit(".jpg")).alias("name"), F.encode("picture", "UTF-8").alias("content"))
    members = members.unionByName(
        base.select("archive", F.concat("stem", F.lit(".json")).alias("name"), F.encode("description", "UTF-8").alias("content"))
    )
    return tables.images_from_members(members).select("url", F.hex("image").alias("image"))


@register(
    "a9_concat",
    """SELECT doc_id, source FROM documents WHERE lang = 'en' UNION ALL SELECT doc_id, source FROM documents
WHERE lang <> 'en' UNION ALL SELECT doc_id, 'labels' FROM labels""",
)
def concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    english = F.col("lang") == "en"
    parts = [
        table(spark, sf_dir, "documents").filter(english).select(*docs.columns),
        table(spark, sf_dir, "documents").filter(~english).select(*docs.columns),
        table(spark, sf_dir, "labels").select("doc_id", F.lit("labels").alias("source")),
    ]
    return tables.concat(parts, expected=3)


@register(
    "a11_split_shards",
    """WITH numbered AS (
  SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS o, count(*) OVER () AS n FROM documents),
sized AS (SELECT *, CAST(ceil(n / 37.0) AS BIGINT) AS shards FROM numbered),
cut AS (SELECT *, n // shards AS small, n % shards AS large FROM sized),
placed AS (
  SELECT doc_id, CAST(CASE WHEN o < large * (small + 1) THEN o // (small + 1)
    ELSE large + (o - large * (small + 1)) // small END AS INTEGER) AS shard FROM cut)
SELECT doc_id, shard, CASE WHEN shard < 2 THEN 'valid' ELSE 'train' END AS split FROM placed""",
)
def split_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.with_shards(table(spark, sf_dir, "documents").select("doc_id"), 37)


# --- B: string rewrites of pages ------------------------------------------------------------


def _rewrite(name: str, expression, sql: str) -> None:
    @register(name, f"SELECT page_id, {sql} AS html FROM (SELECT page_id, replace(html, 'ou', chr(10) || chr(10) || '  ') AS html FROM pages)")
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        spaced = F.replace("html", F.lit("ou"), F.lit("\n\n  "))
        return table(spark, sf_dir, "pages").select("page_id", expression(spaced).alias("html"))


_rewrite("b1a_linebreaks", T.collapse_linebreaks, "regexp_replace(html, '\\n{2,}', chr(10), 'g')")
_rewrite("b1b_spaces", T.collapse_spaces, "regexp_replace(html, ' {2,}', ' ', 'g')")
_rewrite("b1c_comments", T.drop_comments, "regexp_replace(html, '(?s)<!--.*?-->', '', 'g')")
_rewrite("b1d_br", T.mark_line_breaks, f"regexp_replace(html, '<br ?/?>|</br>', '{C.LINE_BREAK_TOKEN}', 'g')")

# --- B: addresses and sizes made from the documents --------------------------------------------

_STEM = "lower(text)"
_RAW_SRC = f"""CASE doc_id % 8
  WHEN 0 THEN 'https://img.example.org/a_b-' || doc_id || '/' || source || '_logo-12x34.big.png'
  WHEN 1 THEN '//cdn.example.net/' || {_STEM} WHEN 2 THEN '../../pics/' || source || '%20x.gif'
  WHEN 3 THEN 'data:image/png;base64,' || source WHEN 4 THEN './' || {_STEM} || '.jpg'
  WHEN 5 THEN '/root/' || doc_id || '.webp?ids=' || doc_id WHEN 6 THEN 'https://bad host/' || source ELSE '' END"""
_SOURCES = f"""sources AS (
  SELECT doc_id, source, 'https://' || source || '.example.org:80/deep/page' AS page_url, {_RAW_SRC} AS raw FROM documents)"""


def raw_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        F.concat(F.lit("https://"), "source", F.lit(".example.org:80/deep/page")).alias("page_url"),
        F.expr(_RAW_SRC).alias("raw"),
    )


@register(
    "b12_media_src",
    f"""WITH {_SOURCES} SELECT doc_id, CASE
  WHEN raw <> '' AND NOT contains(raw, ',') AND NOT contains(raw, ' ') THEN raw
  WHEN doc_id % 3 = 0 THEN 'lazy/' || doc_id END AS src FROM sources""",
)
def media_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    lazy = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("lazy/"), F.col("doc_id").cast("string"))).otherwise("a, b")
    attrs = F.create_map(F.lit("src"), "raw", F.lit("alt"), "source", F.lit("data-lazy-src"), lazy)
    return raw_sources(spark, sf_dir).select("doc_id", U.image_source(attrs).alias("src"))


_ABSOLUTE = """CASE WHEN raw LIKE 'http%' THEN raw WHEN raw LIKE '//%' THEN 'http:' || raw
  ELSE 'https://' || source || '.example.org:80' ||
    CASE WHEN regexp_replace(raw, '\\.+/', '', 'g') LIKE '/%' THEN '' ELSE '/' END ||
    regexp_replace(raw, '\\.+/', '', 'g') END"""


@register("b13_absolutize", f"WITH {_SOURCES} SELECT doc_id, {_ABSOLUTE} AS src FROM sources")
def absolutize(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = U.absolutize(F.col("page_url"), F.col("raw"))
    return raw_sources(spark, sf_dir).select("doc_id", src.alias("src"))


@register(
    "b14_valid_url",
    f"""WITH {_SOURCES} SELECT doc_id, regexp_full_match({_ABSOLUTE},
  '(?i)(?:http|ftp)s?://(?:(?:[A-Z0-9](?:[A-Z0-9-]{{0,61}}[A-Z0-9])?\\.)+(?:[A-Z]{{2,6}}\\.?|[A-Z0-9-]{{2,}}\\.?))(?:/?|[/?]\\S+)')
  AS valid FROM sources""",
)
def valid_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = U.absolutize(F.col("page_url"), F.col("raw"))
    return raw_sources(spark, sf_dir).select("doc_id", U.is_valid_url(src).alias("valid"))


@register(
    "b15_filename_text",
    f"""WITH {_SOURCES}, stems AS (
  SELECT doc_id, string_split(list_last(string_split({_ABSOLUTE}, '/')), '.')[1] AS stem FROM sources),
spaced AS (
  SELECT doc_id, stem, trim(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
    regexp_replace(stem, '[_-]', ' ', 'g'), '%2[0]*', ' ', 'g'), '[0-9]+x[0-9]+', '', 'g'), '[0-9]+', ' ', 'g'),
    ' {{2,}}', ' ', 'g'), chr(10), ' '), '+', ' '), '%B', ' '), '%', ' ')) AS t FROM stems)
SELECT doc_id, CASE WHEN regexp_matches(stem, '\\?[A-Za-z0-9]+=') OR length(t) <= 1 THEN '' ELSE t END AS words
FROM spaced""",
)
def filename_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = U.absolutize(F.col("page_url"), F.col("raw"))
    return raw_sources(spark, sf_dir).select("doc_id", U.filename_text(src).alias("words"))


_SIZE = """CASE doc_id % 7 WHEN 0 THEN CAST(n_chars AS VARCHAR) WHEN 1 THEN CAST(n_chars AS VARCHAR) || 'px;'
  WHEN 2 THEN CAST(n_chars % 101 AS VARCHAR) || '%' WHEN 3 THEN CAST(n_chars AS VARCHAR) || '.75'
  WHEN 4 THEN 'auto' WHEN 5 THEN '"' || CAST(n_chars AS VARCHAR) || '"' ELSE source END"""


@register(
    "b16_parse_size",
    """SELECT doc_id, CASE WHEN doc_id % 7 IN (0, 1, 3, 5) THEN CAST(n_chars AS INTEGER) END AS px,
  CASE WHEN doc_id % 7 = 2 THEN CAST(n_chars % 101 AS INTEGER) WHEN doc_id % 7 = 4 THEN 100 END AS pct FROM documents""",
)
def parse_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = table(spark, sf_dir, "documents").select("doc_id", F.expr(_SIZE.replace("VARCHAR", "STRING")).alias("size"))
    return sized.select("doc_id", U.size_px(F.col("size")).alias("px"), U.size_pct(F.col("size")).alias("pct"))


_BREAKS = "replace(replace(replace(text, 'en', '#BR_TAG# '), chr(10), chr(10) || chr(9)), 'er', '  er')"


@register(
    "b20_format_text",
    f"""WITH flat AS (
  SELECT doc_id, regexp_replace(replace(replace({_BREAKS}, chr(10), ' '), chr(9), ' '), ' {{2,}}', ' ', 'g') AS t
  FROM documents)
SELECT doc_id, CASE WHEN t LIKE ' %' THEN ' ' ELSE '' END ||
  array_to_string(list_transform(string_split(t, '#BR_TAG#'), lambda x: trim(x)), chr(10)) ||
  CASE WHEN t LIKE '% ' AND length(t) > 1 THEN ' ' ELSE '' END AS text FROM flat""",
)
def format_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.format_text(F.expr(_BREAKS)).alias("text"))
