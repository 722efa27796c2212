"""Page operators, over `pages` and over pages written from the lines of `documents`."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella import constants as C
from tessella.catalog import sql as S
from tessella.catalog.registry import register
from tessella.catalog.views import DOC_LINES, DOCS_WEB, docs_web, table
from tessella.functions.arrays import let
from tessella.functions.text import collapse_spaces, where_found
from tessella.operators import html as H
from tessella.sources.dom import build_dom_nodes, dom_nodes

EOD = C.END_OF_DOCUMENT

# How line `pos` of document `doc_id` is written into its page, by (pos + doc_id) % 12.
# {L} is the escaped line, {I} the image name.
FRAGMENTS = [
    "<p>{L}</p>",
    "<div><div>{L}</div></div>",
    '<img src="https://img.example.org/{I}.jpg" alt="picture {I}" width="120px;" height="50%"><p>{L}</p>',
    '<div class="x footer"><p>{L}</p></div>',
    "<ul><li>{L}</li></ul>",
    '<div id="menu">{L}</div>',
    '<div class="post-date">{L}<p>{L}</p></div>',
    "<b>{L}</b> ",
    '<figure><img data-src="../pics/{I}.png"><figcaption>{L}</figcaption></figure>',
    '<div class="more-link"><a href="#">{L}</a></div>',
    "<p>  </p><div></div><p>{L}</p>",
    "<section>{L}<br/>{L}</section>",
]
# Tags that each fragment gives.
TAGS = [
    ["p", "-text"],
    ["div", "div", "-text"],
    ["img", "p", "-text"],
    ["div", "p", "-text"],
    ["ul", "li", "-text"],
    ["div", "-text"],
    ["div", "-text", "p", "-text"],
    ["b", "-text", "-text"],
    ["figure", "img", "figcaption", "-text"],
    ["div", "a", "-text"],
    ["p", "-text", "div", "p", "-text"],
    ["section", "-text"],
]
FRAME = ["html", "head", "title", "-text", "body"]


def _line(text: Column) -> Column:
    flat = F.trim(where_found(text, "  ", collapse_spaces))
    return let(flat, lambda t: F.when(t == "", F.lit("blank")).otherwise(t))


def _escaped(text: Column) -> Column:
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text


def written_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, url, warc_filename, html)."""

    def fragment(line: Column, pos: Column) -> Column:
        k = (pos + F.col("doc_id")) % len(FRAGMENTS)
        template = F.get(F.array(*map(F.lit, FRAGMENTS)), k.cast("int"))
        image = F.concat(F.col("doc_id").cast("string"), F.lit("_"), pos.cast("string"))
        return F.replace(F.replace(template, F.lit("{L}"), _escaped(_line(line))), F.lit("{I}"), image)

    body = F.array_join(F.transform(F.split("text", "\n"), fragment), "")
    html = F.concat(F.lit("<html><head><title>t</title></head><body>"), body, F.lit("</body></html>"))
    return docs_web(spark, sf_dir).select("doc_id", "url", "warc_filename", html.alias("html"))


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = written_pages(spark, sf_dir)
    return build_dom_nodes(pages.withColumn("html", H.clean_html(F.col("html"))))


_LINES = f"""{DOC_LINES}, frag AS (
  SELECT doc_id, url, pos, (pos + doc_id) % 12 AS k, doc_id || '_' || pos AS img,
         coalesce(nullif(trim(regexp_replace(line, ' {{2,}}', ' ', 'g')), ''), 'blank') AS line FROM doc_lines)"""


def _tag_counts_sql(tags: list[list[str]], frame: list[str], more: str = "") -> str:
    cases = " ".join(f"WHEN {k} THEN {_list(t)}" for k, t in enumerate(tags))
    return f"""WITH {_LINES}, tagged AS (
  SELECT doc_id, unnest(CASE k {cases} END) AS tag FROM frag
  UNION ALL SELECT doc_id, unnest({_list(frame)}) FROM documents{more})
SELECT doc_id, tag, count(*) AS n FROM tagged GROUP BY ALL"""


def _list(values: list[str]) -> str:
    return "[" + ", ".join(map(S.quoted, values)) + "]::VARCHAR[]"


def _tag_counts(pages_nodes: DataFrame) -> DataFrame:
    return dom_nodes(pages_nodes).groupBy("doc_id", "tag").agg(F.count(F.lit(1)).alias("n"))


def _changed(changes: dict[int, list[str]]) -> list[list[str]]:
    return [changes.get(k, tags) for k, tags in enumerate(TAGS)]


def _tree_step(name: str, step, tags: list[list[str]], frame: list[str] = FRAME, more: str = "", whole=None) -> None:
    """A step on the node arrays, or `whole`, a step on the table of pages."""

    @register(name, _tag_counts_sql(tags, frame, more))
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        if whole is not None:
            return _tag_counts(whole(parsed(spark, sf_dir)))
        return _tag_counts(parsed(spark, sf_dir).withColumn("nodes", step(F.col("nodes"))))


_tree_step("b2_dom_nodes", lambda n: n, TAGS)
_tree_step("b3_drop_matching", H.drop_matching, _changed({3: []}))
_tree_step("b4_replace_matching", H.replace_matching, _changed({9: ["-text"]}))
_tree_step("b5_unwrap", H.unwrap_inline, _changed({7: ["-text", "-text"], 9: ["div", "-text"]}))
_tree_step(
    "b6_strip",
    lambda n: H.strip_uninteresting(H.unwrap_inline(n)),
    _changed({4: ["ul"], 7: ["-text", "-text"], 9: ["div", "-text"]}),
    ["html", "body"],
)
_tree_step("b7_special_divs", H.strip_special_divs, _changed({5: []}))
_tree_step("b8_dates", H.drop_date_text, _changed({6: ["div", "p", "-text"]}))
# The body itself goes when there is nothing in it.
_tree_step(
    "b9_empty_leaves",
    None,
    _changed({10: ["p", "-text"]}),
    ["html", "head", "title", "-text"],
    " UNION ALL SELECT DISTINCT doc_id, 'body' FROM frag",
    whole=H.drop_empty_nodes,
)
_tree_step("b10_unnest", H.unnest_same_tag, _changed({1: ["div", "-text"]}))
_tree_step(
    "b11_remerge",
    lambda n: H.remerge_text(H.unwrap_inline(n)),
    _changed({7: ["-text"], 9: ["div", "-text"]}),
)


# --- Media ------------------------------------------------------------------------------

_IMAGE_SRC = """CASE k WHEN 2 THEN 'https://img.example.org/' || img || '.jpg'
  ELSE regexp_extract(url, '^https://[^/]*') || '/pics/' || img || '.png' END"""


def _leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.extract_leaves(H.simplify(parsed(spark, sf_dir)))


def _image_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leaves(spark, sf_dir).select("doc_id", F.explode(F.filter("nodes", lambda n: n["kind"] == "image")).alias("n"))


@register(
    "b17_media_record",
    f"""WITH {_LINES} SELECT doc_id, url AS document_url, {_IMAGE_SRC} AS src,
  CASE k WHEN 8 THEN '../pics/' || img || '.png' ELSE {_IMAGE_SRC} END AS unformatted_src,
  CASE k WHEN 2 THEN 'picture ' || img END AS alt_text, CASE k WHEN 2 THEN 120 END AS rendered_width_px,
  CASE k WHEN 2 THEN 50 END AS rendered_height_pct FROM frag WHERE k IN (2, 8)""",
)
def media_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["document_url", "src", "unformatted_src", "alt_text", "rendered_width_px", "rendered_height_pct"]
    return _image_rows(spark, sf_dir).select("doc_id", *[F.col(f"n.meta.{c}").alias(c) for c in columns])


# A video with its own size, one that takes the address of its first source, and an audio.
_FILMS = (
    '<video width="640" height="360" src="../v/{I}.mp4"></video>'
    '<video><source src=""><source src="https://v.example.org/{I}.webm"></video>'
    '<audio src="//a.example.net/{I}.mp3"></audio><audio></audio>{L}'
)


@register(
    "b17b_video_audio",
    f"""WITH {DOCS_WEB}, hosts AS (SELECT doc_id, url, regexp_extract(url, '^https://[^/]*') AS host FROM docs_web)
SELECT doc_id, 'video' AS tag, url AS document_url, host || '/v/' || doc_id || '.mp4' AS src, '640' AS width, '360' AS height
FROM hosts UNION ALL
SELECT doc_id, 'video', url, 'https://v.example.org/' || doc_id || '.webm', NULL, NULL FROM hosts UNION ALL
SELECT doc_id, 'audio', url, 'http://a.example.net/' || doc_id || '.mp3', NULL, NULL FROM hosts""",
)
def video_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.replace(F.replace(F.lit(_FILMS), F.lit("{L}"), _escaped(F.col("text"))), F.lit("{I}"), F.col("doc_id").cast("string"))
    pages = docs_web(spark, sf_dir).select("doc_id", "url", html.alias("html"))
    nodes = build_dom_nodes(pages).withColumn("inner", H.inner_sources(F.col("nodes")))
    nodes = nodes.select("doc_id", "url", F.explode(F.arrays_zip("nodes", "inner")).alias("x")).select("doc_id", "url", "x.*")
    record = H.media_record(F.col("nodes"), F.col("url"), F.col("inner"))
    found = nodes.filter(F.col("nodes.tag").isin("video", "audio")).select("doc_id", record.alias("r")).filter("r IS NOT NULL")
    return found.select("doc_id", *[F.col(f"r.{c}").alias(c) for c in ("tag", "document_url", "src", "width", "height")])


@register(
    "b18_caption",
    f"""WITH {_LINES} SELECT doc_id, {_IMAGE_SRC} AS src, CASE k WHEN 8 THEN line ELSE 'picture ' || img END AS caption
FROM frag WHERE k IN (2, 8)""",
)
def caption(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _image_rows(spark, sf_dir).select("doc_id", "n.src", "n.caption")


@register(
    "b19_keep_nodes",
    f"""WITH {_LINES} SELECT d.doc_id, count(CASE WHEN k IN (0, 1, 2, 6, 7, 8, 9, 10, 11) THEN 1 END) AS n_texts,
  count(CASE WHEN k IN (2, 8) THEN 1 END) AS n_images FROM documents d LEFT JOIN frag USING (doc_id) GROUP BY d.doc_id""",
)
def keep_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    def count(kind: str) -> Column:
        return F.size(F.filter("nodes", lambda n: n["kind"] == kind))

    return _leaves(spark, sf_dir).select("doc_id", count("text").alias("n_texts"), count("image").alias("n_images"))


# --- Documents ------------------------------------------------------------------------------

# Leaves in page order; s is what the tags of a leaf put between it and its neighbours,
# and blanks at its ends count as 1.
_MERGED = f"""{_LINES}, leaves AS (
  SELECT doc_id, pos, 0 AS sub, {_IMAGE_SRC} AS src, NULL AS text, k, NULL AS s FROM frag WHERE k IN (2, 8)
  UNION ALL
  SELECT doc_id, pos, 1, NULL, CASE k WHEN 9 THEN '{EOD}' WHEN 11 THEN line || chr(10) || line ELSE line END, k,
         CASE k WHEN 0 THEN 3 WHEN 2 THEN 3 WHEN 6 THEN 3 WHEN 10 THEN 3 WHEN 7 THEN 0 WHEN 9 THEN 0 ELSE 2 END
  FROM frag WHERE k IN (0, 1, 2, 6, 7, 8, 9, 10, 11)),
islands AS (SELECT *, count(src) OVER (PARTITION BY doc_id ORDER BY pos, sub) AS island FROM leaves),
joints AS (
  SELECT *, lag(text) OVER w IS NULL AS is_first, greatest(s, lag(s) OVER w,
    CASE WHEN k = 9 OR lag(k) OVER w IN (7, 9) THEN 1 ELSE 0 END) AS strength
  FROM islands WHERE src IS NULL WINDOW w AS (PARTITION BY doc_id, island ORDER BY pos, sub)),
merged AS (
  SELECT doc_id, island, 1 AS part, string_agg(CASE WHEN is_first THEN '' WHEN strength = 3 THEN chr(10) || chr(10)
    WHEN strength = 2 THEN chr(10) WHEN strength = 1 THEN ' ' ELSE '' END || text, '' ORDER BY pos, sub) AS body
  FROM joints GROUP BY doc_id, island
  UNION ALL SELECT doc_id, island, 0, '[' || src || ']' FROM islands WHERE src IS NOT NULL)"""


def _body(nodes: Column) -> Column:
    return F.array_join(
        F.transform(nodes, lambda n: F.coalesce(n["text"], F.concat(F.lit("["), n["src"], F.lit("]")))), "|"
    )


_BODY_SQL = """SELECT d.doc_id, {extra}coalesce(string_agg(m.body, '|' ORDER BY island, part), '') AS body,
  count(m.body) AS n_nodes FROM docs_web d LEFT JOIN merged m USING (doc_id) GROUP BY d.doc_id{group}"""


@register("b21_merge_texts", f"WITH {_MERGED} {_BODY_SQL.format(extra='', group='')}")
def merge_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = _leaves(spark, sf_dir).withColumn("nodes", H.merge_text_nodes(F.col("nodes")))
    return merged.select("doc_id", _body(F.col("nodes")).alias("body"), F.size("nodes").alias("n_nodes"))


@register("b22_web_docs", f"WITH {_MERGED} {_BODY_SQL.format(extra='d.domain, ', group=', d.domain')}")
def web_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = H.pack_documents(parsed(spark, sf_dir))
    return docs.select("doc_id", "domain", _body(F.col("nodes")).alias("body"), F.size("nodes").alias("n_nodes"))


# The given pages hold no image: a page is one text, its blocks set apart by blank lines.
@register(
    "b22b_given_pages",
    """WITH bodies AS (
  SELECT page_id, regexp_replace(regexp_replace(regexp_extract(html, '(?s)</nav>(.*?)<footer>', 1), '(?s)<!--.*?-->', '', 'g'),
    '</?b>|<br ?/?>|</br>', '', 'g') AS body FROM pages),
blocks AS (
  SELECT page_id, generate_subscripts(string_split_regex(body, '<[^>]*>'), 1) AS i,
         unnest(string_split_regex(body, '<[^>]*>')) AS block FROM bodies),
plain AS (
  SELECT page_id, i, trim(regexp_replace(replace(replace(replace(replace(replace(replace(block, '&lt;', '<'), '&gt;', '>'),
    '&quot;', '"'), '&#x27;', ''''), '&#39;', ''''), '&amp;', '&'), '[ \n\t]+', ' ', 'g')) AS block FROM blocks)
SELECT page_id, string_agg(block, chr(10) || chr(10) ORDER BY i) AS body FROM plain WHERE block <> '' GROUP BY page_id""",
)
def given_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").withColumn("html", H.clean_html(F.col("html")))
    return H.pack_documents(build_dom_nodes(pages)).select("page_id", _body(F.col("nodes")).alias("body"))
