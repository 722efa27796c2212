"""Schemas of the tables that pass between the jobs."""

from pyspark.sql import types as T

POINTERS = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("warc_filename", T.StringType()),
        T.StructField("warc_record_offset", T.LongType()),
        T.StructField("warc_record_length", T.LongType()),
        T.StructField("content_languages", T.StringType()),
        T.StructField("fetch_status", T.IntegerType()),
        T.StructField("url_host_registered_domain", T.StringType()),
    ]
)

PATH = T.ArrayType(T.StructType([T.StructField("tag", T.StringType()), T.StructField("no", T.IntegerType())]))

# One element or text leaf of a page. `path` runs from the root to the node itself;
# `figcaption` is the caption text inside the node or the figure around it. `end` is the
# number of its last descendant (its own for a leaf): y is inside x when x.no < y.no <= x.end.
DOM_NODE = T.StructType(
    [
        T.StructField("pos", T.IntegerType()),
        T.StructField("tag", T.StringType()),
        T.StructField("path", PATH),
        T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
        T.StructField("text", T.StringType()),
        T.StructField("n_children", T.IntegerType()),
        T.StructField("figcaption", T.StringType()),
        T.StructField("source_src", T.StringType()),
        T.StructField("end", T.IntegerType()),
    ]
)
DOM_NODES = T.ArrayType(DOM_NODE)

IMAGE_META = T.StructType(
    [
        T.StructField("document_url", T.StringType()),
        T.StructField("unformatted_src", T.StringType()),
        T.StructField("src", T.StringType()),
        T.StructField("formatted_filename", T.StringType()),
        T.StructField("alt_text", T.StringType()),
        T.StructField("rendered_width_px", T.IntegerType()),
        T.StructField("rendered_width_pct", T.IntegerType()),
        T.StructField("rendered_height_px", T.IntegerType()),
        T.StructField("rendered_height_pct", T.IntegerType()),
    ]
)

# One text or image of a web document. Operators need kind, text and src; other
# fields travel along untouched.
DOC_NODE = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("src", T.StringType()),
        T.StructField("caption", T.StringType()),
        T.StructField("meta", IMAGE_META),
    ]
)
WEB_DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("domain", T.StringType()),
        T.StructField("warc_filename", T.StringType()),
        T.StructField("nodes", T.ArrayType(DOC_NODE)),
    ]
)
