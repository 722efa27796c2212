"""Shapes of web documents: nested nodes, image references and paragraphs.

A document is one row with an array of nodes (struct of kind, text, src, ...). A
change inside a document is an array expression; counting across documents uses the
narrow tables below, which carry keys and positions and no text, and the outcome is
joined back once by document id.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.constants import PARAGRAPH_SEPARATOR
from tessella.functions.arrays import edited, let, without

IMAGE, TEXT = "image", "text"


def is_image(node: Column) -> Column:
    return node["kind"] == IMAGE


def is_text(node: Column) -> Column:
    return node["kind"] == TEXT


def image_srcs(nodes: Column) -> Column:
    """Addresses of the images of a document, in order."""
    return F.filter(nodes["src"], lambda s: s.isNotNull() & (s != ""))


def texts(nodes: Column) -> Column:
    """Non-empty texts of a document, in order."""
    return F.filter(nodes["text"], lambda t: t.isNotNull() & (t != ""))


def full_text(nodes: Column, separator: str = PARAGRAPH_SEPARATOR) -> Column:
    return F.array_join(texts(nodes), separator)


def map_texts(nodes: Column, change: Callable[[Column], Column]) -> Column:
    """Change the text of each text node; NULL texts stay."""
    return F.transform(
        nodes, lambda n: F.when(n["text"].isNotNull(), n.withField("text", change(n["text"]))).otherwise(n)
    )


def filter_paragraphs(text: Column, keep: Callable[[Column], Column], separator: str = PARAGRAPH_SEPARATOR) -> Column:
    return F.array_join(F.filter(F.split(text, separator), keep), separator)


def render(nodes: Column) -> Column:
    """A document as one string, for reports: texts as they are, images in brackets."""
    return F.array_join(
        F.transform(nodes, lambda n: F.coalesce(n["text"], F.concat(F.lit("["), n["src"], F.lit("]")))), "\n"
    )


def image_refs(docs: DataFrame) -> DataFrame:
    """(doc_id, pos, src): one row per image node."""
    refs = F.filter(
        F.transform("nodes", lambda n, i: F.struct(i.alias("pos"), n["src"].alias("src"))),
        lambda r: r["src"].isNotNull() & (r["src"] != ""),
    )
    return docs.select("doc_id", F.inline(refs))


def paragraph_table(docs: DataFrame, *columns: str, separator: str = PARAGRAPH_SEPARATOR) -> DataFrame:
    """(doc_id, columns, node, par, paragraph): one row per paragraph of a text node."""

    def of_node(n: Column, i: Column) -> Column:
        return F.transform(
            F.coalesce(F.split(n["text"], separator), F.array().cast("array<string>")),
            lambda p, j: F.struct(i.alias("node"), j.alias("par"), p.alias("paragraph")),
        )

    # The outer form keeps the optimizer from splitting every text a second time in a filter.
    rows = docs.select("doc_id", *columns, F.inline_outer(F.flatten(F.transform("nodes", of_node))))
    return rows.filter(F.col("node").isNotNull())


def compute_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """`withColumn` that drops the rows where the value is NULL and evaluates it once.

    A plain filter on a computed column is pushed below its projection, which repeats
    the whole expression; a generator is a border for that.
    """
    kept = [c for c in df.columns if c != name]
    return df.select(*kept, F.explode_outer(F.array(value)).alias(name)).filter(F.col(name).isNotNull()).select(*df.columns)


def drop_nodes(docs: DataFrame, drops: DataFrame) -> DataFrame:
    """Documents without the nodes listed in `drops` (doc_id, pos)."""
    per_doc = drops.groupBy("doc_id").agg(F.array_sort(F.collect_set("pos")).alias("_drop"))
    return (
        docs.join(per_doc, "doc_id", "left")
        .withColumn("nodes", F.when(F.col("_drop").isNull(), F.col("nodes")).otherwise(without(F.col("nodes"), F.col("_drop"))))
        .drop("_drop")
    )


def drop_paragraphs(
    docs: DataFrame, drops: DataFrame, separator: str = PARAGRAPH_SEPARATOR, drop_empty: bool = False
) -> DataFrame:
    """Documents without the paragraphs listed in `drops` (doc_id, node, par).

    A text with no paragraph left becomes '', or its node goes with `drop_empty`.
    """
    per_node = drops.groupBy("doc_id", "node").agg(F.array_sort(F.collect_set("par")).alias("pars"))
    per_doc = per_node.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("node", "pars"))).alias("_drop"))

    def cut(n: Column, d: Column) -> Column:
        text = let(F.split(n["text"], separator), lambda pars: F.array_join(without(pars, d["pars"]), separator))
        return F.array(F.when(n["text"].isNull(), n).otherwise(n.withField("text", text)))

    nodes = edited(F.col("nodes"), F.col("_drop"), lambda d: d["node"], cut)
    if drop_empty:
        nodes = F.filter(nodes, lambda n: ~(is_text(n) & (n["text"] == "")))
    return (
        docs.join(per_doc, "doc_id", "left")
        .withColumn("nodes", F.when(F.col("_drop").isNull(), F.col("nodes")).otherwise(nodes))
        .drop("_drop")
    )
