"""Clean-up inside documents. All of it maps the node array within its row."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.constants import END_OF_DOCUMENT, PARAGRAPH_SEPARATOR, SPAM_WORD_CUTOFF
from tessella.functions.arrays import let
from tessella.functions.metrics import spam_word_ratio
from tessella.functions.text import strip_blanks
from tessella.operators.dedup import dedup_images_in_doc
from tessella.operators.nodes import compute_once, filter_paragraphs, image_srcs, is_image, map_texts, texts


def merge_adjacent_texts(nodes: Column, separator: str = PARAGRAPH_SEPARATOR) -> Column:
    """Drop empty texts, fuse neighbouring texts and keep the images.

    Nodes with neither text nor address, as left by images that were not found, go too
    (see `reject_count`).
    """
    filled = F.filter(nodes, lambda n: (is_image(n) & n["src"].isNotNull()) | (~is_image(n) & (n["text"] != "")))

    def merged(kept: Column) -> Column:
        starts = F.array_compact(
            F.transform(
                kept, lambda n, i: F.when((i == 0) | is_image(n) | is_image(F.get(kept, i - 1)), i)
            )
        )

        def piece(s: Column, start: Column, k: Column) -> Column:
            length = F.coalesce(F.get(s, k + 1), F.size(kept)) - start
            first = F.get(kept, start)
            return F.when(length == 1, first).otherwise(
                first.withField("text", F.array_join(F.slice(kept, start + 1, length)["text"], separator))
            )

        return let(starts, lambda s: F.transform(s, lambda start, k: piece(s, start, k)))

    return let(filled, merged)


def reject_count(nodes: Column) -> Column:
    """Nodes that hold neither a text nor an image address."""
    return F.size(F.filter(nodes, lambda n: n["text"].isNull() & n["src"].isNull()))


def drop_spam_paragraphs(
    nodes: Column, cutoff: float = SPAM_WORD_CUTOFF, separator: str = PARAGRAPH_SEPARATOR
) -> Column:
    """Keep the paragraphs whose share of boilerplate words is below the cutoff."""
    return map_texts(nodes, lambda t: filter_paragraphs(t, lambda p: spam_word_ratio(p) < cutoff, separator))


def _is_marker(paragraph: Column) -> Column:
    return strip_blanks(paragraph) == END_OF_DOCUMENT


def collapse_markers(nodes: Column, separator: str = PARAGRAPH_SEPARATOR) -> Column:
    """Of consecutive marker paragraphs in a text keep the first."""

    def collapsed(text: Column) -> Column:
        return let(
            F.split(text, separator),
            lambda pars: F.array_join(
                F.filter(
                    pars,
                    lambda p, i: ~(_is_marker(p) & (i > 0) & F.coalesce(_is_marker(F.get(pars, i - 1)), F.lit(False))),
                ),
                separator,
            ),
        )

    return map_texts(nodes, collapsed)


def drop_trailing_marker(nodes: Column, separator: str = PARAGRAPH_SEPARATOR) -> Column:
    """Take one marker off the end of the last node, if that is a text ending with it."""

    def cut(text: Column) -> Column:
        return let(
            F.split(text, separator),
            lambda pars: F.when(
                F.element_at(pars, -1) == END_OF_DOCUMENT,
                F.array_join(F.slice(pars, 1, F.size(pars) - 1), separator),
            ).otherwise(text),
        )

    return F.transform(
        nodes,
        lambda n, i: F.when(
            (i == F.size(nodes) - 1) & n["text"].isNotNull(), n.withField("text", cut(n["text"]))
        ).otherwise(n),
    )


def has_text_and_image(nodes: Column) -> Column:
    """At least one non-empty text and at least one image."""
    return (F.size(texts(nodes)) > 0) & (F.size(image_srcs(nodes)) > 0)


def is_marker_only(nodes: Column) -> Column:
    """All texts are the marker; also true without any text."""
    return F.forall(texts(nodes), _is_marker)


def final_nodes(nodes: Column, separator: str = PARAGRAPH_SEPARATOR) -> Column:
    """The node steps of the final processing, in their order."""
    nodes = let(nodes, dedup_images_in_doc)
    nodes = drop_spam_paragraphs(nodes, separator=separator)
    nodes = merge_adjacent_texts(nodes, separator)
    nodes = collapse_markers(nodes, separator)
    nodes = let(nodes, lambda n: drop_trailing_marker(n, separator))
    return merge_adjacent_texts(nodes, separator)


def final_processing(docs: DataFrame, separator: str = PARAGRAPH_SEPARATOR) -> DataFrame:
    """Final node steps, then the two document filters."""
    nodes = let(
        final_nodes(F.col("nodes"), separator),
        lambda n: F.when(~is_marker_only(n) & has_text_and_image(n), n),
    )
    return compute_once(docs, "nodes", nodes)


def final_cleaning(docs: DataFrame, separator: str = PARAGRAPH_SEPARATOR) -> DataFrame:
    """Merge texts and keep the documents with text and image."""
    nodes = let(merge_adjacent_texts(F.col("nodes"), separator), lambda n: F.when(has_text_and_image(n), n))
    return compute_once(docs, "nodes", nodes)
