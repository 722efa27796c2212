"""Removal of repeated images, documents, paragraphs and similar texts."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.constants import END_OF_DOCUMENT, FREQUENT_IMAGE_CUTOFF, PARAGRAPH_SEPARATOR
from tessella.functions.arrays import let, without
from tessella.functions.similarity import later_similar
from tessella.operators.nodes import (
    drop_nodes,
    drop_paragraphs,
    image_refs,
    image_srcs,
    paragraph_table,
)
from tessella.operators.skew import HOT_MIN_ROWS, HOT_SHARE, count_rows, hot_keys, salted_join

# --- Images ---------------------------------------------------------------------


def image_url_counts(docs: DataFrame) -> DataFrame:
    """(src, n): how often each image address occurs in the documents."""
    return count_rows(image_refs(docs), ["src"])


def frequent_images(docs: DataFrame, threshold: int = FREQUENT_IMAGE_CUTOFF) -> DataFrame:
    return image_url_counts(docs).filter(F.col("n") > threshold)


def dedup_frequent_images(
    docs: DataFrame,
    threshold: int = FREQUENT_IMAGE_CUTOFF,
    share: float = HOT_SHARE,
    min_rows: int = HOT_MIN_ROWS,
) -> DataFrame:
    """Remove the nodes of all images that occur more than `threshold` times."""
    listed = frequent_images(docs, threshold)
    hot = hot_keys(listed, ["src"], share=share, min_rows=min_rows)
    drops = salted_join(image_refs(docs), listed.select("src"), ["src"], hot, ["doc_id", "pos"], "left_semi")
    return drop_nodes(docs, drops)


def dedup_images_in_doc(nodes: Column) -> Column:
    """Keep the first of several image nodes with the same address."""

    def first_only(pairs: Column) -> Column:
        # Sorted by (src, i), every entry that follows one with the same src is a repeat.
        repeats = F.transform(
            F.filter(pairs, lambda p, k: (k > 0) & (p["src"] == F.get(pairs, k - 1)["src"])), lambda p: p["i"]
        )
        return let(
            F.array_sort(repeats), lambda drop: F.when(F.size(drop) == 0, nodes).otherwise(without(nodes, drop))
        )

    pairs = F.filter(
        F.transform(nodes, lambda n, i: F.struct(n["src"].alias("src"), i.alias("i"))),
        lambda p: p["src"].isNotNull(),
    )
    return let(F.sort_array(pairs), first_only)


# --- Documents --------------------------------------------------------------------


def dedup_by_url(
    docs: DataFrame, strict: bool = False, share: float = HOT_SHARE, min_rows: int = HOT_MIN_ROWS
) -> DataFrame:
    """Keep, of the documents of one URL, those of the greatest archive file name.

    Documents of the same URL and file all stay, unless `strict`; then the one with the
    greatest id does. A missing file name is less than any other. Documents without a
    URL all stay. Only ids and keys are grouped and joined; the losers are taken off
    the documents by id.
    """
    keyed = docs.select("doc_id", "url", "warc_filename").filter(F.col("url").isNotNull())
    best = keyed.groupBy("url").agg(
        F.max(F.struct("warc_filename", "doc_id")).alias("_best"), F.count(F.lit(1)).alias("n")
    )
    hot = hot_keys(best, ["url"], share=share, min_rows=min_rows)
    joined = salted_join(keyed, best.filter("n > 1").drop("n"), ["url"], hot, ["doc_id"])
    stays = F.col("doc_id") == F.col("_best.doc_id") if strict else F.col("warc_filename").eqNullSafe(F.col("_best.warc_filename"))
    return docs.join(joined.filter(~stays).select("doc_id"), "doc_id", "left_anti")


def _group_stats(counts: DataFrame, groups: str, total: str, repeated: str) -> DataFrame:
    again = F.col("n") > 1
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias(total),
        F.count(F.when(again, 1)).alias(groups),
        F.coalesce(F.sum(F.when(again, F.col("n"))), F.lit(0)).alias(repeated),
        F.coalesce(F.sum(F.when(again, F.col("n") - 1)), F.lit(0)).alias("n_removable"),
    )


def url_dup_stats(docs: DataFrame) -> DataFrame:
    """Documents, URLs seen at least twice, documents under them, removable documents."""
    return _group_stats(count_rows(docs, ["url"]), "n_repeated_urls", "n_docs", "n_docs_in_groups")


def image_set_signature(nodes: Column) -> Column:
    """Digest of the set of image addresses of a document; NULL if it has no image."""
    srcs = F.array_sort(F.array_distinct(image_srcs(nodes)))
    return F.when(F.size(srcs) > 0, F.sha2(F.array_join(srcs, "\n"), 256))


def dedup_by_image_set(docs: DataFrame, share: float = HOT_SHARE, min_rows: int = HOT_MIN_ROWS) -> DataFrame:
    """Keep, of the documents with the same set of images, the last one.

    Last is by archive file name, then by id. Documents without images, or without
    nodes at all, stay. Only ids and digests are grouped, with partial maxima; the
    losers are taken off the documents by id.
    """
    signed = docs.select("doc_id", "warc_filename", image_set_signature(F.col("nodes")).alias("sig"))
    signed = signed.filter(F.col("sig").isNotNull())
    last = signed.groupBy("sig").agg(
        F.max(F.struct("warc_filename", "doc_id"))["doc_id"].alias("_last"), F.count(F.lit(1)).alias("n")
    )
    hot = hot_keys(last, ["sig"], share=share, min_rows=min_rows)
    joined = salted_join(signed.select("doc_id", "sig"), last.filter("n > 1").drop("n"), ["sig"], hot, ["doc_id"])
    return docs.join(joined.filter(F.col("doc_id") != F.col("_last")).select("doc_id"), "doc_id", "left_anti")


def image_set_stats(docs: DataFrame) -> DataFrame:
    """Documents with images, those sharing their image set, removable documents."""
    signed = docs.select(image_set_signature(F.col("nodes")).alias("sig")).filter(F.col("sig").isNotNull())
    return _group_stats(count_rows(signed, ["sig"]), "n_repeated_sets", "n_docs", "n_docs_in_groups")


# --- Paragraphs ---------------------------------------------------------------------


def _keyed_paragraphs(docs: DataFrame, separator: str) -> DataFrame:
    """(doc_id, domain, node, par, digest): paragraphs by a 128-bit digest, without the text."""
    return (
        paragraph_table(docs, "domain", separator=separator)
        .filter(~F.col("paragraph").contains(END_OF_DOCUMENT))
        .select("doc_id", "domain", "node", "par", F.unhex(F.md5("paragraph")).alias("digest"))
    )


def repeated_paragraphs(docs: DataFrame, min_count: int = 3, separator: str = PARAGRAPH_SEPARATOR) -> DataFrame:
    """(domain, digest, n): paragraphs that occur at least `min_count` times in a domain."""
    return count_rows(_keyed_paragraphs(docs, separator), ["domain", "digest"]).filter(F.col("n") >= min_count)


def dedup_paragraphs_by_domain(
    docs: DataFrame,
    min_count: int = 3,
    drop_empty: bool = False,
    separator: str = PARAGRAPH_SEPARATOR,
    share: float = HOT_SHARE,
    min_rows: int = HOT_MIN_ROWS,
) -> DataFrame:
    """Remove every occurrence of the paragraphs repeated in their domain.

    The group is (domain, paragraph), so a very large domain spreads over all tasks; a
    very frequent paragraph is counted by partial sums and joined by salts.
    """
    listed = repeated_paragraphs(docs, min_count, separator)
    keys = ["domain", "digest"]
    hot = hot_keys(listed, keys, share=share, min_rows=min_rows)
    drops = salted_join(
        _keyed_paragraphs(docs, separator), listed.select(*keys), keys, hot, ["doc_id", "node", "par"], "left_semi"
    )
    return drop_paragraphs(docs, drops, separator, drop_empty)


# --- Similar texts inside a document ----------------------------------------------------

# Documents up to this many distinct texts are compared in place, longer ones in tiles.
TEXTS_PER_TILE = 512


def _sorted_texts(nodes: Column) -> Column:
    """(text, pos) of the texts of a document, in text order."""
    return F.sort_array(
        F.filter(
            F.transform(nodes, lambda n, i: F.struct(n["text"].alias("text"), i.alias("pos"))),
            lambda p: p["text"].isNotNull(),
        )
    )


def _is_copy(pairs: Column, pair: Column, k: Column) -> Column:
    return (k > 0) & (pair["text"] == F.get(pairs, k - 1)["text"])


def similar_nodes(docs: DataFrame, threshold: int = 80, per_tile: int = TEXTS_PER_TILE) -> DataFrame:
    """(doc_id, pos) of the texts that are similar to an earlier text of their document.

    Equal texts are settled by position alone; what is left is compared by length,
    then by character counts, and only then by the full similarity. No pair becomes a
    row: a document is compared where it lies, and one with very many texts is cut
    into tiles of `per_tile` x `per_tile` texts that run as separate groups.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    pairs = let(
        _sorted_texts(F.col("nodes")),
        lambda s: F.struct(
            F.filter(s, lambda p, k: _is_copy(s, p, k))["pos"].alias("copies"),
            F.filter(s, lambda p, k: ~_is_copy(s, p, k)).alias("firsts"),
        ),
    )
    marked = docs.select("doc_id", pairs.alias("pairs")).select("doc_id", "pairs.copies", "pairs.firsts")
    copies = marked.select("doc_id", F.explode("copies").alias("pos"))

    def compare_in_place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [
                (doc_id, pos)
                for doc_id, texts, positions in zip(batch["doc_id"], batch["texts"], batch["positions"])
                for pos in later_similar(list(texts), list(positions), threshold)
            ]
            yield pd.DataFrame(found, columns=["doc_id", "pos"])

    texts_of = F.col("firsts")
    short = (
        marked.filter(F.size(texts_of).between(2, per_tile))
        .select("doc_id", texts_of["text"].alias("texts"), texts_of["pos"].alias("positions"))
        .mapInPandas(compare_in_place, f"doc_id {id_type}, pos int")
    )

    blocks = F.ceil(F.size(texts_of) / per_tile).cast("int")
    rows = marked.filter(F.size(texts_of) > per_tile).select(
        "doc_id", blocks.alias("blocks"), F.inline("firsts")
    )
    block = F.pmod(F.xxhash64("text"), F.col("blocks")).cast("int")
    tiled = rows.withColumn("block", block).select(
        "doc_id",
        "text",
        "pos",
        "block",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
    )
    tiled = tiled.select(
        "doc_id",
        "text",
        "pos",
        "block",
        F.least("block", "other").alias("tile_a"),
        F.greatest("block", "other").alias("tile_b"),
    )

    def compare_tile(pdf: pd.DataFrame) -> pd.DataFrame:
        found = later_similar(
            pdf["text"].tolist(), pdf["pos"].tolist(), threshold, groups=pdf["block"].tolist()
        )
        return pd.DataFrame({"doc_id": pdf["doc_id"].iloc[0], "pos": pd.Series(found, dtype="int32")})

    long = tiled.groupBy("doc_id", "tile_a", "tile_b").applyInPandas(compare_tile, f"doc_id {id_type}, pos int")
    return copies.unionByName(short).unionByName(long).distinct()


def dedup_similar_nodes(docs: DataFrame, threshold: int = 80, per_tile: int = TEXTS_PER_TILE) -> DataFrame:
    """Documents without the texts that are similar to an earlier one."""
    return drop_nodes(docs, similar_nodes(docs, threshold, per_tile))

