"""Image store joined to the documents.

Image bytes stay in the store as long as possible: documents are worked on by
address, and the payload is looked up once, at the end.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.constants import BANNED_URL_WORDS
from tessella.functions.arrays import edited, let
from tessella.operators.nodes import image_refs
from tessella.operators.skew import HOT_MIN_ROWS, HOT_SHARE, count_rows, hot_keys, salted_join


def has_banned_word(url: Column, words: list[str] = BANNED_URL_WORDS) -> Column:
    """The address holds one of the words (substring, case as written)."""
    banned = F.lit(False)
    for word in words:
        banned = banned | url.contains(word)
    return banned


def find_images(
    refs: DataFrame, images: DataFrame, share: float = HOT_SHARE, min_rows: int = HOT_MIN_ROWS
) -> DataFrame:
    """References with the columns of the image store, NULL where the address is unknown."""
    hot = hot_keys(count_rows(refs, ["src"]), ["src"], share=share, min_rows=min_rows)
    store = images.withColumnRenamed("url", "src")
    return salted_join(refs, store, ["src"], hot, ["doc_id", "pos"], "left")


def attach_images(
    docs: DataFrame,
    images: DataFrame,
    payload: str = "image",
    banned_words: list[str] | None = None,
    share: float = HOT_SHARE,
    min_rows: int = HOT_MIN_ROWS,
) -> DataFrame:
    """Put the payload of each image into its node, with counts of found and missing ones.

    With `banned_words`, addresses that hold one are treated as unknown. If the nodes
    already have a payload field, only the missing ones are looked up.
    """
    node_fields = docs.schema["nodes"].dataType.elementType.fieldNames()
    again = payload in node_fields
    refs = image_refs(docs)
    if again:
        wanted = F.filter(
            F.transform(
                "nodes",
                lambda n, i: F.struct(i.alias("pos"), n["src"].alias("src"), n[payload].isNull().alias("todo")),
            ),
            lambda r: r["todo"] & r["src"].isNotNull() & (r["src"] != ""),
        )
        refs = docs.select("doc_id", F.inline(wanted)).drop("todo")
    if banned_words is not None:
        refs = refs.filter(~has_banned_word(F.col("src"), banned_words))
    found = find_images(refs, images.select("url", payload), share, min_rows).filter(F.col(payload).isNotNull())
    hits = F.array_sort(F.collect_list(F.struct("pos", payload)))
    per_doc = found.groupBy("doc_id").agg(hits.alias("_found"))
    nodes = F.col("nodes")
    if not again:
        missing = F.lit(None).cast(images.schema[payload].dataType)
        nodes = F.transform("nodes", lambda n: n.withField(payload, missing))
    once = let(F.col("_found"), lambda f: F.filter(f, lambda x, i: (i == 0) | (x["pos"] != F.get(f, i - 1)["pos"])))
    filled = edited(nodes, once, lambda f: f["pos"], lambda n, f: F.array(n.withField(payload, f[payload])))

    n_urls = F.size(F.filter("nodes", lambda n: n["src"].isNotNull() & (n["src"] != "")))
    n_found = F.size(F.filter("nodes", lambda n: n[payload].isNotNull()))
    return (
        docs.join(per_doc, "doc_id", "left")
        .withColumn("nodes", F.when(F.col("_found").isNull(), nodes).otherwise(filled))
        .drop("_found")
        .withColumn("num_found", n_found)
        .withColumn("num_not_found", n_urls - F.col("num_found"))
    )


def merge_image_sets(first: DataFrame, second: DataFrame, order: str | None = None) -> DataFrame:
    """Two image stores as one with every address once; the second wins where both know it.

    Of repeats inside one store the last by `order` wins, and without it, or between
    equal places, the last by a hash of the row. The winner is found on keys alone and
    its payload joined afterwards.
    """
    place = F.lit(0) if order is None else F.col(order)
    both = [
        images.withColumn("_key", F.struct(F.lit(k).alias("store"), place.alias("place"), F.xxhash64(*images.columns).alias("row")))
        for k, images in enumerate((first, second))
    ]
    every = both[0].unionByName(both[1])
    winners = every.select("url", "_key").groupBy("url").agg(F.max("_key").alias("_key"))
    # Rows that agree in the whole key are the same row; the join has dealt them by url already.
    return every.join(winners, ["url", "_key"]).drop("_key").dropDuplicates(["url"])


def restrict_image_store(images: DataFrame, keep: DataFrame, drop: DataFrame) -> DataFrame:
    """Images whose address is on the first list and not on the second."""
    wanted = keep.select("url").distinct().join(drop.select("url"), "url", "left_anti")
    return images.join(wanted, "url", "left_semi")


def images_as_urls(nodes: Column) -> Column:
    """The address of each node, NULL for texts: the form that can be published."""
    return F.transform(nodes, lambda n: n["src"])


def published_documents(docs: DataFrame) -> DataFrame:
    """Aligned lists of texts and image addresses with the metadata as JSON."""
    fields = docs.schema["nodes"].dataType.elementType.fieldNames()
    meta = (
        F.to_json(F.col("nodes")["meta"])
        if "meta" in fields
        else F.to_json(F.transform("nodes", lambda n: F.when(n["src"].isNotNull(), F.struct(n["src"].alias("src")))))
    )
    general = [c for c in ("url", "warc_filename", "warc_record_offset", "warc_record_length") if c in docs.columns]
    return docs.select(
        "doc_id",
        F.col("nodes")["text"].alias("texts"),
        images_as_urls(F.col("nodes")).alias("images"),
        meta.alias("metadata"),
        F.to_json(F.struct(*general)).alias("general_metadata"),
    )


def distinct_image_urls(docs: DataFrame) -> DataFrame:
    """Each image address of the documents once."""
    return image_refs(docs).select(F.col("src").alias("url")).distinct()

