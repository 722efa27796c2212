"""Predicates on images, paragraphs and documents.

Checks that need no model are column expressions evaluated inside the row, cheapest
first; the language and perplexity checks run afterwards, on what is left.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.constants import DIACRITICS_CLASS, END_OF_DOCUMENT, PARAGRAPH_SEPARATOR, UNSAFE_SCORE_CUTOFFS
from tessella.functions import metrics as M
from tessella.functions import text as T
from tessella.functions.arrays import let
from tessella.operators.nodes import (
    drop_nodes,
    full_text,
    image_refs,
    image_srcs,
    is_image,
    paragraph_table,
)
from tessella.operators.skew import HOT_MIN_ROWS, HOT_SHARE, count_rows, hot_keys, salted_join
from tessella.plans.options import ImageChecks, TextChecks

# --- Images --------------------------------------------------------------------


def valid_format(fmt: Column, formats: tuple[str, ...]) -> Column:
    """A known format must be on the list; an unknown one passes."""
    return fmt.isNull() | F.lower(fmt).isin(*formats)


def rendered_size(original: Column, px: Column, pct: Column) -> Column:
    """Rendered side in pixels: a percentage of the original, half to even, or the pixels."""
    return F.when(pct.isNotNull(), F.bround(original * pct / 100.0).cast("int")).otherwise(px)


def valid_size(
    width: Column, height: Column, rendered_width: Column, rendered_height: Column, checks: ImageChecks
) -> Column:
    """All known sides within bounds and the aspect ratio not too long either way."""
    low, high = checks.min_side, checks.max_side
    ratio = width / F.nullif(height, F.lit(0))
    return (
        width.between(low, high)
        & height.between(low, high)
        & (rendered_width.isNull() | rendered_width.between(low, high))
        & (rendered_height.isNull() | rendered_height.between(low, high))
        & ratio.between(1 / checks.max_aspect_ratio, checks.max_aspect_ratio)
    )


def unsafe_urls(scores: DataFrame, cutoffs: dict[str, float] = UNSAFE_SCORE_CUTOFFS) -> DataFrame:
    """Addresses with any score above its cutoff. `scores` has url and one column per label."""
    unknown = set(cutoffs) - set(scores.columns)
    if unknown:
        raise ValueError(f"the score table has no columns {sorted(unknown)}")
    unsafe = F.lit(False)
    for label, cutoff in cutoffs.items():
        unsafe = unsafe | (F.col(label) > cutoff)
    return scores.filter(unsafe).select("url").distinct()


def _listed_refs(docs: DataFrame, urls: DataFrame, share: float, min_rows: int) -> DataFrame:
    """Image references of the documents whose address is on the list."""
    refs = image_refs(docs)
    listed = urls.select(F.col("url").alias("src")).distinct()
    hot = hot_keys(count_rows(refs, ["src"]), ["src"], share=share, min_rows=min_rows)
    return salted_join(refs, listed, ["src"], hot, ["doc_id", "pos"], "left_semi")


def drop_unsafe_image_docs(
    docs: DataFrame, urls: DataFrame, share: float = HOT_SHARE, min_rows: int = HOT_MIN_ROWS
) -> DataFrame:
    """Documents without any image on the list."""
    hit = _listed_refs(docs, urls, share, min_rows).select("doc_id").distinct()
    return docs.join(hit, "doc_id", "left_anti")


def remove_listed_images(
    docs: DataFrame, urls: DataFrame, share: float = HOT_SHARE, min_rows: int = HOT_MIN_ROWS
) -> DataFrame:
    """Documents without the image nodes on the list; a document may end up empty."""
    return drop_nodes(docs, _listed_refs(docs, urls, share, min_rows))


# --- Texts -----------------------------------------------------------------------


def first_failed_check(
    text: Column,
    checks: TextChecks,
    words: Column | None = None,
    char_repetition: Column | None = None,
    word_repetition: Column | None = None,
) -> Column:
    """Name of the first check that the text fails, NULL if it passes all of them.

    Later checks are not evaluated for a text that has failed, except for the two n-gram
    metrics. Those stand in a projection: inside a lambda they are given, as are the words.
    """
    bare = T.strip_diacritics(text)
    words = T.words(text) if words is None else words
    # A text without diacritics, as most are, is not searched for its words again.
    bare_words = F.when(~text.rlike(DIACRITICS_CLASS), words).otherwise(T.words(bare))
    count = F.size(words)
    rules: list[tuple[str, Column]] = []
    if checks.min_words is not None:
        rules.append(("number_words", count < checks.min_words))
    if checks.max_words is not None:
        rules.append(("number_words", count > checks.max_words))
    if checks.max_char_repetition is not None:
        ratio = M.char_repetition_ratio(bare, checks.char_repetition_length) if char_repetition is None else char_repetition
        rules.append(("character_repetition", ratio > checks.max_char_repetition))
    if checks.max_word_repetition is not None:
        ratio = M.word_repetition_ratio(words, checks.word_repetition_length) if word_repetition is None else word_repetition
        rules.append(("word_repetition", ratio > checks.max_word_repetition))
    if checks.max_special_chars is not None:
        rules.append(("special_characters", M.special_char_ratio(text) > checks.max_special_chars))
    if checks.min_stop_words is not None:
        ratio = M.listed_word_ratio(bare_words, list(checks.stop_words))
        rules.append(("stop_words", ratio < checks.min_stop_words))
    if checks.max_flagged_words is not None and checks.flagged_words:
        ratio = M.listed_word_ratio(bare_words, list(checks.flagged_words))
        rules.append(("flagged_words", ratio > checks.max_flagged_words))
    if checks.min_punctuation is not None:
        ratio = M.punctuation_ratio(text, checks.punctuation_min_words)
        rules.append(("punctuation", ratio < checks.min_punctuation))
    if checks.min_common_words is not None:
        ratio = M.listed_word_ratio(bare_words, list(checks.common_words))
        rules.append(("common_words", ratio < checks.min_common_words))
    if not rules:
        return F.lit(None).cast("string")
    (name, failed), *rest = rules
    decision = F.when(failed, F.lit(name))
    for name, failed in rest:
        decision = decision.when(failed, F.lit(name))
    return decision


def _failed_image_check(node: Column, checks: ImageChecks) -> Column:
    """Name of the failed image check of a node that carries sizes and format."""
    width, height = node["width"], node["height"]
    decision = F.lit(None).cast("string")
    if checks.check_size:
        sized = valid_size(
            width,
            height,
            rendered_size(width, node["meta"]["rendered_width_px"], node["meta"]["rendered_width_pct"]),
            rendered_size(height, node["meta"]["rendered_height_px"], node["meta"]["rendered_height_pct"]),
            checks,
        )
        decision = F.when(~F.coalesce(sized, F.lit(False)), F.lit("image_size")).otherwise(decision)
    if checks.check_format:
        decision = F.when(~valid_format(node["format"], checks.formats), F.lit("image_format")).otherwise(decision)
    return decision


def filter_paragraphs(
    docs: DataFrame,
    checks: TextChecks,
    image_checks: ImageChecks = ImageChecks(),
    separator: str = PARAGRAPH_SEPARATOR,
    keep_newlines: bool = True,
) -> DataFrame:
    """Documents with only the paragraphs and images that pass their checks.

    Texts are cleaned first. The marker always passes. A text node without a surviving
    paragraph, a failed image and an empty node are removed. The checks that need a
    model are in plans.flows.
    """

    # The paragraphs of every node (NULL for one without text), their words and n-gram metrics
    # are columns of their own; the verdict is then one pass over the nodes.
    def of_node(n: Column) -> Column:
        return F.when(~(is_image(n) & n["src"].isNotNull()), F.split(T.clean_text(n["text"], keep_newlines), separator))

    kept = docs.columns
    docs = docs.withColumn("_paragraphs", F.transform("nodes", of_node))
    docs = docs.withColumn("_words", F.transform("_paragraphs", lambda pars: F.transform(pars, T.words)))
    ratios = {}
    if checks.max_char_repetition is not None:
        bare = F.transform("_paragraphs", lambda pars: F.transform(pars, T.strip_diacritics))
        ratios["_chars"] = M.char_repetition_ratio(bare, checks.char_repetition_length, depth=2)
    if checks.max_word_repetition is not None:
        ratios["_repeats"] = M.word_repetition_ratio(F.col("_words"), checks.word_repetition_length, depth=2)
    docs = docs.withColumns(ratios) if ratios else docs

    def passes(p: Column, i: Column, j: Column) -> Column:
        def at(name: str) -> Column | None:
            return F.get(F.get(name, i), j) if name in docs.columns else None

        failed = let(at("_words"), lambda words: first_failed_check(p, checks, words, at("_chars"), at("_repeats")))
        return (p == END_OF_DOCUMENT) | failed.isNull()

    def text_node(n: Column, i: Column) -> Column:
        survivors = F.filter(F.get("_paragraphs", i), lambda p, j: passes(p, i, j))
        return let(
            survivors,
            lambda s: F.when(F.size(s) > 0, n.withField("text", F.array_join(s, separator))),
        )

    def checked(n: Column, i: Column) -> Column:
        image = n
        if image_checks.check_format or image_checks.check_size:
            image = F.when(_failed_image_check(n, image_checks).isNull(), n)
        return F.when(is_image(n) & n["src"].isNotNull(), image).when(n["text"].isNotNull(), text_node(n, i))

    return docs.withColumn("nodes", F.array_compact(F.transform("nodes", checked))).select(*kept)


def audit(
    docs: DataFrame,
    checks: TextChecks,
    image_checks: ImageChecks = ImageChecks(),
    separator: str = PARAGRAPH_SEPARATOR,
) -> DataFrame:
    """All documents with the check that discards them (NULL = retained)."""
    kept = [c for c in docs.columns if c != "failed_check"]
    docs = docs.withColumn("_text", full_text(F.col("nodes"), separator))
    docs = docs.withColumn("_words", T.words(F.col("_text")))
    n_images = F.size(image_srcs(F.col("nodes")))
    decision = first_failed_check(F.col("_text"), checks, F.col("_words"))
    if image_checks.max_images is not None:
        decision = F.when(n_images > image_checks.max_images, F.lit("number_images")).otherwise(decision)
    if image_checks.min_images is not None:
        decision = F.when(n_images < image_checks.min_images, F.lit("number_images")).otherwise(decision)
    return docs.select(*kept, decision.alias("failed_check"))


def filter_documents(
    docs: DataFrame,
    checks: TextChecks,
    image_checks: ImageChecks = ImageChecks(),
    separator: str = PARAGRAPH_SEPARATOR,
) -> DataFrame:
    """Documents without a failed check."""
    name = "_failed"
    judged = audit(docs, checks, image_checks, separator).withColumnRenamed("failed_check", name)
    return judged.filter(F.col(name).isNull()).select(*docs.columns)


def audit_counts(audited: DataFrame) -> DataFrame:
    return audited.groupBy("failed_check").agg(F.count(F.lit(1)).alias("n_docs"))


def paragraph_checks(
    docs: DataFrame, checks: TextChecks, *columns: str, separator: str = PARAGRAPH_SEPARATOR
) -> DataFrame:
    """(doc_id, node, par, failed_check) of every paragraph, for reports."""
    return paragraph_table(docs, *columns, separator=separator).select(
        "doc_id",
        *columns,
        "node",
        "par",
        F.when(F.col("paragraph") != END_OF_DOCUMENT, first_failed_check(F.col("paragraph"), checks)).alias(
            "failed_check"
        ),
    )
