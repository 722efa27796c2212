"""Statistics for reports and for choosing thresholds."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.constants import PARAGRAPH_SEPARATOR
from tessella.functions import metrics as M
from tessella.functions import text as T
from tessella.operators.cleanup import reject_count
from tessella.operators.nodes import full_text, image_srcs, paragraph_table, texts
from tessella.operators.ordinals import with_running_sum
from tessella.operators.skew import count_rows
from tessella.plans.options import TextChecks


def _two_decimals(x: Column) -> Column:
    """Rounded by the binary value: 0.145 is a little less than its text and gives 0.14."""
    return F.round(x * 100) / 100


def with_text_metrics(rows: DataFrame, text: str, checks: TextChecks) -> DataFrame:
    """All metrics that need no model, rounded to two decimals, of the text column of `rows`,
    after the columns of `rows` without the text. The words are made once, in columns."""
    kept = [c for c in rows.columns if c != text]
    rows = rows.withColumn("_bare", T.strip_diacritics(F.col(text)))
    rows = rows.withColumns({"_words": T.words(F.col(text)), "_bare_words": T.words(F.col("_bare"))})
    return rows.select(*kept, *_text_metrics(F.col(text), F.col("_bare"), F.col("_words"), F.col("_bare_words"), checks))


def _text_metrics(text: Column, bare: Column, words: Column, bare_words: Column, checks: TextChecks) -> list[Column]:
    metrics = {
        "n_words": T.num_words(text),
        "char_repetition": M.char_repetition_ratio(bare, checks.char_repetition_length),
        "word_repetition": M.word_repetition_ratio(words, checks.word_repetition_length),
        "special_chars": M.special_char_ratio(text),
        "stop_words": M.listed_word_ratio(bare_words, list(checks.stop_words)),
        "flagged_words": M.listed_word_ratio(bare_words, list(checks.flagged_words)),
        "punctuation": M.punctuation_ratio(text, checks.punctuation_min_words),
        "common_words": M.listed_word_ratio(bare_words, list(checks.common_words)),
    }
    return [_two_decimals(m).alias(name) if name != "n_words" else m.alias(name) for name, m in metrics.items()]


def metric_profile(
    docs: DataFrame, checks: TextChecks, level: str = "document", separator: str = PARAGRAPH_SEPARATOR
) -> DataFrame:
    """Metrics per document (joined texts) or per paragraph."""
    if level == "paragraph":
        pars = paragraph_table(docs, separator=separator)
        return with_text_metrics(pars.select("doc_id", "node", "par", "paragraph"), "paragraph", checks)
    if level != "document":
        raise ValueError("level must be 'document' or 'paragraph'")
    joined = docs.select("doc_id", full_text(F.col("nodes"), separator).alias("text"))
    return with_text_metrics(joined, "text", checks)


def image_profile(images: DataFrame) -> DataFrame:
    ratio = F.round(F.col("width") / F.nullif(F.col("height"), F.lit(0)), 2)
    return images.select("url", "width", "height", ratio.alias("aspect_ratio"))


def trimmed_histogram(
    values: DataFrame, metric: str, bins: int = 20, low: float = 0.05, high: float = 0.95
) -> DataFrame:
    """(bin, bin_start, n): equal-width bins over the values between two shares of the rows.

    Rows are counted per value first; rows of equal value are interchangeable, so the
    ordinals to cut off follow from running counts over the distinct values.
    """
    counts = count_rows(values.select(F.col(metric).alias("value")).filter(F.col("value").isNotNull()), ["value"])
    running = with_running_sum(counts, "value", "n", "upto")
    total = counts.agg(F.sum("n").alias("t")).scalar()
    first, last = F.floor(total * F.lit(low)), F.floor(total * F.lit(high))
    inside = F.least("upto", last) - F.greatest(F.col("upto") - F.col("n"), first)
    kept = running.select("value", inside.alias("n")).filter(F.col("n") > 0)
    ends = kept.agg(F.struct(F.min("value").alias("lo"), F.max("value").alias("hi")).alias("e")).scalar()
    width = (ends["hi"] - ends["lo"]) / F.lit(float(bins))
    number = F.when(width > 0, F.least(F.floor((F.col("value") - ends["lo"]) / width), F.lit(bins - 1))).otherwise(0)
    return (
        kept.select(number.cast("int").alias("bin"), "n", ends["lo"].alias("lo"), width.alias("width"))
        .groupBy("bin", F.round(F.col("lo") + F.col("bin") * F.col("width"), 6).alias("bin_start"))
        .agg(F.sum("n").alias("n"))
    )


def top_by_score(rows: DataFrame, score: str, n: int, tie: str) -> DataFrame:
    """The n rows of the highest score; ties go by the second column."""
    return rows.orderBy(F.desc(score), tie).limit(n)


def sample_docs(docs: DataFrame, n: int, seed: int = 0, key: str = "doc_id") -> DataFrame:
    """n documents in a random order that depends only on the seed and the keys."""
    return docs.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), key).limit(n)


def domain_positions(docs: DataFrame) -> DataFrame:
    """(domain, doc_id): which documents belong to a domain, in long form."""
    return docs.select("domain", "doc_id")


def domain_counts(docs: DataFrame) -> DataFrame:
    """Documents per domain with the first and last id; texts and images too if there are nodes."""
    counted = [
        F.count(F.lit(1)).alias("n_docs"),
        F.min("doc_id").alias("first_doc_id"),
        F.max("doc_id").alias("last_doc_id"),
    ]
    if "nodes" in docs.columns:
        counted += [F.sum(F.size(image_srcs(F.col("nodes")))).alias("n_images"), F.sum(F.size(texts(F.col("nodes")))).alias("n_texts")]
    return docs.groupBy("domain").agg(*counted)


def stage_counts(docs: DataFrame, stage: str) -> DataFrame:
    """Documents, image nodes, text nodes and nodes that hold neither after a stage."""
    return docs.agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.coalesce(F.sum(F.size(image_srcs(F.col("nodes")))), F.lit(0)).alias("n_images"),
        F.coalesce(
            F.sum(F.size(F.filter("nodes", lambda n: n["text"].isNotNull() & (n["text"] != "")))), F.lit(0)
        ).alias("n_texts"),
        F.coalesce(F.sum(reject_count(F.col("nodes"))), F.lit(0)).alias("n_rejected"),
    ).select(F.lit(stage).alias("stage"), "n_docs", "n_images", "n_texts", "n_rejected")


def stage_report(stages: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [stage_counts(docs, name) for name, docs in stages.items()])
