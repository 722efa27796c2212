"""Language and perplexity models as tables.

Both scores are sums over the keys of a text: pieces of many texts look up each of their
distinct keys once and add up the weights of each text. Weights are integers (millionths of a
logarithm), so a score does not depend on the order of summation.
"""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tessella.functions import bigrams, ngrams
from tessella.sources.storage import settle

UNIT = 1_000_000


# --- Language ---------------------------------------------------------------------


MAX_LANGUAGES = 1000


@dataclass(frozen=True)
class LanguageModel:
    """`weights`: (key, w0, w1, ...), one weight per language in the order of `languages`.

    `bases` holds the weight of an unknown n-gram per language.
    """

    weights: DataFrame
    languages: list[str]
    bases: list[int]
    n: int


def _flat(text: Column) -> Column:
    return F.replace(F.lower(text), F.lit("\n"), F.lit(" "))


def train_language_model(
    labelled: DataFrame,
    text: str = "text",
    label: str = "lang",
    n: int = 3,
    k: float = 0.5,
    fold: dict[str, str] | None = None,
) -> LanguageModel:
    """Add-k character n-gram profile per language; `fold` maps labels onto others."""
    lang = F.col(label)
    for source, target in (fold or {}).items():
        lang = F.when(lang == source, F.lit(target)).otherwise(lang)
    texts = labelled.select(lang.alias("label"), _flat(F.col(text)).alias("text"))
    # Counted within the batches first, so that few rows are grouped.
    grams = texts.mapInArrow(ngrams.summed_chars(n), f"label string, key {ngrams.char_key_type(n)}, n bigint")
    counts = settle(grams.groupBy(F.col("label").alias("lang"), "key").agg(F.sum("n").alias("n")))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    vocabulary = counts.agg(F.count_distinct("key").alias("v")).scalar()
    floor = F.ln(F.lit(k) / (F.col("total") + F.lit(k) * vocabulary))
    # One short row per label; more labels than the bound are an error.
    rows = (
        totals.select("lang", F.round(floor * UNIT).cast("bigint").alias("base"))
        .orderBy("lang")
        .limit(MAX_LANGUAGES + 1)
        .collect()
    )
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = [r["lang"] for r in rows]
    # ln((n + k) / (total + k v)) - ln(k / (total + k v)) = ln((n + k) / k)
    weight = F.round(F.ln((F.col("n") + k) / F.lit(k)) * UNIT).cast("bigint")
    weights = counts.groupBy("key").agg(
        *[F.max(F.when(F.col("lang") == lang, weight)).alias(f"w{i}") for i, lang in enumerate(languages)]
    )
    return LanguageModel(settle(weights), languages, [r["base"] for r in rows], n)


def identify_language(
    texts: DataFrame, model: LanguageModel, ids: list[str], text: str = "text"
) -> DataFrame:
    """(ids, lang_pred, lang_score): best language and its posterior probability.

    Every text has a row; one without any n-gram gets the first language with equal odds.
    """
    names = [f"w{i}" for i in range(len(model.languages))]
    # Settled, so that a piece holds the same texts whenever it is read.
    flat = texts.select(*ids, _flat(F.col(text)).alias("_text"))
    fields = flat.schema.fields
    pieces = settle(flat.mapInArrow(ngrams.piece_numbers, StructType([*fields, StructField("_piece", LongType())])))
    asked = pieces.select("_piece", "_text").mapInArrow(
        ngrams.piece_keys(model.n), f"_piece bigint, key {ngrams.char_key_type(model.n)}"
    )
    known = asked.join(model.weights, "key").select("_piece", "key", *names)
    of_text = StructType([*fields[:-1], *[StructField(c, LongType()) for c in ("m", *names)]])
    parts = pieces.groupBy("_piece").cogroup(known.groupBy("_piece")).applyInArrow(
        ngrams.piece_sums(model.n, ids, names), of_text
    )
    sums = parts.groupBy(*ids).agg(F.sum("m").alias("m"), *[F.sum(w).alias(f"s{i}") for i, w in enumerate(names)])
    costs = F.sort_array(
        F.array(
            *[
                F.struct((-(F.col("m") * base + F.col(f"s{i}"))).alias("cost"), F.lit(lang).alias("lang"))
                for i, (lang, base) in enumerate(zip(model.languages, model.bases))
            ]
        )
    )
    ranked = sums.select(*ids, costs.alias("r"))
    best = F.get("r", F.lit(0))
    odds = F.aggregate(
        "r", F.lit(0.0), lambda acc, x: acc + F.exp((best["cost"] - x["cost"]) / F.lit(float(UNIT)))
    )
    return ranked.select(*ids, best["lang"].alias("lang_pred"), F.round(1 / odds, 6).alias("lang_score"))


# --- Perplexity ---------------------------------------------------------------------


#: Bytes of the corpus in a bucket of bigrams, and the least number of buckets.
BUCKET, MIN_BUCKETS = 1 << 24, 16
#: Questions and counts are shuffled for so many ranges of buckets, one after the other.
SLICES = 2


@dataclass(frozen=True)
class BigramWeights:
    """Counts to weights, with the number v of distinct next tokens as `vocabulary`."""

    vocabulary: int
    k: float
    min_count: int

    def of_bigram(self, n: np.ndarray) -> np.ndarray:
        """Weights of bigrams seen n times; 0 for those that are not stored."""
        return np.where(n >= max(self.min_count, 1), _units(np.log10(n + self.k) - np.log10(self.k)), 0)

    def of_context(self, n: np.ndarray) -> np.ndarray:
        """Weights of contexts seen n times; 0 for unknown ones."""
        smooth = self.k * max(self.vocabulary, 1)
        return np.where(n > 0, _units(np.log10(smooth) - np.log10(n + smooth)), 0)


@dataclass(frozen=True)
class BigramModel:
    """`counts`: (bucket, data, nexts), how often each bigram 'a b' and each context 'a' was seen, as blobs of
    `functions.bigrams`; `base`: one row (base), what every bigram counts before it is looked up."""

    counts: DataFrame
    buckets: int
    base: DataFrame
    weights: BigramWeights


def _units(x: np.ndarray) -> np.ndarray:
    return (np.sign(x) * np.floor(np.abs(x) * UNIT + 0.5)).astype(np.int64)


def _by_place(rows: DataFrame) -> DataFrame:
    return rows.repartition("at").sortWithinPartitions("at", "kind", "part")


def train_bigram_model(corpus: DataFrame, text: str = "text", k: float = 0.1, min_count: int = 1) -> BigramModel:
    """Add-k bigram model of a reference corpus; bigrams below `min_count` are not stored.

    p(b | a) = (n(a b) + k) / (n(a) + k v) with v distinct next tokens. Split into
    ln-sums: a base of -log10 v for each bigram, corrected by the weights of the
    context and of the bigram where they are known.
    """
    size = corpus.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = MIN_BUCKETS + size // BUCKET
    sent = corpus.select(F.col(text).alias("text")).mapInArrow(bigrams.sent_counts(buckets), bigrams.ROWS)
    counts = settle(_by_place(sent).mapInArrow(bigrams.summed_counts, "bucket bigint, data binary, nexts bigint"))
    v = F.sum("nexts")
    base = counts.agg(F.round(-F.log10(v) * UNIT).cast("bigint").alias("base"))
    return BigramModel(counts, buckets, base, BigramWeights(counts.agg(v).first()[0] or 0, k, min_count))


def perplexity(
    texts: DataFrame, model: BigramModel, ids: list[str], text: str = "text"
) -> DataFrame:
    """(ids, perplexity): 10^(-log score / tokens), a line of m tokens counting m + 1.

    Pieces of texts, settled as token numbers, ask the buckets of the model for the counts of their
    distinct bigrams and contexts and then score their texts.
    """
    named = texts.select(*ids, F.col(text).alias("_text"))
    asking = settle(named.mapInArrow(bigrams.packed_pieces(ids), bigrams.ROWS))
    length = F.sum(F.octet_length("data"))
    # With many more texts than the model has seen, several tasks share a bucket.
    copies = max(1, (asking.agg(length).first()[0] or 0) // (model.counts.agg(length).first()[0] or 1))
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy")
    place = F.col("bucket") * copies + F.col("copy")
    scored, step = asking, -(-model.buckets // SLICES)
    for low in range(0, model.buckets, step):
        high = min(low + step, model.buckets)
        known = model.counts.filter(F.col("bucket").between(low, high - 1)).select("bucket", "data", copy).select(
            place.alias("at"), F.lit(bigrams.KNOWN).alias("kind"), F.lit(0).cast("bigint").alias("part"), "data"
        )
        asked = asking.mapInArrow(bigrams.asked_counts(model.buckets, copies, low, high), bigrams.ROWS)
        scored = scored.unionByName(
            settle(_by_place(known.unionByName(asked)).mapInArrow(bigrams.answered_counts(copies), bigrams.ROWS))
        )
    out = StructType([*named.schema.fields[:-1], StructField("hit", LongType()), StructField("m", LongType())])
    scores = bigrams.scored_texts(model.buckets, model.weights, ids)
    sums = _by_place(scored).mapInArrow(scores, out).groupBy(*ids).agg(F.sum("hit").alias("hit"), F.sum("m").alias("m"))
    score = F.col("hit") + F.col("m") * model.base.scalar()
    return sums.select(
        *ids, F.round(F.pow(F.lit(10.0), -score / F.lit(float(UNIT)) / F.col("m")), 1).alias("perplexity")
    )
