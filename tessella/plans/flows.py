"""The flows: pages to documents, filtering, and the curation of a whole corpus.

The corpus-wide stages read their input more than once (to count, to look up and to
apply), so a chain of them would repeat its beginning many times over. `cut` is called
with each table that is read again; by default it checkpoints it in the shared folder,
and it may as well write a table and return that.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.constants import END_OF_DOCUMENT, PARAGRAPH_SEPARATOR
from tessella.operators import cleanup, dedup, filters, html
from tessella.operators.models import BigramModel, LanguageModel, identify_language, perplexity
from tessella.operators.nodes import drop_paragraphs, full_text, paragraph_table
from tessella.plans.options import DOCUMENT_CHECKS, PARAGRAPH_CHECKS, ImageChecks, TextChecks
from tessella.sources.dom import build_dom_nodes
from tessella.sources.storage import settle

Cut = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Models:
    language: LanguageModel | None = None
    perplexity: BigramModel | None = None


def pages_to_documents(pages: DataFrame) -> DataFrame:
    """Web documents of pages with url and html; one narrow stage."""
    return html.pack_documents(build_dom_nodes(pages.withColumn("html", html.clean_html(F.col("html")))))


def failed_by_models(texts: DataFrame, ids: list[str], text: str, checks: TextChecks, models: Models) -> DataFrame:
    """(ids) of the texts that fail the language or the perplexity check.

    A check with a bound needs its model; `checks.without_models()` leaves both out.
    Perplexities are made only of texts that pass the language check.
    """
    if checks.min_language_score is not None and models.language is None:
        raise ValueError("the language check has a bound and no model")
    if checks.max_perplexity is not None and models.perplexity is None:
        raise ValueError("the perplexity check has a bound and no model")
    failed = texts.select(*ids).limit(0)
    if checks.min_language_score is not None:
        wrong = (F.col("lang_pred") != checks.language) | (F.col("lang_score") < checks.min_language_score)
        failed = settle(identify_language(texts, models.language, ids, text).filter(wrong).select(*ids))
        # A text without an id stays, as it equals no failed one.
        texts = texts.join(failed, ids, "left_anti") if checks.max_perplexity is not None else texts
    if checks.max_perplexity is not None:
        high = F.col("perplexity") > checks.max_perplexity
        failed = failed.unionByName(perplexity(texts, models.perplexity, ids, text).filter(high).select(*ids))
    return failed.distinct()


def filter_corpus(
    docs: DataFrame,
    models: Models = Models(),
    paragraph_checks: TextChecks = PARAGRAPH_CHECKS,
    document_checks: TextChecks = DOCUMENT_CHECKS,
    image_checks: ImageChecks = ImageChecks(),
    similarity: int | None = 80,
    separator: str = PARAGRAPH_SEPARATOR,
    cut: Cut = settle,
) -> DataFrame:
    """Paragraph checks, similar texts, document checks; the checks with models come last at each level."""
    docs = filters.filter_paragraphs(docs, paragraph_checks, image_checks, separator)
    if paragraph_checks != paragraph_checks.without_models():
        docs = cut(docs)
        pars = paragraph_table(docs, separator=separator).filter(F.col("paragraph") != END_OF_DOCUMENT)
        failed = failed_by_models(pars, ["doc_id", "node", "par"], "paragraph", paragraph_checks, models)
        docs = drop_paragraphs(docs, failed, separator, drop_empty=True)
    if similarity is not None:
        docs = dedup.dedup_similar_nodes(cut(docs), similarity)
    docs = filters.filter_documents(docs, document_checks, image_checks, separator)
    if document_checks != document_checks.without_models():
        docs = cut(docs)
        texts = docs.select("doc_id", full_text(F.col("nodes"), separator).alias("text"))
        docs = docs.join(failed_by_models(texts, ["doc_id"], "text", document_checks, models), "doc_id", "left_anti")
    return docs


def curate(
    docs: DataFrame,
    unsafe: DataFrame | None = None,
    opted_out: DataFrame | None = None,
    separator: str = PARAGRAPH_SEPARATOR,
    cut: Cut = settle,
) -> dict[str, DataFrame]:
    """Corpus-wide removal stages in their order, by name; the last one is the result."""
    stages = {"input": cut(docs)}

    def add(name: str, df: DataFrame) -> None:
        stages[name] = cut(df)

    def last() -> DataFrame:
        return next(reversed(stages.values()))

    add("frequent_images", dedup.dedup_frequent_images(last()))
    if unsafe is not None:
        add("unsafe_images", filters.drop_unsafe_image_docs(last(), unsafe))
    add("url", dedup.dedup_by_url(last()))
    add("paragraphs", dedup.dedup_paragraphs_by_domain(last(), separator=separator))
    add("final_cleaning", cleanup.final_cleaning(last(), separator))
    add("image_sets", dedup.dedup_by_image_set(last()))
    if opted_out is not None:
        add("opt_out", filters.remove_listed_images(last(), opted_out))
    add("final_processing", cleanup.final_processing(last(), separator))
    return stages
