"""Whole flows as queries."""

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from tessella.catalog.document_queries import DOCUMENTS, LINE, PARAGRAPHS, _unsafe, rendered
from tessella.catalog.page_queries import written_pages
from tessella.catalog.registry import register
from tessella.catalog.views import table, web_docs
from tessella.operators import models, profile
from tessella.plans import flows


@register("flow_pages_to_filtered")
def pages_to_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written from the documents, made into documents again and filtered with both models."""
    docs = flows.pages_to_documents(written_pages(spark, sf_dir))
    corpus = table(spark, sf_dir, "documents")
    trained = flows.Models(models.train_language_model(corpus), models.train_bigram_model(corpus))
    paragraphs = replace(PARAGRAPHS, language="en", min_language_score=0.5, max_perplexity=2200)
    documents = replace(DOCUMENTS, language="en", min_language_score=0.85, max_perplexity=1900)
    return rendered(flows.filter_corpus(docs, trained, paragraphs, documents))


@register("flow_curate")
def curate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All corpus-wide stages, reported stage by stage."""
    docs = web_docs(spark, sf_dir, markers=True)
    return profile.stage_report(flows.curate(docs, unsafe=_unsafe(spark, sf_dir), separator=LINE))
