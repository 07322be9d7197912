"""The whole flow: page markup to elements, contexts, answers, blocks, sections and documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators import answers, blocks, context, docjson, grounding, quality, sections


def requests(pages: DataFrame) -> DataFrame:
    """Second-pass prompts of the pages' elements, with their contexts."""
    return answers.with_prompts(context.spatial(grounding.parse(pages)))


def documents(pages: DataFrame, responses: DataFrame) -> DataFrame:
    """Documents from pages with markup and recorded answers (doc_id, element_id, raw_response); of several answers the last by answer_idx."""
    found = blocks.assemble(grounding.parse(pages), blocks.latest(answers.parse(responses)))
    return docjson.assemble(found, pages.groupBy("doc_id").agg(F.count(F.lit(1)).cast("int").alias("page_count")))


def run(pages: DataFrame, infer: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """documents with a live provider: infer adds raw_response to prompts."""
    return documents(pages, infer(requests(pages)))


def report(pages: DataFrame, responses: DataFrame) -> DataFrame:
    """Counts of each document."""
    elements = grounding.parse(pages)
    found = blocks.assemble(elements, blocks.latest(answers.parse(responses)))
    return quality.document_counts(pages, elements, found, sections.tree(found))
