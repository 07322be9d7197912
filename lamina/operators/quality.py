"""Diagnostics: label census, preview and context coverage, figure votes, batch totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsonio, labels

# Thresholds for good and moderate.
COVERAGE, PREVIEW_LENGTH, CONTEXT_LENGTH = (0.7, 0.5), (30, 15), (100, 50)


def grade(value: Column, limits: tuple[float, float]) -> Column:
    return F.when(value >= limits[0], "good").when(value >= limits[1], "moderate").otherwise("poor")


def label_census(found: DataFrame) -> DataFrame:
    """label, n, known, from rows with a label; ties in the report's order go by label."""
    known = F.col("label").isin(*labels.LABEL_TYPES)
    return found.groupBy("label").agg(F.count(F.lit(1)).alias("n")).withColumn("known", known)


def unknown_labels(found: DataFrame) -> DataFrame:
    """Distinct labels outside the known table."""
    return found.select("label").distinct().join(F.broadcast(labels.label_table(found.sparkSession)), "label", "left_anti")


def preview_quality(elements: DataFrame) -> DataFrame:
    """Per type and overall (type null): elements, with_preview, coverage, avg_length and grades."""
    size = F.length("text_preview")
    out = elements.rollup("element_type").agg(
        F.count(F.lit(1)).alias("elements"), F.count("text_preview").alias("with_preview"), F.sum(size).alias("total"), F.avg(size).alias("avg_length")
    )
    out = out.withColumn("coverage", F.col("with_preview") / F.col("elements"))
    return out.select(
        "element_type", "elements", "with_preview", F.round("coverage", 6).alias("coverage"), F.round("avg_length", 6).alias("avg_length"),
        grade(F.col("coverage"), COVERAGE).alias("coverage_grade"), grade(F.coalesce("avg_length", F.lit(0.0)), PREVIEW_LENGTH).alias("length_grade"),
    )


def preview_lengths(elements: DataFrame) -> DataFrame:
    """Per type and overall (type null): elements with and without preview, avg, min and max length, 0 where none has one."""
    size = F.length("text_preview")
    return elements.rollup("element_type").agg(
        F.count(F.lit(1)).alias("elements"), F.count("text_preview").alias("with_preview"), F.count_if(F.col("text_preview").isNull()).alias("without_preview"),
        F.round(F.coalesce(F.avg(size), F.lit(0.0)), 6).alias("avg_length"), F.coalesce(F.min(size), F.lit(0)).alias("min_length"), F.coalesce(F.max(size), F.lit(0)).alias("max_length"),
    )


def label_report(found: DataFrame) -> DataFrame:
    """label, n, known of rows with label and place (a sortable position), the most frequent first, of equal counts the earliest."""
    counts = found.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("place"))
    return counts.withColumn("known", F.col("label").isin(*labels.LABEL_TYPES)).orderBy(F.desc("n"), "place")


def type_report(elements: DataFrame) -> DataFrame:
    """element_type and n, by name."""
    return elements.groupBy("element_type").agg(F.count(F.lit(1)).alias("n")).orderBy("element_type")


def context_quality(contexts: DataFrame) -> DataFrame:
    """Per visual type and overall: elements, avg, min and max context length and its grade."""
    size = F.length("context")
    out = contexts.where(labels.is_visual(F.col("element_type"))).rollup("element_type").agg(
        F.count(F.lit(1)).alias("elements"), F.avg(size).alias("avg_length"), F.min(size).alias("min_length"), F.max(size).alias("max_length")
    )
    return out.withColumn("length_grade", grade(F.col("avg_length"), CONTEXT_LENGTH)).withColumn("avg_length", F.round("avg_length", 6))


def figure_vote(responses: DataFrame) -> DataFrame:
    """key, best from rows (key, prompt_type, raw_response): a readable answer counts 1, its type field 2 more, a complex image 1 less.

    Of equal scores the first of graph, diagram, complex_image wins.
    """
    found = responses.withColumn("answer", jsonio.loose_object(F.col("raw_response")))
    field = F.when(F.col("prompt_type") == "graph", F.get_json_object("answer", "$.graph_data.graph_type")).when(
        F.col("prompt_type") == "diagram", F.get_json_object("answer", "$.diagram_data.diagram_type")
    )
    score = F.col("answer").isNotNull().cast("int") + 2 * field.isNotNull().cast("int") - (F.col("prompt_type") == "complex_image").cast("int")
    order = F.array_position(F.array(F.lit("graph"), F.lit("diagram"), F.lit("complex_image")), F.col("prompt_type"))
    scored = found.select("key", "prompt_type", F.struct(score.alias("score"), (-order).alias("order")).alias("rank"))
    return scored.groupBy("key").agg(F.max_by("prompt_type", "rank").alias("best"), F.max("rank.score").alias("score"))


def document_counts(pages: DataFrame, elements: DataFrame, blocks: DataFrame, sections: DataFrame) -> DataFrame:
    """doc_id, pages, elements, blocks, sections: sections counts roots only."""
    by = lambda df, name: df.groupBy("doc_id").agg(F.count(F.lit(1)).alias(name))
    out = by(pages, "pages")
    for df, name in ((elements, "elements"), (blocks, "blocks"), (sections.where("parent_id is null"), "sections")):
        out = out.join(by(df, name), "doc_id", "left")
    return out.na.fill(0, ["elements", "blocks", "sections"])


def batch_summary(results: DataFrame) -> DataFrame:
    """One row from results (status, elapsed): successes, failures, total seconds, mean seconds and minutes of successes."""
    good = F.col("status") == "success"
    return results.agg(
        F.count_if(good).alias("success"), F.count_if(F.col("status") == "failed").alias("failed"), F.round(F.sum("elapsed"), 6).alias("total_seconds"),
        F.round(F.avg(F.when(good, F.col("elapsed"))), 6).alias("mean_seconds"), F.round(F.avg(F.when(good, F.col("elapsed"))) / 60, 6).alias("mean_minutes"),
    )
