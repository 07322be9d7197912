"""Layout labels and the seven element types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Element types in their order, and the labels with a type of their own.
ELEMENT_TYPES = ("text_header", "text_section", "text_paragraph", "table", "graph", "diagram", "complex_image")
TEXT_TYPES = ("text_header", "text_section", "text_paragraph")
VISUAL_TYPES = ("table", "graph", "diagram", "complex_image")
LABEL_TYPES = {
    "title": "text_header",
    "heading": "text_header",
    "section-header": "text_section",
    "section_header": "text_section",
    "text": "text_paragraph",
    "paragraph": "text_paragraph",
    "table": "table",
    "graph": "graph",
    "chart": "graph",
    "plot": "graph",
    "figure": "diagram",
    "diagram": "diagram",
    "flowchart": "diagram",
    "image": "complex_image",
    "photo": "complex_image",
    "picture": "complex_image",
}
#: For other labels, the first row with a contained word decides.
CONTAINED = (
    (("title", "header", "heading"), "text_header"),
    (("section",), "text_section"),
    (("table",), "table"),
    (("graph", "chart", "plot"), "graph"),
    (("diagram", "flow"), "diagram"),
    (("image", "figure", "photo"), "complex_image"),
)
DEFAULT_TYPE = "text_paragraph"


def strip(text: Column) -> Column:
    """text without Unicode white space at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def normal_label(label: Column) -> Column:
    return F.lower(strip(label))


def element_type(label: Column) -> Column:
    """The element type of a normalised label: the exact table, then contained words, then the default."""
    exact = F.create_map(*[F.lit(x) for pair in LABEL_TYPES.items() for x in pair])
    rules = F.lit(DEFAULT_TYPE)
    for words, kind in reversed(CONTAINED):
        hit = F.lit(False)
        for w in words:
            hit = hit | F.contains(label, F.lit(w))
        rules = F.when(hit, kind).otherwise(rules)
    return F.coalesce(F.try_element_at(exact, label), rules)


def is_text(kind: Column) -> Column:
    return kind.isin(*TEXT_TYPES)


def is_visual(kind: Column) -> Column:
    return kind.isin(*VISUAL_TYPES)


def is_figure_label(label: Column) -> Column:
    """Labels that say figure in some form."""
    return F.contains(F.lower(label), F.lit("fig"))


def type_ordinal(kind: Column) -> Column:
    """Position of a type in the fixed order, for stable sorting; null for unknown types."""
    at = F.array_position(F.array(*[F.lit(t) for t in ELEMENT_TYPES]), kind)
    return F.nullif(at, F.lit(0)).cast("int")


def label_table(spark: SparkSession) -> DataFrame:
    """label, element_type: the exact table as a lookup of fixed size."""
    return spark.createDataFrame(list(LABEL_TYPES.items()), "label string, element_type string")
