"""Grounding markup to elements, and the filters over elements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry, labels, text

# Fixed value: a label tag pair followed at once by a box tag pair.
TAGS = r"(?s)<\|ref\|>(.*?)<\|/ref\|><\|det\|>(.*?)<\|/det\|>"
NUMBER = r"^[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"


def tagged(markup: Column) -> Column:
    """array of struct(label, box, body) in order: body is the text up to the next pair."""
    return F.arrays_zip(
        F.regexp_extract_all(markup, F.lit(TAGS), F.lit(1)).alias("label"),
        F.regexp_extract_all(markup, F.lit(TAGS), F.lit(2)).alias("box"),
        _bodies(markup).alias("body"),
    )


def _bodies(markup: Column) -> Column:
    parts = F.split(markup, TAGS, -1)
    return F.slice(parts, F.lit(2), F.size(parts))


def coordinates(box: Column) -> Column:
    """The numbers of a box's first bracket group; null when any part is no number."""
    group = F.regexp_extract(labels.strip(box), r"^[\[\s]*([^\[\]]*)", 1)
    parts = F.filter(F.transform(F.split(group, ","), labels.strip), lambda p: p != "")
    read = lambda ps: F.when(F.forall(ps, lambda p: F.rlike(p, F.lit(NUMBER))), F.transform(ps, lambda p: p.try_cast("double")))
    return F.get(F.transform(F.array(parts), read), F.lit(0))  # the parts are found once for both uses


def parse(pages: DataFrame) -> DataFrame:
    """Elements of pages (doc_id, page_num, width, height, raw_response).

    Pairs with fewer than four coordinates or with a part that is no number are dropped but
    keep their place in the numbering. One pass over each page; no shuffle.
    """
    read = lambda t: F.struct(t["label"].alias("label"), coordinates(t["box"]).alias("xy"), t["body"].alias("body"))  # noqa: E731  (before the filter, which would else read boxes again)
    found = pages.select("doc_id", "page_num", "width", "height", F.posexplode(F.transform(tagged(F.col("raw_response")), read)).alias("elem_idx", "tag"))
    found = found.select("*", F.col("tag.xy").alias("xy")).where(F.size("xy") >= 4).withColumn("label", labels.normal_label(F.col("tag.label")))
    at = lambda k, size: geometry.rescale(F.get(F.col("xy"), F.lit(k)), F.col(size)).cast("double")
    return found.select(
        "doc_id", "page_num", "elem_idx",
        F.concat(F.lit("page_"), F.col("page_num"), F.lit("_e"), F.col("elem_idx")).alias("element_id"),
        "label", labels.element_type(F.col("label")).alias("element_type"),
        F.struct(at(0, "width").alias("x1"), at(1, "height").alias("y1"), at(2, "width").alias("x2"), at(3, "height").alias("y2"), F.col("page_num").alias("page")).alias("bbox"),
        F.lit(1.0).alias("confidence"),
        text.preview(F.col("tag.body")).alias("text_preview"),
        F.col("height").alias("page_height"),
    )


def raw_labels(pages: DataFrame) -> DataFrame:
    """Stripped labels as written, one row per pair."""
    return pages.select("doc_id", "page_num", F.explode(F.regexp_extract_all("raw_response", F.lit(TAGS), F.lit(1))).alias("tag")).select(
        "doc_id", "page_num", labels.strip(F.col("tag")).alias("label")
    )


def parse_json(pages: DataFrame) -> DataFrame:
    """Elements of pages whose answer is the JSON form {elements: [{element_type, bbox, ...}]}.

    Elements without a known type or with fewer than four box numbers are dropped; ids default
    to the place in the list, confidence to 1.
    """
    schema = "elements array<struct<element_id:string,element_type:string,bbox:array<double>,confidence:double,text_preview:string>>"
    found = pages.select("doc_id", "page_num", F.posexplode(F.from_json("raw_response", schema)["elements"]).alias("elem_idx", "e"))
    found = found.where(F.col("e.element_type").isin(*labels.ELEMENT_TYPES) & (F.size("e.bbox") >= 4))
    at = lambda k: F.get(F.col("e.bbox"), F.lit(k))
    return found.select(
        "doc_id", "page_num", "elem_idx", F.coalesce("e.element_id", F.concat(F.lit("e"), F.col("elem_idx"))).alias("element_id"), F.col("e.element_type").alias("element_type"),
        F.struct(at(0).alias("x1"), at(1).alias("y1"), at(2).alias("x2"), at(3).alias("y2"), F.col("page_num").alias("page")).alias("bbox"),
        F.coalesce("e.confidence", F.lit(1.0)).alias("confidence"), F.col("e.text_preview").alias("text_preview"),
    )


def visual(elements: DataFrame) -> DataFrame:
    return elements.where(labels.is_visual(F.col("element_type")))


def textual(elements: DataFrame) -> DataFrame:
    return elements.where(labels.is_text(F.col("element_type")))


def on_pages(elements: DataFrame, first: int, last: int) -> DataFrame:
    return elements.where(F.col("page_num").between(first, last))
