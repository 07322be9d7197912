"""Content blocks: elements with their answers, in document order, with a payload per type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import jsonio, labels, text
from . import answers


def image_id(kind: Column, page: Column, index: Column) -> Column:
    return F.format_string("%s_p%d_e%d", kind, page, index)


def latest(analyses: DataFrame, order: str = "answer_idx") -> DataFrame:
    """One analysis per element: the last by order, where there are several.

    Without such a column several analyses of one element are an error, for none of them is the last.
    """
    if order not in analyses.columns:
        several = F.count(F.lit(1)).over(Window.partitionBy("doc_id", "element_id")) > 1
        told = F.raise_error(F.concat(F.lit("several answers but no order: "), F.coalesce("element_id", F.lit("null"))))
        return analyses.withColumn("_one", F.when(several, told).otherwise(F.lit(None).cast("void"))).where("_one is null").drop("_one")
    last = Window.partitionBy("doc_id", "element_id").orderBy(F.desc(order))
    return analyses.withColumn("_nth", F.row_number().over(last)).where("_nth = 1").drop("_nth")


def indexed(elements: DataFrame, analyses: DataFrame) -> DataFrame:
    """Elements that have an analysis, with doc_index counted over them in page and element order."""
    own = analyses.drop("element_type")
    order = Window.partitionBy("doc_id").orderBy("page_num", "elem_idx")
    return elements.join(own, ["doc_id", "element_id"]).withColumn("doc_index", (F.row_number().over(order) - 1).cast("int"))


def assemble(elements: DataFrame, analyses: DataFrame) -> DataFrame:
    """Blocks: id, type, doc_index, text, title_full, numbering, level, page, bbox and one payload per type."""
    rows = indexed(elements, analyses)
    kind, data = F.col("element_type"), F.col("structured_data")
    empty = F.array().cast("array<string>")
    rows = rows.withColumn("text", F.get("items", F.lit(0))).withColumn("title_full", F.get("items", F.lit(1)))
    rows = rows.withColumn("numbering", F.when(labels.is_text(kind), text.numbering(F.col("text"))))
    rows = rows.withColumn("level", F.when((kind == "text_section") & F.col("numbering").isNotNull(), text.depth(F.col("numbering"))))
    rows = rows.withColumn("image_id", F.when(labels.is_visual(kind), image_id(kind, F.col("page_num"), F.col("doc_index"))))
    common = [F.col("keywords"), F.col("summary"), F.col("image_id")]
    # A payload is a column of its own, which keeps it from being read once a field.
    read = {"graph": (answers.GRAPH, "graph_data"), "diagram": (answers.DIAGRAM, "diagram_data"), "complex_image": (answers.COMPLEX, "complexity_data")}
    rows = rows.withColumns({f"_{k}": F.when(kind == k, F.from_json(data, schema)[name]) for k, (schema, name) in read.items()})
    graph, diagram, other = (F.col(f"_{k}") for k in read)
    none = F.create_map().cast("map<string,string>")
    text_data = F.struct("numbering", "keywords", "summary")
    table = F.struct(
        F.col("doc_index"), F.lit(0).alias("rows"), F.lit(0).alias("cols"), F.array().cast("array<array<string>>").alias("data"), jsonio.field(data, "$.markdown").alias("markdown"),
        *common, (F.coalesce(jsonio.field(data, "$.complexity"), F.lit("")) == "complex").alias("is_complex"),
    )
    graph_data = F.struct(
        graph["title"].alias("title"), F.coalesce(graph["graph_type"], F.lit("unknown")).alias("graph_type"), F.coalesce(graph["x_axis"], none).alias("x_axis"),
        F.coalesce(graph["y_axis"], none).alias("y_axis"), F.coalesce(graph["legend"], empty).alias("legend"), F.coalesce(graph["trends"], empty).alias("data_trends"), *common,
    )
    diagram_data = F.struct(
        F.col("element_id").alias("id"), F.col("doc_index"), F.coalesce(diagram["diagram_type"], F.lit("unknown")).alias("diagram_type"),
        F.coalesce(diagram["components"], F.array().cast("array<struct<id:string,label:string>>")).alias("components"),
        F.coalesce(diagram["connections"], F.array().cast("array<struct<from:string,to:string>>")).alias("connections"), diagram["mermaid"].alias("mermaid"),
        *common, (F.coalesce(diagram["complexity"], F.lit("")) == "complex").alias("is_complex"), F.col("bbox"),
    )
    image = F.struct(
        F.coalesce(other["underlying_type"], F.lit("unknown")).alias("underlying_type"), other["visible_text"].alias("visible_text"), F.col("keywords"),
        F.coalesce(other["complexity_reasons"], empty).alias("complexity_reasons"), F.col("summary"), F.col("image_id"),
    )
    return rows.select(
        "doc_id", F.col("element_id").alias("id"), kind.alias("type"), "doc_index", "text", "title_full", "numbering", "level", F.col("page_num").alias("page"), "bbox",
        F.when(labels.is_text(kind), text_data).alias("text_data"), F.when(kind == "table", table).alias("table"), F.when(kind == "graph", graph_data).alias("graph"),
        F.when(kind == "diagram", diagram_data).alias("diagram"), F.when(kind == "complex_image", image).alias("complex_image"),
    )


def table_cells(markdown: Column) -> Column:
    """Beyond parity: the rows of a markdown table as an array of arrays, without the rule below the head."""
    lines = F.filter(F.transform(F.split(markdown, "\n"), labels.strip), lambda x: F.startswith(x, F.lit("|")))
    lines = F.filter(lines, lambda x: ~F.rlike(x, F.lit(r"^\|[\s:|-]+\|?$")))
    return F.transform(lines, lambda x: F.transform(F.split(F.regexp_replace(x, r"^\||\|$", ""), r"\|"), labels.strip))
