"""Second-pass answers: prompts per element, and strict parsing of the JSON that comes back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import jsonio, labels

#: Own wording. The first pass asks for markup; the second for one JSON object per element.
FIRST_PASS = "Transcribe this page as markdown and mark every element with its label and its box."
NO_CONTEXT = "No text was found near this element."
_COMMON = '{"items": [text], "keywords": [text], "summary": text'
_ASK = "Text near the element:\n{context}\n\nDescribe the %s in the picture. Answer with one JSON object only: %s}"
PROMPTS = {
    "text_header": _ASK % ("heading", _COMMON),
    "text_section": _ASK % ("section heading, its number as the first item and its title as the second,", _COMMON),
    "text_paragraph": _ASK % ("paragraph", _COMMON),
    "table": _ASK % ("table", _COMMON + ', "markdown": text, "complexity": "simple" or "complex", "complexity_reason": text'),
    "graph": _ASK % ("graph", _COMMON + ', "graph_data": {"title": text, "graph_type": text, "x_axis": {"label": text, "unit": text}, "y_axis": {"label": text, "unit": text}, "legend": [text], "trends": [text]}'),
    "diagram": _ASK % ("diagram", _COMMON + ', "diagram_data": {"diagram_type": text, "components": [{"id": text, "label": text}], "connections": [{"from": text, "to": text}], "mermaid": text, "complexity": "simple" or "complex", "complexity_reason": text}'),
    "complex_image": _ASK % ("picture", _COMMON + ', "complexity_data": {"underlying_type": text, "visible_text": text, "complexity_reasons": [text]}'),
}

#: Whole-page prompts for trying a model out, beside the two passes.
AD_HOC = {
    "plain_text": "Write down all text of this page.",
    "markdown": FIRST_PASS,
    "page_summary": 'Describe the page. Answer with one JSON object only: {"title": text, "sections": [text], "tables": [text], "figures": [text], "summary": text}',
}

ANSWER = "items array<string>, keywords array<string>, summary string"
GRAPH = "graph_data struct<title:string,graph_type:string,x_axis:map<string,string>,y_axis:map<string,string>,legend:array<string>,trends:array<string>>"
DIAGRAM = (
    "diagram_data struct<diagram_type:string,components:array<struct<id:string,label:string>>,connections:array<struct<`from`:string,`to`:string>>,"
    "mermaid:string,complexity:string,complexity_reason:string>"
)
COMPLEX = "complexity_data struct<underlying_type:string,visible_text:string,complexity_reasons:array<string>>"
TABLE = "markdown string, complexity string, complexity_reason string"


def prompt_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(PROMPTS.items()), "element_type string, template string")


def prompt(kind: Column, context: Column) -> Column:
    """The prompt of an element type with its context filled in; an unknown type is an error."""
    template = F.try_element_at(F.create_map(*[F.lit(x) for pair in PROMPTS.items() for x in pair]), kind)
    filled = F.replace(template, F.lit("{context}"), F.when(F.coalesce(context, F.lit("")) == "", NO_CONTEXT).otherwise(context))
    return F.when(kind.isin(*labels.ELEMENT_TYPES), filled).otherwise(F.raise_error(F.concat(F.lit("no prompt for the type "), F.coalesce(kind, F.lit("null")))))


def with_prompts(contexts: DataFrame) -> DataFrame:
    return contexts.withColumn("prompt", prompt(F.col("element_type"), F.col("context")))


def figure_prompts(elements: DataFrame) -> DataFrame:
    """Each figure once per visual prompt, to find out which one suits it."""
    return elements.withColumn("prompt_type", F.explode(F.array(F.lit("graph"), F.lit("diagram"), F.lit("complex_image"))))


def page_prompts(pages: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Each page once per whole-page prompt."""
    chosen = {n: AD_HOC[n] for n in names or AD_HOC}
    one = F.array(*[F.struct(F.lit(n).alias("prompt_name"), F.lit(t).alias("prompt")) for n, t in chosen.items()])
    return pages.withColumn("_p", F.explode(one)).select(*pages.columns, "_p.prompt_name", "_p.prompt")


def without_end(response: Column, token: str) -> Column:
    """A response without the end token."""
    return F.replace(response, F.lit(token), F.lit(""))


def parse(responses: DataFrame) -> DataFrame:
    """doc_id, element_id, element_type, answer_idx, valid, items, keywords, summary, structured_data, raw_response.

    answer_idx, which orders the answers to one element, is kept where there is one.

    Only a strict JSON object is valid; any other answer, a bare list too, keeps its raw text
    with empty fields. The fields are a column of their own, which keeps them from being read once each.
    """
    rows = responses.withColumn("structured_data", jsonio.strict_object("raw_response")).withColumn("_a", F.from_json("structured_data", ANSWER))
    a = F.col("_a")
    empty = F.array().cast("array<string>")
    return rows.select(
        *[c for c in ("doc_id", "element_id", "element_type", "answer_idx") if c in responses.columns],
        F.col("structured_data").isNotNull().alias("valid"),
        F.coalesce(a["items"], empty).alias("items"), F.coalesce(a["keywords"], empty).alias("keywords"), a["summary"].alias("summary"),
        "structured_data", "raw_response",
    )
