"""Documents as one nested value: assembly, reading back with defaults, export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from . import sections

VERSION, UNKNOWN_VERSION = "1.0.0", "0.0.0"
BOX = "struct<x1:double,y1:double,x2:double,y2:double,page:int>"
COMMON = "keywords:array<string>,summary:string,image_id:string"
TEXT = "struct<numbering:string,keywords:array<string>,summary:string>"
TABLE = f"struct<doc_index:int,rows:int,cols:int,data:array<array<string>>,markdown:string,{COMMON},is_complex:boolean>"
GRAPH = f"struct<title:string,graph_type:string,x_axis:map<string,string>,y_axis:map<string,string>,legend:array<string>,data_trends:array<string>,{COMMON}>"
DIAGRAM = (
    "struct<id:string,doc_index:int,diagram_type:string,components:array<struct<id:string,label:string>>,"
    f"connections:array<struct<`from`:string,`to`:string>>,mermaid:string,{COMMON},is_complex:boolean,bbox:{BOX}>"
)
PICTURE = "struct<underlying_type:string,visible_text:string,keywords:array<string>,complexity_reasons:array<string>,summary:string,image_id:string>"
BLOCK = (
    f"struct<id:string,type:string,doc_index:int,text:string,level:int,page:int,bbox:{BOX},text_data:{TEXT},"
    f"table:{TABLE},graph:{GRAPH},diagram:{DIAGRAM},complex_image:{PICTURE}>"
)
SECTION = "struct<id:string,number:string,title:string,level:int,doc_index:int,span:array<int>,parent_id:string,block_ids:array<string>,heading_block_id:string>"
DOCUMENT = f"version string, metadata struct<page_count:int,extra:map<string,string>>, blocks array<{BLOCK}>, sections array<{SECTION}>"


def with_sections(documents: DataFrame) -> DataFrame:
    """documents (held: blocks in order, structs of b and number) with sections: the same rows as sections.with_blocks.

    A section's blocks are the run from its heading to the next one, so each is a slice. The
    headings and ids are columns of their own, which keeps them from being computed per section.
    """
    at = F.transform("held", lambda x, i: F.struct(i.alias("i"), x["b"].alias("b"), x["number"].alias("number")))
    found = F.filter(at, lambda x: sections.is_heading(x["b"]["type"], x["number"]))
    head = lambda x: F.struct(x["i"].alias("i"), text.depth(x["number"]).alias("level"), x["b"]["id"].alias("id"), x["b"]["doc_index"].alias("doc_index"), x["b"]["text"].alias("text"), x["number"].alias("number"))
    rows = documents.withColumn("heads", F.transform(found, head)).withColumn("ids", F.col("held.b.id"))
    heads, name = F.col("heads"), lambda h: F.concat(F.lit("sec_"), h["id"])

    def section(h: Column, k: Column) -> Column:
        above = F.filter(F.slice(heads, F.lit(1), k), lambda x: x["level"] < h["level"])
        end = F.coalesce(F.get(heads, k + 1)["i"], F.size("ids"))
        return F.struct(
            name(h).alias("id"), h["number"].alias("number"), F.coalesce(h["text"], F.lit("")).alias("title"), h["level"].alias("level"), h["doc_index"].alias("doc_index"),
            F.array(h["doc_index"], h["doc_index"] + 1).alias("span"), name(F.try_element_at(above, F.lit(-1))).alias("parent_id"),
            F.slice("ids", h["i"] + 1, end - h["i"]).alias("block_ids"), h["id"].alias("heading_block_id"),
        )

    return rows.withColumn("sections", F.transform(heads, section)).drop("heads", "ids")


def assemble(blocks: DataFrame, page_counts: DataFrame) -> DataFrame:
    """doc_id, version, metadata, blocks, sections: one row per document, sections flat in document order.

    Blocks are gathered once per document; the sections come from the gathered array.
    """
    in_order = lambda a, b: a["b"]["doc_index"] - b["b"]["doc_index"]  # noqa: E731  (payloads hold maps, which have no order of their own)
    own = [c for c in blocks.columns if c not in ("doc_id", "title_full", "numbering")]
    one = F.struct(F.struct(*own).alias("b"), F.col("numbering").alias("number"))
    held = blocks.groupBy("doc_id").agg(F.array_sort(F.collect_list(one), in_order).alias("held"))
    none = F.array().cast(f"array<{SECTION}>")
    return with_sections(page_counts.join(held, "doc_id", "left")).select(
        "doc_id", F.lit(VERSION).alias("version"), F.struct(F.col("page_count"), F.create_map().cast("map<string,string>").alias("extra")).alias("metadata"),
        F.coalesce(F.col("held.b"), F.array()).alias("blocks"), F.coalesce("sections", none).alias("sections"),
    )


def element_json(elements: DataFrame) -> DataFrame:
    """doc_id, element_id, json of every element: its place, type, box, confidence and preview."""
    own = ["element_id", "element_type", "bbox", "confidence", "text_preview"]
    return elements.select("doc_id", "element_id", F.to_json(F.struct(*own), {"ignoreNullFields": "false"}).alias("json"))


def page_json(elements: DataFrame) -> DataFrame:
    """doc_id, page_num, json of every page with elements, these in order."""
    one = F.struct("elem_idx", F.struct("element_id", "element_type", "bbox", "confidence", "text_preview").alias("e"))
    held = elements.groupBy("doc_id", "page_num").agg(F.array_sort(F.collect_list(one)).alias("held"))
    return held.select("doc_id", "page_num", F.to_json(F.struct("page_num", F.col("held.e").alias("elements")), {"ignoreNullFields": "false"}).alias("json"))


def to_json(documents: DataFrame) -> DataFrame:
    """doc_id, json."""
    return documents.select("doc_id", F.to_json(F.struct("version", "metadata", "blocks", "sections")).alias("json"))


def from_json(rows: DataFrame) -> DataFrame:
    """Documents of rows (doc_id, json): version, section level, index and span have defaults; unknown types pass through.

    The document comes out of a generator, below which no filter on its parts (as explode adds one) is
    pushed; it would read, and make, every JSON text a second time.
    """
    d = rows.select("doc_id", F.explode(F.array(F.from_json("json", DOCUMENT))).alias("d"))

    def section(s):
        index = F.coalesce(s["doc_index"], F.lit(0))
        return s.withField("level", F.coalesce(s["level"], F.lit(1))).withField("doc_index", index).withField("span", F.coalesce(s["span"], F.array(index, index + 1)))

    return d.select(
        "doc_id", F.coalesce("d.version", F.lit(UNKNOWN_VERSION)).alias("version"), F.col("d.metadata").alias("metadata"),
        F.coalesce("d.blocks", F.array().cast(f"array<{BLOCK}>")).alias("blocks"), F.transform(F.coalesce("d.sections", F.array().cast(f"array<{SECTION}>")), section).alias("sections"),
    )


def nested(flat: list[dict]) -> list[dict]:
    """The sections of one document as a tree, for the pretty export of a single file."""
    by = {s["id"]: {k: v for k, v in s.items() if k != "parent_id"} | {"subsections": []} for s in flat}
    roots = []
    for s in flat:
        (by[s["parent_id"]]["subsections"] if s.get("parent_id") in by else roots).append(by[s["id"]])
    return roots
