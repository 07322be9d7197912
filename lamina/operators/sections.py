"""The section tree as a flat table: headings, parents, members, paths and spans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text


def is_heading(kind: Column, number: Column) -> Column:
    return (kind == "text_section") & number.isNotNull()


def headings(blocks: DataFrame) -> DataFrame:
    """doc_id, section_id, number, title, level, doc_index, heading_block_id of the numbered section blocks."""
    rows = blocks.where(is_heading(F.col("type"), F.col("numbering")))
    return rows.select(
        "doc_id", F.concat(F.lit("sec_"), "id").alias("section_id"), F.col("numbering").alias("number"), F.coalesce("text", F.lit("")).alias("title"),
        text.depth(F.col("numbering")).alias("level"), "doc_index", F.col("id").alias("heading_block_id"),
    )


def parent_at(level: Column, found: Column, order: list[str], key: str = "doc_id", depth: int | None = 6) -> Column:
    """`found` of the nearest earlier heading of a smaller level; null for roots. found: a struct led by doc_index.

    With a bounded depth: the latest heading of each smaller level, of which the latest wins.
    depth None takes the array form, exact at any depth.
    """
    before = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    if depth is None:
        deep = F.collect_list(F.struct(found.alias("f"), level.alias("l"))).over(before)
        return F.array_max(F.transform(F.filter(deep, lambda s: s["l"] < level), lambda s: s["f"]))
    upper = [F.when(level > k, F.last(F.when(level == k, found), ignorenulls=True).over(before)) for k in range(1, depth)]
    return F.greatest(*upper)


def tree(blocks: DataFrame, depth: int = 6) -> DataFrame:
    """headings with parent_id, in one shuffle; documents with deeper levels take the exact array form."""
    rows = headings(blocks).withColumn("deepest", F.max("level").over(Window.partitionBy("doc_id")))
    one = F.struct("doc_index", "section_id")
    near = rows.where(F.col("deepest") <= depth).withColumn("parent", parent_at(F.col("level"), one, ["doc_index"], depth=depth))
    far = rows.where(F.col("deepest") > depth).withColumn("parent", parent_at(F.col("level"), one, ["doc_index"], depth=None))
    return near.unionByName(far).withColumn("parent_id", F.col("parent.section_id")).drop("deepest", "parent")


def members(blocks: DataFrame) -> DataFrame:
    """doc_id, id, doc_index, section_id: the latest heading at or before each block; null before the first."""
    running = Window.partitionBy("doc_id").orderBy("doc_index").rowsBetween(Window.unboundedPreceding, 0)
    heading = F.when(is_heading(F.col("type"), F.col("numbering")), F.concat(F.lit("sec_"), "id"))
    return blocks.select("doc_id", "id", "doc_index", F.last(heading, ignorenulls=True).over(running).alias("section_id"))


def with_blocks(blocks: DataFrame) -> DataFrame:
    """The tree with block_ids in document order."""
    held = members(blocks).where("section_id is not null").groupBy("doc_id", "section_id").agg(F.array_sort(F.collect_list(F.struct("doc_index", "id"))).alias("held"))
    return tree(blocks).join(held.select("doc_id", "section_id", F.col("held.id").alias("block_ids")), ["doc_id", "section_id"], "left")


def spans(blocks: DataFrame, depth: int = 6) -> DataFrame:
    """Beyond parity: first and end doc_index of each section with its subsections, by the next heading of its level or above.

    The nearest later heading of every level runs backwards through the document; documents
    with deeper levels take the exact array form.
    """
    doc = Window.partitionBy("doc_id")
    after = doc.orderBy(F.desc("doc_index")).rowsBetween(Window.unboundedPreceding, -1)
    heading = is_heading(F.col("type"), F.col("numbering"))
    rows = blocks.select("doc_id", "doc_index", "id", heading.alias("heading"), F.when(heading, text.depth(F.col("numbering"))).alias("level"))
    rows = rows.withColumn("end", F.max("doc_index").over(doc) + 1).withColumn("deepest", F.max("level").over(doc)).where("heading")
    near = rows.where(F.col("deepest") <= depth)
    later = [F.when(F.col("level") >= k, F.last(F.when(F.col("level") == k, F.col("doc_index")), ignorenulls=True).over(after)) for k in range(1, depth + 1)]
    near = near.withColumn("next", F.least(*later))
    far = rows.where(F.col("deepest") > depth)
    all_later = F.collect_list(F.struct(F.col("doc_index").alias("i"), F.col("level").alias("l"))).over(after)
    far = far.withColumn("next", F.array_min(F.transform(F.filter(all_later, lambda s: s["l"] <= F.col("level")), lambda s: s["i"])))
    found = near.unionByName(far)
    return found.select("doc_id", F.concat(F.lit("sec_"), "id").alias("section_id"), "level", F.col("doc_index").alias("span_start"), F.coalesce("next", "end").alias("span_end"))


def paths(sections: DataFrame, depth: int = 6) -> DataFrame:
    """Beyond parity: section numbers from the root down to each section, at any depth.

    Of the latest earlier headings of the smaller levels those are ancestors that come after
    all of still smaller levels. Documents with levels beyond depth gather the earlier headings instead.
    """
    before = Window.partitionBy("doc_id").orderBy("doc_index").rowsBetween(Window.unboundedPreceding, -1)
    rows = sections.select("doc_id", "section_id", "doc_index", "level", "number").withColumn("deepest", F.max("level").over(Window.partitionBy("doc_id")))
    own = F.struct(F.col("doc_index").alias("i"), F.col("level").alias("l"), F.col("number").alias("n"))
    latest = [F.when(F.col("level") > k, F.last(F.when(F.col("level") == k, own), ignorenulls=True).over(before)) for k in range(1, depth)]
    near = rows.where(F.col("deepest") <= depth).withColumn("above", F.filter(F.array(*latest), lambda x: x.isNotNull()))
    near = near.withColumn("above", F.filter("above", lambda x, k: ~F.exists(F.slice("above", F.lit(1), k), lambda y: y["i"] > x["i"])))
    start = F.struct(F.col("level").alias("l"), F.array().cast("array<string>").alias("path"))
    climb = lambda s, x: F.when(x["l"] < s["l"], F.struct(x["l"].alias("l"), F.concat(F.array(x["n"]), s["path"]).alias("path"))).otherwise(s)
    far = rows.where(F.col("deepest") > depth).withColumn("earlier", F.reverse(F.collect_list(own).over(before)))
    far = far.withColumn("up", F.aggregate("earlier", start, climb)["path"])
    near = near.withColumn("up", F.transform("above", lambda x: x["n"]))
    return near.select("doc_id", "section_id", "number", "up").unionByName(far.select("doc_id", "section_id", "number", "up")).select(
        "doc_id", "section_id", F.concat("up", F.array("number")).alias("path")
    )
