"""Text around an element: by distance on the page, or by place in the element list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry, labels

BUDGET, LEAST_CUT, RADIUS, WINDOW = 500, 20, 0.2, 2
#: Own wording of the two answers when there is nothing around an element.
NOT_FOUND, NOTHING = "The element has no surroundings on this page.", "The elements around it hold no text."


def _pages(elements: DataFrame) -> DataFrame:
    """One row per page: its elements in order. The only shuffle of both contexts."""
    one = F.struct("elem_idx", "element_id", "element_type", geometry.center_y(F.col("bbox")).alias("y"), "text_preview", "page_height")
    return elements.groupBy("doc_id", "page_num").agg(F.array_sort(F.collect_list(one)).alias("all"))


def within_budget(lines: Column, budget: int = BUDGET) -> Column:
    """Lines joined by newlines while their total length fits; the first that does not is cut if enough of it fits."""
    start = F.struct(F.lit(0).alias("used"), F.lit(True).alias("open"), F.array().cast("array<string>").alias("kept"))

    def add(s: Column, line: Column) -> Column:
        rest = F.lit(budget) - s["used"]
        fits = F.length(line) <= rest
        cut = F.concat(F.left(line, rest), F.lit("..."))
        kept = F.when(~s["open"], s["kept"]).when(fits, F.concat(s["kept"], F.array(line))).when(rest > LEAST_CUT, F.concat(s["kept"], F.array(cut))).otherwise(s["kept"])
        return F.struct(F.when(s["open"] & fits, s["used"] + F.length(line)).otherwise(s["used"]).alias("used"), (s["open"] & fits).alias("open"), kept.alias("kept"))

    return F.aggregate(lines, start, add, lambda s: F.array_join(s["kept"], "\n"))


def spatial(elements: DataFrame, radius: float = RADIUS, budget: int = BUDGET) -> DataFrame:
    """doc_id, page_num, elem_idx, element_id, element_type, context, nearby: text of the nearest text elements.

    Nearest by vertical centre within radius of the page height, ties by place; elements
    without preview are skipped and use no budget.
    """

    def around(e: Column) -> Column:
        near = F.filter(F.col("all"), lambda o: o["element_type"].isin(*labels.TEXT_TYPES) & (o["elem_idx"] != e["elem_idx"]) & (F.abs(o["y"] - e["y"]) <= e["page_height"] * F.lit(radius)))
        return F.array_sort(F.transform(near, lambda o: F.struct(F.abs(o["y"] - e["y"]).alias("far"), o["elem_idx"], o["element_type"], o["text_preview"])))

    rows = _pages(elements).select("doc_id", "page_num", F.explode("all").alias("e"), "all")
    rows = rows.withColumn("near", around(F.col("e")))
    told = F.filter(F.col("near"), lambda o: o["text_preview"].isNotNull())
    lines = F.transform(told, lambda o: F.concat(F.lit("["), o["element_type"], F.lit("] "), o["text_preview"]))
    return rows.select("doc_id", "page_num", "e.elem_idx", "e.element_id", "e.element_type", within_budget(lines, budget).alias("context"), F.size("near").alias("nearby"))


def positional(elements: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, page_num, elem_idx, element_id, element_type, context: the elements up to window places before and after."""
    rows = _pages(elements).select("doc_id", "page_num", F.posexplode("all").alias("pos", "e"), "all")
    first = F.greatest(F.lit(0), F.col("pos") - window)
    near = F.slice(F.col("all"), first + 1, F.col("pos") + window - first + 1)

    def line(o: Column) -> Column:
        own = F.concat(F.lit("[CURRENT ELEMENT: "), o["element_type"], F.lit("]"))
        return F.when(o["elem_idx"] == F.col("e.elem_idx"), own).when(o["text_preview"].isNotNull(), F.concat(o["element_type"], F.lit(": "), o["text_preview"]))

    lines = F.filter(F.transform(near, line), lambda x: x.isNotNull())
    joined = F.when(F.size(lines) == 0, NOTHING).otherwise(F.array_join(lines, "\n"))
    return rows.select("doc_id", "page_num", "e.elem_idx", "e.element_id", "e.element_type", joined.alias("context"))
