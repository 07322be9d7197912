"""Section numbers, keywords and sentence-aware chunks."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .labels import strip

# Korean function words that are no keywords.
STOPWORDS = (
    "및 등 것 그 이 저 수 때 내 외 또는 그리고 하는 되는 있는 없는 위한 위해 경우 대한 통해 따라 에서 으로 에게 에 를 을 가 은 는 의 와 과"
).split()
NUMBER = r"(?U)^(\d+(?:\.\d+)*)"


def numbering(text: Column) -> Column:
    """Leading section number: one ended by a point, else by a bracket, else by white space; null if none."""
    found = [F.nullif(F.regexp_extract(strip(text), NUMBER + end, 1), F.lit("")) for end in (r"\.", r"\)", r"\s")]
    return F.coalesce(*found)


def numbering_full(text: Column) -> Column:
    """The whole leading number with all its parts, whatever ends it."""
    return F.nullif(F.regexp_extract(strip(text), NUMBER + r"(?:[.)]|\s|$)", 1), F.lit(""))


def depth(number: Column) -> Column:
    """Parts of a section number."""
    return (F.length(number) - F.length(F.replace(number, F.lit("."), F.lit(""))) + 1).cast("int")


def preview(body: Column, limit: int = 50) -> Column:
    """Stripped text, cut to limit with an ellipsis when longer; null when empty."""
    text = strip(body)
    return F.when(text == "", None).when(F.length(text) > limit, F.concat(F.left(text, F.lit(limit - 3)), F.lit("..."))).otherwise(text)


def words(korean_only: bool = True, min_length: int = 2) -> Callable[[str], list[str]]:
    """The candidate keywords of a text, in order: runs of Hangul (and ASCII letters) that are long enough and no stop words."""
    runs = re.compile(("[\uac00-\ud7a3]" if korean_only else "[\uac00-\ud7a3a-zA-Z]") + f"{{{max(min_length, 1)},}}")
    stop = frozenset(STOPWORDS)
    return lambda text: [w for w in runs.findall(text) if w not in stop]


def keywords(texts: DataFrame, key: str, text: str, k: int = 10, min_length: int = 2, korean_only: bool = True) -> DataFrame:
    """key, rank, keyword, n: the k most frequent words of each text, ties by first appearance.

    Texts meet by key once and are counted one by one where they lie. The only text of its key sends its k best words,
    several texts of a key send all their words; these counts add up, combined before the shuffle.
    """
    candidates, kinds = words(korean_only, min_length), [pa.string(), pa.int64(), pa.int32()]

    def pooled(keys: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
        at, *columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([keys.take(pa.array(at)), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], [key, "keyword", "n", "first"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rows = batch.column(0), []
            for at, (said, several) in enumerate(zip(batch.column(1), batch.column(2), strict=True)):
                found = candidates(said.as_py())
                best = sorted(Counter(found).items(), key=itemgetter(1), reverse=True)  # stable: ties stay in order
                if several.as_py():
                    first = dict(zip(reversed(found), range(len(found) - 1, -1, -1), strict=True))
                    rows += [(at, w, n, first[w]) for w, n in best]
                else:
                    rows += [(at, w, n, place) for place, (w, n) in enumerate(best[:k])]
                if len(rows) >= 50_000:
                    yield pooled(keys, rows)
                    rows = []
            if rows:
                yield pooled(keys, rows)

    several = F.count(F.lit(1)).over(Window.partitionBy(key)) > 1
    said = texts.where(F.col(text).isNotNull()).select(key, F.col(text).alias("_said")).select(key, "_said", several.alias("_several"))
    made = T.StructType([texts.schema[key], T.StructField("keyword", T.StringType()), T.StructField("n", T.LongType()), T.StructField("first", T.IntegerType())])
    counts = said.mapInArrow(run, made).groupBy(key, "keyword").agg(F.sum("n").alias("n"), F.min("first").alias("first"))
    order = Window.partitionBy(key).orderBy(F.desc("n"), "first", "keyword")
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(key, "rank", "keyword", "n")


def chunks(text: Column, limit: int = 512) -> Column:
    """Pieces of at most limit characters that break at sentence marks; a longer sentence stays whole.

    The text is a run of sentences and marks; a piece that would overflow the open chunk closes it.
    """
    pieces = F.regexp_extract_all(text, F.lit(r"[^.!?]+|[.!?]"), F.lit(0))
    start = F.struct(F.lit("").alias("open"), F.array().cast("array<string>").alias("done"))

    def add(state: Column, piece: Column) -> Column:
        over = F.length(state["open"]) + F.length(piece) > limit
        closed = F.when(over & (state["open"] != ""), F.concat(state["done"], F.array(strip(state["open"])))).otherwise(state["done"])
        return F.struct(F.when(over, piece).otherwise(F.concat(state["open"], piece)).alias("open"), closed.alias("done"))

    def finish(state: Column) -> Column:
        return F.when(state["open"] != "", F.concat(state["done"], F.array(strip(state["open"])))).otherwise(state["done"])

    return F.when(F.length(text) <= limit, F.array(text)).otherwise(F.aggregate(pieces, start, add, finish))


def stem(path: Column) -> Column:
    """File name without folders and last extension."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/\\]*)$", 1), r"(?<=.)\.[^.]*$", "")
