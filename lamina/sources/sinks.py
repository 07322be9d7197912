"""Sinks: documents, crops, batch summaries, texts."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import docjson


def documents(found: DataFrame, folder: str, mode: str = "append") -> None:
    """One JSON object per line."""
    docjson.to_json(found).select("json").write.mode(mode).text(folder)


def by_document(found: DataFrame, folder: str, mode: str = "append") -> None:
    """JSON lines in a folder per document, so that a resumed run sees what is done."""
    docjson.to_json(found).write.mode(mode).partitionBy("doc_id").text(folder)


def in_buckets(found: DataFrame, folder: str, buckets: int = 256, mode: str = "append") -> None:
    """doc_id and json as Parquet in a bounded number of folders, whatever the number of documents; resumed by an anti join on doc_id."""
    rows = docjson.to_json(found).withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int"))
    rows.write.mode(mode).partitionBy("bucket").parquet(folder)


def pretty(found: DataFrame, doc_id: object, path: str) -> None:
    """One document as an indented file with its sections nested; a helper for single files on the driver."""
    rows = docjson.to_json(found.where(F.col("doc_id") == doc_id)).limit(1).collect()
    if not rows:
        raise FileNotFoundError(f"no document {doc_id}")
    value = json.loads(rows[0]["json"])
    value["sections"] = docjson.nested(value["sections"])
    with open(path, "w", encoding="utf-8") as out:
        json.dump(value, out, ensure_ascii=False, indent=2)


def crops(elements: DataFrame, folder: str, cropper: Callable[[bytes, tuple], bytes]) -> DataFrame:
    """doc_id, image_id, element_type, crop of elements (image, bbox, image_id) for a partitioned write.

    A crop that fails gives null bytes and its error instead of ending the job.
    """
    schema = "doc_id string, image_id string, element_type string, crop binary, error string"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.itertuples(index=False):
                try:
                    box = r.bbox if isinstance(r.bbox, dict) else r.bbox.asDict()
                    out.append((str(r.doc_id), r.image_id, r.element_type, cropper(bytes(r.image), tuple(box[k] for k in ("x1", "y1", "x2", "y2"))), None))
                except Exception as e:  # kept per row
                    out.append((str(r.doc_id), r.image_id, r.element_type, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])

    made = elements.select("doc_id", "image_id", "element_type", "image", "bbox").mapInPandas(run, schema)
    made.write.mode("append").partitionBy("element_type").parquet(folder)
    return made.sparkSession.read.parquet(folder)


def summary(one_row: DataFrame, folder: str) -> None:
    one_row.coalesce(1).write.mode("overwrite").json(folder)


def texts(rows: DataFrame, column: str, folder: str) -> None:
    rows.select(F.col(column).alias("value")).write.mode("append").text(folder)
