"""File sources: PDFs, images, recorded answers, stored documents; resume by anti join."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text

PAGES = "doc_id string, page_num int, image binary, text_layer string, width int, height int, dpi int, error string"

#: A batch of rendered pages ends at so many rows or bytes.
MOST_ROWS, MOST_BYTES = 10_000, 8 << 20

#: (content, dpi, with text) -> (image, text layer or None, width, height) of each page.
Renderer = Callable[[bytes, int, bool], Iterator[tuple[bytes, str | None, int, int]]]


def scan(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """path, modificationTime, length, content, doc_id of the files right below a folder."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "false").load(folder)
    return found.withColumn("doc_id", text.stem(F.col("path")))


def images(spark: SparkSession, path: str) -> DataFrame:
    """Image files with their size, by Spark's own image source."""
    return spark.read.format("image").option("dropInvalid", "true").load(path).select("image.origin", "image.height", "image.width", "image.nChannels", "image.mode", "image.data")


def render(files: DataFrame, renderer: Renderer, dpi: int = 200, with_text: bool = True) -> DataFrame:
    """PAGES rows of files (doc_id, content), numbered from 1.

    A file that cannot be rendered gives one row with its error; a page without a readable
    text layer has the empty text. The renderer runs in the executors, a file at a time; the
    pages of many small files share a batch.
    """

    names = [c.split()[0] for c in PAGES.split(", ")]

    def made(doc: str, content: bytes) -> list[tuple]:
        try:
            return [(doc, n, image, (layer or "").strip(), w, h, dpi, None) for n, (image, layer, w, h) in enumerate(renderer(bytes(content), dpi, with_text), 1)]
        except Exception as e:  # one bad file must not end the batch
            return [(doc, None, None, None, None, None, dpi, f"{type(e).__name__}: {e}")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, blob, number = batch.schema.field("doc_id").type, batch.schema.field("content").type, pa.int32()
            kinds = [word, number, blob, word, number, number, number, word]
            pooled = lambda rows, kinds=kinds: pa.RecordBatch.from_arrays([pa.array(c, k, from_pandas=True) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
            rows, held = [], 0
            for doc, content in zip(batch.column("doc_id"), batch.column("content"), strict=True):
                for row in made(doc.as_py(), content.as_py()):
                    rows.append(row)
                    held += len(row[2] or b"") + len(row[3] or "")
                    if len(rows) >= MOST_ROWS or held >= MOST_BYTES:
                        yield pooled(rows)
                        rows, held = [], 0
            if rows:
                yield pooled(rows)

    return files.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("content").cast("binary").alias("content")).mapInArrow(run, PAGES)


def outstanding(inputs: DataFrame, outputs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Inputs without an output of their name: what a resumed run has left."""
    return inputs.join(outputs.select(key).distinct(), key, "left_anti")


def outputs(spark: SparkSession, folder: str, suffix: str = "_docjson") -> DataFrame:
    """doc_id of the documents already written below a folder."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}.json").load(folder).select("path")
    return found.select(F.regexp_replace(text.stem(F.col("path")), suffix + "$", "").alias("doc_id"))
