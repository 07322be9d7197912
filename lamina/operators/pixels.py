"""Pixels of raw images (rows of red, green, blue bytes): crops, tiles, padded views, normalised arrays.

Decoding and encoding stay with the sources and sinks; everything here is numpy on raw bytes,
a batch of rows at a time, next to the box arithmetic of functions.geometry. Resizing is
bilinear; a model that wants another filter brings its own through `resize`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry, labels

# Fixed values.
MEAN, STD = (0.5, 0.5, 0.5), (0.5, 0.5, 0.5)
PLACEHOLDER = (100, 100)

Resize = Callable[[np.ndarray, int, int], np.ndarray]


def array(data: bytes, width: int, height: int) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(height, width, 3)


def crop(image: np.ndarray, box: tuple[float, float, float, float]) -> np.ndarray:
    """The box of an image, black where it leaves the image; an error for an inverted box."""
    x1, y1, x2, y2 = (int(round(v)) for v in box)
    if x2 < x1 or y2 < y1:
        raise ValueError(f"box {box} is inverted")
    out = np.zeros((y2 - y1, x2 - x1, 3), np.uint8)
    h, w = image.shape[:2]
    a, b, c, d = max(x1, 0), max(y1, 0), min(x2, w), min(y2, h)
    if a < c and b < d:
        out[b - y1 : d - y1, a - x1 : c - x1] = image[b:d, a:c]
    return out


def resize(image: np.ndarray, width: int, height: int) -> np.ndarray:
    """Bilinear, by pixel centres."""
    h, w = image.shape[:2]
    y = np.clip((np.arange(height) + 0.5) * h / height - 0.5, 0, h - 1)
    x = np.clip((np.arange(width) + 0.5) * w / width - 0.5, 0, w - 1)
    y0, x0 = y.astype(int), x.astype(int)
    y1, x1 = np.minimum(y0 + 1, h - 1), np.minimum(x0 + 1, w - 1)
    fy, fx = (y - y0)[:, None, None], (x - x0)[None, :, None]
    top = image[y0][:, x0] * (1 - fx) + image[y0][:, x1] * fx
    low = image[y1][:, x0] * (1 - fx) + image[y1][:, x1] * fx
    return np.rint(top * (1 - fy) + low * fy).astype(np.uint8)


def padded_view(image: np.ndarray, size: int = geometry.BASE, mean=MEAN, resize: Resize = resize) -> np.ndarray:
    """The whole image within a square, its shape kept, the rest in the mean colour."""
    h, w = image.shape[:2]
    scale = min(size / w, size / h)
    nw, nh = max(1, round(w * scale)), max(1, round(h * scale))
    out = np.empty((size, size, 3), np.uint8)
    out[:] = [int(m * 255) for m in mean]
    top, left = (size - nh) // 2, (size - nw) // 2
    out[top : top + nh, left : left + nw] = resize(image, nw, nh)
    return out


def tiles(image: np.ndarray, cols: int, rows: int, tile: int = geometry.TILE, thumbnail: bool = False, resize: Resize = resize) -> list[np.ndarray]:
    """The image resized to a grid and cut row by row, with a thumbnail of the whole if asked for and more than one tile."""
    whole = resize(image, cols * tile, rows * tile)
    out = [whole[r * tile : (r + 1) * tile, c * tile : (c + 1) * tile] for r in range(rows) for c in range(cols)]
    return out + ([resize(image, tile, tile)] if thumbnail and len(out) != 1 else [])


def normalised(image: np.ndarray, mean=MEAN, std=STD) -> np.ndarray:
    """float32 by channel, row, column: bytes over 255, less the mean, over the deviation."""
    x = image.astype(np.float32).transpose(2, 0, 1) / np.float32(255)
    return (x - np.array(mean, np.float32)[:, None, None]) / np.array(std, np.float32)[:, None, None]


def crop_elements(pages: DataFrame, elements: DataFrame) -> DataFrame:
    """doc_id, page_num, elem_idx, element_type, width, height, data, error of every visual element.

    pages: doc_id, page_num, width, height, image (raw bytes). Boxes meet their page in an
    equi-join; a crop that fails gives the white placeholder and its error.
    """
    wanted = elements.where(labels.is_visual(F.col("element_type"))).select("doc_id", "page_num", "elem_idx", "element_type", "bbox.x1", "bbox.y1", "bbox.x2", "bbox.y2")
    joined = wanted.join(pages.select("doc_id", "page_num", "width", "height", "image"), ["doc_id", "page_num"])
    kind = joined.schema
    schema = ", ".join([f"{n} {kind[n].dataType.simpleString()}" for n in ("doc_id", "page_num", "elem_idx", "element_type")] + ["width int, height int, data binary, error string"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.itertuples(index=False):
                try:
                    got, error = crop(array(bytes(r.image), r.width, r.height), (r.x1, r.y1, r.x2, r.y2)), None
                except ValueError as e:
                    got, error = np.full((*PLACEHOLDER, 3), 255, np.uint8), str(e)
                out.append((r.doc_id, r.page_num, r.elem_idx, r.element_type, got.shape[1], got.shape[0], got.tobytes(), error))
            yield pd.DataFrame(out, columns=["doc_id", "page_num", "elem_idx", "element_type", "width", "height", "data", "error"])

    return joined.mapInPandas(run, schema)


def views(pages: DataFrame, low: int = 2, high: int = 6, base: int = geometry.BASE, tile: int = geometry.TILE) -> DataFrame:
    """doc_id, page_num, view, width, height, data: the padded view (0) and the tiles (from 1) of every page."""
    planned = pages.select("doc_id", "page_num", "width", "height", "image", geometry.crop_grid(F.col("width"), F.col("height"), low, high, tile).alias("g"))
    planned = planned.select("doc_id", "page_num", "width", "height", "image", "g.cols", "g.rows")
    kind = planned.schema
    schema = f"doc_id {kind['doc_id'].dataType.simpleString()}, page_num {kind['page_num'].dataType.simpleString()}, view int, width int, height int, data binary"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples(index=False):
                image = array(bytes(r.image), r.width, r.height)
                found = [padded_view(image, base)] + (tiles(image, r.cols, r.rows, tile) if r.cols * r.rows > 1 else [])
                yield pd.DataFrame([(r.doc_id, r.page_num, k, v.shape[1], v.shape[0], v.tobytes()) for k, v in enumerate(found)], columns=["doc_id", "page_num", "view", "width", "height", "data"])

    return planned.mapInPandas(run, schema)
