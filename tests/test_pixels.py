"""Crops, tiles and views of raw images."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamina.operators import pixels

IMAGE = np.arange(4 * 6 * 3, dtype=np.uint8).reshape(4, 6, 3)


def test_crop():
    assert np.array_equal(pixels.crop(IMAGE, (1, 1, 3, 4)), IMAGE[1:4, 1:3])
    out = pixels.crop(IMAGE, (-2, 3, 2, 6))
    assert out.shape == (3, 4, 3) and np.array_equal(out[0, 2:], IMAGE[3, :2]) and not out[1:].any() and not out[:, :2].any()
    with pytest.raises(ValueError, match="inverted"):
        pixels.crop(IMAGE, (3, 0, 1, 1))


def test_resize_and_tiles():
    assert np.array_equal(pixels.resize(IMAGE, 6, 4), IMAGE)
    flat = np.full((5, 7, 3), 9, np.uint8)
    assert (pixels.resize(flat, 13, 3) == 9).all()
    found = pixels.tiles(IMAGE, 3, 2, 2, thumbnail=True)
    assert len(found) == 7 and np.array_equal(found[4], IMAGE[2:4, 2:4]) and found[6].shape == (2, 2, 3)
    assert len(pixels.tiles(IMAGE, 1, 1, 2, thumbnail=True)) == 1
    view = pixels.padded_view(IMAGE, 12)
    assert view.shape == (12, 12, 3) and (view[0] == 127).all() and (view[-1] == 127).all() and not (view[6] == 127).all()
    assert np.allclose(pixels.normalised(np.array([[[0, 255, 51]]], np.uint8)).ravel(), [-1, 1, -0.6])


def test_elements_and_views(spark):
    big = np.zeros((500, 700, 3), np.uint8)
    pages = spark.createDataFrame([(1, 1, 6, 4, bytearray(IMAGE.tobytes())), (1, 2, 700, 500, bytearray(big.tobytes()))], "doc_id int, page_num int, width int, height int, image binary")
    elements = spark.createDataFrame([(1, 1, 0, "table", 1.0, 1.0, 3.0, 4.0), (1, 1, 1, "graph", 5.0, 0.0, 1.0, 1.0), (1, 1, 2, "text_header", 0.0, 0.0, 1.0, 1.0)], "doc_id int, page_num int, elem_idx int, element_type string, x1 double, y1 double, x2 double, y2 double")
    elements = elements.withColumn("bbox", F.struct("x1", "y1", "x2", "y2")).drop("x1", "y1", "x2", "y2")
    got = {r["elem_idx"]: r for r in pixels.crop_elements(pages, elements).collect()}
    assert set(got) == {0, 1} and bytes(got[0]["data"]) == IMAGE[1:4, 1:3].tobytes() and got[0]["error"] is None
    assert (got[1]["width"], got[1]["height"], set(got[1]["data"])) == (100, 100, {255}) and "inverted" in got[1]["error"]
    seen = sorted((r["page_num"], r["view"], r["width"]) for r in pixels.views(pages).collect())
    assert seen == [(1, 0, 1024), (2, 0, 1024), (2, 1, 640), (2, 2, 640), (2, 3, 640), (2, 4, 640), (2, 5, 640), (2, 6, 640)]
