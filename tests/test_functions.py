"""Hand-worked values and small independent models of the functions."""

import random
import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lamina.functions import geometry, jsonio, labels, text
from lamina.operators import grounding


def column(spark, values, expression, kind="string"):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, v {kind}")
    return [r["x"] for r in rows.select("k", expression(F.col("v")).alias("x")).orderBy("k").collect()]


NUMBERS = {
    "1. a": "1", "1.1. a": "1.1", "1.1.1 a": "1.1", "1) a": "1", "1.1) a": "1", "1 a": "1", "1.1 a": "1", "12": None, "3.5kg": "3", "1.": "1", "1.1": "1",
    "1.1.1.": "1.1.1", "１. a": "１", "": None, "  2. b": "2",
}


def test_numbering(spark):
    assert column(spark, NUMBERS, text.numbering) == list(NUMBERS.values())
    assert column(spark, ["1.1.1 x", "1.1) x", "2", "x"], text.numbering_full) == ["1.1.1", "1.1", "2", None]


LABELS = {
    "section-header": "text_section", "section header": "text_header", "subtitle": "text_header", "text_section": "text_section", "text_paragraph": "graph", "paragraphs": "graph",
    "photograph": "graph", "flow-chart": "graph", "flowchart": "diagram", "figure": "diagram", "figure_2": "complex_image", "table_caption": "table", "picture_2": "text_paragraph",
    "caption": "text_paragraph", " Title\n": "text_header",
}


def test_label_types(spark):
    assert column(spark, LABELS, lambda v: labels.element_type(labels.normal_label(v))) == list(LABELS.values())
    assert column(spark, ["table", "odd"], labels.type_ordinal) == [4, None]


def test_coordinates(spark):
    got = column(spark, ["[[1,2,3,4],[5,6,7,8]]", "100,200,300,400", "[1,2,3]", "[]", "[ -1.5, 2, 3, 4 ]", "[1,2,x,4,5]"], grounding.coordinates)
    assert got == [[1, 2, 3, 4], [100, 200, 300, 400], [1, 2, 3], [], [-1.5, 2, 3, 4], None]


def test_rescale_and_gaps(spark):
    tag = "<|ref|>{}<|/ref|><|det|>{}<|/det|>{}"
    md = tag.format("Table ", "[[500,0,999,999]]", "\n a\n b ") + tag.format("x", "[1]", "") + tag.format("title", "[[-10,1,2,3000]]", "\n ")
    page = spark.createDataFrame([(1, 1, 1000, 1000, md), (2, 1, 10, 10, None), (3, 1, 10, 10, "")], "doc_id int, page_num int, width int, height int, raw_response string")
    found = {r["element_id"]: r for r in grounding.parse(page).collect()}
    assert set(found) == {"page_1_e0", "page_1_e2"}
    assert tuple(found["page_1_e0"]["bbox"]) == (500, 0, 1000, 1000, 1) and found["page_1_e0"]["text_preview"] == "a\n b"
    assert tuple(found["page_1_e2"]["bbox"]) == (-10, 1, 2, 3003, 1) and found["page_1_e2"]["text_preview"] is None


def test_preview(spark):
    assert column(spark, ["x" * 50, "x" * 51, " \n  "], text.preview) == ["x" * 50, "x" * 47 + "...", None]


def chunk_model(t, limit):
    if len(t) <= limit:
        return [t]
    out, cur = [], ""
    for piece in re.split(r"([.!?])", t):
        if len(cur) + len(piece) > limit:
            out += [cur.strip()] if cur else []
            cur = piece
        else:
            cur += piece
    return out + ([cur.strip()] if cur else [])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("ab .!?\n", max_size=60), min_size=1, max_size=30))
def test_chunks(spark, values):
    assert column(spark, values, lambda v: text.chunks(v, 12)) == [chunk_model(v, 12) for v in values]


def test_keywords_model(spark):
    rng = random.Random(4)
    texts = [(k, " ".join(rng.choice("aa bb ccc d ee! 노열 그리고".split()) for _ in range(rng.randrange(30)))) for k in range(40)]
    rows = spark.createDataFrame(texts, "key int, text string")
    got = {}
    for r in text.keywords(rows, "key", "text", k=3, korean_only=False).orderBy("key", "rank").collect():
        got.setdefault(r["key"], []).append(r["keyword"])
    for key, t in texts:
        words = [w for w in re.sub(r"[^가-힣a-zA-Z\s]", " ", t).split() if len(w) > 1 and w not in text.STOPWORDS]
        assert got.get(key, []) == [w for w, _ in Counter(words).most_common(3)]


def test_keywords_are_counted_in_their_text(spark):
    """Words are no rows before they are counted; several texts of a key count together, the null key's too."""
    rng = random.Random(5)
    texts = [(k if k < 20 else 7 if k < 26 else None, " ".join(rng.choice("aa bb ccc dddd\u2003x\tee! 노열 그리고 가나é다라".split(" ")) for _ in range(rng.randrange(1, 40)))) for k in range(32)] + [(7, None), (40, None), (41, "")]
    found = text.keywords(spark.createDataFrame(texts, "key int, text string").repartition(5), "key", "text", k=4, korean_only=False)
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
    counts, first = {}, {}
    for key, t in texts:
        held = [w for w in re.sub(r"[^가-힣a-zA-Z\s]", " ", t or "").split() if len(w) > 1 and w not in text.STOPWORDS]
        counts.setdefault(key, Counter()).update(held)
        for i, w in enumerate(held):
            first[key, w] = min(i, first.get((key, w), i))
    want = {(key, r, w, n) for key, c in counts.items() for r, (w, n) in enumerate(sorted(c.items(), key=lambda x: (-x[1], first[key, x[0]], x[0]))[:4], 1)}
    assert {tuple(r) for r in found.collect()} == want and found.schema["n"].dataType.simpleString() == "bigint"


TILES = {
    (640, 640): (1, 1, 273), (1700, 2200): (2, 3, 903), (2200, 1700): (3, 2, 893), (1000, 1000): (2, 2, 693), (3200, 400): (6, 1, 883), (641, 300): (2, 1, 483),
    (300, 3000): (1, 6, 933), (1000, 400): (2, 1, 483), (2000, 800): (3, 1, 583),
}


def test_tiles(spark):
    rows = spark.createDataFrame([(k, *wh) for k, wh in enumerate(TILES)], "k int, w int, h int").withColumn("g", geometry.crop_grid(F.col("w"), F.col("h")))
    got = rows.select("k", "g.cols", "g.rows", geometry.vision_tokens(F.col("g")).alias("t")).orderBy("k").collect()
    assert [tuple(r)[1:] for r in got] == list(TILES.values())
    assert geometry.largest_view() == (1280, 1280) and geometry.largest_view(1280, 1024) == (2048, 2048)


@pytest.mark.parametrize(("ids", "n", "allowed", "want"), [([1, 2, 3, 1, 2], 3, [], [3]), ([1, 2, 3, 1, 2], 3, [3], []), ([1, 2], 3, [], []), ([1, 1, 1], 1, [], []), ([], 2, [], [])])
def test_banned(spark, ids, n, allowed, want):
    assert column(spark, [ids], lambda v: geometry.banned(v, n, 10, allowed), "array<int>") == [want]


def test_clamp(spark):
    box = spark.range(1).select(F.struct(F.lit(-5).alias("x1"), F.lit(10).alias("y1"), F.lit(2000).alias("x2"), F.lit(20).alias("y2")).alias("b"))
    assert tuple(box.select(geometry.clamped(F.col("b"), F.lit(1700), F.lit(2200)).alias("c")).first()["c"]) == (0, 10, 1700, 20)


def test_strict_json(spark):
    values = ['{"a":1} x', "{'a':1}", '{"a":NaN}', '{"a":1,"a":2}', '```json\n{"a":1}\n```', "[1]", "3", None, '{"a":{"b":"ü"}}']
    assert column(spark, values, jsonio.strict_object) == [None, None, '{"a": NaN}', '{"a": 2}', None, None, None, None, '{"a": {"b": "ü"}}']
    assert column(spark, ['x {"a": 1} {"b": 2}', '{"a": {"b": 1}} {"c": 3}', "none"], jsonio.loose_object) == ['{"a": 1}', '{"c": 3}', None]
