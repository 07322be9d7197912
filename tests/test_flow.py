"""Contexts, blocks, sections, documents, providers, sources, sinks, streams and the command line."""

import json
import random
import warnings

import pytest
from pyspark.sql import functions as F

from lamina import cli, config, pipeline
from lamina.operators import answers, blocks, context, docjson, grounding, quality, sections
from lamina.plans import fixtures
from lamina.sources import files, providers, sinks
from lamina.streaming import drain

SF = "/root/testdata/sf0.001"


def budget_model(lines, budget=500):
    out, used = [], 0
    for line in lines:
        if used + len(line) > budget:
            if budget - used > 20:
                out.append(line[: budget - used] + "...")
            break
        out.append(line)
        used += len(line)
    return "\n".join(out)


def test_budget(spark):
    rng = random.Random(1)
    cases = [["a" * n for n in sizes] for sizes in ([300, 150, 100], [300, 185, 100], [500], [600], [480, 30, 5], [])]
    cases += [["x" * rng.randrange(1, 300) for _ in range(rng.randrange(8))] for _ in range(60)]
    rows = spark.createDataFrame([(k, c) for k, c in enumerate(cases)], "k int, c array<string>")
    got = rows.select("k", context.within_budget(F.col("c")).alias("x")).orderBy("k").collect()
    assert [r["x"] for r in got] == [budget_model(c) for c in cases]


def outline_rows(rng, n, deepest):
    out = []
    for i in range(n):
        if rng.random() < 0.6:
            level = rng.randrange(1, deepest + 1)
            out.append((1 if i % 2 else 2, f"b{i}", "text_section", i, "t", ".".join(["1"] * level)))
        else:
            out.append((1 if i % 2 else 2, f"b{i}", "text_paragraph", i, "t", None))
    return out


@pytest.mark.parametrize("deepest", [4, 9])
def test_parents(spark, deepest):
    rows = outline_rows(random.Random(deepest), 80, deepest)
    want, stacks, current, member = {}, {}, {}, {}
    for doc, name, kind, _, _, number in rows:
        stack = stacks.setdefault(doc, [])
        if kind == "text_section":
            level = number.count(".") + 1
            while stack and stack[-1][1] >= level:
                stack.pop()
            want[name] = stack[-1][0] if stack else None
            stack.append(("sec_" + name, level))
            current[doc] = "sec_" + name
        member[name] = current.get(doc)
    df = spark.createDataFrame(rows, "doc_id int, id string, type string, doc_index int, text string, numbering string")
    got = {r["heading_block_id"]: r["parent_id"] for r in sections.tree(df).collect()}
    assert got == want
    assert {r["id"]: r["section_id"] for r in sections.members(df).collect()} == member


@pytest.mark.parametrize("deepest", [3, 9])
def test_document_sections_equal_the_table(spark, deepest):
    """The sections gathered with a document are those of the flat tree with its blocks."""
    rows = [(d, i, t, k, x, n) for d, i, t, k, x, n in outline_rows(random.Random(deepest), 90, deepest)]
    rows = [(d, i, t, sum(1 for r in rows[:k] if r[0] == d), x, n) for k, (d, i, t, _, x, n) in enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id int, id string, type string, doc_index int, text string, numbering string")
    made = docjson.assemble(df, spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "doc_id int, page_count int")).collect()
    got = {(r["doc_id"], s["id"]): (s["parent_id"], s["level"], s["doc_index"], s["block_ids"], s["title"], s["number"]) for r in made for s in r["sections"]}
    want = {(r["doc_id"], r["section_id"]): (r["parent_id"], r["level"], r["doc_index"], r["block_ids"], r["title"], r["number"]) for r in sections.with_blocks(df).collect()}
    assert got == want and [r["blocks"] for r in made if r["doc_id"] == 3] == [[]]


def test_payloads(spark):
    data = {
        "table": {"items": ["x"], "markdown": "|a|b|\n|-|-|\n|1|2|", "complexity": "complex"},
        "graph": {"items": [], "graph_data": {"title": "T", "x_axis": {"label": "l", "unit": "u"}, "legend": ["q"], "trends": ["up"]}},
        "diagram": {"diagram_data": {"diagram_type": "flow", "components": [{"id": "1", "label": "A"}], "complexity": "complex"}},
        "complex_image": {"complexity_data": {"visible_text": "v"}},
        "text_section": {"items": ["2.1. Head", "Title"], "keywords": ["k"], "summary": "s"},
    }
    kinds = list(data)
    elements = spark.createDataFrame([(1, 1, i, f"e{i}", k, 1.0) for i, k in enumerate(kinds)], "doc_id int, page_num int, elem_idx int, element_id string, element_type string, confidence double")
    elements = elements.withColumn("bbox", F.expr("named_struct('x1', 0D, 'y1', 0D, 'x2', 1D, 'y2', 1D, 'page', 1)"))
    responses = spark.createDataFrame([(1, f"e{i}", json.dumps(data[k])) for i, k in enumerate(kinds)], "doc_id int, element_id string, raw_response string")
    b = {r["type"]: r for r in blocks.assemble(elements, blocks.latest(answers.parse(responses))).collect()}
    assert b["table"]["table"]["is_complex"] and b["table"]["table"]["image_id"] == "table_p1_e0" and b["table"]["table"]["data"] == []
    assert b["graph"]["graph"]["graph_type"] == "unknown" and b["graph"]["graph"]["x_axis"] == {"label": "l", "unit": "u"} and b["graph"]["text"] is None
    assert b["diagram"]["diagram"]["is_complex"] and b["diagram"]["diagram"]["components"][0]["label"] == "A"
    assert b["complex_image"]["complex_image"]["underlying_type"] == "unknown" and b["complex_image"]["complex_image"]["visible_text"] == "v"
    s = b["text_section"]
    assert (s["numbering"], s["level"], s["title_full"], s["text_data"]["summary"]) == ("2.1", 2, "Title", "s")
    cells = spark.createDataFrame([("|a|b|\n|---|:-:|\n| 1 | 2 |",)], "m string").select(blocks.table_cells(F.col("m")).alias("c")).first()["c"]
    assert cells == [["a", "b"], ["1", "2"]]


def test_last_answer_wins(spark):
    rows = spark.createDataFrame([(1, "e", 1, "a"), (1, "e", 2, "b")], "doc_id int, element_id string, n int, v string")
    assert [r["v"] for r in blocks.latest(rows, "n").collect()] == ["b"]


def test_documents_and_files(spark, tmp_path):
    pages, responses = fixtures.markup(spark, SF).where("doc_id < 12"), fixtures.responses(spark, SF).where("doc_id < 12")
    made = pipeline.documents(pages, responses)
    sinks.by_document(made, str(tmp_path / "out"))
    sinks.pretty(made, 3, str(tmp_path / "3.json"))
    value = json.loads((tmp_path / "3.json").read_text())
    assert value["version"] == "1.0.0" and value["blocks"][0]["doc_index"] == 0
    assert {r["doc_id"] for r in spark.read.text(str(tmp_path / "out")).select("doc_id").collect()} == set(range(12))
    back = docjson.from_json(spark.createDataFrame([(1, '{"sections":[{"id":"s","doc_index":4}],"blocks":[{"id":"b","type":"odd"}]}'), (2, "{}")], "doc_id int, json string"))
    one, two = back.orderBy("doc_id").collect()
    assert (one["version"], one["sections"][0]["level"], one["sections"][0]["span"], one["blocks"][0]["type"]) == ("0.0.0", 1, [4, 5], "odd")
    assert two["blocks"] == [] and two["sections"] == []
    flat = [{"id": "a", "parent_id": None}, {"id": "b", "parent_id": "a"}, {"id": "c", "parent_id": "b"}, {"id": "d", "parent_id": None}]
    tree = docjson.nested(flat)
    assert [t["id"] for t in tree] == ["a", "d"] and tree[0]["subsections"][0]["subsections"][0]["id"] == "c"


class Echo:
    def __call__(self, prompts, images):
        if any("BAD" in p for p in prompts):
            raise RuntimeError("broken")
        return [f"{p}|{len(i or b'')}<end>" for p, i in zip(prompts, images, strict=True)][:-1]


def test_providers(spark):
    rows = spark.createDataFrame([(k, p, bytearray(b"abc")) for k, p in enumerate(["x", "y"])], "k int, prompt string, image binary").coalesce(1)
    got = {r["k"]: r for r in providers.infer(rows, Echo, "<end>").collect()}
    assert (got[0]["raw_response"], got[1]["raw_response"]) == ("x|3", "")
    bad = providers.infer(spark.createDataFrame([(1, "BAD")], "k int, prompt string"), Echo).first()
    assert bad["raw_response"] is None and bad["error"] == "RuntimeError: broken"
    kept = providers.recorded(rows, spark.createDataFrame([(1, "r")], "k int, raw_response string"), ["k"]).orderBy("k").collect()
    assert [r["raw_response"] for r in kept] == [None, "r"]


def test_prompts(spark):
    rows = spark.createDataFrame([("table", ""), ("graph", "near {x}")], "element_type string, context string")
    got = [r["prompt"] for r in answers.with_prompts(rows).collect()]
    assert answers.NO_CONTEXT in got[0] and "near {x}" in got[1]
    with pytest.raises(Exception, match="no prompt for the type"):
        answers.with_prompts(spark.createDataFrame([("odd", "")], "element_type string, context string")).collect()
    assert answers.prompt_table(spark).count() == 7
    pages = spark.createDataFrame([(1,), (2,)], "page_num int")
    assert answers.page_prompts(pages).count() == 6 and answers.page_prompts(pages, ["markdown"]).first()["prompt"] == answers.FIRST_PASS
    assert spark.range(1).select(answers.without_end(F.lit("a<e>b"), "<e>").alias("x")).first()["x"] == "ab"


def render(content, dpi, with_text):
    if content == b"bad":
        raise ValueError("no pages")
    for n, part in enumerate(content.split(b"|")):
        yield part, f" page {n} " if with_text else None, 10 * dpi, 20


def test_sources(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"one|two")
    (tmp_path / "b.pdf").write_bytes(b"bad")
    (tmp_path / "c.txt").write_bytes(b"x")
    found = files.scan(spark, str(tmp_path))
    assert {r["doc_id"] for r in found.collect()} == {"a", "b"}
    rows = files.render(found, render).orderBy("doc_id", "page_num").collect()
    assert [(r["doc_id"], r["page_num"], r["text_layer"], r["width"]) for r in rows] == [("a", 1, "page 0", 2000), ("a", 2, "page 1", 2000), ("b", None, None, None)]
    assert rows[2]["error"] == "ValueError: no pages"
    (tmp_path / "done").mkdir()
    (tmp_path / "done" / "a_docjson.json").write_text("{}")
    left = files.outstanding(found, files.outputs(spark, str(tmp_path / "done")))
    assert [r["doc_id"] for r in left.collect()] == ["b"]


def test_pages_of_small_files_share_batches(spark, monkeypatch):
    """Many small files make few batches, and a batch ends at its limits, within a file too."""
    import pyarrow as pa

    class Files:
        select = lambda self, *cols: self
        mapInArrow = lambda self, run, schema: run

    docs = [str(k) for k in range(3000)]
    batch = pa.RecordBatch.from_arrays([pa.array(docs), pa.array([b"bad" if k % 7 == 3 else b"one|two|three" for k in range(3000)], pa.binary())], ["doc_id", "content"])
    want = [r for k, d in enumerate(docs) for r in ([(d, None, "ValueError: no pages")] if k % 7 == 3 else [(d, n, None) for n in (1, 2, 3)])]
    read = lambda made: [(r["doc_id"], r["page_num"], r["error"]) for b in made for r in b.to_pylist()]
    whole = list(files.render(Files(), render)(iter([batch])))
    assert len(whole) == 1 and read(whole) == want
    for limit, most, least in (("MOST_ROWS", 2, 2), ("MOST_BYTES", 1, 1)):
        with monkeypatch.context() as m:
            m.setattr(files, limit, most)
            cut = list(files.render(Files(), render)(iter([batch])))
        assert least <= max(b.num_rows for b in cut) <= 2 and read(cut) == want
    rows = spark.createDataFrame([("a", bytearray(b"x|y")), ("b", bytearray(b"bad")), ("c", None), ("d", bytearray(b""))], "doc_id string, content binary").coalesce(1)
    got = [(r["doc_id"], r["page_num"], r["image"], r["text_layer"], (r["error"] or "").partition(":")[0]) for r in files.render(rows, render, with_text=False).collect()]
    assert got == [("a", 1, b"x", "", ""), ("a", 2, b"y", "", ""), ("b", None, None, None, "ValueError"), ("c", None, None, None, "TypeError"), ("d", 1, b"", "", "")]


def test_json_is_read_once(spark):
    """Each document's JSON is read once, an answer's and a payload's fields are read together."""
    made = pipeline.documents(fixtures.markup(spark, SF), fixtures.full_responses(spark, SF))
    for part in ("blocks", "sections"):
        found = docjson.from_json(docjson.to_json(made)).select("doc_id", F.explode(part).alias("x")).select("doc_id", "x.*")
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        for schema in (part, "graph_data", "diagram_data", "complexity_data", "items"):
            assert plan.count(f"from_json(StructField({schema},") == 1
    rows = spark.createDataFrame([(1, None), (2, "{}"), (3, "no json"), (4, '{"version":"2","sections":[{"id":"s"}]}')], "doc_id int, json string")
    got = {r["doc_id"]: (r["version"], r["metadata"], r["blocks"], [(s["id"], s["level"], s["span"]) for s in r["sections"]]) for r in docjson.from_json(rows).collect()}
    none = ("0.0.0", None, [], [])
    assert got == {1: none, 2: none, 3: none, 4: ("2", None, [], [("s", 1, [0, 1])])}


def test_crops(spark, tmp_path):
    rows = spark.createDataFrame([(1, "i1", "table", bytearray(b"abcdef"))], "doc_id int, image_id string, element_type string, image binary")
    rows = rows.withColumn("bbox", F.expr("named_struct('x1', 1D, 'y1', 0D, 'x2', 3D, 'y2', 1D)"))
    got = sinks.crops(rows, str(tmp_path / "crops"), lambda image, box: image[int(box[0]) : int(box[2])]).collect()
    assert bytes(got[0]["crop"]) == b"bc" and got[0]["element_type"] == "table"


def test_stream(spark, tmp_path):
    source, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    pages = fixtures.markup(spark, SF)
    want = grounding.parse(pages.where("doc_id < 6")).count()
    for part in ("doc_id < 3", "doc_id >= 3 and doc_id < 6"):
        pages.where(part).write.mode("append").parquet(source)
        drain.drain(drain.elements(spark, source), out, mark)
    assert spark.read.parquet(out).count() == want


def test_config(tmp_path):
    path = str(tmp_path / "c.yaml")
    config.save(config.PRESETS["cpu"], path)
    assert config.load(path, "rtx4090") == config.PRESETS["cpu"] == config.load(preset="CPU")
    with pytest.raises(ValueError, match="unknown preset"):
        config.load(preset="none")
    with pytest.raises(ValueError, match="device"):
        config.replace(config.DEFAULT, device="tpu").validate()
    with warnings.catch_warnings(record=True) as told:
        warnings.simplefilter("always")
        config.replace(config.DEFAULT, dtype="float32", base_size=7, pdf_dpi=72).validate()
    assert len(told) == 3


def test_cli(spark, tmp_path):
    pages, recorded, out = (str(tmp_path / x) for x in ("pages", "answers", "out"))
    fixtures.markup(spark, SF).where("doc_id < 6").write.parquet(pages)
    fixtures.responses(spark, SF).where("doc_id < 6").write.parquet(recorded)
    both = ["--pages", pages, "--answers", recorded, "--output", out]
    assert cli.main(["process", *both, "--doc", "2"], spark) == 0
    assert cli.main(["batch", *both, "--resume", "--preset", "cpu"], spark) == 0
    assert {r["doc_id"]: r["n"] for r in spark.read.text(out).groupBy("doc_id").agg(F.count("*").alias("n")).collect()} == {k: 1 for k in range(6)}
    assert cli.main(["batch", *both, "--resume"], spark) == 1


def test_broken_documents_fail_alone(spark, tmp_path):
    """A batch with a page that has no markup: the other documents are written, the summary and the exit code tell."""
    import json

    pages, recorded, out = (str(tmp_path / x) for x in ("pages", "answers", "out"))
    rows = fixtures.markup(spark, SF).where("doc_id < 6")
    rows.withColumn("raw_response", F.when(F.col("doc_id") != 4, F.col("raw_response"))).write.parquet(pages)
    fixtures.responses(spark, SF).where("doc_id < 6").write.parquet(recorded)
    both = ["--pages", pages, "--answers", recorded, "--output", out, "--buckets", "3"]
    assert cli.main(["batch", *both], spark) == 1
    assert sorted(r["doc_id"] for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3, 5]
    told = json.loads(spark.read.text(out + "_summary").first()["value"])
    assert (told["success"], told["failed"]) == (5, 1) and told["mean_seconds"] <= told["total_seconds"] / 5
    assert {r["doc_id"]: r["error"] for r in spark.read.parquet(out + "_results").where("status = 'failed'").collect()} == {4: "a page has no markup"}
    assert cli.main(["batch", *both, "--resume"], spark) == 1 and spark.read.parquet(out).count() == 5


def test_last_answer_needs_an_order(spark):
    rows = spark.createDataFrame([(1, "a", "x", 2), (1, "a", "y", 5), (1, "b", "z", 1)], "doc_id int, element_id string, v string, answer_idx int")
    assert sorted(r["v"] for r in blocks.latest(rows).collect()) == ["y", "z"]
    assert blocks.latest(rows.where("v <> 'x'").drop("answer_idx")).count() == 2
    with pytest.raises(Exception, match="several answers but no order: a"):
        blocks.latest(rows.drop("answer_idx")).collect()


@pytest.mark.parametrize("deep", [False, True])
def test_spans_and_paths_equal_a_walk(spark, deep):
    """Random outlines, also beyond six levels, against a walk with a stack."""
    import random

    rng, rows, want = random.Random(3), [], {}
    for doc in range(12):
        stack, n, levels = [], 40, []
        for i in range(n):
            level = rng.randrange(1, 10 if deep else 7)
            number = ".".join(str(rng.randrange(1, 9)) for _ in range(level))
            head = i % 2 == 0
            rows.append((doc, f"b{i}", "text_section" if head else "text_paragraph", i, "t", number if head else None))
            if head:
                levels.append((i, level))
                stack = [x for x in stack if x[0] < level] + [(level, number)]
                want[doc, f"sec_b{i}"] = [x[1] for x in stack]
        for i, level in levels:
            want[doc, f"sec_b{i}", "end"] = min([k for k, up in levels if k > i and up <= level], default=n)
    df = spark.createDataFrame(rows, "doc_id int, id string, type string, doc_index int, text string, numbering string")
    assert {(r["doc_id"], r["section_id"]): r["path"] for r in sections.paths(sections.tree(df)).collect()} == {k: v for k, v in want.items() if len(k) == 2}
    assert {(r["doc_id"], r["section_id"], "end"): r["span_end"] for r in sections.spans(df).collect()} == {k: v for k, v in want.items() if len(k) == 3}


def test_grades(spark):
    rows = spark.createDataFrame([(0.7,), (0.5,), (0.1,)], "v double").select(quality.grade(F.col("v"), quality.COVERAGE).alias("g"))
    assert [r["g"] for r in rows.collect()] == ["good", "moderate", "poor"]
