"""Registry of the engine's own queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import pipeline
from ..functions import geometry, jsonio, labels, text
from ..operators import answers, blocks, context, docjson, grounding, quality, sections
from ..session import ship, table
from ..sources import files, providers
from ..streaming import drain
from . import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL twin."""

    def add(f):
        QUERIES[f.__name__] = wraps(f)(lambda spark, sf_dir: f(ship(spark), sf_dir))
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grounding.parse(fx.markup(spark, sf_dir))


def _box(elements: DataFrame) -> list:
    return [F.col(f"bbox.{k}").alias(k) for k in ("x1", "y1", "x2", "y2")]


# --- markup ---------------------------------------------------------------------------------


@query(f"WITH {fx.SQL_ELEMENTS} SELECT label, count(*) AS n, sum(x1)::BIGINT AS sum_x1 FROM elements GROUP BY label")
def label_census(spark, sf_dir):
    """How often each layout label occurs, and the sum of its left edges."""
    return _elements(spark, sf_dir).groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("bbox.x1").cast("long").alias("sum_x1"))


@query(f"WITH {fx.SQL_ELEMENTS} SELECT element_type, label, count(*) AS n, sum(x1)::BIGINT AS sum_x1, count(text_preview) AS with_preview FROM elements GROUP BY ALL")
def type_census(spark, sf_dir):
    """Labels with their element types."""
    return _elements(spark, sf_dir).groupBy("element_type", "label").agg(
        F.count(F.lit(1)).alias("n"), F.sum("bbox.x1").cast("long").alias("sum_x1"), F.count("text_preview").alias("with_preview")
    )


@query(f"WITH {fx.SQL_ELEMENTS} SELECT doc_id, page_num, elem_idx, element_id, label, element_type, x1, y1, x2, y2, 1.0::DOUBLE AS confidence, text_preview FROM elements")
def elements_parsed(spark, sf_dir):
    """Every element of the markup."""
    found = _elements(spark, sf_dir)
    return found.select("doc_id", "page_num", "elem_idx", "element_id", "label", "element_type", *_box(found), "confidence", "text_preview")


@query(f"WITH {fx.SQL_ELEMENTS} SELECT text_preview, count(*) AS n FROM elements WHERE text_preview IS NOT NULL GROUP BY text_preview")
def text_previews(spark, sf_dir):
    """Previews and how often each occurs."""
    return _elements(spark, sf_dir).where("text_preview is not null").groupBy("text_preview").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {fx.SQL_ELEMENTS} SELECT element_type, max(x2 - x1) AS max_width, min(y2 - y1) AS min_height, sum((x2 - x1) * (y2 - y1))::BIGINT AS area,
  (sum((y1 + y2) / 2) * 2)::BIGINT AS center_twice FROM elements GROUP BY element_type""")
def bbox_geometry(spark, sf_dir):
    """Widths, heights, areas and centres by type."""
    b = F.col("bbox")
    return _elements(spark, sf_dir).groupBy("element_type").agg(
        F.max(geometry.width(b)).alias("max_width"), F.min(geometry.height(b)).alias("min_height"), F.sum(geometry.area(b)).cast("long").alias("area"),
        (F.sum(geometry.center_y(b)) * 2).cast("long").alias("center_twice"),
    )


@query(f"""WITH {fx.SQL_ELEMENTS} SELECT doc_id, element_id, greatest(0, least(x1 - 300, 1000))::INT AS x1, greatest(0, least(y1 - 300, 1200))::INT AS y1,
  greatest(0, least(x2 - 300, 1000))::INT AS x2, greatest(0, least(y2 - 300, 1200))::INT AS y2 FROM elements""")
def bbox_clamped(spark, sf_dir):
    """Boxes moved off the page and cut to a smaller one."""
    moved = F.struct(*[(F.col(f"bbox.{k}") - 300).cast("int").alias(k) for k in ("x1", "y1", "x2", "y2")])
    cut = _elements(spark, sf_dir).select("doc_id", "element_id", geometry.clamped(moved, F.lit(1000), F.lit(1200)).alias("b"))
    return cut.select("doc_id", "element_id", "b.*")


@query(f"WITH {fx.SQL_ELEMENTS} SELECT doc_id, page_num, element_id, element_type FROM elements WHERE element_type IN ('table', 'graph', 'diagram', 'complex_image') AND page_num BETWEEN 1 AND 2")
def visual_elements(spark, sf_dir):
    """Tables, graphs, diagrams and pictures of the first two pages."""
    return grounding.on_pages(grounding.visual(_elements(spark, sf_dir)), 1, 2).select("doc_id", "page_num", "element_id", "element_type")


@query(f"WITH {fx.SQL_ELEMENTS} SELECT doc_id, count(*) AS n, min(element_type) AS first_type FROM elements WHERE element_type IN ('text_header', 'text_section', 'text_paragraph') GROUP BY doc_id")
def text_elements(spark, sf_dir):
    """Text elements of each document."""
    return grounding.textual(_elements(spark, sf_dir)).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.min("element_type").alias("first_type"))


@query(f"WITH {fx.SQL_ELEMENTS} SELECT label, count(*) AS n, label IN ('title', 'heading', 'section-header', 'section_header', 'text', 'paragraph', 'table', 'graph', 'chart', 'plot', 'figure', 'diagram', 'flowchart', 'image', 'photo', 'picture') AS known FROM elements GROUP BY label")
def known_unknown_labels(spark, sf_dir):
    """Labels as written, and whether the table knows them."""
    return quality.label_census(grounding.raw_labels(fx.markup(spark, sf_dir)))


@query(f"WITH {fx.SQL_ELEMENTS} SELECT DISTINCT label FROM elements WHERE label IN ('text_paragraph', 'caption', 'flow-chart', 'figure_2')")
def unknown_labels(spark, sf_dir):
    """Labels outside the table."""
    return quality.unknown_labels(grounding.raw_labels(fx.markup(spark, sf_dir)))


@query(f"WITH {fx.SQL_ELEMENTS} SELECT label, element_type, count(*) AS n FROM elements WHERE label LIKE '%fig%' GROUP BY ALL")
def figure_labels(spark, sf_dir):
    """Labels that say figure."""
    return _elements(spark, sf_dir).where(labels.is_figure_label(F.col("label"))).groupBy("label", "element_type").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT doc_id, 1 AS page_num, k::INT AS elem_idx, 'e' || k AS element_id, ['table', 'graph', 'diagram'][k + 1] AS element_type, (doc_id % 100 + k)::DOUBLE AS x1, 1.0::DOUBLE AS confidence
  FROM documents, range(0, 3) t(k)""")
def json_elements(spark, sf_dir):
    """First-pass answers in their JSON form; elements of unknown type or with short boxes are dropped."""
    x = F.col("doc_id") % 100
    one = lambda kind, k, more="": F.concat(F.lit(f'{{"element_type":"{kind}","bbox":['), x + k, F.lit(f",2,3,4]{more}}}"))
    bad = F.lit(',{"element_type":"nonsense","bbox":[1,2,3,4]},{"element_type":"table","bbox":[1,2]}')
    answer = F.concat(F.lit('{"elements":['), one("table", 0), F.lit(","), one("graph", 1, ',"confidence":1.0'), F.lit(","), one("diagram", 2), bad, F.lit("]}"))
    pages = table(spark, sf_dir, "documents").select("doc_id", F.lit(1).alias("page_num"), answer.alias("raw_response"))
    return grounding.parse_json(pages).select("doc_id", "page_num", "elem_idx", "element_id", "element_type", "bbox.x1", "confidence")


# --- text functions ---------------------------------------------------------------------------


@query(f"WITH {fx.SQL_OUTLINE} SELECT doc_id, doc_index, number AS numbering, level, CASE WHEN level = 3 THEN number ELSE number END AS numbering_full FROM heads")
def numbering_parse(spark, sf_dir):
    """Section numbers and depths of outline headings."""
    heads = fx.outline(spark, sf_dir).where("type = 'text_section'")
    return heads.select("doc_id", "doc_index", "numbering", text.depth(F.col("numbering")).alias("level"), text.numbering_full(F.col("text")).alias("numbering_full"))


@query("""WITH t AS (SELECT doc_id, string_split_regex(regexp_replace(text, '[^a-zA-Z\\s]', ' ', 'g'), '\\s+') AS ws FROM documents),
w AS (SELECT doc_id, unnest(ws) AS keyword, unnest(range(0, len(ws))) AS pos FROM t),
c AS (SELECT doc_id, keyword, count(*) AS n, min(pos) AS first_pos FROM w WHERE length(keyword) >= 4 GROUP BY ALL)
SELECT doc_id, rank::INT AS rank, keyword, n FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first_pos) AS rank FROM c) WHERE rank <= 10""")
def keywords_topk(spark, sf_dir):
    """The ten most frequent words of four or more ASCII letters of each document."""
    return text.keywords(table(spark, sf_dir, "documents"), "doc_id", "text", k=10, min_length=4, korean_only=False)


@query("SELECT * FROM (VALUES (1, 1, '노열', 2), (1, 2, '관리', 1), (1, 3, '기준', 1), (2, 1, '보고서', 2), (2, 2, '작성', 1)) t(key, rank, keyword, n)")
def keywords_hangul(spark, sf_dir):
    """Korean keywords of a few texts: ties by first appearance, stop words and single letters dropped."""
    rows = spark.createDataFrame([(1, "노열 관리 기준. 노열은 중요한 지표입니다. 노열 에서 abc"), (2, "보고서 작성 및 보고서 12 를"), (3, ""), (4, "only latin")], "key int, text string")
    out = text.keywords(rows, "key", "text", k=3)
    return out.select("key", "rank", "keyword", F.col("n").cast("int").alias("n"))


@query("""WITH RECURSIVE p AS (SELECT doc_id, text, length(text) AS len, regexp_extract_all(text, '[^.!?]+|[.!?]') AS ps FROM documents),
f AS (SELECT doc_id, 1 AS k, ps, ''::VARCHAR AS cur, 0::BIGINT AS n, 0::BIGINT AS total, 0::BIGINT AS longest FROM p WHERE len > 512
  UNION ALL SELECT doc_id, k + 1, ps, CASE WHEN length(cur) + length(ps[k]) > 512 THEN ps[k] ELSE cur || ps[k] END,
    n + CASE WHEN length(cur) + length(ps[k]) > 512 AND cur <> '' THEN 1 ELSE 0 END,
    total + CASE WHEN length(cur) + length(ps[k]) > 512 AND cur <> '' THEN length(trim(cur, ' ' || chr(9) || chr(10) || chr(13))) ELSE 0 END,
    greatest(longest, CASE WHEN length(cur) + length(ps[k]) > 512 AND cur <> '' THEN length(trim(cur, ' ' || chr(9) || chr(10) || chr(13))) ELSE 0 END)
  FROM f WHERE k <= len(ps))
SELECT doc_id, 1::BIGINT AS n_chunks, len AS total_chars, len AS longest FROM p WHERE len <= 512
UNION ALL SELECT doc_id, n + CASE WHEN cur <> '' THEN 1 ELSE 0 END, total + length(trim(cur, ' ' || chr(9) || chr(10) || chr(13))),
  greatest(longest, length(trim(cur, ' ' || chr(9) || chr(10) || chr(13)))) FROM f WHERE k = len(ps) + 1""")
def chunk_stats(spark, sf_dir):
    """Number and size of the sentence-aware chunks of each document."""
    rows = table(spark, sf_dir, "documents").select("doc_id", text.chunks(F.col("text"), 512).alias("c"))
    sizes = F.transform("c", lambda x: F.length(x).cast("long"))
    total = F.aggregate(sizes, F.lit(0).cast("long"), lambda a, b: a + b)
    return rows.select("doc_id", F.size("c").cast("long").alias("n_chunks"), total.alias("total_chars"), F.array_max(sizes).alias("longest"))


# --- context --------------------------------------------------------------------------------


_SPATIAL = f"""WITH {fx.SQL_ELEMENTS},
near AS (
  SELECT e.doc_id, e.page_num, e.elem_idx, c.elem_idx AS c_idx, abs((c.y1 + c.y2) / 2 - (e.y1 + e.y2) / 2) AS far, '[' || c.element_type || '] ' || c.text_preview AS line
  FROM elements e JOIN elements c ON e.doc_id = c.doc_id AND e.page_num = c.page_num AND e.elem_idx <> c.elem_idx
  WHERE c.element_type IN ('text_header', 'text_section', 'text_paragraph') AND abs((c.y1 + c.y2) / 2 - (e.y1 + e.y2) / 2) <= 2200 * 0.2::DOUBLE),
summed AS (SELECT *, sum(length(line)) OVER (PARTITION BY doc_id, page_num, elem_idx ORDER BY far, c_idx) AS cum FROM near WHERE line IS NOT NULL),
kept AS (
  SELECT *, CASE WHEN cum <= {{budget}} THEN line WHEN cum - length(line) <= {{budget}} AND {{budget}} - (cum - length(line)) > 20 THEN left(line, ({{budget}} - (cum - length(line)))::INT) || '...' END AS part FROM summed),
joined AS (SELECT doc_id, page_num, elem_idx, string_agg(part, chr(10) ORDER BY far, c_idx) AS context FROM kept WHERE part IS NOT NULL GROUP BY ALL),
contexts AS (SELECT e.doc_id, e.page_num, e.elem_idx, e.element_id, e.element_type, coalesce(j.context, '') AS context
  FROM elements e LEFT JOIN joined j ON e.doc_id = j.doc_id AND e.page_num = j.page_num AND e.elem_idx = j.elem_idx)"""


@query(_SPATIAL.format(budget=500) + " SELECT * FROM contexts")
def context_spatial(spark, sf_dir):
    """Text near each element within the budget."""
    return context.spatial(_elements(spark, sf_dir)).drop("nearby")


@query(_SPATIAL.format(budget=150) + " SELECT * FROM contexts")
def context_tight(spark, sf_dir):
    """The same with a budget that cuts many lines."""
    return context.spatial(_elements(spark, sf_dir), budget=150).drop("nearby")


@query(f"""WITH {fx.SQL_ELEMENTS},
near AS (SELECT e.doc_id, e.page_num, e.elem_idx, c.elem_idx AS c_idx, CASE WHEN c.elem_idx = e.elem_idx THEN '[CURRENT ELEMENT: ' || e.element_type || ']'
    WHEN c.text_preview IS NOT NULL THEN c.element_type || ': ' || c.text_preview END AS line
  FROM elements e JOIN elements c ON e.doc_id = c.doc_id AND e.page_num = c.page_num AND abs(e.elem_idx - c.elem_idx) <= 2)
SELECT e.doc_id, e.page_num, e.elem_idx, e.element_id, e.element_type, string_agg(n.line, chr(10) ORDER BY n.c_idx) AS context
FROM elements e JOIN near n ON e.doc_id = n.doc_id AND e.page_num = n.page_num AND e.elem_idx = n.elem_idx WHERE n.line IS NOT NULL GROUP BY ALL""")
def context_positional(spark, sf_dir):
    """The two elements before and after each element."""
    return context.positional(_elements(spark, sf_dir))


_PROMPT_CASE = " ".join("WHEN '" + k + "' THEN '" + v.replace("'", "''") + "'" for k, v in answers.PROMPTS.items())


@query(_SPATIAL.format(budget=500) + f""" SELECT doc_id, element_id, md5(replace(CASE element_type {_PROMPT_CASE} END, '{{context}}', CASE WHEN context = '' THEN '{answers.NO_CONTEXT}' ELSE context END)) AS prompt_md5
  FROM contexts""")
def prompts_rendered(spark, sf_dir):
    """The second-pass prompt of every element, as a digest."""
    return pipeline.requests(fx.markup(spark, sf_dir)).select("doc_id", "element_id", F.md5(F.col("prompt").cast("binary")).alias("prompt_md5"))


# --- answers and blocks -----------------------------------------------------------------------


@query(f"""WITH {fx.SQL_ANSWERS} SELECT doc_id, element_id, m NOT IN (0, 2) AS valid, CASE WHEN m NOT IN (0, 2) THEN item ELSE '' END AS items,
  CASE WHEN m IN (0, 1, 2) THEN '' ELSE array_to_string(w, '|') END AS keywords, CASE WHEN m NOT IN (0, 2) THEN first_word END AS summary FROM answers""")
def answers_parsed(spark, sf_dir):
    """Second-pass answers under strict JSON."""
    found = answers.parse(fx.responses(spark, sf_dir))
    return found.select("doc_id", "element_id", "valid", F.array_join("items", "|").alias("items"), F.array_join("keywords", "|").alias("keywords"), "summary")


def _blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.assemble(_elements(spark, sf_dir), blocks.latest(answers.parse(fx.responses(spark, sf_dir))))


@query(f"""WITH {fx.SQL_ELEMENTS}, {fx.SQL_ANSWERS.partition('),' + chr(10))[2].replace('FROM worded', 'FROM worded')},
joined AS (SELECT e.*, a.m, a.item, a.w, a.first_word, row_number() OVER (PARTITION BY e.doc_id ORDER BY e.page_num, e.elem_idx) - 1 AS doc_index
  FROM elements e JOIN answers a ON e.doc_id = a.doc_id AND e.element_id = a.element_id)
SELECT doc_id, element_id AS id, element_type AS type, doc_index::INT AS doc_index, CASE WHEN m NOT IN (0, 2) THEN item END AS text, page_num AS page,
  CASE WHEN element_type IN ('table', 'graph', 'diagram', 'complex_image') THEN element_type || '_p' || page_num || '_e' || doc_index END AS image_id,
  CASE WHEN m NOT IN (0, 2) THEN first_word END AS summary, CASE WHEN element_type = 'graph' THEN 'unknown' END AS graph_type FROM joined""")
def blocks_indexed(spark, sf_dir):
    """Content blocks in document order."""
    b = _blocks(spark, sf_dir)
    return b.select(
        "doc_id", "id", "type", "doc_index", "text", "page", F.coalesce("table.image_id", "graph.image_id", "diagram.image_id", "complex_image.image_id").alias("image_id"),
        F.coalesce("text_data.summary", "table.summary", "graph.summary", "diagram.summary", "complex_image.summary").alias("summary"), "graph.graph_type",
    )


@query("SELECT event_type, count(*) AS n, sum((json_extract_string(props, '$.k'))::BIGINT)::BIGINT AS total FROM events WHERE json_valid(props) GROUP BY event_type")
def events_props_json(spark, sf_dir):
    """A field of the strict JSON properties of events, by type."""
    rows = table(spark, sf_dir, "events").select("event_type", jsonio.strict_object("props").alias("p")).where("p is not null")
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(jsonio.field(F.col("p"), "$.k").cast("long")).alias("total"))


# --- sections -------------------------------------------------------------------------------


@query(f"WITH {fx.SQL_OUTLINE} SELECT doc_id, 'sec_' || id AS section_id, number, level, doc_index, CASE WHEN parent_index IS NOT NULL THEN 'sec_b' || parent_index END AS parent_id FROM tree")
def section_tree(spark, sf_dir):
    """Sections with their parents."""
    return sections.tree(fx.outline(spark, sf_dir)).select("doc_id", "section_id", "number", "level", "doc_index", "parent_id")


@query(f"""WITH {fx.SQL_OUTLINE} SELECT doc_id, 'sec_b' || (doc_index - doc_index % 3) AS section_id, count(*) AS n, string_agg(id, ',' ORDER BY doc_index) AS block_ids FROM blocks GROUP BY ALL""")
def section_blocks(spark, sf_dir):
    """Blocks of each section, in order."""
    rows = sections.with_blocks(fx.outline(spark, sf_dir))
    return rows.select("doc_id", "section_id", F.size("block_ids").cast("long").alias("n"), F.array_join("block_ids", ",").alias("block_ids"))


@query(f"WITH {fx.SQL_OUTLINE} SELECT level, count(*) AS n, count(parent_index) AS with_parent, max(len(string_split(number, '.')))::INT AS deepest FROM tree GROUP BY ROLLUP (level)")
def section_depth_rollup(spark, sf_dir):
    """Sections by level and overall."""
    rows = sections.tree(fx.outline(spark, sf_dir))
    return rows.rollup("level").agg(F.count(F.lit(1)).alias("n"), F.count("parent_id").alias("with_parent"), F.max(F.size(F.split("number", r"\."))).alias("deepest"))


@query(f"""WITH {fx.SQL_OUTLINE}, ends AS (SELECT doc_id, max(doc_index) + 1 AS e FROM blocks GROUP BY doc_id)
SELECT h.doc_id, 'sec_' || h.id AS section_id, h.level, h.doc_index AS span_start,
  coalesce((SELECT min(n.doc_index) FROM heads n WHERE n.doc_id = h.doc_id AND n.doc_index > h.doc_index AND n.level <= h.level), e)::INT AS span_end FROM heads h JOIN ends ON h.doc_id = ends.doc_id""")
def section_spans(spark, sf_dir):
    """Where each section begins and ends."""
    return sections.spans(fx.outline(spark, sf_dir))


@query(f"""WITH {fx.SQL_OUTLINE}
SELECT t.doc_id, 'sec_' || t.id AS section_id, CASE WHEN p.parent_index IS NOT NULL THEN g.number || '>' ELSE '' END || CASE WHEN t.parent_index IS NOT NULL THEN p.number || '>' ELSE '' END || t.number AS path
FROM tree t LEFT JOIN tree p ON p.doc_id = t.doc_id AND p.doc_index = t.parent_index LEFT JOIN tree g ON g.doc_id = t.doc_id AND g.doc_index = p.parent_index""")
def section_paths(spark, sf_dir):
    """Numbers from the root down to each section."""
    return sections.paths(sections.tree(fx.outline(spark, sf_dir))).select("doc_id", "section_id", F.array_join("path", ">").alias("path"))


# --- diagnostics ----------------------------------------------------------------------------


@query(f"""WITH {fx.SQL_ELEMENTS}, s AS (SELECT element_type, count(*) AS elements, count(text_preview) AS with_preview, avg(length(text_preview)) AS a FROM elements GROUP BY ROLLUP (element_type))
SELECT element_type, elements, with_preview, round(with_preview::DOUBLE / elements, 6) AS coverage, round(a, 6) AS avg_length,
  CASE WHEN with_preview::DOUBLE / elements >= 0.7 THEN 'good' WHEN with_preview::DOUBLE / elements >= 0.5 THEN 'moderate' ELSE 'poor' END AS coverage_grade,
  CASE WHEN coalesce(a, 0) >= 30 THEN 'good' WHEN coalesce(a, 0) >= 15 THEN 'moderate' ELSE 'poor' END AS length_grade FROM s""")
def preview_quality(spark, sf_dir):
    """Coverage and length of previews by type and overall."""
    return quality.preview_quality(_elements(spark, sf_dir))


@query(_SPATIAL.format(budget=500) + """ SELECT element_type, count(*) AS elements, round(avg(length(context)), 6) AS avg_length, min(length(context))::INT AS min_length, max(length(context))::INT AS max_length,
  CASE WHEN avg(length(context)) >= 100 THEN 'good' WHEN avg(length(context)) >= 50 THEN 'moderate' ELSE 'poor' END AS length_grade
  FROM contexts WHERE element_type IN ('table', 'graph', 'diagram', 'complex_image') GROUP BY ROLLUP (element_type)""")
def context_quality(spark, sf_dir):
    """Length of contexts of visual elements by type and overall."""
    return quality.context_quality(context.spatial(_elements(spark, sf_dir)))


@query("""SELECT doc_id AS key, CASE WHEN doc_id % 4 = 0 THEN 'graph' WHEN doc_id % 4 = 1 THEN 'diagram' WHEN doc_id % 4 = 2 THEN 'graph' ELSE 'graph' END AS best,
  CASE WHEN doc_id % 4 = 3 THEN 0 ELSE 1 END AS score FROM documents""")
def figure_vote(spark, sf_dir):
    """The class that three prompts vote for; a nested answer breaks off at its first closing brace and does not count."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"))
    m = F.col("key") % 4
    rows = answers.figure_prompts(docs)
    good, bad = F.lit('text {"a": 1} more'), F.lit("no json")
    reply = (
        F.when((m == 0) & (F.col("prompt_type") == "graph"), good)
        .when((m == 1) & (F.col("prompt_type") == "diagram"), F.lit('{"diagram_type": "flow"}'))
        .when((m == 3) & (F.col("prompt_type") == "diagram"), F.lit('{"items": [], "diagram_data": {"diagram_type": "flow"}}'))
        .when((m == 2) & (F.col("prompt_type") != "complex_image"), good)
        .otherwise(bad)
    )
    return quality.figure_vote(rows.withColumn("raw_response", reply))


@query("""SELECT count(CASE WHEN o_orderstatus <> 'P' THEN 1 END) AS success, count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS failed, round(sum((o_orderkey % 97)::DOUBLE), 6) AS total_seconds,
  round(avg(CASE WHEN o_orderstatus <> 'P' THEN (o_orderkey % 97)::DOUBLE END), 6) AS mean_seconds, round(avg(CASE WHEN o_orderstatus <> 'P' THEN (o_orderkey % 97)::DOUBLE END) / 60, 6) AS mean_minutes FROM orders""")
def batch_summary(spark, sf_dir):
    """Totals of a batch of results."""
    rows = table(spark, sf_dir, "orders").select(F.when(F.col("o_orderstatus") == "P", "failed").otherwise("success").alias("status"), (F.col("o_orderkey") % 97).cast("double").alias("elapsed"))
    return quality.batch_summary(rows)


@query(f"""WITH {fx.SQL_ELEMENTS}, {fx.SQL_ANSWERS.partition('),' + chr(10))[2]},
b AS (SELECT e.doc_id FROM elements e JOIN answers a ON e.doc_id = a.doc_id AND e.element_id = a.element_id)
SELECT p.doc_id, p.pages, p.elements, coalesce(b.n, 0) AS blocks, 0::BIGINT AS sections
FROM (SELECT doc_id, count(DISTINCT page_num) AS pages, count(*) AS elements FROM elements GROUP BY doc_id) p LEFT JOIN (SELECT doc_id, count(*) AS n FROM b GROUP BY doc_id) b ON p.doc_id = b.doc_id""")
def document_counts(spark, sf_dir):
    """Pages, elements, blocks and root sections of each document."""
    return pipeline.report(fx.markup(spark, sf_dir), fx.responses(spark, sf_dir))


# --- geometry -------------------------------------------------------------------------------


def _sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", (F.col("p_partkey") * 37 % 2900 + 100).cast("int").alias("w"), (F.col("p_partkey") * 53 % 3100 + 120).cast("int").alias("h"))


_GRIDS = ", ".join(f"({n}, {i}, {j})" for n, (i, j) in enumerate(geometry.tile_grids()))
_PLAN = f"""WITH RECURSIVE sizes AS (SELECT p_partkey, (p_partkey * 37 % 2900 + 100)::INT AS w, (p_partkey * 53 % 3100 + 120)::INT AS h FROM part),
grids(n, i, j) AS (VALUES {_GRIDS}),
fold AS (SELECT p_partkey, w, h, 0 AS n, 'infinity'::DOUBLE AS diff, 1 AS cols, 1 AS rows FROM sizes
  UNION ALL SELECT p_partkey, w, h, f.n + 1,
    CASE WHEN abs(w::DOUBLE / h - i::DOUBLE / j) < diff THEN abs(w::DOUBLE / h - i::DOUBLE / j) ELSE diff END,
    CASE WHEN abs(w::DOUBLE / h - i::DOUBLE / j) < diff OR (abs(w::DOUBLE / h - i::DOUBLE / j) = diff AND w::DOUBLE * h > 204800.0::DOUBLE * i * j) THEN i ELSE cols END,
    CASE WHEN abs(w::DOUBLE / h - i::DOUBLE / j) < diff OR (abs(w::DOUBLE / h - i::DOUBLE / j) = diff AND w::DOUBLE * h > 204800.0::DOUBLE * i * j) THEN j ELSE rows END
  FROM fold f JOIN grids g ON g.n = f.n),
plan AS (SELECT p_partkey, w, h, CASE WHEN w <= 640 AND h <= 640 THEN 1 ELSE cols END AS cols, CASE WHEN w <= 640 AND h <= 640 THEN 1 ELSE rows END AS rows FROM fold WHERE n = {len(geometry.tile_grids())})"""


@query(_PLAN + " SELECT p_partkey, w, h, cols, rows FROM plan")
def tile_plan(spark, sf_dir):
    """The tile grid of many page sizes."""
    rows = _sizes(spark, sf_dir).withColumn("g", geometry.crop_grid(F.col("w"), F.col("h")))
    return rows.select("p_partkey", "w", "h", "g.cols", "g.rows")


@query(_PLAN + " SELECT cols, rows, 16 * 17 + 1 + CASE WHEN cols > 1 OR rows > 1 THEN rows * 10 * (cols * 10 + 1) ELSE 0 END AS tokens, count(*) AS n FROM plan GROUP BY ALL")
def vision_tokens(spark, sf_dir):
    """Vision tokens by grid."""
    rows = _sizes(spark, sf_dir).withColumn("g", geometry.crop_grid(F.col("w"), F.col("h")))
    return rows.groupBy("g.cols", "g.rows", geometry.vision_tokens(F.col("g")).alias("tokens")).agg(F.count(F.lit(1)).alias("n"))


@query(_PLAN + " SELECT p_partkey, k::INT AS tile, ((k % cols) * 640)::INT AS x1, ((k // cols) * 640)::INT AS y1, ((k % cols + 1) * 640)::INT AS x2, ((k // cols + 1) * 640)::INT AS y2 FROM (SELECT *, unnest(range(0, cols * rows)) AS k FROM plan)")
def tile_boxes(spark, sf_dir):
    """Boxes of the tiles."""
    rows = _sizes(spark, sf_dir).select("p_partkey", F.posexplode(geometry.tile_boxes(geometry.crop_grid(F.col("w"), F.col("h")))).alias("tile", "b"))
    return rows.select("p_partkey", "tile", "b.*")


@query("""WITH ids AS (SELECT doc_id, list_transform(string_split(text, ' '), lambda x: length(x)::INT) AS ids FROM documents),
s AS (SELECT doc_id, ids, len(ids) AS n FROM ids),
g AS (SELECT doc_id, ids, n, unnest(range(greatest(0, n - 50), greatest(n - 2, 0))) AS i FROM s WHERE n >= 3),
hits AS (SELECT DISTINCT doc_id, ids[i + 3] AS b FROM g WHERE ids[i + 1] = ids[n - 1] AND ids[i + 2] = ids[n] AND ids[i + 3] <> 5)
SELECT s.doc_id, coalesce(string_agg(b::VARCHAR, ',' ORDER BY b), '') AS banned FROM s LEFT JOIN hits ON s.doc_id = hits.doc_id GROUP BY s.doc_id""")
def ngram_ban_whole(spark, sf_dir):
    """Tokens that would repeat a trigram, over word lengths of each whole document."""
    ids = F.transform(F.split("text", " ", -1), lambda x: F.length(x))
    rows = table(spark, sf_dir, "documents").select("doc_id", ids.alias("ids"))
    return rows.select("doc_id", F.array_join(F.transform(geometry.banned(F.col("ids"), 3, 50, [5]), lambda x: x.cast("string")), ",").alias("banned"))


# --- documents, sources, streams ----------------------------------------------------------------


@query(f"""WITH {fx.SQL_ELEMENTS}, {fx.SQL_ANSWERS.partition('),' + chr(10))[2]},
b AS (SELECT e.doc_id, e.element_id, e.page_num, e.elem_idx FROM elements e JOIN answers a ON e.doc_id = a.doc_id AND e.element_id = a.element_id)
SELECT p.doc_id, '1.0.0' AS version, p.page_count, coalesce(n, 0)::BIGINT AS n_blocks, last_id FROM (SELECT doc_id, count(DISTINCT page_num)::INT AS page_count FROM elements GROUP BY doc_id) p
LEFT JOIN (SELECT doc_id, count(*) AS n, arg_max(element_id, page_num * 100 + elem_idx) AS last_id FROM b GROUP BY doc_id) b ON p.doc_id = b.doc_id""")
def docjson_roundtrip(spark, sf_dir):
    """Documents assembled, written as JSON and read back."""
    made = pipeline.documents(fx.markup(spark, sf_dir), fx.responses(spark, sf_dir))
    back = docjson.from_json(docjson.to_json(made))
    return back.select("doc_id", "version", "metadata.page_count", F.size("blocks").cast("long").alias("n_blocks"), F.get(F.col("blocks"), F.size("blocks") - 1)["id"].alias("last_id"))


@query("SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_antijoin(spark, sf_dir):
    """Documents without a result yet."""
    return files.outstanding(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), table(spark, sf_dir, "labels"))


@query("SELECT event_type, date_trunc('hour', ts) AS window_start, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def event_windows(spark, sf_dir):
    """Beyond parity: events per type and hour."""
    return drain.event_counts(table(spark, sf_dir, "events"))


@query(r"""SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY k) - 1)::INT AS elem_idx, tag, body FROM (
  SELECT page_id, k, tags[k] AS tag, trim(bodies[k]) AS body FROM (
    SELECT page_id, regexp_extract_all(html, '<(h1|p|li)>([^<]*)', 1) AS tags, regexp_extract_all(html, '<(h1|p|li)>([^<]*)', 2) AS bodies,
      unnest(range(1, len(regexp_extract_all(html, '<(h1|p|li)>', 1)) + 1)) AS k FROM pages))""")
def web_elements(spark, sf_dir):
    """Beyond parity: headings, paragraphs and list items of web pages."""
    found = table(spark, sf_dir, "pages").select(
        "page_id", F.posexplode(F.arrays_zip(*[F.regexp_extract_all("html", F.lit("<(h1|p|li)>([^<]*)"), F.lit(k)).alias(n) for k, n in ((1, "tag"), (2, "body"))])).alias("elem_idx", "e")
    )
    return found.select("page_id", "elem_idx", "e.tag", F.trim("e.body").alias("body"))


# --- answers of every form, payloads, reports -----------------------------------------------------


_OWN_ANSWERS = fx.SQL_ANSWERS.partition(")," + chr(10))[2]


@query(f"""WITH {fx.SQL_ELEMENTS}, {_OWN_ANSWERS},
late AS (SELECT doc_id, 'page_' || (i // {fx.LINES} + 1) || '_e' || (i % {fx.LINES}) AS element_id FROM lines WHERE (doc_id + i) % 4 = 0)
SELECT e.doc_id, e.element_id AS id, CASE WHEN l.element_id IS NOT NULL THEN 'later' WHEN m NOT IN (0, 2) THEN item END AS text,
  CASE WHEN l.element_id IS NOT NULL THEN 'corrected' WHEN m NOT IN (0, 2) THEN first_word END AS summary
FROM elements e LEFT JOIN answers a ON e.doc_id = a.doc_id AND e.element_id = a.element_id LEFT JOIN late l ON e.doc_id = l.doc_id AND e.element_id = l.element_id
WHERE a.element_id IS NOT NULL OR l.element_id IS NOT NULL""")
def repeated_answers(spark, sf_dir):
    """Of several answers to an element the last counts."""
    b = blocks.assemble(_elements(spark, sf_dir), blocks.latest(answers.parse(fx.repeated(spark, sf_dir))))
    return b.select("doc_id", "id", "text", F.coalesce("text_data.summary", "table.summary", "graph.summary", "diagram.summary", "complex_image.summary").alias("summary"))


_FULL = f"""WITH {fx.SQL_ELEMENTS},
worded AS (SELECT doc_id, i, regexp_extract_all(lower(line), '[a-z]{{2,}}')[1:3] AS w FROM lines),
held AS (
  SELECT e.*, w.i, w.w, coalesce(w.w[1], '') AS w1, coalesce(w.w[2], '') AS w2, coalesce(w.w[3], '') AS w3, (w.i + 1) || CASE WHEN w.i % 3 = 0 THEN '' ELSE '.' || (w.i % 3) END AS number,
    (row_number() OVER (PARTITION BY e.doc_id ORDER BY e.page_num, e.elem_idx) - 1)::INT AS doc_index
  FROM elements e JOIN worded w ON e.doc_id = w.doc_id AND w.i = (e.page_num - 1) * {fx.LINES} + e.elem_idx)"""
_IS = lambda kind, value: f"CASE WHEN element_type = '{kind}' THEN {value} END"


@query(f"""{_FULL} SELECT doc_id, element_id AS id, element_type AS type, doc_index, number || '. ' || w1 AS text, page_num AS page, x1, y1, x2, y2, w1 AS summary, array_to_string(w, '|') AS keywords,
  CASE WHEN element_type LIKE 'text%' THEN number END AS numbering, CASE WHEN element_type = 'text_section' THEN len(string_split(number, '.'))::INT END AS level,
  CASE WHEN element_type NOT LIKE 'text%' THEN element_type || '_p' || page_num || '_e' || doc_index END AS image_id,
  {_IS("table", "'| a |' || chr(10) || '|---|' || chr(10) || '| ' || w1 || ' |'")} AS markdown, {_IS("table", "0")} AS cells, {_IS("table", "i % 2 = 0")} AS table_complex, {_IS("table", "doc_index")} AS table_index,
  {_IS("graph", "w1")} AS title, {_IS("graph", "'bar'")} AS graph_type, {_IS("graph", "w2")} AS x_label, {_IS("graph", "w3")} AS y_unit, {_IS("graph", "w1 || '|' || w2")} AS legend, {_IS("graph", "'up'")} AS trends,
  {_IS("diagram", "'flow'")} AS diagram_type, {_IS("diagram", "'a=' || w1")} AS components, {_IS("diagram", "'a>b'")} AS connections, {_IS("diagram", "'graph TD'")} AS mermaid, {_IS("diagram", "i % 3 = 0")} AS diagram_complex,
  {_IS("diagram", "x2")} AS diagram_x2, {_IS("complex_image", "'photo'")} AS underlying_type, {_IS("complex_image", "w3")} AS visible_text, {_IS("complex_image", "'dense|small'")} AS reasons
FROM held""")
def documents_whole(spark, sf_dir):
    """Every field of every block after a round trip through JSON."""
    made = pipeline.documents(fx.markup(spark, sf_dir), fx.full_responses(spark, sf_dir))
    b = docjson.from_json(docjson.to_json(made)).select("doc_id", F.explode("blocks").alias("b")).select("doc_id", "b.*")
    kinds = ("text_data", "table", "graph", "diagram", "complex_image")
    either = lambda name, own=kinds: F.coalesce(*[F.col(f"{k}.{name}") for k in own])
    pairs = lambda c, x, y, mark: F.array_join(F.transform(c, lambda s: F.concat(s[x], F.lit(mark), s[y])), "|")
    return b.select(
        "doc_id", "id", "type", "doc_index", "text", "page", "bbox.x1", "bbox.y1", "bbox.x2", "bbox.y2", either("summary").alias("summary"), F.array_join(either("keywords"), "|").alias("keywords"),
        "text_data.numbering", "level", either("image_id", kinds[1:]).alias("image_id"),
        "table.markdown", (F.col("table.rows") + F.col("table.cols") + F.size("table.data")).alias("cells"), F.col("table.is_complex").alias("table_complex"), F.col("table.doc_index").alias("table_index"),
        "graph.title", "graph.graph_type", F.col("graph.x_axis")["label"].alias("x_label"), F.col("graph.y_axis")["unit"].alias("y_unit"), F.array_join("graph.legend", "|").alias("legend"), F.array_join("graph.data_trends", "|").alias("trends"),
        "diagram.diagram_type", pairs("diagram.components", "id", "label", "=").alias("components"), pairs("diagram.connections", "from", "to", ">").alias("connections"), "diagram.mermaid", F.col("diagram.is_complex").alias("diagram_complex"),
        F.col("diagram.bbox.x2").alias("diagram_x2"), "complex_image.underlying_type", "complex_image.visible_text", F.array_join("complex_image.complexity_reasons", "|").alias("reasons"),
    )


@query(f"""{_FULL}, heads AS (SELECT doc_id, doc_index, len(string_split(number, '.')) AS level FROM held WHERE element_type = 'text_section'),
roots AS (SELECT doc_id, count(*) AS sections FROM heads h WHERE level = 1 OR NOT EXISTS (SELECT 1 FROM heads p WHERE p.doc_id = h.doc_id AND p.doc_index < h.doc_index AND p.level < h.level) GROUP BY doc_id)
SELECT h.doc_id, count(DISTINCT page_num) AS pages, count(*) AS elements, count(*) AS blocks, coalesce(any_value(r.sections), 0) AS sections FROM held h LEFT JOIN roots r ON h.doc_id = r.doc_id GROUP BY h.doc_id""")
def document_totals(spark, sf_dir):
    """Pages, elements, blocks and root sections where answers hold section numbers."""
    return pipeline.report(fx.markup(spark, sf_dir), fx.full_responses(spark, sf_dir))


@query(f"""WITH {fx.SQL_OUTLINE}, held AS (SELECT doc_id, doc_index - doc_index % 3 AS head, string_agg(id, ',' ORDER BY doc_index) AS block_ids FROM blocks GROUP BY ALL)
SELECT t.doc_id, 'sec_' || t.id AS id, t.number, t.level, t.doc_index::INT AS doc_index, CASE WHEN t.parent_index IS NOT NULL THEN 'sec_b' || t.parent_index END AS parent_id, h.block_ids, t.id AS heading_block_id,
  (t.doc_index + 1)::INT AS span_end FROM tree t JOIN held h ON h.doc_id = t.doc_id AND h.head = t.doc_index""")
def documents_sections(spark, sf_dir):
    """Every section of every document after a round trip through JSON."""
    rows = fx.outline(spark, sf_dir)
    made = docjson.assemble(rows, rows.groupBy("doc_id").agg(F.lit(1).alias("page_count")))
    s = docjson.from_json(docjson.to_json(made)).select("doc_id", F.explode("sections").alias("s")).select("doc_id", "s.*")
    return s.select("doc_id", "id", "number", "level", "doc_index", "parent_id", F.array_join("block_ids", ",").alias("block_ids"), "heading_block_id", F.col("span")[1].alias("span_end"))


@query(f"""WITH {fx.SQL_LINES}, boxed AS (SELECT doc_id, i AS elem_idx, i * 13 % 400 AS x, i % 6 AS m FROM lines)
SELECT doc_id, elem_idx, trunc(x / 999.0::DOUBLE * 1000) AS x1, trunc((CASE WHEN m = 0 THEN x + 1 ELSE x END) / 999.0::DOUBLE * 1000) AS y1,
  trunc((CASE m WHEN 0 THEN x + 50 WHEN 3 THEN 500 ELSE 700 END) / 999.0::DOUBLE * 1000) AS x2, trunc((CASE m WHEN 0 THEN x + 60 WHEN 3 THEN 600 ELSE 800 END) / 999.0::DOUBLE * 1000) AS y2
FROM boxed WHERE m IN (0, 3, 4)""")
def boxes_kept(spark, sf_dir):
    """Elements whose boxes are short, empty or no numbers go, the others keep their place."""
    return grounding.parse(fx.boxes(spark, sf_dir)).select("doc_id", "elem_idx", "bbox.x1", "bbox.y1", "bbox.x2", "bbox.y2")


@query(f"""WITH {fx.SQL_ELEMENTS} SELECT element_type, count(*) AS elements, count(text_preview) AS with_preview, count(*) - count(text_preview) AS without_preview, round(coalesce(avg(length(text_preview)), 0), 6) AS avg_length,
  coalesce(min(length(text_preview)), 0)::INT AS min_length, coalesce(max(length(text_preview)), 0)::INT AS max_length FROM elements GROUP BY ROLLUP (element_type)""")
def preview_lengths(spark, sf_dir):
    """Elements with and without preview, and the lengths of previews, by type and overall."""
    return quality.preview_lengths(_elements(spark, sf_dir))


@query(f"""WITH {fx.SQL_ELEMENTS}, n AS (SELECT label, count(*) AS n, min(doc_id * 1000000 + page_num * 100 + elem_idx) AS place FROM elements GROUP BY label)
SELECT label, n, (row_number() OVER (ORDER BY n DESC, place))::INT AS rank FROM n""")
def labels_by_count(spark, sf_dir):
    """The label report's order: the most frequent first, then the earliest."""
    found = quality.label_report(_elements(spark, sf_dir).withColumn("place", F.struct("doc_id", "page_num", "elem_idx")))
    return found.select("label", "n", F.row_number().over(Window.orderBy(F.desc("n"), "place")).alias("rank"))  # a row per label


@query(f"WITH {fx.SQL_ELEMENTS} SELECT element_type, count(*) AS n, (row_number() OVER (ORDER BY element_type))::INT AS rank FROM elements GROUP BY element_type")
def types_by_name(spark, sf_dir):
    """The type report's order."""
    found = quality.type_report(_elements(spark, sf_dir))
    return found.select("element_type", "n", F.row_number().over(Window.orderBy("element_type")).alias("rank"))  # a row per type


@query(f"""WITH {fx.SQL_ELEMENTS} SELECT doc_id, page_num, count(*)::INT AS n, string_agg(element_id || ':' || element_type || ':' || x1::INT || ':' || coalesce(length(text_preview), -1), ',' ORDER BY elem_idx) AS elements
FROM elements GROUP BY doc_id, page_num""")
def pages_nested(spark, sf_dir):
    """Pages as JSON of their elements, read back."""
    own = "page_num int, elements array<struct<element_id:string,element_type:string,bbox:struct<x1:double>,text_preview:string>>"
    d = docjson.page_json(_elements(spark, sf_dir)).select("doc_id", F.from_json("json", own).alias("d"))
    one = lambda e: F.concat_ws(":", e["element_id"], e["element_type"], e["bbox"]["x1"].cast("int"), F.coalesce(F.length(e["text_preview"]), F.lit(-1)))
    return d.select("doc_id", "d.page_num", F.size("d.elements").alias("n"), F.array_join(F.transform("d.elements", one), ",").alias("elements"))


@query(f"WITH {fx.SQL_ELEMENTS} SELECT doc_id, element_id, element_type, x2, page_num AS page, 1.0::DOUBLE AS confidence, text_preview FROM elements")
def elements_json(spark, sf_dir):
    """Elements as JSON, read back."""
    own = "element_id string, element_type string, bbox struct<x2:double,page:int>, confidence double, text_preview string"
    d = docjson.element_json(_elements(spark, sf_dir)).select("doc_id", F.from_json("json", own).alias("d"))
    return d.select("doc_id", "d.element_id", "d.element_type", "d.bbox.x2", "d.bbox.page", "d.confidence", "d.text_preview")


# --- sources and providers ------------------------------------------------------------------------


@query(r"""WITH p AS (SELECT doc_id, 'in/' || source || '/' || CASE WHEN doc_id % 3 = 0 THEN '.' || doc_id ELSE doc_id || '.' || lang || '.pdf' END AS path FROM documents)
SELECT doc_id, regexp_replace(regexp_extract(path, '([^/]*)$', 1), '(.)\.[^.]*$', '\1') AS stem FROM p""")
def file_stems(spark, sf_dir):
    """Output names from paths; a leading point begins no extension."""
    name = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("."), "doc_id")).otherwise(F.concat("doc_id", F.lit("."), "lang", F.lit(".pdf")))
    return table(spark, sf_dir, "documents").select("doc_id", text.stem(F.concat(F.lit("in/"), "source", F.lit("/"), name)).alias("stem"))


@query(_PLAN + f""", t AS (SELECT p_partkey, cols, rows, 16 * 17 + 1 + CASE WHEN cols > 1 OR rows > 1 THEN rows * 10 * (cols * 10 + 1) ELSE 0 END AS tokens FROM plan)
SELECT p_partkey, cols * rows <> 1 AS thumbnail, tokens::BIGINT * {2 * 2048 * 1280} AS flops, 1280 AS largest_width FROM t""")
def image_totals(spark, sf_dir):
    """Thumbnails, the projector's operations and the largest view."""
    rows = _sizes(spark, sf_dir).withColumn("g", geometry.crop_grid(F.col("w"), F.col("h")))
    tokens = geometry.vision_tokens(F.col("g"))
    return rows.select("p_partkey", geometry.has_thumbnail(F.col("g"), True).alias("thumbnail"), geometry.projector_flops(tokens).alias("flops"), F.lit(geometry.largest_view()[0]).alias("largest_width"))


@query(f"WITH {fx.SQL_LINES} SELECT doc_id, i, CASE WHEN (doc_id + i) % 5 <> 0 THEN line END AS raw_response FROM lines")
def recorded_answers(spark, sf_dir):
    """Recorded answers meet their requests by key; requests without one stay."""
    rows = fx.lines(spark, sf_dir)
    said = rows.where((F.col("doc_id") + F.col("i")) % 5 != 0).select("doc_id", "i", F.col("line").alias("raw_response"))
    return providers.recorded(rows.select("doc_id", "i"), said, ["doc_id", "i"])


@query(f"WITH {fx.SQL_LINES} SELECT doc_id, i, length(line) || ':' || line AS raw_response, NULL::VARCHAR AS error FROM lines")
def inferred_answers(spark, sf_dir):
    """A model's answers in batches, every row with its own key, without the end mark."""
    return providers.infer(fx.lines(spark, sf_dir).select("doc_id", "i", F.col("line").alias("prompt")), fx.Counting, "<end>").select("doc_id", "i", "raw_response", "error")


@query(f"""WITH {fx.SQL_LINES} SELECT doc_id::VARCHAR AS doc_id, i + 1 AS page_num, trim(line, ' ' || chr(9) || chr(13)) AS text_layer, octet_length(encode(line))::INT AS width, 200 AS height, NULL::VARCHAR AS error FROM lines WHERE doc_id % 7 <> 3
UNION ALL SELECT doc_id::VARCHAR, NULL, NULL, NULL, NULL, 'ValueError: no pages' FROM documents WHERE doc_id % 7 = 3""")
def rendered_pages(spark, sf_dir):
    """Files rendered to numbered pages; a broken file is one row with its error."""
    content = F.when(F.col("doc_id") % 7 == 3, "broken").otherwise(F.col("text")).cast("binary")
    files_ = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), content.alias("content"))
    return files.render(files_, fx.by_line).select("doc_id", "page_num", "text_layer", "width", "height", "error")
