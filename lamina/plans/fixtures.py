"""Closed-form inputs derived from the corpus tables, the same in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table

WIDTH, HEIGHT, LINES = 1700, 2200, 8
LABELS = (
    "title heading section-header section_header text paragraph table graph chart plot figure diagram flowchart image photo picture "
    "text_paragraph caption flow-chart figure_2"
).split()


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, i, line."""
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("i", "line"))


def _label(doc: Column, i: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in LABELS]), ((doc * 7 + i * 3) % len(LABELS) + 1).cast("int"))


def markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, page_num, width, height, raw_response: eight lines a page as grounding markup. No shuffle."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.split("text", "\n", -1).alias("lines"))
    docs = docs.select("doc_id", "lines", F.explode(F.sequence(F.lit(0), ((F.size("lines") - 1) / LINES).cast("int"))).alias("p"))
    own = F.slice("lines", F.col("p") * LINES + 1, F.lit(LINES))

    def element(line: Column, k: Column) -> Column:
        i = F.col("p") * LINES + k
        x, y = (i * 13) % 400, (i * 37) % 900
        box = F.concat(F.lit("[["), x, F.lit(","), y, F.lit(","), 400 + (i * 11) % 600, F.lit(","), y + 60, F.lit("]]"))
        return F.concat(F.lit("<|ref|>"), _label(F.col("doc_id"), i), F.lit("<|/ref|><|det|>"), box, F.lit("<|/det|>\n"), line)

    return docs.select(
        "doc_id", (F.col("p") + 1).alias("page_num"), F.lit(WIDTH).alias("width"), F.lit(HEIGHT).alias("height"), F.array_join(F.transform(own, element), "\n").alias("raw_response")
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, element_id, answer_idx, raw_response: second-pass answers, some broken, some bare lists, some missing."""
    rows = lines(spark, sf_dir).select("doc_id", "i", F.slice(F.regexp_extract_all(F.lower("line"), F.lit("[a-z]{2,}"), F.lit(0)), 1, 3).alias("w"))
    w = lambda k: F.coalesce(F.get("w", F.lit(k)), F.lit(""))
    m = (F.col("doc_id") + F.col("i")) % 11
    items = F.concat(F.lit('{"items":["'), w(0), F.lit(" "), w(1), F.lit('"]'))
    keys = F.concat(F.lit(',"keywords":['), F.array_join(F.transform("w", lambda x: F.concat(F.lit('"'), x, F.lit('"'))), ","), F.lit("]"))
    end = F.concat(F.lit(',"summary":"'), w(0), F.lit('"}'))
    whole = F.concat(items, keys, end)
    answer = F.when(m == 0, F.concat(whole, F.lit(" trailing"))).when(m == 1, F.concat(items, end)).when(m == 2, F.concat(F.lit("["), whole, F.lit("]"))).otherwise(whole)
    return rows.where(m != 3).select(
        "doc_id", F.concat(F.lit("page_"), (F.floor(F.col("i") / LINES) + 1).cast("int"), F.lit("_e"), F.col("i") % LINES).alias("element_id"), F.col("i").alias("answer_idx"), answer.alias("raw_response")
    )


def _element_id() -> Column:
    return F.concat(F.lit("page_"), (F.floor(F.col("i") / LINES) + 1).cast("int"), F.lit("_e"), F.col("i") % LINES)


def repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """responses, and a later answer to every fourth element."""
    again = lines(spark, sf_dir).where((F.col("doc_id") + F.col("i")) % 4 == 0)
    late = F.lit('{"items":["later"],"keywords":[],"summary":"corrected"}')
    return responses(spark, sf_dir).unionByName(again.select("doc_id", _element_id().alias("element_id"), (F.col("i") + 1_000_000).alias("answer_idx"), late.alias("raw_response")))


def full_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An answer to every element, with a section number of depth 1 or 2 and a payload for each type."""
    rows = lines(spark, sf_dir).select("doc_id", "i", F.slice(F.regexp_extract_all(F.lower("line"), F.lit("[a-z]{2,}"), F.lit(0)), 1, 3).alias("w"))
    w = [F.coalesce(F.get("w", F.lit(k)), F.lit("")) for k in range(3)]
    number = F.concat((F.col("i") + 1).cast("string"), F.when(F.col("i") % 3 == 0, ".").otherwise(F.concat(F.lit("."), F.col("i") % 3, F.lit("."))))
    complex_ = lambda n: F.when(F.col("i") % n == 0, "complex").otherwise("simple")
    graph = F.struct(w[0].alias("title"), F.lit("bar").alias("graph_type"), F.struct(w[1].alias("label")).alias("x_axis"), F.struct(w[2].alias("unit")).alias("y_axis"), F.array(w[0], w[1]).alias("legend"), F.array(F.lit("up")).alias("trends"))
    diagram = F.struct(
        F.lit("flow").alias("diagram_type"), F.array(F.struct(F.lit("a").alias("id"), w[0].alias("label"))).alias("components"),
        F.array(F.struct(F.lit("a").alias("from"), F.lit("b").alias("to"))).alias("connections"), F.lit("graph TD").alias("mermaid"), complex_(3).alias("complexity"),
    )
    picture = F.struct(F.lit("photo").alias("underlying_type"), w[2].alias("visible_text"), F.array(F.lit("dense"), F.lit("small")).alias("complexity_reasons"))
    answer = F.struct(
        F.array(F.concat(number, F.lit(" "), w[0]), w[1]).alias("items"), F.col("w").alias("keywords"), w[0].alias("summary"), F.concat(F.lit("| a |\n|---|\n| "), w[0], F.lit(" |")).alias("markdown"),
        complex_(2).alias("complexity"), graph.alias("graph_data"), diagram.alias("diagram_data"), picture.alias("complexity_data"),
    )
    return rows.select("doc_id", _element_id().alias("element_id"), F.col("i").alias("answer_idx"), F.to_json(answer).alias("raw_response"))


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page per document with a tagged line each, of whose boxes half are short, empty or no numbers."""
    x = F.col("i") * 13 % 400
    box = F.element_at(
        F.array(
            F.format_string("[[%d,%d,%d,%d]]", x, x + 1, x + 50, x + 60), F.format_string("[[%d,%d,%d]]", x, x, x), F.format_string("[[%d,%d,abc,9]]", x, x),
            F.format_string("[[ %d , %d , 500 , 600 ]]", x, x), F.format_string("[[%d,%d,700,800,9]]", x, x), F.lit("[]"),
        ),
        (F.col("i") % 6 + 1).cast("int"),
    )
    rows = lines(spark, sf_dir).withColumn("x", F.struct("i", F.concat(F.lit("<|ref|>text<|/ref|><|det|>"), box, F.lit("<|/det|>\n"), "line").alias("t")))
    held = rows.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda r: r["t"]), "\n").alias("raw_response"))
    return held.select("doc_id", F.lit(1).alias("page_num"), F.lit(1000).alias("width"), F.lit(1000).alias("height"), "raw_response")


class Counting:
    """A model that says each prompt with its length in front and an end mark behind."""

    def __call__(self, prompts: list[str], images: list[bytes | None]) -> list[str]:
        return [f"{len(p)}:{p}<end>" for p in prompts]


def by_line(content: bytes, dpi: int, with_text: bool):
    """A renderer whose pages are the lines of a file."""
    if content == b"broken":
        raise ValueError("no pages")
    for line in content.split(b"\n"):
        yield line, line.decode() if with_text else None, len(line), dpi


def outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks in which every third line is a numbered heading of depth 1 to 3."""
    rows = lines(spark, sf_dir)
    k, head = F.floor(F.col("i") / 3).cast("int"), F.col("i") % 3 == 0
    d = 1 + (F.col("doc_id") + k) % 3
    number = F.concat((k + 1).cast("string"), F.lit("."), F.when(d >= 2, "1.").otherwise(""), F.when(d >= 3, "1.").otherwise(""))
    body = F.when(head, F.concat(number, F.lit(" "), F.col("line"))).otherwise(F.col("line"))
    from ..functions import text

    rows = rows.select(
        "doc_id", F.concat(F.lit("b"), F.col("i")).alias("id"), F.when(head, "text_section").otherwise("text_paragraph").alias("type"), F.col("i").alias("doc_index"), body.alias("text")
    )
    return rows.withColumn("numbering", F.when(F.col("type") == "text_section", text.numbering(F.col("text"))))


#: Common table expressions for the SQL twins.
SQL_LINES = """lines AS (
  SELECT doc_id, i::INT AS i, ls[i + 1] AS line FROM (SELECT doc_id, ls, unnest(range(0, len(ls))) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)))"""
_LIST = ", ".join(f"'{x}'" for x in LABELS)
SQL_ELEMENTS = f"""{SQL_LINES},
labelled AS (SELECT *, [{_LIST}][((doc_id * 7 + i * 3) % {len(LABELS)} + 1)::INT] AS label FROM lines),
elements AS (
  SELECT doc_id, (i // {LINES} + 1)::INT AS page_num, (i % {LINES})::INT AS elem_idx, 'page_' || (i // {LINES} + 1) || '_e' || (i % {LINES}) AS element_id, label,
    CASE WHEN label IN ('title', 'heading') THEN 'text_header' WHEN label IN ('section-header', 'section_header') THEN 'text_section'
         WHEN label IN ('text', 'paragraph', 'caption') THEN 'text_paragraph' WHEN label = 'table' THEN 'table'
         WHEN label IN ('graph', 'chart', 'plot', 'text_paragraph', 'flow-chart') THEN 'graph' WHEN label IN ('figure', 'diagram', 'flowchart') THEN 'diagram'
         ELSE 'complex_image' END AS element_type,
    trunc((i * 13 % 400) / 999.0::DOUBLE * {WIDTH}) AS x1, trunc((i * 37 % 900) / 999.0::DOUBLE * {HEIGHT}) AS y1,
    trunc((400 + i * 11 % 600) / 999.0::DOUBLE * {WIDTH}) AS x2, trunc((i * 37 % 900 + 60) / 999.0::DOUBLE * {HEIGHT}) AS y2,
    CASE WHEN trim(line, ' ' || chr(9) || chr(13)) = '' THEN NULL WHEN length(trim(line, ' ' || chr(9) || chr(13))) > 50
         THEN left(trim(line, ' ' || chr(9) || chr(13)), 47) || '...' ELSE trim(line, ' ' || chr(9) || chr(13)) END AS text_preview
  FROM labelled)"""
SQL_ANSWERS = f"""{SQL_LINES},
worded AS (SELECT doc_id, i, regexp_extract_all(lower(line), '[a-z]{{2,}}')[1:3] AS w FROM lines),
answers AS (
  SELECT doc_id, i, 'page_' || (i // {LINES} + 1) || '_e' || (i % {LINES}) AS element_id, (doc_id + i) % 11 AS m, coalesce(w[1], '') || ' ' || coalesce(w[2], '') AS item,
    w, coalesce(w[1], '') AS first_word FROM worded WHERE (doc_id + i) % 11 <> 3)"""
SQL_OUTLINE = f"""{SQL_LINES},
blocks AS (
  SELECT doc_id, i AS doc_index, 'b' || i AS id, i % 3 = 0 AS head, (1 + (doc_id + i // 3) % 3)::INT AS d, (i // 3 + 1) AS k, line FROM lines),
heads AS (
  SELECT doc_id, doc_index, id, d AS level, k || CASE WHEN d >= 2 THEN '.1' ELSE '' END || CASE WHEN d >= 3 THEN '.1' ELSE '' END AS number FROM blocks WHERE head),
tree AS (
  SELECT h.*, (SELECT max(p.doc_index) FROM heads p WHERE p.doc_id = h.doc_id AND p.doc_index < h.doc_index AND p.level < h.level) AS parent_index FROM heads h)"""
