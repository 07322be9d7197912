"""URL filter: a path-template tree per host, in DataFrame functions only.

Paths are split into segments; digit runs become ``{n}``. The tree is built level by level.
Siblings below one generalised prefix of a host are candidates for each other when the same
kinds of next segments make up a tenth or more of their urls. Of such candidates those merge
into ``*`` with these kinds (``*(.)`` where the path ends) that are statistically alike: a
chi-square test holds the counts of their next segments against those of all candidates together,
which rare ones need not pass, and a binomial test their labelled block rate, where they have
labels. Two siblings at least must merge. Children are then counted anew below the merged prefix, so
branches that merge pool their children on every level. Below ``levels`` segments the rest of a path counts as one.

A template's purity is its share of blocked labels, smoothed towards its parent's purity and
towards one half, and so on up to the host's, which is smoothed towards the share among all labels. Templates
whose purity reaches ``purity`` are rejected. Labels come from the rules: a url that a rule fits is
labelled by that rule; the template decides the others. So evidence reaches unlabelled
urls through merged branches; a parent's purity alone never rejects a branch.

Defined edge cases: a null url or one without ``://`` has an empty host and path, no rule
and the verdict of the template (allow when nothing is blocked). Repeated rows are judged one by
one and count as evidence one by one. An empty table gives an empty result. Other columns
of the input are ignored, whatever their names; a very long path is a single deep template.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (verdict, rule): the rules of the registered query.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://`` up to / ? # or the end, A-Z lower-cased; path up to ? or #."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: len(r[1])):
        name, _, prefix = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit("/" + prefix))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


#: Tree: segments that are told apart, share below which a sibling is rare, tests in standard deviations,
#: weights of the prior of a host and of a node, purity that rejects.
LEVELS, MIN_SHARE, DEVIATIONS, HOST_PRIOR, PRIOR, PURITY = 8, 0.05, 3.0, 10.0, 2.0, 0.8


def leaves_of(rows: DataFrame, levels: int) -> DataFrame:
    """host, shape, parts (at most levels + 1), n, labelled, blocked of rows (host, path, by_rule)."""
    counted = rows.groupBy("host", "shape").agg(
        F.count(F.lit(1)).alias("n"), F.count("by_rule").alias("labelled"), F.count_if(F.col("by_rule") == "block").alias("blocked")
    )
    return counted.withColumn("parts", F.split("shape", "/", levels + 1))


def merged_level(tree: DataFrame, depth: int, min_share: float, deviations: float) -> DataFrame:
    """tree (leaves with their generalised prefix) with the segment at depth added to prefix, merged where siblings are alike."""
    at = tree.withColumn("part", F.get("parts", F.lit(depth))).withColumn("child", F.coalesce(F.get("parts", F.lit(depth + 1)), F.lit("")))
    live = at.where("part is not null")
    cells = live.groupBy("host", "prefix", "part", "child").agg(F.sum("n").alias("o"), F.sum("labelled").alias("l"), F.sum("blocked").alias("b"))
    each = cells.groupBy("host", "prefix", "part").agg(F.sum("o").alias("n"))
    # the kinds that make up a tenth of a sibling: ten at most
    main = cells.join(each, ["host", "prefix", "part"]).where("10 * o >= n")
    main = main.groupBy("host", "prefix", "part").agg(F.array_join(F.array_sort(F.collect_set(F.when(F.col("child") == "", ".").otherwise(F.col("child")))), "|").alias("like"))
    group = ["host", "prefix", "like"]
    cells = common.stored(cells.join(main, ["host", "prefix", "part"]), "cells")
    kinds = cells.groupBy(*group, "child").agg(F.sum("o").alias("kind_n"), F.sum("l").alias("l"), F.sum("b").alias("b"))
    parents = kinds.groupBy(*group).agg(F.sum("kind_n").alias("pn"), ((F.sum("b") + 1) / (F.sum("l") + 2)).alias("pooled"), (F.count(F.lit(1)) - 1).alias("free"))
    cells = cells.join(kinds.select(*group, "child", "kind_n"), [*group, "child"])
    squares = cells.groupBy(*group, "part").agg(F.sum(F.col("o") * F.col("o") / F.col("kind_n")).alias("square"), F.sum("o").alias("n"), F.sum("l").alias("pl"), F.sum("b").alias("pb"))
    siblings = squares.join(parents, group)
    chi = F.col("square") * F.col("pn") / F.col("n") - F.col("n")
    alike = chi <= F.col("free") + deviations * F.sqrt(2 * F.col("free")) + 1e-6
    off = F.col("pb") - F.col("pl") * F.col("pooled")
    agree = off * off <= deviations * deviations * F.col("pl") * F.col("pooled") * (1 - F.col("pooled")) + 1e-6
    joins = agree & (alike | (F.col("n") < min_share * F.col("pn")))
    siblings = siblings.select(*group, "part", joins.cast("int").alias("joins"))
    several = siblings.groupBy(*group).agg((F.sum("joins") > 1).alias("several"))
    wild = F.concat(F.lit("*("), "like", F.lit(")"))
    named = siblings.join(several, group).select("host", "prefix", "part", F.when((F.col("joins") == 1) & F.col("several"), wild).otherwise(F.col("part")).alias("named"))
    below = F.when(F.col("named").isNull(), F.col("prefix")).otherwise(F.concat("prefix", F.lit("/" if depth else ""), "named"))
    up = F.when(F.col("named").isNull(), F.col("ups")).otherwise(F.concat("ups", F.array("prefix")))
    joined = at.join(named, ["host", "prefix", "part"], "left")
    return joined.select("host", "shape", "parts", "n", "labelled", "blocked", up.alias("ups"), below.alias("prefix"))


def purities(tree: DataFrame, rate: float, host_prior: float, prior: float) -> DataFrame:
    """host, shape, template, template_purity of finished leaves; every ancestor's counts take part once, by its depth."""
    path = F.concat(F.slice("ups", F.lit(2), F.greatest(F.size("ups") - 1, F.lit(0))), F.array("prefix"))
    nodes = tree.select("host", "shape", "prefix", "labelled", "blocked", F.posexplode(path).alias("depth", "node"))
    counts = nodes.groupBy("host", "depth", "node").agg(F.sum("labelled").alias("l"), F.sum("blocked").alias("b"))
    hosts = tree.groupBy("host").agg(F.sum("labelled").alias("hl"), F.sum("blocked").alias("hb"))
    hosts = hosts.select("host", ((F.col("hb") + host_prior * rate) / (F.col("hl") + host_prior)).alias("host_purity"))
    chains = tree.select("host", "prefix", path.alias("path")).distinct()
    chains = chains.select("host", "prefix", F.posexplode("path").alias("depth", "node")).join(counts, ["host", "depth", "node"])
    chains = chains.groupBy("host", "prefix").agg(F.array_sort(F.collect_list(F.struct("depth", "l", "b"))).alias("chain")).join(hosts, "host")
    down = F.aggregate("chain", F.col("host_purity"), lambda p, x: (x["b"] + prior * (p + 0.5)) / (x["l"] + 2 * prior))
    pure = chains.select("host", "prefix", down.alias("template_purity"))
    return tree.select("host", "shape", "prefix").join(pure, ["host", "prefix"]).select("host", "shape", F.col("prefix").alias("template"), "template_purity")


def judge(
    urls: DataFrame, rules=RULES, levels: int = LEVELS, min_share: float = MIN_SHARE, deviations: float = DEVIATIONS, host_prior: float = HOST_PRIOR,
    prior: float = PRIOR, purity: float = PURITY, key: str = "page_id", url: str = "url",
) -> DataFrame:
    """key, host, path, rule, verdict, template, template_purity for every row of urls.

    Only (host, shape) counts enter the tree, pre-aggregated before their shuffle; the way
    back to the rows is a join on (host, shape), whose hot hosts adaptive execution splits.
    """
    host, path = host_and_path(F.col(url))
    rows = urls.select(F.col(key), host.alias("host"), path.alias("path"))
    rule, by_rule = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.select(key, "host", "path", rule.alias("rule"), by_rule.alias("by_rule"), F.regexp_replace("path", "[0-9]+", "{n}").alias("shape"))

    tree = common.stored(leaves_of(rows, levels), "leaves")  # the tree is read from here, not from the rows again
    deepest, labelled, blocked = tree.agg(F.max(F.size("parts")), F.sum("labelled"), F.sum("blocked")).first()
    tree = tree.withColumn("ups", F.array().cast("array<string>")).withColumn("prefix", F.lit(""))
    for depth in range(deepest or 0):
        tree = common.stored(merged_level(tree, depth, min_share, deviations), f"level-{depth}")
    judged = purities(tree, ((blocked or 0) + 1) / ((labelled or 0) + 2), host_prior, prior)

    by_tree = F.when(F.col("template_purity") >= purity - 1e-9, "block").otherwise("allow")
    return rows.join(judged, ["host", "shape"], "left").select(
        key, "host", "path", "rule", F.coalesce("by_rule", by_tree).alias("verdict"), "template", "template_purity"
    )


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(common.pages(spark, sf_dir).select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


#: What the twin begins with: hosts, paths and rules.
SQL_RULED = """WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parsed AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
ruled AS (
  SELECT page_id, host, path,
    CASE WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
         WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
         WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
         WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
         WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule FROM parsed),
shaped AS (
  SELECT page_id, host, path, rule,
    CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' END AS by_rule,
    regexp_replace(path, '[0-9]+', '{n}', 'g') AS shape FROM ruled),"""


def sql_level(d: int) -> str:
    """One level of the tree as common table expressions: from tree{d} to tree{d + 1}."""
    return f"""
live{d} AS (SELECT host, prefix, parts[{d + 1}] AS part, coalesce(parts[{d + 2}], '') AS child, n, labelled, blocked FROM tree{d} WHERE len(parts) > {d}),
cells{d} AS (SELECT host, prefix, part, child, sum(n)::DOUBLE AS o, sum(labelled)::DOUBLE AS l, sum(blocked)::DOUBLE AS b FROM live{d} GROUP BY ALL),
each{d} AS (
  SELECT *, (SELECT string_agg(kind, '|' ORDER BY kind) FROM (SELECT CASE WHEN child = '' THEN '.' ELSE child END AS kind FROM cells{d} c
             WHERE c.host = e.host AND c.prefix = e.prefix AND c.part = e.part AND 10 * c.o >= e.n)) AS alike
  FROM (SELECT host, prefix, part, sum(o) AS n, sum(l) AS l, sum(b) AS b FROM cells{d} GROUP BY ALL) e),
own{d} AS (SELECT c.host, c.prefix, c.part, c.child, c.o, e.alike FROM cells{d} c JOIN each{d} e ON c.host = e.host AND c.prefix = e.prefix AND c.part = e.part),
kinds{d} AS (SELECT host, prefix, alike, child, sum(o) AS kind_n FROM own{d} GROUP BY ALL),
parents{d} AS (SELECT host, prefix, alike, sum(n) AS pn, (sum(b) + 1) / (sum(l) + 2) AS rate FROM each{d} GROUP BY ALL),
widths{d} AS (SELECT host, prefix, alike, count(*) - 1 AS free FROM kinds{d} GROUP BY ALL),
squares{d} AS (
  SELECT c.host, c.prefix, c.part, sum(c.o * c.o / k.kind_n) AS square
  FROM own{d} c JOIN kinds{d} k ON c.host = k.host AND c.prefix = k.prefix AND c.alike = k.alike AND c.child = k.child GROUP BY ALL),
tested{d} AS (
  SELECT s.host, s.prefix, s.alike, s.part,
    (b - l * rate) * (b - l * rate) <= {DEVIATIONS**2}::DOUBLE * l * rate * (1 - rate) + 1e-6 AND
    (square * pn / n - n <= free + {DEVIATIONS}::DOUBLE * sqrt(2 * free) + 1e-6 OR n < {MIN_SHARE}::DOUBLE * pn) AS joins
  FROM each{d} s JOIN squares{d} q ON s.host = q.host AND s.prefix = q.prefix AND s.part = q.part
    JOIN parents{d} p ON s.host = p.host AND s.prefix = p.prefix AND s.alike = p.alike JOIN widths{d} w ON s.host = w.host AND s.prefix = w.prefix AND s.alike = w.alike),
named{d} AS (
  SELECT host, prefix, part,
    CASE WHEN joins AND count(CASE WHEN joins THEN 1 END) OVER (PARTITION BY host, prefix, alike) > 1 THEN '*(' || alike || ')' ELSE part END AS named FROM tested{d}),
tree{d + 1} AS (
  SELECT t.host, t.shape, t.parts, t.n, t.labelled, t.blocked,
    CASE WHEN m.named IS NULL THEN t.path ELSE list_append(t.path, t.prefix{" || '/'" if d else ""} || m.named) END AS path,
    CASE WHEN m.named IS NULL THEN t.prefix ELSE t.prefix{" || '/'" if d else ""} || m.named END AS prefix
  FROM tree{d} t LEFT JOIN named{d} m ON t.host = m.host AND t.prefix = m.prefix AND t.parts[{d + 1}] = m.part)"""


ORACLE = f"""
{SQL_RULED}
leaves AS (
  SELECT host, shape, count(*) AS n, count(by_rule) AS labelled, count(CASE WHEN by_rule = 'block' THEN 1 END) AS blocked FROM shaped GROUP BY host, shape),
tree0 AS (
  SELECT host, shape, CASE WHEN len(p) > {LEVELS} + 1 THEN list_append(p[1:{LEVELS}], array_to_string(p[{LEVELS} + 1:], '/')) ELSE p END AS parts, n, labelled, blocked,
    []::VARCHAR[] AS path, '' AS prefix FROM (SELECT *, string_split(shape, '/') AS p FROM leaves)),
{",".join(sql_level(d) for d in range(LEVELS + 1))},
hosts AS (
  SELECT host, (sum(blocked) + {HOST_PRIOR}::DOUBLE * (SELECT (sum(blocked) + 1)::DOUBLE / (sum(labelled) + 2) FROM leaves)) / (sum(labelled) + {HOST_PRIOR}::DOUBLE) AS purity
  FROM leaves GROUP BY host),
nodes AS (SELECT host, depth, path[depth] AS node, sum(labelled) AS l, sum(blocked) AS b FROM (SELECT *, unnest(range(1, len(path) + 1)) AS depth FROM tree{LEVELS + 1}) GROUP BY ALL),
pure0 AS (SELECT DISTINCT t.host, t.prefix, t.path, h.purity FROM tree{LEVELS + 1} t JOIN hosts h ON t.host = h.host),
{",".join(f"""
pure{d} AS (
  SELECT p.host, p.prefix, p.path, CASE WHEN n.node IS NULL THEN p.purity ELSE (n.b + {PRIOR}::DOUBLE * (p.purity + 0.5::DOUBLE)) / (n.l + 2 * {PRIOR}::DOUBLE) END AS purity
  FROM pure{d - 1} p LEFT JOIN nodes n ON n.host = p.host AND n.depth = {d} AND n.node = p.path[{d}])""" for d in range(1, LEVELS + 2))}
SELECT s.page_id, s.host, s.path, s.rule, coalesce(s.by_rule, CASE WHEN p.purity >= {PURITY}::DOUBLE - 1e-9 THEN 'block' ELSE 'allow' END) AS verdict
FROM shaped s LEFT JOIN tree{LEVELS + 1} t ON s.host = t.host AND s.shape = t.shape LEFT JOIN pure{LEVELS + 1} p ON p.host = t.host AND p.prefix = t.prefix
"""
