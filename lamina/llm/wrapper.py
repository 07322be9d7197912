"""Main-text extraction by wrapper induction over the pages of a host.

Each page becomes a DOM tree whose repeated siblings are folded into one node; a node is
named by the path of tags and classes above it. Trees of one host are aligned by simple tree
matching, so that nodes of different layouts share a template node. The text blocks of a
template node are aligned from both ends (the first and last ``EDGE`` of a page), so a repeated
sibling is a place of its own.

A place is judged over the pages of its host, if these are ``min_pages`` or more with different
main texts. It is template when it says the same on every page that has it. It is a template with a hole when its first or last
``HELD`` words are the same everywhere and it is ``SHORT`` characters long at most on average, and navigation when ``LINKED`` of its text stands in links.
Template goes from every page; holes and navigation go from pages without an article or
main element, which otherwise bounds the content. All other places are slots and stay. A page that
would lose more than half of its content, and more than ``COPIED`` characters, keeps it: such pages are near copies of each other.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and comments are
told by tag, role, class or id beside that and never count as content.

Only statistics of places are grouped, pre-aggregated, and distinct layouts are aligned in groups
of bounded size; pages meet their host's places in an equi-join whose hot hosts
adaptive execution splits. Parsing takes time and memory linear in the page.

Defined edge cases: a null or empty html gives the empty text; a page without markup gives
its text; what follows a tag or comment that never ends is no text; a host with fewer than ``min_pages`` different pages has no template; equal pages
give equal texts; a null url or one without host forms a host of its own (empty); repeated
rows give one result each; elements nested very deeply keep their text; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, urls

TAG = re.compile(r"<(?P<end>/)?(?P<tag>[A-Za-z][A-Za-z0-9:-]*)(?P<attrs>(?>=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)>")
#: The same where a quote is never closed: the tag ends at the first >.
UNQUOTED = re.compile(r"<(?P<end>/)?(?P<tag>[A-Za-z][A-Za-z0-9:-]*)(?P<attrs>[^>]*)>")
BEGINS = re.compile(r"</?[A-Za-z]")
RAW = {t: re.compile(rf"</{t}\s*>", re.IGNORECASE) for t in "script style noscript template textarea title svg iframe".split()}
#: Numbers of characters that no reference needs.
LONG_REFERENCE = re.compile(r"&#(?:[0-9]{8,}|[xX][0-9a-fA-F]{7,});?")
ATTR = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr b bdi bdo big br cite code data dfn del em font i img ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split())
SKIPPED = set("nav header footer aside form button select option input label menu dialog head script style noscript template textarea title svg iframe object fieldset".split())
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
BOILERPLATE = set(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer header "
    "masthead menu nav navbar navigation newsletter notice popup promo promoted related replies reply share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
#: Inside the article these head the text itself.
HEADS = {"header", "masthead", "banner"}
ROLES = set("navigation banner contentinfo complementary search form menu menubar alert dialog".split())
#: Opening one of the keys ends an open element of the values.
CLOSES = {"p": "p", "li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
CLOSES = {k: set(v.split()) for k, v in CLOSES.items()}
BLOCK_ENDS_P = set("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
SCOPE = set("article section div main body table ul ol td th aside nav header footer form blockquote".split())


@dataclass(slots=True)
class Node:
    """An element; name: tag with classes; path: names from the root; skipped and main hold for all below it; block: its nearest element that is not inline."""

    tag: str
    name: str
    path: str
    skipped: bool
    main: bool
    depth: int = 0
    block: Node | None = None
    children: dict[str, Node] = field(default_factory=dict)


@dataclass(slots=True)
class Block:
    """A text block: the path of its element, its text and how much of that stands in links; whether in a skipped or a main element."""

    path: str
    text: str
    linked: int
    skipped: bool
    main: bool


#: Elements deeper than this share the template node of their ancestor at that depth; longer names are digests.
MAX_DEPTH, MAX_NAME = 100, 80


def markup(text: str) -> Iterator[tuple[str, re.Match | None]]:
    """(text before, tag) in order, the tag None at the end; comments, declarations and raw elements are passed over, but for their tag."""
    at, look, tag = 0, 0, TAG
    while True:
        i = text.find("<", look)
        if i < 0:
            yield text[at:], None
            return
        if text.startswith("<!--", i) or text.startswith(("<!", "<?"), i):
            close = "-->" if text.startswith("<!--", i) else ">"
            end = text.find(close, i + (4 if len(close) == 3 else 2))
            yield text[at:i], None
            if end < 0:
                return
            at = look = end + len(close)
            continue
        if not BEGINS.match(text, i):
            look = i + 1
            continue
        m = tag.match(text, i)
        if m is None and tag is TAG:
            tag = UNQUOTED
            m = tag.match(text, i)
        yield text[at:i], m
        if m is None:
            return
        at = look = m.end()
        raw = RAW.get(m["tag"].lower()) if not m["end"] else None
        if raw and not (m["attrs"].endswith("/") and m["tag"].lower() == "svg"):
            end = raw.search(text, at)
            at = look = end.end() if end else len(text)


class Open:
    """The open elements, with the places of each tag and of scopes, so that ends are found at once."""

    def __init__(self, root: Node):
        self.stack, self.scopes = [root], []
        self.at: dict[str, list[int]] = {}

    def push(self, node: Node) -> None:
        self.at.setdefault(node.tag, []).append(len(self.stack))
        if node.tag in SCOPE:
            self.scopes.append(len(self.stack))
        self.stack.append(node)

    def last(self, tags) -> int:
        """The place of the last open element of some tags, or 0."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)

    def scope(self) -> int:
        return self.scopes[-1] if self.scopes else 0

    def cut(self, k: int) -> bool:
        """Closes all from place k on; whether one of them is not inline."""
        block = False
        while len(self.stack) > k:
            gone = self.stack.pop()
            self.at[gone.tag].pop()
            if gone.tag in SCOPE:
                self.scopes.pop()
            block |= gone.tag not in INLINE
        return block


def unescaped(chunk: str) -> str:
    return entities.unescape(LONG_REFERENCE.sub("\ufffd", chunk)) if "&" in chunk else chunk


def parse(text: str) -> tuple[Node, list[Block]]:
    """The folded tree and the page's text blocks in order."""
    root = Node("", "", "", False, False)
    root.block = root
    open_, blocks, parts = Open(root), [], []
    owner, linked = [root, root], [0]

    def flush() -> None:
        if parts:
            joined = " ".join("".join(parts).split())
            if joined:
                blocks.append(Block(owner[0].path, joined, min(linked[0], len(joined)), owner[1].skipped, owner[1].main))
            parts.clear()
            linked[0] = 0

    for before, m in markup(text):
        if before:
            if not parts:
                owner[:] = [open_.stack[-1].block, open_.stack[-1]]
            parts.append(unescaped(before))
            if open_.at.get("a"):
                linked[0] += len(before)
        if m is None:
            continue
        tag = m["tag"].lower()
        if tag in RAW:
            if tag == "textarea":
                flush()
            continue
        if tag == "br":
            if parts:
                parts.append(" ")
            continue
        inline = tag in INLINE
        if not inline:
            flush()
        if m["end"]:
            k = open_.last((tag,))
            if k and (not inline or k > open_.scope()) and open_.cut(k) and inline:
                flush()
            continue
        if tag in VOID:
            continue
        ends = CLOSES.get(tag, set()) | ({"p"} if tag in BLOCK_ENDS_P else set())
        k = open_.last(ends)
        if k and k >= open_.scope():
            open_.cut(k)
        attrs = {a.lower(): b or c or d or "" for a, b, c, d in ATTR.findall(m["attrs"])} if m["attrs"] else {}
        up = open_.stack[-1]
        marks = {w.lower() for a in ("class", "id") for w in WORDS.findall(attrs.get(a, ""))} if attrs and tag not in ("html", "body", "article", "main") else set()
        marks = marks & BOILERPLATE | ({tag} & SKIPPED) | ({attrs.get("role", "").lower()} & ROLES)
        if marks & HEADS and up.main:
            marks -= HEADS
        skipped = bool(marks) or "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true"
        main = tag in ("article", "main") or attrs.get("role", "").lower() in ("main", "article") or "articleBody" in m["attrs"]
        classes = "".join("." + c for c in sorted(attrs.get("class", "").split()))
        name = tag + (classes if len(classes) <= MAX_NAME else f".{number(classes)}") + "!" * skipped + "^" * main
        node = up.children.get(name)
        if node is None:
            deep = up.depth >= MAX_DEPTH
            node = Node(tag, name, up.path if deep else f"{up.path}/{name}", up.skipped or skipped, up.main or main, up.depth + (not deep))
            node.block = up.block if inline else node
            if not deep:
                up.children[name] = node
        if not m["attrs"].endswith("/"):
            open_.push(node)
    flush()
    return root, blocks


def layout(node: Node) -> list:
    """The folded tree as nested lists [name, children]."""
    return [node.name, [layout(c) for c in node.children.values()]]


def matching(a: list, b: list) -> tuple[int, list[tuple[list, list]]]:
    """Simple tree matching: the size of the largest order-keeping match of two trees, and the matched nodes.

    Only children of equal names can match, so the best match of two lists of children is
    the heaviest increasing chain of such pairs, found with prefix maxima in a Fenwick tree.
    """
    if a[0] != b[0]:
        return 0, []
    places: dict[str, list[int]] = {}
    for j, q in enumerate(b[1], 1):
        places.setdefault(q[0], []).append(j)
    pairs = [(i, j) for i, p in enumerate(a[1]) for j in reversed(places.get(p[0], ()))]  # later j first: a child matches once
    n = len(b[1])
    best: list[tuple[int, int]] = [(0, -1)] * (n + 1)  # weight and last pair of the best chain that ends at or before a place
    chain, below = [], []
    for i, j in pairs:
        size, inner = matching(a[1][i], b[1][j - 1])
        at, so_far = j - 1, (0, -1)
        while at:
            so_far = max(so_far, best[at])
            at -= at & -at
        chain.append(so_far[1])
        below.append(inner)
        at, own = j, (so_far[0] + size, len(chain) - 1)
        while at <= n:
            if own[0] > best[at][0]:
                best[at] = own
            at += at & -at
    at, end = n, (0, -1)
    while at:
        end = max(end, best[at])
        at -= at & -at
    found, k = [(a, b)], end[1]
    while k >= 0:
        found += below[k]
        k = chain[k]
    return end[0] + 1, found


class Template:
    """The aligned tree of some layouts; a template node is named by its path, later ones of a path with a number."""

    def __init__(self):
        self.tree: list = ["", []]
        self.name: dict[int, str] = {id(self.tree): ""}
        self.used: dict[str, int] = {}

    def align(self, tree: list) -> dict[str, str]:
        """path -> template node; unmatched nodes join the template below their matched parent."""
        _, pairs = matching(self.tree, tree)
        own = {id(b): a for a, b in pairs}
        out: dict[str, str] = {}

        def walk(node: list, path: str, parent: list | None) -> None:
            match = own.get(id(node))
            if match is None:
                match = [node[0], []]
                n = self.used[path] = self.used.get(path, 0) + 1
                self.name[id(match)] = path if n == 1 else f"{path}~{n}"
                (parent or self.tree)[1].append(match)
            out[path] = self.name[id(match)]
            for c in node[1]:
                walk(c, f"{path}/{c[0]}", match)

        walk(tree, "", None)
        return out


def number(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


#: Blocks of a node that are places of their own, from each end; words that a template with a hole holds, and its mean length; share of navigation.
EDGE, HELD, SHORT, LINKED = 3, 3, 200, 0.8
#: No template within the content is as long as that and longer than the rest.
COPIED = 500


def placed(blocks: list[Block]) -> list[list[str]]:
    """The places of each block: its path with its number from the start and from the end, as far as these are at most EDGE."""
    total: dict[str, int] = {}
    for b in blocks:
        total[b.path] = total.get(b.path, 0) + 1
    seen: dict[str, int] = {}
    out = []
    for b in blocks:
        k = seen.get(b.path, 0)
        seen[b.path] = k + 1
        left = total[b.path] - k
        out.append([f"{b.path}#{k + 1}"] * (k < EDGE) + [f"{b.path}#-{left}"] * (left <= EDGE))
    return out


def region(blocks: list[Block]) -> list[Block]:
    """What the page's markup alone makes content: blocks within article or main, or all, without what is skipped."""
    shown = [b for b in blocks if not b.skipped]
    return [b for b in shown if b.main] or shown


SLOTS = "host string, layout string, path string, place string, digest long, head long, tail long, size long, linked long, page long"
STATISTICS = ("digest", "head", "tail")


def slots(pages: DataFrame) -> DataFrame:
    """SLOTS rows: each place's text, its first and its last words as digests, with the digest of its page's main text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for host, text in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                root, blocks = parse(text or "")
                shape, page = json.dumps(layout(root)), number("\n".join(b.text for b in region(blocks)))
                for b, places in zip(blocks, placed(blocks), strict=True):
                    whole, words = number(b.text), b.text.split(" ")
                    # of a text that is too short to have a hole, head and tail are the text's own
                    head, tail = (number(" ".join(w)) for w in (words[:HELD], words[-HELD:])) if len(words) > HELD else (whole, whole)
                    out += [(host, shape, b.path, p, whole, head, tail, len(b.text), b.linked, page) for p in places]
            kinds = [pa.string()] * 4 + [pa.int64()] * 6
            cols = zip(*out, strict=True) if out else [()] * 10
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], [x.split()[0] for x in SLOTS.split(", ")])

    return pages.select("host", "html").mapInArrow(run, SLOTS)


def induce(found: DataFrame, min_pages: int, together: int = 200) -> DataFrame:
    """host, template (places), hole (places) from SLOTS rows; hole: templates with a hole and navigation.

    Statistics of places are minima, maxima, sums and distinct-count sketches, which all combine before
    their shuffles. The layouts of a host are aligned in groups of about `together`; template
    nodes of the groups meet by name, so no host meets in one task.
    """
    sums = [F.sum(c).alias(c) for c in ("size", "linked", "n")]
    extremes = [f(c).alias(f"{n}_{c}") for c in STATISTICS for n, f in (("low", F.min), ("high", F.max))]
    places = found.withColumn("n", F.lit(1)).groupBy("host", "layout", "path", "place").agg(*extremes, *sums, F.hll_sketch_agg("page", 8).alias("pages"))
    places = common.stored(places, "places")

    def build(key, table):
        template, out = Template(), []
        for shape in sorted(table.column("layout").to_pylist()):
            out += [(key[0].as_py(), shape, path, node) for path, node in template.align(json.loads(shape)).items()]
        return pa.Table.from_arrays([pa.array(c, pa.string()) for c in zip(*out, strict=True)], ["host", "layout", "path", "node"])

    layouts = places.select("host", "layout").distinct()
    parts = layouts.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / together).alias("parts"))
    dealt = layouts.join(parts, "host").withColumn("part", F.pmod(F.xxhash64("layout"), F.col("parts")))
    aligned = dealt.groupBy("host", "part").applyInArrow(build, "host string, layout string, path string, node string")
    named = places.join(aligned, ["host", "layout", "path"]).withColumn("nth", F.substring_index("place", "#", -1))
    again = [f(f"{n}_{c}").alias(f"{n}_{c}") for c in STATISTICS for n, f in (("low", F.min), ("high", F.max))]
    judged = named.groupBy("host", "node", "nth").agg(*again, *sums, F.hll_sketch_estimate(F.hll_union_agg("pages")).alias("pages"))
    same = {c: F.col(f"low_{c}") == F.col(f"high_{c}") for c in STATISTICS}
    many, short = F.col("pages") >= min_pages, F.col("size") <= SHORT * F.col("n")
    hole = (same["head"] | same["tail"]) & short | (F.col("linked") >= LINKED * F.col("size"))
    judged = judged.select("host", "node", "nth", (many & same["digest"]).alias("template"), (many & hole).alias("hole"))
    back = named.select("host", "place", "node", "nth").distinct().join(judged, ["host", "node", "nth"])
    back = back.groupBy("host", "place").agg(F.every("template").alias("template"), F.every("hole").alias("hole")).where("template or hole")
    listed = lambda kind: F.array_sort(F.collect_list(F.when(kind, F.col("place"))))
    return back.groupBy("host").agg(listed(F.col("template")).alias("template"), listed(F.col("hole") & ~F.col("template")).alias("hole"))


def main_text(text: str, template: set[str] = frozenset(), hole: set[str] = frozenset()) -> str:
    """The main text of a page, given the places of its host that are template or template with a hole."""
    if not text:
        return ""
    _, blocks = parse(text)
    inside = region(blocks)
    if template or hole:
        at = {id(b): p for b, p in zip(blocks, placed(blocks), strict=True)}
        gone = template if inside and inside[0].main else template | hole
        slot = [b for b in inside if not any(p in gone for p in at[id(b)])]
        whole, left = (sum(len(b.text) for b in x) for x in (inside, slot))
        if whole - left <= max(COPIED, left):
            inside = slot
    return "\n\n".join(b.text for b in inside)


def pages_with_hosts(pages: DataFrame) -> DataFrame:
    """page_id, url, html, host."""
    host, _ = urls.host_and_path(F.col("url"))
    return pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("host"))


def extract(pages: DataFrame, min_pages: int = 5) -> DataFrame:
    """page_id, url, text, n_chars for every row of pages (page_id, url, html)."""
    rows = pages_with_hosts(pages)
    templates = common.stored(induce(slots(rows), min_pages), "templates")  # apart from the pages, whose hot hosts the join can then split

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[set, set]] = {}
        for batch in batches:
            texts, template, hole = [], batch.column("template"), batch.column("hole")
            for k, (host, page) in enumerate(zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True)):
                if host not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[host] = set(template[k].as_py() or ()), set(hole[k].as_py() or ())
                texts.append(main_text(page, *known[host]))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    joined = rows.join(templates, "host", "left").select("page_id", "url", "html", "host", "template", "hole")
    out = joined.mapInArrow(run, "page_id long, url string, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(common.pages(spark, sf_dir))
