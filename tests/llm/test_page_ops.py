"""Main text, WARC bundles and URL filters against brute force, SQL and on edge cases."""

import base64
import hashlib

import pytest

from lamina.llm import queries, urls, warc, wrapper
from tests import compare

SF = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string, host string, path string, text string, key long"


def pages(spark, rows):
    """Pages with extra columns whose names operators use themselves."""
    return spark.createDataFrame([(i, u, h, "x", "x", "x", 1) for i, u, h in rows], PAGES)


# --- main text --------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="<p>no</p>";</script><style>p{{}}</style></head><body>
<nav><ul><li><a href="/a">Menu {k}</a></li></ul></nav><!-- <p>hidden</p> --><div class="ad-box">Buy {k}</div><div id="cookie-notice">We use cookies</div>
<article><h1>Head {k} &amp; more</h1><p><b>First {k}.<br><p>Second&nbsp;one
 with   space.</p><p class="subscribe">Sign up here</p><ul><li>item {k}a<li>item b</ul><form><input>Search</form></article>
<section class="comments"><p>Reader {k}</p></section><aside>Side</aside><footer>&copy; {k}</footer></body></html>"""


def test_main_text(spark):
    rows = [(k, f"http://h{k // 4}.example/{k}", PAGE.format(k=k)) for k in range(30)] + [
        (100, None, None), (101, "x", ""), (102, "http://h.example/x", "plain & simple text"), (103, "http://one.example/", "<div><p>only</p></div><div><p>some longer content here</p></div>"),
        (104, "http://h1.example/4", PAGE.format(k=4)), (105, "http://big.example/", "<article><p>" + "w " * 50_000 + "</p></article>"), (106, "http://n.example/", "<div>" * 3000 + "deep" + "</div>" * 3000),
    ]
    got = {r["page_id"]: r for r in wrapper.extract(pages(spark, rows)).collect()}
    assert len(got) == len(rows)
    for k in range(30):
        assert got[k]["text"] == f"Head {k} & more\n\nFirst {k}.\n\nSecond one with space.\n\nitem {k}a\n\nitem b"
    assert got[4]["text"] == got[104]["text"] and got[100]["text"] == got[101]["text"] == "" and got[102]["text"] == "plain & simple text"
    assert got[105]["n_chars"] == 99_999 and got[106]["text"] == "deep"
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert wrapper.extract(pages(spark, [])).collect() == []


def test_near_copies_keep_their_text(spark):
    """Pages of one host that differ in a word are copies, not one template around a word."""
    html = "<article><h1>Head</h1><p>{k}</p><p>" + "long and equal " * 50 + "</p></article>"
    got = wrapper.extract(pages(spark, [(k, f"http://h.example/{k}", html.format(k=k)) for k in range(12)])).collect()
    assert {r["text"] for r in got} == {f"Head\n\n{k}\n\n" + ("long and equal " * 50).strip() for k in range(12)}


def test_constant_nodes_become_template(spark):
    """A node that says the same on every page of its host is dropped, whatever its markup says."""
    html = "<article><h1>{k}</h1><div class=box><p>Follow our channel for updates</p></div><p>Body {k}</p></article>"
    rows = [(k, f"http://h.example/{k}", html.format(k=k)) for k in range(25)] + [(50 + k, f"http://small.example/{k}", html.format(k=k)) for k in range(3)]
    got = {r["page_id"]: r["text"] for r in wrapper.extract(pages(spark, rows)).collect()}
    assert got[3] == "3\n\nBody 3" and got[51] == "1\n\nFollow our channel for updates\n\nBody 1"


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<header><h1>Site</h1></header><article><header><h1>Title</h1></header><p>Body</p><footer>by us</footer></article>", "Title\n\nBody"),
        ("<main><div class='article-header'><h2>T</h2></div><p>B</p><div class=userComments><p>c</p></div><div class='ADS top'>x</div></main>", "T\n\nB"),
        ("<div role=navigation>m</div><div role='main'><p>a<p>b<div hidden>c</div></div><div class=site-header>s</div>", "a\n\nb"),
        ("<article><pre>x\n  y</pre><table><tr><td>1<td>2</table><p>a<br/>b<!-- c --><script>d</script>e</p>&lt;tail&gt; &#x41;&eacute;</article>", "x y\n\n1\n\n2\n\na be\n\n<tail> Aé"),
        ("<p>1 < 2 and <b>x</p", "1 < 2 and x"),
        ("<article><p>open", "open"),
        ("<article><p title=don't>a</p><p title='x > y'>isn't</p><a href=\"u>v\">b</a>", "a\n\nisn't\n\nb"),
    ],
)
def test_markup(html, want):
    assert wrapper.main_text(html) == want


def test_pages_without_article_keep_every_slot():
    long, nav = "most of the text " * 50, "<nav>menu</nav>"
    html = f"<body>{nav}<h1>Title</h1><p class=lead>Lead</p><div class=story><p>{long}</p></div><div class=more><p>The end</p></div></body>"
    assert wrapper.main_text(html) == "\n\n".join(["Title", "Lead", long.strip(), "The end"])


def test_copies_are_no_template(spark):
    html = "<article><p>Same on all copies</p></article>"
    got = wrapper.extract(pages(spark, [(k, f"http://h.example/{k}", html) for k in range(40)])).collect()
    assert {r["text"] for r in got} == {"Same on all copies"}


def test_layouts_in_small_groups(spark):
    """Constants are found across groups of layouts that were aligned apart."""
    rows = [(k, f"http://h.example/{k}", f"<article><h1>{k}</h1><div class=box>Always the same</div>" + f"<div class=v{k}>own {k}</div></article>") for k in range(40)]
    found = wrapper.slots(wrapper.pages_with_hosts(pages(spark, rows)))
    one, many = (wrapper.induce(found, 20, n).collect() for n in (200, 3))
    assert [r["template"] for r in one] == [r["template"] for r in many] == [["/article^/div.box#-1", "/article^/div.box#1"]]


def test_repeated_siblings_are_places(spark):
    """A constant paragraph beside varying ones goes, from either end, whatever the number of paragraphs; a sentence that only many pages share stays."""
    html = lambda k: "<article><p>Welcome to our site</p>" + f"<p>Body {k} {{}}</p>" * (1 + k % 4) + ("<p>Often said.</p>" if k % 5 else "") + f"<p>More {k}</p><p>Follow our channel for updates</p></article>"
    rows = [(k, f"http://h.example/{k}", html(k)) for k in range(40)]
    got = {r["page_id"]: r["text"] for r in wrapper.extract(pages(spark, rows)).collect()}
    for k in range(40):
        assert got[k] == "\n\n".join([f"Body {k} {{}}"] * (1 + k % 4) + ["Often said."] * (k % 5 > 0) + [f"More {k}"])


def test_holes_and_navigation_go_without_article(spark):
    """Fixed words around a varying part, and blocks of links, are template where no article bounds the content."""
    html = "<body><div class=x>Shop of the town number {k}</div><div class=y><a href=a>one {k}</a> <a href=b>two {k}</a></div><h1>Title {k}</h1><div class=t><p>{k} is what this page tells at length, and more {k}.</p></div><div>All rights at {k} reserved by us all</div></body>"
    rows = [(k, f"http://h.example/{k}", html.format(k=k)) for k in range(12)] + [(50 + k, f"http://small.example/{k}", html.format(k=k)) for k in range(3)]
    got = {r["page_id"]: r["text"] for r in wrapper.extract(pages(spark, rows)).collect()}
    assert got[3] == "Title 3\n\n3 is what this page tells at length, and more 3." and got[51].startswith("Shop of the town number 1\n\none 1 two 1\n\nTitle 1")


def brute_places(rows, min_pages):
    """Template places by their definition: every place of every page of a host, compared as texts."""
    said, mains = {}, {}
    for _, url, html in rows:
        host = host_model(url)[0]
        _, blocks = wrapper.parse(html or "")
        shown = [b for b in blocks if not b.skipped]
        main = "\n".join(b.text for b in ([b for b in shown if b.main] or shown))
        by = {}
        for b in blocks:
            by.setdefault(b.path, []).append(b.text)
        for path, texts in by.items():
            for k, t in enumerate(texts):
                for name in {k + 1, k - len(texts)} & {1, 2, 3, -1, -2, -3}:
                    said.setdefault((host, f"{path}#{name}"), set()).add(t)
                    mains.setdefault((host, f"{path}#{name}"), set()).add(main)
    return {k for k, v in said.items() if len(v) == 1 and len(mains[k]) >= min_pages}


def test_template_equals_brute_force(spark):
    """Every page of the smallest tables, with a host of many templates."""
    rows = [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    rows += [(9000 + k, f"http://t.example/{k}", f"<nav>Home</nav><article><h2>Part</h2><p>{k}</p><p>{k % 3}</p><p>End</p></article><footer>us</footer>") for k in range(9)]
    want = brute_places(rows, 5)
    got = {(r["host"], p) for r in wrapper.induce(wrapper.slots(wrapper.pages_with_hosts(pages(spark, rows))), 5).collect() for p in r["template"]}
    assert got == want and len([p for h, p in got if h == "t.example"]) >= 4
    found = {r["page_id"]: r["text"] for r in wrapper.extract(pages(spark, rows)).collect()}
    for i, url, html in rows:
        own = {p for h, p in want if h == host_model(url)[0]}
        if i < 9000:
            assert found[i] == wrapper.main_text(html, own)
        else:
            assert found[i] == f"{i - 9000}\n\n{(i - 9000) % 3}"


@pytest.mark.parametrize(
    "html",
    ["<div>x" * 40_000, "</i>x" * 100_000, "<b><i>" * 20_000 + "</u></b>x" * 20_000, "<a " * 100_000, '<a b=">"' * 60_000, "<b>" * 20_000 + "<div></div>x" * 20_000, "".join(f"<p class=c{k}>x</p>" for k in range(20_000)), "<!--" * 100_000, "&#" + "9" * 200_000 + ";x", "<td>" * 60_000 + "x", "<svg/>x" * 60_000],
)
def test_parsing_is_linear(html):
    import time

    began = time.process_time()
    root, _ = wrapper.parse(html)
    wrapper.layout(root)
    assert time.process_time() - began < 5


def test_matching_of_long_sibling_lists():
    import time

    began = time.process_time()
    a, b = (["", [[f"p{k * step}", []] for k in range(5000)]] for step in (1, 2))
    assert wrapper.matching(a, b)[0] == 2501 and time.process_time() - began < 5


def test_tree_matching():
    tree = lambda name, *kids: [name, list(kids)]
    a = tree("a", tree("b", tree("d")), tree("c"))
    assert wrapper.matching(a, a)[0] == 4
    assert wrapper.matching(a, tree("a", tree("c"), tree("b")))[0] == 2
    assert wrapper.matching(a, tree("x"))[0] == 0
    t = wrapper.Template()
    one, two = t.align(["", [["html", [["p", []]]]]]), t.align(["", [["html", [["div", []], ["p", []]]]]])
    assert one["/html/p"] == two["/html/p"] and two["/html/div"] not in one.values()


# --- WARC -------------------------------------------------------------------------------------


@pytest.mark.parametrize("broadcast_rows", [100, 0])
def test_warc(spark, broadcast_rows):
    rows = [(5, "http://a/ b", "same"), (3, None, "same"), (9, "u", "same"), (1, "u", None), (2, "u", ""), (4, "u", "ü" * 400_000), (7, "u", "x\r\n\r\nWARC/1.1"), (None, "u", "n"), (11, "u", "o"), (11, "u", "o")]
    bundles = warc.write_bundles(warc.with_revisits(pages(spark, rows), broadcast_rows=broadcast_rows), bundle_bytes=200_000, frame_bytes=1000)
    got = sorted(warc.read_bundles(bundles).collect(), key=str)
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got}
    assert {k: (r["record_type"], r["refers_to"]) for k, r in by.items()} == {
        3: ("response", None), 5: ("revisit", 3), 9: ("revisit", 3), 1: ("response", None), 2: ("revisit", 1), 4: ("response", None), 7: ("response", None), None: ("response", None), 11: ("response", None),
    }
    for i, _, html in rows:
        body = (html or "").encode()
        assert (by[i]["payload_bytes"], by[i]["payload_digest"]) == (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode())
    assert warc.read_bundles(warc.write_bundles(warc.with_revisits(pages(spark, [])))).collect() == []
    few = warc.with_revisits(pages(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")]), min_revisit=3).collect()
    assert {r["key"]: r["refers_to"] for r in few} == {1: None, 2: None, 3: None, 4: 3}


def test_seek_table():
    b = warc.Bundle(frame_bytes=50)
    records = [warc.record(k, "u", bytes([65 + k]) * 30, None) for k in range(4)]
    for k, r in enumerate(records):
        b.add(warc.record_id(k), r)
    data = b.close()
    import io

    import zstandard

    assert zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read() == b"".join(records)
    reader = warc.Reader(data)
    for k in (3, 0, 2):
        head, block = reader.read(b.frames[k], b.offsets[k])
        assert head["WARC-Record-ID"] == f"<urn:page:{k}>" and block == bytes([65 + k]) * 30
    with pytest.raises(ValueError, match="seekable"):
        warc.Reader(b"nothing at all here")


# --- URLs -------------------------------------------------------------------------------------


def host_model(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = lambda s, marks: s[: min([s.find(m) for m in marks if m in s], default=len(s))]
    host = cut(rest, "/?#")
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    return lower, cut(rest[len(host) :], "?#")


URLS = [
    None, "", "no scheme", "http://", "http://EXAMPLE.com", "http://Example.COM/en/1", "https://a.www.example.com/en/9?x#y", "http://xexample.com/en/", "ftp://h.net/es/3#z",
    "http://net/es/", "http://anet/es/1", "http://h.net/fr", "http://h.net/fr/", "x://y://z/en/", "http://ÄÖ.com/ß", "http://h.com?q=/en/", "http://example.com/EN/", "http://h.org/en/1\n2",
]


def test_hosts_paths_and_rules(spark):
    got = {r["page_id"]: r for r in urls.judge(pages(spark, [(k, u, None) for k, u in enumerate(URLS)])).collect()}
    for k, u in enumerate(URLS):
        host, path = host_model(u)
        fits = [(len(t), t, v) for v, t in urls.RULES if (host == t.split("/")[0] or host.endswith("." + t.split("/")[0])) and path.startswith("/" + t.split("/", 1)[1])]
        r = got[k]
        assert (r["host"], r["path"], r["rule"]) == (host, path, max(fits)[1] if fits else None), u
        assert r["verdict"] == (max(fits)[2] if fits else r["verdict"]) and r["verdict"] in ("allow", "block")


def test_pure_templates_are_rejected(spark):
    """Rows without rule follow their template's labelled purity; long, repeated and empty paths included."""
    rules = (("block", "h.io/bad/1"), ("allow", "h.io/good/1"))
    rows = [(k, f"http://h.io/bad/1{k}", None) for k in range(20)] + [(100 + k, f"http://h.io/good/1{k}", None) for k in range(20)]
    rows += [(200, "http://h.io/bad/9", None), (201, "http://h.io/good/9", None), (202, "http://h.io/bad/9", None), (203, "http://h.io", None), (204, "http://h.io/" + "a/" * 3000, None)]
    got = {r["page_id"]: r for r in urls.judge(pages(spark, rows), rules).collect()}
    assert [got[k]["verdict"] for k in (200, 201, 202, 203, 204)] == ["block", "allow", "block", "allow", "allow"]
    assert got[200]["template"] == "/bad/{n}"
    assert urls.judge(pages(spark, [])).collect() == []


def test_evidence_reaches_unlabelled_branches(spark):
    """Branches whose children look alike merge and share their labels on every level; others and other hosts do not."""
    rules = (("block", "h.io/es/"), ("block", "h.io/fr/"), ("allow", "h.io/docs/"), ("allow", "k.io/"))
    rows, k = [], 0
    for lang in ("es", "fr", "de", "pt"):
        for n in range(30):
            rows.append((k := k + 1, f"http://h.io/{lang}/{n}" + (".html" if n % 3 == 0 else ""), None))
    for n in range(60):
        rows.append((k := k + 1, f"http://h.io/docs/a{chr(97 + n % 26)}/x", None))
        rows.append((k := k + 1, f"http://k.io/de/{n}", None))
        rows.append((k := k + 1, f"http://free.io/de/{n}", None))
    got = {r["page_id"]: r for r in urls.judge(pages(spark, rows), rules).collect()}
    for i, u, _ in rows:
        assert got[i]["verdict"] == ("block" if "h.io" in u and "/docs/" not in u else "allow"), u
        if "h.io" in u and "/docs/" not in u:
            assert got[i]["template"] in ("/*({n}.html|{n})/*(.)", "/*({n}|{n}.html)/*(.)")
    deep = [(i, "http://d.io/" + "/".join(["a"] * 20 + [str(i)]), None) for i in range(5)]
    assert {r["template"] for r in urls.judge(pages(spark, deep), rules).collect()} == {"/a" * 20 + "/{n}"}


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_equals_sql(spark, name):
    assert compare.of_spark(queries.QUERIES[name](spark, SF)) == compare.of_sql(compare.connect(SF), queries.ORACLE[name])
