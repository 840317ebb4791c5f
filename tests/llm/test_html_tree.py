import pytest
from llm_texts import prose

from stellate.llm import html_tree

SCHEMA = "page_id bigint, url string, html string, host string, text string"


def texts_of(spark, pages, **settings):
    frame = spark.createDataFrame([(i, u, h, "h", "t") for i, u, h in pages], SCHEMA)
    out = html_tree.main_text(frame, settings=html_tree.Settings(**settings))
    assert out.columns == ["page_id", "url", "text"]
    return {r.page_id: r.text for r in out.collect()}


PAGE = """<!DOCTYPE html><html lang="en"><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head>
<body class="has-sidebar"><header class="site-header"><h1>Site name</h1></header>
<nav><ul><li><a href="/a">Menu one</a></li><li>Menu two</li></ul></nav>
<div class="ad">Buy &amp; save</div><div id="cookie-notice">We use cookies <button>OK</button></div>
<div class="wrapper with-sidebar"><article><header><h1>Title &mdash; here</h1></header>
<p>First   para&shy;graph<br>with <b>bold</b> and <a href="x">link</a> &lt;tag&gt; &eacute;&#233;&nbsp;end.
<p>{body}<ul><li>item one<li>item two</ul>
<div class="share-buttons">Share this</div><form><input value="x">Your mail</form>
<aside>Aside text</aside><table><tr><td>a</td><td>b</td></tr><tr><td>c</td></tr></table>
<blockquote>quoted</blockquote><pre>code  x</pre><noscript>enable js</noscript><p hidden>hidden</p>
<section class="comments"><article class="comment"><p>Nice post!</p></article></section><footer>By me</footer></article></div>
<div class="sidebar"><p>Popular posts</p></div><footer>&copy; 2024</footer></body></html>"""

WANT = "Title — here\nFirst para­graph with bold and link <tag> éé end.\n{body}\nitem one\nitem two\na b\nc\nquoted\ncode x"


def test_article_without_furniture(spark):
    body = prose(1, 30)
    got = texts_of(spark, [(1, "http://a.example/1", PAGE.format(body=body))])
    assert got[1] == WANT.format(body=body)


def test_odd_pages(spark):
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    pages = [
        (1, None, None), (2, "u", ""), (3, "http://x/", "no markup at all &amp; more"), (4, "u", "<p>one<p>two</div></p>"),
        (5, "u", "<article><p><b>unclosed <i>marks<br><p>next</article>"), (6, "u", "<!-- open comment"), (7, "u", deep),
        (8, "u", "<article>" + "<p>w</p>" * 30000 + "</article>"), (9, "u", "<script>only()</script>"),
        (10, "u", "<main>m<article>a</article></main>x"), (11, "u", "<p>a</p><p>a</p>"), (11, "u", "<p>a</p><p>a</p>"),
        (12, "u", "a < b and <3 & c"), (13, "u", "<article><p>x</p></article><article><p>y</p></article>"), (14, "u", "<p>a\x00b</p>"),
    ]
    got = texts_of(spark, pages)
    assert got[1] == got[2] == got[6] == got[9] == ""
    assert got[3] == "no markup at all & more"
    assert got[4] == got[5].replace("unclosed marks\nnext", "one\ntwo") == "one\ntwo"
    assert got[7] == "deep" and got[8] == "\n".join(["w"] * 30000)
    assert got[10] == "a" and got[11] == "a\na" and got[13] == "x\ny"
    assert got[12].startswith("a < b")


def test_template_of_a_host_is_learnt(spark):
    """Parts that the markup does not name: the same on every page of the host, so they go."""
    def page(i):
        return (
            f"<body><div class=x1>Welcome to the portal</div><div class=x2><p>{prose(i, 30)}</p><p>{prose(100 + i, 20)}</p></div>"
            f"<div class=x3>All rights kept</div></body>"
        )

    pages = [(i, "http://one.example/p", page(i)) for i in range(20)]
    pages += [(100 + i, f"http://solo{i}.example/", page(i)) for i in range(3)]
    got = texts_of(spark, pages)
    assert got[5] == f"{prose(5, 30)}\n{prose(105, 20)}"
    assert got[101].startswith("Welcome to the portal") and got[101].endswith("All rights kept")


def test_one_odd_page_does_not_save_a_template(spark):
    def page(i):
        top = "Closed on that day" if i == 999 else "Welcome to the portal"
        return f"<body><div class=x1>{top}</div><div class=x2><p>{prose(i, 12)}</p><p>Ask us for more</p></div></body>"

    got = texts_of(spark, [(i, "http://one.example/p", page(i)) for i in range(1000)])
    assert all(got[i] == prose(i, 12) for i in range(999))
    assert got[999] == f"Closed on that day\n{prose(999, 12)}"


def neutral(i, n=30):
    """No article, no telling name: a portal's frame around a page's own text, with a rare note inside the frame."""
    links = "".join(f"<li><a href=/{k}>Go to {prose(7000 + k, 2)}</a></li>" for k in range(6))
    note = f"<div class=a4><p>{prose(9000 + i, 6)}</p></div>" if i % 40 == 7 else ""
    paragraphs = "".join(f"<p>{prose(100 * i + k, 15)}</p>" for k in range(1 + i % 4))
    return (
        f"<body><div class=a1><div class=a2><ul>{links}</ul></div><div class=a3>All about things</div>{note}</div>"
        f"<div class=b1><h2>{prose(300 + i, 4)}</h2>{paragraphs}</div><div class=c1><div class=c2>Kept rights</div></div></body>"
    )


@pytest.mark.parametrize("settings", [{"marks": True}, {"marks": False}, {"marks": False, "host_nodes": 0}])
def test_the_tree_alone_removes_whole_branches(spark, settings):
    got = texts_of(spark, [(i, f"http://n{i % 2}.example/{i}", neutral(i)) for i in range(240)], **settings)
    for i, text in got.items():
        own = [prose(300 + i, 4)] + [prose(100 * i + k, 15) for k in range(1 + i % 4)]
        assert text == "\n".join(own), i  # the rare note goes with the branch that it is in


def test_few_pages_say_little(spark):
    """Two pages of a host that share a part do not make it template; belief grows with the pages."""
    def page(i):
        return f"<body><div class=x1>The same on all</div><p>{prose(i, 9)}</p></body>"

    for n, gone in ((2, False), (4, False), (30, True)):
        got = texts_of(spark, [(i, "http://f.example/", page(i)) for i in range(n)], marks=False)
        assert all(("The same on all" in t) != gone for t in got.values()), n


def test_importance_is_the_entropy_formula(spark):
    """Composite importance by pointer jumping against the recursion on the tree."""
    from pyspark.sql import functions as F

    s = html_tree.Settings()
    pages = spark.createDataFrame([(f"k{i}", neutral(i)) for i in range(60)], "key string, html string")
    seen = pages.select(F.lit("h").alias("host"), "key", html_tree._seen_udf(s)("html").alias("s")).select("host", "key", "s.*")
    tree, _ = html_tree.site_tree(seen, s)
    rows = {r["node"]: r for r in tree.collect()}
    kids = {}
    for r in rows.values():
        kids.setdefault(r["parent"], []).append(r["node"])

    def composite(n):
        return rows[n]["own"] + sum(rows[c]["weight"] * composite(c) for c in kids.get(n, ()))

    got = html_tree._from_below(tree.select("host", "node", F.col("own").alias("value")), html_tree._jumps(tree), html_tree._sum)
    found = {r["node"]: r["value"] for r in got.collect()}
    assert set(found) == set(rows) and all(abs(found[n] - composite(n)) < 1e-9 for n in rows)
    assert all(-1e-9 <= v <= 1 + 1e-9 for v in found.values()) and min(found.values()) < s.threshold < max(found.values())


def test_names_with_other_words_keep_an_articles_text(spark):
    body = '<article><p class="share-price">Up 3%</p><div class="notice-period">Three months</div><div class="share-buttons">Share</div><p class=cookie-notice>OK?</p><p>End</p></article>'
    assert texts_of(spark, [(1, "http://s/", body)])[1] == "Up 3%\nThree months\nEnd"


def test_mirrored_pages_are_not_template(spark):
    body = f"<body><div class=x><p>{prose(1, 30)}</p></div></body>"
    got = texts_of(spark, [(i, "http://m.example/", body) for i in range(30)])
    assert set(got.values()) == {prose(1, 30)}


def test_empty_table(spark):
    assert texts_of(spark, []) == {}


@pytest.mark.parametrize("url,host", [
    ("https://user@Blog.Example.com:80/x?y", "blog.example.com"), (None, ""), ("nothing", ""), ("http://[::1", "["),
])
def test_hosts(spark, url, host):
    from pyspark.sql import functions as F

    assert spark.range(1).select(html_tree.host_of(F.lit(url).cast("string")).alias("h")).first().h == host


def test_whole_table(spark):
    """Every page of the small table: all text of the article, block by block, and nothing else."""
    import html as entities
    import re

    from stellate.llm.catalog import QUERIES

    root = "/root/testdata/sf0.001"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{root}/pages.parquet").collect()}
    for r in QUERIES["op4_style_tree_text"](spark, root).collect():
        article = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        parts = re.split(r"</?(?:p|h1)>|<br>", article)
        blocks = [" ".join(entities.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in parts]
        assert r.text == "\n".join(b for b in blocks if b)
        assert r.n_chars == len(r.text)
