"""Wrappers: alignment, slots and main text."""

from __future__ import annotations

import html as entities
import json
import re

from meridia.llm import wrappers as w


def merged(*pages):
    out = None
    for p in pages:
        t = w.page_tree(p)
        out = t if out is None else w.aligned(out, t)
    return out


def text(page, *others):
    return w.main_text(page, w.slots(merged(page, *others)))


def test_expression_has_slots_optional_and_repeated_groups():
    a = "<div><h1>One</h1><ul><li>x</li><li>y</li></ul><p>same</p></div>"
    b = "<div><h1>Two</h1><p>new</p><ul><li>z</li></ul><p>same</p></div>"
    e = w.expression(merged(a, b))
    assert "<h1> #text </h1>" in e and "(<li> #text </li>)+" in e and "(<p> #same </p>)?" in e and "#same" in e


def test_alignment_covers_whatever_the_order():
    pages = [f"<body><div class='a'>{'<p>t%d</p>' % i * (i % 3)}</div>{'<div class=b>s</div>' if i % 2 else ''}</body>" for i in range(6)]
    slots = [w.slots(merged(*x)) for x in (pages, pages[::-1], pages[2:] + pages[:2])]
    assert slots[0] == slots[1] == slots[2]


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use</div>
<article><header><h1>Head &amp; line</h1></header><p><b>First  <i>one</i>.<br><p>Second&nbsp;&eacute; &lt;b&gt;
text</p><div class="ad">Buy</div><form><p>Mail</p></form><aside>Also</aside><blockquote>Quote</blockquote></article>
<section id="comments"><p>Nice post</p></section><!-- <p>gone</p> --><footer>&copy; x</footer></body></html>"""


def test_main_text():
    assert text(PAGE) == "Head & line\n\nFirst one.\n\nSecond é <b> text\n\nQuote"


def test_hosts_without_article():
    page = lambda i: f"<html><body><div class='top'>Welcome</div><div class='body'><p>Text {i} is here</p><p>More {i}</p></div><div class='links'><a href=x>a {i}</a> <a href=y>b {i}</a></div><div class='footer'>f {i}</div></body></html>"
    assert text(page(1), page(2), page(3)) == "Text 1 is here\n\nMore 1"


def test_odd_pages():
    assert text("") == "" and text("plain words") == "plain words" and text("<p>a<p>b") == "a\n\nb"
    assert text("<article><p>x &amp; y</article") == "x & y"
    assert text("<article><p>cut off in <b>the mid") == "cut off in the mid"
    assert text("<article><p title='a>b'>t</p><script>never closed") == "t"
    assert text("<article>1 < 2 and <3</article>") == "1 < 2 and <3"
    for n in (300, 20_000):
        deep = "<div>" * n + "<article><p>deep</p></article>"
        assert text(deep) == "deep" and text(deep + "<nav>menu</nav>") == "deep"
    assert text("".join(f"<div class=c{chr(97 + i % 26)}{i}>" for i in range(3000)) + "<p>x</p>") == "x"


def test_templates_of_one_host_have_their_main_parts_each():
    article = lambda i: f"<body><nav>n</nav><article><h1>T{i}</h1><p>Words of page {i}</p></article><div class=end>Site {i}</div></body>"
    plain = lambda i: f"<body><div class=top>Welcome</div><div class=content><p>Other words {i} and more of them</p><p>Last {i}</p></div><div class=end>S {i}</div></body>"
    pages = [article(1)] + [plain(i) for i in range(2, 12)]
    weight = w.slots(merged(*pages))
    assert w.main_text(pages[0], weight) == "T1\n\nWords of page 1"
    assert [w.main_text(p, weight) for p in pages[1:]] == [f"Other words {i} and more of them\n\nLast {i}" for i in range(2, 12)]
    copies = [plain(7)] * 6
    assert text(*copies) == text(plain(7)).replace("x", "x") != ""


def test_slots_follow_from_the_wrapper():
    page = lambda i: f"<body><div class=x1><p>All the same words here</p></div><div class=x2><p>Own words {i} of this page</p></div></body>"
    assert text(page(1)) != text(page(1), page(2), page(3)) == "Own words 1 of this page"  # a single page says nothing of sameness


def test_a_hot_host_with_classes_of_its_own_stays_small():
    name = lambda i: "".join(chr(97 + int(c)) for c in str(7919 * i))
    page = lambda i: f"<body><div class={name(i)}><p>Own {i}</p></div><div class=post-{i}><h2>H {i}</h2>" + "<h3>a</h3><p>b</p>" * 40 + "</div></body>"
    sizes = []
    tree = None
    for i in range(400):
        one = w.page_tree(page(i))
        tree = one if tree is None else w.aligned(tree, one)
        sizes.append(len(json.dumps(tree)))
    assert sizes[-1] < 3 * sizes[40] and sizes[-1] < 20_000
    assert "Own 5" in w.main_text(page(5), w.slots(tree))


def test_a_table_by_the_articles_of_its_pages(spark):
    got = {r.page_id: r.text for r in w.extracted(spark.read.parquet("/root/testdata/sf0.01/pages.parquet")).collect()}
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    for r in rows:
        body = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        body = re.sub(r'<div class="ad">.*?</div>|<script.*?</script>|<!--.*?-->', "\n", body, flags=re.S)
        words = " ".join(entities.unescape(re.sub(r"<[^>]*>", " ", body)).split())
        assert re.sub(r"\s", "", got[r.page_id]) == re.sub(r"\s", "", words), r.page_id


BODY = "<h1>Title {i}</h1><p>Own words number {i}, and many more of them for page {i}.</p><h2>Summary</h2><p>Last words {i} of it.</p>"
WANT = "Title {i}\n\nOwn words number {i}, and many more of them for page {i}.\n\nSummary\n\nLast words {i} of it."


def each(page, n=5):
    pages = [page.replace("{i}", str(i * 37)) for i in range(1, n + 1)]
    weight = w.slots(merged(*pages))
    return [w.main_text(p, weight) for p in pages]


def wanted(text, n=5):
    return [text.replace("{i}", str(i * 37)) for i in range(1, n + 1)]


def test_names_that_hold_a_listed_word_are_no_other_part():
    for before, after in (('<div class="content-sidebar-wrap"><main>', "</main></div>"), ('<div id="page" class="no-sidebar"><article>', "</article></div>"), ('<div class="sidebar"><main>', "</main></div>"), ('<div class="page has-comments"><article>', "</article></div>"), ('<body class="cookie login"><div class="entry">', "</div>")):
        assert each(f"<body><nav>a b</nav>{before}{BODY}{after}<footer>f</footer></body>") == wanted(WANT), before
    inside = '<article><p class="share-price">Price {i}</p><h2 id="login">Log in {i}</h2><section id="menu"><p>Dishes {i}</p></section><div class="share-buttons">Share {i}</div><div class="ad">Buy {i}</div><div id="comments">So nice {i}</div></article>'
    assert each(inside) == wanted("Price {i}\n\nLog in {i}\n\nDishes {i}")


def test_titles_headings_and_lists_of_links_stay():
    top, end = "<body><div class=top>Welcome to all</div>", "<div class=end>The same end</div></body>"
    assert each(f"{top}<div class=content>{BODY}</div>{end}") == wanted(WANT)
    title, rest = BODY.split("</h1>")
    assert each(f"{top}<div class=content>{title}</h1><div class=by>By {{i}}</div><div class=body>{rest}</div></div>{end}") == wanted(WANT.replace("\n\n", "\n\nBy {i}\n\n", 1))
    assert each(f"{top}{title}</h1><div class=body>{rest}</div>{end}") == wanted(WANT)
    links = "<h2>References</h2><ul><li><a href=x>Paper {i}</a></li><li><a href=y>Other {i}</a></li></ul>"
    assert each(f"{top}<div class=content>{BODY}{links}</div>{end}") == wanted(WANT + "\n\nReferences\n\nPaper {i}\n\nOther {i}")
    # but a menu beside it, even one that differs, and a notice that recurs are none of it
    assert each(f"{top}<ul class=x><li><a href=x>Go {{i}}</a></li></ul><div class=content>{BODY}<div class=rights>All rights reserved.</div></div>{end}") == wanted(WANT)


def test_the_heaviest_text_is_main_whatever_its_name():
    long = "Many words that tell of {i} and go on and on. " * 20
    assert each(f"<body><div class=top>Hi {{i}}</div><div class=widget><p>{long}</p></div></body>") == wanted(long.strip())


def test_pages_of_links_alone_have_no_text():
    assert each("<body><ul><li><a href=x>Go {i}</a></li></ul><p>The same</p></body>") == [""] * 5


def test_a_table_without_articles(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    plain = rows.selectExpr("page_id", "url", "replace(replace(html, '<article>', '<div class=\"x\">'), '</article>', '</div>') AS html")
    with_, without = ({r.page_id: r.text for r in w.extracted(df).collect()} for df in (rows, plain))
    hosts = {r.page_id: r.url.split("/")[2] for r in rows.collect()}
    known = [i for i in with_ if list(hosts.values()).count(hosts[i]) >= 3]
    assert len(known) > 100
    same = sum(with_[i] == without[i] for i in known)
    assert same >= 0.97 * len(known), same / len(known)


def test_frames(spark):
    rows = [(1, "http://h.x/1", PAGE), (1, "http://h.x/1", PAGE), (2, None, None), (None, "http://h.x/2", "<article><p>b</p></article>"), (4, "odd url", "<p>c</p>")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, text string")
    got = sorted(((r.page_id or -1), r.text[:5], r.n_chars, len(r.text)) for r in w.extracted(df).collect())
    assert [g[:2] for g in got] == [(-1, "b"), (1, "Head "), (1, "Head "), (2, ""), (4, "c")]
    assert all(n == m for _, _, n, m in got)
    assert w.extracted(df.limit(0)).count() == 0
