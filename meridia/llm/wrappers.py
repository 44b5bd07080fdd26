"""Operator 8: main text of web pages by wrappers inferred for each host.

A page is read as a stream of tags and text and folded into a tree. A host's wrapper is a union-free expression over such
trees: aligning a further page with it keeps what both have, makes what only one has optional, folds neighbours of one shape
into a repeated group, and turns texts that differ into slots. Aligning two wrappers works alike, so each task first aligns
the pages of a host that it reads, and only these partial wrappers are shuffled: a hot host is as cheap as any.

A node of more than WIDE parts becomes a repeated group in which each shape is one optional part, and where classes alone make as
many shapes, they become one of any class; what lies deeper than DEEP elements counts to the part above it. So a wrapper stays small
whatever the pages of a host hold.

A wrapper says how much text each slot holds, how much of it is in links, and whether it was the same on all of three different
pages or more (copies of a page count once). A page's main part is found by its own slots: of those that differ between pages and
aren't mostly links, the deepest element with SHARE of the page's weight. Slots in article or main elements weigh more. Elements and roles
that hold no text (menus, footers, asides, forms, scripts and the like) and reader comments are never part of it. A class or an id that says no
more than a word for such parts (`sidebar`, `cookie-notice`, but not `content-sidebar-wrap` or `share-price`) lowers the weight of what is
in it: what is so named within the main part is left out, but a main part that stands in such an element is still one. All else of
an article or main element is text. Of other main parts it is what differs between pages, lists of links included, with headings that recur
before such text, and the title that stands before the part. Pages of several templates on one host so have their main parts each.

Defined cases: null html is an empty page; a page without main text has empty text; a null or odd url belongs to the host ''
or to what stands for one; repeated rows give repeated results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, slim

# Names of HTML elements and the usual words for parts of a page that aren't its text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img".split())
RAW = frozenset("script style noscript template svg textarea iframe object canvas select title xmp".split())
ASIDE = frozenset("nav footer aside form menu dialog button head header".split())
MAIN = frozenset("article main".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
NOT_TEXT = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe sidebar menu nav navbar navigation breadcrumb breadcrumbs footer comment comments disqus respond replies share sharing social related recommended widget login signup skip".split()
)
COMMENTS = frozenset("comment comments disqus respond replies".split())
HEADING = frozenset("header masthead".split())
#: Words that say nothing of what an element holds.
NEUTRAL = frozenset(
    "site page main top bottom left right inner outer box block bar list item items area section wrap wrapper container holder slot unit link links button buttons post posts entry article text title global primary secondary first last my the js wp ui col row group panel form icon icons label message inline fixed sticky mini small large".split()
)
#: Elements that hold blocks of a text, but not a whole one.
BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table thead tbody tfoot tr td th figure figcaption caption details summary address center".split())
TITLES = frozenset("h1 h2 h3 h4 h5 h6 dt th caption legend".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(?P<raw>script|style|noscript|template|svg|textarea|iframe|object|canvas|select|title|xmp)\b(?:"[^"]*"|'[^']*'|[^'">])*>.*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*>?|</(?P<close>[a-zA-Z][^\s>/]*)[^>]*>?|<(?P<open>[a-zA-Z][^\s>/]*)(?P<attrs>(?:"[^"]*"|'[^']*'|[^'">])*)>|(?P<text>[^<]+|<)""",
    re.S | re.I,
)
NUMBERED = re.compile(r"[0-9]{3,}")
ATTR = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
WIDE, DEEP = 24, 60
LEAST_PAGES = 3  # different pages with one text in a slot: it isn't theirs
MAIN_WEIGHT, SHARE = 20, 0.85
#: Factors of what is named as another part, and of lists of links; text weighs HEAVY at least, whatever its factors, lists of links less.
NAMED_WEIGHT, LINKS_WEIGHT, HEAVY = 0.05, 1e-9, 0.03
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def named(words: list[str], in_main: bool) -> str:
    """What a class or an id of these words says: '!' for reader comments, '~' for a part that isn't text, else nothing."""
    known = set(words)
    rest = known - NOT_TEXT - HEADING - NEUTRAL
    if rest:
        return ""
    if known & COMMENTS:
        return "!"
    return "~" if known & NOT_TEXT or (not in_main and known & HEADING) else ""


def shape(tag: str, attrs: str, in_main: bool) -> str:
    """An element's name in a wrapper: its tag, its first class, and '!' if it holds no main text or '~' if its name says so."""
    mark, first = "!" if tag in ASIDE and not (in_main and tag == "header") else "", ""
    if attrs and not attrs.isspace():
        for m in ATTR.finditer(attrs):
            name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if name == "role":
                mark = "!" if value in ROLES else mark
            elif name == "hidden" or (name == "aria-hidden" and value == "true"):
                mark = "!"
            elif name in ("class", "id"):
                # Within an article ids are places to link to.
                says = {named([w for w in re.split(r"[^a-z0-9]+", x) if w], in_main) for x in value.split()}
                mark = "!" if "!" in says else mark or ("~" if "~" in says and not (in_main and name == "id") else "")
                if name == "class" and value.split():
                    first = "." + NUMBERED.sub("#", value.split()[0]).replace("/", "_").rstrip("!~")
    return tag + first + (mark if tag not in ("html", "body", "article", "main") else "")


def blocks(page: str) -> Iterator[tuple[tuple[str, ...], str, int]]:
    """(path of shapes, text, characters of it in links) of each block of text, in order."""
    stack: list[tuple[str, str, int, int, int]] = []  # tag, shape, and how many of the elements so far are main, hold no main text, or are named so
    path: tuple[str, ...] = ()
    held: list[str] = []
    links = link_depth = open_p = 0

    def place() -> tuple[str, ...]:
        if len(stack) <= DEEP:
            return tuple([x[1] for x in stack])
        top, above = stack[-1], stack[DEEP - 2]
        return (*[x[1] for x in stack[: DEEP - 1]], ("article" if top[2] > above[2] else "div") + ".deep" + ("!" if top[3] > above[3] else "~" if top[4] > above[4] else ""))

    def flush():
        nonlocal links
        text = " ".join(entities.unescape("".join(held)).split())
        held.clear()
        out = (path, text, links)
        links = 0
        return out

    def pop_to(k: int) -> None:
        nonlocal path, link_depth, open_p
        open_p -= sum([x[0] == "p" for x in stack[k:]])
        del stack[k:]
        link_depth = 0
        path = place()

    for m in TOKEN.finditer(page):
        if m["text"] is not None:
            held.append(m["text"])
            if link_depth:
                links += len(m["text"])
        elif m["open"]:
            tag = m["open"].lower()
            if tag in INLINE:
                if tag in ("br", "img", "wbr"):
                    held.append(" ")
                if tag == "a":
                    link_depth = 1
                continue
            if held:
                yield flush()
            if tag in VOID:
                continue
            if tag in CLOSES_P and open_p:
                k = max(i for i, x in enumerate(stack) if x[0] == "p")
                pop_to(k)
            for other in CLOSES.get(tag, ()):
                k = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == other), -1)
                if k >= 0 and not any(x[0] in ("ul", "ol", "table", "dl") for x in stack[k:]):
                    pop_to(k)
            mains, bad, said = stack[-1][2:] if stack else (0, 0, 0)
            name = shape(tag, m["attrs"] or "", mains > 0)
            stack.append((tag, name, mains + (tag in MAIN), bad + name.endswith("!"), said + name.endswith("~")))
            open_p += tag == "p"
            path = (*path, stack[-1][1]) if len(stack) <= DEEP else place()
        elif m["close"]:
            tag = m["close"].lower()
            if tag in INLINE:
                if tag == "a":
                    link_depth = 0
                continue
            if held:
                yield flush()
            k = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), -1)
            if k >= 0:
                pop_to(k)
    if held:
        yield flush()


# A wrapper's node is [shape, optional, repeated, pages, children]; pages holds their number and the LEAST_PAGES smallest digests of them.
# A text slot has the shape '#' and, for children, [digest or null for differing texts, characters, characters in links].


def page_tree(page: str) -> list:
    """A page as a wrapper of one page."""
    own = [1, zlib.crc32(page.encode(errors="replace"))]
    root = ["", False, False, own, []]
    open_: list[list] = [root]
    last: tuple[str, ...] = ()
    for path, text, links in blocks(page):
        if not text:
            continue
        same = 0
        while same < len(path) and same < len(last) and path[same] == last[same]:
            same += 1
        if same == len(path) == len(last) and path:  # the next element of one shape
            same -= 1
        del open_[same + 1 :]
        for s in path[same:]:
            open_[-1][4].append(node := [s, False, False, own, []])
            open_.append(node)
        open_[-1][4].append(["#", False, False, own, [zlib.crc32(text.encode()), len(text), min(links, len(text))]])
        last = path
    return folded(root)


def folded(node: list) -> list:
    """Neighbours of one shape as one repeated group, all the way down."""
    if node[0] == "#":
        return node
    out: list[list] = []
    for child in node[4]:
        put(out, folded(child))
    node[4] = narrowed(out)
    return node


def put(parts: list[list], node: list) -> None:
    """Adds a further part; after one of its shape, the group repeats."""
    if parts and parts[-1][0] == node[0]:
        parts[-1] = aligned(parts[-1], node, within=True)
        parts[-1][2] = True
    else:
        parts.append(node)


def any_class(shape_: str) -> str:
    """The shape of elements of one name, whatever their class."""
    return shape_ if shape_ == "#" else shape_.rstrip("!~").split(".")[0] + ".*" + (shape_[-1] if shape_[-1:] in ("!", "~") else "")


def narrowed(parts: list[list]) -> list[list]:
    """Parts, if too many, as a repeated group of one optional part a shape; if too many still, one a name."""
    for name in (lambda s: s, any_class):
        if len(parts) <= WIDE:
            break
        by: dict[str, list] = {}
        for x in parts:
            x = [name(x[0]), True, True, *x[3:]]
            by[x[0]] = aligned(by[x[0]], x, True) if x[0] in by else x
        parts = list(by.values())
    return parts


def aligned(a: list, b: list, within: bool = False) -> list:
    """The least expression that covers both nodes, which are of one shape; within: both stand in the same page."""
    pages = [max(a[3][0], b[3][0]) if within else a[3][0] + b[3][0], *sorted({*a[3][1:], *b[3][1:]})[:LEAST_PAGES]]
    flags = [a[0], a[1] or b[1], a[2] or b[2], pages]
    if a[0] == "#":
        x, y = a[4], b[4]
        return [*flags, [x[0] if x[0] == y[0] else None, x[1] + y[1], x[2] + y[2]]]
    left, right = a[4], b[4]
    # a part of a name whose classes became one goes to that one
    for mine, other in ((left, right), (right, left)):
        wild = {x[0] for x in mine if ".*" in x[0]}
        if wild and any(x[0] not in wild and any_class(x[0]) in wild for x in other):
            by = [[any_class(x[0]) if any_class(x[0]) in wild else x[0], *x[1:]] for x in other]
            if other is right:
                right = merged_parts(by)
            else:
                left = merged_parts(by)
    n, m = len(left), len(right)
    if [x[0] for x in left] == [y[0] for y in right]:
        return [*flags, [aligned(x, y, within) for x, y in zip(left, right, strict=True)]]
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if left[i][0] == right[j][0] else max(best[i + 1][j], best[i][j + 1])
    out: list[list] = []
    i = j = 0
    while i < n or j < m:
        if i < n and j < m and left[i][0] == right[j][0]:
            put(out, aligned(left[i], right[j], within))
            i, j = i + 1, j + 1
        elif j == m or (i < n and best[i + 1][j] >= best[i][j + 1]):
            put(out, [left[i][0], True, *left[i][2:]])
            i += 1
        else:
            put(out, [right[j][0], True, *right[j][2:]])
            j += 1
    return [*flags, narrowed(out)]


def merged_parts(parts: list[list]) -> list[list]:
    """Parts of which some came to have one shape, each shape once."""
    by: dict[str, list] = {}
    for x in parts:
        by[x[0]] = aligned(by[x[0]], x, True) if x[0] in by else x
    return list(by.values())


def expression(node: list) -> str:
    """A wrapper as a union-free regular expression, for readers."""
    if node[0] == "#":
        body = "#text" if node[4][0] is None else "#same"
    else:
        inner = " ".join(map(expression, node[4]))
        body = f"<{node[0]}> {inner} </{node[0]}>" if node[0] else inner
    mark = ("+" if node[2] else "") if not node[1] else ("*" if node[2] else "?")
    return f"({body}){mark}" if mark else body


def element(shape_: str) -> str:
    """The tag of a shape."""
    return shape_.rstrip("!~").split(".")[0]


def slots(wrapper: list) -> dict[str, float]:
    """The weight of each path of slots: its characters a page, more in article or main elements, less in those named as something else;
    next to nothing if they are links for the most part, 0 if it is one text on different pages, and -1 if it is never main text.
    Paths with parts of any class end so."""
    found: dict[str, list] = {}
    waiting = [(wrapper, ())]
    while waiting:
        node, path = waiting.pop()
        if node[0] == "#":
            x = found.setdefault("/".join(path), [0, 0, False, 1])
            x[0] += node[4][1]
            x[1] += node[4][2]
            x[2] |= node[4][0] is not None and len(node[3]) > LEAST_PAGES
            x[3] = max(x[3], node[3][0])
        else:
            waiting += [(child, (*path, node[0]) if node[0] else path) for child in node[4]]
    out = {}
    for p, (n, links, same, pages) in found.items():
        parts = p.split("/")
        if any(s.endswith("!") for s in parts) or p.startswith("head"):
            out[p] = -1.0
        else:
            own = 0.0 if same else 1.0 if links * 2 < n else LINKS_WEIGHT
            out[p] = n / pages * own * (MAIN_WEIGHT if any(element(s) in MAIN for s in parts) else 1.0) * (NAMED_WEIGHT if any(s.endswith("~") for s in parts) else 1.0)
    return out


def main_part(paths: set[tuple[str, ...]], weight: dict[str, float]) -> tuple[str, ...] | None:
    """The path of the element that holds a page's main text; null if it has none."""
    held: dict[tuple[str, ...], float] = {}
    for p in paths:
        w = weight.get("/".join(p), 0.0)
        if w > HEAVY:
            for k in range(len(p) + 1):
                held[p[:k]] = held.get(p[:k], 0.0) + w
    if not held:  # an article that is the same on different pages is still one
        inside = sorted(p[: k + 1] for p in paths for k, x in enumerate(p) if element(x) in MAIN and weight.get("/".join(p)) == 0)
        return inside[0] if inside else None
    at = max((p for p in held if held[p] >= SHARE * held[()]), key=lambda p: (len(p), p))
    main = next((k + 1 for k, s in enumerate(at) if element(s) in MAIN), None)
    return at if main is None else at[:main]  # all of the article


def within(rows: list[tuple[tuple[str, ...], str]], at: tuple[str, ...], weight: dict[str, float]) -> list[str]:
    """The texts of a page's blocks (path, text) that belong to its main part, the element at."""
    whole = any(element(s) in MAIN for s in at)
    loose = not whole and bool(at) and element(at[-1]) in BLOCKS
    while at and not whole and element(at[-1]) in BLOCKS:
        at = at[:-1]  # to the element that holds all blocks of the text
    heavy = [weight.get("/".join(p), -1.0) > HEAVY for p, _ in rows]
    inside = [p[: len(at)] == at and (not loose or len(p) == len(at) or element(p[len(at)]) in BLOCKS) and weight.get("/".join(p), -1.0) >= 0 and not any(s[-1:] in ("!", "~") for s in p[len(at) :]) for p, _ in rows]
    if whole:
        return [t for (_, t), ok in zip(rows, inside) if ok]
    keep = [a and b for a, b in zip(inside, heavy)]
    first = next((i for i, k in enumerate(keep) if k), len(rows))
    nearly_all = element(at[-1]) in ("html", "body") if at else True
    after = False
    for i in range(len(rows) - 1, -1, -1):
        if inside[i] and not keep[i]:
            p = rows[i][0]
            # Headings that recur before own text, and lists of links that differ between pages.
            keep[i] = (after and bool(p) and element(p[-1]) in TITLES) or (weight["/".join(p)] > 0 and (not nearly_all or (after and i > first)))
        after = after or keep[i]
    # The title, and what stands between it and the part, if elements above the part hold them.
    for up in range(1, len(at) + 1):
        above = at[:-up]
        own = [i for i in range(first) if heavy[i] and rows[i][0][: len(above)] == above and not any(s[-1:] in ("!", "~") for s in rows[i][0][len(above) :])]
        title = next((i for i in reversed(own) if rows[i][0] and element(rows[i][0][-1]) in ("h1",) + (() if not above or element(above[-1]) in ("html", "body") else ("h2",))), None)
        if title is not None:
            for i in own:
                keep[i] |= i >= title
            break
    return [t for (_, t), k in zip(rows, keep) if k]


def host_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper, main) for pages(host, html)."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_pydict({"host": pa.array(list(held), pa.string()), "wrapper": pa.array([json.dumps(w) for w in held.values()], pa.string())})
            held.clear()
            return batch

        for batch in batches:
            for host, page in zip(batch.column("host"), batch.column("html"), strict=True):
                tree = page_tree(page.as_py() or "")
                host = host.as_py()
                held[host] = aligned(held[host], tree) if host in held else tree
            if len(held) > 2000:
                yield out()
        if held:
            yield out()

    def whole(group: pa.Table) -> pa.Table:
        wrapper = None
        for x in sorted(group.column("wrapper").to_pylist()):
            tree = json.loads(x)
            wrapper = tree if wrapper is None else aligned(wrapper, tree)
        found = slots(wrapper)
        return pa.table({"host": group.column("host")[:1], "wrapper": pa.array([json.dumps(wrapper)]), "slots": pa.array([json.dumps(found)])})

    parts = pages.select("host", "html").mapInArrow(partial, "host string, wrapper string")
    return parts.groupBy("host").applyInArrow(whole, "host string, wrapper string, slots string")


class Wrapped:
    """A host's slots, to read its pages by."""

    def __init__(self, weight: dict[str, float]):
        self.weight = weight
        self.wild = {"/".join(q[: k + 1]) for p in weight if ".*" in p for q in [p.split("/")] for k, s in enumerate(q) if ".*" in s}
        self.known: dict[tuple[str, ...], tuple[str, ...]] = {}
        self.main: dict[frozenset, tuple[str, ...] | None] = {}

    def path(self, path: tuple[str, ...]) -> tuple[str, ...]:
        """A page's path as the wrapper has it."""
        if not self.wild:
            return path
        if path not in self.known:
            out: tuple[str, ...] = ()
            for s in path:
                any_ = (*out, any_class(s))
                out = any_ if "/".join(any_) in self.wild else (*out, s)
            self.known[path] = out
        return self.known[path]

    def text(self, page: str) -> str:
        """The blocks of a page that stand in its main part, two newlines between them."""
        rows = [(self.path(path), text) for path, text, _ in blocks(page) if text]
        paths = frozenset(p for p, _ in rows)
        if paths not in self.main:
            if len(self.main) > 2000:
                self.main.clear()
            self.main[paths] = main_part(paths, self.weight)
        at = self.main[paths]
        return "" if at is None else "\n\n".join(within(rows, at, self.weight))


def main_text(page: str, weight: dict[str, float]) -> str:
    """The main text of a page by its host's slots."""
    return Wrapped(weight).text(page)


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: page_id, url, text, n_chars."""
    rows = slim(pages, page_id=id_col, url=url_col, html=html_col)
    rows = rows.withColumn("host", F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), HOST, 1)))
    # Written first: a join of two tables is one that AQE can split where a host is hot, or send out where wrappers are few.
    known = materialize(host_wrappers(rows).select("host", "slots"), "wrappers")
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Wrapped] = {}
        for batch in batches:
            texts = []
            for page, own in zip(batch.column("html"), batch.column("slots"), strict=True):
                key = own.as_py() or "{}"
                if key not in held:
                    if len(held) > 500:
                        held.clear()
                    held[key] = Wrapped(json.loads(key))
                texts.append(held[key].text(page.as_py() or ""))
            yield pa.RecordBatch.from_pydict({"page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    joined = rows.join(known, "host", "left").select("page_id", "url", "html", "slots")
    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint")
