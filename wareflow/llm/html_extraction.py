"""HTML extraction by consensus host paths.

1. Each page is parsed into containers. A container's own text is scored: its characters outside links,
   with marks for the tags and class words that main or side content usually has; the best container
   names a path of tags and generalised classes (digits cut, so `post-17` and `post-18` agree).
2. The paths are votes; Spark adds them up per host. Paths with a quarter of the host's votes win, at most
   four: a host may have several templates.
3. A page whose own best container has a winning path is extracted with it; another page with the winning
   path that has most votes of those that hold half of its unlinked text (of equal ones the longest, then
   the last by name). A page with none of them, or without a host, is extracted with its own best container.

Blocks with unlinked text that stand around the chosen container, but in no container of their own or in
one with the title (h1), belong to the text; other containers beside it do not. Inside the chosen
container side content (menus, headers of the site, footers, side bars, notices, adverts, forms, comments,
scripts, styles) is left out. It is told by its tag, or by a class, id or role
that is, begins or ends with a word for side content; words after `has-`, `with-`, `no-` name what is there,
not what it is. What holds most of the page's unlinked text is no side content by its words, nor as a form
or header, unless an article or main element with text stands beside it; comments, adverts and consent
notices are left out at any length where there is other text. Blocks become lines: character references are
decoded, runs of white space are one space, blocks without text are dropped.

Tags that are never closed end with the container that holds them; a `<p>`, `<li>`, ... ends at the next
one; a `<head>` ends at the first tag or text that cannot stand in it. Where `<body>` is left out, the root
of the page is the body. Defined cases: a null or empty html gives an empty text; so does a page without
text outside side content, and a text without any tag, which is no page; a page without a
host has no vote; repeated rows vote once each.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wareflow.llm.arrays import map_columns, quoted, set_aside
from wareflow.operators.shared import shared_folder, stored
from wareflow.llm.url_filter import url_host

# Tags by role in HTML
BROADCAST_BYTES = 16 << 20  # winning paths up to this measured size are broadcast
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "svg", "title", "object", "canvas", "math"}
SIDE = {"nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "head", "fieldset", "label", *RAW}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main",
    "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
CONTAINERS = {"article", "body", "div", "main", "section", "td"}
IN_HEAD = {"html", "head", "base", "link", "meta", "title", "style", "script", "noscript", "template"}
# Words in classes, ids and roles of side content, and of main content
SIDE_WORDS = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent disqus footer gdpr "
    "header masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted promotion related replies reply "
    "search share sharing sidebar sidenav signup social sponsor sponsored subscribe subscription toolbar widget widgets complementary "
    "contentinfo alert disclaimer login".split()
)
COMMENT_WORDS = set("comment comments disqus replies reply".split())
NOTICE_WORDS = set("ad ads advert adverts advertisement advertising consent cookie cookies gdpr sponsored".split())
# In a name, what follows is there or missing, or named as well
JOINING = set("has have having hide hides hidden no non not with without".split())
MAIN_WORDS = set("article articlebody body content entry main post story text".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$)", re.S)
_NAMES = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I | re.S)
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "path", "side", "items", "linked", "own", "bonus")

    def __init__(self, tag: str, path: str, side: bool, bonus: float):
        self.tag, self.path, self.side, self.bonus = tag, path, side, bonus
        self.items: list = []  # texts and nodes in page order
        self.linked = self.own = 0  # characters in links, characters in all


def _side_words(name: str) -> set[str]:
    """The words that make a class, id or role one of side content: all of it, or its first or last part."""
    parts = _WORD.findall(name)
    joined = next((i for i, p in enumerate(parts) if p in JOINING), len(parts))
    if MAIN_WORDS.intersection(parts[joined:]) or "and" in parts and not SIDE_WORDS.issuperset(set(parts) - {"and"}):
        return set()
    return SIDE_WORDS.intersection(parts[:joined][:1] + parts[:joined][-1:])


def _attributes(raw: str) -> tuple[str, set[str], set[str], bool, bool]:
    """(generalised class part of the path, words of class, id and role, those for side content, whether comments or notices, whether hidden)."""
    name, words, names, hidden = "", set(), set(), False
    if raw and ("=" in raw or "hidden" in raw):
        for m in _NAMES.finditer(raw):
            key, value = m[1].lower(), html.unescape(m[2] or m[3] or m[4] or "").lower()
            if key == "class":
                name = "".join("." + c for c in sorted({re.sub(r"\d+", "", c) for c in value.split()}) if c)
            if key in ("class", "id", "role"):
                words |= set(_WORD.findall(value))
                names |= set(value.split())
            elif key == "style":
                hidden |= "display:none" in value.replace(" ", "")
            else:
                hidden |= key == "hidden" or value == "true"
    side = set().union(*map(_side_words, names)) if words & SIDE_WORDS else set()
    return name, words, side, bool(side & COMMENT_WORDS or names & NOTICE_WORDS), hidden


def parse(page: str) -> Node:
    """The tree of a page; what is unclosed ends with its container."""
    root = Node("", "", False, 0)
    stack, at, n = [root], 0, len(page)
    named = {}  # what is side content by its words, or a form: node -> whether comments or notices
    while at < n:
        m = _TOKEN.search(page, at)
        text = page[at : m.start()] if m else page[at:]
        if text:
            if stack[-1].tag == "head" and text.strip():
                stack.pop()
            stack[-1].items.append(html.unescape(text))
        if not m:
            break
        at = m.end()
        tag = m[2].lower() if m[2] else ""
        if not tag:
            continue
        if m[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
                # an inline or paragraph end tag does not close the container around it
                if stack[depth].tag in CONTAINERS | {"nav", "footer", "aside", "header", "table"} and tag not in CONTAINERS | {"nav", "footer", "aside", "header", "table", "html"}:
                    break
            if tag == "p" or tag in BLOCKS:
                stack[-1].items.append(None)
            continue
        if stack[-1].tag == "head" and tag not in IN_HEAD:
            stack.pop()
        if tag in BLOCKS and tag not in ("br", "hr"):
            _end_paragraph(stack)
        if tag in CLOSES:
            for depth in range(len(stack) - 1, max(0, len(stack) - 6), -1):
                if stack[depth].tag in CLOSES[tag]:
                    del stack[depth:]
                    break
                if stack[depth].tag in ("ul", "ol", "dl", "table", "select"):
                    break
        name, words, side_words, apart, hidden = _attributes(m[3])
        top = stack[-1]
        side = hidden or tag in SIDE or bool(side_words) and tag not in ("html", "body", "article", "main", "h1")
        if tag == "header" and not any(x.tag in ("article", "main") for x in stack):
            side = True
        bonus = (1.0 if tag in ("article", "main") else 0.0) + (0.5 if words & MAIN_WORDS else 0.0)
        node = Node(tag, f"{top.path}>{tag}{name}", side, bonus)
        top.items.append(node)
        if side and not hidden and (tag == "form" or tag not in SIDE):
            named[node] = apart
        if tag in RAW:
            # raw text up to its end tag; it is never shown
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else n
        elif tag not in VOID and not m[3].rstrip().endswith("/"):
            stack.append(node)
    if named:
        _keep_most(root, named)
    return root


def _keep_most(root: Node, named: dict[Node, bool]) -> None:
    """Takes the side mark from what holds most of the unlinked text of the page, with no main element beside it.

    Comments and notices lose it only if they hold all.
    """
    nodes, todo = [], [root]
    while todo:
        nodes.append(todo.pop())
        todo += [x for x in nodes[-1].items if isinstance(x, Node) and (not x.side or x in named)]
    plain: dict[Node, int] = {}
    for node in reversed(nodes):
        plain[node] = 0 if node.tag == "a" else sum(len(x.strip()) if isinstance(x, str) else plain.get(x, 0) for x in node.items if x is not None)
    # unlinked text in main elements: `marked` inside a node, `beside` outside it (elements around it do not count)
    marked: dict[Node, int] = {}
    for node in reversed(nodes):
        marked[node] = plain[node] if node.tag in ("article", "main") else sum(marked.get(x, 0) for x in node.items if isinstance(x, Node))
    beside = {root: 0}
    for node in nodes:
        within = sum(marked.get(x, 0) for x in node.items if isinstance(x, Node))
        beside.update((x, beside[node] + within - marked[x]) for x in node.items if isinstance(x, Node) and x in marked)
    for node, apart in named.items():
        if node in plain and (plain[node] == plain[root] > 0 if apart else 2 * plain[node] > plain[root] and not beside[node]):
            node.side = False


def _end_paragraph(stack: list[Node]) -> None:
    """A block ends the paragraph that is open, with the inline tags in it."""
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].tag == "p":
            del stack[depth:]
            return
        if stack[depth].tag in BLOCKS:
            return


def _walk(root: Node):
    """Nodes outside side content, each before its children."""
    todo = [root]
    while todo:
        node = todo.pop()
        yield node
        todo += [x for x in reversed(node.items) if isinstance(x, Node) and not x.side]


def _containers(root: Node) -> list[Node]:
    """Containers outside side content; the root is one on a page without `<body>`."""
    nodes = list(_walk(root))
    implied = all(n.tag != "body" for n in nodes)
    return [n for n in nodes if n.tag in CONTAINERS or implied and n is root]


def _measure(root: Node) -> None:
    nodes = list(_walk(root))
    for node in reversed(nodes):
        for x in node.items:
            if isinstance(x, str):
                node.own += len(x.strip())
            elif isinstance(x, Node) and not x.side:
                node.own += x.own
                node.linked += x.own if x.tag == "a" else x.linked


def best_container(root: Node) -> Node | None:
    """The container with the best score: text outside links, weighted by its marks.

    Inside the body a container wins unless it has clearly less of the text, as the others there may be
    anything; inside one that was better than the body, only if its marks make it better still or it leaves
    out no unlinked text.
    """
    _measure(root)
    best, score = None, 0.0
    for node in _containers(root):
        if node.own:
            plain = node.own - node.linked
            worth = plain * (1 + node.bonus) * (1 - node.linked / (node.own + 1)) + 0.01 * (1 + node.path.count(">"))
            inside = best is not None and node.path.startswith(best.path + ">")
            whole = inside and (plain == best.own - best.linked or best.tag in ("", "body") and node.tag != "td" and worth >= 0.95 * score)
            if worth > score or whole:
                best, score = node, max(worth, score)
    return best


def block_texts(root: Node, chosen: list[Node]) -> list[str]:
    """The blocks of the chosen containers in page order, without side content.

    Around them, blocks with unlinked text that are in no other container, or in one with the title.
    """
    out, line, plain = [], [], False  # plain: whether the line may stay

    def close():
        nonlocal plain
        text = _SPACE.sub(" ", "".join(line)).strip()
        if text and plain:
            out.append(text)
        line.clear()
        plain = False

    wanted = set(chosen)
    above = set()  # nodes around chosen containers or titles
    for node in reversed(list(_walk(root))):
        if any(isinstance(x, Node) and not x.side and (x in wanted or x in above or x.tag == "h1") for x in node.items):
            above.add(node)
    # node, its items, whether inside a chosen container, whether inside a link
    todo: list = [(root, iter(root.items), root in wanted, False)]
    while todo:
        node, items, inside, linked = todo[-1]
        x = next(items, StopIteration)
        if x is StopIteration:
            todo.pop()
            if node.tag in BLOCKS:
                close()
        elif x is None:
            close()
        elif isinstance(x, str):
            line.append(x)
            plain = plain or inside or not linked and any(map(str.isalnum, x))
        else:
            if x.tag in BLOCKS:
                close()
            if not x.side and (inside or x.tag not in CONTAINERS or x in wanted or x in above):
                todo.append((x, iter(x.items), inside or x in wanted, linked or x.tag == "a"))
    close()
    return out


def page_path(page: str | None) -> str | None:
    """A page's vote."""
    best = best_container(parse(page)) if page else None
    return best.path if best else None


def page_text(page: str | None, paths: str | list[str] | None) -> str:
    """The main text with a winning path of the host, first ones first, or else with the page's own best container.

    A path of the host that is not the page's own counts only where it holds half of the unlinked text.
    """
    if not page:
        return ""
    root = parse(page)
    best = best_container(root)
    if best is None:
        return ""
    paths = [paths] if isinstance(paths, str) else paths or []
    chosen = best.path
    if chosen not in paths:
        held = Counter()
        for n in _containers(root):
            held[n.path] += n.own - n.linked
        chosen = next((p for p in paths if 2 * held[p] >= root.own - root.linked > 0), chosen)
    return "\n".join(block_texts(root, [n for n in _containers(root) if n.path == chosen]))


def vote(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """(host, path, votes) of all pages with a host."""

    def paths(column: pa.Array) -> list:
        return [pa.array([page_path(p) for p in column.to_pylist()], pa.string())]

    named = pages.select(url_host(F.col(quoted(url))).alias("host"), F.col(quoted(page)).alias("page")).where("host <> ''")
    return map_columns(named, paths, ["page"], ["host"], "path string").where("path IS NOT NULL").groupBy("host", "path").agg(F.count("*").alias("votes"))


def winners(votes: DataFrame) -> DataFrame:
    """(host, paths): up to four paths for each host; a host has few paths, as classes are generalised."""
    shares = votes.withColumn("all", F.sum("votes").over(Window.partitionBy("host"))).where("4 * votes >= all")
    ranked = F.sort_array(F.collect_list(F.struct("votes", F.char_length("path").alias("long"), "path")), asc=False)
    return shares.groupBy("host").agg(ranked["path"].alias("paths"))


def extract(pages: DataFrame, url: str = "url", page: str = "html", text: str = "text") -> DataFrame:
    """`pages` with the main text of each page."""

    def texts(column: pa.Array, paths: pa.Array) -> list:
        return [pa.array([page_text(p, q) for p, q in zip(column.to_pylist(), paths.to_pylist(), strict=True)], pa.string())]

    given, names = set_aside(pages)
    host, folder = url_host(F.col(names[url])), shared_folder(pages.sparkSession)
    won = stored(winners(vote(given, names[url], names[page])), folder, "paths")
    size = won.agg(F.coalesce(F.sum(F.octet_length("host") + F.octet_length(F.array_join("paths", ",")) + 64), F.lit(0))).first()[0]
    # few hosts: no page is shuffled; else the key is spelled anew, so Spark can split the pages of a hot host
    won = won.select(F.concat(F.lit("host "), "host").alias("_host"), F.col("paths").alias("_paths"))
    won = F.broadcast(won) if size <= BROADCAST_BYTES else won
    joined = given.withColumn("_host", F.concat(F.lit("host "), F.coalesce(host, F.lit("")))).join(won, "_host", "left")
    out = map_columns(joined, texts, [names[page], "_paths"], list(names.values()), "_text string")
    kept = [F.col(n).alias(c) for c, n in names.items() if c.lower() != text.lower()]
    return out.select(*kept, F.col("_text").alias(text))
