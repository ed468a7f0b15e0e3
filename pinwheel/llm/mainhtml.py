"""Main text of web pages by composite text density.

For every node of the page's tree: characters C, tags T, characters LC and tags LT in links.
The composite density is characters per tag, scaled down where links prevail:

  C/T * log(C/LC * T/LT) / log(ln(C/(C-LC) * LC + LCb/Cb * C + e))

(b: the body; a zero denominator counts as 1). The density sum of a node adds up its
children's densities and its own bare text. The node of the largest sum is the main subtree;
the lowest density on its path to the body is the threshold, and every other node that
reaches it gives its own subtree of largest sum as well (an article in several parts).

Elements that hold no article by their meaning (scripts, ...) are left out of tree and text.
Others are doubtful by their tag (forms, navigation, ...) or by the words of their class, id
or role (adverts, comments, notices, ...); that is only evidence, which the densities of the
whole page can refute (see ``_prune``). Text inside a block is joined with single blanks,
blocks with an empty line; character references are decoded.
"""

from __future__ import annotations

import html
import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pinwheel.llm.common import column, map_text, texts_of

#: HTML's raw-text, void, block, and boilerplate elements.
RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
         "fieldset", "figcaption", "figure", "footer", "form", "frameset", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header",
         "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table",
         "tbody", "tfoot", "thead", "tr", "caption", "ul"}
NEVER = {"head", "script", "style", "noscript", "template", "iframe", "object", "embed", "svg", "canvas", "audio", "annotation", "annotation-xml",
         "video", "map", "select", "option", "datalist", "textarea", "button", "input", "title", "noframes", "noembed", "dialog"}
USUALLY_NOT = {"nav", "aside", "footer", "form", "menu", "header"}
#: Words that mark an element as something else than the article.
MARKERS = ("ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion promoted "
           "nav navbar navigation menu submenu breadcrumb breadcrumbs pagination pager toolbar topbar masthead sitemap "
           "header footer copyright colophon sidebar aside widget widgets related recommended recommendations trending popular "
           "comment comments commentlist respond replies discussion disqus feedback reviews testimonials guestbook "
           "cookie cookies consent gdpr notice notices notification alert disclaimer popup modal overlay paywall "
           "share sharing social newsletter subscribe subscription signup login search form")
MARKED = frozenset(MARKERS.split())
#: Those of them that name parts of articles as well.
WEAK = frozenset("alert notice notices disclaimer search form related recommended recommendations trending popular widget widgets "
                 "discussion feedback header social menu banner promotion aside".split())
#: And those that are matters an article may be about.
TOPICS = WEAK | frozenset("copyright cookie cookies consent gdpr login signup subscribe subscription sharing modal popup overlay "
                          "navigation pagination paywall notification sponsor sponsored reviews testimonials".split())
#: Words of a class or id that mark the article itself, and the words of text that bear it out.
POSITIVE = frozenset("content article post entry story main body text".split())
BORNE_OUT = 10
#: Weakly marked elements outside the article are dropped below this share of the page's text, taken together by marks.
SMALL = 0.1
#: The page's densest subtree stays if it has more than so many times the text that is left without it.
MOST = 4
#: Parts of a class name that tell of a state or a layout of something that isn't what they name.
STATES = {"open", "opened", "closed", "has", "no", "with", "without", "enabled", "disabled", "layout", "page", "wrapper", "content"}
MARK_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "alertdialog", "menu", "menubar"}
#: What a start tag closes, up to the given borders.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"}), "tbody": ({"tbody", "thead"}, {"table"})}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
ENDS_PARAGRAPH = BLOCK - {"body", "html", "head", "tr", "tbody", "thead", "tfoot", "caption", "legend"}

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>"
                   r"|<[!?][^>]*+(?:>|\Z)|</?[a-zA-Z][^>]*+\Z", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: Parts of a block, list or table, which don't stand alone.
PARTS_OF = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q",
            "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
            "li", "dt", "dd", "tr", "td", "th", "tbody", "thead", "tfoot", "caption", "col", "colgroup", "figcaption", "summary", "legend"}

PARTS = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")


class Node:
    __slots__ = ("tag", "parent", "kids", "doubtful", "chars", "tags", "link_chars", "link_tags", "density", "sum", "own", "core", "titled",
                 "inside", "marks", "positive")

    def __init__(self, tag: str, parent, doubtful: frozenset = frozenset(), positive: bool = False):
        self.tag, self.parent, self.doubtful, self.positive, self.own = tag, parent, doubtful, positive, -1
        self.kids: list = []  # nodes and strings, in order


def doubtful(tag: str, attributes: str) -> frozenset:
    """What tells that an element is probably not part of an article: its tag (``<form>``), its
    role (``=alert``) or words of its class and id; empty for headings and where nothing does."""
    if tag in USUALLY_NOT:
        return frozenset((f"<{tag}>",))
    if tag in {"html", "body", "article", "main"} or tag in HEADINGS or "=" not in attributes:
        return frozenset()
    marks: set = set()
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        value = a or b or c
        if name.lower() == "role":
            role = value.strip().lower()
            if role in MARK_ROLES:
                marks.add(role if role in ("alert", "search") else f"={role}")
            continue
        for word in value.split():
            parts = {x.lower() for x in PARTS.findall(word)}
            if not parts & STATES:
                marks |= parts & MARKED
    return frozenset(marks)


def positive(tag: str, attributes: str) -> bool:
    """Whether tag, class or id say that an element is the article."""
    return tag in ("article", "main") or "=" in attributes and any(
        {x.lower() for x in PARTS.findall(a or b or c)} & POSITIVE for name, a, b, c in ATTRIBUTE.findall(attributes) if name.lower() != "role")


def parse(page: str) -> Node:
    """A tree of the page: unclosed paragraphs, items and cells end where HTML ends them, stray
    end tags are ignored, unknown or cut-off markup is dropped."""
    root = Node("html", None)
    here, place, skip = root, 0, ""
    for m in TOKEN.finditer(page):
        if skip:  # inside raw text: only its own end tag counts
            if not ((m[1] or m[4]) and (m[2] or m[5]).lower() == skip):
                continue
            skip = ""
            place = m.end()
            continue
        if m.start() < place:
            continue
        if m.start() > place:
            here.kids.append(page[place:m.start()])
        place = m.end()
        closing, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            continue
        tag = name.lower()
        if closing:
            node = here
            while node is not root and node.tag != tag:
                node = node.parent
            if node is not root:
                here = node.parent
            elif tag == "p":
                here.kids.append(Node("p", here))
            continue
        if tag in ("html", "body"):
            if tag == "body":
                node = here
                while node is not root and node.tag != "head":
                    node = node.parent
                here = node.parent or root
            continue
        if tag in ENDS_PARAGRAPH:
            here = _closed(here, {"p"}, {"table", "td", "th", "button", "object"})
        if tag in CLOSES:
            here = _closed(here, *CLOSES[tag])
        marks = doubtful(tag, attributes)
        node = Node(tag, here, marks, not marks and positive(tag, attributes))
        here.kids.append(node)
        if tag in RAW:
            skip = tag
        elif tag not in VOID:
            here = node  # a closing slash means nothing on an HTML element
    if place < len(page) and not skip:
        here.kids.append(page[place:])
    return root


def _closed(here: Node, tags: set, borders: set) -> Node:
    """Where to go on after closing the nearest open element of ``tags`` within ``borders``."""
    node = here
    while node.parent is not None and node.tag not in borders:
        if node.tag in tags:
            return node.parent
        node = node.parent
    return here


def _order(root: Node) -> list[Node]:
    """All nodes, parents first."""
    nodes, k = [root], 0
    while k < len(nodes):
        nodes += [x for x in nodes[k].kids if isinstance(x, Node)]
        k += 1
    return nodes


def _prune(root: Node) -> None:
    """Drop what never is article text, and what is doubtful unless the text speaks against it.

    A doubtful element stays if it wraps the article or is its header, or if it isn't mostly
    links and: it is weakly marked, and lies in the article or the densest subtree, has the
    title or a share of the text that isn't small; or its marks can be matters of the article
    it lies in, and its density reaches the body-path threshold; or it holds the subtree of
    largest density sum and most of the page's text (then others with its marks stay too),
    and no other element is marked as the article and bears it out.
    """
    nodes = _order(root)
    for n in reversed(nodes):
        n.kids = [x for x in n.kids if isinstance(x, str) or x.tag not in NEVER]
    if not any([n.doubtful for n in nodes]):
        return
    nodes = _measure(root)
    for n in reversed(nodes):
        below = [x for x in n.kids if isinstance(x, Node)]
        n.core = n.tag in ("article", "main") or any([x.core for x in below])
        n.titled = (n.tag == "h1") + sum([x.titled for x in below])
    densest = _best(root)
    for n in nodes:
        # 2: inside an article, 1: inside the densest subtree.
        n.inside = 2 if n.tag in ("article", "main") else max(n.parent.inside if n.parent else 0, n is densest)
    threshold, n = math.inf, densest
    while n is not None:
        threshold, n = min(threshold, n.density), n.parent
    small, shares = SMALL * root.chars, {}
    for n in nodes:  # a text counts for the nearest marks around it
        n.marks = n.doubtful or (n.parent.marks if n.parent else n.doubtful)
        shares[n.marks] = shares.get(n.marks, 0) + n.own

    def stays(x: Node) -> bool:
        around = x.parent.inside
        if not x.doubtful or x.core:
            return True
        if x.tag == "header":  # an article's own header holds its title, as the one with the page's only titles does
            return around == 2 or 0 < x.titled == root.titled and 2 * x.link_chars <= x.chars
        if x.tag == "form" and x.titled:  # a page in a form
            return True
        if 2 * x.link_chars > x.chars:
            return False
        if around == 2 and x.doubtful <= TOPICS and x.density >= threshold:
            return True
        if not x.doubtful <= WEAK:
            return False
        return around > 0 or x.titled > 0 or x.chars >= small or shares[x.doubtful] >= small

    left, stack = 0, [root]
    while stack:
        n = stack.pop()
        left += n.own
        stack += [x for x in n.kids if isinstance(x, Node) and stays(x)]
    refuted, n, out = set(), densest, None
    while n.parent is not None:
        if not stays(n):
            out = n
            refuted.add(n.doubtful)
        n = n.parent
    if out is None or 2 * densest.link_chars > densest.chars or out.chars <= MOST * left or _borne_out(root, stays):
        refuted.clear()
    for n in nodes:
        n.kids = [x for x in n.kids if isinstance(x, str) or stays(x)
                  or (x.doubtful in refuted and 2 * x.link_chars <= x.chars and (x.chars >= small or x.tag not in USUALLY_NOT))]


def _borne_out(root: Node, stays) -> bool:
    """Whether an element marked as the article, outside of what doesn't stay, has some text."""
    stack = [(root, False)]
    words = 0
    while stack:
        n, inside = stack.pop()
        inside = inside or n.positive
        for x in n.kids:
            if isinstance(x, Node):
                if stays(x) and x.tag != "a":
                    stack.append((x, inside))
            elif inside:
                words += len(x.split())
    return words >= BORNE_OUT


def _measure(root: Node) -> list[Node]:
    nodes = _order(root)
    for n in reversed(nodes):
        if n.own < 0:  # the texts stay when nodes are dropped
            n.own = sum([len(" ".join(html.unescape(x).split())) for x in n.kids if isinstance(x, str)])
        sub = [x for x in n.kids if isinstance(x, Node)]
        n.chars = n.own + sum([x.chars for x in sub])
        n.tags = sum([x.tags + 1 for x in sub])
        n.link_tags = sum([x.link_tags + (x.tag == "a") for x in sub])
        n.link_chars = n.chars if n.tag == "a" else sum([x.link_chars for x in sub])
    ratio = root.link_chars / max(root.chars, 1)
    for n in nodes:
        n.density = _density(n, ratio)
    for n in nodes:
        n.sum = n.own + sum([x.density for x in n.kids if isinstance(x, Node)])
    return nodes


def _density(n: Node, body_ratio: float) -> float:
    c, t = n.chars, max(n.tags, 1)
    if not c:
        return 0.0
    lc, lt = max(n.link_chars, 1), max(n.link_tags, 1)
    base = math.log(c / max(c - n.link_chars, 1) * n.link_chars + body_ratio * c + math.e)
    return c / t * math.log(max(c / lc * t / lt, 1.0)) / max(math.log(base), 1e-3) if base > 1 else 0.0


def _best(top: Node) -> Node:
    """The node of largest density sum at or below ``top``; the outermost of equal ones."""
    best = top
    for n in _order(top):
        if n.sum > best.sum and n.tag not in PARTS_OF:
            best = n
    return best


def main_nodes(root: Node) -> list[Node]:
    """The chosen subtrees in page order, none inside another."""
    _prune(root)
    nodes = _measure(root)
    if not root.chars:
        return []
    main = _best(root)
    threshold, n = math.inf, main
    while n is not None:
        threshold = min(threshold, n.density)
        n = n.parent
    chosen = {id(main)} | {id(_best(n)) for n in nodes if n.density >= threshold and n.tag not in PARTS_OF}
    out, stack = [], [root]
    while stack:
        n = stack.pop()
        if id(n) in chosen:
            out.append(n)
        else:
            stack += reversed([x for x in n.kids if isinstance(x, Node)])
    return out


def blocks(node: Node) -> list[str]:
    """Text blocks below a node, in page order."""
    out, run = [], []

    def flush():
        text = " ".join(html.unescape("".join(run)).split())
        if text:
            out.append(text)
        run.clear()

    stack: list = [node]
    while stack:
        x = stack.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            run.append(x)
        elif x.tag in BLOCK:
            flush()
            stack.append(None)
            stack += reversed(x.kids)
        elif x.tag in ("br", "td", "th"):
            run.append(" ")
            stack += reversed(x.kids)
        else:
            stack += reversed(x.kids)
    flush()
    return out


def main_text(page: str | None) -> str:
    """The article of a page as text; empty for a null or empty page."""
    if not page:
        return ""
    return "\n\n".join([b for n in main_nodes(parse(page)) for b in blocks(n)])


def extract_main_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", out_col: str = "text") -> DataFrame:
    """All columns of ``pages`` but ``html_col``, and ``out_col``, the main text of the whole page
    (a column of that name is replaced). Null pages give an empty text; repeated rows are each
    extracted; an empty table gives no rows. No shuffle."""
    kept = [c for c in pages.columns if c not in (html_col, out_col)]
    plain = pages.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], F.col(f"`{html_col}`").cast("string").alias("text"))
    types = dict(plain.dtypes)
    schema = ", ".join([f"c{i} {types[f'c{i}']}" for i in range(len(kept))] + ["text string"])

    def start():
        def work(piece):
            return [*(column(piece, f"c{i}") for i in range(len(kept))), [main_text(p) for p in texts_of(piece)]]
        return work

    return map_text(plain, schema, start).toDF(*kept, out_col)


def page_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    out = extract_main_text(pages.select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
