"""Main text of web pages by tree scoring.

A page is cut into tags and text by one regular expression and built into a tree. Text blocks
pass points for length and commas to their ancestors, halved at each step; an ancestor's points are
discounted by the share of its text that lies in links. The container with the most
points is kept together with siblings that read like it: text elements and containers of its kind with few
links, tables, and text that stands loose beside it.
"""

from __future__ import annotations

import html
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm._shared import map_texts

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes svg math".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th
    thead tr ul br""".split())
CLOSES_P = BLOCK - {"br", "body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
#: Never part of an article.
DROP = frozenset("""script style noscript template iframe object embed svg math canvas audio video head title nav footer aside form
    button select option input textarea fieldset menu dialog noembed noframes xmp map""".split())
#: Words in class, id or role that mark page furniture, and words that speak for content.
FURNITURE = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar navigation
    breadcrumb breadcrumbs footer header masthead comment comments disqus discussion replies reply respond share sharing social related recommended
    recommendations widget cookie cookies consent gdpr notice notices alert popup modal overlay subscribe subscription newsletter signup login search
    pagination pager toolbar copyright legal disclaimer skip toc tags meta byline complementary contentinfo outbrain taboola""".split())
CONTENT = frozenset("article content main body entry post story text page hentry maincontent".split())
SCORED = frozenset("p pre td li blockquote dd h1 h2 h3 h4 h5 h6 div section article main body".split())

#: Elements that hold text, not other containers.
TEXT = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote table figure section".split())

TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
TELLING = re.compile("class|id|role|style|hidden", re.I)
BARE_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|/?$)")
NO_NAMES: frozenset[str] = frozenset()
#: Furniture even where a content word stands beside it.
STRONG = frozenset("comment comments ad ads sidebar footer header nav menu".split())
NAME_PART = re.compile(r"[a-z0-9]+")


class Node:
    __slots__ = ("tag", "parent", "kids", "names", "furniture", "points", "chars", "linked", "hidden")

    def __init__(self, tag: str, parent: "Node | None", attributes: str = ""):
        self.tag, self.parent, self.kids = tag, parent, []
        self.points = self.chars = self.linked = 0.0
        self.names, self.hidden, self.furniture = NO_NAMES, False, False
        if attributes and TELLING.search(attributes):
            found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
            self.names = frozenset(NAME_PART.findall(" ".join(found.get(a, "") for a in ("class", "id", "role")).lower()))
            style = found.get("style", "").replace(" ", "").lower()
            self.hidden = ("display:none" in style or "visibility:hidden" in style or found.get("aria-hidden", "").lower() == "true"
                           or BARE_HIDDEN.search(attributes) is not None)
            self.furniture = bool(self.names & FURNITURE) and not (self.names & CONTENT and not self.names & STRONG)


def build(page: str) -> Node:
    """The element tree; strings are text with references decoded. Unclosed and stray tags are
    mended as browsers do in common cases: block starts and ends close an open paragraph, list items
    and table cells close their like, a stray end tag is ignored."""
    root = node = Node("html", None)
    at, end = 0, len(page)
    while at < end:
        m = TOKEN.search(page, at)
        if m is None:
            node.kids.append(html.unescape(page[at:]))
            break
        if m.start() > at:
            node.kids.append(html.unescape(page[at:m.start()]))
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            up = node
            while up is not None and up.tag != tag:
                # an inline end tag does not reach outside its block
                if tag not in BLOCK and up.tag in BLOCK and up.tag != "p":
                    up = None
                    break
                up = up.parent
            if up is not None and up.parent is not None:
                node = up.parent
            continue
        if tag in ("html", "body"):
            if tag == "body" and node.parent is not None and node.tag != "body":
                node = root
            if tag == "html":
                continue
        if tag in CLOSES_P:
            up = node
            while up is not None and up.tag != "p" and (up.tag not in BLOCK):
                up = up.parent
            if up is not None and up.tag == "p":
                node = up.parent
        if tag in ("li", "dd", "dt", "tr", "td", "th", "option"):
            like = {"dd": ("dd", "dt"), "dt": ("dd", "dt"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",)}.get(tag, (tag,))
            stop = {"li": ("ul", "ol", "menu"), "dd": ("dl",), "dt": ("dl",), "td": ("tr", "table"), "th": ("tr", "table"), "tr": ("table", "tbody", "thead", "tfoot")}.get(tag, ("select",))
            up = node
            while up is not None and up.tag not in like and up.tag not in stop:
                up = up.parent
            if up is not None and up.tag in like:
                node = up.parent
        child = Node(tag, node, m[3] or "")
        node.kids.append(child)
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = close.end() if close else end
        elif tag not in VOID and not (m[3] or "").endswith("/"):
            node = child
    return root


def dropped(node: Node, in_article: bool) -> bool:
    if node.tag in DROP or node.hidden or node.furniture:
        return True
    return node.tag == "header" and not in_article


def blocks(node: Node) -> list[str]:
    """Texts of the blocks below ``node`` in page order, white space squeezed."""
    out, run = [], []

    def close() -> None:
        text = " ".join("".join(run).split())
        run.clear()
        if text:
            out.append(text)

    stack: list = [(node, 0, node.tag in ("article", "main"))]
    while stack:
        at, k, inside = stack.pop()
        if k < len(at.kids):
            stack.append((at, k + 1, inside))
            kid = at.kids[k]
            if isinstance(kid, str):
                run.append(kid)
            elif not dropped(kid, inside):
                if kid.tag in BLOCK:
                    close()
                stack.append((kid, 0, inside or kid.tag in ("article", "main")))
        elif at.tag in BLOCK or at is node:
            close()
    return out


def score(root: Node) -> list[Node]:
    """Pass points up; returns the containers that got some."""
    got: dict[int, Node] = {}
    stack: list = [(root, 0, False)]
    while stack:
        at, k, inside = stack.pop()
        if k < len(at.kids):
            stack.append((at, k + 1, inside))
            kid = at.kids[k]
            if isinstance(kid, str):
                text = kid.strip()
                if not text:
                    continue
                up, linked = at, False
                while up is not None:
                    linked = linked or up.tag == "a"
                    up.chars += len(text)
                    up.linked += len(text) * linked
                    up = up.parent
                if not linked:
                    box = at
                    while box.tag not in SCORED and box.parent is not None:
                        box = box.parent
                    points, up, share = text.count(",") + text.count("،") + text.count("、") + len(text) / 100.0 + 0.25, box.parent or box, 1.0
                    while up is not None:
                        up.points += points * share
                        got[id(up)] = up
                        up, share = up.parent, share / 2
            elif not dropped(kid, inside):
                stack.append((kid, 0, inside or kid.tag in ("article", "main")))
    return list(got.values())


def rank(node: Node) -> float:
    bonus = 1.25 if node.tag in ("article", "main") or node.names & CONTENT else 1.0
    return node.points * bonus * (1.0 - (node.linked / node.chars if node.chars else 0.0))


def belongs(kid: Node, kind: str, least: float) -> bool:
    """Whether an element beside the best container of tag ``kind`` goes with it: it reads like one, or it is a text
    element or a container of the same kind with few links."""
    if rank(kid) >= least:
        return True
    if not kid.chars or kid.linked / kid.chars >= 0.25:
        return False
    return kid.tag in TEXT or (kid.tag == kind and any(isinstance(x, Node) and x.tag in TEXT for x in kid.kids))


def beside(parent: Node, best: Node, middle: list[str], least: float) -> list[str]:
    """``middle``, the blocks of ``best``, between those of its siblings that belong to it; text and inline elements that
    stand loose in ``parent`` are blocks too."""
    out, loose = [], Node("div", None)

    def close() -> None:
        nonlocal loose
        said = [x for x in loose.kids if isinstance(x, str) or x.tag != "a"]
        if any(isinstance(x, str) and x.strip() or isinstance(x, Node) and x.chars > 2 * x.linked for x in said):
            out.extend(blocks(loose))
        loose = Node("div", None)

    for kid in parent.kids:
        if isinstance(kid, str) or (kid is not best and kid.tag not in BLOCK):
            if isinstance(kid, str) or not dropped(kid, False):
                loose.kids.append(kid)
            continue
        close()
        if kid is best:
            out += middle
        elif not dropped(kid, False) and belongs(kid, best.tag, least):
            out += blocks(kid)
    close()
    return out


def main_text(page: str) -> str:
    root = build(page)
    got = score(root)
    if not got:
        return ""
    best = max(got, key=rank)
    up = best.parent  # an article or main element around the best container is the container
    while up is not None:
        if up.tag in ("article", "main"):
            best = up
        up = up.parent
    out, least = blocks(best), max(1.0, 0.2 * rank(best))
    if best.tag in ("article", "main"):
        if best.parent is None or best.tag == "main":
            return " ".join(out)
        return " ".join(x for kid in best.parent.kids if isinstance(kid, Node) for x in (
            out if kid is best else blocks(kid) if kid.tag == "article" and not dropped(kid, False) and rank(kid) >= least else []))
    at = best
    while at.parent is not None:  # siblings of the best container and, below the body, of what is around it
        if at is not best and (at.tag == "body" or at.parent.tag == "body" or at.parent.parent is None):
            break
        out, at = beside(at.parent, at, out, least), at.parent
    return " ".join(out)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: ``id_col, url_col, text, n_chars`` (code points; text is empty if none).

    Null or empty html gives an empty text; null ids and urls are passed on; repeated rows stay
    repeated; other columns are ignored. A page without any scored text, or one whose text
    all lies in links or page furniture, gives an empty text. Pages are independent, so there is
    no shuffle and a lost executor costs only its own pages."""
    def work():
        def run(texts: list[str]):
            found = [main_text(x) for x in texts]
            return None, [found, [len(x) for x in found]]
        return run

    return map_texts(pages, {id_col: F.col(id_col), url_col: F.col(url_col)}, F.col(html_col), "text string, n_chars long", work)
