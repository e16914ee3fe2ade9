"""Main text of web pages by composite text density.

For every element of the page tree: C characters and T tags below it, LC and LT
those inside links. Its density is C/T, adjusted by the logarithm of (C/LC)(T/LT)
to a base that grows with the share of linked text (the composite text density).
The container with the largest sum of its children's densities holds the main
text. The smallest density on the path from it to the body is the threshold
that text beside the path must reach. Elements that by their tag, role or class
are menus, headers, footers, sidebars, notices, adverts, forms or comments, as
well as scripts and styles, are left out before densities are taken. An element
isn't left out for its class if it holds a main element, or if it holds an article
or most of the page's unlinked text and no article outside such elements holds a
quarter as much; and classes count for nothing if they would leave out more
unlinked text than they leave, unless such an article is left.

Defined results: a null or empty page, or one without text, gives an empty
text; malformed markup (unclosed, stray or deeply nested tags) is repaired as
far as the open elements tell; a tie of density sums goes to the first element
in page order; pages of any length are read whole; repeated rows give repeated
results. ``<br>`` is white space inside its block.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, defaultdict
from collections.abc import Callable

from pyspark.sql import DataFrame

from touchpath.llm.common import LONG, STRING, field, map_text

MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:"[^"]*"|'[^']*'|[^"'>])*+)>|[^<]++|<""", re.S)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/"']|\Z)""", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noframes".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that may hold a whole main text; a paragraph or an inline element may not.
HOLDERS = BLOCK - HEADINGS - frozenset("address caption dd dl dt figcaption hr li p pre summary tr".split())
DROPPED = RAW | frozenset("head nav footer aside form button select option template svg math object canvas audio video menu dialog header".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "tbody": {"tr", "td", "th", "tbody", "thead"}, "tfoot": {"tr", "td", "th", "tbody", "thead"}}
SCOPE = frozenset("table ul ol dl html body".split())
NOT_MAIN = frozenset("""ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies
alert alerts consent disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices notification paywall popup promo promoted
promotion related replies responses share sharing sidebar signup social sponsor sponsored subscribe toolbar widget""".split())
NOT_MAIN_START = re.compile(r"(?:advert|adsby|adsense|comment|cookie|sidebar|footer|navbar|navigation|sponsor|newsletter|breadcrumb|consent|disqus|popup)")
NOT_MAIN_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())


class Node:
    __slots__ = ("tag", "parent", "items", "dropped", "by_class", "chars", "tags", "link_chars", "link_tags", "density", "total", "in_article")

    def __init__(self, tag: str, parent: Node | None, dropped: bool):
        self.tag, self.parent, self.items, self.dropped, self.by_class = tag, parent, [], dropped, False
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0
        self.in_article = tag in ("article", "main") or parent is not None and parent.in_article


def _left_out(tag: str, attributes: str, parent: Node) -> bool:
    if tag in DROPPED and not (tag == "header" and parent.in_article):
        return True
    if not attributes or tag in ("body", "html", "article", "main"):
        return False
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "role" and value in NOT_MAIN_ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def _boilerplate_class(tag: str, attributes: str) -> bool:
    if not attributes or tag in ("body", "html", "article", "main"):
        return False
    for name, value in ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id"):
            words = re.split(r"[^a-z0-9]+", value.strip("\"'").lower())
            if not NOT_MAIN.isdisjoint(words) or any(map(NOT_MAIN_START.match, words)):
                return True
    return False


def _drop_by_class(nodes: list[Node]) -> None:
    """Leave out the elements with a boilerplate class and all below them, but none that may hold the main text."""
    flagged = {id(n) for n in nodes if n.by_class and not n.dropped}
    if not flagged:
        return
    unlinked, holds, within = Counter(), defaultdict(set), set()
    for node in reversed(nodes):  # children follow their parents
        if node.dropped or node.tag == "a":
            continue
        unlinked[id(node)] += sum(len(" ".join(x.split())) for x in node.items if isinstance(x, str))
        if node.parent is not None:
            unlinked[id(node.parent)] += unlinked[id(node)]
            holds[id(node.parent)] |= holds[id(node)]
            if node.tag in ("article", "main") and unlinked[id(node)]:
                holds[id(node.parent)].add(node.tag)
    outside = 0
    for node in nodes:
        if id(node) in flagged or node.parent is not None and id(node.parent) in within:
            within.add(id(node))
        elif node.tag in ("article", "main") and not node.dropped:
            outside = max(outside, unlinked[id(node)])
    total, out = unlinked[id(nodes[0])], set()
    for node in nodes:
        if node.parent is not None and id(node.parent) in out:
            out.add(id(node))
        elif id(node) in flagged:
            n, inner = unlinked[id(node)], holds[id(node)]
            if not ("main" in inner or ("article" in inner or 2 * n > total) and 4 * outside < n):
                out.add(id(node))
    removed = sum(unlinked[id(n)] for n in nodes if id(n) in out and id(n.parent) not in out)
    if 2 * removed > total and 4 * outside < removed:
        return
    for node in nodes:
        node.dropped = node.dropped or id(node) in out


def parse(page: str, by_class: bool = True) -> list[Node]:
    """Nodes in page order; the first is the root. Items of a node are texts and child nodes.

    Without ``by_class`` only tags tell which elements are left out.
    """
    root = Node("body", None, False)
    nodes, top, open_tags, at, size = [root], root, Counter(), 0, len(page)
    last_end = page.rfind(">")  # no markup can end after it

    def close(upto: Node) -> Node:
        node = top
        while node is not upto.parent:
            open_tags[node.tag] -= 1
            node = node.parent
        return node

    while at < size:
        if at > last_end and not page.startswith("<!--", at):
            top.items.append(page[at:])
            break
        found = MARKUP.match(page, at)
        at = found.end()
        slash, name, attributes = found.groups()
        if name is None:
            text = found.group()
            if text[0] != "<" or len(text) == 1:
                top.items.append(text)
            continue
        name = name.lower()
        if slash:
            if open_tags[name]:
                node = top
                while node.tag != name:
                    if name not in BLOCK and node.tag in BLOCK:
                        node = None  # a stray end of an inline element doesn't end blocks
                        break
                    node = node.parent
                if node is not None:
                    top = close(node)
            continue
        if name in ("html", "body"):
            continue
        if name in BLOCK and open_tags["p"]:
            node = top
            while node.tag != "p":
                node = node.parent
            top = close(node)
        if name in CLOSES and any(open_tags[t] for t in CLOSES[name]):
            node, last = top, None
            while node is not None and node.tag not in SCOPE:
                last = node if node.tag in CLOSES[name] else last
                node = node.parent
            if last is not None:
                top = close(last)
        if name in VOID:
            top.items.append(" ")
            top.tags += 1
            continue
        node = Node(name, top, top.dropped or _left_out(name, attributes if by_class else "", top))
        node.by_class = by_class and _boilerplate_class(name, attributes)
        nodes.append(node)
        top.items.append(node)
        if name in RAW:
            end = re.compile(rf"</{name}[^>]*+>?", re.I).search(page, at)
            at = end.end() if end else size
            continue
        open_tags[name] += 1
        top = node
    _drop_by_class(nodes)
    return nodes


def _measure(nodes: list[Node]) -> None:
    for node in reversed(nodes):  # children follow their parents
        if node.dropped:
            continue
        node.chars += sum(len(" ".join(x.split())) for x in node.items if isinstance(x, str))
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.link_tags + 1
        if node.parent is not None:
            up = node.parent
            up.chars += node.chars
            up.tags += node.tags + 1
            up.link_chars += node.link_chars
            up.link_tags += node.link_tags
    body = nodes[0]
    linked = body.link_chars / max(body.chars, 1)
    for node in nodes:
        if node.dropped or not node.chars:
            continue
        c, t = node.chars, max(node.tags, 1)
        lc, lt = max(node.link_chars, 1), max(node.link_tags, 1)
        base = math.log(c / max(c - node.link_chars, 1) * lc + linked * c + math.e)
        node.density = c / t * math.log(max(c / lc * t / lt, 1.0)) / math.log(max(base, 1.0001)) if base > 1 else c / t
        if node.parent is not None:
            node.parent.total += node.density


def extract(page: str) -> str:
    """Main text of one page, a line per block."""
    for by_class in (True, False):  # a page whose outermost element has a boilerplate class is judged by tags alone
        nodes = parse(page, by_class)
        _measure(nodes)
        kept = [n for n in nodes if not n.dropped and n.chars]
        if kept:
            break
    else:
        return ""
    best = max((n for n in kept if n.tag in HOLDERS), key=lambda n: n.total)  # the first of equal sums
    path, node = [], best
    while node is not None:
        path.append(node)
        node = node.parent
    threshold = min(n.density for n in path)
    chosen, above = {id(best)}, {id(n): n for n in path[1:]}
    for n in kept:  # text beside the path that is as dense as the path, and the headings of its article
        if n.parent is not None and id(n.parent) in above and id(n) not in above and n is not best:
            dense = n.density >= threshold and n.link_chars * 3 <= n.chars
            if dense or n.tag in HEADINGS and n.parent.in_article:
                chosen.add(id(n))
    blocks, inline = [], []

    def flush() -> None:
        text = " ".join(html.unescape("".join(inline)).split())
        if text:
            blocks.append(text)
        inline.clear()

    work = [(nodes[0], id(nodes[0]) in chosen)]
    while work:
        item, inside = work.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            if inside:
                inline.append(item)
        elif not item.dropped:
            inside = inside or id(item) in chosen
            block = item.tag in BLOCK
            if block:
                flush()
                work.append((None, False))
            work.extend((x, inside) for x in reversed(item.items))
    flush()
    return "\n".join(blocks)


def main_text(df: DataFrame, html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns, ``text`` (the main text, empty if none) and ``n_chars`` (its code points)."""

    def make() -> Callable[[list[str]], list[list]]:
        def compute(pages: list[str]) -> list[list]:
            texts = [extract(p) for p in pages]
            return [texts, [len(t) for t in texts]]

        return compute

    return map_text(df, html_col, keep if keep is not None else ["page_id", "url"], [field("text", STRING), field("n_chars", LONG)], make)
