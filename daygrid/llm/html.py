"""Main text of web pages by tree scoring.

A page is read into a tree as browsers read broken markup: paragraphs end where the next block begins, scripts and styles
are raw text, an unfinished tag at the end is dropped. Menus, headers, footers, sidebars, notices, adverts, forms and
comments are set aside by element, role and class. Every paragraph then has points for its length and commas, which it passes on:
all to its parent, half to the grandparent, less further up. A container's points are discounted by its share of linked
text. The best container is the article, together with siblings that score well enough; an article or
main element around it is taken whole. If no paragraph is long enough to score, that element, or the body, is the article.

Each page is one row of a narrow map over the table: no shuffle, and a lost task repeats only its own pages.

Nulls and edge cases: null and empty pages have an empty text; so has a page with nothing but what is set aside. Pages of
any length are read whole. Null urls and repeated rows pass through. Other columns are not looked at.
"""

from __future__ import annotations

import re
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from daygrid.llm.common import beside, table

# Elements by their role in HTML, and words by which page authors name what is not the article.
_RAW = frozenset("script style noscript template textarea title iframe xmp noembed noframes".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot "
    "th thead tr ul caption".split()
)
_ENDS_P = _BLOCK - frozenset("body html li dd dt td th tr tbody thead tfoot caption legend".split())
#: An open element on the left ends where one on the right begins, unless a boundary lies between.
_SIBLINGS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tr": (("tr",), ("table", "tbody", "thead", "tfoot")),
    "tbody": (("tbody", "thead", "tfoot"), ("table",)),
    "tfoot": (("tbody", "thead", "tfoot"), ("table",)),
}
_ASIDE = frozenset("nav header footer aside form button select menu dialog svg object audio video canvas map search".split())
_ROLES = re.compile(r"\brole\s*=\s*[\"']?(?:navigation|banner|contentinfo|complementary|search|form|alert|alertdialog|dialog|menu)\b", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_NAMES = re.compile(r"\b(?:class|id)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_NEVER = re.compile(
    r"(?<![a-z])(?:ads?|advert\w*|adsense|adslot|sponsor\w*|promo\w*|comments?|commentlist|respond|repl(?:y|ies)|disqus\w*|"
    r"cookies?|consent|gdpr|newsletter|subscri\w+|signup|popup|modal|overlay)(?![a-z])",
    re.I,
)
_COMMENT = re.compile(r"(?<![a-z])(?:comments?|commentlist|respond|repl(?:y|ies)|disqus\w*)(?![a-z])", re.I)
_RARELY = re.compile(
    r"(?<![a-z])(?:side-?bar|menu|nav\w*|breadcrumbs?|header|masthead|footer|banner|notice|alert|warning|widget|shar(?:e|ing)|social|"
    r"related|recommend\w*|paginat\w*|pager|toolbar|login|search|form|skip|tags?)(?![a-z])",
    re.I,
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>(?:[^>\"']+|\"[^\"]*\"|'[^']*')*))>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*\Z",
    re.S,
)
_PARAGRAPH = frozenset("p pre td blockquote li dd section div article main body center".split())
SHORTEST = 25


class _Node:
    __slots__ = ("tag", "parent", "out", "content", "own", "commas", "text", "linked", "score", "holds")

    def __init__(self, tag: str, parent: _Node | None, out: int):
        self.tag, self.parent, self.out = tag, parent, out
        self.content: list[_Node | str] = []
        self.own = self.commas = self.text = self.linked = 0
        self.score, self.holds = 0.0, 0


def _set_aside(tag: str, attributes: str, in_article: bool) -> int:
    """What an element says of itself.

    2: it is never part of an article; 1: only if it holds one, or its title; 5: only if it holds all of the page's articles;
    4: an article that is one only if the page has no other; 0: it may be.
    """
    if tag in ("html", "body"):
        return 0
    rare = tag in _ASIDE and not (tag == "header" and in_article)
    if attributes:
        if _HIDDEN.search(attributes):
            return 2
        names = " ".join("".join(found) for found in _NAMES.findall(attributes)).replace("_", "-")
        if names and tag != "main" and _NEVER.search(names):
            return 5 if tag != "article" else 2 if _COMMENT.search(names) else 4
        heading = tag in ("article", "main", "h1", "h2", "h3", "h4", "h5", "h6")
        rare = rare or bool(_ROLES.search(attributes)) or bool(names and not heading and _RARELY.search(names))
    return int(rare)


def _tree(page: str) -> list[_Node]:
    """All nodes in page order; the first is the root."""
    root = _Node("", None, 0)
    nodes, stack, at = [root], [root], 0

    def text(piece: str) -> None:
        if piece:
            stack[-1].content.append(unescape(piece) if "&" in piece else piece)

    def close(depth: int) -> None:
        del stack[depth:]

    def close_open(tags: tuple[str, ...], boundary: tuple[str, ...]) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in tags:
                return close(depth)
            if stack[depth].tag in boundary:
                return None

    while match := _TOKEN.search(page, at):
        text(page[at : match.start()])
        at = match.end()
        slash, tag, attributes = match.group(1, 2, 3) if match.group(2) else match.group(4, 5, 6)
        if not tag:
            continue
        tag = tag.lower()
        if slash:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    close(depth)
                    break
                if tag not in _BLOCK and stack[depth].tag in _BLOCK:
                    break
            continue
        if tag in _RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in _ENDS_P:
            close_open(("p",), ("table", "td", "th", "button", "object", "caption"))
        if tag in _SIBLINGS:
            close_open(*_SIBLINGS[tag])
        parent = stack[-1]
        in_article = any(n.tag in ("article", "main") for n in stack) if tag == "header" else False
        node = _Node(tag, parent, _set_aside(tag, attributes, in_article))
        parent.content.append(node)
        nodes.append(node)
        if tag not in _VOID and not attributes.endswith("/"):
            stack.append(node)
        elif tag not in _VOID and tag in _BLOCK:
            stack.append(node)  # in HTML the slash does not close such an element
    text(page[at:])
    return nodes


def _measure(nodes: list[_Node]) -> None:
    """Marks what is set aside and sums up text, linked text and points."""
    doubtful = [node for node in nodes if node.out == 4]
    alone = len(doubtful) == 1 and not any(node.tag == "article" and node.out == 0 for node in nodes)
    for node in doubtful:
        node.out = 0 if alone else 2
    articles = {id(node): int(node.tag in ("article", "main") and node.out == 0) for node in nodes}
    total = sum(articles.values())
    for node in reversed(nodes):
        if node.parent is not None:
            articles[id(node.parent)] += articles[id(node)]
    for node in nodes:
        if node.out == 5:
            node.out = 1 if total and articles[id(node)] == total else 2
    for node in reversed(nodes):
        holds = max(node.holds, {"article": 2, "main": 2, "h1": 1}.get(node.tag, 0) if node.out == 0 else 0)
        # Page headers have titles of their own, so a title alone does not make them the article's.
        stays = node.out == 0 or node.out == 1 and holds > (node.tag in ("nav", "header", "footer", "aside"))
        node.holds = holds if stays else 0
        if node.parent is not None and stays:
            node.parent.holds = max(node.parent.holds, holds)
    linked = {}
    for node in nodes:
        parent = node.parent
        inherited = parent is not None and parent.out == 3
        # 3: set aside. What may hold the article is not, if it does.
        node.out = 3 if inherited or node.out == 2 or node.out == 1 and not node.holds else 0
        linked[id(node)] = node.tag == "a" or (parent is not None and linked[id(parent)])
    for node in reversed(nodes):
        if node.out == 3:
            continue
        for piece in node.content:
            if isinstance(piece, str):
                length = len(" ".join(piece.split()))
                node.text += length
                node.own += length
                node.commas += piece.count(",") + piece.count("、") + piece.count("，") + piece.count("،")
                node.linked += length if linked[id(node)] else 0
            elif piece.out != 3:
                node.text += piece.text
                node.linked += piece.linked
                if piece.tag not in _BLOCK:
                    node.own += piece.own
                    node.commas += piece.commas
    for node in nodes:
        if node.out == 3 or node.tag not in _PARAGRAPH or node.own < SHORTEST:
            continue
        points = 1 + node.commas + min(node.own // 100, 3)
        above, level = node.parent, 0
        while above is not None:
            above.score += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            above, level = above.parent, level + 1
    for node in nodes:
        if node.score:
            node.score = (node.score + (5 if node.tag in ("article", "main") else 0)) * (1 - node.linked / max(node.text, 1))


def _article(nodes: list[_Node]) -> list[_Node]:
    """The nodes whose text is the article, in page order."""
    best = max(nodes, key=lambda n: n.score)  # of equal ones the first, which is the outer one
    if best.score <= 0:
        for tag in ("article", "main", "body"):
            for node in nodes:
                if node.tag == tag and node.out == 0:
                    return [node]
        return [nodes[0]] if not any(n.tag == "body" for n in nodes) else []
    for tag in ("article", "main"):
        around = best
        while around is not None and around.tag != tag:
            around = around.parent
        if around is not None:
            best = around
            break
    if best.parent is None:
        return [best]
    bar, kept = max(10.0, 0.2 * best.score), []
    for node in best.parent.content:
        if isinstance(node, str) or node.out == 3:
            continue
        density = node.linked / max(node.text, 1)
        paragraph = node.tag == "p" and (node.text > 80 and density < 0.25 or 0 < node.text <= 80 and density == 0)
        heading = node.tag in ("h1", "h2", "h3") and density < 0.5
        if node is best or node.score >= bar or paragraph or heading:
            kept.append(node)
    return kept


def main_text(page: str | None) -> str:
    """The article of a page: its blocks, one for each line."""
    if not page:
        return ""
    nodes = _tree(page)
    _measure(nodes)
    blocks: list[str] = []
    pieces: list[str] = []

    def end_block() -> None:
        block = " ".join("".join(pieces).split())
        pieces.clear()
        if block:
            blocks.append(block)

    for top in _article(nodes):
        # An explicit stack: pages may nest deeper than Python calls.
        todo: list[tuple[_Node, int]] = [(top, 0)]
        end_block()
        while todo:
            node, place = todo.pop()
            if place < len(node.content):
                todo.append((node, place + 1))
                piece = node.content[place]
                if isinstance(piece, str):
                    pieces.append(piece)
                elif piece.tag == "br":
                    before = place and node.content[place - 1]
                    end_block() if isinstance(before, _Node) and before.tag == "br" else pieces.append(" ")
                elif piece.out != 3:
                    if piece.tag in _BLOCK:
                        end_block()
                    todo.append((piece, 0))
            elif node.tag in _BLOCK:
                end_block()
        end_block()
    return "\n".join(blocks)


def extract(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep``, text and n_chars for every row of ``pages``."""

    def read(batch: pd.DataFrame) -> pd.DataFrame:
        texts = [main_text(page) for page in batch["_html"]]
        return pd.DataFrame({"text": texts, "n_chars": [len(t) for t in texts]})

    return beside(pages.select(*keep, pages[html].alias("_html")), keep, read, "text string, n_chars long")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
