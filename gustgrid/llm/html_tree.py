"""Main text of web pages by tree scoring.

A page becomes a tree of elements (unclosed paragraphs and list items are closed as browsers do).
Each paragraph-like element gives points for its length and its commas to its parent, half of them to
the next ancestor, a quarter to the next, and so on to the root; an element's sum is discounted by its
link density. The best container is widened to the outermost element in which other parts hold
paragraphs like its own, then to the article around it and the main element around that, and kept with
those siblings that score near it. Menus, headers, footers, sidebars, notices, adverts, forms, reader
comments, scripts and styles are left out by tag, role, class or id. A class, role or id counts if all
of one of its words say so ("comment-list", not "related-work"); headings never count, nor ids of
sections in an article; words that articles use themselves (discussion, notice, related) count there
only for elements of mostly links. Work is per page, in the tasks that read it.
"""

from __future__ import annotations

import heapq
import html
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg math object noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html "
    "li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
DROPPED = frozenset("nav header footer aside form menu button select option dialog head label fieldset".split())
PARAGRAPH = frozenset("p td pre blockquote dd li figcaption".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
# Opening one of these ends an open element of the group, up to the nearest barrier.
CLOSES = {"li": ("li", {"ul", "ol", "menu"}), "dt": ("dd dt", {"dl"}), "dd": ("dd dt", {"dl"}), "tr": ("tr td th", {"table"}), "td": ("td th", {"tr", "table"}),
          "th": ("td th", {"tr", "table"}), "option": ("option", {"select"})}
CONTAINER_BONUS = {"article": 10.0, "main": 6.0, "section": 1.0, "div": 1.0}
# Words of parts beside the text, wherever they stand.
STRONG = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo cookie cookies consent gdpr menu nav navbar navigation breadcrumb breadcrumbs sidebar footer masthead "
    "comment comments commentlist respond disqus share sharing social recommended subscribe newsletter popup modal pagination complementary contentinfo topbar".split())
# Words that an article may use for its own parts.
WEAK = frozenset(
    "promotion banner notice alert disclaimer header discussion replies related overlay login signin signup search toolbar pager widget skip".split())
# Words that may stand beside these in one name.
NEUTRAL = frozenset(
    "site page main global top bottom left right inner outer box container wrapper wrap holder area block section bar bars panel list items item links link buttons icons slot unit "
    "content body text form thread author meta count title row col column primary secondary wp js is fixed sticky big small".split())
# "with-sidebar" and "no-comments" name the element around such parts.
AROUND = re.compile(r"(?<![^\s])(?:with|without|has|no)[-_]\S*")
# Besides paragraphs, these may hold text directly.
OWN_TEXT = frozenset("div section article main body".split())
SIBLING_SHARE = 0.2
# A main heading names the container of the text, however short the text is.
TITLE_BONUS = 5.0
# Shares below this are lost in rounding.
LEAST_SHARE = 1e-9


class Node:
    __slots__ = ("tag", "parent", "children", "hint", "id_hint", "length", "links", "commas", "score", "points", "paragraphs")

    def __init__(self, tag: str, parent: "Node | None", hint: int = 0, id_hint: int = 0):
        self.tag, self.parent, self.hint, self.id_hint = tag, parent, hint, id_hint
        self.children: list["Node | str"] = []
        self.length = self.links = self.commas = 0
        self.score = 0.0
        # Of the paragraphs in the whole element.
        self.points, self.paragraphs = 0.0, 0


def _level(value: str) -> int:
    """0: no name of the value is of a part beside the text, 1: by a weak word, 2: by a strong one."""
    level = 0
    for name in AROUND.sub(" ", value).split():
        words = [w for w in re.split(r"[^a-z]+", name) if w]
        if words and all(w in STRONG or w in WEAK or w in NEUTRAL for w in words):
            level = max(level, 2 if not STRONG.isdisjoint(words) else 1 if not WEAK.isdisjoint(words) else 0)
    return level


def _hints(attributes: str) -> tuple[int, int]:
    """Levels of the class or role, and of the id; 3 if the element is hidden."""
    level, id_level = 0, 0
    for name, *values in ATTRIBUTE.findall(attributes):
        value = "".join(values).lower()
        name = name.lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            return 3, 0
        if name in ("class", "role"):
            level = max(level, _level(value))
        elif name == "id":
            id_level = max(id_level, _level(value))
    return level, id_level


def _beside(node: Node, inside: bool) -> bool:
    """Whether an element's names say that it is no part of the text; ``inside`` an article or main element weak words need links."""
    if node.hint == 3 or node.tag in ("html", "body", "main", "article") or node.tag in HEADING:
        return node.hint == 3
    level = max(node.hint, 0 if inside and node.tag == "section" else node.id_hint)
    return level == 2 or level == 1 and (not inside or 2 * node.links >= node.length > 0)


def parse(page: str) -> Node:
    """The element tree; text is unescaped. Raw-text elements and comments are gone."""
    root = Node("#root", None)
    at, here, size = 0, root, len(page)
    while at < size:
        found = TOKEN.search(page, at)
        if not found:
            here.children.append(html.unescape(page[at:]))
            break
        if found.start() > at:
            here.children.append(html.unescape(page[at : found.start()]))
        at = found.end()
        tag = found[2]
        if not tag:
            continue
        tag = tag.lower()
        if found[1]:
            up = here
            while up is not root and up.tag != tag:
                # An inline end tag does not close blocks around it.
                up = root if tag not in BLOCK and up.tag in BLOCK else up.parent
            if up is not root:
                here = up.parent
            continue
        if tag in RAW:
            if not found[3].rstrip().endswith("/") or tag not in ("svg", "math"):
                close = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                at = close.end() if close else size
            continue
        if tag in BLOCK:
            # A block ends an open paragraph.
            up = here
            while up is not root and up.tag != "p" and up.tag not in ("td", "th", "table", "button", "object"):
                up = up.parent
            if up.tag == "p":
                here = up.parent
        if tag in CLOSES:
            ends, barrier = CLOSES[tag]
            up = here
            while up is not root and up.tag not in barrier:
                if up.tag in ends.split():
                    here = up.parent
                up = up.parent
        node = Node(tag, here, *(_hints(found[3]) if found[3] else ()))
        here.children.append(node)
        if tag not in VOID and not found[3].endswith("/"):
            here = node
        elif tag not in VOID and tag in BLOCK | {"span", "b", "i", "a", "em", "strong"}:
            here = node
    return root


def _order(root: Node) -> list[Node]:
    """All elements, each after its parent (no recursion: pages may nest deeply)."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(c for c in reversed(node.children) if isinstance(c, Node))
    return out


def _in_article(node: Node) -> bool:
    up = node.parent
    while up is not None and up.tag not in ("article", "main"):
        up = up.parent
    return up is not None


def _alive(nodes: list[Node]) -> list[Node]:
    """The elements not left out by tag or hint, each after its parent.

    A hint holds whatever the length of its element. Only while nothing outside hinted elements has text of
    its own, the longest of them that lies in no other is taken for a container with a misleading name.
    """
    alive: list[Node] = []
    waiting: list[tuple[int, int, Node]] = []
    seen = 0
    # What holds <main> is no part beside the text.
    around: set[int] = set()
    for node in nodes:
        up = node.parent if node.tag == "main" else None
        while up is not None and id(up) not in around:
            around.add(id(up))
            up = up.parent
    node, text = nodes[0], False
    while True:
        # Elements of this part with whether their text is one of paragraphs.
        todo = [(node, True, _in_article(node))]
        while todo:
            node, own, inside = todo.pop()
            inside = inside or node.tag in ("article", "main")
            if node.tag in BLOCK:
                own = node.tag in PARAGRAPH or node.tag in OWN_TEXT
            own = own and node.tag != "a"
            alive.append(node)
            text = text or own and any(isinstance(c, str) and c.strip() for c in node.children)
            for child in reversed(node.children):
                if isinstance(child, str) or child.tag in DROPPED:
                    continue
                if _beside(child, inside) and id(child) not in around:
                    seen += 1
                    heapq.heappush(waiting, (-child.length, seen, child))
                else:
                    todo.append((child, own, inside))
        if text or not waiting or not waiting[0][0]:
            break
        node = heapq.heappop(waiting)[-1]
    return alive


def main_text(page: str | None) -> str:
    """The blocks of the main text joined by newlines; empty if there is none."""
    if not page:
        return ""
    root = parse(page)
    nodes = _order(root)
    for node in reversed(nodes):
        for child in node.children:
            if isinstance(child, str):
                node.length += len(" ".join(child.split()))
                node.commas += child.count(",")
            else:
                node.length, node.commas = node.length + child.length, node.commas + child.commas
                node.links += child.length if child.tag == "a" else child.links
    alive = _alive(nodes)
    live = {id(n) for n in alive}
    dropped = {id(n) for n in nodes if id(n) not in live}

    for node in reversed(alive):
        own = any(isinstance(c, str) and c.strip() for c in node.children)
        blocks = any(isinstance(c, Node) and c.tag in BLOCK for c in node.children)
        if node.tag in PARAGRAPH and not blocks or node.tag in OWN_TEXT and own or node.tag in PARAGRAPH and own:
            density = node.links / node.length if node.length else 0.0
            points = (min(node.length / 25.0, 1.0) + node.commas + min(node.length / 100.0, 3.0)) * (1.0 - density)
            above = node.parent if node.tag in PARAGRAPH else node
            share = 1.0
            while above is not None and share > LEAST_SHARE:
                above.score += points * share
                above, share = above.parent, share / 2
            if points > node.points:
                # A text with blocks in it counts once.
                node.points, node.paragraphs = points, 1
        if node.tag == "h1" and node.parent is not None:
            node.parent.score += TITLE_BONUS
        if node.parent is not None:
            node.parent.points += node.points
            node.parent.paragraphs += node.paragraphs
    best, top = None, 0.0
    for node in alive:
        if node.score > 0 and node.tag not in ("#root", "html"):
            density = node.links / node.length if node.length else 0.0
            final = (node.score + CONTAINER_BONUS.get(node.tag, 0.0)) * (1.0 - density)
            if final > top:
                best, top = node, final
    if best is None:
        best = next((n for n in alive if n.tag in ("article", "main", "body")), root)
    article = best
    while article is not None and article.tag not in ("article", "main"):
        article = article.parent
    path = [] if article is not None else _widened(best, dropped)
    if path:
        dropped |= _link_lists(path, dropped)
    main = article
    while main is not None and main.tag != "main":
        main = main.parent
    best = main or article or (path or [best])[-1]

    kept = [best]
    if best.parent is not None and best.tag not in ("article", "main", "body", "#root"):
        kept = []
        for sibling in best.parent.children:
            if sibling is best:
                kept.append(sibling)
            elif isinstance(sibling, Node) and id(sibling) not in dropped and sibling.length:
                density = sibling.links / sibling.length
                if not path and sibling.score >= SIBLING_SHARE * best.score and density < 0.5 or sibling.tag in PARAGRAPH | HEADING and density < 0.25:
                    kept.append(sibling)
    elif best.tag == "article" and best.parent is not None:
        # Parts of one text in several articles.
        kept = [s for s in best.parent.children if s is best or isinstance(s, Node) and s.tag == "article" and id(s) not in dropped and s.score >= SIBLING_SHARE * best.score]
    return "\n".join(_blocks(kept, dropped))


def _widened(best: Node, dropped: set[int]) -> list[Node]:
    """The elements from the best one to the outermost in which another part, no list of links, holds paragraphs like its own."""
    like = SIBLING_SHARE * best.points / max(best.paragraphs, 1)
    path, node, size = [best], best, 1
    while node.parent is not None:
        up = node.parent
        path.append(up)
        if any(isinstance(c, Node) and c is not node and id(c) not in dropped and c.points > 0 and 2 * c.links < c.length and c.points >= like for c in up.children):
            size = len(path)
        node = up
    return path[:size] if size > 1 else []


def _link_lists(path: list[Node], dropped: set[int]) -> set[int]:
    """Containers of mostly links beside the path of a widened element."""
    lists = set()
    todo = [c for node, inner in zip(path[1:], path) for c in node.children if c is not inner]
    while todo:
        node = todo.pop()
        if isinstance(node, str) or id(node) in dropped:
            continue
        if node.tag in BLOCK and node.tag not in PARAGRAPH | HEADING and node.length and 2 * node.links >= node.length:
            lists.add(id(node))
        else:
            todo.extend(node.children)
    return lists


def _blocks(kept: list[Node], dropped: set[int]) -> list[str]:
    blocks, line = [], []

    def end() -> None:
        text = " ".join("".join(line).split())
        if text:
            blocks.append(text)
        line.clear()

    for top in kept:
        todo: list = [(top, 0)]
        while todo:
            node, step = todo.pop()
            if isinstance(node, str):
                line.append(node)
                continue
            if step == 0 and node is not top and id(node) in dropped:
                line.append(" ")
                continue
            if node.tag in BLOCK:
                end()
            elif node.tag in ("br", "img"):
                line.append(" ")
            if step == 0:
                todo.append((node, 1))
                todo.extend((c, 0) for c in reversed(node.children))
        end()
    return blocks


def _page_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(p) for p in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"])


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page row: ``id_col, url, text, n_chars`` (code points); null or empty html gives an empty text."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return rows.mapInArrow(_page_batches, f"id {kinds['id']}, url {kinds['url']}, text string, n_chars long").withColumnRenamed("id", id_col)
