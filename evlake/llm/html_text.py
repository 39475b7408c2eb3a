"""The main text of web pages, by tree scoring.

A page becomes a tree of its elements. What is no article by its kind goes first:
scripts, styles, menus, forms, page headers and footers, asides, adverts, notices and
reader comments, told by tag, role and class names. A name tells only as a whole
(``share-buttons``, not ``share-price``), and a text block inside an article goes only
for a name that no author gives to text. Every paragraph then earns points
for its length and its commas, which it passes to its ancestors, less the further up;
an ancestor's points are discounted by the share of its text that lies in links. The
container with the most points is the article, widened to the ``article`` or ``main``
element around it, or by its siblings that score well or read like its paragraphs.
Other ``article`` elements with a fair part of its text are parts of it.

The text is that of the container's blocks in page order, one line each, white space
in a block turned into single spaces; character references are decoded. Nothing is
capped, and markup may be broken in any way: what is never closed ends with what is
around it, an unclosed comment, script or style with the page. The time taken grows with
the page's length, however its elements nest.

Pages are read where they are, in batches; nothing is shuffled. Defined results: null
or empty html has an empty text; html without any element is one block; repeated rows
are reported each.
"""

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>
    |<(/?)([A-Za-z][A-Za-z0-9:-]*+)((?:[^<>"']++|"[^"]*+"|'[^']*+')*+)>
    |<(/?)([A-Za-z][A-Za-z0-9:-]*+)([^<>]*+)>""",
    re.S | re.X,
)
_MARKS = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_WORD = re.compile(r"[a-z]+")

# HTML's own element kinds.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style title textarea noscript iframe template svg object select".split())
#: Of these, those that take the rest of the page if they are not closed.
_RAW_TO_END = frozenset("script style title textarea".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q s samp small"
    " span strike strong sub sup time tt u var wbr"
    " math mi mn mo ms mtext mspace mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mtable mtr mtd"
    " mstyle mpadded mphantom menclose mfenced semantics".split()
)
_ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main"
    " nav ol p pre section table ul".split()
)
_ENDS_SAME = {"li": "ul ol menu", "dt": "dl", "dd": "dl", "tr": "table", "td": "tr table", "th": "tr table", "option": ""}
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

#: Elements that never belong to an article.
_NEVER = frozenset(
    "nav footer aside form button dialog menu head canvas audio video fieldset input option optgroup annotation".split()
)
#: Words of class, id or role that say so, and those that do only outside an article.
_BAD_WORDS = frozenset(
    "nav navbar navigation menu footer sidebar aside ad ads advert adverts advertisement advertising sponsor sponsored"
    " promo promotion banner cookie cookies consent gdpr notice popup modal overlay newsletter subscribe signup share"
    " sharing social related recommended comment comments disqus replies reply breadcrumb breadcrumbs pagination pager"
    " widget toolbar login search paywall complementary contentinfo hidden".split()
)
_BAD_OUTSIDE = frozenset("header masthead topbar".split())
#: Words that say nothing beside one of those.
_NEUTRAL = frozenset(
    "area bar block bottom box btn button buttons col column container content desktop div footer form global group icon"
    " icons inner items left link links list lists main message messages mobile outer page panel policy posts primary"
    " right row secondary section site stories sub text thread title top view wrap wrapper".split()
)
#: Blocks of text, and the words that no author gives to them.
_TEXT = frozenset("p pre blockquote li dt dd td th figcaption h1 h2 h3 h4 h5 h6".split())
_BAD_FOR_TEXT = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo cookie cookies consent gdpr newsletter"
    " subscribe signup disqus breadcrumb breadcrumbs pagination pager hidden comment comments".split()
)
#: The part of the article's text another ``article`` must have to belong to it.
ARTICLE_PART = 0.25
_COMMENT_WORDS = frozenset("comment comments reply replies".split())

#: A paragraph of fewer characters earns nothing, if any is longer.
LEAST_CHARACTERS = 25
LEVELS = 5
#: A list or box of links: so many links with so much of its text.
LINKS, LINK_SHARE = 3, 0.8


class _Node:
    __slots__ = ("tag", "parent", "kids", "words", "gone", "size", "commas", "linked", "links", "points", "article")

    def __init__(self, tag: str, parent: "_Node | None", words: frozenset, gone: bool):
        self.tag, self.parent, self.words, self.gone = tag, parent, words, gone
        self.kids: list = []
        self.size = self.commas = self.linked = self.links = 0
        self.points = 0.0
        self.article = tag in ("article", "main") or bool(parent and parent.article)

    def article_in(self, other: "_Node") -> bool:
        """Whether this node lies inside the other."""
        up = self
        while up is not None and up is not other:
            up = up.parent
        return up is other


def _marks(rest: str) -> tuple[frozenset, bool]:
    """An element's class, id and role names, each as its words; whether it is not shown."""
    names, unseen = set(), False
    for m in _MARKS.finditer(rest):
        name, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            unseen = True
        elif name == "style":
            unseen = unseen or "display:none" in value.replace(" ", "")
        else:
            names.update(words for words in (tuple(_WORD.findall(n)) for n in value.split()) if words)
    return frozenset(names), unseen


def _says(names: frozenset, bad: frozenset) -> bool:
    """Whether a name as a whole is of the bad kind: a word of it is, and no other says
    anything else."""
    for words in names:
        told = [w for w in words if w in bad]
        if told and all(w in bad or w in _BAD_WORDS or w in _NEUTRAL for w in words):
            return True
    return False


def _is_gone(tag: str, names: frozenset, unseen: bool, parent: _Node) -> bool:
    if tag in ("html", "body", "main"):
        return False
    if unseen or tag in _NEVER:
        return True
    if tag == "article":
        return _says(names, _COMMENT_WORDS)
    if parent.article:
        return _says(names, _BAD_FOR_TEXT if tag in _TEXT else _BAD_WORDS)
    return tag == "header" or _says(names, _BAD_WORDS) or _says(names, _BAD_OUTSIDE)


class _Open:
    """The open elements, with the places of each kind, so that ending one takes no walk."""

    def __init__(self, root: _Node):
        self.stack = [root]
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def push(self, node: _Node) -> None:
        at = len(self.stack)
        self.places.setdefault(node.tag, []).append(at)
        if node.tag not in _INLINE:
            self.blocks.append(at)
        self.stack.append(node)

    def _last(self, tag: str) -> int:
        at = self.places.get(tag)
        return at[-1] if at else 0

    def _cut(self, at: int) -> None:
        while len(self.stack) > at:
            node = self.stack.pop()
            self.places[node.tag].pop()
            if node.tag not in _INLINE:
                self.blocks.pop()

    def end(self, tag: str, stop: frozenset) -> None:
        """An open element of the kind ends here, unless one of ``stop`` lies between."""
        at = self._last(tag)
        if at and all(self._last(s) < at for s in stop):
            self._cut(at)

    def close(self, tag: str) -> None:
        at = self._last(tag)
        # A stray end of an inline element closes no block.
        if at and not (tag in _INLINE and self.blocks and self.blocks[-1] > at):
            self._cut(at)


def _tree(page: str) -> list[_Node]:
    """All nodes, parents before their children."""
    root = _Node("#page", None, frozenset(), False)
    nodes, open_, at = [root], _Open(root), 0
    # No markup ends behind the last of these, so none is looked for.
    n = page.rfind(">") + 1
    unclosed: set[str] = set()
    while True:
        m = _TOKEN.search(page, at, n) if at < n else None
        text = page[at : m.start()] if m else page[at:]
        if text:
            open_.stack[-1].kids.append(html.unescape(text) if "&" in text else text)
        if not m:
            break
        at = m.end()
        if m[0].startswith("<!--") and not m[0].endswith("-->"):
            break
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            open_.close(tag)
            continue
        if tag in _RAW:
            end = None if tag in unclosed else re.compile(rf"</{re.escape(tag)}[^>]*>", re.I).search(page, at)
            if end:
                at = end.end()
            elif tag in _RAW_TO_END:
                break
            else:
                unclosed.add(tag)
            continue
        if tag == "br":
            open_.stack[-1].kids.append(" ")
            continue
        if tag in _ENDS_P:
            for kind in ("p", "option", "optgroup"):
                open_.end(kind, _ENDS_SAME_STOP)
        if tag in _ENDS_SAME:
            open_.end(tag, frozenset(_ENDS_SAME[tag].split()))
        rest = m[3] or m[6] or ""
        names, unseen = _marks(rest) if rest.strip(" /\n\t\r") else (frozenset(), False)
        parent = open_.stack[-1]
        node = _Node(tag, parent, names, parent.gone or _is_gone(tag, names, unseen, parent))
        parent.kids.append(node)
        nodes.append(node)
        if tag not in _VOID and not rest.endswith("/") or tag not in _VOID and tag not in _INLINE:
            open_.push(node)
    return nodes


_ENDS_SAME_STOP = frozenset(("table", "td", "th", "button"))


def _score(nodes: list[_Node]) -> None:
    """Sizes of every node, then the points paragraphs pass upwards."""
    own = {}
    for node in nodes:
        if node.gone:
            continue
        texts = [k for k in node.kids if type(k) is str]
        node.size = sum(len(t.strip()) for t in texts)
        node.commas = sum(t.count(",") + t.count("，") for t in texts)
        own[node] = node.size
    for node in reversed(nodes):
        if node.gone or not node.parent:
            continue
        if node.tag == "a":
            node.linked, node.links = node.size, 1
        up = node.parent
        up.size += node.size
        up.commas += node.commas
        up.linked += node.linked
        up.links += node.links
        if node.tag in _INLINE and own.get(node):
            own[up] = own.get(up, 0) + own[node]
    paragraphs = [x for x in nodes if not x.gone and x.tag not in _INLINE and own.get(x)]
    long = [x for x in paragraphs if x.size >= LEAST_CHARACTERS]
    for node in long or paragraphs:
        points = 1 + node.commas + min(node.size // 100, 3)
        # Text that stands in a container itself counts for the container.
        up, level = (node, 0) if node.tag not in ("p", "pre", "blockquote", "li", "td", "dd", *_HEADINGS) else (node.parent, 0)
        while up is not None and level < LEVELS:
            up.points += points / (1, 2, 6, 9, 12)[level]
            up, level = up.parent, level + 1


def _density(node: _Node) -> float:
    return node.linked / node.size if node.size else 0.0


def _chosen(nodes: list[_Node]) -> list[_Node]:
    """The container and the siblings that belong to it, in page order."""
    _score(nodes)
    open_ = [x for x in nodes if not x.gone and x.size]
    if not open_:
        return []
    worth = {x: x.points * (1 - _density(x)) for x in open_}
    best = max(open_, key=lambda x: worth[x])
    around = best
    while around is not None and around.tag not in ("article", "main"):
        around = around.parent
    if around is not None:
        return [x for x in open_ if x is around or _is_part(x, around)]
    if best.parent is None or best.tag in ("body", "html"):
        return [best]
    limit, kept = max(10.0, worth[best] / 5), []
    for x in best.parent.kids:
        if type(x) is str or x.gone or not x.size:
            continue
        dense = _density(x)
        alike = bool(x.words) and x.words == best.words and worth[x] >= worth[best] / 10
        reads = x.tag == "p" and (dense < 0.25 if x.size > 80 else dense == 0)
        if x is best or worth[x] >= limit or alike or reads or (x.tag in _HEADINGS and dense < 0.5):
            kept.append(x)
    return kept


def _is_part(node: _Node, chosen: _Node) -> bool:
    """Whether an ``article`` beside the chosen element is a part of the same text."""
    if node.tag != "article" or node.parent.article or node.size < ARTICLE_PART * chosen.size:
        return False
    return not chosen.article_in(node) and _density(node) < 0.5


def main_text(page: str) -> str:
    """The article's blocks, one line each."""
    blocks: list[str] = []
    for top in _chosen(_tree(page)):
        line: list[str] = []

        def flush(line=line):
            block = " ".join("".join(line).split())
            if block:
                blocks.append(block)
            line.clear()

        # A node, or the end of a block.
        todo: list = [top]
        while todo:
            x = todo.pop()
            if type(x) is str:
                line.append(x)
            elif x is None:
                flush()
            elif not x.gone and not (x is not top and x.links >= LINKS and x.tag not in _INLINE and _density(x) >= LINK_SHARE):
                if x.tag not in _INLINE:
                    flush()
                    todo.append(None)
                todo.extend(reversed(x.kids))
        flush()
    return "\n".join(blocks)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page.as_py() or "") for page in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"),
                batch.column("url"),
                pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64()),
            ],
            ["page_id", "url", "text", "n_chars"],
        )


def extracted(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """A row per row of ``pages``: page_id, url, its main text and the text's code points."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col(html_column).alias("html")
    )
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
