"""Main text of HTML pages by tree scoring.

A page is read once into a tree of its block elements. Each paragraph gives points for its length and
its commas to its ancestors, all to the parent, half to the next, and less further up; a container's
points are discounted by the share of its text that is in links. The best container is kept with
all of the article (else main, or box named so) around it, so that headings, short paragraphs, lists and quotes
beside it stay, and with those of its siblings that score well or are long paragraphs with few links. Before that, elements that
never hold an article (menus, page headers and footers, sidebars, forms, scripts and the like, by tag, role
or by the words of their class and id) are left out, and inside what is kept, lists and boxes that are
mostly links. A class that names content (``post``, ``content``) outweighs unlikely ones beside it, and names
that speak of a part or a style (``with-sidebar``, ``overflow-hidden``) leave nothing out. A page of which words
and forms have left out far more than is found is read again without those words.

Blocks are joined in page order by one line feed; white space inside a block is one space, and so is a
line break, while two in a row end the block. Character references are decoded.

Scale: pages are independent; one pass without a shuffle. A page is read in time linear in its length, at
most three times.

Defined cases: a null or empty html, or one without text, has an empty text. Tags left open or closed out
of order are closed where the next block begins, or at the end; a comment or script left open runs to the
end of the page. If nothing earns points, the article, main or body element is taken. Repeated rows are
read each; an empty table gives no rows; other columns are left aside.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailtide.llm.texts import slices

# Names of HTML elements, and words that mark what is not the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe xmp noembed noframes svg math".split())
NEVER = frozenset(
    "script style title textarea noscript template iframe xmp noembed noframes svg math head nav footer"
    " aside button select option label menu dialog object canvas audio video map datalist".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q ruby rp rt s samp small"
    " span strike strong sub sup time tt u var".split()
)
PARAGRAPHS = frozenset("p pre blockquote td li dd div section article main".split())
CLOSED_BY_BLOCK = frozenset("p h1 h2 h3 h4 h5 h6".split())
CLOSED_BY_OWN = {
    "li": ("li", ("ul", "ol", "menu")),
    "dt": ("dt dd", ("dl",)),
    "dd": ("dt dd", ("dl",)),
    "tr": ("tr td th", ("table",)),
    "td": ("td th", ("tr", "table")),
    "th": ("td th", ("tr", "table")),
    "option": ("option", ("select",)),
}
UNLIKELY = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments"
    " commentlist consent cookie cookies disqus disclaimer footer footnav gdpr header hidden login masthead"
    " menu meta modal nav navbar navigation newsletter notice notification overlay pager pagination paywall"
    " popup promo promoted promotion rail recommend recommended related remark replies respond rss share"
    " sharing shoutbox sidebar sidenav signup skip skyscraper social sponsor sponsored subscribe survey tags"
    " teaser toc toolbar tooltip topbar widget widgets".split()
)
UNLIKELY_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog menu menubar alert form".split()
)
#: Links of fewer characters on average are a menu, also inside an article; longer ones are its references.
MENU_CHARS = 20
#: Those that stay unlikely when a page is read again, as they are seldom a wrapper of the article.
FIRM = UNLIKELY - frozenset("header meta modal notice overlay paywall share skip tags widget widgets".split())
LIKELY = frozenset("article body content entry hentry main page post story text blog".split())
#: A class or id of such words alone outweighs unlikely ones beside it, if they are not firm or tell the layout.
_CONTENT = frozenset("article content entry hentry main post story".split())
_ARTICLE = frozenset("article entry hentry post story".split())
_LAYOUT = frozenset("banner menu nav sidebar".split())
#: Before an unlikely word: the element has or lacks such a part, and is not one.
_HAVING = frozenset("has have having hide no non not show with without".split())
_HIDING = frozenset("is js u visually".split())
_WRAPS = frozenset("form fieldset".split())
TAG_POINTS = {"article": 10, "main": 8, "div": 5, "section": 5, "pre": 3, "td": 3, "blockquote": 3}
TAG_POINTS |= {"ul": -3, "ol": -3, "dl": -3, "address": -3, "th": -5}

#: A paragraph of fewer characters earns nothing.
LEAST_CHARS = 25
#: A page is read again if what is left out has so many characters, or if less than ``NEARLY_NOTHING`` is found.
ARTICLE_CHARS = 200
NEARLY_NOTHING = 50

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)[^>]*(?:>|\Z)",
    re.S,
)
_ATTRS = re.compile(r"([^\s\"'>/=]++)(?:\s*+=\s*+(\"[^\"]*\"|'[^']*'|[^\s>]++))?")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class _Node:
    __slots__ = ("tag", "parent", "dropped", "soft", "points", "article", "chars", "linked", "inline", "blocks")

    def __init__(
        self, tag: str, parent: int, dropped: bool, soft: bool, points: float, inline: bool, article: bool = False
    ):
        self.tag, self.parent, self.dropped, self.soft, self.points = tag, parent, dropped, soft, points
        self.inline, self.article, self.chars, self.linked, self.blocks = inline, article, 0, 0, 0


def _unlikely(name: str, words: list[str]) -> frozenset[str]:
    """The words of one class or id that say that an element is not the article's."""
    found = UNLIKELY.intersection(words)
    if not found or _HAVING.intersection(words[:-1]):
        return frozenset()
    if "hidden" in found and (":" in name or not _HIDING.issuperset(w for w in words if w != "hidden")):
        found -= {"hidden"}  # overflow-hidden, hidden-print, md:hidden
    if found == {"header"} and LIKELY.intersection(words) - {"page", "main", "body"}:
        return frozenset()  # entry-header: the article's own
    return found


def _marks(tag: str, attrs: str) -> tuple[bool, frozenset[str], int, bool]:
    """Whether an element is hidden or has another role, its unlikely words, its points, and if it is named an article."""
    unlikely: frozenset[str] = frozenset()
    likely = whole = article = False
    for name, value in _ATTRS.findall(attrs):
        name, value = name.lower(), value.strip("\"'")
        if name == "role" and value.lower() in UNLIKELY_ROLES:
            if value.lower() != "form":
                return True, unlikely, 0, False
            unlikely |= {"form"}
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True, unlikely, 0, False
        if name == "style" and _HIDDEN_STYLE.search(value):
            return True, unlikely, 0, False
        if name in ("class", "id"):
            for one in value.split():
                words = [w.lower() for w in _WORDS.findall(one)]
                unlikely |= _unlikely(one, words)
                likely = likely or not LIKELY.isdisjoint(words)
                whole = whole or bool(words) and _CONTENT.issuperset(words)
                article = article or bool(words) and _ARTICLE.issuperset(words)
    if tag in ("html", "body", "article", "main"):
        unlikely &= {"form"}
    elif whole:
        unlikely &= FIRM - _LAYOUT | {"form"}
    return False, unlikely, 25 * likely, article


class _Page:
    """The tree of a page, and its blocks of text as (node, text, characters in links).

    ``left_out`` are the unlikely words that leave an element out; without ``form`` forms are kept.
    """

    def __init__(self, page: str, left_out: frozenset[str] = UNLIKELY | {"form"}):
        self.left_out = left_out
        self.lost = 0  # characters outside of links that are left out by words or as a form
        self.nodes = [_Node("", -1, False, False, 0, False)]
        self.blocks: list[tuple[int, str, int]] = []
        self.stack = [0]
        self.parts: list[str] = []
        self.links: list[str] = []
        self.in_link = False
        self.breaks = 0
        at, end = 0, len(page)
        while at < end:
            found = _TOKEN.search(page, at)
            if not found:
                self._text(page[at:])
                break
            if found.start() > at:
                self._text(page[at : found.start()])
            at = found.end()
            tag = found["tag"] or found["tag2"]
            if tag:
                tag = tag.lower()
                if found["end"] or found["end2"]:
                    self._close(tag)
                else:
                    attrs = found["attrs"] or ""
                    self._open(tag, attrs)
                    if tag in RAW and attrs.endswith("/"):
                        self._close(tag)
                    elif tag in RAW:
                        stop = re.compile(f"</{tag}", re.I).search(page, at)
                        at = stop.start() if stop else end
        self._flush()

    def _text(self, text: str) -> None:
        own = self.nodes[self.stack[-1]]
        if own.dropped:
            if own.soft and not self.in_link:
                self.lost += len(text.strip())
            return
        if "&" in text:
            text = references.unescape(text)
        if self.breaks:
            if not text.strip():
                return
            self.breaks = 0
        self.parts.append(text)
        if self.in_link:
            self.links.append(text)

    def _flush(self) -> None:
        """End the block of text that is being read."""
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                node = self.stack[-1]
                while self.nodes[node].inline:
                    node = self.nodes[node].parent
                self.blocks.append((node, text, len(" ".join("".join(self.links).split()))))
            self.parts, self.links = [], []
        self.breaks = 0

    def _open(self, tag: str, attrs: str) -> None:
        if tag == "br":
            self.breaks += 1
            if self.breaks > 1:
                self._flush()
            else:
                self.parts.append(" ")
            return
        if tag in VOID:
            if tag == "hr":
                self._flush()
            return
        inline = tag in INLINE
        if tag == "a":
            self.in_link = True
        if inline and "=" not in attrs and "hidden" not in attrs:
            return
        parent = self.stack[-1]
        hidden, words, points, article = _marks(tag, attrs) if attrs else (False, frozenset(), 0, False)
        if tag in _WRAPS:
            words |= {"form"}
        # words that may name a wrapper, such as tags, say little of a part of a paragraph
        unlikely = not (self.left_out & FIRM if inline else self.left_out).isdisjoint(words)
        if inline and not unlikely and not hidden:
            return
        if not inline:
            self._flush()
            self.in_link = False
            self._imply(tag)
            parent = self.stack[-1]
        up = self.nodes[parent]
        never = hidden or tag in NEVER or (tag == "header" and not self._within(("article", "main")))
        soft = not never and (up.soft or not up.dropped and unlikely)
        dropped = up.dropped or never or unlikely
        self.nodes.append(_Node(tag, parent, dropped, soft, points + TAG_POINTS.get(tag, 0), inline, article))
        self.stack.append(len(self.nodes) - 1)

    def _within(self, tags: tuple[str, ...]) -> bool:
        return any(self.nodes[n].tag in tags for n in self.stack)

    def _imply(self, tag: str) -> None:
        """Close what the start of a block closes."""
        while len(self.stack) > 1 and (
            self.nodes[self.stack[-1]].tag in CLOSED_BY_BLOCK or self.nodes[self.stack[-1]].inline
        ):
            self.stack.pop()
        if tag in CLOSED_BY_OWN:
            closed, bounds = CLOSED_BY_OWN[tag]
            for place in range(len(self.stack) - 1, 0, -1):
                name = self.nodes[self.stack[place]].tag
                if name in bounds:
                    break
                if name in closed.split():
                    del self.stack[place:]
                    break

    def _close(self, tag: str) -> None:
        if tag == "a":
            self.in_link = False
        if tag in VOID:
            if tag == "br":
                self._open("br", "")
            return
        if tag not in INLINE:
            self._flush()
            self.in_link = False
        for place in range(len(self.stack) - 1, 0, -1):
            node = self.nodes[self.stack[place]]
            if node.tag == tag:
                del self.stack[place:]
                return
            if tag in INLINE and not node.inline:
                return

    def _score(self) -> None:
        for node, text, linked in self.blocks:
            up = node
            while up >= 0:
                self.nodes[up].chars += len(text)
                self.nodes[up].linked += linked
                self.nodes[up].blocks += 1
                up = self.nodes[up].parent
            own = self.nodes[node]
            if len(text) < LEAST_CHARS or own.tag not in PARAGRAPHS:
                continue
            points = 1 + text.count(",") + min(len(text) / 100, 3)
            up, level = (own.parent if own.tag in ("p", "pre", "td", "li", "dd", "blockquote") else node), 0
            while up > 0 and level < 5:
                self.nodes[up].points += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
                up, level = self.nodes[up].parent, level + 1

    def _density(self, node: _Node) -> float:
        return node.linked / node.chars if node.chars else 0.0

    def main(self) -> list[str]:
        """The blocks of the article."""
        if not self.blocks:
            return []
        self._score()
        earned = {
            n: node.points * (1 - self._density(node))
            for n, node in enumerate(self.nodes)
            if n and node.chars
        }
        scored = self._scored_nodes()
        if scored:
            best = max(scored, key=lambda n: (earned.get(n, 0), -n))
        else:
            named = [n for n in earned if self.nodes[n].tag in ("article", "main")]
            best = max(named, key=lambda n: self.nodes[n].chars) if named else 0
        kept = {self._enclosing(best)} | self._siblings(best, earned)
        kept |= self._titles(best, kept)
        out = []
        for node, text, _ in self.blocks:
            up, inside, links, menu = node, False, False, False
            while up >= 0:
                own = self.nodes[up]
                if up in kept:
                    inside = True
                    links = menu if own.article or own.tag in ("article", "main") else links
                    break
                if own.tag in ("ul", "ol", "dl", "div", "section", "table") and self._density(own) > 0.5:
                    links = True
                    menu |= own.chars < MENU_CHARS * own.blocks
                up = own.parent
            if inside and not links or best == 0:
                out.append(text)
        return out

    def _scored_nodes(self) -> set[int]:
        """Ancestors to which some paragraph gave points."""
        found: set[int] = set()
        for node, text, _ in self.blocks:
            own = self.nodes[node]
            if len(text) >= LEAST_CHARS and own.tag in PARAGRAPHS:
                up = own.parent if own.tag in ("p", "pre", "td", "li", "dd", "blockquote") else node
                for _ in range(3):
                    if up > 0:
                        found.add(up)
                        up = self.nodes[up].parent
        return found

    def _enclosing(self, best: int) -> int:
        """The article around the best container, else the main part or a box named as an article, else itself.

        A part around several articles, or one that is mostly links, is not taken.
        """
        if self.nodes[best].tag in ("article", "main"):
            return best
        named, up = best, self.nodes[best].parent
        while up > 0 and self._density(self.nodes[up]) <= 0.5:
            own = self.nodes[up]
            if own.tag == "article":
                return up
            if own.tag == "main" or own.article and named == best:
                named = up
            if own.tag in ("main", "body"):
                break
            up = own.parent
        if named == best:
            return best
        inside, articles = {named}, 0
        for n in range(named + 1, len(self.nodes)):  # parents come before their children
            own = self.nodes[n]
            if own.parent in inside:
                inside.add(n)
                articles += own.tag == "article" and own.chars > 0
        return best if articles > 1 else named

    def _titles(self, best: int, kept: set[int]) -> set[int]:
        """The main headings above what is kept, if it has none of its own."""
        above, up = set(), best
        while up >= 0:
            above.add(up)
            up = self.nodes[up].parent
        found = set()
        for node, _, _ in self.blocks:
            own = self.nodes[node]
            if own.tag != "h1":
                continue
            up = node
            while up >= 0 and up not in kept:
                up = self.nodes[up].parent
            if up >= 0:
                return set()
            if own.parent in above and self._density(own) < 0.25:
                found.add(node)
        return found

    def _siblings(self, best: int, earned: dict[int, float]) -> set[int]:
        if best == 0:
            return set()
        least = max(10.0, 0.2 * earned.get(best, 0.0))
        found = set()
        for n, score in earned.items():
            node = self.nodes[n]
            if n == best or node.parent != self.nodes[best].parent or node.dropped:
                continue
            density = self._density(node)
            if score >= least and density < 0.5 or node.tag == "p" and node.chars > 80 and density < 0.25:
                found.add(n)
        return found


def main_text(page: str | None) -> str:
    """The article of a page, a line per block.

    If words of class and id, or forms, have left out far more than is found, the page is read again without
    the words that may name a wrapper; and without any, if nearly nothing is found still.
    """
    if not page:
        return ""
    read = _Page(page)
    text = "\n".join(read.main())
    if read.lost >= max(ARTICLE_CHARS if text else LEAST_CHARS, 2 * len(text)):
        again = "\n".join(_Page(page, FIRM).main())
        if len(again) > max(ARTICLE_CHARS if text else 0, 2 * len(text)):
            text = again
    if len(text) < NEARLY_NOTHING and read.lost >= ARTICLE_CHARS:
        again = "\n".join(_Page(page, frozenset()).main())
        text = again if len(again) >= ARTICLE_CHARS else text
    return text


def extract(pages: DataFrame) -> DataFrame:
    """Per page: ``page_id, url, text, n_chars``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                texts = [main_text(page) for page in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("page_id"),
                        part.column("url"),
                        pa.array(texts, pa.string()),
                        pa.array([len(t) for t in texts], pa.int64()),
                    ],
                    ["page_id", "url", "text", "n_chars"],
                )

    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    return rows.mapInArrow(read, "page_id long, url string, text string, n_chars long")
