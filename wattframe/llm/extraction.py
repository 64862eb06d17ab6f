"""Main text of web pages by tree scoring.

Paragraphs give points for their length and commas to the elements around them, less the farther
up; an element's points are discounted by the share of its text that is links. The best element is
the article's container, and siblings that look like more of the same are kept with it.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattframe.llm.tables import in_slices

# Element names and class words of HTML pages.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe title xmp noembed noframes".split())
DROPPED = frozenset(
    "head script style noscript template nav footer aside form button select option textarea input"
    " iframe object embed svg canvas audio video map dialog menu title datalist fieldset xmp"
    " noembed noframes frameset math".split()
)
BLOCKS = frozenset(
    "address article blockquote body center dd details div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main nav ol p pre section summary table tbody"
    " tfoot thead tr ul caption aside search".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
PARAGRAPHS = frozenset("p pre blockquote td dd li".split())
CLOSES_P = BLOCKS - {"body", "html", "caption", "tbody", "tfoot", "thead", "tr", "legend"}
#: An opening element ends an open one of these names, if no element of the second set is between.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"}),
    "tfoot": ({"tr", "td", "th", "thead", "tbody"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
NOISE = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adbox adslot banner"
    " banners promo promos promotion sponsor sponsored sponsors nav navbar navigation navi menu menus"
    " submenu breadcrumb breadcrumbs pagination pager sidebar sidebars sidenav rail footer foot masthead"
    " topbar toolbar cookie cookies consent gdpr notice notices notification notifications popup modal"
    " overlay newsletter subscribe subscription signup login signin share sharing social comment"
    " comments commentlist discussion disqus reply replies respond related recommended recommendations"
    " widget widgets alert hidden outbrain taboola skip hint disclaimer".split()
)
#: Words that name noise only outside an article, where a page's own header would be.
PAGE_NOISE = frozenset("header head topnav brand logo".split())
#: Words that an article's own parts are named by too: inside one they are noise only as a whole name.
DOUBTFUL = frozenset("alert foot hidden hint notice notices rail related skip social".split())
#: Words that leave a class name a whole noise name: ``comment-list`` is one, ``has-sidebar`` is not.
PLAIN = frozenset("list area section box block posts articles stories items item form".split())
#: Beside these words ``comment`` says something about an article, not that it is one.
NO_COMMENT = frozenset("open closed status no has with".split())
NOISE_ROLES = frozenset(
    "navigation banner complementary contentinfo search dialog alertdialog alert form menu menubar"
    " toolbar status".split()
)
CONTENT = frozenset("article main".split())
#: Links of a menu within an article have fewer characters than this on average, without white space.
MENU_CHARS = 20
#: Kept beside the best container of a page without article.
BESIDE = frozenset("p pre blockquote ul ol dl table figure details address div section".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>"
    # A quote holds a value only behind an equals sign; elsewhere, as in <p it's>, it is a sign like others.
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*+)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORDS = re.compile(r"[a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_COMMAS = re.compile("[,，、،՝፣]")


class Element:
    """One element. ``parts`` holds text pieces and elements in page order.

    ``chars``, ``links`` and ``commas`` count what is not dropped below it, without white space.
    """

    __slots__ = ("name", "up", "parts", "points", "drop", "unsure", "content", "chars", "links", "commas")

    def __init__(self, name: str, up: Element | None, drop: bool = False, unsure: bool = False, content: bool = False):
        self.name, self.up, self.drop, self.unsure, self.content = name, up, drop, unsure, content
        self.parts: list = []
        self.points = 0.0
        self.chars = self.links = self.commas = 0


def _attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(source):
        found.setdefault(name.lower(), entities.unescape(double or single or bare))
    return found


def _noise(name: str, attrs: str, in_content: bool) -> tuple[bool, bool, bool]:
    """Whether an element is noise, whether only a part of a class name says so, whether it is content."""
    content = name in CONTENT
    if name in DROPPED or name == "header" and not in_content:
        return True, False, False
    if not attrs or name in ("html", "body") or name in HEADINGS:
        return False, False, content
    found = _attributes(attrs)
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true":
        return True, False, False
    if _UNSEEN.search(found.get("style", "")):
        return True, False, False
    role = found.get("role", "").lower()
    if role in NOISE_ROLES:
        return True, False, False
    if name == "main" or role in CONTENT:
        return False, False, True
    noise = NOISE if in_content or name == "article" else NOISE | PAGE_NOISE
    named = f"{found.get('class', '')} {found.get('id', '')}".split()
    names = [set(_WORDS.findall(_CAMEL.sub(" ", one).lower())) for one in named]
    names = [words for words in names if words & noise]
    whole = any(all(word in noise or word in PLAIN or word.isdigit() for word in words) for words in names)
    if name == "article":
        comment = any(words & {"comment", "reply"} and not words & NO_COMMENT for words in names)
        return (True, False, False) if whole or comment else (False, False, True)
    if in_content and not whole:
        # A part of a name drops no paragraph of an article, and a word that articles use drops nothing.
        if name in PARAGRAPHS or all(words & noise <= DOUBTFUL for words in names):
            return False, False, False
    return bool(names), not whole, False


def _settle(root: Element) -> None:
    """Keep what only a part of a class name calls noise if it holds an article or most of the paragraphs."""
    nodes: list[Element] = []
    todo = [root]
    while todo:
        node = todo.pop()
        nodes.append(node)
        todo.extend(p for p in node.parts if isinstance(p, Element) and (not p.drop or p.unsure))
    if not any(node.unsure and node.drop for node in nodes):
        return
    text: dict[int, int] = {}
    holds: dict[int, bool] = {}
    for node in reversed(nodes):
        inner = [p for p in node.parts if isinstance(p, Element) and id(p) in text]
        own = 0
        if node.name in PARAGRAPHS:
            own = sum(len("".join(p.split())) for p in node.parts if isinstance(p, str))
            own += sum(p.chars for p in inner if p.name not in BLOCKS)
        elif node.name not in BLOCKS:  # inline text counts for the paragraph around it
            node.chars = sum(len("".join(p.split())) for p in node.parts if isinstance(p, str))
            node.chars += sum(p.chars for p in inner)
        text[id(node)] = own + sum(text[id(p)] for p in inner)
        holds[id(node)] = node.content or any(holds[id(p)] for p in inner)
    for node in nodes:
        node.chars = 0
        if node.unsure and node.drop and (holds[id(node)] or 2 * text[id(node)] > text[id(root)]):
            node.drop = False


class _Open:
    """The open elements from the root down, and at which depths each name is among them."""

    def __init__(self, root: Element):
        self.stack = [root]
        self.depths: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.content = 0

    def push(self, node: Element) -> None:
        depth = len(self.stack)
        self.stack.append(node)
        self.depths.setdefault(node.name, []).append(depth)
        if node.name in BLOCKS:
            self.blocks.append(depth)
        self.content += node.name in CONTENT

    def close(self, depth: int) -> None:
        """Close what is open at this depth and below."""
        while len(self.stack) > depth:
            node = self.stack.pop()
            self.depths[node.name].pop()
            if node.name in BLOCKS:
                self.blocks.pop()
            self.content -= node.name in CONTENT

    def nearest(self, names) -> int:
        """Depth of the nearest open element of these names; 0 without one."""
        return max((self.depths[name][-1] for name in names if self.depths.get(name)), default=0)

    def end(self, names, until) -> None:
        """Close the nearest open element of these names, unless one of ``until`` is nearer."""
        depth = self.nearest(names)
        if depth > self.nearest(until):
            self.close(depth)


def parsed(source: str) -> Element:
    """The page as a tree. Dropped elements stay in it, marked, so that nesting is right."""
    root = Element("html", None)
    opened = _Open(root)
    stack = opened.stack
    at, end = 0, len(source)
    last = source.rfind(">")
    while at < end:
        mark = source.find("<", at)
        if mark < 0:
            stack[-1].parts.append(source[at:])
            break
        if mark > at:
            stack[-1].parts.append(source[at:mark])
        if last < mark and re.match(r"</?[a-zA-Z]", source[mark : mark + 3]):
            break  # a tag that the page's end cuts off
        token = _TOKEN.match(source, mark)
        if token is None:  # a bare sign
            stack[-1].parts.append("<")
            at = mark + 1
            continue
        at = token.end()
        name = (token["name"] or "").lower()
        if not name or name in ("html", "body") and token["close"]:
            continue
        if token["close"]:
            depth = opened.nearest((name,))
            if name not in BLOCKS and opened.blocks and opened.blocks[-1] > depth:
                depth = 0  # a stray inline end tag closes no block
            if depth:
                opened.close(depth)
            elif name == "p" or name == "br":
                stack[-1].parts.append(Element(name, stack[-1]))
            continue
        if name in CLOSES_P and name != "html":
            opened.end(("p",), ("td", "th", "button", "object", "table", "caption"))
        if name in HEADINGS and stack[-1].name in HEADINGS:
            opened.close(len(stack) - 1)
        if name in ENDS:
            for _ in range(3):
                opened.end(*ENDS[name])
        if name in ("html", "body") and len(stack) > 1:
            continue
        node = Element(name, stack[-1], *_noise(name, token["attrs"], opened.content > 0))
        stack[-1].parts.append(node)
        if name in RAW and not token["attrs"].endswith("/"):
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(source, at)
            at = close.end() if close else end
        elif name not in VOID and not (token["attrs"].endswith("/") and name not in BLOCKS):
            opened.push(node)
    _settle(root)
    return root


def _walk(root: Element) -> Iterator[Element]:
    todo = [root]
    while todo:
        node = todo.pop()
        yield node
        todo.extend(p for p in reversed(node.parts) if isinstance(p, Element) and not p.drop)


def _measure(root: Element) -> list[Element]:
    """All kept elements in page order, their counts summed from the leaves up."""
    nodes = list(_walk(root))
    for node in reversed(nodes):
        for part in node.parts:
            if isinstance(part, str):
                node.chars += len("".join(part.split()))
                node.commas += len(_COMMAS.findall(part))
            elif not part.drop:
                node.chars += part.chars
                node.links += part.links
                node.commas += part.commas
        if node.name == "a":
            node.links = node.chars
    return nodes


def _has_block(node: Element) -> bool:
    return any(isinstance(p, Element) and p.name in BLOCKS and not p.drop for p in node.parts)


def _score(root: Element) -> Element | None:
    """Hand out the paragraphs' points; the best element after the discount for links."""
    given: dict[int, Element] = {}
    for node in _measure(root):
        loose = node.name not in PARAGRAPHS and any(isinstance(p, str) and p.strip() for p in node.parts)
        own = node.name in PARAGRAPHS and not _has_block(node)
        if not own and not (loose and node.name in ("div", "section", "article", "main", "body", "html")):
            continue
        if own:
            chars, links, commas = node.chars, node.links, node.commas
        else:  # text that stands directly in a container counts for the container itself
            direct = "".join(p for p in node.parts if isinstance(p, str))
            chars, links, commas = len("".join(direct.split())), 0, len(_COMMAS.findall(direct))
        if not chars:
            continue
        points = (1 + commas + min(chars / 100, 3)) * (1 - links / chars)
        up, share = (node.up if own else node), 1.0
        while up is not None and share >= 0.2:
            up.points += points * share
            given[id(up)] = up
            up, share = up.up, share / 2
    best, most = None, 0.0
    for node in given.values():
        if node.name in ("ul", "ol", "dl", "table", "tbody", "tr", "thead", "blockquote") and node.up is not None:
            continue  # lists and tables are parts of an article, not articles
        value = node.points * (1 - node.links / node.chars if node.chars else 0)
        if value > most:
            best, most = node, value
    if best is not None:
        best.points = most
    return best


def _kept(best: Element) -> list:
    """The container, or the outermost article or ``main`` around it, with the siblings that belong to it.

    Beside an article only what looks like more of it is kept. Without one, so is everything of few
    links that stands beside the container, and all between the first and the last of that. Within a
    ``main``, other articles stay only if they look like more of the same too.
    """
    bar = max(3.0, 0.2 * best.points)
    up, content, above = best, False, set()
    while up is not None:
        above.add(id(up))
        if up.name in CONTENT:
            best, content = up, True
        up = up.up
    if best.name == "main":
        for node in _walk(best):
            if node.name == "article" and id(node) not in above and id(node.up) in above:
                node.drop = not node.chars or node.links > 0.25 * node.chars or node.points < bar
    if best.up is None:
        return [best]
    kept = []
    for at, part in enumerate(best.up.parts):
        if not isinstance(part, Element) or part.drop:
            continue
        if part is best:
            kept.append(at)
            continue
        if not part.chars or part.links > 0.25 * part.chars:
            continue
        if not content and part.name in BESIDE:
            kept.append(at)
        elif part.name in HEADINGS or part.name == "header":
            kept.append(at)
        elif part.name in PARAGRAPHS and (part.chars > 80 or part.commas):
            kept.append(at)
        elif part.name in ("div", "section", "article") and part.points >= bar:
            kept.append(at)
    if not content:
        kept = range(kept[0], kept[-1] + 1)
    return [best.up.parts[at] for at in kept]


def _is_menu(node: Element, in_content: bool, after: str) -> bool:
    """A list or box of links only.

    Within an article, paragraphs, tables and sections of links are its own (sources, say), and so is
    a list below a heading or one whose entries are longer than a menu's.
    """
    if node.name not in (("ul", "ol", "div") if in_content else ("ul", "ol", "div", "section", "table", "p")):
        return False
    if node.links <= 0.8 * node.chars:
        return False
    links = [child for child in _walk(node) if child.name == "a"]
    if len(links) < 3 or not in_content:
        return len(links) >= 3
    return after not in HEADINGS and node.links < MENU_CHARS * len(links)


def _blocks(node: Element, done: list[str], line: list[str]) -> None:
    """Append finished blocks to ``done``; ``line`` holds the pieces of the open one."""

    def finish() -> None:
        text = " ".join("".join(line).split())
        line.clear()
        if text:
            done.append(text)

    todo: list = [iter([node])]
    names: list[str] = [""]
    inside = 0  # open articles and the like
    after = [""]  # the element before, at each depth
    while todo:
        part = next(todo[-1], None)
        if part is None:
            todo.pop()
            after.pop()
            name = names.pop()
            inside -= name in CONTENT
            if name in BLOCKS:
                finish()
        elif isinstance(part, str):
            line.append(entities.unescape(part))
        elif part.drop or _is_menu(part, inside > 0, after[-1]):
            if part.name in BLOCKS:
                finish()
        else:
            if part.name in BLOCKS:
                finish()
            elif part.name in ("br", "td", "th"):
                line.append(" ")
            after[-1] = part.name
            todo.append(iter(part.parts))
            names.append(part.name)
            after.append("")
            inside += part.name in CONTENT


def main_text(source: str | None) -> str:
    """The article's blocks joined by line breaks; empty if the page has none."""
    if not source:
        return ""
    root = parsed(source)
    best = _score(root)
    if best is None:
        return ""
    done: list[str] = []
    whole = Element("body", None)
    for part in _kept(best):
        cell = isinstance(part, Element) and part.name in ("td", "th")  # cells of a layout end their line
        whole.parts += [Element("div", whole), part, Element("div", whole)] if cell else [part]
    _blocks(whole, done, [])
    return "\n".join(done)


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_slices(batches, 256):
        found = [main_text(source) for source in batch.column(2).to_pylist()]
        lengths = pa.array([len(text) for text in found], pa.int64())
        columns = [batch.column(0), batch.column(1), pa.array(found, pa.string()), lengths]
        yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])


def main_texts(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``page_id, url, text, n_chars``, one row per row of ``pages``; no shuffle.

    Every page's whole html is read, however long. NULL or empty html, and pages without any text
    outside of menus and the like, give an empty text. Identifiers and urls pass through, NULL or
    repeated as they are; other columns are ignored; no rows in, no rows out.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
    )
    return rows.mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")
