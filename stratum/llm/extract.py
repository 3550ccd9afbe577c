"""Main text of web pages by tag-path ratios.

A page's text falls into blocks, each with the tag path from the root (tags with
their class or id).  For every path the text length and the punctuation of its
blocks are added up and divided by their number.  Both ratios are smoothed along
the page, fused into one value a block, and blocks whose path's mean reaches the
page's threshold are content nodes.  The smallest element that holds most of the
content nodes' text is the article's core: short paragraphs and headings inside it
stay, whatever their ratio.  So do, in each part of the page beside the core that has
content nodes, the smallest element that holds these, and headings that lead to what
stays.  Where the core lies in an article or main element, only parts in such elements
count.  The rest goes.  Elements that are no
article text by tag or by name (menus, adverts, forms, comments and the like)
are left out before paths are counted.  A name alone never takes out an article
element (unless inside another one), nor an element that holds more than ``WHOLE``
of the content nodes' text as they are with all named elements in, unless the page
has an article element elsewhere.

Each page is a row of its own, without a shuffle; a page is held by one task.
Null and empty html give an empty text, as do pages without text.  Repeated rows
are each extracted; other columns aren't read.  Broken markup is read as it
comes: a block element closes an open paragraph, an end tag closes up to its
start tag, an end tag without one is ignored, a tag that is cut off is dropped.
What lies between a script's, title's or similar tag and its end tag isn't read as
markup; without an end tag it reaches to the end of the page.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import kind, slices

#: Tags and names; fixed values.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol optgroup option p pre section
select summary table tbody td tfoot th thead title tr ul""".split())
SILENT = frozenset("""annotation annotation-xml aside audio button canvas datalist dialog footer form head iframe input
label menu nav noscript object option script select style svg template textarea title video""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
VERBATIM = frozenset("script style textarea title noscript iframe".split())
#: Words in an element's class, id or role that name something beside the article.
ASIDE = re.compile(r"(?:^|[_-])(?:ads?|advert\w*|alerts?|announcements?|banners?|breadcrumbs?|comments?|complementary|"
                   r"consent|contentinfo|cookies?|copyright|discussion|disqus|dropdown|footers?|gdpr|login|masthead|menus?|"
                   r"modal|nav\w*|newsletter|notices?|notification|pagination|popups?|promo\w*|related|repl(?:y|ies)|"
                   r"responses?|search|share|sharing|sidebars?|signup|social|sponsor\w*|subscribe|teasers?|toolbar|topbar|"
                   r"widgets?)(?:[_-]|\d|$)", re.IGNORECASE)
#: Beginnings of names that tell what an element has or lacks rather than what it is.
ABOUT = re.compile(r"(?:no|not|has|with|without|is|open)[_-]", re.IGNORECASE)
PUNCTUATION = re.compile(r"[.,;:!?。，、；：！？]")
#: Weights of the smoothing along the page, from a block to its second neighbours.
KERNEL = (0.4, 0.2, 0.1)
_HEADINGS = frozenset(f"h{n}" for n in range(1, 7))
#: Share of the content nodes' text that the article's core holds.
MOST = 0.9
#: An element that holds more than this share of the content nodes' text isn't beside the article, whatever its name.
WHOLE = 0.5
#: A path is content from this share of the page's mean fused value on.
THRESHOLD = 0.5

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|"""
                    r"""</?[a-zA-Z][^>]*\Z""", re.DOTALL)
#: A verbatim element's end tag.
_ENDS = {tag: re.compile(rf"</{tag}(?:[\s/][^>]*)?(?:>|\Z)", re.IGNORECASE) for tag in VERBATIM}
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_WORD = re.compile(r"[a-z]+")
#: An attribute's name and its value, quoted or bare.
_ATTRIBUTE = re.compile(r"""([^\s/=][^\s/=]*)(?:\s*=\s*("[^"]*"|'[^']*'|\S*))?""")


class _Element:
    __slots__ = ("tag", "parent", "path", "silent", "depth", "beside")

    def __init__(self, tag: str, names: str, parent: _Element | None, silent: bool, beside: bool = False):
        self.tag, self.parent, self.silent = tag, parent, silent
        self.beside = self if beside else parent.beside if parent else None  # the innermost whose name is beside the article
        self.path = (parent.path if parent else "") + "/" + tag + ("." + names if names else "")
        self.depth = parent.depth + 1 if parent else 0


def blocks_of(page: str) -> list[tuple[str, _Element]]:
    """The page's text blocks outside silent elements and those that their names rule out, in order: text
    and the element that holds it."""
    found: _Found = []
    root = here = _Element("", "", None, False)
    held: list[tuple[str, _Element | None]] = []
    at = 0

    def flush():
        if held:
            block = here
            while block.parent is not None and block.tag not in BLOCKS:
                block = block.parent
            found.append((held.copy(), block))
            held.clear()

    while token := _TOKEN.search(page, at):
        closing, tag = token[1], (token[2] or "").lower()
        if not here.silent and token.start() > at:
            held.append((page[at:token.start()], here.beside))
        at = token.end()
        if not tag:
            continue
        if closing:
            to = here
            while to.parent is not None and to.tag != tag:
                if to.tag in BLOCKS and tag not in BLOCKS:
                    to = root  # an inline end tag doesn't close a block
                    break
                to = to.parent
            if to.parent is not None:
                if tag in BLOCKS:
                    flush()
                here = to.parent
        else:
            if tag in BLOCKS or tag == "hr":
                flush()
                to = here
                while to.parent is not None and (to.tag not in BLOCKS or to.tag == "p" or to.tag == tag == "li"):
                    if to.tag == "p" or to.tag == tag == "li":
                        here = to.parent
                        break
                    to = to.parent
            elif tag == "br":
                held.append((" ", here.beside))
            if tag in VOID or token[3].rstrip().endswith("/"):
                continue
            if tag in VERBATIM:
                end = _ENDS[tag].search(page, at)
                at = end.end() if end else len(page)
            else:
                attributes = {k.lower(): v.strip("\"'") for k, v in reversed(_ATTRIBUTE.findall(token[3]))} if token[3] else {}
                names = " ".join(attributes.get(k, "") for k in ("class", "id", "role")).strip()
                silent = here.silent or tag in SILENT or "hidden" in attributes or (
                    tag == "header" and not _inside_article(here))
                judged = not silent and bool(names) and tag not in ("html", "body", "main") and (
                    tag != "article" or _inside_article(here, ("article",)))
                beside = judged and (_beside(names) or "header" in _WORD.findall(names.lower()) and not _inside_article(here))
                here = _Element(tag, names, here, silent, beside)
    if not here.silent:
        held.append((page[at:], here.beside))
    flush()
    return _texts(found, _ruled_out(found))


_Found = list[tuple[list[tuple[str, "_Element | None"]], _Element]]


def _texts(found: _Found, out: set[_Element]) -> list[tuple[str, _Element]]:
    """The blocks, of their pieces those that no element of ``out`` holds."""
    texts = []
    for pieces, block in found:
        text = " ".join(html.unescape("".join(piece for piece, beside in pieces if beside not in out)).split())
        if text:
            texts.append((text, block))
    return texts


def _ruled_out(found: _Found) -> set[_Element]:
    """The elements named as beside the article that hold little of the content nodes' text or lie outside the page's
    article elements (main elements if there are none) that no name covers, and those in them."""
    named = {beside for pieces, _ in found for _, beside in pieces if beside is not None}
    if not named:
        return named
    blocks = _texts(found, set())
    chosen = {element for (_, element), content in zip(blocks, content_nodes(blocks)) if content}
    marks = {tag for pieces, block in found if any(beside is None and piece.strip() for piece, beside in pieces)
             for tag in ("article", "main") if _inside_article(block, (tag,))}
    mark = min(marks, default=None)
    held: dict[_Element, int] = defaultdict(int)
    total = 0
    for pieces, block in found:
        for piece, beside in pieces if block in chosen else ():
            size = len("".join(piece.split()))
            total += size
            while beside is not None:
                held[beside] += size
                beside = beside.parent.beside
    out = set()
    for element in named:
        beside = element
        while beside is not None and held[beside] > WHOLE * total and (mark is None or _inside_article(beside, (mark,))):
            beside = beside.parent.beside
        if beside is not None:
            out.add(element)
    return out


def _beside(names: str) -> bool:
    """Whether one of an element's names, as it is or with camel case split, is that of something beside the article."""
    return any(ASIDE.search(name) or ASIDE.search(_CAMEL.sub("-", name)) for name in names.split() if not ABOUT.match(name))


def _inside_article(element: _Element | None, tags: tuple[str, ...] = ("article", "main")) -> bool:
    while element is not None:
        if element.tag in tags:
            return True
        element = element.parent
    return False


def _smoothed(values: list[float]) -> list[float]:
    out = []
    for i in range(len(values)):
        total = weight = 0.0
        for d in range(-len(KERNEL) + 1, len(KERNEL)):
            if 0 <= i + d < len(values):
                total += KERNEL[abs(d)] * values[i + d]
                weight += KERNEL[abs(d)]
        out.append(total / weight)
    return out


def content_nodes(blocks: list[tuple[str, _Element]]) -> list[bool]:
    """Whether each block's path is content, by the fused ratios of length and punctuation."""
    totals: dict[str, list[float]] = defaultdict(lambda: [0, 0, 0])
    for text, element in blocks:
        t = totals[element.path]
        t[0] += len(text)
        t[1] += len(PUNCTUATION.findall(text))
        t[2] += 1
    length = _smoothed([totals[e.path][0] / totals[e.path][2] for _, e in blocks])
    marks = _smoothed([totals[e.path][1] / totals[e.path][2] for _, e in blocks])
    fused = [math.log1p(a) * (1 + math.log1p(b)) for a, b in zip(length, marks)]
    by_path: dict[str, list[float]] = defaultdict(list)
    for (_, element), value in zip(blocks, fused):
        by_path[element.path].append(value)
    least = THRESHOLD * sum(fused) / max(1, len(fused))
    return [sum(by_path[e.path]) / len(by_path[e.path]) >= least for _, e in blocks]


def article(blocks: list[tuple[str, _Element]], content: list[bool]) -> _Element | None:
    """The smallest element that holds most of the content nodes' text; an article or main element that does goes first."""
    held: dict[_Element, int] = defaultdict(int)
    total = 0
    for (text, element), chosen in zip(blocks, content):
        if chosen:
            total += len(text)
            element = element.parent or element  # a block is a part of an article, never the whole
            while element is not None:
                held[element] += len(text)
                element = element.parent
    enough = [e for e, n in held.items() if n >= MOST * total]
    named = [e for e in enough if e.tag in ("article", "main")]
    return max(named or enough, key=lambda e: e.depth, default=None)


def kept(blocks: list[tuple[str, _Element]], content: list[bool]) -> list[bool]:
    """Whether each block belongs to the article: to its core, to another part with content nodes, or a heading of these."""
    core = article(blocks, content)
    above, element = set(), core
    while element is not None:
        above.add(element)
        element = element.parent
    marked = core is not None and _inside_article(core)
    open_ = [not marked or _inside_article(element) for _, element in blocks]
    out, branches = [], []
    parts: dict[_Element, set[_Element]] = {}
    for (_, element), chosen, allowed in zip(blocks, content, open_):
        path = [element]
        while path[-1] not in above:
            path.append(path[-1].parent)
        inside = path.pop() is core
        branch = path[-1] if path else None
        out.append(inside or chosen and allowed)
        branches.append(None if inside else branch)
        if chosen and allowed and not inside and branch is not None:
            holders = set(path[1:] or path)
            parts[branch] = parts[branch] & holders if branch in parts else holders
    tops = {max(found, key=lambda e: e.depth) for found in parts.values() if found}
    for i, (_, element) in enumerate(blocks):
        while not out[i] and open_[i] and branches[i] in parts and element not in above:
            out[i] = element in tops
            element = element.parent
    return _with_headings(blocks, out, open_)


def _with_headings(blocks: list[tuple[str, _Element]], out: list[bool], allowed: list[bool]) -> list[bool]:
    """The blocks kept, the headings right before them, and if there is no h1, the last one before them."""
    for i in range(len(blocks) - 2, -1, -1):
        out[i] = out[i] or out[i + 1] and allowed[i] and blocks[i][1].tag in _HEADINGS
    if not any(chosen and element.tag == "h1" for (_, element), chosen in zip(blocks, out)):
        for i in range(out.index(True) - 1 if True in out else -1, -1, -1):
            if allowed[i] and blocks[i][1].tag == "h1":
                out[i] = True
                break
    return out


def main_text(page: str | None) -> str:
    blocks = blocks_of(page or "")
    return "\n".join(text for (text, _), chosen in zip(blocks, kept(blocks, content_nodes(blocks))) if chosen)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """For each page ``id_col``, ``url_col``, ``text`` (blocks in page order, joined by line feeds) and ``n_chars``."""

    def extracted(batches):
        for batch in slices(batches):
            texts = [main_text(page) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                [id_col, url_col, "text", "n_chars"])

    return pages.select(id_col, url_col, F.col(html_col).cast("string")).mapInArrow(
        extracted, f"`{id_col}` {kind(pages, id_col)}, `{url_col}` {kind(pages, url_col)}, text string, n_chars long")
