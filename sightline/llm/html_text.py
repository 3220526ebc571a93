"""Main text of web pages by tag-path ratios.

A page becomes a sequence of text nodes, each with its root-to-leaf tag path. Per path, text length
and punctuation are added up and divided by the number of nodes; the two ratios are smoothed over
neighbouring nodes of the same parent path with a Gaussian, fused (their geometric mean) and
weighted by a prior: the first element of the path whose class, id or role names boilerplate
scales it by PRIOR, each further one by AGAIN. Paths at or above the deviation of the fused values, held between LOW and HIGH of the
leading path's value, are selected, and all their nodes are content.

The content nodes vote, with their text, for the element that holds them: from the root, the search
descends as long as one child holds nearly all votes. The text is that of the blocks with a content
node in that element; its other blocks stay if no element in it names them boilerplate and they lie
between content blocks, right after their headings, or if the element is an article or mostly content. So a wrapper's name
alone drops nothing, and without selected paths nothing comes out.
"""

from __future__ import annotations

import functools
import html
import math
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cluster import bounded_batches

# Elements of HTML, and the words that name boilerplate parts.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "plaintext"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main",
    "menu", "nav", "ol", "option", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
NEVER = {"head", "nav", "footer", "aside", "button", "select", "input", "menu", "dialog", "noscript", "template", "svg", "canvas", "object", "audio", "video", "math", "map", *RAW}
BOILERPLATE_ROLE = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "form", "menu", "menubar"}
BOILERPLATE_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies",
    "disqus", "footer", "gdpr", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pager", "pagination", "popup", "promo",
    "promoted", "related", "recommended", "reply", "replies", "responses", "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe", "subscription", "toolbar", "widget",
    "anzeige", "comentarios", "commentaires", "fusszeile", "kommentare", "publicidad", "publicite", "werbung",
}
#: A paragraph ends where one of these opens; a list item, cell or term where its like opens.
CLOSES_P = BLOCK - {"body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "li", "dd", "dt", "option", "legend", "summary", "figcaption"}
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}

#: End tags other than CLOSE_ACROSS don't reach beyond these; elements that may hold an article.
ENCLOSING = {"td", "th", "table", "article", "body"}
CLOSE_ACROSS = {"table", "article", "body", "html", "tr", "tbody", "thead", "tfoot", "main", "div", "section", "td", "th"}
HOLDERS = {"html", "body", "div", "form", "main", "article", "section", "center", "span", "table", "tbody", "tr", "td"}
#: Words that take back the boilerplate word after them, as in has-sidebar.
NEGATING = {"has", "with", "no", "without"}

PRIOR, AGAIN, LOW, HIGH, HOLDS, MOSTLY = 0.05, 0.3, 0.2, 0.5, 0.9, 0.8
#: Characters that a page must have under boilerplate names for them to pass as its content.
NAMED_LEAST = 160

_TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>[^>\"']+|\"[^\"]*\"|'[^']*'|[\"'])*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_PUNCTUATION = re.compile(r"[.,;:!?。，、；：！？…]")
#: Headings that open reader comments; these last to the next heading of their rank, or the end of the element.
_COMMENTS = re.compile(r"(?:\(?\d+\)?\s+)?(?:reader\s+|all\s+|user\s+)?(?:comments?|responses|kommentare?|commentaires?|comentarios?)(?:\s*\(?\d+\)?)?\s*:?|leave a (?:comment|reply)", re.I)
_SPACE = re.compile(r"\s+")
_NAME_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")


@dataclass
class Element:
    """path is the number of its tag path; never: not page text; named: elements from the root on with a boilerplate name; in_article: whether an article or main element holds it."""

    tag: str
    parent: Element | None
    path: int
    never: bool
    named: int
    in_article: bool
    votes: float = 0.0
    plain: float = 0.0
    inside: bool = False


@dataclass
class Text:
    raw: str
    element: Element
    block: int


def _marks(tag: str, attributes: str, in_article: bool) -> tuple[bool, bool]:
    """Whether the element is never page text, and whether its attributes (or being a form) name boilerplate."""
    if tag in NEVER or (tag == "header" and not in_article):
        return True, False
    named = tag == "form"
    for name, *values in _ATTRIBUTE.findall(attributes) if attributes.strip() else ():
        value, name = "".join(values), name.lower()
        if name == "hidden":
            return True, False
        if (name == "aria-hidden" and value == "true") or (name == "role" and value.lower() in BOILERPLATE_ROLE):
            named = True
        if name in ("class", "id") and tag not in ("html", "body", "article", "main"):
            words = ["", *(w.lower() for w in _NAME_WORD.findall(value))]
            named = named or any(w in BOILERPLATE_WORDS and before not in NEGATING for before, w in zip(words, words[1:], strict=False))
    return False, named


def parse(source: str) -> tuple[list[Element], list[Text], list[int]]:
    """The elements in page order, the root first; the text nodes with the number of the block each belongs to; each path's parent path."""
    root = Element("", None, 0, False, 0, False)
    at, position, block = root, 0, 0
    elements, texts = [root], []
    paths: dict[tuple[int, str, bool], int] = {}
    parents = [0]
    open_tags: dict[str, int] = {}

    def put(raw: str) -> None:
        if raw:
            texts.append(Text(raw, at, block))

    def close(upto: Element) -> None:
        """Leave upto and all that is open in it."""
        nonlocal at
        while at is not upto.parent:
            open_tags[at.tag] -= 1
            at = at.parent

    for m in _TOKEN.finditer(source):
        if m.start() < position:
            continue
        put(source[position : m.start()])
        position = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                put(html.escape(m[0][9:].removesuffix("]]>"), quote=False))
            continue
        if tag in BLOCK:
            block += 1
        if m[1]:
            if open_tags.get(tag):
                up = at
                while up.tag != tag:
                    if up.tag in ENCLOSING and tag not in CLOSE_ACROSS:
                        up = None
                        break
                    up = up.parent
                if up is not None:
                    close(up)
            continue
        if tag in CLOSES_P or tag in CLOSES:
            ends, stops = ({"p"}, {"td", "th", "table", "button", "object"}) if tag in CLOSES_P else CLOSES[tag]
            if any(open_tags.get(e) for e in ends):
                up = at
                while up is not root and up.tag not in ends and up.tag not in stops and not (tag in CLOSES_P and up.tag in BLOCK):
                    up = up.parent
                if up.tag in ends:
                    close(up)
        if tag in VOID:
            if tag == "br":
                put(" ")
            continue
        never, named = _marks(tag, m[3], at.in_article)
        path = paths.setdefault((at.path, tag, named), len(parents))
        if path == len(parents):
            parents.append(at.path)
        child = Element(tag, at, path, at.never or never, at.named + named, at.in_article or tag in ("article", "main"))
        elements.append(child)
        if tag in RAW:
            end = _raw_end(tag).search(source, position)
            position = end.end() if end else len(source)
        elif not m[3].endswith("/"):
            at = child
            open_tags[tag] = open_tags.get(tag, 0) + 1
    put(source[position:])
    return elements, texts, parents


@functools.cache
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I)


_KERNEL = [(k, math.exp(-2 * k * k)) for k in range(-1, 2)]


def _smooth(values: list[float], family: list[int]) -> list[float]:
    """A Gaussian of deviation 1/2 over the nodes on either side, those of the same family only."""
    out = []
    for i, mine in enumerate(family):
        total = weight = 0.0
        for k, w in _KERNEL:
            if 0 <= i + k < len(values) and family[i + k] == mine:
                total, weight = total + w * values[i + k], weight + w
        out.append(total / weight)
    return out


def content_paths(nodes: list[tuple[int, int, str]], parents: list[int]) -> set[int]:
    """The paths, of nodes given as (path, boilerplate names on it, text), whose fused and weighted ratio passes the threshold."""
    length, marks, count, named = {}, {}, {}, {}
    for path, names, text in nodes:
        length[path] = length.get(path, 0) + len(text)
        marks[path] = marks.get(path, 0) + len(_PUNCTUATION.findall(text))
        count[path] = count.get(path, 0) + 1
        named[path] = names
    family = [parents[p] for p, _, _ in nodes]
    by_length = _smooth([length[p] / count[p] for p, _, _ in nodes], family)
    by_marks = _smooth([marks[p] / count[p] for p, _, _ in nodes], family)
    fused = dict.fromkeys(count, 0.0)
    prior = {p: PRIOR * AGAIN ** (n - 1) if n else 1.0 for p, n in named.items()}
    for (p, _, _), a, b in zip(nodes, by_length, by_marks, strict=True):
        fused[p] += math.sqrt(a * (b + 0.03)) * prior[p] / count[p]
    leader = max(fused, key=lambda p: fused[p] * length[p])
    if named[leader] and sum(n for p, n in length.items() if named[p]) < NAMED_LEAST:
        unnamed = [n for n in nodes if not n[1]]
        return content_paths(unnamed, parents) if unnamed else set()
    mean = sum(v * count[p] for p, v in fused.items()) / len(nodes)
    spread = math.sqrt(sum(count[p] * (v - mean) ** 2 for p, v in fused.items()) / len(nodes))
    cut = min(max(spread, LOW * fused[leader]), HIGH * fused[leader])
    return {p for p, v in fused.items() if v >= cut}


def _holder(elements: list[Element]) -> Element:
    """The element that holds the votes: the deepest with HOLDS of them, or the article or main element around it."""
    heaviest: dict[int, Element] = {}
    for e in reversed(elements[1:]):  # children come after their parents
        e.parent.votes += e.votes
        e.parent.plain += e.plain
        if id(e.parent) not in heaviest or e.votes >= heaviest[id(e.parent)].votes:
            heaviest[id(e.parent)] = e
    holder = root = elements[0]
    while (heavy := heaviest.get(id(holder))) is not None and heavy.votes >= HOLDS * root.votes and heavy.tag in HOLDERS:
        holder = heavy
    for tag in ("article", "main"):
        up = holder
        while up is not None and up.tag != tag:
            up = up.parent
        if up is not None:
            return up
    return holder


def main_text(source: str | None) -> str:
    """The article's blocks, joined by line feeds; empty for a null or textless page."""
    if not source:
        return ""
    elements, texts, parents = parse(source)
    shown = [(t, clean) for t in texts if not t.element.never and (clean := _SPACE.sub(" ", html.unescape(t.raw)).strip())]
    comments = _comments(shown)
    shown = [x for x in shown if id(x[0]) not in comments]
    if not shown:
        return ""
    content = content_paths([(t.element.path, t.element.named, clean) for t, clean in shown], parents)
    for t, clean in shown:
        t.element.plain += len(clean)
        if t.element.path in content:
            t.element.votes += len(clean)
    if not content:
        return ""
    holder = _holder(elements)
    for e in elements:
        e.inside = e is holder or (e.parent is not None and e.parent.inside)
    inside = [t for t in texts if t.element.inside and not t.element.never and id(t) not in comments]
    by_path = {t.block for t, _ in shown if t.element.inside and t.element.path in content}
    first, last = min(by_path), max(by_path)
    unnamed = sum(len(clean) for t, clean in shown if t.element.inside and t.element.named == holder.named)
    whole = holder.tag == "article" or (holder.tag not in ("", "html", "body") and holder.votes >= MOSTLY * unnamed)
    title = _title_blocks(shown, holder, first)
    for t, _ in reversed(shown):  # headings right before the content
        if t.element.inside and t.block < first:
            if not re.fullmatch("h[1-6]", t.element.tag):
                break
            title.add(t.block)
    blocks: dict[int, list[str]] = {}
    for t in [*(t for t, _ in shown if t.block in title and not t.element.inside), *inside]:
        if t.element.path in content or (t.element.named <= holder.named and (whole or t.block in title or first <= t.block <= last)):
            blocks.setdefault(t.block, []).append(t.raw)
    lines = (_SPACE.sub(" ", html.unescape("".join(b))).strip() for b in blocks.values())
    return "\n".join(x for x in lines if x)


def _comments(shown: list[tuple[Text, str]]) -> set[int]:
    """The text nodes, by identity, of reader comments and their headings."""
    out: set[int] = set()
    element = rank = None
    for t, clean in shown:
        level = int(t.element.tag[1]) if re.fullmatch("h[1-6]", t.element.tag) else None
        up = t.element
        while up is not None and up is not element:
            up = up.parent
        if element is not None and (up is None or (level is not None and level <= rank)):
            element = None
        if element is None and level is not None and level > 1 and _COMMENTS.fullmatch(clean):
            element, rank = t.element.parent, level
        if element is not None:
            out.add(id(t))
    return out


def _title_blocks(shown: list[tuple[Text, str]], holder: Element, first: int) -> set[int]:
    """The block of the last h1 before the content that stands beside its holder, or beside the holder's parent, if these aren't the page's body."""
    beside = [e for e in (holder.parent, holder.parent.parent if holder.parent else None) if e is not None and e.tag not in ("", "html", "body")]
    found = [t.block for t, _ in shown if t.element.tag == "h1" and not t.element.inside and t.block < first and any(t.element.parent is e for e in beside) and t.element.named <= holder.named]
    return set(found[-1:])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of pages: id, url and text, the main text of the whole html.

    Character references are decoded, white space in a block is one space, blocks stand in page
    order with one line feed between them. A null, empty or textless page has an empty text; a
    page without markup is its own text; ids and urls pass as they are; other columns are ignored.
    """
    bounded_batches(pages.sparkSession)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_url"), pa.array([main_text(x.as_py()) for x in batch.column("_html")], pa.string())], ["_id", "_url", "text"])

    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.col(html_col).cast("string").alias("_html"))
    types = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]
    return rows.mapInArrow(run, f"_id {types[0]}, _url {types[1]}, text string").withColumnsRenamed({"_id": id_col, "_url": url_col})
