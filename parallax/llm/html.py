"""Main text of web pages by tag-path ratios."""

from __future__ import annotations

import html as entities
import math
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parallax.llm.common import slices, text_of, trimmed

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*+"|'[^']*+')*+)>""", re.S)
NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
PUNCTUATION = re.compile(r"[.,;:!?…。，！？；：、]")
# fixed values: HTML element names, and words in class and id names that mark what isn't the article
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
DROPPED = {"head", "title", "script", "style", "noscript", "template", "iframe", "svg", "math", "canvas", "object", "audio", "video", "nav", "header", "footer", "aside", "form", "button", "select", "option", "input", "textarea", "label", "fieldset", "dialog", "menu", "datalist"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
SCOPES = {"html", "body", "main", "article", "section", "div", "td", "th", "blockquote", "table", "ul", "ol", "dl", "figure", "aside", "nav", "header", "footer", "form"}
CONTAINERS = {"body", "main", "article", "section", "div", "td"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "optgroup": {"option", "optgroup"}, **dict.fromkeys(("thead", "tbody", "tfoot"), {"tr", "td", "th", "thead", "tbody", "tfoot", "caption", "colgroup"})}
IN_HEAD = {"head", "base", "basefont", "bgsound", "link", "meta", "title", "script", "style", "template", "noscript", "noframes"}
ALWAYS_OUT = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "comment", "comments", "reply", "replies", "respond", "disqus", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "popup", "modal", "newsletter", "subscribe", "subscription", "share", "sharing", "social", "login", "signup", "search"}
OFTEN_OUT = {"banner", "sidebar", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "related", "recommended", "footer", "header", "masthead", "toolbar", "widget", "pagination", "pager", "copyright", "disclaimer", "complementary", "contentinfo"}
#: In an article a name must consist of words that mark, and of these for parts: social-links is out, social-history isn't.
PARTS = {"area", "author", "banner", "bar", "block", "body", "bottom", "box", "btn", "button", "buttons", "container", "content", "count", "field", "footer", "form", "group", "header", "icon", "icons", "inline", "inner", "item", "left", "link", "links", "list", "media", "message", "meta", "module", "outer", "panel", "right", "section", "sidebar", "slot", "text", "thread", "title", "top", "unit", "widget", "wrap", "wrapper"}
#: How much more the ratio of a container that the page names as its article counts: decides between similar ones.
NAMED_ARTICLE = 2
ARTICLE = {"content", "article", "post", "entry", "story", "main", "body", "text"}


class _Open:
    """An element that is open while a page is read."""

    __slots__ = ("tag", "path", "out", "container", "article", "link", "number")

    def __init__(self, tag: str, above: _Open | None, out: bool, number: int, path: int):
        self.tag = tag
        self.path = path
        self.out = out or (above is not None and above.out)
        self.article = tag in ("article", "main") or (above is not None and above.article)
        self.container = number if tag in CONTAINERS and not (above and above.article) else above.container if above else 0
        self.number = number
        self.link = tag == "a" or (above is not None and above.link and tag in INLINE)


def _marked_out(tag: str, attributes: str, inside_article: bool) -> bool:
    if tag in ("html", "body", "main", "article"):
        return False
    if tag in DROPPED:
        return not (tag == "header" and inside_article)
    if "=" not in attributes:
        return bool(re.search(r"\shidden\b", attributes))
    words: set[str] = set()
    for m in NAMED.finditer(attributes):
        if inside_article and re.fullmatch("h[1-6]", tag) and m[0].lstrip()[:2].lower() == "id":
            continue  # a heading's anchor is made of its text
        for name in m[1].strip("\"'").split():
            found = set(re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()))
            if not inside_article or found <= ALWAYS_OUT | PARTS:
                words |= found
    return bool(words & ALWAYS_OUT) or bool(words & OFTEN_OUT and not words & ARTICLE and not inside_article)


class Blocks(list):
    """A page's text blocks in order: [path, container, in an article, text, characters in links, element].

    Elements are numbered in the order in which they begin, paths in that in which they come up. above: the element
    around each element; so what a page needs grows with its length, however deep its elements lie.
    """

    def __init__(self):
        super().__init__()
        self.above = [0]
        self.steps: list[tuple[int, str]] = [(0, "")]  # of each path: the one it goes on from, and the tag

    def path(self, number: int) -> str:
        tags = []
        while number:
            number, tag = self.steps[number]
            tags.append(tag)
        return "".join(f"/{t}" for t in reversed(tags))

    def ends(self) -> list[int]:
        """The last element inside each element: those inside are numbered without a gap."""
        ends = list(range(len(self.above)))
        for k in range(len(ends) - 1, 0, -1):
            ends[self.above[k]] = max(ends[self.above[k]], ends[k])
        return ends


def blocks(page: str) -> Blocks:
    root = _Open("", None, False, 0, 0)
    stack = [root]
    out = Blocks()
    paths: dict[tuple[int, str], int] = {}
    parts: list[str] = []
    links = 0
    number = 0

    def end_block() -> None:
        nonlocal links
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                at = stack[-1]
                k = len(stack) - 1
                while at.tag in INLINE:
                    k -= 1
                    at = stack[k]
                out.append([at.path, at.container, at.article, text, links, at.number])
        links = 0

    def add(text: str) -> None:
        nonlocal links
        if stack[-1].tag == "head" and not text.isspace() and text:
            stack.pop()  # its end tag was left out
        if text and not stack[-1].out:
            text = entities.unescape(text) if "&" in text else text
            parts.append(text)
            if stack[-1].link:
                links += len(text.strip())

    last = page.rfind(">") + 1  # behind it, a tag can't end: what looks like one is text
    page = page[:last] + re.sub("<(?=/?[a-zA-Z])", "&lt;", page[last:])
    at = 0
    while at < len(page):
        m = TAG.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        if not m[2]:
            if m[0].startswith("<![CDATA["):
                add(m[0][9:-3].replace("&", "&amp;"))
            continue
        tag = m[2].lower()
        if tag == "br":
            parts.append("\n")
            continue
        if tag not in INLINE:
            end_block()
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        if stack[-1].tag == "head" and tag not in IN_HEAD:
            stack.pop()
        if tag in VOID:
            continue
        closes = CLOSES.get(tag) or ({"p"} if tag not in INLINE else None)
        if closes:
            cut = len(stack)
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in closes:
                    cut = k
                elif stack[k].tag in SCOPES:
                    break
            del stack[cut:]
        number += 1
        path = paths.setdefault(step := (stack[-1].path, tag), len(out.steps))
        if path == len(out.steps):
            out.steps.append(step)
        out.above.append(stack[-1].number)
        stack.append(_Open(tag, stack[-1], _marked_out(tag, m[3], stack[-1].article), number, path))
        if m[3].endswith("/") and tag in INLINE:
            stack.pop()
        elif tag in RAW:
            stop = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
            at = stop.end() if stop else len(page)
            stack.pop()
    end_block()
    return out


def content(found: Blocks, share: float = 0.15) -> list[str]:
    """Texts of the blocks whose paths are content.

    For each root-to-leaf path: characters outside links and punctuation marks to a block. The path's ratio is the
    product of the first with the logarithm of the second. A block's ratio is smoothed over its neighbours in page
    order, and fused over the container in which its path lies (all of an article is one container), so that short
    headings and paragraphs go with the article around them. An article element's ratio counts NAMED_ARTICLE times.
    If an article is best, articles of at least `share` of its ratio are content. Else it is all of the subtree that
    _subtree() gives.
    """
    if not found:
        return []
    paths: dict[tuple, list[float]] = {}
    for path, container, _, text, links, _ in found:
        sums = paths.setdefault((path, container), [0, 0, 0])
        sums[0] += max(0, len(text) - links)
        sums[1] += len(PUNCTUATION.findall(text))
        sums[2] += 1
    ratio = {key: chars / n * math.log(2 + marks / n) + 1e-9 for key, (chars, marks, n) in paths.items()}
    raw = [ratio[b[0], b[1]] for b in found]
    kernel = (0.25, 0.5, 0.25)
    smooth = []
    for i, b in enumerate(found):
        near = [(w, raw[k]) for w, k in zip(kernel, (i - 1, i, i + 1)) if 0 <= k < len(raw) and found[k][1] == b[1]]
        smooth.append(sum(w * r for w, r in near) / sum(w for w, _ in near))
    fused: dict[int, float] = {}
    articles = {b[1] for b in found if b[2]}
    for b, s in zip(found, smooth):
        fused[b[1]] = max(fused.get(b[1], 0.0), s * (NAMED_ARTICLE if b[2] else 1))
    best = max(fused, key=fused.get)
    high = {c for c, r in fused.items() if r >= share * fused[best]}
    if best in articles:
        return [b[3] for b in found if b[1] in high & articles]
    kept = _subtree(found, high)
    return [b[3] for b, k in zip(found, kept) if k]


def _linked(part: list[list]) -> bool:
    """Whether blocks are links for the greater part, as those of a navigation are."""
    return 2 * sum(b[4] for b in part) > sum(len(b[3]) for b in part)


def _subtree(found: Blocks, high: set[int]) -> list[bool]:
    """Which blocks lie below the lowest common ancestor of the high containers' blocks.

    The ancestor moves up as long as what that adds isn't a navigation. An article is a text of its own: it ends the
    way up, and so it goes below the ancestor unless its ratio is high. There, containers of links go as well.
    """
    ends = found.ends()
    own = [b[5] for b in found if b[1] in high and not b[2]]
    node = min(own)
    while ends[node] < max(own):
        node = found.above[node]
    order = sorted(range(len(found)), key=lambda i: found[i][5])
    numbers = [found[i][5] for i in order]
    within = lambda k: (bisect_left(numbers, k), bisect_right(numbers, ends[k]))
    lo, hi = within(node)
    while node:
        a, b = within(found.above[node])
        added = [found[i] for i in (*order[a:lo], *order[hi:b])]
        if added and (_linked(added) or any(x[2] for x in added)):
            break
        node, lo, hi = found.above[node], a, b
    inside = set(order[lo:hi])
    groups: dict[int, list[list]] = {}
    for b in found:
        groups.setdefault(b[1], []).append(b)
    out = {c for c, part in groups.items() if c not in high and (part[0][2] or _linked(part))}
    return [b[1] in high or (i in inside and b[1] not in out) for i, b in enumerate(found)]


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page; text is empty if there is none, or html is null.

    No shuffle. Repeated and null ids pass through; an empty table gives no rows; other columns are not read. Pages may
    be of any length and nest to any depth; of containers of equal ratios the first is taken as best. Bytes that aren't
    UTF-8 become U+FFFD.
    """

    @trimmed
    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = ["\n\n".join(content(blocks(h or ""))) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    source = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), text_of(html_col).alias("html"))
    return source.mapInArrow(rows, "page_id long, url string, text string, n_chars long")
