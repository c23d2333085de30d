"""Main text of web pages by tag-path ratios.

A page's text nodes are grouped by their root-to-leaf tag path. Text length and
punctuation per node of a path are smoothed along the page, fused, and compared
with a threshold; the paths above it name the content nodes. The container around
all of them bounds the article. The result are the blocks inside it that hold a
content node, and its paragraphs, headings, list items, table cells and captions;
other blocks below the threshold, boilerplate elements, elements marked as such
and lists of nothing but links are left out. Content nodes outside of any article
or main element don't count where such an element holds most of the text.

Elements are numbered as they open, so that an element's number is larger than its
parent's: sums over subtrees and what is inherited take one pass each, whatever
the depth.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)"  # a comment, or an unclosed one to the end
    r"|<[!?][^>]*(?:>|\Z)"
    # a name, attributes with values in quotes or up to the next blank, as browsers read them
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>]++)?)?)*+)(?:>|\Z)"
    r"|([^<]+|<)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)(?:\"|\Z)|'([^']*+)(?:'|\Z)|([^\s>]++))?)?")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that hold no markup, and what ends them.
PLAIN = {x: re.compile(rf"</{x}(?=[\s/>]|\Z)", re.I) for x in "script style noscript textarea title iframe".split()}
#: Those of them that are so in vector graphics as well.
CODE = frozenset(("script", "style"))
RAW = frozenset("script style noscript template textarea title iframe svg object".split())
BLOCK = frozenset(
    "address article aside blockquote body dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that end an open element of the first kind when they start.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol menu dl table tbody thead tfoot article section main div body html aside nav header footer form blockquote figure td th".split())
BOILERPLATE = frozenset("head nav footer aside form menu button select dialog fieldset".split())
_DISCUSSION = r"comments?|commentlist|disqus|repl(?:y|ies)|respond|discussion"
_WORDS = (
    r"ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notices?|alerts?|popup|modal|overlay|newsletter|subscri\w*"
    rf"|sidebar\w*|menus?|nav\w*|breadcrumbs?|header|masthead|footer|foot|{_DISCUSSION}"
    r"|share|sharing|social|related|recommend\w*|widgets?|login|signup|search"
)
#: What may stand beside such words in a class name that means the same.
_BESIDE = (
    r"site|page|main|global|top|bottom|left|right|upper|lower|inner|outer|containers?|wrap(?:per)?|box|block|bar|area|section|lists?|items?|links?"
    r"|buttons?|groups?|panel|primary|secondary|tertiary|fixed|sticky|mobile|desktop|forms?|slot|unit|blog|wp|posts?|articles?|entry|stories|\d+"
)
#: A class, id or role, as a whole, that names boilerplate: "has-sidebar", "no-ads" and "comments-open" don't.
MARKS = re.compile(
    rf"(?:^|\s)(?!(?:post|article|entry)[_-]+header(?:\s|$))(?:(?:{_BESIDE})[_-]+)*(?:{_WORDS})(?:[_-]+(?:{_BESIDE}|{_WORDS}|content|text|title|body|trail))*(?=\s|$)", re.I
)
#: What an id alone marks on an element that may be a chapter or a paragraph of an article; "discussion" or "related" may name one.
PART_MARKS = re.compile(
    rf"(?:^|\s)(?:(?:{_BESIDE})[_-]+)*(?:comments?|commentlist|disqus|sidebar\w*|menu|nav\w*|breadcrumbs?|footer|masthead|ads?|advert\w*|cookies?|consent|newsletter)(?:[_-]+(?:{_BESIDE}))*(?=\s|$)", re.I
)
PARTS = frozenset("section p h1 h2 h3 h4 h5 h6 li dt dd td th".split())
#: Blocks that belong to an article they stand in, whatever their ratio.
KEPT = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th caption figcaption pre blockquote summary details".split())
#: A class, id or role, as a whole, that names the beginning of an article, wherever it stands.
LEAD = re.compile(r"(?:^|\s)(?:(?:article|post|entry|story|page)[_-]+)?(?:lead|lede|intro(?:duction)?|standfirst|dek|deck|abstract|excerpt|subtitle|subhead(?:line)?)(?:[_-]+(?:text|paragraph|body))?(?=\s|$)", re.I)
DISCUSSION = re.compile(rf"(?:^|[\s_-])(?:{_DISCUSSION})(?=$|[\s_-])", re.I)
HOME = frozenset(("article", "main"))
#: Elements that are left out as a whole where they hold nothing but links, more than FEW_LINKS.
LISTS = BLOCK - HOME - frozenset("html body li dt dd option tr td th tbody thead tfoot caption".split())
FEW_LINKS = 2
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？¿¡]")
#: Share of a page's text that stands for an article beside a marked element.
ELSEWHERE = 0.1
#: Standard deviation of the smoothing window, in text nodes.
SIGMA = 1.0
#: Share of the mean fused ratio that a path has to reach.
THRESHOLD = 0.5
#: Elements that can bound an article; a paragraph, list, table or inline element can't.
CONTAINERS = HOME | frozenset("html body div section".split())
#: Share of the selected text that an article or main element has to hold to make selected text outside of any such element outlying.
HOLDS = 0.85


class Page:
    """Elements and text nodes of a page; element 0 is the page itself.

    Per element: parent, tag, number of its tag path (names with classes), and
    whether it stands in a boilerplate element, in an article or main, in a link.
    Texts are (element, block number, text) in page order; marked elements tell
    whether their mark names a discussion.
    """

    def __init__(self, page: str):
        self.parent, self.tag, self.path, self.junk, self.home, self.link = [-1], [""], [0], [False], [False], [-1]
        self.texts: list[tuple[int, int, str]] = []
        self.marked: dict[int, bool] = {}
        self.leads: set[int] = set()
        self._names: dict[tuple[int, str], int] = {}
        self._read(page)

    def _open(self, up: int, tag: str, attributes: str) -> int:
        named = [(name.lower(), x or y or z) for name, x, y, z in ATTRIBUTE.findall(attributes)] if attributes.strip() else []
        marks = " ".join(v for name, v in named if name in ("class", "id", "role"))
        k = len(self.parent)
        if marks and tag not in ("html", "body") and tag not in HOME:
            plain = tag in PARTS and not any(name in ("class", "role") for name, _ in named)
            if m := (PART_MARKS if plain else MARKS).search(marks):
                self.marked[k] = bool(DISCUSSION.search(m[0]))
            elif LEAD.search(marks):
                self.leads.add(k)
        self.parent.append(up)
        self.tag.append(tag)
        self.path.append(self._names.setdefault((self.path[up], f"{tag}.{marks}" if marks else tag), len(self._names) + 1))
        self.junk.append(self.junk[up] or tag in BOILERPLATE or tag == "header" and not self.home[up])
        self.home.append(self.home[up] or tag in HOME)
        self.link.append(k if tag == "a" else self.link[up])
        return k

    def _read(self, page: str) -> None:
        stack, block, at, raw = [0], 0, 0, None
        tags, opened = self.tag, {}

        def close(i: int) -> None:
            for k in stack[i:]:
                opened[tags[k]] -= 1
            del stack[i:]

        while m := TOKEN.match(page, at):
            closing, tag, attributes, text = m.groups()
            at = m.end()
            if tag and not closing and (kind := tag.lower()) in PLAIN and (not raw or kind in CODE) and not attributes.rstrip().endswith("/"):
                end = PLAIN[kind].search(page, at)
                at = end.start() if end else len(page)
            if raw:
                if closing and tag.lower() == raw:
                    raw = None
                continue
            if text is not None:
                self.texts.append((stack[-1], block, entities.unescape(text)))
                continue
            if tag is None:
                continue
            tag = tag.lower()
            if closing:
                if not opened.get(tag):
                    block += tag in BLOCK
                    continue
                for i in range(len(stack) - 1, 0, -1):
                    if tags[stack[i]] == tag:
                        block += tag in BLOCK
                        close(i)
                        break
                    if tag not in BLOCK and tags[stack[i]] in BLOCK:
                        break
                continue
            if tag == "br":
                self.texts.append((stack[-1], block, " "))
                continue
            block += tag in BLOCK
            if tag in VOID:
                continue
            if tag in RAW:
                if not attributes.rstrip().endswith("/"):
                    raw = tag
                continue
            if tag in BLOCK and opened.get("p"):
                for i in range(len(stack) - 1, 0, -1):
                    if tags[stack[i]] == "p":
                        close(i)
                        break
                    if tags[stack[i]] in SCOPES:
                        break
            if tag in CLOSES:
                for i in range(len(stack) - 1, 0, -1):
                    if tags[stack[i]] in CLOSES[tag]:
                        close(i)
                        break
                    if tags[stack[i]] in SCOPES:
                        break
            stack.append(self._open(stack[-1], tag, attributes))
            opened[tag] = opened.get(tag, 0) + 1

    def summed(self, own: dict[int, int]) -> list[int]:
        """For every element the sum over itself and all it holds."""
        out = [own.get(k, 0) for k in range(len(self.parent))]
        for k in range(len(out) - 1, 0, -1):
            out[self.parent[k]] += out[k]
        return out

    def within(self, roots: set[int]) -> list[bool]:
        """For every element whether it is one of ``roots`` or stands in one."""
        out = [False] * len(self.parent)
        for k, up in enumerate(self.parent):
            out[k] = k in roots or k > 0 and out[up]
        return out

    def homes(self, k: int) -> list[int]:
        """The article and main elements around an element, itself included, from the inside out."""
        out = []
        while k > 0 and self.home[k]:
            if self.tag[k] in HOME:
                out.append(k)
            k = self.parent[k]
        return out


def lowered(page: Page, texts: list[tuple[int, int, str]]) -> set[int]:
    """The marked elements that are boilerplate indeed.

    A mark doesn't count where its element holds more than half of the page's text
    without links, or the only article or main element with unmarked text. It counts
    even so if ``ELSEWHERE`` of the text is unmarked and, but for a discussion,
    in another article or main. Where marks take all text, that with the most doesn't count.
    """
    own: dict[int, int] = {}
    at_home: dict[int, int] = {}
    for e, _, text in texts:
        own[e] = own.get(e, 0) + len(text) * (page.link[e] < 0)
        if found := page.homes(e):
            at_home[found[0]] = 1
    held, with_text = page.summed(own), page.summed({e: 1 for e, _, _ in texts})
    above = page.summed(at_home)
    low = {k for k in page.marked if with_text[k]}
    around = {k for k in low if above[k]}
    total = held[0]

    def unmarked(home: bool) -> int:
        out = page.within(low)
        return sum(n for e, n in own.items() if not out[e] and (not home or page.home[e]))

    for k in sorted(low):
        if 2 * held[k] > total or k in around:
            elsewhere = unmarked(False) if page.marked[k] else 0 if page.home[k] else unmarked(True)
            if elsewhere < ELSEWHERE * total and (2 * held[k] > total or not unmarked(True)):
                low.discard(k)
    while low and not unmarked(False) and (most := max((held[k], -k) for k in low))[0]:
        low.discard(-most[1])
    return low


def smooth(values: np.ndarray) -> np.ndarray:
    """Gaussian window over the sequence of text nodes."""
    width = int(3 * SIGMA)
    window = np.exp(-0.5 * (np.arange(-width, width + 1) / SIGMA) ** 2)
    padded = np.convolve(values, window)[width : width + len(values)]
    return padded / np.convolve(np.ones(len(values)), window)[width : width + len(values)]


def path_ratios(paths: list[int], texts: list[str], smoothed: bool = True) -> tuple[dict[int, float], float]:
    """The largest fused ratio of each path, and the mean over all text nodes.

    A node's ratios are its path's mean text length and mean number of marks,
    each smoothed over the sequence of nodes; fused, they are the geometric mean.
    Without smoothing a path stands for itself, whatever its neighbours are.
    """
    count, length, marks = {}, {}, {}
    for p, text in zip(paths, texts):
        count[p] = count.get(p, 0) + 1
        length[p] = length.get(p, 0) + len(text)
        marks[p] = marks.get(p, 0) + len(PUNCTUATION.findall(text))
    over = smooth if smoothed else lambda x: x
    ratio = over(np.array([length[p] / count[p] for p in paths]))
    points = over(np.array([(marks[p] + 0.1) / count[p] for p in paths]))
    fused = np.sqrt(ratio * points)
    best: dict[int, float] = {}
    for p, value in zip(paths, fused.tolist()):
        best[p] = max(best.get(p, 0.0), value)
    return best, float(fused.mean())


def content_paths(page: Page, texts: list[tuple[int, int, str]]) -> set[int]:
    """The paths whose ratio reaches the threshold and whose text isn't mostly that of links."""
    paths = [page.path[e] for e, _, _ in texts]
    best, mean = path_ratios(paths, [t for _, _, t in texts])
    length, links = {}, {}
    for p, (e, _, text) in zip(paths, texts):
        length[p] = length.get(p, 0) + len(text)
        links[p] = links.get(p, 0) + len(text) * (page.link[e] >= 0)
    linked = {p for p in length if links[p] > 0.5 * length[p]}
    return {p for p, v in best.items() if v >= THRESHOLD * mean and p not in linked} or set(best) - linked or set(best)


def link_lists(page: Page, texts: list[tuple[int, int, str]], ratios: dict[int, float], least: float) -> set[int]:
    """The lists and other blocks whose whole text, but for separators, is that of more than ``FEW_LINKS`` links.

    A part of a list or table is none, nor is the page or an article as such, nor,
    within an article, a list of links whose path has a ratio like a text's: references
    have titles, with marks in them, where menus have words.
    """
    links = page.summed({page.link[e]: 1 for e, _, _ in texts if page.link[e] >= 0})
    plain = page.summed({e: 1 for e, _, text in texts if page.link[e] < 0 and any(c.isalnum() for c in text)})
    telling = page.summed({e: 1 for e, _, _ in texts if page.home[e] and page.link[e] >= 0 and ratios[page.path[e]] >= least})
    return {k for k, tag in enumerate(page.tag) if tag in LISTS and links[k] > FEW_LINKS and not plain[k] and not telling[k]}


def bounds(page: Page, content: list[int]) -> set[int]:
    """The elements that bound an article; element 0 is the whole page.

    It is the deepest article or main around all elements with content, else each
    one's outermost article or main if all have one, else the deepest container
    around all.
    """
    number: dict[int, int] = {}
    for e in content:
        number[e] = number.get(e, 0) + 1
    inside = page.summed(number)
    common = max(k for k, n in enumerate(inside) if n == len(content))
    if found := page.homes(common):
        return {found[0]}
    if all(page.home[e] for e in content):
        return {page.homes(e)[-1] for e in set(content)}
    while common and page.tag[common] not in CONTAINERS:
        common = page.parent[common]
    return {common}


def main_text(html: str | None) -> str:
    """The article of a page: blocks in page order, one per line; empty where there is none.

    A null or empty page, and one without any text outside boilerplate, gives an
    empty text. Truncated and unclosed markup is read as browsers do: what is
    open ends with its parent, and an unfinished tag or comment at the end is none.
    """
    if not html:
        return ""
    page = Page(html)
    found = [x for x in page.texts if not page.junk[x[0]]]
    texts = [(e, b, " ".join(t.split())) for e, b, t in found if t.strip()]
    if low := page.marked and lowered(page, texts):
        out = page.within(low)
        found, texts = [x for x in found if not out[x[0]]], [x for x in texts if not out[x[0]]]
    if not texts:
        return ""
    chosen = content_paths(page, texts)
    content = [x for x in texts if page.path[x[0]] in chosen]
    held: dict[int, int] = {}
    for e, _, text in content:
        if around := page.homes(e):
            held[around[-1]] = held.get(around[-1], 0) + len(text)
    lead = page.within(page.leads)
    if held and max(held.values()) >= HOLDS * sum(len(t) for _, _, t in content):
        content = [x for x in content if page.home[x[0]]]
    around = bounds(page, [e for e, _, _ in content if page.home[e] or not lead[e]] or [e for e, _, _ in content])
    inside = page.within(around | page.leads)
    ratios, mean = path_ratios([page.path[e] for e, _, _ in texts], [t for _, _, t in texts], smoothed=False)
    lists = page.within(link_lists(page, texts, ratios, THRESHOLD * mean))
    blocks: dict[int, list[str]] = {}
    keep = set()
    for e, block, text in found:
        if not inside[e] or lists[e]:
            continue
        blocks.setdefault(block, []).append(text)
        if block not in keep and text.strip():
            if page.path[e] in chosen:
                keep.add(block)
            else:
                # a part of a text, or words of an article that are no link, stay whatever their ratio; bare numbers don't
                linked, at_home = page.link[e] >= 0, page.home[e]
                while e and page.tag[e] not in BLOCK:
                    e = page.parent[e]
                if page.tag[e] in KEPT or at_home and not linked and any(c.isalpha() for c in text):
                    keep.add(block)
    lines = (" ".join("".join(x).split()) for b, x in sorted(blocks.items()) if b in keep)
    return "\n".join(x for x in lines if x)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of ``pages``.

    Null ids and urls stay null, a null or empty page gives an empty text, rows
    that repeat stay so many rows, an empty table gives an empty result; other
    columns are ignored.
    """

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            out = [main_text(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
