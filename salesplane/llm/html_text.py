"""Main text of web pages by composite text density."""

from __future__ import annotations

import html
import math
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table

_MARKUP = re.compile(r"<!--(?:.*?--!?>|.*)|<[!?][^>]*>|<(/?)(?=[a-zA-Z])", re.S)
_NAME_END = re.compile(r"[\s/>]")
_SPECIAL = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p "
                  "pre section summary table tbody tfoot thead tr ul".split())
CLOSES_P = BLOCK - frozenset("body caption dd dt html legend li option optgroup summary tbody tfoot thead tr".split())
#: An element that such a start tag ends, if it is open within the given scope.
ENDS_SAME = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
             "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
             "option": ({"option"}, {"select", "datalist"}), "body": ({"head"}, set())}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Never part of an article's text.
DROPPED = frozenset("head nav footer aside form script style noscript template svg math canvas iframe object embed audio video map "
                    "button select textarea input datalist dialog menu title noembed noframes applet".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
_BOILERPLATE = re.compile(
    r"^(?:nav|navbar|navigation|menu|topmenu|submenu|breadcrumbs?|sidebar|side|aside|footer|foot|masthead|header|"
    r"ad|ads|adv|advert|adverts|advertisement|advertising|adsbygoogle|banner|sponsor|sponsored|promo|promotion|"
    r"comment|comments|commentlist|respond|disqus|replies|cookie|cookies|consent|gdpr|notice|notices|notification|"
    r"alert|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|share|sharing|social|related|"
    r"recommended|recommendations|widget|widgets|toolbar|pagination|pager|search|skip|copyright|legal|disclaimer)$")
_NOT_AN_ARTICLE = frozenset("comment comments reply respond ad ads advert advertisement sponsored promo related teaser".split())
_ARTICLE_PARTS = frozenset("article content entry post story".split())
#: First parts of words that say how a wrapper looks or behaves, not what it is.
_MODIFIERS = frozenset("has no with without is show hide".split())
#: Second parts of names such as share-buttons; within an article only these make a
#: compound name one of the list's (social-history and share-price are content).
_HOLDERS = frozenset("area bar block box button buttons container form icons items link links list section wrapper".split())
_COMMENTS = frozenset("comment comments commentlist respond disqus replies".split())
_TOKEN = re.compile(r"[A-Za-z]+")
#: Why an element is dropped: for what it is, or by a name that wrappers may have too.
CERTAIN, BY_NAME = 1, 2
#: Share of a page's plain characters over which an element isn't dropped by name;
#: long sidebars beside short articles hold more than half.
MOST = 0.9


def _named(parts: list[str], within: bool) -> bool:
    """Whether the parts of a class or id word name boilerplate; ``within`` an article
    a compound name does so as a whole only."""
    if not parts:
        return False
    if _BOILERPLATE.match("".join(parts)):
        return True
    if within:
        return bool(_BOILERPLATE.match(parts[0])) and all(_BOILERPLATE.match(p) or p in _HOLDERS for p in parts)
    return bool(_BOILERPLATE.match(parts[0]) or _BOILERPLATE.match(parts[-1]))


def _boilerplate(tag: str, attributes: str, within: bool = False) -> int:
    """CERTAIN, BY_NAME or 0."""
    if tag in DROPPED:
        return CERTAIN
    if not attributes or tag in ("html", "body"):
        return 0
    named = 0
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return CERTAIN
        if name == "role" and value.lower() in DROPPED_ROLES:
            return CERTAIN
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return CERTAIN
        if name in ("class", "id"):
            for word in value.split():
                parts = [p.lower() for p in _TOKEN.findall(re.sub(r"([a-z])([A-Z])", r"\1-\2", word))]
                if tag in ("article", "main") and not _NOT_AN_ARTICLE.intersection(parts):
                    continue
                if parts and parts[-1] == "header" and parts[0] in _ARTICLE_PARTS:
                    continue
                if parts and parts[0] in _MODIFIERS:
                    continue
                if _named(parts, within):
                    if _COMMENTS.intersection(parts):
                        return CERTAIN
                    named = BY_NAME
    return named


class _Next:
    """Position of a pattern's next match, or the source's length; found once."""

    def __init__(self, pattern: re.Pattern, source: str):
        self.pattern, self.source, self.since, self.at = pattern, source, 0, -1

    def __call__(self, at: int) -> int:
        if not self.since <= at <= self.at:
            m = self.pattern.search(self.source, at)
            self.since, self.at = at, m.start() if m else len(self.source)
        return self.at


class _Tags:
    """Ends of tags and of their names, quoted values of any length skipped.  What
    a search that failed has passed is not passed again, so a page takes linear time."""

    def __init__(self, source: str):
        self.source, self.failed = source, set()
        self.name_end, self.special = _Next(_NAME_END, source), _Next(_SPECIAL, source)

    def find(self, at: int) -> tuple[int, int]:
        """Ends of the name that begins at ``at`` and of its tag (its ``>``), or -1 for no tag."""
        name = self.name_end(at)
        end = self._end(name)
        if end < 0 and (quote := self.special(at)) < name:
            name, end = quote, self._end(quote)
        return name, end

    def _end(self, at: int) -> int:
        quotes = []
        while (i := self.special(at)) < len(self.source) and i not in self.failed:
            if self.source[i] == ">":
                return i
            quotes.append(i)
            at = self.source.find(self.source[i], i + 1) + 1
            if not at:
                break
        self.failed.update(quotes)
        return -1


class _Page:
    """Elements in document order, and the texts and block borders between them."""

    def __init__(self, source: str):
        self.tag, self.parent, self.why, self.first, self.last = ["html"], [-1], [0], [0], [0]
        self.events: list[tuple[int, str | None]] = []  # (element, text), or None where a block begins or ends
        self._open, self._names = [0], ["html"]
        self._read(source)
        while self._open:
            self._close()
        self.drop = self._dropped()

    def _dropped(self) -> list[bool]:
        """Elements to drop, with all they hold; not by name one that holds most
        of the page's plain characters: there the text density decides."""
        n = len(self.tag)
        sure, link, plain = [False] * n, [False] * n, [0] * n
        for i in range(1, n):
            up = self.parent[i]
            sure[i] = sure[up] or self.why[i] == CERTAIN
            link[i] = link[up] or self.tag[i] == "a"
        if BY_NAME in self.why:
            for i, text in self.events:
                if text is not None and not sure[i] and not link[i]:
                    plain[i] += len("".join(text.split()))
            for i in range(n - 1, 0, -1):
                plain[self.parent[i]] += plain[i]
        drop = [False] * n
        for i in range(1, n):
            drop[i] = drop[self.parent[i]] or sure[i] or self.why[i] == BY_NAME and plain[i] <= MOST * plain[0]
        return drop

    def _close(self):
        i = self._open.pop()
        self._names.pop()
        if self.tag[i] in BLOCK:
            self.events.append((i, None))
        self.last[i] = len(self.events)

    def _end(self, names: set[str], scope: set[str]):
        for k in range(len(self._names) - 1, 0, -1):
            if self._names[k] in names:
                while len(self._names) > k:
                    self._close()
                return
            if self._names[k] in scope:
                return

    def _start(self, tag: str, attributes: str):
        if tag == "html":
            return
        if tag in ENDS_SAME:
            self._end(*ENDS_SAME[tag])
        if tag in CLOSES_P and "p" in self._names:
            self._end({"p"}, {"button", "table", "td", "th", "caption"})
        up, i = self._open[-1], len(self.tag)
        self.tag.append(tag)
        self.parent.append(up)
        why = _boilerplate(tag, attributes, "article" in self._names or "main" in self._names)
        if not why and (tag == "header" or self.tag[up] == "header") and tag not in HEADINGS:
            # Of a header only headings stay, and these within an article only.
            why = 0 if any(n in ("article", "main") for n in self._names) else CERTAIN
        self.why.append(why)
        if tag in ("br", "td", "th"):
            self.events.append((i, " "))
        elif tag in BLOCK:
            self.events.append((i, None))
        self.first.append(len(self.events))
        self.last.append(len(self.events))
        if tag not in VOID:
            self._open.append(i)
            self._names.append(tag)

    def _text(self, text: str):
        if text:
            self.events.append((self._open[-1], html.unescape(text) if "&" in text else text))

    def _read(self, source: str):
        at, after, low, tags = 0, 0, None, _Tags(source)
        for m in iter(lambda: _MARKUP.search(source, after), None):
            if m[1] is None:
                self._text(source[at:m.start()])
                at = after = m.end()
                continue
            name, end = tags.find(m.end())
            if end < 0:
                after = m.end()
                continue
            self._text(source[at:m.start()])
            tag, attributes, at = source[m.end():name].lower(), source[name:end], end + 1
            after = at
            if m[1]:
                if tag in self._names[1:]:
                    if tag in BLOCK or tag in ("td", "th", "a"):
                        self._end({tag}, set())
                    else:
                        self._end({tag}, set(BLOCK))
                elif tag == "p":
                    self.events.append((self._open[-1], None))
                continue
            self._start(tag, attributes)
            if tag in RAW and not attributes.endswith("/"):
                low = low if low is not None else source.lower()
                end = low.find(f"</{tag}", at) if len(low) == len(source) else -1
                if end < 0:
                    found = re.compile(f"</{tag}", re.I).search(source, at)
                    end = found.start() if found else len(source)
                at = after = end
        self._text(source[at:])


def _density(c: int, t: int, lc: int, lt: int, share: float) -> float:
    """Composite text density of an element with ``c`` characters, ``t`` tags and,
    of these, ``lc`` and ``lt`` in links; ``share`` is lc / c of the body."""
    if not c:
        return 0.0
    t, plain, lc, lt = max(t, 1), max(c - lc, 1), max(lc, 1), max(lt, 1)
    base = math.log(c / plain * lc + share * c + math.e)
    return c / t * math.log(max(c / lc * t / lt, 1.0)) / max(math.log(base), 1e-9)


def main_text(source: str | None) -> str:
    """Blocks of the page's article, one per line; empty for null or empty pages."""
    if not source:
        return ""
    page = _Page(source)
    n = len(page.tag)
    chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    for i, text in page.events:
        if text is not None and not page.drop[i]:
            chars[i] += len("".join(text.split()))
    for i in range(n - 1, 0, -1):
        if page.drop[i]:
            continue
        if page.tag[i] == "a":
            link_chars[i], link_tags[i] = chars[i], tags[i] + 1
        up = page.parent[i]
        chars[up] += chars[i]
        tags[up] += tags[i] + 1
        link_chars[up] += link_chars[i]
        link_tags[up] += link_tags[i]
    share = link_chars[0] / max(chars[0], 1)
    density = [0.0 if page.drop[i] else _density(chars[i], tags[i], link_chars[i], link_tags[i], share) for i in range(n)]
    total = [0.0] * n
    for i in range(1, n):
        total[page.parent[i]] += density[i]
    if not chars[0]:
        return ""

    best = max(range(n), key=lambda i: (total[i] if not page.drop[i] else -1, -i))
    path = [best]
    while path[-1]:
        path.append(page.parent[path[-1]])
    root = next((i for tag in ("article", "main") for i in reversed(path) if page.tag[i] == tag), None)
    dropped = page.drop
    if root is None:
        # The densest subtree and whatever is as dense as the thinnest element
        # between it and the body; the text is theirs and all between them.
        limit = min(density[i] for i in path)
        kept = [i for i in range(1, n) if density[i] >= limit and chars[i] > 2 * link_chars[i] and page.tag[i] in BLOCK] + [best]
        lines = []
        for i in kept:
            line = []
            while i >= 0:
                line.append(i)
                i = page.parent[i]
            lines.append(line[::-1])
        root, depth = 0, 0
        while all(len(x) > depth and x[depth] == lines[0][depth] for x in lines):
            root, depth = lines[0][depth], depth + 1
        if page.tag[root] in ("html", "body"):
            dropped = list(page.drop)
            for i in range(1, n):
                thin = page.parent[i] == root and page.tag[i] != "body" and density[i] < limit and 2 * link_chars[i] >= chars[i]
                dropped[i] = dropped[i] or thin or page.parent[i] > root and dropped[page.parent[i]]
    blocks, own = [], []
    for i, text in page.events[page.first[root]:page.last[root]]:
        if text is None:
            blocks.append(own)
            own = []
        elif not dropped[i]:
            own.append(text)
    lines = (" ".join("".join(x).split()) for x in [*blocks, own])
    return "\n".join(x for x in lines if x)


def extract_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages`` (page_id, url, html).

    Each whole page is parsed leniently; elements that never belong to an article
    (menus, footers, sidebars, forms, notices, adverts, comments, scripts) leave
    the tree, but an element with such a name only (comments apart) stays if it
    holds most of the page's plain characters; every other element gets its link-adjusted characters per tag, the
    subtree with the largest sum of child densities is chosen, and the thinnest
    element on its path to the body is the threshold for what else is content.
    The outermost ``article`` (or else ``main``) around
    the chosen subtree is taken whole.  Table cells are parts of their row's block.  Null or
    empty html gives empty text; repeated rows and other columns don't matter.
    """
    @F.pandas_udf("string")
    def text(sources: pd.Series) -> pd.Series:
        return pd.Series([main_text(s) for s in sources], dtype=object)

    return (pages.select("page_id", "url", text("html").alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(read_table(spark, sf_dir, "pages"))
