"""Blocks of text of an HTML page, with the path of elements around each.

A tolerant reader: unclosed and stray tags, cut-off pages, raw-text elements and quoted ``>`` are handled the way
browsers do.  Inline elements do not end a block, ``br`` is white space in one.  Elements that hold no article text
(navigation, forms, scripts, adverts, comments and the like, by name, role, class or id) are left out.  A class, id or
role counts as a whole: all of its words must be such words or words of place and layout (``left-sidebar``, but not
``has-sidebar``).  An element that holds the article is never left out: if all marked articles (``article``, ``main``)
of a page lie in such elements these stay, and so does a block element that holds most of the page's text while no
other part of the page is marked as its article (but not one that is no article by its name, like ``nav``).
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field
from functools import lru_cache

# HTML element names by how they are read, and words of class, id and role that mark what is no article.
BLOCKS = frozenset("""html head body div p section article main aside nav header footer form fieldset legend ul ol li dl
    dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption h1 h2 h3 h4 h5 h6 hr address details
    summary dialog menu center hgroup search noframes frameset""".split())
VOID = frozenset("hr br img input meta link area base col embed source track wbr param".split())
RAW = "script|style|noscript|template|textarea|select|svg|math|iframe|object|title|button|canvas|video|audio"
NOT_ARTICLE = frozenset("nav footer aside form head dialog menu search fieldset frameset noframes".split())
NOT_ARTICLE_WORDS = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion nav
    navbar navigation menu footer sidebar aside cookie cookies consent gdpr notice popup modal newsletter subscribe
    subscription signup login breadcrumb breadcrumbs pagination pager share sharing social related recommended
    recommendations comment comments respond disqus widget toolbar copyright contentinfo complementary alert alertdialog
    search skip""".split())
PLACE_WORDS = frozenset("""area bar block bottom box button buttons col column container group holder inner item items
    left link links list main outer post posts primary right secondary section site slot stories top unit wrap
    wrapper""".split())
PAGE_HEADER_WORDS = frozenset("header banner masthead topbar".split())

_ATTRIBUTES = r"(?:[^>=]|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*+"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?:{RAW})(?=[\s/>]){_ATTRIBUTES}>(?:(?<=/>)|.*?(?:</(?:{RAW})\s*>|\Z))"
    rf"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)({_ATTRIBUTES})>"
    r"|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^>]*\Z", re.S | re.I)
_RAW = re.compile(rf"<({RAW})(?=[\s/>]){_ATTRIBUTES}>", re.S | re.I)
_NAMED = re.compile(r"(?:^|\s)(class|id|role|itemprop|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+)))?",
                    re.I)
_WORD = re.compile(r"[a-z]+")
_CLOSES = {"li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
           "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "body": {"head", "p"}}


def _names(value: str, words: frozenset[str]) -> bool:
    """Whether a token of a class, id or role is made of ``words``, with words of place beside them."""
    for token in value.split():
        parts = {w for w in _WORD.findall(token) if len(w) > 1}
        if parts & words and parts <= words | PLACE_WORDS:
            return True
    return False


@lru_cache(maxsize=8192)
def _element(name: str, attributes: str) -> tuple[str, bool, bool, bool]:
    """Signature, whether it holds no article text, whether it may be a page header, whether it is a main region."""
    signature, out, hidden, region, header = name, name in NOT_ARTICLE, False, name in ("article", "main"), name == "header"
    for key, *values in _NAMED.findall(attributes):
        key, value = key.lower(), "".join(values).lower()
        if key in ("class", "id", "role"):
            out |= _names(value, NOT_ARTICLE_WORDS)
            header |= _names(value, PAGE_HEADER_WORDS)
            signature += "." + re.sub(r"\d+", "0", value)
        region |= (key == "role" and value == "main") or (key == "itemprop" and value == "articlebody")
        hidden |= key == "hidden" or (key == "aria-hidden" and value == "true") or (
            key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value) is not None)
    if name in ("html", "body"):
        return name, False, False, False
    return signature, out or hidden, header, region


@dataclass
class Page:
    """Blocks and the paths of all elements, both in page order, and whether a main region exists.

    A block is ``(path, text, in a main region, at)``, where ``at`` is the number of elements that begin before it.
    """

    blocks: list[tuple[str, str, bool, int]] = field(default_factory=list)
    elements: list[str] = field(default_factory=list)
    has_region: bool = False


class _LeftOut:
    """The elements of a page that may be left out and its main regions, until all of the page is known.

    Elements and regions have numbers in page order, -1 is none; of each its parent of that kind is kept.
    """

    def __init__(self) -> None:
        self.around: list[int] = []  # of an element, the next such element around it
        self.movable: list[bool] = []  # whether much text can show that it holds the article
        self.inside: list[int] = []  # its innermost region
        self.regions: list[tuple[int, int]] = []  # the region around a region, and its innermost element

    def chain(self, at: int) -> list[int]:
        out = []
        while at >= 0:
            out.append(at)
            at = self.around[at]
        return out

    def _region_chain(self, at: int) -> list[int]:
        out = []
        while at >= 0:
            out.append(at)
            at = self.regions[at][0]
        return out

    def resolve(self, blocks: list[tuple[str, str, int, int, int]]) -> tuple[list[tuple[str, str, bool, int]], bool]:
        """The blocks ``(path, text, in a main region, at)`` that stay, of ``(path, text, region, element, at)``."""
        if not self.around:
            return [(path, text, region >= 0, at) for path, text, region, _, at in blocks], bool(self.regions)
        chars, total = [0] * len(self.around), 0
        region_chars = [0] * len(self.regions)
        for _, text, region, element, _ in blocks:
            total += len(text)
            if element >= 0:
                chars[element] += len(text)
        for i in range(len(chars) - 1, -1, -1):
            if self.around[i] >= 0:
                chars[self.around[i]] += chars[i]
        out = [True] * len(self.around)
        gone = self._gone(out)
        marked = [i for i, (_, at) in enumerate(self.regions) if not (at >= 0 and gone[at])]
        freed = not marked and bool(self.regions)
        while not marked and self.regions:
            for _, at in self.regions:
                if held := [i for i in self.chain(at) if out[i]]:
                    out[held[-1]] = False
            gone = self._gone(out)
            marked = [i for i, (_, at) in enumerate(self.regions) if not (at >= 0 and gone[at])]
        for _, text, region, element, _ in blocks:
            if region >= 0 and not (element >= 0 and gone[element]):
                for i in self._region_chain(region):
                    region_chars[i] += len(text)
        article = {i for i in marked if region_chars[i]}
        for i, held in enumerate(chars):
            if out[i] and self.movable[i] and 2 * held > total and article <= set(self._region_chain(self.inside[i])):
                out[i] = False
        gone = self._gone(out)
        kept = [(path, text, region >= 0, at) for path, text, region, element, at in blocks
                if not (element >= 0 and gone[element])]
        # regions that were to be left out are the page's article only if they hold most of its text
        return kept, bool(marked) and (not freed or 2 * sum(len(t) for _, t, region, _ in kept if region) > total)

    def _gone(self, out: list[bool]) -> list[bool]:
        gone = list(out)
        for i, around in enumerate(self.around):
            gone[i] = out[i] or (around >= 0 and gone[around])
        return gone


def read(source: str | None) -> Page:
    page = Page()
    if not source:
        return page
    left_out, blocks = _LeftOut(), []
    stack: list[tuple[str, str, int, int]] = [("", "", -1, -1)]  # name, path, element left out, region
    texts: list[str] = []
    inline = 0  # inline elements on the stack
    at, end = 0, len(source)

    def flush() -> None:
        if texts:
            text = "".join(texts)
            if text := " ".join((html.unescape(text) if "&" in text else text).split()):
                blocks.append((stack[-1][1], text, stack[-1][3], stack[-1][2], len(page.elements)))
            texts.clear()

    while at < end:
        found = _TOKEN.search(source, at)
        if found is None:
            texts.append(source[at:])
            break
        if found.start() > at:
            texts.append(source[at : found.start()])
        at = found.end()
        name = found.group(2)
        if name is None:
            if raw := _RAW.match(found.group()):  # up to the end tag of its own name
                if not raw.group().endswith("/>"):
                    close = re.compile(rf"</{raw.group(1)}\s*>", re.I).search(source, found.start() + raw.end())
                    at = close.end() if close else end
                if raw.group(1).lower() == "title" and stack[-1][0] not in ("head", "", "html"):
                    continue
            continue
        name, attributes = name.lower(), found.group(3)
        block = name in BLOCKS
        if not block:
            if name == "br":
                texts.append(" ")
            if name in VOID:
                continue
            if found.group(1):
                if not inline or all(x[0] != name for x in stack):
                    continue
            elif not attributes or attributes.endswith("/") or not _element(name, attributes)[1]:
                continue
        flush()
        if found.group(1):
            if name in ("html", "body"):
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == name:
                    inline -= sum(x[0] not in BLOCKS for x in stack[i:])
                    del stack[i:]
                    break
            continue
        closes = _CLOSES.get(name, {"p"}) if block else ()
        while stack[-1][0] in closes:
            stack.pop()
        if stack[-1][0] == "head" and name not in ("head", "html"):
            stack.pop()
        if name in VOID:
            continue
        _, path, element, region = stack[-1]
        signature, out, header, is_region = _element(name, attributes)
        path = f"{path}/{signature}"
        if out or (header and region < 0 and not is_region):
            left_out.around.append(element)
            left_out.movable.append(block and (name not in NOT_ARTICLE or name in ("form", "fieldset")))
            left_out.inside.append(region)
            element = len(left_out.around) - 1
        if is_region:
            left_out.regions.append((region, element))
            region = len(left_out.regions) - 1
        stack.append((name, path, element, region))
        inline += not block
        page.elements.append(path)
    flush()
    page.blocks, page.has_region = left_out.resolve(blocks)
    return page
