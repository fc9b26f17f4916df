"""Main text of web pages by tag-path ratios (operator 1).

A page is read as blocks: runs of text between block-level tags. Every root-to-leaf tag path (tags
with their classes) gets two ratios over its blocks: characters per node and punctuation per node.
The ratios are smoothed along the page, fused by their geometric mean, and paths above a share of
the page's mean are content paths. The element that holds most of the text on content paths is the
article. On pages that do not say so themselves (article, main) its blocks are chosen by the ratios:
those on content paths, and what stands among them as headings, lists, tables and the like; boxes
beside them without any content path go. Parts that are marked as
something else (menus, headers, footers, sidebars, notices, adverts, forms, comments of readers,
scripts) never count. Pages are independent of each other, so nothing is shuffled.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from orderdw.llm.common import table

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark "
                   "q s samp small span strike strong sub sup time tt u var wbr br img".split())
NEVER = frozenset("head script style noscript template svg math iframe object canvas audio video "
                  "nav footer aside form button select textarea option datalist dialog menu".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset "
                     "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav "
                     "ol p pre section table ul".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
            "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table article section div main body html aside form".split())
OTHER_PARTS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs masthead footer sidebar aside widget ad ads "
    "adv advert advertisement adsense sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup login "
    "search share sharing social related recommended recommendations trending pagination pager "
    "toolbar skip hidden disclaimer copyright legal teaser teasers".split())
COMMENTS = frozenset("comment comments commentlist respond replies disqus discussion".split())
HEADERS = frozenset(["header", "topbar"])
CONTENT = frozenset("article content post entry story main".split())
STATES = frozenset("has with without no is".split())  # a class such as has-sidebar names no part
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu "
                  "menubar alertdialog".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BOXES = frozenset("div section center td".split())
LARGE = frozenset(["html", "body", "main", "article"])
WORD = re.compile(r"[a-z0-9]+")
SPACE = re.compile(r"\s+")
MARKS = frozenset(".,;:!?…。，、；：！？।؟،")
SHARE, LINKED = 0.4, 0.9


class _Page(HTMLParser):
    """Elements (parent, tag, path, excluded) and blocks (element, text, linked characters)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.paths, self.out = ["#"], [-1], [0], [False]
        self.inside = [False]  # of an article or main element
        self.names: dict[tuple[int, str], int] = {}
        self.stack = [0]
        self.open = Counter()  # how many elements of each name the stack holds
        self.blocks: list[tuple[int, str, int]] = []
        self.text: list[str] = []
        self.at, self.links, self.linked = 0, 0, 0

    def flush(self) -> None:
        if self.text:
            text = SPACE.sub(" ", "".join(self.text)).strip()
            if text:
                self.blocks.append((self.at, text, min(self.linked, len(text))))
            self.text, self.linked = [], 0

    def _excluded(self, tag: str, attrs: list[tuple[str, str | None]], inside: bool) -> bool:
        if tag in NEVER:
            return True
        if tag == "header" and not inside:
            return True
        for key, value in attrs:
            value = (value or "").lower()
            if key in ("class", "id"):
                if any(self._other_part(tag, name, inside) for name in value.split()):
                    return True
            elif tag in LARGE:
                continue
            elif (key == "role" and value in ROLES or key == "hidden"
                  or key == "aria-hidden" and value == "true"
                  or key == "style" and "display:none" in value.replace(" ", "")):
                return True
        return False

    @staticmethod
    def _other_part(tag: str, name: str, inside: bool) -> bool:
        """Whether a class or id names something else than the article: its last word does, or any
        of its words if none speaks of content."""
        words = WORD.findall(name)
        if not words or words[0] in STATES:
            return False
        if tag in LARGE:  # of these only an article can be a comment
            return tag == "article" and not COMMENTS.isdisjoint(words)
        if not COMMENTS.isdisjoint(words) or words[-1] in OTHER_PARTS:
            return True
        if not CONTENT.isdisjoint(words):
            return False
        return not OTHER_PARTS.isdisjoint(words) or not inside and not HEADERS.isdisjoint(words)

    def _close_to(self, depth: int) -> None:
        for at in self.stack[depth:]:
            self.open[self.tags[at]] -= 1
            if self.tags[at] == "a":
                self.links -= 1
        del self.stack[depth:]

    def _implied(self, tag: str) -> None:
        wanted = {"p"} if tag in CLOSES_P else SIBLINGS.get(tag)
        if wanted and any(self.open[name] for name in wanted):
            for depth in range(len(self.stack) - 1, 0, -1):
                name = self.tags[self.stack[depth]]
                if name in wanted:
                    self._close_to(depth)
                    break
                if name in SCOPE and name not in wanted:
                    break

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in INLINE:
            self.flush()
        elif tag == "br":
            self.text.append(" ")
        if tag in VOID:
            return
        self._implied(tag)
        up = self.stack[-1]
        kind = next((f"{tag}.{v}" for k, v in attrs if k == "class"), tag)
        path = self.names.setdefault((self.paths[up], kind), len(self.names) + 1)
        here = len(self.tags)
        self.tags.append(tag)
        self.parents.append(up)
        self.paths.append(path)
        self.inside.append(self.inside[up] or tag in ("article", "main"))
        self.out.append(self.out[up] or self._excluded(tag, attrs, self.inside[here]))
        self.stack.append(here)
        self.open[tag] += 1
        if tag == "a":
            self.links += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in ("div", "p", "span", "a", "li", "section"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self.flush()
        if not self.open[tag]:  # a stray end tag
            return
        for depth in range(len(self.stack) - 1, 0, -1):
            name = self.tags[self.stack[depth]]
            if name == tag:
                self._close_to(depth)
                break
            if tag in INLINE and name not in INLINE:
                break

    def handle_data(self, data: str) -> None:
        here = self.stack[-1]
        if self.out[here]:
            if self.text and self.out[self.at] is False:
                self.text.append(" ")
            return
        if not self.text or self.out[self.at]:
            self.at = here
            while self.tags[self.at] in INLINE:  # a block belongs to its block-level element
                self.at = self.parents[self.at]
        self.text.append(data)
        if self.links:
            self.linked += len(data.strip())


def _smoothed(values: list[float]) -> list[float]:
    weights = (0.25, 0.5, 0.25)
    padded = [values[0], *values, values[-1]]
    return [sum(w * padded[i + j] for j, w in enumerate(weights)) for i in range(len(values))]


def content_paths(blocks: list[tuple[int, str]]) -> set[int]:
    """The paths whose fused ratios reach SHARE of the page's mean per block."""
    stats: dict[int, list[float]] = {}
    for path, text in blocks:
        s = stats.setdefault(path, [0, 0, 0])
        s[0] += 1
        s[1] += len(text)
        s[2] += sum(map(MARKS.__contains__, text))
    chars = _smoothed([stats[p][1] / stats[p][0] for p, _ in blocks])
    marks = _smoothed([stats[p][2] / stats[p][0] for p, _ in blocks])
    fused: dict[int, float] = {}
    for (path, _), c, m in zip(blocks, chars, marks, strict=True):
        fused[path] = fused.get(path, 0.0) + math.sqrt(c * (1 + m))
    mean = sum(fused.values()) / len(blocks)
    return {p for p, total in fused.items() if total / stats[p][0] >= SHARE * mean}


def main_text(html: str | None) -> str:
    """The article's blocks, in page order, joined by two line feeds."""
    if not html:
        return ""
    page = _Page()
    # No tag ends behind the last bracket: what begins there is text, and is not tried as a tag.
    end = html.rfind(">") + 1
    page.feed(html[:end] + html[end:].replace("<", "&lt;"))
    page.close()
    page.flush()
    menus = _menus(page)
    blocks = [(at, text) for at, text, _ in page.blocks
              if not page.out[at] and at not in menus]
    if not blocks:
        return ""
    wanted = content_paths([(page.paths[at], text) for at, text in blocks])
    weight = [0] * len(page.tags)
    for at, text in blocks:
        if page.paths[at] in wanted:
            weight[at] += len(text)
    depth = [0] * len(page.tags)
    for at in range(len(page.tags) - 1, 0, -1):
        weight[page.parents[at]] += weight[at]
    for at in range(1, len(page.tags)):
        depth[at] = depth[page.parents[at]] + 1
    top = _container(page, weight, depth)
    held = [False] * len(page.tags)
    held[top] = True
    for at in range(1, len(page.tags)):
        held[at] = held[at] or held[page.parents[at]]
    if page.tags[top] not in ("article", "main"):
        chosen = {at for at, _ in blocks if held[at] and page.paths[at] in wanted}
        held = _among(page, top, {at for at, _ in blocks}, chosen, held)
    return "\n\n".join(text for at, text in blocks if held[at])


def _among(page: _Page, top: int, texts: set[int], chosen: set[int], held: list[bool]
           ) -> list[bool]:
    """The elements in ``top`` that are chosen, or stand among chosen ones: an element goes with what
    it holds if it is a mere box of other things than headings, nothing in it is chosen, and
    something beside it is. Headings go with what they head."""
    def holding(blocks: set[int]) -> list[bool]:
        some = [at in blocks and tag not in HEADINGS for at, tag in enumerate(page.tags)]
        for at in range(len(page.tags) - 1, 0, -1):
            some[page.parents[at]] = some[page.parents[at]] or some[at]
        return some

    some, any_ = holding(chosen), holding(texts)
    kept = [False] * len(page.tags)
    kept[top] = True
    for at in range(top + 1, len(page.tags)):
        kept[at] = held[at] and kept[page.parents[at]] and (
            some[at] or not any_[at] or page.tags[at] not in BOXES or not some[page.parents[at]])
    return kept


def _container(page: _Page, weight: list[int], depth: list[int]) -> int:
    for tag in ("article", "main"):
        found = [i for i, t in enumerate(page.tags) if t == tag and not page.out[i]]
        if found:
            best = max(found, key=lambda i: (weight[i], -i))
            if 2 * weight[best] >= weight[0]:
                return best
    full = [i for i in range(len(weight)) if 10 * weight[i] >= 9 * weight[0]]
    best = max(full, key=lambda i: (depth[i], -i))
    if page.tags[best] in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "td", "pre"):
        best = max(page.parents[best], 0)  # a page of one paragraph has its heading beside it
    return best


def _menus(page: _Page) -> set[int]:
    """Elements of lists that hold little but links, outside of articles."""
    total, linked, count = ([0] * len(page.tags) for _ in range(3))
    for at, text, links in page.blocks:
        total[at] += len(text)
        linked[at] += links
        count[at] += 1
    for at in range(len(page.tags) - 1, 0, -1):
        up = page.parents[at]
        total[up] += total[at]
        linked[up] += linked[at]
        count[up] += count[at]
    menu = [False] * len(page.tags)
    for at in range(1, len(page.tags)):
        menu[at] = menu[page.parents[at]] or (
            page.tags[at] in ("ul", "ol", "div", "table") and count[at] >= 3
            and not page.inside[at] and linked[at] >= LINKED * max(1, total[at]))
    return {at for at, m in enumerate(menu) if m}


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(h) for h in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html).

    Character references are decoded, white space inside a block is one space, blocks are trimmed
    and joined by two line feeds. Null, empty and text-free pages give an empty text; broken markup
    is read as browsers would. Repeated rows repeat; other columns are left out.
    """
    return pages.select("page_id", "url", "html").mapInArrow(
        _extract, "page_id long, url string, text string, n_chars long")


def op1_html_tag_paths(spark: SparkSession, folder: str) -> DataFrame:
    """Contract query: the main text of every page."""
    return extract(table(spark, folder, "pages"))
