"""Main text of web pages: parser events, text-to-tag ratios, smoothing, clustering.

The standard library's parser is fed a page and its events are turned into blocks, the
lines of the method: a block's text, its number of tags and the region it lies in. Parts
that markup declares to be no content (navigation, footers, forms, adverts, comments and
so on) are left out as they stream by. Every block's ratio of text to tags is smoothed
with a Gaussian along the page, a threshold splits the ratios into two clusters, and the
regions that hold a block of the upper cluster are the content. A region is kept whole,
short lines included; with none above the threshold the region with most text is kept.
Articles and main elements are regions as wholes, and are preferred to the rest of the
page if one of them reaches the threshold.

Words of classes and ids are evidence only. A name made of hints alone leaves its element
out, a hint among other words does so if most of the element's text is links. Neither
counts for headings, for an element that holds an article or main element (unless those
beside it have more text), or for one with more than half of the page's text, unless it is
named as comments or stands beside an article or main element with text of its own: it may
outgrow that. A word for reader comments counts in any name, unless hardly a text lies outside
the element: then it is around the story, too. Ids of sections and paragraphs of an article name their subject.

Defined cases: null and empty pages give an empty text; broken markup is read as far as
the parser understands it; repeated rows are extracted each; further columns pass through
unless they are named ``main_text``, which is replaced.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from hearthlog.llm.worker import slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Width of the smoothing, in blocks.
SIGMA = 1.0

# HTML elements by role.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_BREAKS = set(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li "
    "main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
_NO_CONTENT = set(
    "head title script style noscript template nav aside footer form button select textarea "
    "iframe object svg canvas dialog menu label fieldset datalist audio video map".split()
)
_REGIONS = set("article main section div td body".split())
_ARTICLES = {"article", "main"}
#: A start tag ends open elements of these kinds, as far as the fence elements.
_ENDS = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
_FENCES = set("ul ol dl table tbody thead tfoot select".split())
_ENDS_P = _BREAKS - {"br", "option", "td", "th", "tr", "tbody", "thead", "tfoot", "body", "html"}
# Words in classes and ids, and roles, of parts that are no article text.
_HINTS = set(
    "ad ads adv advert adverts advertisement advertising adsense adslot banner sponsor sponsored "
    "promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup login sidebar sidenav rail menu menus nav navbar "
    "navigation breadcrumb breadcrumbs pagination pager footer comment comments commentlist "
    "disqus respond reply replies share sharing social related recommended widget widgets search "
    "toolbar masthead topbar".split()
)
_HEADER_HINTS = {"header"}
_ROLES = set(
    "navigation banner contentinfo complementary search dialog alertdialog alert form menu "
    "menubar toolbar".split()
)
#: Words that say nothing beside a hint: a sidebar-left is a sidebar.
_LAYOUT = set(
    "area bar block body bottom box button buttons col column container content form global group holder icons "
    "inner item items left link links list module outer page panel post posts primary right row "
    "secondary section site slot text title top unit wrap wrapper".split()
)
_DISCUSSION = set("comment comments commentlist disqus respond reply replies".split())
_ARTICLE_HINTS = {"comment", "comments", "reply", "ad", "advert", "related"}
_HEADINGS = set("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Elements whose id, in an article, is the target of a link to what they say.
_TARGETS = set("section p li dt dd blockquote figure table".split())
_KEEP = {"html", "body", "main"}
_SENTENCE_END = re.compile(r"[.!?\u2026:;]\W*$")
_COPYRIGHT = re.compile(r"\W*(?:\u00a9|\(c\)|copyright|all rights reserved)", re.IGNORECASE)
_NAMES = re.compile(r"[A-Za-z0-9]+")
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


class PageBlocks(HTMLParser):
    """Collects ``blocks`` of [text pieces, tags, region, mark, characters in links].

    A mark is an element whose name hints at no content.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, int, int]] = []  # name, no content, region, mark
        self.places: dict[str, list[int]] = {}  # where in ``open`` the elements of a name are
        self.blocks: list[list] = []
        # Name, and the article and the main element that a region is or lies in.
        self.regions: list[tuple[str, int, int]] = [("page", -1, -1)]
        # Parent, hint alone, discussion, a discussion by a word among others, beside
        # articles, holds one.
        self.marks: list[list] = []
        self._fresh = True

    def _push(self, tag: str, silent: bool, region: int, mark: int) -> None:
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, silent, region, mark))

    def _close_from(self, at: int) -> None:
        while len(self.open) > at:
            self.places[self.open.pop()[0]].pop()

    def _last(self, names: set[str]) -> int:
        """Where the innermost open element of these names is, or -1."""
        return max((p[-1] for name in names if (p := self.places.get(name))), default=-1)

    def _silent(self) -> bool:
        return bool(self.open) and self.open[-1][1]

    def _region(self) -> int:
        return self.open[-1][2] if self.open else 0

    def _mark(self) -> int:
        return self.open[-1][3] if self.open else -1

    def _inside(self, names: set[str]) -> bool:
        return any(self.places.get(name) for name in names)

    def _no_content(self, tag: str, attrs: list) -> bool:
        if tag in _NO_CONTENT:
            return True
        if tag in _KEEP:
            return False
        in_article = self._inside(_ARTICLES)
        if tag == "header":
            return not in_article
        values = dict(attrs)
        style = (values.get("style") or "").replace(" ", "").lower()
        if "hidden" in values or values.get("aria-hidden") == "true" or "display:none" in style:
            return True
        if tag not in _BREAKS:
            return False  # a class within a line names a word, not a part of the page
        if (values.get("role") or "").lower() in _ROLES:
            return True
        return False

    def _hinted(self, tag: str, attrs: list) -> tuple[bool, bool, bool] | None:
        """Whether a name is made of hints alone, of a discussion, or has one in it.

        None without hints.
        """
        if tag not in _BREAKS or tag in _KEEP or tag in _HEADINGS:
            return None
        values = dict(attrs)
        classes, own_id = (values.get("class") or "").split(), (values.get("id") or "").split()
        if not classes and not own_id:
            return None
        in_article = self._inside(_ARTICLES)
        if tag == "article":
            hints = _ARTICLE_HINTS
        else:
            hints = _HINTS if in_article else _HINTS | _HEADER_HINTS
        known = hints | _LAYOUT
        hinted = alone = discussion = mentioned = False
        for name in classes + own_id:
            split = {w.lower() for w in _WORDS.findall(name)}
            whole = {w.lower() for w in _NAMES.findall(name)}
            found = (split | whole) & hints
            if not found:
                continue
            hinted = True
            target = in_article and tag in _TARGETS and name not in classes
            if not target and (split <= known or {w for w in whole if not w.isdigit()} <= known):
                alone = True
                discussion |= bool(found & _DISCUSSION)
            elif not target:
                mentioned |= bool(found & _DISCUSSION)
        return (alone, discussion, mentioned) if hinted else None

    def _end_implied(self, ends: set[str], fences: set[str]) -> None:
        at = self._last(ends)
        if at > self._last(fences - ends):
            self._close_from(at)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _ENDS:
            self._end_implied(_ENDS[tag], _FENCES - {"tbody", "thead", "tfoot"})
        if tag in _ENDS_P:
            self._end_implied({"p"}, _REGIONS | _FENCES | {"li", "blockquote", "button", "th"})
        if tag in _BREAKS:
            self._fresh = True
        if not self._silent():
            self._count_tag()
        if tag in _VOID:
            return
        silent = self._silent() or self._no_content(tag, attrs)
        region, mark = self._region(), self._mark()
        if tag in _REGIONS and not silent:
            self._open_region(tag, region)
            region = len(self.regions) - 1
        if not silent:
            if tag in _ARTICLES:
                at = mark
                while at >= 0 and not self.marks[at][-1]:
                    self.marks[at][-1] = True
                    at = self.marks[at][0]
            if hinted := self._hinted(tag, attrs):
                beside = not self._inside(_ARTICLES)
                self.marks.append([mark, *hinted, beside, False])
                mark = len(self.marks) - 1
        self._push(tag, silent, region, mark)

    def _open_region(self, tag: str, parent: int) -> None:
        """The outermost article, else the innermost main element, owns what is in it."""
        _, article, main = self.regions[parent]
        own = len(self.regions)
        if article < 0 and tag == "article":
            article = own
        self.regions.append((tag, article, own if tag == "main" else main))

    def owner(self, region: int) -> int:
        """The article or main element around a region, else the region itself."""
        _, article, main = self.regions[region]
        return article if article >= 0 else main if main >= 0 else region

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        # A slash does not close an HTML element.
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in _BREAKS:
            self._fresh = True
        if not self._silent():
            self._count_tag()
        if places := self.places.get(tag):
            self._close_from(places[-1])

    def _count_tag(self) -> None:
        if self.blocks and not self._fresh:
            self.blocks[-1][1] += 1

    def handle_data(self, data: str) -> None:
        if self._silent():
            # What is left out still parts the text around it.
            return
        mark = self._mark()
        if self._fresh or not self.blocks or self.blocks[-1][2] != self._region():
            if not data.strip():
                return
            self.blocks.append([[], 1, self._region(), mark, 0])
            self._fresh = False
        self.blocks[-1][0].append(data)
        if mark >= 0 and self._inside({"a"}):
            self.blocks[-1][4] += len(" ".join(data.split()))


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Ratios after a Gaussian filter whose weights are renormalized at the page's ends."""
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    full = np.convolve(ratios, kernel)[reach : reach + len(ratios)]
    return full / np.convolve(np.ones(len(ratios)), kernel)[reach : reach + len(ratios)]


def threshold(ratios: np.ndarray) -> float:
    """The cut between two clusters of ratios: midway between their means (2-means)."""
    cut = float(ratios.mean())
    for _ in range(50):
        upper = ratios >= cut
        if upper.all() or not upper.any():
            return cut
        middle = float((ratios[upper].mean() + ratios[~upper].mean()) / 2)
        if middle == cut:
            return cut
        cut = middle
    return cut


def _left_out(parser: PageBlocks, blocks: list[tuple]) -> set[int]:
    """The marks whose blocks are no content."""
    marks = parser.marks
    size, linked, own = ([0] * len(marks) for _ in range(3))
    # Whether a mark and all around it hold an article: a mark comes after those around it.
    around = []
    for parent, *_, holds in marks:
        around.append(holds and (parent < 0 or around[parent]))
    total = plain = beside_all = 0
    for text, _, region, mark, links in blocks:
        article = parser.regions[parser.owner(region)][0] in _ARTICLES
        article &= mark < 0 or around[mark]
        total += len(text)
        plain += len(text) * (mark < 0)
        beside_all += len(text) * article
        if mark >= 0:
            size[mark] += len(text)
            linked[mark] += links
            own[mark] += len(text) * article
    for at in range(len(marks) - 1, -1, -1):
        if (parent := marks[at][0]) >= 0:
            size[parent] += size[at]
            linked[parent] += linked[at]
            own[parent] += own[at]
    out: set[int] = set()
    for at, (parent, alone, discussion, mentioned, beside, holds) in enumerate(marks):
        others = beside_all - own[at]
        most = 2 * size[at] > total and not discussion and not (beside and others)
        needed = most or (holds and others <= size[at])
        if mentioned and not (holds and others <= size[at]):
            # Reader comments may be longer than the story, but they are not all there is:
            # an element around the story and its comments leaves next to nothing beside it.
            needed, alone = max(plain, others) * 10 < size[at], True
        if parent in out or (not needed and (alone or 2 * linked[at] > size[at])):
            out.add(at)
    return out


def main_text(html: str | None) -> str:
    """The article of a page: blocks of the content regions, joined by one space."""
    parser = PageBlocks()
    parser.feed(html or "")
    parser.close()
    blocks = []
    for pieces, *rest in parser.blocks:
        if text := " ".join("".join(pieces).split()):
            blocks.append((text, *rest))
    if parser.marks:
        out = _left_out(parser, blocks)
        # A page that is nothing but hinted elements keeps them.
        blocks = [block for block in blocks if block[3] not in out] or blocks
    if not blocks:
        return ""
    texts = [block[0] for block in blocks]
    lengths = np.array([len(text) for text in texts], float)
    ratios = lengths / np.array([block[1] for block in blocks], float)
    owners = [parser.owner(block[2]) for block in blocks]
    kinds = [parser.regions[owner][0] for owner in owners]
    marked = [i for i, kind in enumerate(kinds) if kind in _ARTICLES]
    if marked and (len(marked) == len(texts) or (ratios[marked] >= threshold(smoothed(ratios))).any()):
        # Among articles and main elements a block's own ratio counts beside the smoothed
        # one, or a long block between short ones would lose to a teaser at the end.
        smooth = smoothed(ratios[marked])
        cut = threshold(smooth)
        reached = np.maximum(smooth, ratios[marked]) >= cut
        content = {owners[i] for i, high in zip(marked, reached) if high}
        return " ".join(texts[i] for i in marked if owners[i] in content)
    smooth = smoothed(ratios)
    cut = threshold(smooth)
    content = {owner for owner, ratio in zip(owners, smooth) if ratio >= cut}
    if not content:
        content = {owners[int(lengths.argmax())]}
    kept = [i for i, owner in enumerate(owners) if owner in content]
    # Nothing marks where the article ends: what lies between its regions belongs to it. At
    # the end of a page a short region without a sentence, or with a copyright, does not.
    last, full = kept[-1], {owner for owner, ratio in zip(owners, ratios) if ratio >= cut}
    while last > kept[0] and owners[last] not in full and _is_colophon(texts[last]):
        last -= 1
    return " ".join(texts[kept[0] : last + 1])


def _is_colophon(text: str) -> bool:
    return not _SENTENCE_END.search(text) or bool(_COPYRIGHT.match(text))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "html"):
        texts = [main_text(html) for html in part.column("html").to_pylist()]
        yield part.append_column("main_text", pa.array(texts, pa.string()))


def extract_main_text(pages: DataFrame) -> DataFrame:
    """``pages`` with ``main_text``."""
    pages = pages.drop("main_text")
    schema = T.StructType([*pages.schema.fields, T.StructField("main_text", T.StringType())])
    return pages.mapInArrow(_extract, schema)
