"""Main text of web pages by two-pass passage rules (operator 5).

*Passages.*  A page is cut into passages of text at passage-level tags.  A passage knows its length,
the share of its characters inside links, the share of its words that are stop words, and
the elements it lies in.

*First pass.*  A passage inside an element that is by its name, role, class or id a menu,
header, footer, sidebar, notice, advert, form or comment section is bad, and so is one that
is mostly links.  Classes count as whole: ``has-sidebar`` is no sidebar.  If a page has nothing
good but an article or main element in a bad one (a form around the page, a wrapper named after
its sidebar; not comments or teasers), that starts clean.  A passage with enough stop words, long
enough and with few links is good.  Everything else is undecided: short passages (headings,
one-line paragraphs), and passages with few stop words inside an article element; a long passage
with few stop words elsewhere is bad.  On a page with few stop words as a whole (another
language), a long passage with few links is good without them.

*Second pass.*  Undecided passages take the label of the nearest decided passage of the element
they lie in, else of their section; if there is none, an article is good, and elsewhere the
nearest decided passages of the page count.  Of two different ones at the same distance, both
must be good, in an article one.

Scanning is linear in the page: a page of any length is taken whole, and unclosed or
misnested tags do not matter.  Defined results: a null or empty page, or one without
content, has an empty text; repeated pages are extracted alike; null ids and urls are kept;
further columns are not looked at.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import plain, slices

LONG, SHORT = 140, 60
MANY_STOP, FEW_STOP = 0.20, 0.10
MANY_LINKS, SOME_LINKS = 0.5, 0.25

#: Frequent function words (fixed values; English, German, French, Spanish).
STOP_WORDS = frozenset("""
the and of to a in is it that was for on are as with his they at be this from have or by one
had not but what all were when we there can an your which their if will each about how up out
der die das und ist in zu den von mit sich des auf für nicht ein eine als auch es an werden aus
er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur
le la les de des du et un une est en que qui dans pour pas sur au avec ce il plus par ne se sont
el los las y del que un una con no por para su al lo como más pero sus le ya o este sí porque
""".split())

BAD_TAGS = frozenset("nav footer aside form button select option menu dialog noscript template svg math canvas "
                     "object audio video fieldset label input map".split())
#: Words of class, id and role that name what is not the article.
BAD_NAMES = frozenset("""
nav navbar navigation menu breadcrumb breadcrumbs pagination pager header masthead topbar footer colophon
sidebar aside rail widget widgets ad ads adv advert adverts advertisement adbox adsense banner sponsor sponsored
promo promotion cookie cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe
subscription signup login signin search searchbox form share sharing social related recommended recommendations
comment comments disqus reply replies respond discussion complementary contentinfo toolbar skip hidden
""".split())
ARTICLE_NAMES = frozenset("article main post entry content story articlebody maincontent".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""
a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span
strike strong sub sup time tt u var wbr
""".split())
#: Passage elements that hold text rather than other passages.
PARTS = frozenset("p h1 h2 h3 h4 h5 h6 passagequote pre li dt dd html body".split())
#: Start tags that end an open element of the given names.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
        "th": ("td", "th"), "option": ("option",), "a": ("a",)}
_TAG_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_TAG_STOP = re.compile(r"[>\"']")
_ATTR = re.compile(r"([a-zA-Z][\w:-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_NAME = re.compile(r"[a-z]+")
#: Parts of a class that say what a page has or lacks rather than what an element is.
STATES = frozenset("has have no not with without is".split())
#: Parts that go with the name of an element without changing what it is.
FILLERS = frozenset("wrap wrapper container box area list item inner outer section holder group row col".split())
#: Bad names whose elements hold articles of their own (comments, teasers): no article starts
#: anew inside them.
HARD_NAMES = frozenset("""
nav navbar navigation menu breadcrumb breadcrumbs pagination pager footer colophon hidden share sharing social
related recommended recommendations comment comments disqus reply replies respond discussion contentinfo
ad ads adv advert adverts advertisement adbox adsense sponsor sponsored promo promotion
""".split())
HARD_TAGS = frozenset("nav footer button select option menu dialog noscript template svg math canvas object audio "
                      "video".split())
_WORD = re.compile(r"[^\W\d_]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Passage:
    __slots__ = ("text", "links", "bad", "article", "inner", "section", "box")

    def __init__(self, text: str, links: int, bad: bool, article: bool, inner: bool, section: int, box: int):
        self.text, self.links, self.bad, self.article = text, links, bad, article
        self.inner = inner  # inside an article that is inside a bad element, but good in itself
        self.section, self.box = section, box  # numbers of the elements it lies in; 0: none


def _named(word: str) -> str | None:
    """The bad name that a class, id or role stands for: its last part, fillers and numbers
    aside, unless a part says that the page has or lacks such a thing."""
    parts = _NAME.findall(_CAMEL.sub(" ", word).lower())
    if STATES & set(parts[:-1]):
        return None
    while len(parts) > 1 and parts[-1] in FILLERS:
        parts.pop()
    # a part for which the last one is the matter: cookie-notice, comment-form, ad-slot
    first = parts[0] if parts and parts[0] in BAD_NAMES and parts[-1] not in ARTICLE_NAMES else None
    return parts[-1] if parts and parts[-1] in BAD_NAMES else first


def _attributes(raw: str) -> tuple[bool, bool, bool]:
    """Whether a start tag's attributes name a bad part, one that holds articles of its own,
    and whether an article."""
    bad = hard = article = False
    for m in _ATTR.finditer(raw):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key in ("class", "id", "role"):
            for word in value.split():
                name = _named(word)
                bad, hard = bad or name is not None, hard or name in HARD_NAMES
                article = article or word.lower().replace("-", "").replace("_", "") in ARTICLE_NAMES
        elif key == "hidden" or key == "aria-hidden" and value == "true":
            bad = hard = True
        elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value.lower()):
            bad = hard = True
    return bad, hard, article


class _Page:
    def __init__(self):
        self.passages: list[Passage] = []
        self.stack: list[tuple[str, bool, bool, bool, bool, int, int]] = []  # name, and the state outside it
        self.open: dict[str, int] = {}
        self.bad, self.hard, self.article, self.inner = False, False, False, False
        self.section, self.box, self.boxes = 0, 0, 0
        self.parts: list[str] = []
        self.links, self.in_link = 0, False

    def text(self, s: str) -> None:
        if s:
            s = html.unescape(s)
            self.parts.append(s)
            if self.in_link:
                self.links += len("".join(s.split()))

    def end_passage(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.passages.append(Passage(text, self.links, self.bad, self.article, self.inner, self.section, self.box))
        self.parts, self.links, self.in_link = [], 0, False

    def start(self, name: str, attrs: str) -> None:
        passage = name not in INLINE
        if passage:
            self.end_passage()
            if self.open.get("p"):
                self.close("p", within=True)
        for other in ENDS.get(name, ()):
            if self.open.get(other):
                self.close(other, within=True)
        if name == "br":
            self.parts.append(" ")
        if name == "a":
            self.in_link = True
        if name in VOID:
            return
        bad, hard, article = _attributes(attrs) if attrs.strip() else (False, False, False)
        if name in BAD_TAGS or name == "header" and not (self.article or self.inner):
            bad, hard = True, hard or name in HARD_TAGS
        self.stack.append((name, self.bad, self.hard, self.article, self.inner, self.section, self.box))
        self.open[name] = self.open.get(name, 0) + 1
        if name in ("article", "main"):
            article = True
            if self.bad and not (self.hard or bad or self.article):
                self.inner = True
        if bad and name not in ("body", "html"):
            self.bad, self.hard, self.inner = True, self.hard or hard, False
        if article and not bad and not self.article:
            self.article = True
        if passage and name not in PARTS:
            self.boxes += 1
            self.box = self.boxes
            if name in ("article", "main", "section") or article:
                self.section = self.box

    def close(self, name: str, within: bool = False) -> None:
        """End the innermost open element of this name; ``within``: only if no container
        was opened inside it."""
        if not self.open.get(name):
            return
        if within:
            for k in range(len(self.stack) - 1, -1, -1):
                if self.stack[k][0] == name:
                    break
                if self.stack[k][0] not in INLINE:
                    return
        while self.stack:
            n, self.bad, self.hard, self.article, self.inner, self.section, self.box = self.stack.pop()
            self.open[n] -= 1
            if n == name:
                return

    def end(self, name: str) -> None:
        if name not in INLINE:
            self.end_passage()
        if name == "a":
            self.in_link = False
        self.close(name)


def _tag_end(page: str, pos: int, unclosed: set[int]) -> int:
    """Where the start tag whose attributes begin at ``pos`` ends, -1 if a quote in it is never
    closed.  ``unclosed``: quotes that are known to lead to such an end, so that no part of a
    page is read in vain twice."""
    opened = []
    while True:
        m = _TAG_STOP.search(page, pos)
        if m and m[0] == ">":
            return m.start()
        if m and m.start() not in unclosed:
            opened.append(m.start())
            pos = page.find(m[0], m.end()) + 1
            if pos:
                continue
        unclosed.update(opened)
        return -1


def passages(page: str) -> list[Passage]:
    """The passages of a page in page order."""
    p, pos, n = _Page(), 0, len(page)
    unclosed: set[int] = set()
    while pos < n:
        lt = page.find("<", pos)
        if lt < 0:
            p.text(page[pos:])
            break
        p.text(page[pos:lt])
        nxt = page[lt + 1: lt + 2]
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 2)
            pos = n if end < 0 else end + 3
        elif nxt in ("!", "?"):
            end = page.find(">", lt)
            pos = n if end < 0 else end + 1
        elif nxt == "/" and page[lt + 2: lt + 3].isalpha():
            end = page.find(">", lt)
            name = page[lt + 2: n if end < 0 else end].split("/")[0].split(None, 1)[0].lower()
            p.end(name)
            pos = n if end < 0 else end + 1
        elif nxt.isascii() and nxt.isalpha():
            m = _TAG_NAME.match(page, lt + 1)
            end = _tag_end(page, m.end(), unclosed)
            if end >= 0:
                name, attrs, pos = m[0].lower(), page[m.end():end], end + 1
            else:
                end = page.find(">", lt)
                if end < 0:
                    break  # a tag that the page's end cuts off
                name = page[lt + 1:end].split(None, 1)[0].split("/")[0].lower()
                attrs, pos = "", end + 1
            if name in RAW:
                if name not in INLINE:
                    p.end_passage()
                shut = re.compile(rf"</{name}\b[^>]*>?", re.I).search(page, pos)
                pos = shut.end() if shut else n
            else:
                p.start(name, attrs)
        else:
            p.text("<")
            pos = lt + 1
    p.end_passage()
    return p.passages


def _stop_words(b: Passage) -> tuple[int, int]:
    words = _WORD.findall(b.text.lower())
    return sum(w in STOP_WORDS for w in words), len(words)


def _links(b: Passage) -> float:
    return b.links / max(1, len(b.text) - b.text.count(" "))


def _first_pass(b: Passage, known: bool) -> bool | None:
    """``known``: whether the page is in a language whose stop words are known; in others a long
    passage with few links is good."""
    size, links = len(b.text), _links(b)
    if b.bad or links > MANY_LINKS:
        return False
    stop, words = _stop_words(b)
    stop /= max(1, words)
    if not known and size >= LONG and links <= SOME_LINKS:
        return True
    if size >= SHORT and stop >= MANY_STOP and links <= SOME_LINKS or size >= LONG and stop >= FEW_STOP and links <= SOME_LINKS:
        return True
    if size < LONG or b.article:
        return None
    return False


def _first(found: list[Passage]) -> list[bool | None]:
    seen = [_stop_words(b) for b in found if not b.bad and _links(b) <= SOME_LINKS]
    known = sum(s for s, _ in seen) >= FEW_STOP * sum(w for _, w in seen)
    return [_first_pass(b, known) for b in found]


def main_text(page: str | None) -> str:
    """The main text of a page: its good passages in page order, joined by one space."""
    found = passages(page or "")
    first = _first(found)
    if not any(first) and not any(b.article and not b.bad for b in found) and any(b.inner for b in found):
        for b in found:  # what there is of an article lies in a bad element: it starts clean
            b.bad, b.article = not b.inner, b.inner
        first = _first(found)
    n = len(found)
    # nearest decided passages on either side: of the element, of the section, of the page
    near = [[[None, None], [None, None], [None, None]] for _ in range(n)]
    for side, order in ((0, range(n)), (1, range(n - 1, -1, -1))):
        last: list[dict[int, int]] = [{}, {}, {}]
        for k in order:
            places = (found[k].box, found[k].section, 0)
            for level, place in enumerate(places):
                if place or level == 2:
                    near[k][level][side] = last[level].get(place)
                    if first[k] is not None and (level == 2 or not found[k].bad):
                        last[level][place] = k
    return " ".join(b.text for k, b in enumerate(found)
                    if (first[k] if first[k] is not None else _second_pass(k, b, near[k], first)))


def _second_pass(k: int, b: Passage, near: list, first: list[bool | None]) -> bool:
    for level, sides in enumerate(near):
        if level == 2 and b.article:
            return True
        sides = sorted((s for s in sides if s is not None), key=lambda s: abs(s - k))
        if sides:
            labels = [first[s] for s in sides if abs(s - k) == abs(sides[0] - k)]
            return any(labels) if b.article else all(labels)
    return False


def extract(spark: SparkSession, pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""
    def run(batches):
        for batch in slices(batches):
            texts = [main_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = plain(pages, page_id=id_col, url=url_col, html=html_col)
    rows = rows.withColumn("page_id", F.col("page_id").cast("long"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
