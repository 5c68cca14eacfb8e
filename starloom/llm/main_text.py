"""Main text of web pages: subtrees that recur across the pages of a host are taken out, the article is kept.

A first pass hashes every element of a page, bottom-up, with its tag, classes, text and children. Spark counts for
each host on how many different pages a hash occurs; those on many pages are the site's template. A second pass deletes these
subtrees, and what its tag, role or class marks as no part of an article, and joins the blocks of what is left. Both
passes go through a page once, forwards, with a stack of open elements; the second notes texts, begins and ends on the
way and takes the blocks from these notes.

If a page has an ``article`` (or ``main``), the text is taken from it. Inside of it a recurring subtree goes only if
it consists of links for the most part: prose that copies of an article share is not a template.

Copies of a page, under one address or several, count as one page. The page, its body, what holds its content and
what makes up nearly all of its text are never a template, nor are they evidence of one: what lies inside such an
element (or in the content) is counted once for all pages that hold the same one.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Collection, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.batches import bound_batches
from starloom.operators import joins
from starloom.session import stage
from starloom.sources.markup import scan

LEAST_PAGES = 4  # different ones of a host, from which on a subtree belongs to the template, whatever the host's size
NEARLY_ALL = 0.9  # of the text of a page (or of its content)
LISTED = 2_000  # elements of a host's template that may go along with each of its pages
FAIR, HALF = 0.2, 0.5  # of a page's text: that a content element holds at least; that a marked wrapper of one does

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
_DROPPED = frozenset(
    "aside button canvas dialog embed footer form head iframe input menu nav noscript object option script select "
    "style svg template textarea title".split())
_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
_MARKS = frozenset(
    "ad ads adsense advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer gdpr login menu modal nav navbar navigation newsletter notice notices pager pagination popup promo "
    "recommended related replies reply share sharing sidebar signup skip social sponsor sponsored subscribe toolbar "
    "widget".split())
# Which open elements a start tag ends, up to the nearest of the second set.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_NEVER = frozenset(("html", "body", "article", "main"))
_PARAGRAPH = frozenset(("p",))
_AROUND_PARAGRAPH = frozenset(("table", "td", "th", "li", "div", "section", "article", "button"))
_AROUND_INLINE = frozenset(("article", "main", "body", "td", "li"))
_NOTHING: frozenset[str] = frozenset()


@dataclass
class _Open:
    tag: str
    number: int
    dropped: bool
    hashed: object = None
    inside: bool = False  # the content element
    text: int = 0
    linked: int = 0
    kept: int = 0  # text outside of what is marked
    holds: bool = False  # the content element, somewhere below
    soft: bool = False  # marked by a name, not by its tag alone
    wraps: bool = False  # an article or main, marked or not, somewhere below


def _marked(tag: str, named: dict[str, str]) -> bool:
    """The tag, role or class says that this is no part of an article."""
    if tag in _DROPPED:
        return True
    if tag in _NEVER:
        return False
    if not named:
        return False
    if "hidden" in named or named.get("aria-hidden") == "true":
        return True
    if "style" in named and re.search(r"display\s*:\s*none", named["style"], re.I):
        return True
    if "role" in named and named["role"].lower() in _ROLES:
        return True
    if "class" not in named and "id" not in named:
        return False
    names = f"{named.get('class') or ''} {named.get('id') or ''}"
    return _marks(names) if len(names) <= _SHORT else _marks.__wrapped__(names)


_SHORT = 256  # characters of the names that are remembered


@lru_cache(maxsize=4_096)
def _marks(names: str) -> bool:
    """Whether one of the words in a class and an identifier is a mark; a site has few of them, on all pages."""
    return not _MARKS.isdisjoint(re.split(r"[^a-z0-9]+", names.lower()))


_DEPTH = 512  # elements below this depth are only counted; their text belongs to the last one above it
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")


def _named(attributes: str) -> dict[str, str]:
    if not attributes:
        return {}
    pairs = reversed(_ATTRIBUTE.findall(attributes))  # of repeated ones the first counts
    return {k.lower(): entities.unescape(v.strip("\"'")) for k, v in pairs}


class _Walker:
    """Goes through a page and keeps the stack of open elements, with the end tags that may be left out put in."""

    def __init__(self, spared: frozenset[int] = frozenset()) -> None:
        self.stack: list[_Open] = []
        self.open_tags: dict[str, int] = {}
        self.count = 0
        self.spared = spared  # marked elements that hold the text of the page
        self.deep = self.hidden = 0  # open elements below the bound, and how many there were when a marked one began

    def opened(self, element: _Open, attrs: dict[str, str]) -> None: ...

    def ended(self, element: _Open) -> None: ...

    def _pop(self) -> None:
        element = self.stack.pop()
        self.open_tags[element.tag] -= 1
        self.ended(element)

    def _end(self, tags: Collection[str], stop: Collection[str]) -> None:
        for tag in tags:
            if self.open_tags.get(tag):
                break
        else:
            return
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at].tag in tags:
                while len(self.stack) > at:
                    self._pop()
                return
            if self.stack[at].tag in stop:
                return

    def _start(self, tag: str, attrs: dict[str, str]) -> None:
        if tag in _BLOCK:
            self._end(_PARAGRAPH, _AROUND_PARAGRAPH)
        if tag in _CLOSES:
            self._end(*_CLOSES[tag])
        marked = _marked(tag, attrs)
        element = _Open(tag, self.count, (marked and self.count not in self.spared) or bool(self.stack and self.stack[-1].dropped))
        element.soft = marked and (tag == "form" or tag not in _DROPPED)
        self.count += 1
        self.opened(element, attrs)
        self.stack.append(element)
        self.open_tags[tag] = self.open_tags.get(tag, 0) + 1
        if tag in _VOID:
            self._pop()

    def _below(self, tag: str, is_end: bool, attributes: str) -> bool:
        """Whether a tag is below the bound; then it is counted, and text within a marked element is left out."""
        if not is_end and len(self.stack) >= _DEPTH and tag not in _VOID:
            self.deep += 1
            if not self.hidden and _marked(tag, _named(attributes)):
                self.hidden = self.deep
        elif is_end and self.deep and tag not in _VOID:
            self.deep -= 1
            if self.deep < self.hidden:
                self.hidden = 0
        else:
            return False
        if tag in _BLOCK:
            self.edge()
        return True

    def edge(self) -> None: ...

    def text(self, data: str) -> None: ...

    def run(self, page: str) -> None:
        for before, tag, is_end, attributes in scan(page):
            if before and not self.hidden:
                self.text(before)
            if not tag or self._below(tag, is_end, attributes):
                continue
            if is_end:
                if tag != "p" or self.open_tags.get("p"):
                    self._end((tag,), _NOTHING if tag in _BLOCK else _AROUND_INLINE)
                continue
            self._start(tag, _named(attributes))
        while self.stack:
            self._pop()


@dataclass
class _Counted:
    """An element that has ended; ``last`` is the number of the last element in it."""
    tag: str
    hashed: int
    text: int
    linked: int
    kept: int
    inside: bool
    holds: bool
    last: int


_END, _EDGE = None, ()  # on a tape: an element ends; a block begins or ends below the bound of depth


class _Census(_Walker):
    """Hash of each element, its text length and share of links, and where the content elements are."""

    def __init__(self, spared: frozenset[int] = frozenset(), noting: bool = False) -> None:
        super().__init__(spared)
        self.tape: list | None = [] if noting else None  # texts, begins (tag, number, dropped) and ends, in order
        self.elements: dict[int, _Counted] = {}
        self.content = False
        self.total = 0
        self.wrappers: dict[int, tuple[int, bool]] = {}  # marked by a name: their text, and whether an article is within
        self.kept = self.kept_inside = 0
        self.whole, self.contents = hashlib.blake2b(digest_size=8), hashlib.blake2b(digest_size=8)

    def opened(self, element: _Open, attrs: dict[str, str]) -> None:
        if self.tape is not None:
            self.tape.append((element.tag, element.number, element.dropped))
        element.hashed = hashlib.blake2b(digest_size=8)
        element.hashed.update(f"<{element.tag} {attrs.get('class') or ''}>".encode("utf-8", "surrogatepass"))
        above = bool(self.stack and self.stack[-1].inside)
        element.inside = above or (element.tag in ("article", "main") and not element.dropped)
        self.content |= element.inside

    def edge(self) -> None:
        if self.tape is not None:
            self.tape.append(_EDGE)

    def text(self, data: str) -> None:
        if self.tape is not None:
            self.tape.append(data)
        words = " ".join(data.split())
        if not words:
            return
        top = self.stack[-1] if self.stack else None
        self.total += len(words)
        (top.hashed if top else self.whole).update(words.encode("utf-8", "surrogatepass"))
        if not (top and top.dropped):
            self.kept += len(words)
            if top and top.inside:
                self.kept_inside += len(words)
        if top:
            top.text += len(words)
            top.kept += 0 if top.dropped else len(words)
            if any(self.open_tags.get(t) for t in ("a", "button")):
                top.linked += len(words)

    def ended(self, element: _Open) -> None:
        if self.tape is not None:
            self.tape.append(_END)
        digest = element.hashed.digest()
        self.elements[element.number] = _Counted(
            element.tag, int.from_bytes(digest, "little", signed=True), element.text, element.linked, element.kept,
            element.inside, element.holds, self.count - 1)
        if element.soft and element.text:
            self.wrappers[element.number] = element.text, element.wraps
        if element.inside and not (self.stack and self.stack[-1].inside):
            self.contents.update(digest)
        if self.stack:
            up = self.stack[-1]
            up.hashed.update(digest)
            up.text += element.text
            up.linked += element.linked
            up.kept += element.kept
            up.holds |= element.inside or element.holds
            up.wraps |= element.wraps or element.tag in ("article", "main")
        else:
            self.whole.update(digest)

    def wrongly_marked(self) -> frozenset[int]:
        """Elements whose name says that they are no part of an article, although they hold the text of the page."""
        return frozenset(n for n, (text, wraps) in self.wrappers.items() if n not in self.spared and (
            text >= NEARLY_ALL * self.total or wraps and not self.content and text >= HALF * self.total))

    def settle(self) -> None:
        """Content elements that hold but little of the page's text are no more than a part of it."""
        if self.content and self.kept_inside < FAIR * self.kept:
            self.content = False
            for e in self.elements.values():
                e.inside = e.holds = False

    def core(self) -> int | None:
        """Number of the innermost element with nearly all text of the page, if most of it is no links."""
        large = (n for n, e in self.elements.items()
                 if e.kept and e.kept >= NEARLY_ALL * self.kept and 2 * e.linked < e.text)
        return max(large, default=None)

    def _may_recur(self, e: _Counted) -> bool:
        if not e.text or e.tag in ("html", "body", "main"):
            return False
        if e.inside:
            return 2 * e.linked >= e.text and e.kept < NEARLY_ALL * self.kept_inside
        if e.holds:
            return False
        return self.content or 2 * e.linked >= e.text or not e.kept or e.kept < NEARLY_ALL * self.kept

    def candidates(self) -> dict[int, int]:
        """Number and hash of the elements with text that may belong to a template."""
        return {n: e.hashed for n, e in self.elements.items() if self._may_recur(e)}

    def counted(self) -> tuple[int, list[int], int, list[int]]:
        """Hash of the page and the candidates' hashes outside of its core, hash of the core and those inside.

        The core are the content elements, or else the element with nearly all text.
        """
        page = int.from_bytes(self.whole.digest(), "little", signed=True)
        found, core = self.candidates(), None if self.content else self.core()
        if self.content:
            unit = int.from_bytes(self.contents.digest(), "little", signed=True)
            inner = {n for n in found if self.elements[n].inside}
        elif core is not None:
            unit, last = self.elements[core].hashed, self.elements[core].last
            inner = {n for n in found if core < n <= last}
        else:
            unit, inner = page, set()
        around = {h for n, h in found.items() if n not in inner}
        return page, sorted(around), unit, sorted({found[n] for n in inner} - around)


def _blocks(tape: list, deleted: set[int], content: bool) -> list[str]:
    """Text blocks of the content, without marked and deleted elements, from what a census has noted."""
    blocks: list[str] = []
    parts: list[str] = []
    above: list[tuple[bool, bool, bool]] = []  # of the open elements: is a block, inside, dropped
    inside = dropped = False

    def flush() -> None:
        if block := " ".join("".join(parts).split()):
            blocks.append(block)
        parts.clear()

    for noted in tape:
        if noted.__class__ is str:
            if not dropped and (inside or not content):
                parts.append(noted)
        elif noted is _END:
            if above.pop()[0]:
                flush()
            _, inside, dropped = above[-1] if above else (False, False, False)
        elif noted is _EDGE:
            flush()
        else:
            tag, number, marked = noted
            inside = inside or tag in ("article", "main")
            dropped = dropped or marked or number in deleted or (tag == "header" and not inside)
            above.append((tag in _BLOCK, inside, dropped))
            if tag in _BLOCK:
                flush()
            elif tag == "br":
                parts.append(" ")
    flush()
    return blocks


def _census(html: str | None, noting: bool = False) -> _Census:
    """The elements of a page; it is walked again if a mark has taken its text away."""
    found = _Census(noting=noting)
    found.run(html or "")
    if spared := found.wrongly_marked():
        found = _Census(spared, noting)
        found.run(html or "")
    found.settle()
    return found


def template_candidates(html: str | None) -> tuple[int, list[int], int, list[int]]:
    """The distinct hashes of a page's elements that a template could hold; see ``_Census.counted``."""
    return _census(html).counted()


def page_text(html: str | None, template: set[int]) -> str:
    """Main text of a page, without the subtrees whose hash is in ``template``."""
    census = _census(html, noting=True)
    deleted = {n for n, h in census.candidates().items() if h in template} if template else set()
    return "\n".join(_blocks(census.tape, deleted, census.content))


def _hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = pd.DataFrame([template_candidates(h) for h in batch["html"]], columns=["page", "hashes", "core", "within"])
        yield found.assign(host=batch["host"].to_numpy(), key=batch["key"].to_numpy())


def _texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = [page_text(h, set() if t is None else set(t)) for h, t in zip(batch["html"], batch["template"], strict=True)]
        out = pd.DataFrame({"page_id": batch["page_id"].astype("Int64"), "url": batch["url"], "text": texts,
                            "n_chars": [len(t) for t in texts]})
        yield out


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """A row per page: ``page_id, url, text, n_chars``.

    NULL and empty pages give an empty text. Pages without a readable host in their address form one host. Repeated
    rows give repeated results, an empty table an empty one; other columns are ignored. A subtree belongs to the
    template of a host if it is on at least ``LEAST_PAGES`` different pages of it.
    """
    bound_batches(pages.sparkSession)
    named = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
        F.lower(F.coalesce(F.regexp_extract(F.col(url_col), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1), F.lit(""))).alias("host"),
    ).withColumn("key", F.xxhash64("page_id", "url", "html"))
    hashed = stage(named.where("html IS NOT NULL").select("host", "key", "html").mapInPandas(
        _hashes, "page long, hashes array<long>, core long, within array<long>, host string, key long"), "hashes")
    each = hashed.select("host", "key", F.explode(F.concat(
        F.transform("hashes", lambda h: F.struct(h.alias("hash"), F.col("page").alias("unit"))),
        F.transform("within", lambda h: F.struct(h.alias("hash"), F.col("core").alias("unit"))))).alias("e"),
    ).select("host", "key", "e.hash", "e.unit")
    recurring = each.groupBy("host", "hash").agg(F.count_distinct("unit").alias("n")).where(
        F.col("n") >= LEAST_PAGES).select("host", "hash")
    recurring = stage(recurring, "templates")
    of_host = recurring.groupBy("host").agg(F.collect_set("hash").alias("template"))
    most = recurring.groupBy("host").count().agg(F.max("count")).first()[0] or 0
    if most <= LISTED and joins.fits_broadcast(recurring):
        # Few and short templates go to the pages, which so stay where they are; a page looks up its own elements only.
        met = named.join(F.broadcast(of_host), "host", "left")
    else:
        template = each.join(recurring, ["host", "hash"]).groupBy("key").agg(F.collect_set("hash").alias("template"))
        met = named.join(template, "key", "left")
    return met.select("page_id", "url", "html", "template").mapInPandas(
        _texts, "page_id long, url string, text string, n_chars long")
