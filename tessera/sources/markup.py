"""Pages read as markup: links with how they were found, and the cards of classic listings.

A page is tokenised once, whole, by the parser of Python's standard library, in Arrow batches where Spark
has put it: attributes in any quoting, comments, scripts and all character references are what they
are to a browser.  What comes out are rows; everything after that is column work.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Tags by the attribute that holds their link.
LINKED = {"a": "href", "script": "src", "iframe": "src", "form": "action"}
# URLs and quoted paths anywhere in a text.
_TEXT_URL = re.compile(r"https?://[^\s\"'<>\\)]+", re.IGNORECASE)
_QUOTED_PATH = re.compile(r"""["']((?:/|\.\.?/)[^"'<>\\\s]+)["']""")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_LINK = "kind string, link string, url string, text string, pos int"
#: Rows of output that are handed on at once, about.
_BATCH = 20_000


def squeezed(text: str) -> str:
    return " ".join(text.split())


class Tokens(HTMLParser):
    """Calls :meth:`opened`, :meth:`closed` and :meth:`said` along a page; every element that opens also closes.

    An end tag closes what is open up to its own start; one without a start is passed over.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.path: list[str] = []

    def read(self, text: str | None) -> Tokens:
        self.feed(text or "")
        self.close()
        while self.path:
            self.closed(self.path.pop())
        return self

    def handle_starttag(self, tag, attrs):
        self.path.append(tag)
        self.opened(tag, {k: v or "" for k, v in attrs})
        if tag in _VOID:
            self.closed(self.path.pop())

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in self.path:
            while True:
                last = self.path.pop()
                self.closed(last)
                if last == tag:
                    break

    def handle_data(self, data):
        self.said(data)

    def opened(self, tag: str, attributes: dict[str, str]) -> None: ...

    def closed(self, tag: str) -> None: ...

    def said(self, text: str) -> None: ...


class LinkReader(Tokens):
    """Links of a page in order: (tag, link, shown text), and the texts of its scripts."""

    def __init__(self) -> None:
        super().__init__()
        self.links: list[list] = []
        self.scripts: list[str] = []
        self._texts: list[str] = []
        self._open: list[tuple[int, int]] = []

    def opened(self, tag, attributes):
        if tag == "a":
            self._open.append((len(self.links) if "href" in attributes else -1, len(self._texts)))
        if LINKED.get(tag) in attributes:
            self.links.append([tag, squeezed(attributes[LINKED[tag]]), ""])
        if tag == "script":
            self.scripts.append("")

    def closed(self, tag):
        if tag == "a":
            at, since = self._open.pop()
            if at >= 0:
                self.links[at][2] = squeezed(" ".join(self._texts[since:]))

    def said(self, text):
        if self.path and self.path[-1] == "script":
            self.scripts[-1] += text
        elif self._open and not (self.path and self.path[-1] in ("style", "template")):
            self._texts.append(text.strip())


def joined(base: str | None, link: str) -> str:
    """A link against its page's URL; a link that is no URL leads nowhere."""
    try:
        return urljoin(base or "", link)
    except ValueError:
        return ""


def written_urls(base: str | None, text: str | None) -> list[str]:
    """Absolute URLs and quoted paths that stand anywhere in a text, resolved, different and sorted."""
    plain = (text or "").replace("\\/", "/").replace("\\u002F", "/")
    found = {x.rstrip(".,;") for x in _TEXT_URL.findall(plain)}
    return sorted(found | {joined(base, x) for x in _QUOTED_PATH.findall(plain)})


def page_links(base: str | None, text: str | None) -> Iterator[tuple]:
    """(kind, link, url, text, pos): tags by their name, then ``inline`` URLs in scripts and ``written`` ones anywhere."""
    page = LinkReader().read(text)
    for pos, (tag, link, shown) in enumerate(page.links):
        yield tag, link, joined(base, link), shown, pos
    for kind, parts in (("inline", page.scripts), ("written", [text])):
        for url in sorted({x for part in parts for x in written_urls(base, part)}):
            yield kind, url, url, "", None


def exploded(rows: DataFrame, give: Callable[..., Iterator[tuple]], given: tuple[str, ...], schema: str) -> DataFrame:
    """The other columns of ``rows`` beside each row that ``give`` makes of the ``given`` columns, in Arrow batches.

    ``give`` must not fail.  Rows for which it makes nothing go.
    """
    keep = [f for f in rows.schema.fields if f.name not in given]
    made = T.StructType.fromDDL(schema)
    names = [f.name for f in made.fields]

    def run(batches):
        for batch in batches:
            at, columns = [], [[] for _ in names]

            def flushed():
                carried = batch.select([f.name for f in keep]).take(pa.array(at, pa.int64()))
                types = [pa.int32() if f.dataType == T.IntegerType() else pa.string() for f in made.fields]
                return pa.RecordBatch.from_arrays([*carried.columns, *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=[*(f.name for f in keep), *names])

            values = [batch.column(x) for x in given]
            for row in range(batch.num_rows):
                for out in give(*(v[row].as_py() for v in values)):
                    at.append(row)
                    for column, value in zip(columns, out, strict=True):
                        column.append(value)
                if len(at) >= _BATCH:
                    yield flushed()
                    at, columns = [], [[] for _ in names]
            if at:
                yield flushed()

    return rows.mapInArrow(run, T.StructType([*keep, *made.fields]))


def read_links(pages: DataFrame) -> DataFrame:
    """(..., page, kind, link, url, text, pos) of pages (url, html, ...), in one pass over them.

    ``kind`` is a, script, iframe or form for the link of such a tag, ``inline`` for a URL in a script,
    ``written`` for one anywhere in the page.  ``link`` is decoded, white space squeezed; ``url`` resolved
    against the page's URL; ``text`` what an ``a`` shows; ``pos`` its place among the page's tags.  A null
    page has no links.
    """
    rows = pages.select("*", pages["url"].alias("page"))
    return exploded(rows, page_links, ("url", "html"), _LINK)


# ---------------------------------------------------------------- cards


# The class of a card, the words before its place, and the form of its link.
CARD_CLASS = "icims_jobcarditem"
PLACE_LABELS = ("job location", "job locations", "location", "locations")
_POSTING = re.compile(r"/jobs/(\d+)(?:/.*)?/job")


class CardReader(Tokens):
    """The cards of a listing page: list items of a class, each with the texts of the elements that matter."""

    def __init__(self) -> None:
        super().__init__()
        self.cards: list[dict] = []
        self._card: dict | None = None
        self._depth = 0
        self._texts: list[list] = []

    def opened(self, tag, attributes):
        classes = attributes.get("class", "").lower()
        if self._card is None:
            if tag == "li" and CARD_CLASS in classes:
                self._card, self._depth = {"link": "", "number": "", "title": "", "posted": "", "fields": [], "spans": []}, len(self.path)
            return
        card = self._card
        if tag == "a" and not card["number"]:
            found = _POSTING.search(attributes.get("href", ""))
            if found:
                card["link"], card["number"] = attributes["href"], found[1]
        if tag == "span" and "title" in attributes:
            card["spans"].append([attributes["title"], ""])
        elif tag == "span":
            if classes.strip() == "sr-only" and len(card["spans"]) and not card["posted"] and self.path[-2:-1] == ["span"]:
                card["posted"] = card["spans"][-1][0]
            card["spans"].append(["", classes.strip()])
        if tag in ("h3", "dt", "dd", "span"):
            self._texts.append([tag, len(card["spans"]) - 1, ""])

    def said(self, text):
        for open_ in self._texts:
            open_[2] += text + " "

    def closed(self, tag):
        card = self._card
        if card is None:
            return
        if tag in ("h3", "dt", "dd", "span") and self._texts:
            kind, span, text = self._texts.pop()
            text = squeezed(text)
            if kind == "h3" and card["number"] and not card["title"]:
                card["title"] = text
            elif kind in ("dt", "dd"):
                card["fields"].append((kind, text))
            elif kind == "span":
                card["fields"].append((card["spans"][span][1] or "span", text))
        if tag == "li" and len(self.path) < self._depth:
            self.cards.append(card)
            self._card, self._texts = None, []


def _place(fields: list[tuple[str, str]]) -> str:
    """What follows the first label that has something after it: a dd after its dt, or the span after a header's."""
    pairs = list(zip(fields, fields[1:]))
    terms = [x for x in fields if x[0] in ("dt", "dd")]
    for label in PLACE_LABELS:
        for (kind, text), (after, value) in zip(terms, terms[1:]):
            if kind == "dt" and after == "dd" and text.lower().startswith(label):
                if value:
                    return value
                break
    return next((value for (kind, text), (after, value) in pairs if kind == "sr-only field-label" and text.lower() in PLACE_LABELS[:2] and after == "span"), "")


def listing_cards(text: str | None) -> Iterator[tuple]:
    """(slug, title, classic_url, full_location, posted_date, pos) of the cards of a page that have a link and a title."""
    for pos, card in enumerate(CardReader().read(text).cards):
        address, mark, query = card["link"].strip().partition("?")
        kept = "&".join(x for x in query.split("&") if x != "in_iframe=1").rstrip("&")
        url = address + (mark + kept if kept else "")
        if card["number"] and card["title"] and url:
            yield card["number"], card["title"], url, _place(card["fields"]), card["posted"].strip(), pos


CARD = "slug string, title string, classic_url string, full_location string, posted_date string, pos int"


_CARD_TYPES = {"string": (T.StringType(), pa.string()), "int": (T.IntegerType(), pa.int32())}
_CARD_FIELDS = [(name, *_CARD_TYPES[kind]) for name, kind in (x.split() for x in CARD.split(", "))]


@F.arrow_udf(T.ArrayType(T.StructType([T.StructField(name, kind) for name, kind, _ in _CARD_FIELDS])))
def page_cards(texts: pa.Array) -> pa.Array:
    """As :func:`listing_cards`, the cards of a text in one array; null for null."""
    names, made = [x[0] for x in _CARD_FIELDS], pa.list_(pa.struct([(name, kind) for name, _, kind in _CARD_FIELDS]))
    return pa.array([None if x is None else [dict(zip(names, card, strict=True)) for card in listing_cards(x)] for x in texts.to_pylist()], made)
