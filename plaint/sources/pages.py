"""List items of fetched pages."""

from __future__ import annotations

from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plaint.functions.columns import column

# The list that holds the traffic news, and its elements.
NEWS_LIST = "latest_traffic_list"
TIME_TAG = "h4"
DESCRIPTION_TAG = "p"

# Fixed values of HTML: elements that have no inside.
VOID_TAGS = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen link "
    "menuitem meta nextid param source spacer track wbr".split()
)
# Elements whose text is not text of the page.
SILENT_TAGS = frozenset("rp rt script style template".split())

_ITEMS = "array<struct<time: string, description: string>>"


def element(markup: Column | str, tag: str) -> Column:
    """Inside of the first element with this tag, in markup where none is nested in its own kind."""
    found = F.regexp_extract_all(column(markup), F.lit(rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}\s*>"), F.lit(1))
    return F.get(found, 0)


def read_pages(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Saved pages as ``page, html``: the file's path and its content as UTF-8. Bytes that are no
    UTF-8 become replacement characters."""
    files = spark.read.format("binaryFile").load(path)

    @F.arrow_udf("string")
    def text(contents: pa.Array) -> pa.Array:
        return pa.array([c.decode("utf-8", "replace") for c in contents.to_pylist()], pa.string())

    return files.select(F.col("path").alias("page"), text("content").alias("html"))


class _Item:
    """A list item that is being read: the texts of its first time and description elements."""

    def __init__(self) -> None:
        self.found: dict[str, list[str]] = {}


class ListReader(HTMLParser):
    """Reads the items of one list from a page, balanced by a stack of open elements.

    An end tag closes the last open element of its name and all that were opened in it; one that
    matches nothing is passed over; what is never closed ends with the page. So an item without an
    end tag holds the items after it, as nested lists hold theirs, and each of them is an item."""

    def __init__(self, list_id: str | None, tags: tuple[str, str]) -> None:
        super().__init__(convert_charrefs=True)
        self.list_id, self.tags = list_id, tags
        self.items: list[_Item] = []
        # Open elements: tag, item, texts.
        self.stack: list[tuple[str, _Item | None, list[str] | None]] = []
        self.open_tags: Counter[str] = Counter()
        self.inside = 0 if list_id is None else None  # height of the stack within the list
        self.over = False
        self.pieces: list[str] = []
        self.readers: list[list[str]] = []
        # Open items that have not met their first element of a tag; the innermost last.
        self.lacking: dict[str, list[_Item]] = {tag: [] for tag in tags}

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._start(tag, attrs)
        if tag in VOID_TAGS:
            self._close_last()

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._start(tag, attrs)
        self._close_last()

    def _start(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._end_piece()
        item = texts = None
        if self.inside is not None and not self.over:
            if self.lacking.get(tag):
                texts = []
                for other in self.lacking[tag]:
                    other.found[tag] = texts
                self.lacking[tag].clear()
                self.readers.append(texts)
            if tag == "li":
                item = _Item()
                self.items.append(item)
                for waiting in self.lacking.values():
                    waiting.append(item)
        self.stack.append((tag, item, texts))
        self.open_tags[tag] += 1
        if self.inside is None and tag == "ul" and dict(attrs).get("id") == self.list_id:
            self.inside = len(self.stack)

    def _close_last(self) -> None:
        self._end_piece()
        tag, item, texts = self.stack.pop()
        self.open_tags[tag] -= 1
        if item is not None:
            for waiting in self.lacking.values():
                if waiting and waiting[-1] is item:
                    waiting.pop()
        if texts is not None:
            self.readers.pop()
        if self.inside is not None and len(self.stack) < self.inside:
            self.over = True

    def handle_endtag(self, tag: str) -> None:
        while self.open_tags[tag]:
            closed = self.stack[-1][0]
            self._close_last()
            if closed == tag:
                return
        self._end_piece()

    def handle_data(self, data: str) -> None:
        if self.readers:
            self.pieces.append(data)

    def _end_piece(self) -> None:
        """A piece of text ends at every tag and comment, and is trimmed by itself."""
        if self.pieces:
            text = "".join(self.pieces).strip()
            self.pieces.clear()
            if text and not any(self.open_tags[tag] for tag in SILENT_TAGS):
                for texts in self.readers:
                    texts.append(text)

    def handle_comment(self, data: str) -> None:
        self._end_piece()

    handle_decl = handle_pi = unknown_decl = handle_comment

    def read(self, page: str) -> list[dict[str, str]]:
        try:
            self.feed(page)
            self.close()
        except AssertionError:  # a declaration that the parser refuses ends the page
            pass
        self._end_piece()
        names = ("time", "description")
        return [{n: "".join(i.found.get(t, ())) for n, t in zip(names, self.tags)} for i in self.items]


def list_items(markup: Column | str, list_id: str | None, time_tag: str, description_tag: str) -> Column:
    """The items of a page's list, as an array. Only pages with a list item go to Python."""

    @F.arrow_udf(_ITEMS)
    def read(pages: pa.Array) -> pa.Array:
        found = [None if p is None else ListReader(list_id, (time_tag, description_tag)).read(p) for p in pages.to_pylist()]
        return pa.array(found, pa.list_(pa.struct([("time", pa.string()), ("description", pa.string())])))

    markup = column(markup)
    # Without this, a filter on the items is pushed below and every page is read twice.
    return read.asNondeterministic()(F.when(F.rlike(markup, F.lit("(?i)<li")), markup))


def extract_list_items(
    pages: DataFrame,
    key: str = "page_id",
    html: str = "html",
    list_id: str | None = NEWS_LIST,
    time_tag: str = TIME_TAG,
    description_tag: str = DESCRIPTION_TAG,
) -> DataFrame:
    """``key, position, time, description``: one row per ``li`` of the first list with the id, from 0.

    Items come in the order of their start tags, those of nested lists too, and each gives the text
    of the first time and description element anywhere in it. A field whose element is missing is
    ''; a page without the list gives no row. Without an id, all items of the page are read.
    """
    items = list_items(html, list_id, time_tag.lower(), description_tag.lower())
    # The array is computed below the generator, which would keep it from being a Python expression.
    listed = pages.select(F.col(key), items.alias("_items"))
    rows = listed.select(key, F.posexplode("_items").alias("position", "item"))
    return rows.select(key, "position", "item.time", "item.description")


def either_field(items: DataFrame) -> DataFrame:
    """Items with a time or a description."""
    return items.filter((F.col("time") != "") | (F.col("description") != ""))
