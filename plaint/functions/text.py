"""Text columns: cleaning, shortening, and the plain text of markup."""

from __future__ import annotations

import html

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from plaint.functions.columns import column

# The characters that end a line, the length of a short comment and its ending.
LINE_ENDS = r"[\r\n\x85\u2028-\u2029]+"
SHORT_LENGTH = 200
SHORT_ENDING = "…"

# Whitespace that Python's str.strip() removes, as a Java character class body.
_SPACE = r"\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Stands for a tag while character references are decoded; NUL cannot occur in HTML text.
_TAG = "\u0000"


def one_line(text: Column | str) -> Column:
    """Drop double quotes, then turn every run of line ends into one space. Nothing is trimmed."""
    return F.regexp_replace(F.replace(column(text), F.lit('"'), F.lit("")), LINE_ENDS, " ")


def or_blank(text: Column | str) -> Column:
    """NULL becomes the empty string."""
    return F.coalesce(column(text), F.lit(""))


def short_comment(text: Column | str, length: int = SHORT_LENGTH) -> Column:
    """The first ``length`` characters; the ending is always there, also after a short text."""
    return F.concat(or_blank(F.substring(column(text), 1, length)), F.lit(SHORT_ENDING))


def bullet_line(text: Column | str) -> Column:
    """The text as one item of a list."""
    return F.concat(F.lit("- "), column(text))


def decode_entities(text: Column | str) -> Column:
    """Replace every character reference of HTML in one pass.

    The 2,231 names have no built-in function. Only text that holds an ampersand goes to Python.
    """

    @F.arrow_udf("string")
    def unescape(texts: pa.Array) -> pa.Array:
        decoded = [None if t is None else html.unescape(t) for t in texts.to_pylist()]
        return pa.array(decoded, pa.string())

    # Without this, a filter on the result is pushed below and every text goes to Python twice.
    decode = unescape.asNondeterministic()
    text = column(text)
    return F.coalesce(decode(F.when(F.contains(text, F.lit("&")), text)), text)


def element_text(markup: Column | str) -> Column:
    """The text inside an element: every piece of text between tags, trimmed and joined.

    A missing element, which the extractor gives as NULL, has the text ''.
    """
    untagged = F.regexp_replace(column(markup), r"(?s)<!--.*?-->|<[^>]*>", _TAG)
    pieces = decode_entities(untagged)
    joined = F.regexp_replace(pieces, f"[{_SPACE}]*{_TAG}[{_SPACE}]*", "")
    return or_blank(F.regexp_replace(joined, f"^[{_SPACE}]+|[{_SPACE}]+$", ""))
