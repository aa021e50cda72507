"""Mail headers, text measures, cleaning and tokens."""

from __future__ import annotations

import re
import string
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Header patterns and body markers.
NAMED_SENDER = r'From:\s*"?([^"<]+)"?\s*<([^>]+)>'
BARE_SENDER = r"From:\s*([^<\n\s]+)"
SUBJECT = r"Subject:\s*([^\n]*)"
READ_MARK = "Status: RO"
BODY_MARK = "Status: O"
# Cleaning patterns. `[^\n]` keeps a tag within its line.
TAG = r"<[^\n]*?>"
NOT_LETTERS = r"[^a-zA-Z]+"


def _literal(text: str) -> str:
    """Regular expression that matches ``text`` itself.

    Plain text stays unquoted, because Java splits at one plain character
    without a regular expression.
    """
    return text if re.fullmatch(r"[\w :,;=-]+", text) else r"\Q" + text + r"\E"


def extracted(column: str, pattern: str, group: int) -> Column:
    """Capture group of the first match; null without a match."""
    c = F.col(column)
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def header_fields(column: str) -> dict[str, Column]:
    """Sender address and name, subject, and the body after the status line."""
    return {
        "sender_email": F.coalesce(
            extracted(column, NAMED_SENDER, 2), extracted(column, BARE_SENDER, 1)
        ),
        "sender_name": extracted(column, NAMED_SENDER, 1),
        "subject": extracted(column, SUBJECT, 1),
        "email_text": body(column),
    }


def body(column: str) -> Column:
    """Second piece of the text cut at the body mark.

    Only the first read mark counts as a body mark as well.
    """
    first_mark = F.locate(READ_MARK, F.col(column))
    marked = F.when(
        first_mark > 0,
        F.overlay(F.col(column), F.lit(BODY_MARK), first_mark, F.lit(len(READ_MARK))),
    ).otherwise(F.col(column))
    return F.get(F.split(marked, _literal(BODY_MARK)), 1)


def text_measures(column: str) -> dict[str, Column]:
    """Length, share of capitals, and share of characters that are neither
    ASCII letters nor spaces (named ``percent_digits``)."""
    c, size = F.col(column), F.length(column)
    no_capitals = F.translate(c, string.ascii_uppercase, "")
    others = F.translate(c, string.ascii_letters + " ", "")
    return {
        f"{column}_length": size,
        f"{column}_percent_capital": F.try_divide(size - F.length(no_capitals), size),
        f"{column}_percent_digits": F.try_divide(F.length(others), size),
    }


def cleaned(column: str) -> Column:
    """Tags and everything but letters to spaces, spaces squeezed, lower case.

    A run of anything but letters ends as one space, whatever it is made of, so
    one replacement does the work of two.
    """
    c = F.col(column)
    untagged = F.when(c.contains("<"), F.regexp_replace(c, TAG, " ")).otherwise(c)
    return F.lower(F.regexp_replace(untagged, NOT_LETTERS, " "))


def tokens(column: str, separator: str = " ") -> Column:
    """Pieces between literal separators, empty ones included."""
    return F.split(F.col(column), _literal(separator))


def kept_tokens(column: str, stopwords: Iterable[str], min_length: int = 3) -> Column:
    """Tokens that are no stop words and have at least ``min_length`` characters."""
    words = sorted(set(stopwords))

    def keep(token: Column) -> Column:
        long_enough = F.length(token) >= min_length
        return long_enough & ~token.isin(*words) if words else long_enough

    return F.filter(F.col(column), keep)


def with_clean_text(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    return df.withColumn(name or column, cleaned(column))


def with_tokens(df: DataFrame, column: str, separator: str = " ") -> DataFrame:
    return df.withColumn(f"{column}_tokenised", tokens(column, separator))


def without_stopwords(df: DataFrame, column: str, stopwords: Iterable[str]) -> DataFrame:
    return df.withColumn(column, kept_tokens(column, stopwords))
