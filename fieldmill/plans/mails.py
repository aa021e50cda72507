"""Mail-text job: header fields, measures, clean tokens and topic clusters."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from ..functions.text import (
    header_fields,
    text_measures,
    with_clean_text,
    with_tokens,
    without_stopwords,
)
from ..learn.model import clustered_texts, top_terms


def prepared(mails: DataFrame, stopwords: Iterable[str], column: str = "emails") -> DataFrame:
    """Narrow transformations only: no shuffle however large the corpus is.

    Every mail stays; one without a body has null measures and tokens.
    """
    return (
        mails.withColumns(header_fields(column))
        .withColumns(text_measures("email_text"))
        .transform(with_clean_text, "email_text", "clean_text")
        .transform(with_tokens, "clean_text")
        .transform(without_stopwords, "clean_text_tokenised", list(stopwords))
    )


def clusters(prepared_mails: DataFrame, k: int = 5, terms: int = 100) -> DataFrame:
    """Most frequent terms per cluster of texts."""
    known = prepared_mails.where("clean_text_tokenised is not null").select("clean_text_tokenised")
    grouped = clustered_texts(known, "clean_text_tokenised", k)
    return top_terms(grouped, "clean_text_tokenised", "cluster", terms)
