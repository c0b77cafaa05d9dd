"""Cleaning, filtering and exact de-duplication of documents."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slantwise import constants as K
from slantwise.functions import text as tx
from slantwise.operators.language import LanguageProfiles


def filter_length(
    df: DataFrame, min_chars: int = K.MIN_CHARS, max_chars: int | None = K.MAX_CHARS, text_col: str = "text"
) -> DataFrame:
    """Keep texts of ``min_chars``..``max_chars`` characters (``None``: no upper bound); null text is dropped."""
    length = F.char_length(F.col(text_col))
    return df.where(length >= min_chars if max_chars is None else length.between(min_chars, max_chars))


def filter_language(
    df: DataFrame,
    target: str | None = "en",
    text_col: str = "text",
    words: Mapping[str, Iterable[str]] = K.FUNCTION_WORDS,
    profiles: LanguageProfiles | None = None,
) -> DataFrame:
    """Keep texts detected as ``target``; ``None`` switches the filter off.

    With ``profiles``, learned from labelled texts, character n-grams decide, for any
    number of languages; without labelled texts the function ``words`` do.
    """
    if target is None:
        return df
    text = F.col(text_col)
    return df.where((profiles.detect(text) if profiles else tx.detect_language(text, words)) == target)


def deduplicate(df: DataFrame, text_col: str = "text", order_col: str = "doc_id") -> DataFrame:
    """One row per text, blind to case and whitespace: the first by ``order_col``.

    A rank filter of 1 becomes a group limit on the map side, so each task sends
    at most one row per text and a text copied into a third of the corpus does
    not pile up in one reducer.
    """
    first = Window.partitionBy("_text_hash").orderBy(order_col)
    return (
        df.withColumn("_text_hash", tx.text_hash(F.col(text_col)))
        .withColumn("_rank", F.row_number().over(first))
        .where("_rank = 1")
        .drop("_rank", "_text_hash")
    )


def normalize(df: DataFrame, text_col: str = "text") -> DataFrame:
    return df.withColumn(text_col, tx.normalize_text(F.col(text_col)))


def preprocess(
    df: DataFrame,
    min_chars: int = K.MIN_CHARS,
    max_chars: int | None = None,
    language: str | None = "en",
    normalize_unicode: bool = True,
    dedup: bool = True,
    text_col: str = "text",
    order_col: str = "doc_id",
    profiles: LanguageProfiles | None = None,
) -> DataFrame:
    """Length filter, language filter, clean-up, de-duplication, length filter."""
    out = filter_length(df, min_chars, max_chars, text_col)
    out = filter_language(out, language, text_col, profiles=profiles)
    if normalize_unicode:
        out = normalize(out, text_col)
    if dedup:
        out = deduplicate(out, text_col, order_col)
    return filter_length(out, min_chars, max_chars, text_col)
