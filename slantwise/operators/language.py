"""Language of texts by ranked character n-gram profiles learned from labelled texts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from slantwise.functions import charngrams as cg

SIZES = (1, 2, 3)
TOP = 300
MAX_LANGUAGES = 1000
UNKNOWN = "unknown"


def letters(text: Column) -> Column:
    """Lower-cased letters; all between them, and both ends, are one space. Null without a letter."""
    words = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " "))
    return F.when(words != "", F.concat(F.lit(" "), words, F.lit(" ")))


@dataclass(frozen=True)
class LanguageProfiles:
    """Ranked n-grams per language, small enough to travel with a task.

    ``keys`` are sorted n-grams as numbers, ``weights`` their weight per language (the
    most frequent n-gram of a language weighs most, an unlisted one nothing).
    """

    languages: tuple[str, ...]
    keys: np.ndarray
    weights: np.ndarray
    sizes: tuple[int, ...] = SIZES

    def detect(self, text: Column) -> Column:
        """Language with the highest weight of the text's n-grams.

        Ties go to the alphabetically first code; a text without a listed n-gram, and
        null, is ``unknown``. The score is made inside the row; no row leaves its partition.
        """
        names, keys, weights, sizes = np.array([*self.languages, UNKNOWN], object), self.keys, self.weights, self.sizes

        def best(texts: pd.Series) -> pd.Series:
            scores = cg.label_scores(texts.tolist(), keys, weights, sizes)
            winner = scores.argmax(axis=1) if scores.shape[1] else np.zeros(len(texts), int)
            found = scores.max(axis=1, initial=0.0) > 0
            return pd.Series(names[np.where(found, winner, len(names) - 1)])

        return F.coalesce(F.pandas_udf(best, StringType())(F.coalesce(letters(text), F.lit(""))), F.lit(UNKNOWN))


def language_profiles(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", sizes: Sequence[int] = SIZES, top: int = TOP
) -> DataFrame:
    """``(lang, gram, n, rank)``: the ``top`` most frequent character n-grams per language.

    Ties in frequency go to the gram. Batches are folded before the shuffle, so one
    row per language, gram and task travels, whatever share of the rows a language
    has; the rank filter is a group limit. Rows without text or language don't count.
    """
    if not sizes or max(sizes) > cg.LONGEST or min(sizes) < 1:
        raise ValueError(f"n-grams have 1 to {cg.LONGEST} characters")
    wanted = tuple(sizes)
    rows = docs.select(F.col(lang_col).alias("lang"), letters(F.col(text_col)).alias("letters")).dropna()
    counted = rows.mapInPandas(lambda frames: cg.count_by_label(frames, wanted), "lang string, gram string, n long")
    totals = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return totals.withColumn("rank", rank).where(F.col("rank") <= top)


def load_profiles(table: DataFrame, sizes: Sequence[int] = SIZES, top: int = TOP, max_languages: int = MAX_LANGUAGES) -> LanguageProfiles:
    """Profiles for tasks, from a table of at most ``max_languages * top`` rows."""
    rows = table.select("lang", "gram", "rank").limit(max_languages * top + 1).collect()
    languages = tuple(sorted({r["lang"] for r in rows}))
    if len(rows) > max_languages * top or len(languages) > max_languages:
        raise ValueError(f"more than {max_languages} languages of {top} n-grams")
    keys = np.array(sorted({cg.key_of(r["gram"]) for r in rows}), np.int64)
    weights = np.zeros((len(keys), len(languages)))
    column = {name: k for k, name in enumerate(languages)}
    for r in rows:
        weights[np.searchsorted(keys, cg.key_of(r["gram"])), column[r["lang"]]] = top + 1 - r["rank"]
    return LanguageProfiles(languages, keys, weights, tuple(sizes))


def learn_profiles(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", sizes: Sequence[int] = SIZES, top: int = TOP
) -> LanguageProfiles:
    """Profiles of all languages in ``lang_col``."""
    return load_profiles(language_profiles(docs, text_col, lang_col, sizes, top), sizes, top)


def language_confusion(docs: DataFrame, profiles: LanguageProfiles, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(lang, detected, count)`` over labelled texts."""
    found = docs.select(F.col(lang_col).alias("lang"), profiles.detect(F.col(text_col)).alias("detected"))
    return found.groupBy("lang", "detected").agg(F.count(F.lit(1)).alias("count"))
