"""Keywords: candidates whose tf-idf profile is closest to the whole text."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from slantwise import constants as K
from slantwise.functions import classgrams, textgrams
from slantwise.functions import text as tx
from slantwise.functions.arrays import value_counts
from slantwise.operators.features import ROUND, top_per_group
from slantwise.session import BROADCAST_ROWS, materialize

# N-grams that are made distinct in one bucket, about.
BUCKET_GRAMS = 1 << 22


def text_keywords(
    text: Column,
    top_k: int = 20,
    ngram_range: tuple[int, int] = K.NGRAM_RANGE,
    stop_words: Iterable[str] = K.STOP_WORDS,
) -> Column:
    """Array of ``(rank, keyword, score)`` structs, computed inside the row.

    Each text has a private space: the text and its distinct candidate n-grams
    are the documents, single tokens are the terms. A term's document frequency
    is 1 (the text) plus the candidates that hold it. Array code counts and scores the n-grams of
    many texts at once, and only those that may be listed get a name; no row leaves its partition.
    """
    low, high = ngram_range
    stop = frozenset(stop_words)

    def leading(lists: pa.Array) -> pa.Array:
        return textgrams.leading_grams(lists, stop, low, high, top_k, 2 * 10.0**-ROUND)

    found = F.arrow_udf(leading, "array<struct<raw: double, keyword: string>>")(tx.tokens(text))
    ranked = F.sort_array(F.transform(found, lambda s: F.struct((-F.round(s["raw"], ROUND)).alias("order"), s["keyword"].alias("keyword"))))
    return F.transform(
        F.slice(ranked, 1, top_k),
        lambda x, i: F.struct((i + 1).alias("rank"), x["keyword"].alias("keyword"), (-x["order"]).alias("score")),
    )


def doc_keywords(
    docs: DataFrame,
    top_k: int = 20,
    ngram_range: tuple[int, int] = K.NGRAM_RANGE,
    stop_words: Iterable[str] = K.STOP_WORDS,
    text_col: str = "text",
    id_col: str = "doc_id",
) -> DataFrame:
    """``(id, rank, keyword, score)``: the best candidates of every text."""
    return docs.select(id_col, F.inline(text_keywords(F.col(text_col), top_k, ngram_range, stop_words)))


def class_keywords(
    docs: DataFrame,
    label_col: str = "label",
    classes: Sequence[str] = K.CLASSES,
    top_k: int = 20,
    ngram_range: tuple[int, int] = K.NGRAM_RANGE,
    stop_words: Iterable[str] = K.STOP_WORDS,
    max_docs: int | None = None,
    text_col: str = "text",
    id_col: str = "doc_id",
) -> DataFrame:
    """Keywords of all texts of every class; an absent class has no rows.

    ``max_docs`` keeps the first documents of a class by id. Candidates are the
    n-grams of single documents. Counts per class and term take the place of a
    joined text, so no class is ever held in one row. Terms are counted by their 64-bit
    hash, n-grams made distinct in array code by the hashes of all their terms.

    A single token scores its own weight in the class, so the ``top_k`` heaviest
    tokens set a floor. Every n-gram is weighed where it stands by the heaviest terms,
    a bounded list; only those that may reach the floor, which rises with the scores met, get a name and an exact score.
    """
    low, high = ngram_range
    known = docs.where(F.col(label_col).isin(list(classes)))
    if max_docs is not None:
        first = Window.partitionBy(label_col).orderBy(id_col)
        known = known.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= max_docs)
    pair = ["class_name", "term"]
    known = materialize(known.select(F.col(label_col).alias("class_name"), tx.tokens(F.col(text_col)).alias("words")), "class-tokens")
    coded = known.select("class_name", F.transform("words", lambda word: F.xxhash64(word)).alias("terms"), "words")
    stop = _names(docs.sparkSession, stop_words)
    tokens = known.agg(F.coalesce(F.sum(F.size("words")), F.lit(0))).first()[0]
    counts = _counts(coded, stop, low, high, tokens)
    # One row per class.
    sizes = F.broadcast(counts.where("term is null").select("class_name", F.col("_held").alias("_n")))
    idf = F.ln((F.coalesce("_n", F.lit(0)) + 2.0) / (F.col("_held") + 2.0)) + 1.0
    weights = counts.where("term is not null").join(sizes, "class_name", "left")
    weights = materialize(weights.select(*pair, (F.col("_held") > 0).alias("_content"), (F.col("_tf") * idf).alias("_total"), idf.alias("_idf")), "class-weights")
    norms = weights.groupBy("class_name").agg(F.sum(F.col("_total") * F.col("_total")).alias("_sq"))
    live = _reaching(coded, stop, weights, norms, classes, top_k, low, high)
    parts = live.select("class_name", "keyword", F.inline(value_counts(F.split("keyword", " ")))).withColumn("term", F.xxhash64("term"))
    own = F.col("tf") * F.col("_idf")
    sims = parts.join(weights, pair).groupBy("class_name", "keyword").agg(
        F.sum(own * F.col("_total")).alias("_dot"), F.sum(own * own).alias("_own")
    )
    score = F.round(F.col("_dot") / F.sqrt(F.col("_sq") * F.col("_own")), ROUND)
    scored = sims.join(F.broadcast(norms), "class_name").select("class_name", "keyword", score.alias("score"))
    return top_per_group(scored, "class_name", "score", top_k, "keyword").select("class_name", "rank", "keyword", "score")


def _names(spark: SparkSession, words: Iterable[str]) -> np.ndarray:
    """64-bit names of words, as ``xxhash64`` gives them."""
    names = [F.xxhash64(F.lit(word)) for word in sorted(set(words))]
    return np.array(spark.range(1).select(F.array(*names)).first()[0] if names else [], np.int64)


def _counts(coded: DataFrame, stop: np.ndarray, low: int, high: int, tokens: int) -> DataFrame:
    """Per class and term its places and the number of candidates that hold it; those of a class in all, as the null term."""
    grams = tokens * (high - low + 1)
    bits = max(4, (grams // BUCKET_GRAMS).bit_length())
    parts = coded.select("class_name", "terms").mapInArrow(
        lambda b: classgrams.gram_parts(b, stop, low, high, bits), "bucket int, class_name string, n int, data binary"
    )
    dealt = parts.repartition(1 << bits, "bucket").sortWithinPartitions("bucket", "class_name", "n")
    counts = dealt.mapInArrow(classgrams.term_counts, "class_name string, term long, tf long, held long")
    return materialize(counts.groupBy("class_name", "term").agg(F.sum("tf").alias("_tf"), F.sum("held").alias("_held")), "class-terms")


def _heaviest(weights: DataFrame, limit: int = BROADCAST_ROWS) -> tuple[dict, float, dict]:
    """Terms, weights and idf per class of at most ``limit`` of the heaviest terms; of all others a bound
    of the weights, and the least idf per class."""
    power = F.floor(F.log2("_total"))
    powers = sorted(weights.groupBy(power.alias("power")).count().collect(), reverse=True)
    least, listed = powers[0].power + 1 if powers else 0, 0
    for row in powers:
        listed += row["count"]
        if listed > limit:
            break
        least = row.power
    heavy = weights.where(power >= least).select("class_name", "term", "_total", "_idf").toPandas().sort_values("term")
    known = {name: tuple(own[c].to_numpy() for c in ("term", "_total", "_idf")) for name, own in heavy.groupby("class_name")}
    if listed <= limit:
        return known, 0.0, {}
    others = weights.where(power < least).groupBy("class_name").agg(F.min("_idf").alias("idf")).collect()
    # More than the power by the rounding of a logarithm.
    return known, 2.0**least * (1 + 1e-9), {r.class_name: r.idf for r in others}


def _reaching(coded: DataFrame, stop: np.ndarray, weights: DataFrame, norms: DataFrame, classes: Sequence[str], top_k: int, low: int, high: int) -> DataFrame:
    """Distinct ``(class_name, keyword)`` that may be among the best ``top_k`` of their class."""
    # Less the rounding of two scores.
    slack = dict.fromkeys(classes, 0.0) | {r.class_name: math.sqrt(r["_sq"]) * 2 * 10.0**-ROUND for r in norms.collect()}
    floors = dict.fromkeys(classes, 0.0)
    if low == 1:  # else no single tokens set a floor
        tokens = weights.where("_content").select("class_name", "term", "_total")
        # A class of few tokens has no floor.
        last = top_per_group(tokens, "class_name", "_total", top_k).where(F.col("rank") == top_k)
        floors |= {r.class_name: max(0.0, r["_total"] - slack[r.class_name]) for r in last.collect()}
    known, rest, least = _heaviest(weights)
    none = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0))
    known, least = dict.fromkeys(classes, none) | known, dict.fromkeys(classes, 0.0) | least
    found = coded.mapInArrow(lambda b: classgrams.reaching(b, stop, low, high, top_k, known, rest, least, floors, slack), "class_name string, keyword string")
    return materialize(found.distinct(), "live-candidates")
