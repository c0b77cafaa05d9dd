"""N-gram counts, vocabulary, tf-idf and discriminative phrases."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slantwise import constants as K
from slantwise.functions import grams
from slantwise.functions import text as tx
from slantwise.functions.arrays import let, value_counts
from slantwise.session import BROADCAST_ROWS, materialize, small_side

ROUND = 6

# Buckets of the first count of n-grams, per term kept; at least two to the power of the other.
BUCKETS_A_TERM, LEAST_BITS = 128, 16

# Tokens a class may have that are looked for in its texts.
HEAVY_TOKENS = 1_000


@dataclass(frozen=True)
class Analyzer:
    """How text becomes terms, and how counts become weights.

    With ``tokenized`` the text column holds the tokens already (``token_table``).
    """

    ngram_range: tuple[int, int] = K.NGRAM_RANGE
    stop_words: Iterable[str] = K.STOP_WORDS
    sublinear_tf: bool = True
    simple: bool = False
    tokenized: bool = False

    def terms(self, text: Column) -> Column:
        if self.simple or self.tokenized:
            from slantwise.functions.arrays import contiguous_ngrams

            return contiguous_ngrams(self.tokens(text), *self.ngram_range)
        return tx.ngrams(text, self.ngram_range, self.stop_words)

    def tokens(self, text: Column) -> Column:
        """The tokens whose neighbours make the terms."""
        if self.tokenized:
            return text
        return tx.simple_tokens(text) if self.simple else tx.content_tokens(text, self.stop_words)

    def tf_weight(self, tf: Column) -> Column:
        return F.lit(1.0) + F.ln(tf) if self.sublinear_tf else tf.cast("double")


DEFAULT_ANALYZER = Analyzer()


def token_table(docs: DataFrame, analyzer: Analyzer = DEFAULT_ANALYZER, text_col: str = "text", keep: Sequence[str] = ("doc_id", "label")) -> tuple[DataFrame, Analyzer]:
    """``(keep..., text)`` with the tokens for the text, stored, and the analyzer to read it with, for a caller that reads texts more than once."""
    stored = materialize(docs.select(*keep, analyzer.tokens(F.col(text_col)).alias(text_col)), "tokens")
    return stored, replace(analyzer, tokenized=True)


def term_counts(
    docs: DataFrame,
    analyzer: Analyzer = DEFAULT_ANALYZER,
    text_col: str = "text",
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """``(keep..., term, tf)``: n-grams counted inside each row, without a shuffle."""
    return docs.select(*keep, F.inline(value_counts(analyzer.terms(F.col(text_col)))))


def _most_frequent(stats: DataFrame, max_features: int) -> DataFrame:
    """The ``max_features`` terms with the highest ``cf``, ties by term.

    A top-k of this size would send up to ``max_features`` rows from every
    partition to one task. A histogram over the logarithm of ``cf`` first tells
    which terms can be among them, so only those are ordered.
    """
    rung = F.floor(F.log2("cf") * 16).cast("int")
    falling = Window.orderBy(F.desc("_rung"))
    reached = F.col("_reached") >= max_features
    floor = (
        stats.groupBy(rung.alias("_rung"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_reached", F.sum("_n").over(falling))
        .select(F.coalesce(F.max(F.when(reached, F.col("_rung"))), F.lit(0)))
        .scalar()
    )
    return stats.where(rung >= floor).orderBy(F.desc("cf"), "term").limit(max_features)


def _frequent_terms(tokens: DataFrame, ngram_range: tuple[int, int], within: Column, max_features: int, least: int) -> DataFrame:
    """``(term, df, cf)`` of terms ``within`` the limits, the ``max_features`` most frequent among them.

    N-grams are first counted by a hash of a fixed number of buckets. A term has at most the count of its
    bucket, so with a floor only terms of buckets that reach it are counted by name.
    The floor is a guess from the buckets; it is lowered until enough terms reach it, so the
    result does not depend on it. ``least`` is a count that every term has.
    """
    low, high = ngram_range
    bits = min(max(LEAST_BITS, (BUCKETS_A_TERM * max_features - 1).bit_length()), 24)
    counts = tokens.mapInArrow(lambda batches: grams.bucket_counts(batches, low, high, bits), "part int, counts binary")
    buckets = materialize(counts.repartition("part").mapInArrow(grams.bucket_sums, "bucket int, n long"), "buckets")
    rung = F.floor(F.log2("n") * 16).cast("int")
    sizes = buckets.groupBy(rung.alias("rung")).agg(F.count(F.lit(1)).alias("buckets"), F.min("n").alias("least"), F.sum("n").alias("n"))
    # One row per step of the logarithm.
    steps = sorted(((r["least"], r["buckets"], r["n"]) for r in sizes.collect()), reverse=True)
    floor, reached = 0.0, 0
    for step, filled, _ in steps:
        reached += filled
        if reached >= max_features:
            floor = max(step - 2 * sum(n for _, _, n in steps) / (1 << bits), step / 4)
            break
    while True:
        last = floor <= max(least, 1)
        live = _bucket_set(buckets.where(F.col("n") >= (least if last else floor)), bits)
        named = tokens.mapInArrow(lambda batches: grams.term_stats(batches, low, high, bits, live.value), "term string, df long, cf long")
        stats = named.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf")).where(within)
        stats = materialize(stats, "term-stats")
        if last or stats.where(F.col("cf") >= floor).count() >= max_features:
            return stats
        floor /= 2


def _bucket_set(buckets: DataFrame, bits: int):
    """Broadcast mask with a place per bucket; at most a word per 32 buckets reaches the driver."""
    words = buckets.groupBy(F.shiftright("bucket", 5).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, bucket & 31)")).alias("set"))
    found = words.toPandas()
    packed = np.zeros(1 << (bits - 5), np.uint32)
    packed[found["word"].to_numpy(np.int64)] = found["set"].to_numpy(np.uint32)
    mask = np.unpackbits(packed.view(np.uint8), bitorder="little").astype(bool)
    return buckets.sparkSession.sparkContext.broadcast(mask)


def _with_index(stats: DataFrame) -> DataFrame:
    """``idx`` of any number of terms: place in a range of terms plus the size of the ranges before."""
    placed = materialize(stats.repartitionByRange("term").withColumn("_range", F.spark_partition_id()), "terms")
    # One row per range.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy("term")) - 1
    return placed.withColumn("_place", place).join(F.broadcast(starts), "_range").withColumn("idx", (F.col("_start") + F.col("_place")).cast("int"))


def vocabulary(
    docs: DataFrame,
    analyzer: Analyzer = DEFAULT_ANALYZER,
    max_features: int | None = None,
    min_df: int | float = K.MIN_DF,
    max_df: int | float = K.MAX_DF,
    text_col: str = "text",
) -> DataFrame:
    """Kept terms with ``idx`` (alphabetical), ``df``, ``cf`` and ``idf``.

    Integer limits are counts, fractional ones shares of the documents. Without
    ``max_features`` all terms stay, after one shuffle of partial sums by term.
    ``max_features`` keeps the most frequent terms, which bounds the result, so it may be
    broadcast, and only terms that can be among them are shuffled (``_frequent_terms``).
    """
    if max_features is not None:
        docs = docs.select(analyzer.tokens(F.col(text_col)).alias("tokens"))
        docs = docs if analyzer.tokenized else materialize(docs, "tokens")
    n_docs = docs.select(F.count(F.lit(1))).scalar()

    def limit(value: int | float) -> Column:
        return F.lit(value) if isinstance(value, int) else F.lit(value) * n_docs

    within = (F.col("df") >= limit(min_df)) & (F.col("df") <= limit(max_df))
    if max_features is None:
        counts = term_counts(docs, analyzer, text_col, keep=())
        indexed = _with_index(counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf")).where(within))
    else:
        index = F.row_number().over(Window.orderBy("term")) - 1
        stats = _frequent_terms(docs, analyzer.ngram_range, within, max_features, min_df if isinstance(min_df, int) else 1)
        indexed = _most_frequent(stats, max_features).withColumn("idx", index)
    return indexed.select(
        "term",
        "idx",
        "df",
        "cf",
        (F.ln((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)).alias("idf"),
    )


def known_terms(counts: DataFrame, table: DataFrame, rows: int | None = None) -> DataFrame:
    """Counts joined to a term table; unknown terms drop out before any shuffle."""
    return counts.join(small_side(table, rows), "term")


class TermTable:
    """A bounded table by term, so that terms are found inside their row, without a join.

    The terms, in the order of ``idx`` if the table has it, get numbers; they and the columns
    ``values`` reach the workers as one broadcast.
    """

    def __init__(self, table: DataFrame, values: Sequence[str] = ()):
        # At most as many rows as may be broadcast.
        rows = table.toPandas().sort_values("idx" if "idx" in table.columns else "term", ignore_index=True)
        spark = table.sparkSession
        parts = grams.index_of(rows["term"].tolist())
        idf = rows["idf"].to_numpy(float) if "idf" in rows else np.ones(len(rows))
        columns = rows[list(values)].to_numpy(float).reshape(len(rows), len(values))
        self.rows = F.broadcast(spark.createDataFrame([(k, *r) for k, r in enumerate(rows.itertuples(index=False, name=None))], T.StructType([T.StructField("number", T.IntegerType()), *table.schema.fields])))
        self.model = spark.sparkContext.broadcast((parts, idf, columns))

    def vectors(self, analyzer: Analyzer, text: Column, top: tuple | None = None, cells: bool = True) -> Column:
        """Known terms of a text as ``(number, tf, tfidf)``, and their products with ``values``: see ``grams.vectors``."""
        model, (low, high), sublinear = self.model, analyzer.ngram_range, analyzer.sublinear_tf
        kind = "struct<terms: array<struct<number: int, tf: int, tfidf: double>>, dots: array<double>, chosen: int>"

        def found(lists: pa.Array) -> pa.Array:
            return grams.vectors(lists, *model.value, low, high, sublinear, top, cells)

        return F.arrow_udf(found, kind)(analyzer.tokens(text))

    def terms(self, docs: DataFrame, analyzer: Analyzer, text_col: str, keep: Sequence[str]) -> DataFrame:
        """``(keep..., terms)``, all known terms of every row: as ``vectors`` gives them, but a few rows at a time."""
        model, (low, high), sublinear = self.model, analyzer.ngram_range, analyzer.sublinear_tf
        tokens = docs.select(*keep, analyzer.tokens(F.col(text_col)).alias("_tokens"))
        cell = T.StructType([T.StructField("number", T.IntegerType()), T.StructField("tf", T.IntegerType()), T.StructField("tfidf", T.DoubleType())])
        schema = T.StructType([*tokens.schema.fields[:-1], T.StructField("terms", T.ArrayType(cell))])
        return tokens.mapInArrow(lambda batches: grams.with_terms(batches, *model.value[:2], low, high, sublinear), schema)


def table_rows(table: DataFrame, rows: int | None) -> int:
    """``rows`` if the caller has a bound, else the count, as far as it matters for a constant."""
    return table.limit(BROADCAST_ROWS + 1).count() if rows is None else rows


def document_terms(
    docs: DataFrame,
    table: DataFrame,
    analyzer: Analyzer = DEFAULT_ANALYZER,
    text_col: str = "text",
    keep: Sequence[str] = ("doc_id",),
    rows: int | None = None,
) -> DataFrame:
    """``(keep..., tf, tfidf, term...)``: known terms of each row, with the table's columns.

    ``table`` has ``term``, ``idf`` and what else shall be attached; the weights of a row
    have length one. Rows are told apart as rows, so ids may repeat or be null. With
    a table of at most ``BROADCAST_ROWS`` terms nothing is shuffled.
    """
    rows = table_rows(table, rows)
    if rows <= BROADCAST_ROWS:
        terms = TermTable(table)
        cells = terms.terms(docs, analyzer, text_col, keep).select(*keep, F.inline("terms"))
        return cells.join(terms.rows, "number").drop("number")
    vectors = joined_vectors(docs, table, analyzer, text_col, keep, rows)
    cells = F.transform("vector", lambda x: F.struct(x["tf"].alias("tf"), (x["w"] / F.col("norm")).alias("tfidf"), x["entry"].alias("entry")))
    return vectors.select(*keep, F.inline(cells)).select(*keep, "tf", "tfidf", "entry.*")


def joined_vectors(
    docs: DataFrame, table: DataFrame, analyzer: Analyzer, text_col: str, keep: Sequence[str], rows: int
) -> DataFrame:
    """``(keep..., vector, norm)`` for a table too large to be broadcast: known terms of each row as ``(entry, tf, w)``.

    ``w`` is tf-idf before the norm. Terms are joined, and a row's terms come together
    again by the row's number.
    """

    def weigh(x: Column) -> Column:
        return F.struct(x["entry"].alias("entry"), x["tf"].alias("tf"), (analyzer.tf_weight(x["tf"]) * x["entry"]["idf"]).alias("w"))

    named = docs.select(F.monotonically_increasing_id().alias("_row"), F.struct(*keep).alias("_keep"), F.col(text_col).alias("_text"))
    counts = known_terms(term_counts(named, analyzer, "_text", ("_row",)), table, rows)
    entry = F.struct("term", *[c for c in table.columns if c != "term"])
    known = F.sort_array(F.collect_list(F.struct(entry.alias("entry"), "tf")))
    lists = counts.groupBy("_row").agg(known.alias("_found"))
    joined = named.select("_row", "_keep").join(lists, "_row", "left")
    none = F.array().cast(lists.schema["_found"].dataType)
    vectors = joined.select("_keep.*", F.transform(F.coalesce("_found", none), weigh).alias("vector"))
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x["w"] * x["w"])
    return vectors.select(*keep, "vector", F.sqrt(squares).alias("norm"))


def tfidf_transform(
    docs: DataFrame,
    vocab: DataFrame,
    analyzer: Analyzer = DEFAULT_ANALYZER,
    text_col: str = "text",
    keep: Sequence[str] = ("doc_id",),
    vocab_rows: int | None = None,
) -> DataFrame:
    """``(keep..., term, idx, tf, tfidf)``, L2-normalised per row."""
    table = document_terms(docs, vocab.select("term", "idx", "idf"), analyzer, text_col, keep, vocab_rows)
    return table.select(*keep, "term", "idx", "tf", "tfidf")


def term_sums(
    docs: DataFrame,
    vocab: DataFrame,
    group: Column,
    analyzer: Analyzer = DEFAULT_ANALYZER,
    text_col: str = "text",
    vocab_rows: int | None = None,
) -> DataFrame:
    """Long form of the term statistics: ``(group, idx, w, n, top)`` for the terms a group has.

    ``w`` is the sum of tf-idf, ``n`` the number of rows, ``top`` the largest tf-idf. Numbers travel, not
    terms, and a task sums its own rows first: one row per (group, idx) and task is shuffled.
    """
    low, high = analyzer.ngram_range
    sublinear = analyzer.sublinear_tf
    sums = [F.sum("w").alias("w"), F.sum("n").alias("n"), F.max("top").alias("top")]
    if table_rows(vocab, vocab_rows) <= BROADCAST_ROWS:
        terms = TermTable(vocab.select("term", "idx", "idf"))
        model = terms.model
        pairs = docs.select(group.alias("group"), analyzer.tokens(F.col(text_col)).alias("tokens"))
        fields = [T.StructField("number", T.IntegerType()), T.StructField("w", T.DoubleType()), T.StructField("n", T.LongType()), T.StructField("top", T.DoubleType())]
        schema = T.StructType([T.StructField("group", pairs.schema["group"].dataType), *fields])
        partial = pairs.mapInArrow(lambda batches: grams.group_sums(batches, *model.value[:2], low, high, sublinear), schema)
        return partial.groupBy("group", "number").agg(*sums).join(terms.rows.select("number", "idx"), "number").select("group", "idx", "w", "n", "top")
    cells = document_terms(docs.withColumn("_group", group), vocab.select("term", "idx", "idf"), analyzer, text_col, ("_group",), vocab_rows)
    named = cells.select(F.col("_group").alias("group"), "idx", F.col("tfidf").alias("w"), F.lit(1).alias("n"), F.col("tfidf").alias("top"))
    return named.groupBy("group", "idx").agg(*sums)


def tfidf_fit(docs: DataFrame, vocab: DataFrame, analyzer: Analyzer = DEFAULT_ANALYZER, text_col: str = "text", vocab_rows: int | None = None) -> DataFrame:
    """``(term, df, sum_tfidf, max_tfidf)`` of the terms that occur; terms are attached at the end."""
    sums = term_sums(docs, vocab, F.lit(0), analyzer, text_col, vocab_rows)
    named = sums.join(vocab.select("idx", "term"), "idx")
    return named.select("term", F.col("n").alias("df"), F.round("w", ROUND).alias("sum_tfidf"), F.round("top", ROUND).alias("max_tfidf"))


def term_weight_lists(
    docs: DataFrame,
    vocab: DataFrame,
    analyzer: Analyzer = DEFAULT_ANALYZER,
    text_col: str = "text",
    keep: Sequence[str] = ("doc_id",),
    vocab_rows: int | None = None,
) -> DataFrame:
    """One row per document with the ``indices`` of its terms and their normalised ``values``."""
    if table_rows(vocab, vocab_rows) <= BROADCAST_ROWS:
        found = TermTable(vocab.select("term", "idx", "idf"))
        terms = found.terms(docs, analyzer, text_col, keep)
        # Numbers follow the index, which has no gaps.
        return terms.select(*keep, F.col("terms.number").alias("indices"), F.col("terms.tfidf").alias("values"))
    counts = term_counts(docs, analyzer, text_col, keep)
    weighted = known_terms(counts, vocab.select("term", "idx", "idf"), vocab_rows).withColumn(
        "_w", analyzer.tf_weight(F.col("tf")) * F.col("idf")
    )
    grouped = weighted.groupBy(*keep).agg(
        F.sort_array(F.collect_list(F.struct("idx", F.col("_w").alias("w")))).alias("_pairs"),
        F.sqrt(F.sum(F.col("_w") * F.col("_w"))).alias("_norm"),
    )
    return grouped.select(
        *keep,
        F.transform("_pairs", lambda p: p["idx"]).alias("indices"),
        F.transform("_pairs", lambda p: p["w"] / F.col("_norm")).alias("values"),
    )


def _class_sums(sums: DataFrame, vocab: DataFrame, classes: Sequence[str]) -> DataFrame:
    """Per term: total weight and document count, overall and per class, with its ``term``."""
    totals = [F.sum("w").alias("_w"), F.sum("n").alias("_n")]
    for i, name in enumerate(classes):
        inside = F.col("group") == name
        totals.append(F.coalesce(F.sum(F.when(inside, F.col("w"))), F.lit(0.0)).alias(f"_w{i}"))
        totals.append(F.coalesce(F.sum(F.when(inside, F.col("n"))), F.lit(0)).alias(f"_n{i}"))
    return sums.groupBy("idx").agg(*totals).join(vocab.select("idx", "term"), "idx")


def _class_sizes(docs: DataFrame, classes: Sequence[str], label_col: str) -> Column:
    """One struct with the number of documents, overall and per class."""
    counts = [F.count(F.lit(1)).alias("n")]
    counts += [F.count(F.when(F.col(label_col) == name, F.lit(1))).alias(f"n{i}") for i, name in enumerate(classes)]
    return docs.agg(*counts).select(F.struct("n", *[f"n{i}" for i in range(len(classes))])).scalar()


def top_per_group(rows: DataFrame, group: str, score: str, top_k: int, name: str = "term") -> DataFrame:
    """Best ``top_k`` rows per group with their rank; ties by name."""
    order = Window.partitionBy(group).orderBy(F.desc(score), name)
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_k)


def _by_class(rows: DataFrame, classes: Sequence[str], scores: Sequence[Column], keep: Sequence[str]) -> DataFrame:
    """One row per input row and class with that class's score."""
    pairs = [
        F.struct(F.lit(name).alias("class_name"), score.cast("double").alias("score"))
        for name, score in zip(classes, scores)
    ]
    return rows.select(*keep, F.inline(F.array(*pairs)))


def chi2_phrases(
    docs: DataFrame,
    vocab: DataFrame,
    label_col: str = "label",
    classes: Sequence[str] = K.CLASSES,
    top_k: int = 50,
    analyzer: Analyzer = DEFAULT_ANALYZER,
    text_col: str = "text",
    vocab_rows: int | None = None,
) -> DataFrame:
    """One-vs-rest chi-square of summed tf-idf: ``(class_name, rank, phrase, score)``.

    With two groups the statistic is ``(O - pT)^2 / (p(1-p)T)``; O is the weight
    inside the class, T the total, p the share of documents in the class. A class
    that holds no or all documents has no statistic.
    """
    sizes = _class_sizes(docs, classes, label_col)
    found = term_sums(docs, vocab, F.col(label_col), analyzer, text_col, vocab_rows)
    sums = _class_sums(found, vocab, classes).withColumn("_sizes", sizes)
    scores = []
    for i in range(len(classes)):
        p = F.col(f"_sizes.n{i}") / F.col("_sizes.n")
        gap = F.col(f"_w{i}") - p * F.col("_w")
        scores.append(F.round(F.try_divide(gap * gap, p * (1 - p) * F.col("_w")), ROUND))
    rows = _by_class(sums, classes, scores, ["term"]).where(F.col("score") > 0)
    return top_per_group(rows, "class_name", "score", top_k).select(
        "class_name", "rank", F.col("term").alias("phrase"), "score"
    )


def group_phrases(
    docs: DataFrame,
    vocab: DataFrame,
    group: Column,
    top_k: int = 20,
    k: int = K.K_ANONYMITY,
    analyzer: Analyzer = DEFAULT_ANALYZER,
    text_col: str = "text",
    vocab_rows: int | None = None,
) -> DataFrame:
    """Phrases a group has more of than its share: ``(group_name, rank, phrase, score)``.

    The statistic of ``chi2_phrases`` for every group of at least ``k`` rows against all
    others, for any number of groups, over the terms that stand in the group with
    more weight than expected. Null groups don't count as one, but as others.
    """
    sums = materialize(term_sums(docs, vocab, group, analyzer, text_col, vocab_rows).drop("top"), "term-sums")
    sizes = docs.groupBy(group.alias("group")).agg(F.count(F.lit(1)).alias("_size"))
    sizes = materialize(sizes, "group-sizes")
    rows = sizes.select(F.coalesce(F.sum("_size"), F.lit(0))).scalar()
    totals = sums.groupBy("idx").agg(F.sum("w").alias("_all"))
    share = F.col("_size") / rows
    gap = F.col("w") - share * F.col("_all")
    score = F.round(F.try_divide(gap * gap, share * (1 - share) * F.col("_all")), ROUND)
    scored = sums.join(small_side(sizes.where(F.col("_size") >= k)), "group").join(totals, "idx")
    scored = scored.where(gap > 0).select(F.col("group").alias("group_name"), "idx", score.alias("score")).where(F.col("score") > 0)
    # The index follows the terms, so it breaks ties as they would.
    best = top_per_group(scored, "group_name", "score", top_k, "idx")
    return best.join(vocab.select("idx", "term"), "idx").select("group_name", "rank", F.col("term").alias("phrase"), "score")


def mi_phrases(
    docs: DataFrame,
    vocab: DataFrame,
    label_col: str = "label",
    classes: Sequence[str] = K.CLASSES,
    top_k: int = 50,
    analyzer: Analyzer = DEFAULT_ANALYZER,
    text_col: str = "text",
    vocab_rows: int | None = None,
) -> DataFrame:
    """Mutual information of term presence and class, re-ranked inside each class.

    The ``top_k * len(classes)`` most informative terms are kept; each class then
    orders them by its mean tf-idf times the information.
    """
    sizes = _class_sizes(docs, classes, label_col)
    found = term_sums(docs, vocab, F.col(label_col), analyzer, text_col, vocab_rows)
    sums = _class_sums(found, vocab, classes).withColumn("_sizes", sizes)
    n = F.col("_sizes.n").cast("double")
    information = F.lit(0.0)
    for i in range(len(classes)):
        in_class = F.col(f"_sizes.n{i}").cast("double")
        for joint, side in (
            (F.col(f"_n{i}"), F.col("_n")),
            (in_class - F.col(f"_n{i}"), n - F.col("_n")),
        ):
            p = joint / n
            information = information + F.when(joint > 0, p * F.ln(p / ((side / n) * (in_class / n)))).otherwise(0.0)
    best = (
        sums.withColumn("_mi", F.round(information, ROUND))
        .orderBy(F.desc("_mi"), "term")
        .limit(top_k * len(classes))
    )
    scores = [
        F.round(F.try_divide(F.col(f"_w{i}"), F.col(f"_sizes.n{i}")) * F.col("_mi"), ROUND)
        for i in range(len(classes))
    ]
    rows = _by_class(best, classes, scores, ["term"]).where(F.col("score").isNotNull())
    return top_per_group(rows, "class_name", "score", top_k).select(
        "class_name", "rank", F.col("term").alias("phrase"), "score"
    )


def discriminative_phrases(docs: DataFrame, vocab: DataFrame, method: str = "chi2", **options) -> DataFrame:
    """Phrases per class by ``chi2`` or ``mutual_info``."""
    methods = {"chi2": chi2_phrases, "mutual_info": mi_phrases}
    if method not in methods:
        raise ValueError(f"unknown method {method!r}, use one of {sorted(methods)}")
    return methods[method](docs, vocab, **options)


def topic_leakage(
    docs: DataFrame,
    pred_col: str = "pred_label",
    top_k: int = 10,
    min_df: int = 2,
    stop_words: Iterable[str] = K.STOP_WORDS,
    text_col: str = "text",
) -> DataFrame:
    """Most frequent 1-2-grams of each predicted class, in at least ``min_df`` documents.

    A pair of tokens is at most as frequent as either of them, and the ``top_k`` most frequent tokens
    of a class set a floor. So after the tokens only pairs of tokens that reach the floor
    are counted. A class with fewer tokens, or with more than ``HEAVY_TOKENS`` at the floor, counts all pairs.
    """
    tokens = docs.select(F.col(pred_col).alias("class_name"), Analyzer((1, 1), stop_words).tokens(F.col(text_col)).alias("tokens"))
    tokens = materialize(tokens, "class-tokens")
    single = materialize(_class_totals(tokens, F.col("tokens")), "single-tokens")
    last = top_per_group(single.where(F.col("_df") >= min_df), "class_name", "count", top_k).where(F.col("rank") == top_k)
    # One row per class.
    floors = F.broadcast(last.select(F.col("class_name").alias("_class"), F.col("count").alias("_floor")))
    heavy = single.join(floors, F.col("class_name").eqNullSafe(F.col("_class"))).where(F.col("count") >= F.col("_floor"))
    first = Window.partitionBy("_class").orderBy(F.desc("count"), "term")
    some = heavy.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= HEAVY_TOKENS + 1)
    lists = some.groupBy("_class").agg(F.collect_list("term").alias("_heavy")).where(F.size("_heavy") <= HEAVY_TOKENS)
    paired = tokens.join(F.broadcast(lists), F.col("class_name").eqNullSafe(F.col("_class")), "left")
    kept = F.transform("tokens", lambda x: F.when(F.col("_heavy").isNull() | F.array_contains("_heavy", x), x))
    pairs = let(kept, lambda items: F.transform(F.slice(items, F.lit(2), F.size(items)), lambda x, i: F.concat(F.get(items, i), F.lit(" "), x)))
    both = single.unionByName(_class_totals(paired, F.filter(pairs, lambda x: x.isNotNull())))
    return top_per_group(both.where(F.col("_df") >= min_df), "class_name", "count", top_k).select(
        "class_name", "rank", "term", "count"
    )


def _class_totals(tokens: DataFrame, terms: Column) -> DataFrame:
    """``(class_name, term, _df, count)`` of the terms of each class."""
    counts = tokens.select("class_name", F.inline(value_counts(terms)))
    return counts.groupBy("class_name", "term").agg(F.count(F.lit(1)).alias("_df"), F.sum("tf").alias("count"))
