"""Classification metrics, calibration and error listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slantwise import constants as K
from slantwise.functions import scores as sc
from slantwise.operators.ranking import exact_median

ROUND = 6


def confusion_matrix(
    df: DataFrame, true_col: str = "label", pred_col: str = "pred_label", classes: Sequence[str] = K.CLASSES
) -> DataFrame:
    """``(true_label, pred_label, count)`` with every cell of the class grid.

    One aggregate over the rows; the empty cells come from a constant grid.
    """
    cells = [F.struct(F.lit(t).alias("true_label"), F.lit(p).alias("pred_label")) for t in classes for p in classes]
    grid = df.sparkSession.range(1).select(F.inline(F.array(*cells)))
    counts = df.groupBy(F.col(true_col).alias("true_label"), F.col(pred_col).alias("pred_label")).agg(
        F.count(F.lit(1)).alias("count")
    )
    return grid.join(counts, ["true_label", "pred_label"], "left").select(
        "true_label", "pred_label", F.coalesce("count", F.lit(0)).alias("count")
    )


def accuracy(df: DataFrame, true_col: str = "label", pred_col: str = "pred_label") -> DataFrame:
    """Share of rows whose prediction is right."""
    right = (F.col(true_col) == F.col(pred_col)).cast("double")
    return df.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(right), ROUND).alias("accuracy"))


def _per_class(df: DataFrame, true_col: str, pred_col: str, classes: Sequence[str]) -> DataFrame:
    """Unrounded precision, recall, F1, support and predicted count per class."""
    cells = confusion_matrix(df, true_col, pred_col, classes)
    sides = cells.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("true_label").alias("class_name"),
                    F.col("count").alias("support"),
                    F.lit(0).cast("bigint").alias("predicted"),
                    F.when(F.col("true_label") == F.col("pred_label"), F.col("count")).otherwise(0).alias("hits"),
                ),
                F.struct(
                    F.col("pred_label").alias("class_name"),
                    F.lit(0).cast("bigint").alias("support"),
                    F.col("count").alias("predicted"),
                    F.lit(0).cast("bigint").alias("hits"),
                ),
            )
        )
    )
    sums = sides.groupBy("class_name").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits")
    )

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    return sums.select(
        "class_name",
        ratio(F.col("hits"), F.col("predicted")).alias("precision"),
        ratio(F.col("hits"), F.col("support")).alias("recall"),
        ratio(2 * F.col("hits"), F.col("support") + F.col("predicted")).alias("f1"),
        "support",
        "predicted",
        "hits",
    )


def per_class_metrics(
    df: DataFrame, true_col: str = "label", pred_col: str = "pred_label", classes: Sequence[str] = K.CLASSES
) -> DataFrame:
    """Precision, recall, F1 and support per class; undefined values are 0."""
    rows = _per_class(df, true_col, pred_col, classes)
    return rows.select("class_name", *[F.round(c, ROUND).alias(c) for c in ("precision", "recall", "f1")], "support")


def macro_f1(
    df: DataFrame, true_col: str = "label", pred_col: str = "pred_label", classes: Sequence[str] = K.CLASSES
) -> DataFrame:
    """Mean F1 over the classes that occur as a label or as a prediction."""
    rows = _per_class(df, true_col, pred_col, classes).where(F.col("support") + F.col("predicted") > 0)
    return rows.agg(F.round(F.coalesce(F.avg("f1"), F.lit(0.0)), ROUND).alias("macro_f1"))


def classification_report(
    df: DataFrame, true_col: str = "label", pred_col: str = "pred_label", classes: Sequence[str] = K.CLASSES
) -> DataFrame:
    """Per-class rows plus ``accuracy``, ``macro avg`` and ``weighted avg``."""
    rows = _per_class(df, true_col, pred_col, classes)
    measures = ("precision", "recall", "f1")
    support = F.sum("support")

    def weighted(name: str) -> Column:
        return F.coalesce(F.try_divide(F.sum(F.col(name) * F.col("support")), support), F.lit(0.0))

    share = F.coalesce(F.try_divide(F.sum("hits"), support), F.lit(0.0))
    summaries = rows.agg(
        *[F.avg(name).alias(f"m_{name}") for name in measures],
        *[weighted(name).alias(f"w_{name}") for name in measures],
        share.alias("share"),
        support.alias("support"),
    )
    summary_rows = summaries.select(
        F.inline(
            F.array(
                F.struct(F.lit("accuracy").alias("row"), *[F.col("share").alias(m) for m in measures], F.col("support")),
                F.struct(F.lit("macro avg").alias("row"), *[F.col(f"m_{m}").alias(m) for m in measures], F.col("support")),
                F.struct(F.lit("weighted avg").alias("row"), *[F.col(f"w_{m}").alias(m) for m in measures], F.col("support")),
            )
        )
    )
    stacked = rows.select(F.col("class_name").alias("row"), *measures, "support").unionByName(summary_rows)
    return stacked.select("row", *[F.round(m, ROUND).alias(m) for m in measures], "support")


def bin_edges(bins: int, low: float = 0.0, high: float = 1.0) -> list[float]:
    """Evenly spaced edges: multiples of the step, the last one exact."""
    step = (high - low) / bins
    return [low + i * step for i in range(bins)] + [high]


def _confidence_bins(df: DataFrame, true_col: str, classes: Sequence[str], bins: int) -> DataFrame:
    """Sums per bin ``(lower, upper]`` of the highest probability.

    The bin number is how many edges lie below the confidence: plain
    comparisons with constants, no join. Confidence 0 belongs to no bin.
    """
    probs = sc.probabilities(classes)
    confidence = F.greatest(*probs)
    right = (sc.argmax_label(probs, classes) == F.col(true_col)).cast("double")
    edges = bin_edges(bins)
    number = sc.total([(F.lit(edge) < confidence).cast("int") for edge in edges]) - 1
    return (
        df.select(confidence.alias("_conf"), right.alias("_right"), number.alias("_bin"))
        .where(F.col("_bin").between(0, bins - 1))
        .groupBy("_bin")
        .agg(F.count(F.lit(1)).alias("count"), F.sum("_conf").alias("_conf"), F.sum("_right").alias("_right"))
    )


def calibration_curve(
    df: DataFrame, true_col: str = "label", classes: Sequence[str] = K.CLASSES, bins: int = K.CALIBRATION_BINS
) -> DataFrame:
    """Mean confidence and accuracy per non-empty bin of the highest probability."""
    edges = bin_edges(bins)
    table = F.array(*[F.lit(e) for e in edges])
    lower, upper = F.get(table, F.col("_bin")), F.get(table, F.col("_bin") + 1)
    return _confidence_bins(df, true_col, classes, bins).select(
        F.round(lower, ROUND).alias("bin_lower"),
        F.round(upper, ROUND).alias("bin_upper"),
        F.format_string("(%.2f, %.2f]", lower, upper).alias("bin"),
        F.round(F.col("_conf") / F.col("count"), ROUND).alias("mean_confidence"),
        F.round(F.col("_right") / F.col("count"), ROUND).alias("mean_accuracy"),
        "count",
    )


def expected_calibration_error(
    df: DataFrame, true_col: str = "label", classes: Sequence[str] = K.CLASSES, bins: int = K.CALIBRATION_BINS
) -> DataFrame:
    """Mean absolute gap between confidence and accuracy, weighted by bin size."""
    table = _confidence_bins(df, true_col, classes, bins)
    n = df.select(F.count(F.lit(1))).scalar()
    gap = F.abs(F.col("_right") / F.col("count") - F.col("_conf") / F.col("count"))
    return table.agg(
        F.round(F.coalesce(F.sum(gap * F.col("count") / n), F.lit(0.0)), ROUND).alias("ece")
    )


def score_histogram(
    df: DataFrame,
    score_col: str = "polarity_score",
    group_col: str | None = None,
    bins: int = K.HISTOGRAM_BINS,
    low: float = -1.0,
    high: float = 1.0,
) -> DataFrame:
    """Counts in equal bins, empty ones included, with the mean and median score.

    Bins are half-open, the last one closed. The computed bin is checked against
    the bin edges, so a score on an edge lands on its right side.
    """
    keys = [group_col] if group_col else []
    edges = bin_edges(bins, low, high)
    table = F.array(*[F.lit(e) for e in edges])
    score = F.col(score_col)
    rough = F.least(F.floor((score - F.lit(low)) * F.lit(bins / (high - low))).cast("int"), F.lit(bins - 1))
    down = (score < F.get(table, rough)).cast("int")
    up = ((score >= F.get(table, rough + 1)) & (rough < bins - 1)).cast("int")
    inside = df.where(score.between(low, high))
    counts = inside.groupBy(*keys, (rough - down + up).alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    stats = df.groupBy(*keys).agg(F.avg(score).alias("_mean"))
    median = exact_median(df, keys, score_col, low, high, out_col="_median")
    if keys:
        stats = stats.join(median, keys)
    else:
        stats = stats.withColumn("_median", median.select("_median").scalar())
    grid = stats.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return grid.join(counts, [*keys, "bin"], "left").select(
        *keys,
        "bin",
        F.round(F.get(table, F.col("bin")), ROUND).alias("bin_lower"),
        F.round(F.get(table, F.col("bin") + 1), ROUND).alias("bin_upper"),
        F.coalesce("count", F.lit(0)).alias("count"),
        F.round("_mean", ROUND).alias("mean_score"),
        F.round("_median", ROUND).alias("median_score"),
    )


def misclassified(
    df: DataFrame,
    true_col: str = "label",
    pred_col: str = "pred_label",
    classes: Sequence[str] = K.CLASSES,
    max_save: int | None = None,
    snippet_chars: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Wrong predictions by id, with probabilities and text.

    ``max_save`` keeps the first ones, ``snippet_chars`` the start of the text.
    """
    names = sc.prob_columns(classes)
    extra = ["source"] if "source" in df.columns else []
    shown = F.col(text_col) if snippet_chars is None else F.substring(text_col, 1, snippet_chars)
    snippet = [shown.alias("text_snippet")] if text_col in df.columns else []
    wrong = (
        df.where(F.col(true_col) != F.col(pred_col))
        .select(
            id_col,
            F.col(true_col).alias("true_label"),
            F.col(pred_col).alias("pred_label"),
            F.greatest(*sc.probabilities(classes)).alias("confidence"),
            *names,
            *extra,
            *snippet,
        )
        .orderBy(id_col)
    )
    return wrong if max_save is None else wrong.limit(max_save)


def error_rate(df: DataFrame, true_col: str = "label", pred_col: str = "pred_label") -> DataFrame:
    """Number and percentage of wrong predictions."""
    n, wrong = F.count(F.lit(1)), F.count(F.when(F.col(true_col) != F.col(pred_col), F.lit(1)))
    return df.agg(
        n.alias("n"), wrong.alias("errors"), F.round(100.0 * wrong / F.greatest(n, F.lit(1)), ROUND).alias("percent")
    )


def score_summary(df: DataFrame, score_col: str = "polarity_score", pred_col: str = "pred_label") -> DataFrame:
    """Documents per predicted label, next to the overall count and mean score."""
    per_label = df.groupBy(pred_col).agg(F.count(F.lit(1)).alias("count"), F.sum(score_col).alias("_sum"))
    everything = Window.partitionBy(F.lit(1))
    # One row per class: the window sees a handful of rows.
    return per_label.select(
        pred_col,
        "count",
        F.sum("count").over(everything).alias("documents"),
        F.round(F.sum("_sum").over(everything) / F.sum("count").over(everything), ROUND).alias("mean_score"),
    )
