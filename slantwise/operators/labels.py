"""Class labels: source-level labels, overridden by document-level ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slantwise import constants as K
from slantwise.functions.scores import index_of
from slantwise.session import BROADCAST_ROWS, small_side


def assign_source_labels(
    df: DataFrame, source_labels: DataFrame | None, source_col: str = "source", out_col: str = "label"
) -> DataFrame:
    """Left join of the lower-cased source to ``source_labels(outlet_name, label)``.

    Without a source column or any source label every label is null.
    """
    rows = 0 if source_labels is None else source_labels.limit(BROADCAST_ROWS + 1).count()
    if source_col not in df.columns or rows == 0:
        return df.withColumn(out_col, F.lit(None).cast("string"))
    lookup = source_labels.select(F.col("outlet_name").alias("_source_key"), F.col("label").alias("_source_label"))
    return (
        df.drop(out_col)
        .join(small_side(lookup, rows), F.lower(F.col(source_col)) == F.col("_source_key"), "left")
        .withColumn(out_col, F.col("_source_label"))
        .drop("_source_key", "_source_label")
    )


def label_tiers(
    df: DataFrame,
    source_labels: DataFrame | None,
    human_labels: DataFrame | None,
    source_col: str = "source",
    id_col: str = "doc_id",
) -> DataFrame:
    """Both label tiers side by side: ``tier1_label`` and ``tier2_label``."""
    out = assign_source_labels(df, source_labels, source_col, "tier1_label")
    if human_labels is None:
        return out.withColumn("tier2_label", F.lit(None).cast("string"))
    kind = df.schema[id_col].dataType
    lookup = human_labels.select(F.col("doc_id").cast(kind).alias(id_col), F.col("label").alias("tier2_label"))
    return out.join(lookup, id_col, "left")


def assign_labels(
    df: DataFrame,
    source_labels: DataFrame | None,
    human_labels: DataFrame | None,
    source_col: str = "source",
    id_col: str = "doc_id",
) -> DataFrame:
    """``label`` = document label where there is one, else the source label, else null."""
    tiers = label_tiers(df.drop("label"), source_labels, human_labels, source_col, id_col)
    return tiers.withColumn("label", F.coalesce("tier2_label", "tier1_label")).drop("tier1_label", "tier2_label")


def label_tier_counts(tiers: DataFrame) -> DataFrame:
    """How many rows each tier labelled, and how many rows have any label."""
    n = F.count(F.lit(1))
    labelled = F.count(F.coalesce("tier2_label", "tier1_label"))
    return tiers.agg(
        n.alias("documents"),
        F.count("tier1_label").alias("tier1"),
        F.round(100.0 * F.count("tier1_label") / F.greatest(n, F.lit(1)), 6).alias("tier1_percent"),
        F.count("tier2_label").alias("tier2"),
        labelled.alias("labeled"),
        (n - labelled).alias("unlabeled"),
    )


def encode_labels(df: DataFrame, classes: Sequence[str] = K.CLASSES, label_col: str = "label") -> DataFrame:
    """Add ``label_int``, the position of the label in the class list."""
    return df.withColumn("label_int", index_of(F.col(label_col), classes))


def is_labeled(label_col: str = "label") -> Column:
    return F.col(label_col).isNotNull()


def labeled(df: DataFrame, label_col: str = "label") -> DataFrame:
    return df.where(is_labeled(label_col))


def unlabeled(df: DataFrame, label_col: str = "label") -> DataFrame:
    return df.where(~is_labeled(label_col))


def label_distribution(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Rows per label, unlabelled rows left out."""
    return labeled(df, label_col).groupBy(label_col).agg(F.count(F.lit(1)).alias("count"))


def balanced_weights(df: DataFrame, label_col: str = "label", classes: Sequence[str] = K.CLASSES) -> DataFrame:
    """Per-class weight ``n / (K * n_class)`` over the labelled rows."""
    counts = label_distribution(df, label_col)
    known = labeled(df, label_col).select(F.count(F.lit(1))).scalar()
    present = labeled(df, label_col).select(F.count_distinct(label_col)).scalar()
    return counts.select(
        F.col(label_col), F.col("count"), (known / (present * F.col("count"))).cast("double").alias("weight")
    )
