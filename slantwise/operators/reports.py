"""Group reports that suppress groups below a minimum size.

The reports describe text content in aggregate; they say nothing about authors
or readers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slantwise import constants as K
from slantwise.functions import scores as sc
from slantwise.functions.fields import subset_field
from slantwise.operators.ranking import exact_median

ROUND = 6
KEYS = ["field", "group_name"]


def stack_fields(df: DataFrame, fields: Sequence[str], meta_col: str = "subset_meta") -> DataFrame:
    """One row per document and known field: ``field``, ``group_name`` and the scores."""
    known = [(f, subset_field(df, f, meta_col)) for f in fields]
    pairs = [
        F.struct(F.lit(name).alias("field"), key.alias("group_name")) for name, key in known if key is not None
    ]
    if not pairs:
        pairs = [F.struct(F.lit("").alias("field"), F.lit("").alias("group_name"))]
        df = df.where(F.lit(False))
    return df.select("*", F.inline(F.array(*pairs)))


def group_statistics(
    scored: DataFrame,
    fields: Sequence[str],
    classes: Sequence[str] = K.CLASSES,
    score_col: str = "polarity_score",
    pred_col: str = "pred_label",
    k: int = 1,
) -> DataFrame:
    """Size, score statistics, class counts and mean entropy of groups of at least ``k``.

    The fields are stacked and grouped together, so the scores are read once for
    all of them. Everything but the median is a partial aggregate.
    """
    probs = sc.probabilities(classes)
    needed = stack_fields(scored, fields).select(
        *KEYS, F.col(score_col).alias("_s"), F.col(pred_col).alias("_p"), sc.entropy_exact(probs).alias("_e")
    )
    stats = needed.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("size"),
        F.avg("_s").alias("mean"),
        F.stddev_pop("_s").alias("std"),
        F.min("_s").alias("min"),
        F.max("_s").alias("max"),
        *[F.count(F.when(F.col("_p") == name, F.lit(1))).alias(f"count_{name}") for name in classes],
        F.avg("_e").alias("mean_entropy"),
    ).where(F.col("size") >= k)
    median = exact_median(needed.select(*KEYS, "_s"), KEYS, "_s")
    return stats.join(median, KEYS)


def subset_report(
    scored: DataFrame, field: str, k: int = K.K_ANONYMITY, classes: Sequence[str] = K.CLASSES
) -> DataFrame:
    """Statistics of the groups of one field that have at least ``k`` documents."""
    return multi_field_report(scored, [field], k, classes)


def multi_field_report(
    scored: DataFrame, fields: Sequence[str] = ("source", "region"), k: int = K.K_ANONYMITY, classes: Sequence[str] = K.CLASSES
) -> DataFrame:
    """One report for several fields. A field the table does not have adds no rows."""
    stats = group_statistics(scored, fields, classes, k=k)
    return stats.select(
        *KEYS,
        "size",
        *[F.round(c, ROUND).alias(f"score_{c}") for c in ("mean", "median", "std", "min", "max")],
        *[f"count_{name}" for name in classes],
        F.round("mean_entropy", ROUND).alias("mean_entropy"),
    )


def suppressed_groups(
    scored: DataFrame, fields: Sequence[str], k: int = K.K_ANONYMITY, mask_sizes: bool = False
) -> DataFrame:
    """Groups below ``k`` with the reason; ``mask_sizes`` hides how small they are."""
    sizes = stack_fields(scored, fields).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("size")).where(F.col("size") < k)
    if mask_sizes:
        return sizes.select(
            *KEYS,
            F.lit(None).cast("bigint").alias("size"),
            F.lit(f"Group size < k-anonymity threshold ({k})").alias("reason"),
        )
    reason = F.format_string(f"Group size (%d) < k-anonymity threshold ({k})", "size")
    return sizes.select(*KEYS, "size", reason.alias("reason"))


def subset_summary(
    scored: DataFrame, fields: Sequence[str], k: int = K.K_ANONYMITY, score_col: str = "polarity_score"
) -> DataFrame:
    """Per field: groups reported and suppressed, range of the reported means.

    A field without a reported group has no summary.
    """
    groups = (
        stack_fields(scored, fields)
        .groupBy(*KEYS)
        .agg(F.count(F.lit(1)).alias("size"), F.avg(score_col).alias("mean"))
    )
    shown = F.col("size") >= k
    return (
        groups.groupBy("field")
        .agg(
            F.count(F.when(shown, F.lit(1))).alias("groups_reported"),
            F.count(F.when(~shown, F.lit(1))).alias("groups_suppressed"),
            F.round(F.min(F.when(shown, F.col("mean"))), ROUND).alias("min_group_mean"),
            F.round(F.max(F.when(shown, F.col("mean"))), ROUND).alias("max_group_mean"),
        )
        .where(F.col("groups_reported") > 0)
    )


def report_lines(report: DataFrame, classes: Sequence[str] = K.CLASSES) -> DataFrame:
    """Readable lines of a report: ``(field, group_name, line_no, line)``."""
    counts = ", ".join(f"{name} %d" for name in classes)
    lines = [
        F.format_string("%s | %d documents", "group_name", "size"),
        F.format_string("polarity %+.3f on average, %+.3f in the middle, spread %.3f", "score_mean", "score_median", "score_std"),
        F.format_string(f"labels {counts}", *[F.col(f"count_{name}") for name in classes]),
        F.format_string("uncertainty %.3f", "mean_entropy"),
    ]
    return report.select(*KEYS, F.posexplode(F.array(*lines)).alias("line_no", "line"))


SECTIONS = ("groups", "suppressed_groups", "summary")


def report_sections(
    scored: DataFrame,
    fields: Sequence[str] = ("source", "region"),
    k: int = K.K_ANONYMITY,
    classes: Sequence[str] = K.CLASSES,
    mask_sizes: bool = False,
) -> DataFrame:
    """The whole report as one table: rows of ``groups``, ``suppressed_groups`` and ``summary``.

    ``section`` says which; the columns of the other sections are null. A field
    whose groups are all suppressed has no summary.
    """
    parts = (
        multi_field_report(scored, fields, k, classes),
        suppressed_groups(scored, fields, k, mask_sizes),
        subset_summary(scored, fields, k),
    )
    out = None
    for name, part in zip(SECTIONS, parts):
        named = part.select(F.lit(name).alias("section"), *part.columns)
        out = named if out is None else out.unionByName(named, allowMissingColumns=True)
    return out.withColumn("k", F.lit(k))


def section_lines(sections: DataFrame, classes: Sequence[str] = K.CLASSES) -> DataFrame:
    """Readable lines of all sections: ``(section, field, group_name, line_no, line)``."""
    groups = report_lines(sections.where(F.col("section") == SECTIONS[0]), classes).withColumn("section", F.lit(SECTIONS[0]))
    hidden = sections.where(F.col("section") == SECTIONS[1]).withColumn("line", F.format_string("%s | not shown: %s", "group_name", "reason"))
    summary = sections.where(F.col("section") == SECTIONS[2]).withColumn(
        "line",
        F.format_string(
            "%s | %d groups shown, %d not shown, means from %+.3f to %+.3f",
            "field", "groups_reported", "groups_suppressed", "min_group_mean", "max_group_mean",
        ),
    )
    columns = ("section", *KEYS, "line_no", "line")
    single = hidden.unionByName(summary).withColumn("line_no", F.lit(0))
    return groups.select(*columns).unionByName(single.select(*columns))


def write_report(report: DataFrame, path: str) -> None:
    """The report as JSON lines; a column that has no value in a row is left out there."""
    report.write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str, classes: Sequence[str] = K.CLASSES) -> DataFrame:
    """A stored report, whichever sections it has."""
    scores = ", ".join(f"score_{c} double" for c in ("mean", "median", "std", "min", "max"))
    counts = ", ".join(f"count_{name} long" for name in classes)
    return spark.read.schema(
        f"section string, field string, group_name string, size long, {scores}, {counts}, mean_entropy double, "
        "reason string, groups_reported long, groups_suppressed long, min_group_mean double, max_group_mean double, k int"
    ).json(path)
