"""Quality rules of documents with verdicts shared by their host."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slantwise.llm import kernels
from slantwise.llm.arrow import append_columns
from slantwise.llm.columns import apart
from slantwise.session import materialize, small_side

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def rule_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the five counts of every whole text; null counts as no words."""
    return append_columns(docs, text_col, kernels.quality_counts, [(c, T.LongType()) for c in COUNTS])


def with_rule_failures(counted: DataFrame, min_words: int = 20, max_repeat_percent: int = 30) -> DataFrame:
    """Adds ``base_failed``: too short, or too many words in repeated windows."""
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def host_rates(judged: DataFrame, host_col: str = "source") -> DataFrame:
    """Failure rate per host, shrunk by a beta prior fitted to all hosts.

    The prior has the mean of all documents; its strength comes from the method
    of moments on the hosts' rates: ``m (1 - m) / v - 1`` with ``v`` the variance
    between hosts, weighted by their documents. Without spread between hosts
    (one host, equal rates) every host gets the mean. Documents without a host
    form one host of their own. A hot host is folded into one row per task
    before the shuffle; the moments reach the driver as one row.
    """
    hosts = judged.groupBy(F.col(host_col).alias("host")).agg(
        F.count("*").alias("pages"), F.sum(F.col("base_failed").cast("long")).alias("failures")
    )
    hosts = materialize(hosts, "host-counts")
    rate = F.col("failures") / F.col("pages")
    total, failed, squares = hosts.agg(F.sum("pages"), F.sum("failures"), F.sum(F.col("pages") * rate * rate)).first()
    mean = failed / total if total else 0.0
    spread = squares / total - mean * mean if total else 0.0
    if spread > 1e-12:
        strength = max(mean * (1 - mean) / spread - 1, 0.0)
        shrunk = (F.col("failures") + F.lit(strength * mean)) / (F.col("pages") + F.lit(strength))
    else:
        shrunk = F.lit(mean)
    return hosts.select("host", "pages", "failures", shrunk.alias("host_rate"))


@apart((*COUNTS, "base_failed", "host_rate", "kept"), ("text_col", "host_col"))
def host_quality(
    docs: DataFrame,
    text_col: str = "text",
    host_col: str = "source",
    min_words: int = 20,
    max_repeat_percent: int = 30,
    max_host_rate: float = 0.5,
    keep_text: bool = True,
) -> DataFrame:
    """Every document with its counts, its own verdict and that of its host.

    ``kept`` is false when the document fails a rule itself, or when the shrunk
    failure rate of its host is above ``max_host_rate``. Columns of ``docs`` stay,
    except those named like a result; without ``keep_text`` the text goes too and
    the counts are stored once instead of computed for the rates and the verdict.
    Null or empty text has no words and fails; equal rows get equal verdicts; an
    empty table gives an empty result.
    """
    results = [c for c in ("base_failed", "host_rate", "kept", "_host") if c in docs.columns]
    judged = with_rule_failures(rule_counts(docs.drop(*results), text_col), min_words, max_repeat_percent)
    if not keep_text:
        judged = materialize(judged.drop(text_col), "rule-counts")
    rates = host_rates(judged, host_col).select(F.col("host").alias("_host"), "host_rate")
    verdict = ~F.col("base_failed") & (F.col("host_rate") <= max_host_rate)
    return (
        judged.join(small_side(rates), F.col(host_col).eqNullSafe(F.col("_host")), "left")
        .drop("_host")
        .withColumn("kept", verdict)
    )
