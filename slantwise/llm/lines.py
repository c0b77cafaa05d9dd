"""Boilerplate lines by their frequency within a site, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slantwise.llm.columns import apart
from slantwise.session import materialize, small_side

BREAKING = "address|article|aside|blockquote|br|dd|div|dl|dt|footer|form|h[1-6]|header|hr|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul|body|head|html"


def page_lines(html: Column) -> Column:
    """Visible text of a page, one line per block; scripts, styles and comments go."""
    out = F.regexp_replace(html, r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->", " ")
    out = F.regexp_replace(out, rf"(?is)</?(?:{BREAKING})(?:\s[^>]*)?/?>", "\n")
    return F.regexp_replace(out, r"(?s)<[^>]*>", "")


def url_host(url: Column) -> Column:
    """Host of an address in lower case; null where there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def _lines(text: Column) -> Column:
    """Lines without outer blanks; blank lines are left out."""
    split = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    return F.filter(F.transform(split, lambda line: F.regexp_replace(line, r"^[\x20\t\r]+|[\x20\t\r]+$", "")), lambda line: line != "")


@apart(("n_lines", "n_dropped"), ("text_col", "host_col"))
def drop_site_boilerplate(
    pages: DataFrame,
    text_col: str = "text",
    host_col: str = "host",
    max_ratio: float = 0.1,
    min_pages: int = 3,
) -> DataFrame:
    """Pages without the lines that stand on too large a share of their site.

    A line goes when it is on ``min_pages`` or more pages of its host and these are
    more than ``max_ratio`` of the host's pages; a page counts once however often
    it repeats a line. ``text_col`` gets the lines that stay, joined by line feeds.
    New columns: ``n_lines`` (not blank), ``n_dropped``. Lines compare without outer
    blanks. Pages without a host form a site of their own; null text has no lines
    and reads as empty; an empty table gives an empty result. Columns named like a
    result are replaced.

    Counting sends one row per distinct line of a site and task, so hot sites and
    hot lines are folded before the shuffle. A site has at most its mean number of
    lines per page, divided by ``max_ratio``, of lines to drop; they are joined back
    by site, one row each.
    """
    results = [c for c in ("n_lines", "n_dropped") if c in pages.columns]
    base = pages.drop(*results).withColumn("_lines", _lines(F.col(text_col)))
    host = F.col(host_col).alias("_host")
    totals = pages.groupBy(host).agg(F.count("*").alias("_pages"))
    marks = F.array_distinct(F.transform("_lines", lambda line: F.xxhash64(line)))
    counts = base.select(host, F.explode(marks).alias("_mark")).groupBy("_host", "_mark").agg(F.count("*").alias("_with"))
    counts = counts.where(F.col("_with") >= min_pages).withColumnRenamed("_host", "_h")
    frequent = (
        counts.join(small_side(materialize(totals, "site-pages")), F.col("_h").eqNullSafe(F.col("_host")))
        .where(F.col("_with") > max_ratio * F.col("_pages"))
        .groupBy("_h")
        .agg(F.collect_set("_mark").alias("_drop"))
    )
    frequent = materialize(frequent, "site-lines")
    joined = base.join(small_side(frequent), F.col(host_col).eqNullSafe(F.col("_h")), "left")
    none = F.array().cast("array<bigint>")
    stays = F.filter("_lines", lambda line: ~F.array_contains(F.coalesce("_drop", none), F.xxhash64(line)))
    kept = joined.withColumn("_stay", stays).withColumns(
        {"n_lines": F.size("_lines").cast("long"), "n_dropped": (F.size("_lines") - F.size("_stay")).cast("long"), text_col: F.array_join("_stay", "\n")}
    )
    return kept.drop("_h", "_drop", "_lines", "_stay")
