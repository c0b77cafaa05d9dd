"""Monotone calibration of scores by pooling adjacent violators over bins."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slantwise.operators.features import ROUND

BINS = 1 << 14
POOLED = "lower double, upper double, weight double, value double"


def _pooling():
    """Built where it is used, so workers need no copy of this package."""

    def pool(weight: np.ndarray, total: np.ndarray) -> list[int]:
        """First bin of each pool: neighbours merge while their means do not rise."""
        first, w, t = [], [], []
        for k in range(len(weight)):
            first.append(k)
            w.append(weight[k])
            t.append(total[k])
            while len(first) > 1 and t[-2] * w[-1] >= t[-1] * w[-2]:
                first.pop()
                w[-2:] = [w[-2] + w[-1]]
                t[-2:] = [t[-2] + t[-1]]
        return first

    def run(frames):
        bins = pd.concat(list(frames), ignore_index=True)
        if len(bins):
            starts = np.array(pool(bins["w"].to_numpy(), bins["t"].to_numpy()))
            ends = np.append(starts[1:], len(bins)) - 1
            weight, total = (np.add.reduceat(bins[c].to_numpy(), starts) for c in ("w", "t"))
            yield pd.DataFrame({"lower": bins["x0"].to_numpy()[starts], "upper": bins["x1"].to_numpy()[ends], "weight": weight, "value": total / weight})

    return run


def isotonic_table(
    df: DataFrame,
    score: Column,
    target: Column,
    weight: Column | None = None,
    low: float = 0.0,
    high: float = 1.0,
    bins: int = BINS,
) -> DataFrame:
    """Least-squares rising steps of ``target`` over ``score``: ``(lower, upper, weight, value)``.

    Scores fall into ``bins`` equal bins of ``[low, high]`` (those outside into the
    outer ones), and bins are partial sums, so whatever the number of rows, one
    task pools at most ``bins`` of them. With no two scores in a bin the
    steps are those of all single rows. Null scores and targets don't count.
    """
    rows = df.select(score.cast("double").alias("x"), target.cast("double").alias("y"), (F.lit(1.0) if weight is None else weight.cast("double")).alias("w"))
    rows = rows.where("x is not null and y is not null and w > 0")
    number = F.greatest(F.least(F.floor((F.col("x") - F.lit(low)) * F.lit(bins / (high - low))), F.lit(bins - 1)), F.lit(0))
    counted = rows.groupBy(number.alias("bin")).agg(
        F.sum("w").alias("w"), F.sum(F.col("w") * F.col("y")).alias("t"), F.min("x").alias("x0"), F.max("x").alias("x1")
    )
    return counted.coalesce(1).sortWithinPartitions("bin").mapInPandas(_pooling(), POOLED)


def isotonic_steps(df: DataFrame, score: Column, target: Column, **options) -> DataFrame:
    """``isotonic_table`` with a running number and rounded values."""
    table = isotonic_table(df, score, target, **options)
    # At most one row per bin.
    number = F.row_number().over(Window.orderBy("lower")).alias("step")
    return table.select(number, *[F.round(c, ROUND).alias(c) for c in ("lower", "upper", "weight", "value")])
