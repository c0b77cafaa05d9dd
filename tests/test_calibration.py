"""Isotonic steps against the closed form, and smoothed targets."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from slantwise.operators import features as ft
from slantwise.operators import training as tr
from slantwise.operators.calibration import isotonic_table
from slantwise.operators.training import smoothed_targets


def closed_form(points):
    """Fitted value per distinct x: the largest mean from the left of the least mean to the right."""
    xs = sorted({x for x, _, _ in points})
    w = np.array([sum(p[2] for p in points if p[0] == x) for x in xs])
    t = np.array([sum(p[1] * p[2] for p in points if p[0] == x) for x in xs])
    mean = lambda a, b: t[a : b + 1].sum() / w[a : b + 1].sum()
    return {x: max(min(mean(a, b) for b in range(k, len(xs))) for a in range(k + 1)) for k, x in enumerate(xs)}


@pytest.mark.parametrize("seed,n", [(1, 60), (2, 1), (3, 25), (4, 40)])
def test_steps_match_the_closed_form(spark, seed, n):
    rng = random.Random(seed)
    points = [(rng.randint(0, 30) / 31, float(rng.random() < 0.3 + 0.02 * rng.randint(0, 30)), float(rng.choice([1, 1, 2.5]))) for _ in range(n)]
    rows = points + [(None, 1.0, 1.0), (0.5, None, 1.0), (0.5, 1.0, 0.0)]
    df = spark.createDataFrame(rows, "x double, y double, w double").repartition(4)
    table = isotonic_table(df, F.col("x"), F.col("y"), F.col("w"), bins=310).orderBy("lower").collect()
    want = closed_form(points)
    assert sum(r.weight for r in table) == pytest.approx(sum(p[2] for p in points))
    assert all(a.upper < b.lower and a.value < b.value for a, b in zip(table, table[1:]))
    for x, value in want.items():
        (step,) = [r for r in table if r.lower <= x <= r.upper]
        assert step.value == pytest.approx(value)


def test_few_bins_bound_the_steps(spark):
    df = spark.range(5000).select((F.col("id") / 5000 * 3 - 1).alias("x"), (F.col("id") % 2).alias("y"))
    table = isotonic_table(df, F.col("x"), F.col("y"), bins=7).collect()
    assert len(table) <= 7 and sum(r.weight for r in table) == 5000
    assert isotonic_table(df.limit(0), F.col("x"), F.col("y")).collect() == []


def test_targets_stop_short_of_zero_and_one(spark):
    df = spark.createDataFrame([(0.5, 1.0), (1.5, 1.0), (-1.0, 0.0)], "margin double, target double")
    rows = sorted(map(tuple, smoothed_targets(df).collect()))
    assert [r[:2] for r in rows] == [(-1.0, 0.0), (-1.0, 1.0), (0.5, 0.0), (0.5, 1.0), (1.5, 0.0), (1.5, 1.0)]
    assert [r[2] for r in rows] == pytest.approx([2 / 3, 1 / 3, 1 / 4, 3 / 4, 1 / 4, 3 / 4])


def test_separators_do_not_depend_on_how_many_are_fitted_at_once(spark):
    words = {"left": "union wages strike", "center": "weather council budget", "right": "taxes market border"}
    rows = [(k % 9, name, " ".join(words[name].split()[: 1 + k % 3])) for k in range(18) for name in words]
    docs = spark.createDataFrame(rows, "doc_id long, label string, text string").coalesce(1)
    vocab = ft.vocabulary(docs, max_features=20, min_df=1, max_df=1.0).persist()
    table = tr.feature_table(docs, vocab)
    assert table.count() == len(rows)
    one, three = (tr.train_svm_calibrated(docs.withColumn("doc_id", F.monotonically_increasing_id()), vocab, max_iter=3, fits_at_once=n) for n in (1, 3))
    assert [x for pair in one.sigmoid for x in pair] == pytest.approx([x for pair in three.sigmoid for x in pair])
    assert len(three.sigmoid) == 9
