import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from slantwise import constants as K
from slantwise.functions import scores as sc
from slantwise.operators import features as ft
from slantwise.operators import linear as ln
from slantwise.operators import training as tr
from slantwise.plans import flows
from slantwise.session import CHECKPOINT_DIR, materialize, shared_dir, small_side
from slantwise.streaming.score_stream import read_scored_stream, score_stream

WORDS = {
    "left": "clinic union teacher welfare rent housing".split(),
    "center": "council meeting report weather budget agenda".split(),
    "right": "tariff farm business border market tax".split(),
}


@pytest.fixture(scope="module")
def raw(spark):
    rng = random.Random(4)
    rows = []
    for i in range(240):
        label = K.CLASSES[i % 3]
        words = [rng.choice(WORDS[label]) if rng.random() < 0.7 else rng.choice(WORDS[rng.choice(K.CLASSES)]) for _ in range(20)]
        rows.append((f"d{i:03d}", " ".join(words) + " is for the town", f"Paper{i % 3}", "2024-%02d-01" % (1 + i % 12), {"region": "ns"[i % 2]}))
    rows.append(("d998", "nobody labelled the text of this one, it is for the town and the county", "Else", "2024-01-01", {}))
    return spark.createDataFrame(rows, "doc_id string, text string, source string, date string, subset_meta map<string,string>")


@pytest.fixture(scope="module")
def splits(spark, raw, tmp_path_factory):
    by_source = spark.createDataFrame([(f"paper{i}", c) for i, c in enumerate(K.CLASSES)], "outlet_name string, label string")
    return flows.prepare(raw, by_source, None, str(tmp_path_factory.mktemp("splits") / "s"))


@pytest.fixture(scope="module")
def trained(splits):
    return flows.train(splits, min_df=2)


def test_prepare(splits):
    sizes = {r.split: r["count"] for r in splits.groupBy("split").count().collect()}
    assert sizes["unlabeled"] == 1 and sizes["test"] == 36 and sum(sizes.values()) == 241


def test_prepare_by_date(spark, raw, tmp_path):
    by_source = spark.createDataFrame([(f"paper{i}", c) for i, c in enumerate(K.CLASSES)], "outlet_name string, label string")
    stored = flows.prepare(raw, by_source, None, str(tmp_path / "t"), split_date="2024-10-01")
    assert stored.where("split = 'test' and date < '2024-10-01'").count() == 0
    assert stored.where("split = 'test'").count() == 60


def test_train_and_evaluate(trained):
    assert trained.test.report.where("row = 'accuracy'").first().f1 > 0.8
    assert trained.validation.confusion.agg(F.sum("count")).first()[0] == 36
    top = {r.class_name: r.phrase for r in trained.phrases.where("rank = 1").collect()}
    assert set(top) == set(K.CLASSES)
    assert trained.coefficients.where("coef <= 0").isEmpty()


def test_model_as_tables_scores_like_mllib(spark, splits):
    train = splits.where("split = 'train'")
    vocab = materialize(ft.vocabulary(train, min_df=2), "vocab")
    features = tr.feature_table(train, vocab)
    fitted = tr.fit_logreg(features)
    direct = {r.doc_id: list(r.p) for r in fitted.transform(features).select("doc_id", vector_to_array("probability").alias("p")).collect()}
    model = tr.train_logreg(train, vocab)
    ours = {r.doc_id: [r.prob_left, r.prob_center, r.prob_right] for r in flows.score(train, model).collect()}
    assert set(ours) == set(direct)
    for key in ours:
        assert ours[key] == pytest.approx(direct[key], abs=1e-5)
        assert sum(ours[key]) == pytest.approx(1.0)


def test_logreg_is_at_the_penalised_optimum(spark, splits):
    """The gradient of C * sum(w * loss) + |coef|^2 / 2 vanishes."""
    train = splits.where("split = 'train'").where("doc_id <> 'd000'")
    vocab = materialize(ft.vocabulary(train, min_df=2), "vocab")
    features = tr.feature_table(train, vocab)
    fitted = tr.fit_logreg(features, C=0.7, tol=1e-10)
    rows = features.collect()
    X = np.array([r.features.toArray() for r in rows])
    y = np.array([int(r.label_int) for r in rows])
    weight = len(y) / (3 * np.bincount(y)[y])
    coef, bias = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
    z = X @ coef.T + bias
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    gradient = 0.7 * ((p - np.eye(3)[y]) * weight[:, None]).T @ X + coef
    assert np.abs(gradient).max() < 1e-3


@pytest.mark.parametrize("calibration", ["sigmoid", "isotonic"])
def test_calibrated_svm(splits, calibration):
    train = splits.where("split = 'train'")
    vocab = materialize(ft.vocabulary(train, min_df=2), "vocab")
    model = tr.train_svm_calibrated(train, vocab, calibration=calibration, max_iter=15)
    rows = flows.score(splits.where("split = 'test'"), model).collect()
    assert all(r.prob_left + r.prob_center + r.prob_right == pytest.approx(1.0) for r in rows)
    assert sum(r.pred_label == r.label for r in rows) / len(rows) > 0.75


def test_missing_class_is_an_error(splits):
    train = splits.where("split = 'train' and label <> 'center'")
    vocab = materialize(ft.vocabulary(train, min_df=2), "vocab")
    with pytest.raises(ValueError, match="center"):
        tr.train_logreg(train, vocab)


def test_save_and_load(spark, trained, splits, tmp_path):
    path = str(tmp_path / "model")
    tr.save_model(trained.model, path)
    loaded = tr.load_model(spark, path)
    test = splits.where("split = 'test'")
    a = {r.doc_id: r.polarity_score for r in flows.score(test, trained.model).collect()}
    b = {r.doc_id: r.polarity_score for r in flows.score(test, loaded).collect()}
    assert a == pytest.approx(b)
    assert tr.export_terms(loaded).count() == loaded.rows


def test_stream_equals_batch(spark, trained, raw, tmp_path):
    incoming = tmp_path / "in"
    lines = raw.select(F.to_json(F.struct("doc_id", "text", "source")).alias("value"))
    lines.repartition(5).write.text(str(incoming))
    (incoming / "broken.txt").write_text("{not json\n")
    out = str(tmp_path / "out")
    for _ in range(2):
        score_stream(spark, str(incoming), out, str(tmp_path / "log"), trained.model, files_per_batch=2).awaitTermination()
    streamed = {r.doc_id: r.polarity_score for r in read_scored_stream(spark, out).collect()}
    batch = {r.doc_id: r.polarity_score for r in flows.score(raw, trained.model).collect()}
    assert streamed == pytest.approx(batch)


def test_report_flow(trained, raw):
    result = flows.report(flows.score(raw, trained.model), k=30)
    groups = {(r.field, r.group_name) for r in result.groups.collect()}
    assert {("source", "Paper0"), ("region", "n"), ("region", "s")} <= groups
    assert {r.group_name for r in result.suppressed.collect()} == {"Else", "unknown"}


def test_broadcast_is_size_checked(spark):
    small, large = spark.range(10), spark.range(100)
    other = spark.range(5)
    planned = lambda side: other.hint("merge").join(side, "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in planned(small_side(small, limit=20))
    assert "broadcast" not in planned(small_side(large, limit=20))
    assert "broadcast" not in planned(small_side(small, rows=21, limit=20))


class Session:
    """As much of a session as the folder lookup reads."""

    def __init__(self, master, folder=None):
        self.conf = {CHECKPOINT_DIR: folder} if folder else {}
        self.sparkContext = self
        self.master, self.applicationId = master, master


def test_shared_dir_comes_from_the_session():
    assert shared_dir(Session("yarn", "hdfs:///shared")) == "hdfs:///shared"
    with pytest.raises(ValueError, match=CHECKPOINT_DIR):
        shared_dir(Session("yarn"))
    local = Session("local[2]")
    assert shared_dir(local) == shared_dir(local)
