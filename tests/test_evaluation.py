import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from slantwise.functions import scores as sc
from slantwise.operators import evaluation as ev
from slantwise.operators import reports as rp
from slantwise.operators.mmr import mmr_select
from slantwise.operators.proposals import propose_labels

SCHEMA = "doc_id long, label string, prob_left double, prob_center double, prob_right double"
ROWS = [
    (0, "left", 1.0, 0.0, 0.0),
    (1, "center", 0.2, 0.3, 0.5),
    (2, "right", 0.25, 0.25, 0.5),
    (3, "left", 0.4, 0.4, 0.2),
    (4, "left", 0.3, 0.1, 0.6),
    (5, "right", 1 / 3, 1 / 3, 1 / 3),
]


@pytest.fixture(scope="module")
def scored(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    probs = sc.probabilities()
    return df.withColumn("pred_label", sc.argmax_label(probs)).withColumn("polarity_score", sc.signed_score(probs))


def test_ties_go_to_the_first_class(scored):
    got = {r.doc_id: r.pred_label for r in scored.collect()}
    assert got == {0: "left", 1: "right", 2: "right", 3: "left", 4: "right", 5: "left"}


def test_entropies_and_note(scored):
    rows = {r.doc_id: r for r in scored.select(
        "doc_id", sc.entropy_exact(sc.probabilities()).alias("e"), sc.entropy_eps(sc.probabilities()).alias("g")
    ).withColumn("note", sc.confidence_note(F.col("e"))).collect()}
    assert rows[0].e == 0 and rows[0].note == "Relatively confident"
    assert rows[5].e == pytest.approx(math.log(3)) and rows[5].note == "High uncertainty"
    for number, _, *p in ROWS:
        assert rows[number].g == pytest.approx(-sum(x * math.log(x + 1e-10) for x in p))


def test_softmax_is_stable(spark):
    df = spark.createDataFrame([(1000.0, 1001.0, -1000.0)], "a double, b double, c double")
    p = df.select(*[x.alias(str(i)) for i, x in enumerate(sc.softmax([F.col("a"), F.col("b"), F.col("c")]))]).first()
    assert sum(p) == pytest.approx(1.0) and p[1] == pytest.approx(1 / (1 + math.exp(-1)))


def test_metrics(scored):
    cells = {(r.true_label, r.pred_label): r["count"] for r in ev.confusion_matrix(scored).collect()}
    assert len(cells) == 9 and sum(cells.values()) == 6 and cells[("center", "center")] == 0
    assert ev.accuracy(scored).first().accuracy == pytest.approx(0.5)
    per = {r.class_name: r for r in ev.per_class_metrics(scored).collect()}
    assert (per["left"].precision, per["left"].recall, per["left"].support) == (pytest.approx(2 / 3, abs=1e-6), pytest.approx(2 / 3, abs=1e-6), 3)
    assert per["center"].f1 == 0 and per["right"].f1 == pytest.approx(0.4)
    assert ev.macro_f1(scored).first().macro_f1 == pytest.approx((2 / 3 + 0 + 0.4) / 3, abs=1e-6)
    no_center = scored.where("label <> 'center'")
    assert ev.macro_f1(no_center).first().macro_f1 > ev.macro_f1(scored).first().macro_f1
    report = {r["row"]: r for r in ev.classification_report(scored).collect()}
    assert report["macro avg"].f1 == pytest.approx((2 / 3 + 0.4) / 3, abs=1e-6)
    assert report["weighted avg"].recall == report["accuracy"].f1 == pytest.approx(0.5)
    assert ev.error_rate(scored).first().errors == 3


def test_calibration_bins(scored):
    confidence = np.array([max(p) for _, _, *p in ROWS])
    right = np.array([1, 0, 1, 1, 0, 0.0])
    edges = np.linspace(0, 1, 11)
    ece, curve = 0.0, []
    for low, high in zip(edges[:-1], edges[1:]):
        mask = (confidence > low) & (confidence <= high)
        if mask.any():
            ece += mask.mean() * abs(right[mask].mean() - confidence[mask].mean())
            curve.append((round(low, 6), confidence[mask].mean(), right[mask].mean(), mask.sum()))
    assert ev.expected_calibration_error(scored).first().ece == pytest.approx(ece, abs=1e-6)
    got = [(r.bin_lower, r.mean_confidence, r.mean_accuracy, r["count"]) for r in ev.calibration_curve(scored).orderBy("bin_lower").collect()]
    assert len(got) == len(curve)
    for a, b in zip(got, curve):
        assert a == pytest.approx(b, abs=1e-6)
    assert ev.calibration_curve(scored).orderBy("bin_lower").first().bin == "(0.30, 0.40]"
    assert ev.bin_edges(10) == list(edges)


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(1)
    scores = np.concatenate([np.linspace(-1, 1, 41), rng.uniform(-1, 1, 200), [-1.0, 1.0, 0.0]])
    df = spark.createDataFrame([(float(s), "a" if i % 3 else "b") for i, s in enumerate(scores)], "polarity_score double, g string")
    rows = ev.score_histogram(df).orderBy("bin").collect()
    assert [r["count"] for r in rows] == list(np.histogram(scores, bins=40, range=(-1, 1))[0])
    assert rows[0].median_score == pytest.approx(float(np.median(scores)), abs=1e-6)
    grouped = ev.score_histogram(df, group_col="g")
    assert grouped.count() == 80 and grouped.agg(F.sum("count")).first()[0] == len(scores)


def test_misclassified(scored):
    df = scored.withColumn("text", F.repeat(F.lit("é"), 400)).withColumn("source", F.lit("s"))
    assert all(len(r.text_snippet) == 400 for r in ev.misclassified(df).collect())
    rows = ev.misclassified(df, max_save=2, snippet_chars=300).collect()
    assert [r.doc_id for r in rows] == [1, 4] and len(rows[0].text_snippet) == 300
    assert ev.misclassified(scored.where("doc_id = 0")).count() == 0


def test_summary(scored):
    rows = {r.pred_label: r for r in ev.score_summary(scored).collect()}
    assert rows["left"]["count"] == 3 and rows["left"].documents == 6


@pytest.fixture(scope="module")
def grouped(spark):
    rng = np.random.default_rng(2)
    rows = []
    for name, n in (("a", 50), ("b", 30), ("c", 15), (None, 5)):
        for _ in range(n):
            p = rng.dirichlet([1, 1, 1])
            rows.append((len(rows), name, {"region": "north"} if len(rows) < 35 else {"other": "x"}, *map(float, p)))
    df = spark.createDataFrame(rows, "doc_id long, source string, subset_meta map<string,string>, prob_left double, prob_center double, prob_right double")
    probs = sc.probabilities()
    return df.withColumn("pred_label", sc.argmax_label(probs)).withColumn("polarity_score", sc.signed_score(probs))


@pytest.mark.parametrize("k, reported", [(30, {"a", "b"}), (31, {"a"}), (100, set()), (1, {"a", "b", "c", "unknown"})])
def test_small_groups_are_suppressed(grouped, k, reported):
    report = rp.subset_report(grouped, "source", k).collect()
    hidden = rp.suppressed_groups(grouped, ["source"], k).collect()
    assert {r.group_name for r in report} == reported
    assert {r.group_name for r in hidden} == {"a", "b", "c", "unknown"} - reported
    for r in report:
        assert r.score_min <= r.score_mean <= r.score_max and r.size >= k
        assert r.count_left + r.count_center + r.count_right == r.size
    summary = rp.subset_summary(grouped, ["source"], k).collect()
    assert len(summary) == bool(reported)
    if reported:
        assert (summary[0].groups_reported, summary[0].groups_suppressed) == (len(reported), 4 - len(reported))


def test_group_statistics(grouped):
    rows = [r for r in grouped.collect() if r.source == "b"]
    scores = np.array([r.polarity_score for r in rows])
    got = next(r for r in rp.subset_report(grouped, "source").collect() if r.group_name == "b")
    assert got.score_median == pytest.approx(np.median(scores), abs=1e-6)
    assert got.score_std == pytest.approx(np.std(scores), abs=1e-6)
    entropy = [-sum(p * math.log(p) for p in (r.prob_left, r.prob_center, r.prob_right)) for r in rows]
    assert got.mean_entropy == pytest.approx(np.mean(entropy), abs=1e-6)


def test_metadata_fields(spark, grouped):
    sizes = {r.group_name: r.size for r in rp.subset_report(grouped, "region", 1).collect()}
    assert sizes == {"north": 35, "unknown": 65}
    assert rp.subset_report(grouped.drop("subset_meta"), "region", 1).count() == 0
    both = rp.multi_field_report(grouped, ("source", "region", "region2"), 1)
    assert {r.field for r in both.collect()} == {"source", "region", "region2"}
    variant = grouped.withColumn("subset_meta", F.try_parse_json(F.to_json("subset_meta")))
    assert {r.group_name: r.size for r in rp.subset_report(variant, "region", 1).collect()} == sizes


def test_masked_sizes(grouped):
    rows = rp.suppressed_groups(grouped, ["source"], 30, mask_sizes=True).collect()
    assert {r.size for r in rows} == {None} and not any(str(n) in r.reason for r in rows for n in (15, 5))


def test_report_lines(grouped):
    lines = [r.line for r in rp.report_lines(rp.subset_report(grouped, "source")).orderBy("group_name", "line_no").collect()]
    assert lines[0] == "a | 50 documents" and lines[1].startswith("polarity ") and len(lines) == 8


def test_proposals(spark):
    rounds = [(1, 0.9, 0.1, 0.0), (1, 0.8, 0.1, 0.1), (2, 0.9, 0.1, 0.0), (2, 0.1, 0.9, 0.0), (3, 0.0, 0.1, 0.9), (3, 0.0, 0.1, 0.9)]
    final = [(1, 0.9, 0.1, 0.0), (2, 0.9, 0.1, 0.0), (3, 0.05, 0.0, 0.95), (4, 0.99, 0.01, 0.0)]
    columns = "doc_id long, prob_left double, prob_center double, prob_right double"
    r, f = spark.createDataFrame(rounds, columns), spark.createDataFrame(final, columns)
    got = [(x.doc_id, x.proposed_label, x.confidence) for x in propose_labels(r, f).collect()]
    assert got == [(3, "right", 0.95), (1, "left", 0.9)]
    assert [x.doc_id for x in propose_labels(r, f, max_new=1).collect()] == [3]


def greedy(vectors, query, top_k, diversity):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    rel = unit @ (query / np.linalg.norm(query))
    chosen = [int(np.argmax(rel))]
    while len(chosen) < min(top_k, len(vectors)):
        rest = [i for i in range(len(vectors)) if i not in chosen]
        worth = {i: (1 - diversity) * rel[i] - diversity * max(unit[i] @ unit[c] for c in chosen) for i in rest}
        chosen.append(max(rest, key=lambda i: worth[i]))
    return chosen


@pytest.mark.parametrize("diversity", [0.0, 0.3, 0.7])
def test_mmr_of_groups(spark, diversity):
    rng = np.random.default_rng(3)
    rows, expected = [], {}
    for group, n in (("big", 12), ("small", 3)):
        vectors, query = rng.normal(size=(n, 4)), rng.normal(size=4)
        rows += [(group, i, [float(x) for x in v], [float(x) for x in query]) for i, v in enumerate(vectors)]
        expected[group] = greedy(vectors, query, 4, diversity)
    df = spark.createDataFrame(rows, "group_id string, cand_id long, vector array<double>, query array<double>")
    picks = {}
    for r in mmr_select(df, 4, diversity).orderBy("group_id", "pick").collect():
        picks.setdefault(r.group_id, []).append(r.cand_id)
    assert picks == expected


def test_mmr_without_vectors(spark):
    rows = [("a", 1, None, [1.0, 0.0]), ("a", 2, [1.0, 0.0], [1.0, 0.0]), ("a", 3, [0.0, 0.0], [1.0, 0.0]), ("b", 4, [1.0, 0.0], None)]
    df = spark.createDataFrame(rows, "group_id string, cand_id long, vector array<double>, query array<double>")
    got = [tuple(r) for r in mmr_select(df, 5).orderBy("group_id", "pick").collect()]
    assert got == [("a", 1, 2, 1.0), ("a", 2, 1, 0.0), ("a", 3, 3, 0.0), ("b", 1, 4, 0.0)]
