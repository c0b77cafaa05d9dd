"""The three end-to-end flows: prepare, train and evaluate, score and report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slantwise import constants as K
from slantwise.operators import evaluation as ev
from slantwise.operators import reports as rp
from slantwise.operators.features import DEFAULT_ANALYZER, Analyzer, chi2_phrases, topic_leakage, vocabulary
from slantwise.operators.labels import assign_labels, encode_labels, labeled, unlabeled
from slantwise.operators.linear import score_documents, top_coefficients
from slantwise.operators.prep import preprocess
from slantwise.operators.splitting import stratified_split, temporal_split
from slantwise.operators.training import CalibratedSvm, LinearModel, svm_score_documents, train_logreg, train_svm_calibrated
from slantwise.session import materialize
from slantwise.sinks.writers import write_splits


def prepare(
    docs: DataFrame,
    source_labels: DataFrame | None,
    human_labels: DataFrame | None,
    out_path: str,
    split_date: str | None = None,
    classes: Sequence[str] = K.CLASSES,
    **preprocessing,
) -> DataFrame:
    """Clean, label and split a corpus and store it partitioned by split.

    The labelled corpus is written once before splitting: the split needs the
    stratum sizes and a few cut keys first, and should not clean the text again
    for each of them.
    """
    clean = preprocess(docs, **preprocessing)
    corpus = materialize(encode_labels(assign_labels(clean, source_labels, human_labels), classes), "corpus")
    if split_date is None:
        split = stratified_split(corpus)
    else:
        split = temporal_split(corpus, split_date)
    rest = unlabeled(corpus).withColumn("split", F.lit(None).cast("string"))
    write_splits(split.unionByName(rest), out_path)
    return docs.sparkSession.read.parquet(out_path)


@dataclass(frozen=True)
class Evaluation:
    """Result tables of a scored, labelled set."""

    scored: DataFrame
    report: DataFrame
    confusion: DataFrame
    ece: DataFrame
    calibration: DataFrame
    errors: DataFrame
    leakage: DataFrame


def evaluate(scored: DataFrame, classes: Sequence[str] = K.CLASSES) -> Evaluation:
    """All evaluation tables of a scored set with ``label`` and ``text``."""
    known = labeled(scored)
    return Evaluation(
        known,
        ev.classification_report(known, classes=classes),
        ev.confusion_matrix(known, classes=classes),
        ev.expected_calibration_error(known, classes=classes),
        ev.calibration_curve(known, classes=classes),
        ev.misclassified(known, classes=classes),
        topic_leakage(known),
    )


@dataclass(frozen=True)
class Training:
    model: LinearModel | CalibratedSvm
    validation: Evaluation
    test: Evaluation
    phrases: DataFrame
    coefficients: DataFrame


def score(docs: DataFrame, model: LinearModel | CalibratedSvm) -> DataFrame:
    """Score documents with either kind of model."""
    if isinstance(model, CalibratedSvm):
        return svm_score_documents(docs, model)
    return score_documents(docs, model.wide(), model.intercepts, model.classes, model.analyzer, rows=model.rows)


def train(
    splits: DataFrame,
    model_type: str = "logistic_regression",
    C: float = 1.0,
    max_iter: int = 1000,
    calibration: str = "sigmoid",
    max_features: int = K.MAX_FEATURES,
    min_df: int | float = K.MIN_DF,
    max_df: int | float = K.MAX_DF,
    analyzer: Analyzer = DEFAULT_ANALYZER,
    classes: Sequence[str] = K.CLASSES,
) -> Training:
    """Fit on the stored ``train`` split; evaluate on ``val`` and ``test``."""
    fit_rows = splits.where("split = 'train'")
    vocab = materialize(vocabulary(fit_rows, analyzer, max_features, min_df, max_df), "vocab")
    if model_type == "logistic_regression":
        model = train_logreg(fit_rows, vocab, C, max_iter, classes, analyzer=analyzer)
        weights, names = model.weights, classes
    elif model_type == "linear_svm":
        model = train_svm_calibrated(fit_rows, vocab, C, max_iter, calibration, classes=classes, analyzer=analyzer)
        # The coefficients shown are those of the first fold.
        weights, names = model.margins.weights.where(F.col("class_idx") < len(classes)), classes
    else:
        raise ValueError(f"unknown model type {model_type!r}")

    def check(name: str) -> Evaluation:
        return evaluate(materialize(score(splits.where(F.col("split") == name), model), f"scored-{name}"), classes)

    return Training(
        model,
        check("val"),
        check("test"),
        chi2_phrases(fit_rows, vocab, classes=classes, analyzer=analyzer, vocab_rows=max_features),
        top_coefficients(weights, names),
    )


@dataclass(frozen=True)
class GroupReport:
    groups: DataFrame
    suppressed: DataFrame
    summary: DataFrame


def report(
    scored: DataFrame, fields: Sequence[str] = ("source", "region"), k: int = K.K_ANONYMITY, classes: Sequence[str] = K.CLASSES
) -> GroupReport:
    """Group report, suppressed groups and summary of a scored table."""
    return GroupReport(
        rp.multi_field_report(scored, fields, k, classes),
        rp.suppressed_groups(scored, fields, k),
        rp.subset_summary(scored, fields, k),
    )
