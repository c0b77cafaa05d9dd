"""One query per operator over the supplied tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slantwise import constants as K
from slantwise.catalog import fixtures as fx
from slantwise.functions import scores as sc
from slantwise.functions import text as tx
from slantwise.functions.arrays import contiguous_ngrams, let
from slantwise.functions.fields import coerce_date, subset_field
from slantwise.operators import calibration as cb
from slantwise.operators import evaluation as ev
from slantwise.operators import features as ft
from slantwise.operators import keywords as kw
from slantwise.operators import labels as lb
from slantwise.operators import language as lg
from slantwise.operators import linear as ln
from slantwise.operators import prep
from slantwise.operators import reports as rp
from slantwise.operators import splitting as sp
from slantwise.operators import training as tr
from slantwise.operators.mmr import mmr_select
from slantwise.operators.proposals import propose_labels
from slantwise.session import materialize, scratch_path
from slantwise.sinks import writers as wr
from slantwise.sources import documents as sd
from slantwise.sources import label_files as lf
from slantwise.streaming.score_stream import read_scored_stream, score_stream

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
PROBS = sc.prob_columns()
ROWS = K.MAX_FEATURES
# Between the sizes of the groups, so that the report has all its sections.
REPORT_K = 120


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def rounded(*names: str) -> list[Column]:
    return [F.round(name, 6).alias(name) for name in names]


# --- sources ---------------------------------------------------------------


def _json_lines(docs: DataFrame) -> DataFrame:
    """Documents as JSON lines, with broken lines mixed in between."""
    good = F.to_json(
        F.struct(F.col("doc_id").cast("string").alias("doc_id"), "text", "source", "date", "subset_meta", "lang")
    )
    key = F.col("doc_id").cast("string")
    bad = F.array(
        F.concat(F.lit('{"doc_id": "'), key, F.lit('", "text": "cut')),
        F.concat(F.lit('{"doc_id": "'), key, F.lit('"}')),
        F.lit("   "),
        F.concat(F.lit("["), key, F.lit("]")),
        F.concat(F.lit('{"doc_id": "'), key, F.lit('", "text": "x"} trailing')),
    )
    lines = F.array(good, F.get(bad, (F.col("doc_id") % 5).cast("int")))
    return docs.select(F.explode(lines).alias("value"))


def _document_view(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.md5("text").alias("text_md5"),
        "source",
        "date",
        F.try_variant_get("subset_meta", "$.region", "string").alias("region"),
        F.try_variant_get("record", "$.lang", "string").alias("lang"),
    )


@query
def jsonl_scan(spark, sf_dir):
    path = scratch_path(spark, "jsonl")
    _json_lines(fx.docs(spark, sf_dir)).write.text(path)
    return _document_view(sd.read_jsonl(spark, path))


@query
def jsonl_dir_scan(spark, sf_dir):
    path = scratch_path(spark, "jsonl-dir")
    docs = fx.docs(spark, sf_dir)
    for start in (0, 1):
        _json_lines(docs.where(F.col("doc_id") % 2 == start)).write.mode("append").text(path)
    return _document_view(sd.read_jsonl_dir(spark, path, pattern="part-*.txt"))


@query
def jsonl_rejects(spark, sf_dir):
    path = scratch_path(spark, "jsonl-rejects")
    _json_lines(fx.docs(spark, sf_dir)).write.text(path)
    found = sd.read_jsonl_rejects(spark, path, pattern="part-*.txt")
    return found.select(F.regexp_extract("line", r"(\d+)", 1).cast("bigint").alias("doc_id"), "reason")


@query
def txt_dir_scan(spark, sf_dir):
    path = scratch_path(spark, "txt")
    names = wr.write_txt_files(fx.docs(spark, sf_dir), path)
    read = sd.read_txt_dir(spark, path, recursive=True)
    found = read.select(
        *wr.txt_file_place(F.col("path")),
        F.md5("text").alias("text_md5"),
        F.char_length("text").alias("n_chars"),
        "source",
        "title",
    )
    return names.join(found, ["folder", "place"]).select("doc_id", "text_md5", "n_chars", "source", "title")


@query
def html_to_docs(spark, sf_dir):
    return sd.html_documents(fx.table(spark, sf_dir, "pages")).select("doc_id", "title", "text", "source")


def _with_wrong_first(labels: DataFrame, key: str) -> DataFrame:
    """Two rows per key, a wrong label before the right one, in file order."""
    other = F.when(F.col("label") == K.CLASSES[0], K.CLASSES[1]).otherwise(K.CLASSES[0])
    pair = F.array(F.struct(F.lit(0).alias("n"), other.alias("label")), F.struct(F.lit(1).alias("n"), F.upper("label").alias("label")))
    doubled = labels.select(key, F.inline(pair))
    return doubled.repartition(key).sortWithinPartitions(key, "n").select(key, "label")


@query
def source_labels_scan(spark, sf_dir):
    path = scratch_path(spark, "source-labels")
    labels = fx.source_labels(spark, sf_dir).withColumn("outlet_name", F.upper("outlet_name"))
    wr.write_csv(_with_wrong_first(labels, "outlet_name"), path)
    return lf.read_source_labels(spark, path)


@query
def human_labels_scan(spark, sf_dir):
    path = scratch_path(spark, "human-labels")
    wr.write_csv(_with_wrong_first(fx.human_labels(spark, sf_dir), "doc_id"), path)
    return lf.read_human_labels(spark, path, id_type="bigint")


def _stored_splits(spark, sf_dir) -> str:
    path = scratch_path(spark, "splits")
    corpus = fx.labeled_docs(spark, sf_dir).select("doc_id", "source", "label")
    split = sp.stratified_split(corpus)
    wr.write_splits(split.unionByName(lb.unlabeled(corpus), allowMissingColumns=True), path)
    return path


@query
def splits_scan(spark, sf_dir):
    path = _stored_splits(spark, sf_dir)
    return sd.read_split(spark, path, "train").select("doc_id", "source", "label", "label_int")


# --- sinks -----------------------------------------------------------------


@query
def split_sink(spark, sf_dir):
    stored = sd.read_split(spark, _stored_splits(spark, sf_dir))
    return stored.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.count("label").alias("labels"))


@query
def label_template(spark, sf_dir):
    path = scratch_path(spark, "template")
    wr.write_label_template(wr.label_template(fx.docs(spark, sf_dir), fx.human_labels(spark, sf_dir)), path)
    sheet = spark.read.options(header=True, comment="#").schema(
        "doc_id bigint, label string, confidence string, notes string"
    ).csv(path)
    return sheet.select("doc_id", *[F.coalesce(c, F.lit("")).alias(c) for c in ("label", "confidence", "notes")])


@query
def scored_sink(spark, sf_dir):
    path = scratch_path(spark, "scored")
    wanted = ["doc_id", "source", "pred_label", "polarity_score", "entropy"]
    # Values of several kinds, nested, as a variant.
    known = F.struct(F.col("label").alias("label"), F.col("label").isNotNull().alias("labeled"), F.array("doc_id", F.lit(None)).alias("ids"))
    meta = F.parse_json(F.to_json(known, {"ignoreNullFields": "false"})).alias("meta")
    wr.write_jsonl(fx.scored(spark, sf_dir).select(*wanted, meta), path)
    stored = spark.read.schema(
        "doc_id bigint, source string, pred_label string, polarity_score double, entropy double, meta string"
    ).json(path)
    return stored.select("doc_id", "source", "pred_label", *rounded("polarity_score", "entropy"), "meta")


@query
def errors_sink(spark, sf_dir):
    path = scratch_path(spark, "errors")
    errors = ev.misclassified(lb.labeled(fx.scored(spark, sf_dir)))
    wr.write_csv(errors.select("doc_id", "true_label", "pred_label", "confidence", "text_snippet"), path)
    stored = (
        spark.read.schema("doc_id bigint, true_label string, pred_label string, confidence double, text_snippet string")
        .options(header=True, multiLine=True, quote='"', escape='"')
        .csv(path)
    )
    return stored.select("doc_id", "true_label", "pred_label", *rounded("confidence"), F.md5("text_snippet").alias("snippet_md5"))


@query
def report_sink(spark, sf_dir):
    path = scratch_path(spark, "report")
    rp.write_report(rp.report_sections(fx.scored(spark, sf_dir), ("source", "region", "lang"), REPORT_K), path)
    return rp.section_lines(rp.read_report(spark, path))


@query
def model_tables(spark, sf_dir):
    path = scratch_path(spark, "model")
    corpus, tokenized = fx.token_docs(fx.clean_docs(spark, sf_dir))
    vocab = fx.fitted_vocabulary(spark, sf_dir, tokenized, corpus)
    tr.save_model(tr.train_logreg(corpus, vocab, analyzer=tokenized), path)
    exported = tr.export_terms(tr.load_model(spark, path))
    return exported.select("term", "idx", "idf", *[F.get("coef", F.lit(i)).alias(f"coef_{c}") for i, c in enumerate(K.CLASSES)])


# --- projections and filters ------------------------------------------------


@query
def normalize_text(spark, sf_dir):
    return fx.docs(spark, sf_dir).select("doc_id", tx.normalize_text(F.col("text")).alias("text"))


@query
def text_hash(spark, sf_dir):
    return fx.docs(spark, sf_dir).select("doc_id", tx.text_hash(F.col("text")).alias("text_hash"))


@query
def filter_length(spark, sf_dir):
    kept = prep.filter_length(fx.docs(spark, sf_dir), 50, 5000)
    return kept.select("doc_id", F.char_length("text").alias("n_chars"))


@query
def detect_language(spark, sf_dir):
    detected = fx.profiles(spark, sf_dir).detect(F.col("text"))
    return fx.docs(spark, sf_dir).select("doc_id", "lang", detected.alias("detected"))


@query
def language_profiles(spark, sf_dir):
    return lg.language_profiles(fx.docs(spark, sf_dir))


@query
def language_confusion(spark, sf_dir):
    return lg.language_confusion(fx.docs(spark, sf_dir), fx.profiles(spark, sf_dir))


@query
def detect_language_by_words(spark, sf_dir):
    return fx.docs(spark, sf_dir).select("doc_id", "lang", tx.detect_language(F.col("text")).alias("detected"))


@query
def filter_language(spark, sf_dir):
    return prep.filter_language(fx.docs(spark, sf_dir), "en", profiles=fx.profiles(spark, sf_dir)).select("doc_id", "lang")


@query
def preprocess_docs(spark, sf_dir):
    cleaned = prep.preprocess(fx.docs(spark, sf_dir), profiles=fx.profiles(spark, sf_dir))
    return cleaned.select("doc_id", "source", "text")


@query
def label_encode(spark, sf_dir):
    return lb.encode_labels(fx.labeled_docs(spark, sf_dir)).select("doc_id", "label", "label_int")


def _gram_digest(docs: DataFrame, grams: Column) -> DataFrame:
    """Per document: number of n-grams, of distinct ones, and a digest of all."""
    found = let(
        grams,
        lambda g: F.struct(
            F.size(g).alias("n_grams"),
            F.size(F.array_distinct(g)).alias("n_distinct"),
            F.md5(F.array_join(F.sort_array(g), "|")).alias("digest"),
        ),
    )
    return docs.select("doc_id", found.alias("g")).select("doc_id", "g.n_grams", "g.n_distinct", "g.digest")


@query
def tokenize_ngrams(spark, sf_dir):
    return _gram_digest(fx.docs(spark, sf_dir), tx.ngrams(F.col("text")))


@query
def tokenize_simple(spark, sf_dir):
    return _gram_digest(fx.docs(spark, sf_dir), contiguous_ngrams(tx.simple_tokens(F.col("text")), 1, 3))


@query
def argmax_label(spark, sf_dir):
    return fx.scored(spark, sf_dir).select(
        "doc_id", sc.argmax_index(sc.probabilities()).alias("pred_index"), "pred_label"
    )


@query
def polarity_score(spark, sf_dir):
    return fx.scored(spark, sf_dir).select("doc_id", *rounded("polarity_score"))


@query
def entropy_eps(spark, sf_dir):
    return fx.scored(spark, sf_dir).select("doc_id", *rounded("entropy"))


@query
def entropy_exact(spark, sf_dir):
    exact = sc.entropy_exact(sc.probabilities())
    return fx.scored(spark, sf_dir).select("doc_id", F.round(exact, 6).alias("entropy"))


@query
def confidence_note(spark, sf_dir):
    return fx.scored(spark, sf_dir).select("doc_id", sc.confidence_note(F.col("entropy")).alias("note"))


@query
def subset_field_keys(spark, sf_dir):
    df = fx.docs(spark, sf_dir)
    return df.select(
        "doc_id", subset_field(df, "source").alias("source_key"), subset_field(df, "region").alias("region_key")
    )


REGISTRY["subset_field"] = REGISTRY.pop("subset_field_keys")


@query
def coerce_dates(spark, sf_dir):
    dated = fx.docs(spark, sf_dir).withColumn("ts", coerce_date(F.col("date"))).where(F.col("ts").isNotNull())
    return dated.select("doc_id", F.date_format("ts", "yyyy-MM-dd").alias("day"))


REGISTRY["coerce_date"] = REGISTRY.pop("coerce_dates")


# --- joins -----------------------------------------------------------------


@query
def assign_source_labels(spark, sf_dir):
    return lb.assign_source_labels(fx.docs(spark, sf_dir), fx.source_labels(spark, sf_dir)).select(
        "doc_id", "source", "label"
    )


@query
def assign_labels(spark, sf_dir):
    return fx.labeled_docs(spark, sf_dir).select("doc_id", "source", "label")


@query
def label_tier_counts(spark, sf_dir):
    tiers = lb.label_tiers(fx.docs(spark, sf_dir), fx.source_labels(spark, sf_dir), fx.human_labels(spark, sf_dir))
    return lb.label_tier_counts(tiers)


@query
def labeled_unlabeled(spark, sf_dir):
    df = fx.labeled_docs(spark, sf_dir)
    return df.select("doc_id", lb.is_labeled().alias("labeled"))


@query
def tfidf_transform(spark, sf_dir):
    stored = fx.stored_docs(spark, sf_dir)
    vocab = fx.fitted_vocabulary(spark, sf_dir, stored=stored)
    table = ft.tfidf_transform(stored, vocab, vocab_rows=ROWS)
    return table.select("doc_id", "term", "tf", *rounded("tfidf"))


@query
def linear_score(spark, sf_dir):
    model = fx.fixed_model(spark, sf_dir)
    return ln.linear_scores(fx.docs(spark, sf_dir), model.wide(), model.intercepts, normalize=True, rows=ROWS).select(
        "doc_id", *rounded("z_0", "z_1", "z_2")
    )


# --- aggregations ----------------------------------------------------------


@query
def dedup_exact(spark, sf_dir):
    return prep.deduplicate(fx.docs(spark, sf_dir)).select("doc_id", "source")


@query
def label_distribution(spark, sf_dir):
    return lb.label_distribution(fx.labeled_docs(spark, sf_dir))


@query
def vocabulary(spark, sf_dir):
    corpus = lb.labeled(fx.clean_docs(spark, sf_dir))
    return ft.vocabulary(corpus, max_features=K.MAX_FEATURES).select("term", "idx", "df", "cf", *rounded("idf"))


@query
def tfidf_fit(spark, sf_dir):
    stored = fx.stored_docs(spark, sf_dir)
    vocab = fx.fitted_vocabulary(spark, sf_dir, stored=stored)
    return ft.tfidf_fit(lb.labeled(stored), vocab, vocab_rows=ROWS)


@query
def chi2_phrases(spark, sf_dir):
    stored = fx.stored_docs(spark, sf_dir)
    return ft.chi2_phrases(lb.labeled(stored), fx.fitted_vocabulary(spark, sf_dir, stored=stored), vocab_rows=ROWS)


@query
def group_phrases(spark, sf_dir):
    stored = fx.stored_docs(spark, sf_dir)
    vocab = fx.fitted_vocabulary(spark, sf_dir, stored=stored)
    return ft.group_phrases(stored, vocab, subset_field(stored, "source"), k=30, vocab_rows=ROWS)


@query
def mi_phrases(spark, sf_dir):
    stored = fx.stored_docs(spark, sf_dir)
    return ft.mi_phrases(lb.labeled(stored), fx.fitted_vocabulary(spark, sf_dir, stored=stored), vocab_rows=ROWS)


def _evaluated(spark, sf_dir) -> DataFrame:
    return lb.labeled(fx.scored(spark, sf_dir))


@query
def confusion_matrix(spark, sf_dir):
    return ev.confusion_matrix(_evaluated(spark, sf_dir))


@query
def accuracy(spark, sf_dir):
    return ev.accuracy(_evaluated(spark, sf_dir))


@query
def per_class_metrics(spark, sf_dir):
    return ev.per_class_metrics(_evaluated(spark, sf_dir))


@query
def macro_f1(spark, sf_dir):
    return ev.macro_f1(_evaluated(spark, sf_dir))


@query
def classification_report(spark, sf_dir):
    return ev.classification_report(_evaluated(spark, sf_dir))


@query
def ece(spark, sf_dir):
    return ev.expected_calibration_error(_evaluated(spark, sf_dir))


@query
def calibration_curve(spark, sf_dir):
    return ev.calibration_curve(_evaluated(spark, sf_dir))


@query
def score_histogram(spark, sf_dir):
    return ev.score_histogram(fx.scored(spark, sf_dir))


@query
def score_histogram_by_group(spark, sf_dir):
    return ev.score_histogram(fx.scored(spark, sf_dir), group_col="source")


@query
def topic_leakage(spark, sf_dir):
    return ft.topic_leakage(fx.scored(spark, sf_dir))


@query
def subset_report(spark, sf_dir):
    return rp.subset_report(fx.scored(spark, sf_dir), "source")


@query
def suppressed_groups(spark, sf_dir):
    return rp.suppressed_groups(fx.scored(spark, sf_dir), ["source", "lang"], 60)


@query
def subset_summary(spark, sf_dir):
    return rp.subset_summary(fx.scored(spark, sf_dir), ["source", "region"])


@query
def multi_field_report(spark, sf_dir):
    return rp.multi_field_report(fx.scored(spark, sf_dir), ("source", "region", "lang"))


@query
def score_summary(spark, sf_dir):
    return ev.score_summary(fx.scored(spark, sf_dir))


# --- windows and top-k -----------------------------------------------------


@query
def stratified_split(spark, sf_dir):
    corpus = fx.labeled_docs(spark, sf_dir).select("doc_id", "source", "label")
    return sp.stratified_split(corpus)


@query
def temporal_split(spark, sf_dir):
    corpus = fx.labeled_docs(spark, sf_dir).select("doc_id", "date", "label")
    return sp.temporal_split(corpus, "2024-06-01")


@query
def top_coefficients(spark, sf_dir):
    return ln.top_coefficients(fx.fixed_weights(fx.fitted_vocabulary(spark, sf_dir)))


@query
def explain_terms(spark, sf_dir):
    stored = fx.stored_docs(spark, sf_dir)
    model = fx.fixed_model(spark, sf_dir, stored)
    return ln.explain_terms(stored, model.wide(), model.intercepts, rows=ROWS)


@query
def leave_one_out(spark, sf_dir):
    stored = fx.stored_docs(spark, sf_dir)
    model = fx.fixed_model(spark, sf_dir, stored)
    return ln.leave_one_out(stored, model.wide(), model.intercepts, rows=ROWS)


@query
def misclassified(spark, sf_dir):
    wrong = ev.misclassified(_evaluated(spark, sf_dir))
    return wrong.select(
        "doc_id", "true_label", "pred_label", *rounded("confidence", *PROBS), "source", "text_snippet"
    )


@query
def error_rate(spark, sf_dir):
    return ev.error_rate(_evaluated(spark, sf_dir))


@query
def propose_labels_all(spark, sf_dir):
    return propose_labels(fx.rounds(spark, sf_dir), lb.unlabeled(fx.scored(spark, sf_dir)), confidence=0.5)


REGISTRY["propose_labels"] = REGISTRY.pop("propose_labels_all")


@query
def class_keywords(spark, sf_dir):
    return kw.class_keywords(lb.labeled(fx.clean_docs(spark, sf_dir)))


@query
def doc_keywords(spark, sf_dir):
    return kw.doc_keywords(fx.clean_docs(spark, sf_dir), top_k=5)


@query
def mmr_picks(spark, sf_dir):
    return mmr_select(fx.vector_candidates(spark, sf_dir), top_k=5, diversity=0.5)


REGISTRY["mmr_select"] = REGISTRY.pop("mmr_picks")


@query
def mmr_relevance_only(spark, sf_dir):
    return mmr_select(fx.vector_candidates(spark, sf_dir), top_k=5, diversity=0.0)


# --- set operations --------------------------------------------------------


@query
def union_files(spark, sf_dir):
    docs = fx.docs(spark, sf_dir).select("doc_id", "source", "date")
    pages = fx.table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), "url")
    return sd.union_documents(docs, pages)


# --- training and scoring --------------------------------------------------


@query
def train_logreg(spark, sf_dir):
    corpus, tokenized = fx.token_docs(fx.clean_docs(spark, sf_dir))
    model = tr.train_logreg(corpus, fx.fitted_vocabulary(spark, sf_dir, tokenized, corpus), analyzer=tokenized)
    return ln.top_coefficients(model.weights)


@query
def train_svm_calibrated(spark, sf_dir):
    stored = fx.stored_docs(spark, sf_dir)
    corpus, tokenized = fx.token_docs(stored)
    model = tr.train_svm_calibrated(corpus, fx.fitted_vocabulary(spark, sf_dir, tokenized, corpus), analyzer=tokenized)
    return tr.svm_score_documents(stored.select("doc_id", "text"), model).drop("text")


@query
def isotonic_calibration(spark, sf_dir):
    known = _evaluated(spark, sf_dir).withColumn("confidence", F.greatest(*[F.col(p) for p in PROBS]))
    right = (F.col("label") == F.col("pred_label")).cast("double")
    return cb.isotonic_steps(known, F.round("confidence", 2), right, bins=1000)


@query
def predict_proba(spark, sf_dir):
    model = fx.fixed_model(spark, sf_dir)
    decisions = ln.linear_scores(fx.docs(spark, sf_dir), model.wide(), model.intercepts, normalize=True, rows=ROWS)
    return ln.predict_proba(decisions).select("doc_id", *rounded(*PROBS))


@query
def score_documents(spark, sf_dir):
    model = fx.fixed_model(spark, sf_dir)
    scored = ln.score_documents(fx.docs(spark, sf_dir), model.wide(), model.intercepts, rows=ROWS)
    return scored.select("doc_id", "source", "pred_label", *rounded(*PROBS, "polarity_score", "entropy"))


@query
def balanced_weights(spark, sf_dir):
    weights = lb.balanced_weights(fx.labeled_docs(spark, sf_dir))
    return weights.select("label", "count", *rounded("weight"))


# --- streaming -------------------------------------------------------------


@query
def stream_score(spark, sf_dir):
    model = fx.fixed_model(spark, sf_dir)
    in_dir, out_dir = scratch_path(spark, "stream-in"), scratch_path(spark, "stream-out")
    _json_lines(fx.docs(spark, sf_dir)).write.text(in_dir)
    score_stream(spark, in_dir, out_dir, scratch_path(spark, "stream-log"), model, files_per_batch=4).awaitTermination()
    return read_scored_stream(spark, out_dir).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "pred_label", *rounded(*PROBS, "polarity_score", "entropy")
    )


# --- flagship --------------------------------------------------------------


@query
def scored_group_report(spark, sf_dir):
    """Clean, de-duplicate, score with the fixed model, report by language and source.

    The cleaned corpus and the narrow scored table are written on the way, as in
    any run that keeps them: the text is cleaned and shuffled once, and the
    report's passes read a few columns.
    """
    model = fx.fixed_model(spark, sf_dir)
    corpus = materialize(prep.preprocess(fx.docs(spark, sf_dir), language=None), "corpus")
    scored = ln.score_documents(corpus, model.wide(), model.intercepts, normalize=False, rows=ROWS)
    return rp.multi_field_report(materialize(scored.drop("text"), "scored"), ("lang", "source", "region"))
