"""Bindings of the operators to the supplied tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slantwise import constants as K
from slantwise.operators.features import Analyzer, token_table, vocabulary
from slantwise.operators.labels import assign_labels
from slantwise.operators.language import LanguageProfiles, learn_profiles
from slantwise.operators.linear import with_score_columns
from slantwise.operators.prep import normalize
from slantwise.operators.training import LinearModel
from slantwise.session import materialize, spread

REGIONS = ("north", "south", "east", "west", "middle")
LABELLED_SOURCES = 18
INTERCEPTS = (0.1, 0.0, -0.1)
ROUNDS = 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` with a date string and a metadata map."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 366).cast("int"))
    date = F.when(F.col("doc_id") % 50 == 0, "n/a").otherwise(F.date_format(day, "yyyy-MM-dd"))
    region = F.get(F.array(*[F.lit(r) for r in REGIONS]), (F.col("doc_id") % 5).cast("int"))
    empty = F.create_map().cast("map<string,string>")
    meta = F.when(F.col("doc_id") % 7 == 0, empty).otherwise(F.create_map(F.lit("region"), region))
    return table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", "source", date.alias("date"), meta.alias("subset_meta")
    )


def profiles(spark: SparkSession, sf_dir: str) -> LanguageProfiles:
    """Language profiles learned from all documents and their ``lang``."""
    return learn_profiles(table(spark, sf_dir, "documents"))


def source_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``outlet_name,label`` of the sources that occur in the documents."""
    number = F.regexp_extract("outlet_name", r"(\d+)$", 1).cast("int")
    label = F.get(F.array(*[F.lit(c) for c in K.CLASSES]), number % 3)
    return (
        table(spark, sf_dir, "documents")
        .select(F.lower("source").alias("outlet_name"))
        .distinct()
        .where(number < LABELLED_SOURCES)
        .select("outlet_name", label.alias("label"))
    )


def human_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id,label``: toxic documents last class, poor ones first class."""
    label = F.when(F.col("toxic") == 1, K.CLASSES[-1]).when(F.col("quality") == 0, K.CLASSES[0])
    return table(spark, sf_dir, "labels").select("doc_id", label.alias("label")).where(F.col("label").isNotNull())


def labeled_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_labels(docs(spark, sf_dir), source_labels(spark, sf_dir), human_labels(spark, sf_dir))


def clean_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with normalised text."""
    return normalize(labeled_docs(spark, sf_dir))


def _probabilities(step: Column | int = 7) -> list[Column]:
    a = 1 + (F.col("doc_id") * step) % 97
    b = 1 + (F.col("doc_id") * 13) % 89
    c = 1 + (F.col("doc_id") * 29) % 83
    mass = (a + b + c).cast("double")
    return [(x.cast("double") / mass) for x in (a, b, c)]


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with fixed probabilities derived from the id."""
    probs = [p.alias(f"prob_{name}") for p, name in zip(_probabilities(), K.CLASSES)]
    return with_score_columns(labeled_docs(spark, sf_dir).select("*", *probs))


def rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of several rounds; every fourth document changes between them."""
    numbered = table(spark, sf_dir, "documents").select(
        "doc_id", F.explode(F.sequence(F.lit(0), F.lit(ROUNDS - 1))).alias("round")
    )
    step = F.when(F.col("doc_id") % 4 == 0, 7 + 2 * F.col("round")).otherwise(7)
    probs = [p.alias(f"prob_{name}") for p, name in zip(_probabilities(step), K.CLASSES)]
    return numbered.select("doc_id", "round", *probs)


def stored_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled clean documents, stored for queries that fit on them and read them again."""
    return materialize(clean_docs(spark, sf_dir), "clean-docs")


def token_docs(stored: DataFrame) -> tuple[DataFrame, Analyzer]:
    """Tokens of the labelled documents, stored for queries that fit a vocabulary and a model on them, and their analyzer."""
    return token_table(stored.where(F.col("label").isNotNull()), Analyzer())


def fitted_vocabulary(spark: SparkSession, sf_dir: str, analyzer: Analyzer = Analyzer(), stored: DataFrame | None = None) -> DataFrame:
    """Vocabulary of the labelled clean documents, ``stored`` or read here, fitted once and stored."""
    corpus = (clean_docs(spark, sf_dir) if stored is None else stored).where(F.col("label").isNotNull())
    return materialize(vocabulary(corpus, analyzer, K.MAX_FEATURES), "vocab")


def fixed_weights(vocab: DataFrame) -> DataFrame:
    """Coefficient of every (term, class) computed from the term length."""
    return vocab.select("term", F.explode(F.sequence(F.lit(0), F.lit(len(K.CLASSES) - 1))).alias("class_idx")).select(
        "term",
        "class_idx",
        (((F.char_length("term") * (F.col("class_idx") + 2)) % 7 - 3) / F.lit(10.0)).alias("coef"),
    )


def fixed_model(spark: SparkSession, sf_dir: str, stored: DataFrame | None = None) -> LinearModel:
    """The fixed coefficients over the fitted vocabulary."""
    vocab = fitted_vocabulary(spark, sf_dir, stored=stored)
    values = ", ".join(f"({i}, cast({v} as double))" for i, v in enumerate(INTERCEPTS))
    intercepts = spark.sql(f"SELECT * FROM VALUES {values} AS t(class_idx, intercept)")
    return LinearModel(vocab, fixed_weights(vocab), intercepts, rows=K.MAX_FEATURES)


def vector_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors grouped by label; the first vector of a group is its query."""
    vectors = table(spark, sf_dir, "embeddings")
    queries = vectors.groupBy("label").agg(
        F.min_by("embedding", "vec_id").alias("query"), F.min("vec_id").alias("_query_id")
    )
    return (
        vectors.join(queries, "label")
        .where(F.col("vec_id") != F.col("_query_id"))
        .select(F.col("label").alias("group_id"), F.col("vec_id").alias("cand_id"), F.col("embedding").alias("vector"), "query")
    )
