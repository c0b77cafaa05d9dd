"""Label CSV scans with validation and last-row-wins keys."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slantwise import constants as K


def last_label_wins(rows: DataFrame, key: str, order: str, label: str = "label") -> DataFrame:
    """One label per key: the one with the highest ``order``."""
    return rows.groupBy(key).agg(F.max_by(label, order).alias(label))


def _header(spark: SparkSession, path: str) -> list[str]:
    """Column names: the first line of a file that is no note, the same in all files of a folder."""
    lines = spark.read.text(path).select(
        F.regexp_replace("value", "^\ufeff", "").alias("line"), F.col("_metadata.file_path").alias("file"), F.struct("_metadata.file_block_start", F.monotonically_increasing_id()).alias("place")
    )
    lines = lines.where(~F.col("line").startswith("#") & (F.trim("line") != ""))
    found = [r["line"] for r in lines.groupBy("file").agg(F.min_by("line", "place").alias("line")).select("line").distinct().limit(2).collect()]
    if len(found) > 1:
        raise ValueError(f"the files of {path} have different headers: {sorted(found)}")
    return [name.strip() for name in next(csv.reader([found[0]]))] if found else []


def _read_labels(
    spark: SparkSession, path: str, key: str, key_type: str, lower_key: bool, skip_blank: bool, classes: Sequence[str]
) -> DataFrame:
    """Rows behind the header of each file, quoted line breaks included, in their order.

    A file is read as a stream by one task, since only its start tells which line
    breaks are quoted; the files of a folder are read side by side. Lines before the
    header are notes; behind it every row counts, also one that begins with ``#`` or
    repeats the header.
    """
    empty = spark.createDataFrame([], f"{key} {key_type}, label string")
    try:
        columns = _header(spark, path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return empty
        raise
    if key not in columns or "label" not in columns:
        raise ValueError(f"{path} must have the columns {key} and label")
    schema = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(len(columns))])
    cells = spark.read.schema(schema).options(multiLine=True, quote='"', escape='"', header=False).csv(path)
    cells = cells.select("*", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("row"))
    is_header = F.lit(True)
    for k, name in enumerate(columns):
        is_header = is_header & (F.trim(F.regexp_replace(F.coalesce(f"c{k}", F.lit("")), "^\ufeff\"?|\"$", "")) == name)
    # One row per file.
    heads = cells.where(is_header).groupBy("file").agg(F.min("row").alias("head"))
    order = F.struct("file", "row").alias("line_no")
    rows = cells.join(heads, "file").where(F.col("row") > F.col("head")).select(
        order, F.col(f"c{columns.index(key)}").alias(key), F.lower(f"c{columns.index('label')}").alias("label")
    )
    if lower_key:
        rows = rows.withColumn(key, F.lower(key))
    if skip_blank:
        rows = rows.where(F.coalesce(F.trim("label"), F.lit("")) != "")
    invalid = rows.where(F.col("label").isNull() | ~F.col("label").isin(list(classes)))
    bad = [row["label"] for row in invalid.select("label").distinct().limit(5).collect()]
    if bad:
        raise ValueError(f"invalid labels in {path}: {bad}")
    return last_label_wins(rows.withColumn(key, F.col(key).cast(key_type)), key, "line_no").select(key, "label")


def read_source_labels(spark: SparkSession, path: str, classes: Sequence[str] = K.CLASSES) -> DataFrame:
    """``outlet_name,label`` file: keys and labels lower-cased, last row wins.

    A missing file gives an empty table; an unknown or blank label is an error.
    """
    return _read_labels(spark, path, "outlet_name", "string", True, False, classes)


def read_human_labels(
    spark: SparkSession, path: str, id_type: str = "string", classes: Sequence[str] = K.CLASSES
) -> DataFrame:
    """``doc_id,label`` file; the id is read with the type of the document table.

    Notes above the header and rows still without a label are skipped, so a partly
    filled template can be read back.
    """
    return _read_labels(spark, path, "doc_id", id_type, False, True, classes)
