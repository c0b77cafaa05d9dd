"""Document scans: JSON lines, text files, HTML pages, stored tables."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slantwise import constants as K
from slantwise.functions import text as tx
from slantwise.functions import textfiles
from slantwise.session import local_folder

# A line split with a fixed separator keeps a stray CR inside a record.
TEXT_OPTIONS = {"lineSep": "\n"}
# Lines from this size on may hold a value that VARIANT has no room for.
VARIANT_BYTES = 1 << 24


REASONS = ("not one object", "malformed", "missing field")


def _checked(lines: DataFrame, required: Sequence[str], value_col: str) -> DataFrame:
    """Lines that are not blank with their ``record`` and the ``reason`` why they are no document.

    A record that is sound but too large for VARIANT has no ``record``, and no reason.
    """
    keys = F.json_object_keys(F.col("line"))
    missing = F.array_except(F.array(*[F.lit(name) for name in required]), keys)
    braced = F.col("line").startswith("{") & F.col("line").endswith("}")
    large = F.octet_length("line") >= VARIANT_BYTES
    reason = (
        F.when(~braced, REASONS[0])
        .when(keys.isNull() | (F.col("record").isNull() & ~large), REASONS[1])
        .when(F.size(missing) > 0, F.concat(F.lit(f"{REASONS[2]}: "), F.array_join(missing, ", ")))
    )
    kept = [c for c in lines.columns if c != value_col]
    split = lines.select(*kept, tx.strip_ws(F.col(value_col)).alias("line")).where(F.col("line") != "")
    return split.withColumn("record", F.when(braced, F.try_parse_json("line"))).withColumn("reason", reason)


def parse_json_lines(
    lines: DataFrame,
    required: Sequence[str] = K.REQUIRED_FIELDS,
    optional: Sequence[str] = K.OPTIONAL_FIELDS,
    value_col: str = "value",
) -> DataFrame:
    """Documents from a column of JSON lines; works on batch and streaming input.

    Blank and malformed lines, lines that are not one JSON object, and objects
    without a required key are skipped; ``rejected_json_lines`` tells which and why.
    Known fields become typed columns; the whole record stays in ``record`` so unknown
    keys are not lost. A record too large for VARIANT keeps its known fields; its
    ``record`` and ``subset_meta`` are null.
    """
    parsed = _checked(lines, required, value_col).where("reason is null")

    def field(name: str) -> Column:
        if name == "subset_meta":
            return F.try_variant_get("record", f"$.{name}", "variant").alias(name)
        whole = F.when(F.col("record").isNull(), F.get_json_object("line", f"$.{name}"))
        return F.coalesce(F.try_variant_get("record", f"$.{name}", "string"), whole).alias(name)

    extra = [c for c in lines.columns if c != value_col]
    return parsed.select(*extra, *[field(name) for name in (*required, *optional)], "record")


def rejected_json_lines(lines: DataFrame, required: Sequence[str] = K.REQUIRED_FIELDS, value_col: str = "value") -> DataFrame:
    """The lines that ``parse_json_lines`` skips, blank ones apart, with the ``reason``."""
    return _checked(lines, required, value_col).where("reason is not null").drop("record")


def _scan_lines(spark: SparkSession, path: str, **options: str) -> DataFrame:
    return spark.read.options(**TEXT_OPTIONS, **options).text(path)


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Documents of one JSON-lines file."""
    return parse_json_lines(_scan_lines(spark, path))


def read_jsonl_rejects(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Rejected records of a file or folder: ``(file_name, block, place, line, reason)``.

    ``block`` is the byte at which the part of the file begins that a task read, and
    ``place`` sorts the lines of that part, so records are found again without a pass
    that numbers a whole file.
    """
    lines = _scan_lines(spark, path, pathGlobFilter=pattern).select(
        "value",
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )
    return rejected_json_lines(lines).select("file_name", "block", "place", "line", "reason")


def read_jsonl_dir(spark: SparkSession, directory: str, pattern: str = "*.jsonl") -> DataFrame:
    """Documents of every file of a folder that matches ``pattern``, in one scan.

    ``file_name`` tells where a record came from; an empty folder gives an empty
    table with the same schema.
    """
    lines = _scan_lines(spark, directory, pathGlobFilter=pattern).select(
        "value", F.col("_metadata.file_name").alias("file_name")
    )
    return parse_json_lines(lines)


def _document(doc_id: Column, text: Column, title: Column, source: str) -> list[Column]:
    empty = F.lit("")
    return [
        doc_id.alias("doc_id"),
        text.alias("text"),
        title.alias("title"),
        empty.alias("date"),
        F.lit(source).alias("source"),
        empty.alias("url"),
        F.create_map().cast("map<string,string>").alias("subset_meta"),
    ]


def _read_files(spark: SparkSession, directory: str, extension: str, recursive: bool) -> DataFrame:
    """One row per file: stem, path and content as valid UTF-8 with LF line ends."""
    content = F.make_valid_utf8(F.col("content").cast("string"))
    return _files(spark, directory, f"*.{extension}", recursive).select(
        F.regexp_replace("file_name", rf"\.{extension}$", "").alias("stem"),
        F.regexp_replace(content, r"\r\n?", "\n").alias("content"),
        "path",
    )


def _files(spark: SparkSession, directory: str, pattern: str, recursive: bool) -> DataFrame:
    """``(file_name, path, content)`` of the files that match.

    Spark's scan holds every file on the driver and reads about 32 small ones a task. So a tree of the local
    disk, or one mounted there, is listed by folder, and tasks list and read the files. Neither has empty files.
    """
    root = local_folder(spark, directory) if recursive else None
    if root is not None and os.path.isdir(root):
        rows = textfiles.chunks(root.rstrip("/") or "/", pattern)
        cores = spark.sparkContext.defaultParallelism
        parts = spark.createDataFrame(rows, "folder string, part int, parts int").repartition(max(1, min(len(rows), 16 * cores)))
        return parts.mapInArrow(lambda batches: textfiles.contents(batches, pattern), "file_name string, path string, content binary")
    scan = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower())
    # The name in the file's metadata is encoded as in a URI.
    return scan.load(directory).select(F.substring_index("path", "/", -1).alias("file_name"), "path", "content")


def read_txt_dir(
    spark: SparkSession, directory: str, default_source: str = "unknown", recursive: bool = False
) -> DataFrame:
    """One document per ``.txt`` file, identified by the file stem; ``path`` is kept."""
    files = _read_files(spark, directory, "txt", recursive)
    return files.select(*_document(F.col("stem"), F.col("content"), F.lit(""), default_source), "path")


def html_documents(
    pages: DataFrame, id_col: str = "page_id", html_col: str = "html", default_source: str = "unknown"
) -> DataFrame:
    """Documents from a table of HTML pages: visible text and title."""
    pruned = pages.select(F.col(id_col).alias("doc_id"), tx.drop_subtrees(F.col(html_col)).alias("pruned"))
    return pruned.select(
        *_document(F.col("doc_id"), tx.html_text(F.col("pruned")), tx.html_title(F.col("pruned")), default_source)
    )


def read_html_dir(
    spark: SparkSession, directory: str, default_source: str = "unknown", recursive: bool = False
) -> DataFrame:
    """One document per ``.html`` file, identified by the file stem."""
    files = _read_files(spark, directory, "html", recursive)
    return html_documents(files, id_col="stem", html_col="content", default_source=default_source)


def union_documents(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Stack tables whose columns differ; a missing column reads as null."""
    out = first
    for other in others:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def read_split(spark: SparkSession, path: str, split: str | None = None, classes: Sequence[str] = K.CLASSES) -> DataFrame:
    """Stored splits; naming one prunes the scan to its partition folder."""
    from slantwise.operators.labels import encode_labels

    df = spark.read.parquet(path)
    if split is not None:
        df = df.where(F.col("split") == split)
    if "label_int" not in df.columns:
        df = encode_labels(df, classes)
    return df
