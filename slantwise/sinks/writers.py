"""Table and file outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slantwise import constants as K
from slantwise.functions import textfiles
from slantwise.session import local_folder, materialize

# A folder of text files holds about this many.
FOLDER_FILES = 1000
# Files of the local disk go without checksum files, each of which costs more processes than the text.
PLAIN_LOCAL = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def write_splits(df: DataFrame, path: str, split_col: str = "split") -> None:
    """One partition folder per split.

    ``df`` carries ``train``/``val``/``test`` in ``split_col``; rows without a
    split are the unlabeled ones. All rows together are the processed corpus.
    """
    named = df.withColumn(split_col, F.coalesce(F.col(split_col), F.lit("unlabeled")))
    named.write.mode("overwrite").partitionBy(split_col).parquet(path)


def label_template(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id") -> DataFrame:
    """Rows of an annotation sheet: the documents that have no label yet."""
    todo = docs if labels is None else docs.join(labels.select(id_col), id_col, "left_anti")
    empty = F.lit("")
    return todo.select(F.col(id_col), empty.alias("label"), empty.alias("confidence"), empty.alias("notes"))


def write_label_template(template: DataFrame, path: str, classes: Sequence[str] = K.CLASSES) -> None:
    """CSV sheets below ``path``, each part with the guideline lines on top.

    The first row of every partition (its running number restarts at 0) brings
    the guideline and header lines along; nothing is gathered or shuffled. When no
    document is left to label, the sheet is these lines alone.
    """
    header = [line.format(classes=", ".join(classes)) for line in K.TEMPLATE_HEADER] + [",".join(template.columns)]
    row_in_partition = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    line = F.to_csv(F.struct(*[F.col(c).cast("string") for c in template.columns]))
    numbered = template.select(line.alias("line"), row_in_partition.alias("row"))
    first = F.array(*[F.lit(text) for text in header], F.col("line"))
    lines = numbered.select(F.explode(F.when(F.col("row") == 0, first).otherwise(F.array("line"))).alias("value"))
    if template.isEmpty():
        one = template.sparkSession.range(1, numPartitions=1)
        lines = one.select(F.explode(F.array(*[F.lit(text) for text in header])).alias("value"))
    lines.write.mode("overwrite").text(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON lines, one folder of part files; variants are written as the JSON they hold."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; line breaks, quotes and outer blanks of a field survive."""
    df.write.mode("overwrite").options(
        header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


def write_txt_files(docs: DataFrame, path: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One ``.txt`` file per document, and ``(folder, place, id)`` that tells whose each is.

    Files stand in folders of about ``FOLDER_FILES``, so that listing them costs one call per
    folder. A folder is written by one task in order of the id; its files are numbered
    in that order, which ``txt_file_place`` reads from their paths. Below a folder of the local disk, or one
    mounted there, tasks write the files themselves; elsewhere Spark's writer does.
    """
    folders = max(1, -(-docs.count() // FOLDER_FILES))
    dealt = docs.select(id_col, text_col, F.pmod(F.xxhash64(id_col), F.lit(folders)).cast("int").alias("folder"))
    local = local_folder(docs.sparkSession, path)
    if local is not None:
        rows = dealt.select(id_col, "folder", F.concat(F.coalesce(text_col, F.lit("")), F.lit("\n")).alias("content"))
        ordered = rows.repartition(folders, "folder").sortWithinPartitions("folder", id_col, "content")
        schema = T.StructType([T.StructField("folder", T.IntegerType()), T.StructField("place", T.IntegerType()), rows.schema[id_col]])
        # The names are stored, so the files are written now, and once.
        return materialize(ordered.mapInArrow(lambda batches: textfiles.written(batches, local), schema), "txt-names")
    sorted_rows = dealt.repartition(folders, "folder").sortWithinPartitions("folder", id_col)
    files = sorted_rows.select("folder", text_col).write.partitionBy("folder")
    files.options(maxRecordsPerFile=1, **PLAIN_LOCAL).text(path)
    place = F.row_number().over(Window.partitionBy("folder").orderBy(id_col)) - 1
    return dealt.select("folder", place.alias("place"), id_col)


def txt_file_place(path: Column) -> list[Column]:
    """``folder`` and ``place`` of a file that ``write_txt_files`` wrote."""
    pattern = r"folder=(\d+)/part-.*\.c(\d+)\.txt$"
    return [F.regexp_extract(path, pattern, k).cast("int").alias(name) for k, name in ((1, "folder"), (2, "place"))]
