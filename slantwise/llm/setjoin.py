"""Size-aware similarity join of documents by their shingle sets."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slantwise.llm import kernels, pairs
from slantwise.llm.arrow import append_columns
from slantwise.llm.columns import apart
from slantwise.llm.components import connected_components
from slantwise.llm.repeats import in_filter
from slantwise.session import materialize

PACKED = "bucket int, keys binary, nodes binary, picks binary"
BUCKET_ENTRIES = 1 << 20
BLOCK_ELEMENTS = 2 << 20
LIST_SETS = 4096
SIZES_LOOKED_AT = 40


def text_key(text_col: str):
    """Names a text by its content; null and empty differ from all others alike."""
    return F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))


def candidate_links(texts: DataFrame, classes: DataFrame, shingle: int, percent: int, small: int, elements: int, list_sets: int = LIST_SETS) -> DataFrame:
    """Pairs of set digests that share a list and whose sketches allow a link, as stars.

    ``elements`` (of all sets) sets the number of buckets, so a bucket fits a task.
    Only members of lists with several sets meet their sketches; a list of more than
    ``list_sets`` sets is cut into blocks, and every two blocks are one task.
    """
    share = 2 * (100 - percent) / (100 + percent)
    buckets = max(1, round(elements * 2 * share / BUCKET_ENTRIES))

    def run(batches):
        return pairs.entries(batches, 0, shingle, small, percent, buckets)

    packed = texts.mapInArrow(run, PACKED).repartition("bucket").sortWithinPartitions("bucket")
    lists = packed.mapInArrow(pairs.join_lists, "list long, node long, k long")
    lists = lists.repartition("node").dropDuplicates(["node", "list"])
    lists = _block_tasks(lists.withColumn("blocks", F.ceil(F.col("k") / list_sets).cast("int")), "list", "node")
    drawn = classes.select(F.col("d1").alias("node"), "n", "sketch")
    rows = lists.select("node", "task").join(drawn, "node").select("task", "node", "n", "sketch")
    rows = rows.repartition("task").sortWithinPartitions("task")
    return materialize(rows.mapInArrow(lambda batches: pairs.plausible(batches, percent), "a long, b long"), "candidate-links")


def _block_tasks(rows: DataFrame, group: str, name: str) -> DataFrame:
    """``rows`` once per ``task``: their group, or each pair of its ``blocks`` with their own."""
    own = F.pmod(F.xxhash64(name), F.col("blocks")).cast("int")
    other = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(F.array_remove(F.sequence(F.lit(0), F.col("blocks") - 1), own))
    dealt = rows.withColumn("own", own).withColumn("other", F.explode(other))
    return dealt.withColumn("task", F.concat_ws("/", group, F.least("own", "other"), F.greatest("own", "other")))


@apart(("n_shingles", "component_id", "is_least"), ("text_col", "id_col"))
def similar_components(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    shingle: int = 3,
    percent: int = 90,
    small: int | None = None,
    block_elements: int = BLOCK_ELEMENTS,
) -> DataFrame:
    """Every document with its set size and its component of linked documents.

    Documents link when their sets of ``shingle``-word shingles (lower case, words
    by white space) have a Jaccard similarity of ``percent`` or more. New columns:
    ``n_shingles``; ``component_id``, the least ``id_col`` reachable by links; and
    ``is_least``, true for the rows that have that id and its text.

    Equal sets are one class. Sets of up to ``small`` elements are found through
    all their subsets of the size a partner must share, larger ones through
    inverted lists; ``small`` is chosen by cost from the histogram of sizes. Within
    a list, sketches rule out the pairs that differ too much, so documents that
    only share a passage do not become one candidate group. Candidate groups are
    then linked exactly; a group of more than ``block_elements`` elements is cut
    into blocks and every two blocks are linked in one task.

    Null or empty text has no shingles, links with nothing and is its own
    component. A null id is never the least; a component of null ids only has a
    null id. Rows that repeat count as copies. An empty table gives an empty
    result. Columns named like a result are replaced.
    """
    results = [c for c in ("n_shingles", "component_id", "is_least") if c in docs.columns]
    base = docs.drop(*results)
    key = text_key(text_col)
    heads = append_columns(
        base.select(F.col(id_col).alias("id"), key.alias("text_key"), F.col(text_col).alias("t")),
        "t",
        lambda column: pairs.head_columns(column, shingle),
        [("n", T.LongType()), ("d1", T.LongType()), ("d2", T.LongType()), ("sketch", T.BinaryType())],
    ).drop("t")
    heads = materialize(heads.withColumn("name", F.concat_ws(":", "n", "d1", "d2")), "set-heads")
    elements = heads.agg(F.sum("n")).first()[0] or 0
    if small is None:
        counts = heads.where(F.col("n").between(1, pairs.largest_partner(SIZES_LOOKED_AT, percent))).groupBy("n").count().collect()
        small = pairs.boundary({r["n"]: r["count"] for r in counts}, percent, SIZES_LOOKED_AT)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_key"))
    classes = heads.where("n > 0").groupBy("name", "d1", "n").agg(first.alias("least"), F.first("sketch").alias("sketch"))
    classes = materialize(classes, "set-classes")
    links = candidate_links(base.select(F.col(text_col).alias("t")), classes, shingle, percent, small, elements)
    groups = connected_components(links).withColumnRenamed("root", "g")
    members = classes.join(groups, F.col("d1") == F.col("node")).select("g", "name", "n", F.col("least.text_key").alias("text_key"))
    members = materialize(members, "members")
    verified = _verified(base, text_col, members, shingle, percent, block_elements)
    roots = connected_components(verified).withColumnRenamed("node", "name")
    named = classes.select("name", "least").join(roots, "name", "left").withColumn("root", F.coalesce("root", "name"))
    lowest = named.groupBy("root").agg(F.min("least").alias("first"))
    labels = named.select("name", "root").join(lowest, "root").select("name", "first")
    texts = heads.groupBy("text_key", "name", "n").agg(F.count("*").alias("copies"))
    by_text = texts.join(labels, "name", "left").select(F.col("text_key").alias("_k"), F.col("n").alias("n_shingles"), "first")
    by_text = materialize(by_text, "set-labels")
    out = base.withColumn("_text_key", key).join(by_text, F.col("_text_key") == F.col("_k"), "left")
    has = F.col("n_shingles") > 0
    least = ~has | (F.col(id_col).eqNullSafe(F.col("first.id")) & (F.col("_text_key") == F.col("first.text_key")))
    out = out.withColumns({"component_id": F.when(has, F.col("first.id")).otherwise(F.col(id_col)), "is_least": least})
    return out.drop("_k", "first", "_text_key")


@apart((), ("text_col", "id_col"))
def keep_one(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", shingle: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group of linked documents: the least id.

    Rows that repeat the kept row are dropped too. Documents without words stay.
    """
    marked = similar_components(docs, text_col, id_col, shingle, percent).where("is_least")
    place = F.row_number().over(Window.partitionBy(text_key(text_col), F.col(id_col)).orderBy(F.lit(0)))
    kept = marked.withColumn("_place", place).where((F.col("_place") == 1) | (F.col("n_shingles") == 0))
    return kept.select(*[f"`{c}`" for c in docs.columns])


def _verified(base: DataFrame, text_col: str, members: DataFrame, shingle: int, percent: int, block_elements: int) -> DataFrame:
    """Exact links, as stars within each candidate group or pair of blocks."""
    totals = members.groupBy("g").agg(F.sum("n").alias("size"), F.count("*").alias("c")).where("c > 1")
    totals = totals.select("g", F.ceil(F.col("size") / block_elements).cast("int").alias("blocks"))
    wanted = members.join(totals, "g").select("g", "name", "text_key", "blocks")
    wanted = _block_tasks(wanted, "g", "name").select("name", "text_key", "task")
    texts = base.select(text_key(text_col).alias("key"), F.col(text_col).alias("t"))
    texts = in_filter(texts, "key", members, "text_key")

    def run(batches):
        for batch in kernels.distinct_rows(batches):
            found = pairs.set_columns(batch.column(1), shingle)
            yield pa.RecordBatch.from_arrays([batch.column(0), found.column(2)], ["key", "elements"])

    sets = texts.select("key", "t").mapInArrow(run, "key string, elements binary")
    rows = sets.join(wanted, F.col("key") == F.col("text_key")).select("task", "name", "elements")
    rows = rows.repartition("task").sortWithinPartitions("task")
    return materialize(rows.mapInArrow(lambda batches: pairs.verify(batches, percent), "a string, b string"), "links")
