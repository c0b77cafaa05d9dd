"""Shards of near equal bytes, tokens and rows by vector bin packing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slantwise.llm.columns import apart
from slantwise.llm.mixing import word_count
from slantwise.session import materialize, small_side

PARCELS_PER_SHARD = 256
SLOT_SLICES = 64


def pack(demand: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each item: largest first, where demand and room left align best.

    Both are shares of the whole. Room may go below zero for an item that fits
    nowhere; ties go to the lowest shard.
    """
    total = demand.sum(axis=0)
    share = demand / np.where(total > 0, total, 1.0)
    room = np.full((shards, demand.shape[1]), 1.0 / shards)
    out = np.zeros(len(demand), np.int64)
    for item in np.argsort(-share.max(axis=1), kind="stable"):
        out[item] = shard = int(np.argmax(room @ share[item]))
        room[shard] -= share[item]
    return out


@apart(("size", "text_crc32", "law", "shard", "slot", "grown_shard"), ("text_col", "id_col"))
def shard_documents(
    docs: DataFrame,
    shards: int = 24,
    text_col: str = "text",
    id_col: str = "doc_id",
    row_bytes: int = 8,
) -> DataFrame:
    """Every document with its shard and its slot there.

    New columns: ``size`` (UTF-8 bytes plus ``row_bytes``), ``text_crc32``, ``law``
    (``bytes``: sizes near equal), ``shard``, ``slot`` (gapless from 0) and
    ``grown_shard`` (null under this law). Rows of equal text form a group and stay
    together unless the group alone is larger than half a shard; such a group is cut
    into as many pieces as it has parcels' worth of bytes or rows.

    Groups are first folded into ``PARCELS_PER_SHARD * shards`` parcels by hash, a
    number that does not depend on the rows; large groups, of which there can be
    only so many, are parcels of their own. The table of parcels (bytes, tokens,
    rows) is therefore small at any scale and is packed at once. Slots are counted
    by slices of a shard, so no task orders a whole shard. Null text is a group of
    its own, of ``row_bytes`` per row and checksum 0; rows that agree in everything
    are interchangeable; an empty table gives an empty result. Columns named like a
    result are replaced.
    """
    results = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    base = docs.drop(*[c for c in results if c in docs.columns])
    base = base.withColumns(
        {
            "size": (F.octet_length(raw) + F.lit(row_bytes)).cast("long"),
            "text_crc32": F.crc32(raw),
            "_group": F.xxhash64(F.col(text_col), F.md5(raw)),
            "_mark": F.xxhash64(F.col(id_col), F.lit(7)),
        }
    )
    narrow = base.select(F.col("_group"), F.col("_mark"), F.col("size"), word_count(F.col(text_col)).alias("_tokens"))
    narrow = materialize(narrow, "shard-rows")
    parcels = PARCELS_PER_SHARD * shards
    groups = narrow.groupBy("_group").agg(F.sum("size").alias("b"), F.count("*").alias("r"))
    totals = narrow.agg(F.sum("size"), F.count("*")).first()
    most_bytes, most_rows = max(1, (totals[0] or 0) // parcels), max(1, totals[1] // parcels)
    cuts = F.greatest(F.ceil(F.col("b") / most_bytes), F.ceil(F.col("r") / most_rows)).cast("long")
    # Groups of several rows above a parcel: fewer than two per parcel in all.
    large = groups.where((F.col("r") > 1) & (cuts > 1)).select(F.col("_group").alias("_g"), F.least(cuts, F.col("r")).alias("_cuts"))
    large = materialize(large, "shard-large")

    def in_parcels(df: DataFrame) -> DataFrame:
        df = df.join(small_side(large), F.col("_group") == F.col("_g"), "left").drop("_g")
        whole = F.col("_cuts").isNull() | (F.col("_cuts") <= PARCELS_PER_SHARD // 2)
        piece = F.when(whole, F.lit(0)).otherwise(F.pmod(F.xxhash64("_mark"), F.col("_cuts")))
        own = F.col("_cuts").isNotNull()
        number = F.when(own, F.xxhash64("_group", piece)).otherwise(F.pmod(F.xxhash64("_group"), F.lit(parcels)))
        return df.withColumn("_parcel", F.concat_ws("/", own.cast("int"), number)).drop("_cuts")

    bounded = (
        in_parcels(narrow)
        .groupBy("_parcel")
        .agg(F.sum("size").alias("b"), F.sum("_tokens").alias("t"), F.count("*").alias("r"))
        .orderBy("_parcel")
        .collect()
    )
    demand = np.array([[x.b, x.t, x.r] for x in bounded], float).reshape(-1, 3)
    placed = pack(demand, shards)
    spark = docs.sparkSession
    # An Arrow table becomes a local relation: no job, no Python on the executors.
    table = spark.createDataFrame(pa.table({"_p": pa.array([x._parcel for x in bounded], pa.string()), "shard": pa.array(placed, pa.int32())}))
    # Bounded by the number of parcels and large groups.
    out = in_parcels(base).join(F.broadcast(table), F.col("_parcel") == F.col("_p")).drop("_p", "_parcel")
    out = out.withColumn("_slice", F.pmod(F.xxhash64("_mark", "_group"), F.lit(SLOT_SLICES)).cast("int"))
    return _slots(out, id_col, text_col)


def _slots(out: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Number the rows of each shard: rows of earlier slices, plus place in the own."""
    counts = materialize(out.groupBy("shard", "_slice").count(), "shard-slices")
    running = F.sum("count").over(Window.partitionBy("shard").orderBy("_slice")) - F.col("count")
    # At most shards * SLOT_SLICES rows.
    before = F.broadcast(counts.select(F.col("shard").alias("_h"), F.col("_slice").alias("_l"), running.alias("_before")))
    place = F.row_number().over(Window.partitionBy("shard", "_slice").orderBy("_mark", "_group", id_col))
    numbered = out.withColumn("_place", place).join(before, (F.col("shard") == F.col("_h")) & (F.col("_slice") == F.col("_l")))
    return numbered.withColumns(
        {
            "law": F.lit("bytes"),
            "slot": (F.col("_before") + F.col("_place") - 1).cast("long"),
            "grown_shard": F.lit(None).cast("int"),
        }
    ).drop("_group", "_mark", "_slice", "_place", "_before", "_h", "_l")
