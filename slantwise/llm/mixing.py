"""Mixing of sources to target weights by capped water-filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slantwise.llm.columns import apart
from slantwise.session import materialize, small_side

WORD = r"[^\x20\x09-\x0D]+"
SLICES = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, max_epochs: int = 3, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """Water level over sources: ``source``, ``source_size``, ``target``.

    Sources by code point, null last, weigh ``weights`` in turn. Clamping a
    source at ``max_epochs`` times its size and sharing the excess by weight ends
    where the sources with the least room per unit of weight are full and all
    others stand at one level; sorted by room per weight, that level follows from
    running sums. The table has one row per source.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    pick = F.array(*[F.lit(w) for w in weights])
    rows = sizes.withColumn("weight", F.get(pick, (F.row_number().over(order) - 1) % len(weights)).cast("long"))
    rows = rows.withColumn("room", max_epochs * F.col("source_size"))
    ranked = Window.orderBy(F.col("room") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    full, all_rows = ranked.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    rows = rows.withColumns(
        {
            "left": F.sum("source_size").over(all_rows) - F.coalesce(F.sum("room").over(full), F.lit(0)),
            "units": F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(full), F.lit(0)),
        }
    )
    # Where the source itself still fits, so do all that follow.
    fits = F.col("room") * F.col("units") >= F.col("left") * F.col("weight")
    level = F.min(F.when(fits, F.struct(F.col("room") / F.col("weight"), F.col("source").isNull(), "source", "left", "units"))).over(all_rows)
    out = rows.withColumn("_level", level).withColumn("_fits", fits)
    share = F.col("_level.left").cast("double") / F.col("_level.units") * F.col("weight")
    return out.select("source", "source_size", F.when(F.col("_fits"), share).otherwise(F.col("room").cast("double")).alias("target"))


@apart(("size", "source_size", "target", "taken"), ("text_col", "source_col", "id_col"))
def mix_sources(
    docs: DataFrame,
    text_col: str = "text",
    source_col: str = "source",
    id_col: str = "doc_id",
    max_epochs: int = 3,
    weights: tuple[int, ...] = (1, 2, 3),
    seed: int = 0,
) -> DataFrame:
    """Every document with the words that the mix takes of it.

    New columns: ``size`` (words), ``source_size``, ``target`` of its source and
    ``taken``. A source at ``r`` times its size takes each document ``floor(r)``
    times; the rest goes to documents in a seeded order by hash until it is used
    up, so the sum over a source is its target rounded down. No document is taken
    more than ``max_epochs`` times. The order's running sum goes through ``SLICES``
    hash slices per source, of which only one per source has to be sorted, so a hot
    source is never ordered in one task. Rows that agree in id and text are
    interchangeable. Null text has size 0; a null source is a source. An empty
    table gives an empty result. Columns named like a result are replaced.
    """
    results = ("size", "source_size", "target", "taken")
    base = docs.drop(*[c for c in results if c in docs.columns])
    name = F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("|"), F.coalesce(F.md5(F.col(text_col)), F.lit("")))
    mark = F.conv(F.left(F.md5(name), F.lit(15)), 16, 10).cast("long")
    base = base.withColumns({"size": word_count(F.col(text_col)), "_mark": mark}).withColumn("_slice", F.shiftright("_mark", 48))
    narrow = materialize(base.select(F.col(source_col).alias("source"), "size", "_mark", "_slice"), "mix-sizes")
    slices = narrow.groupBy("source", "_slice").agg(F.sum("size").alias("slice_size"))
    slices = materialize(slices, "mix-slices")
    sizes = slices.groupBy("source").agg(F.sum("slice_size").alias("source_size"))
    targets = materialize(source_targets(sizes, max_epochs, weights), "mix-targets")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = (F.floor(F.col("target")) - whole * F.col("source_size")).cast("long")
    plan = targets.select("source", "source_size", "target", whole.alias("_whole"), rest.alias("_rest"))
    running = F.sum("slice_size").over(Window.partitionBy("source").orderBy("_slice")) - F.col("slice_size")
    cut = (
        slices.withColumn("_before", running)
        .join(small_side(plan).withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")))
        .where((F.col("_before") <= F.col("_rest")) & (F.col("_rest") < F.col("_before") + F.col("slice_size")))
        .select("source", F.col("_slice").alias("_cut"), (F.col("_rest") - F.col("_before")).alias("_room"))
    )
    cut = materialize(cut, "mix-cuts")
    # Words that a document of the cut slice still gets, by its place there.
    inside = narrow.join(small_side(cut).withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")) & (F.col("_slice") == F.col("_cut")))
    before = F.sum("size").over(Window.partitionBy("source").orderBy("_mark").rangeBetween(Window.unboundedPreceding, -1))
    edge = inside.groupBy("source", "_mark").agg(F.sum("size").alias("size"), F.max("_room").alias("_room"))
    edge = edge.withColumn("_ahead", F.coalesce(before, F.lit(0)))
    edge = edge.where(F.col("_ahead") < F.col("_room")).select(
        F.col("source").alias("_s"), F.col("_mark").alias("_m"), (F.col("_room") - F.col("_ahead")).alias("_give"), F.col("size").alias("_tied")
    )
    edge = materialize(edge, "mix-edge")
    wide = plan.join(small_side(cut).withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s", "_room")
    out = base.join(small_side(wide.withColumnRenamed("source", "_s")), F.col(source_col).eqNullSafe(F.col("_s"))).drop("_s")
    out = out.join(small_side(edge), F.col(source_col).eqNullSafe(F.col("_s")) & (F.col("_mark") == F.col("_m")), "left")
    # Rows with one mark (repeats) share what is left in equal parts.
    given = F.floor(F.least(F.col("_give"), F.col("_tied")) * F.col("size") / F.col("_tied"))
    extra = (
        F.when(F.col("_slice") < F.coalesce(F.col("_cut"), F.lit(SLICES)), F.col("size"))
        .when((F.col("_slice") == F.col("_cut")) & (F.col("_tied") > 0), given)
        .otherwise(0)
    )
    extra = F.when(F.col("_rest") > 0, extra).otherwise(0)
    taken = (F.col("_whole") * F.col("size") + F.coalesce(extra, F.lit(0))).cast("long")
    return out.withColumn("taken", taken).drop("_whole", "_rest", "_cut", "_slice", "_mark", "_s", "_m", "_give", "_tied")
