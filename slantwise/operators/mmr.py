"""Maximal-marginal-relevance selection over a vector column."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slantwise.functions.arrays import cosine
from slantwise.operators.features import ROUND
from slantwise.session import materialize, small_side


def mmr_select(
    candidates: DataFrame,
    top_k: int = 20,
    diversity: float = 0.5,
    group_col: str = "group_id",
    id_col: str = "cand_id",
    vector_col: str = "vector",
    query_col: str = "query",
) -> DataFrame:
    """Greedy selection per group: ``(group, pick, id, similarity)``.

    The first pick is the candidate most similar to the query; each further one
    maximises ``(1 - diversity) * similarity - diversity * redundancy``, where
    redundancy is its highest similarity to a pick so far. Ties go to the lower
    id. A missing vector or query is similar to nothing. No candidate is cut off,
    and no group is gathered: each pick is one pass over the stored vectors, with
    the picks so far (at most ``top_k`` per group) joined to them.
    """
    relevant = candidates.select(
        group_col,
        id_col,
        F.transform(vector_col, lambda x: x.cast("double")).alias("_v"),
        cosine(F.col(vector_col), F.col(query_col)).alias("_rel"),
    )
    if diversity == 0:
        order = Window.partitionBy(group_col).orderBy(F.desc(F.round("_rel", 12)), id_col)
        return (
            relevant.withColumn("pick", F.row_number().over(order))
            .where(F.col("pick") <= top_k)
            .select(group_col, "pick", id_col, F.round("_rel", ROUND).alias("similarity"))
        )
    vectors = materialize(relevant, "mmr-vectors")
    sizes = vectors.groupBy(group_col).agg(F.count(F.lit(1)).alias("_n"))
    groups, most = sizes.agg(F.count(F.lit(1)), F.coalesce(F.max("_n"), F.lit(0))).first()
    chosen = None
    for number in range(1, max(1, min(top_k, most)) + 1):
        best = _best(vectors, chosen, diversity, group_col, id_col, groups)
        best = materialize(best.withColumn("pick", F.lit(number)), "mmr-pick")
        chosen = best if chosen is None else chosen.unionByName(best)
    return chosen.select(group_col, "pick", id_col, F.round("_rel", ROUND).alias("similarity"))


def _best(vectors: DataFrame, chosen: DataFrame | None, diversity: float, group_col: str, id_col: str, groups: int) -> DataFrame:
    """The next pick of every group that has candidates left, with its vector.

    Only worth and id are compared; the vector of the winner is read again, so one
    job makes a pick and no vectors are sorted or shuffled.
    """
    if chosen is None:
        open_rows = vectors.withColumn("_worth", F.round("_rel", 12))
    else:
        # One row per group, of as many picks as there were passes.
        picks = chosen.groupBy(group_col).agg(F.collect_list("_v").alias("_pv"), F.collect_list(id_col).alias("_taken"))
        nearest = F.array_max(F.transform("_pv", lambda p: cosine(F.col("_v"), p)))
        # A pick without a vector is in no list and is similar to nothing.
        missing = F.when(F.size("_pv") < F.size("_taken"), F.lit(0.0))
        worth = (1 - diversity) * F.col("_rel") - diversity * F.coalesce(F.greatest(nearest, missing), F.lit(0.0))
        open_rows = vectors.join(small_side(picks, groups), group_col).where(~F.array_contains("_taken", F.col(id_col)))
        open_rows = open_rows.withColumn("_worth", F.round(worth, 12))
    first = open_rows.groupBy(group_col).agg(F.min(F.struct((-F.col("_worth")).alias("_order"), id_col)).alias("_first"))
    winners = first.select(group_col, F.col(f"_first.{id_col}").alias(id_col))
    return vectors.join(small_side(winners, groups), [group_col, id_col])
