"""Label proposals for unlabelled documents from repeated predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slantwise import constants as K
from slantwise.functions import scores as sc

ROUND = 6


def propose_labels(
    rounds: DataFrame,
    final: DataFrame,
    confidence: float = 0.85,
    max_new: int | None = None,
    classes: Sequence[str] = K.CLASSES,
    id_col: str = "doc_id",
) -> DataFrame:
    """Confident proposals on which every round agrees, the most confident first.

    All of them, or the first ``max_new``.

    ``rounds`` holds one row per document and round, ``final`` one per document.
    Agreement is smallest prediction = largest prediction, a partial aggregate;
    documents below the threshold leave before the join.
    """
    probs = sc.probabilities(classes)
    agreed = (
        rounds.select(id_col, sc.argmax_index(probs).alias("_pred"))
        .groupBy(id_col)
        .agg((F.min("_pred") == F.max("_pred")).alias("consistent"))
        .where("consistent")
    )
    candidates = final.select(
        id_col,
        sc.argmax_label(probs, classes).alias("proposed_label"),
        F.greatest(*probs).alias("_confidence"),
        sc.entropy_exact(probs).alias("_entropy"),
    ).where(F.col("_confidence") >= confidence)
    accepted = candidates.join(agreed, id_col).select(
        id_col,
        "proposed_label",
        F.round("_confidence", ROUND).alias("confidence"),
        F.round("_entropy", ROUND).alias("entropy"),
        "consistent",
    )
    ordered = accepted.orderBy(F.desc("confidence"), id_col)
    return ordered if max_new is None else ordered.limit(max_new)
