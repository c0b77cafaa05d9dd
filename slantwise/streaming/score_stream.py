"""Scoring documents as files arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from slantwise.operators.features import table_rows
from slantwise.operators.linear import score_documents, scoring_table
from slantwise.operators.training import LinearModel
from slantwise.session import BROADCAST_ROWS
from slantwise.sources.documents import TEXT_OPTIONS, parse_json_lines


def score_stream(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    checkpoint_dir: str,
    model: LinearModel,
    files_per_batch: int = 1000,
    **trigger,
) -> StreamingQuery:
    """Score every JSON line of the files that appear in ``in_dir``.

    Each micro-batch overwrites its own ``batch_id=N`` folder, so a batch that is
    replayed after a failure replaces its output instead of repeating it. The
    model is read when the stream starts, once for all batches, unless it is too large for that:
    then its tables are read per batch and joined like in the batch plan.
    """
    lines = spark.readStream.options(**TEXT_OPTIONS, maxFilesPerTrigger=files_per_batch).text(in_dir)
    docs = parse_json_lines(lines).drop("record", "subset_meta")
    wide, intercepts = model.wide(), model.intercepts
    table = scoring_table(wide, len(model.classes)) if table_rows(wide, model.rows) <= BROADCAST_ROWS else None

    def score_batch(batch: DataFrame, batch_id: int) -> None:
        scored = score_documents(batch, wide, intercepts, model.classes, model.analyzer, rows=model.rows, table=table)
        scored.write.mode("overwrite").parquet(f"{out_dir}/batch_id={batch_id}")

    return (
        docs.writeStream.foreachBatch(score_batch)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_scored_stream(spark: SparkSession, out_dir: str) -> DataFrame:
    """Everything scored so far; a document sent again counts with its latest batch.

    Rows that share an id inside that batch all count, as they do when a table is
    scored at once. Nothing says that two rows without an id are one document, so
    these all stay.
    """
    scored = spark.read.parquet(out_dir)
    named = scored.where("doc_id is not null")
    latest = named.groupBy("doc_id").agg(F.max("batch_id").alias("batch_id"))
    return named.join(latest, ["doc_id", "batch_id"]).select(*scored.columns).unionByName(scored.where("doc_id is null"))
