"""Corpus preparation: quality rules, near copies, benchmark leaks, mix, shards.

``STAGES`` lists the steps; each takes ``(spark, docs, sf_dir)`` and works on all
that the step before it kept. ``run`` stores every step in the shared folder.

All steps but the last return the columns of their input, whatever they are called,
in their order. Rows that repeat are judged as rows: quality rules, decontamination
and mix treat equal rows alike, and of equal texts the join keeps one. A null or
empty text has no words, so it fails the quality rules; where a later step meets one,
it links with nothing, holds no benchmark passage, is taken as often as it stands,
and is a shard row of eight bytes. A null source is a source, a null id is never the
least of its group. An empty table gives an empty result in every step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slantwise.llm.columns import apart
from slantwise.llm.decontaminate import decontaminate
from slantwise.llm.mixing import mix_sources
from slantwise.llm.quality import host_quality
from slantwise.llm.setjoin import keep_one
from slantwise.llm.sharding import shard_documents
from slantwise.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules themselves and whose host (``source``) passes."""
    return _passing(docs)


@apart((), ("text", "host"))
def _passing(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    return host_quality(docs, text, host).where("kept").select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the least id; texts without words all stay."""
    return keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage; a null or empty item is none."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, a started repetition counting as one.

    A document of which the mix takes nothing leaves the corpus; one without words
    stays once. Sources are weighed by their order, null last.
    """
    return _repeated(docs)


@apart((), ("text", "source", "name"))
def _repeated(docs: DataFrame, text: str = "text", source: str = "source", name: str = "doc_id") -> DataFrame:
    mixed = mix_sources(docs, text, source, name)
    times = F.when(F.col("size") > 0, F.ceil(F.col("taken") / F.col("size"))).otherwise(1).cast("int")
    repeated = mixed.withColumn("_n", F.explode(F.array_repeat(F.lit(1), times)))
    return repeated.select(*docs.columns)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of each document; equal texts stand together unless they fill half a shard."""
    placed = shard_documents(docs)
    return placed.select("doc_id", "source", "size", "text_crc32", "law", "shard", "slot")


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark_leaks),
    ("mixing sources", mix),
    ("sharding", shards),
]

#: Packing and its slots are outside SQL; tests hold every stage against SQL or brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
