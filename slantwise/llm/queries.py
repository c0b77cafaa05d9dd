"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slantwise.llm import conversations as cv
from slantwise.llm import decontaminate as dc
from slantwise.llm import fingerprints as fp
from slantwise.llm import lines as ln
from slantwise.llm import merkle as mk
from slantwise.llm import mixing as mx
from slantwise.llm import passages as ps
from slantwise.llm import quality as ql
from slantwise.llm import secrets as sc
from slantwise.llm import setjoin as sj
from slantwise.llm import sharding as sh
from slantwise.llm import substrings as ss
from slantwise.llm import tokencount as tc

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)


@query
def op1_repeated_substrings(spark, sf_dir):
    out = ss.remove_repeats(documents(spark, sf_dir, "doc_id", "text"), length=400)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op2_ngram_jaccard_join(spark, sf_dir):
    out = sj.similar_components(documents(spark, sf_dir, "doc_id", "text"), shingle=3, percent=90)
    return out.select("doc_id", "n_shingles", "component_id")


@query
def op3_token_counts(spark, sf_dir):
    import public_tokenizers

    out = tc.count_tokens(documents(spark, sf_dir, "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)
    return out.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query
def op4_mix_sources(spark, sf_dir):
    out = mx.mix_sources(documents(spark, sf_dir, "doc_id", "text", "source"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


@query
def op5_repeated_passages(spark, sf_dir):
    return ps.find_passages(documents(spark, sf_dir, "doc_id", "text"), min_words=50, percent=80)


@query
def op6_site_lines(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    read = pages.select("page_id", ln.url_host(F.col("url")).alias("host"), ln.page_lines(F.col("html")).alias("text"))
    out = ln.drop_site_boilerplate(read, max_ratio=0.1, min_pages=3)
    digest = F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    return out.select("page_id", "host", "n_lines", "n_dropped", digest)


@query
def op7_shard_documents(spark, sf_dir):
    out = sh.shard_documents(documents(spark, sf_dir, "doc_id", "text"))
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


@query
def op8_host_quality(spark, sf_dir):
    out = ql.host_quality(documents(spark, sf_dir, "doc_id", "text", "source"), keep_text=False)
    return out.select("doc_id", *ql.COUNTS, "base_failed", "kept")


@query
def op9_benchmark_leaks(spark, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    out = dc.find_leaks(documents(spark, sf_dir, "doc_id", "text"), benchmark, places=False)
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query
def op10_linked_secrets(spark, sf_dir):
    out = sc.find_secrets(documents(spark, sf_dir, "doc_id", "text"))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


@query
def op11_merkle_manifest(spark, sf_dir):
    docs = documents(spark, sf_dir, *mk.LEAF_FIELDS)
    struck = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    found = {"text": F.when(struck, lowered).otherwise(F.col("text"))}
    out = mk.merkle_manifest(docs, fanout=8, found=found)
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@query
def op12_repair_conversations(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return cv.repair_conversations(cv.damage(turns), among=turns)


@query
def op13_simhash_components(spark, sf_dir):
    return fp.similar_fingerprints(documents(spark, sf_dir, "doc_id", "text"), size=4, max_bits=4, seed=42)
