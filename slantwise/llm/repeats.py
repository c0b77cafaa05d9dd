"""Keys that occur more than once, and rows worth shuffling because of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slantwise.session import materialize

# A filter of WORDS * 64 bits; its size never depends on the input.
FILTER_WORDS = 1 << 16


def in_filter(rows: DataFrame, key: str, among: DataFrame, among_key: str) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not in ``among``.

    A bit table of fixed size is broadcast, so rows that a later join would drop
    are not shuffled. It never drops a row whose key is in ``among``; when very
    many keys fill the table it only stops saving work.
    """
    bit = F.pmod(F.xxhash64(F.col(among_key), F.lit(1)), F.lit(64)).cast("int")
    word = F.pmod(F.xxhash64(F.col(among_key)), F.lit(FILTER_WORDS)).alias("_word")
    table = among.select(word, F.expr("1L").alias("one"), bit.alias("bit")).groupBy("_word").agg(
        F.bit_or(F.call_function("shiftleft", F.col("one"), F.col("bit"))).alias("_bits")
    )
    table = materialize(table, "bits")
    own = F.pmod(F.xxhash64(F.col(key), F.lit(1)), F.lit(64)).cast("int")
    marked = rows.withColumn("_word", F.pmod(F.xxhash64(F.col(key)), F.lit(FILTER_WORDS))).join(F.broadcast(table), "_word")
    return marked.where(F.getbit(F.col("_bits"), own) == 1).drop("_word", "_bits")
