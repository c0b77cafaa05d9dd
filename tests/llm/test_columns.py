"""No column of a caller meets one that an operator makes for itself."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from slantwise.llm import decontaminate, lines, mixing, quality, secrets, setjoin, sharding, substrings, tokencount
from slantwise.llm.columns import apart

# Helper and result names of all operators, and names that differ in case only.
NAMES = [
    "first", "last", "node", "root", "least", "key", "content", "name", "n", "g", "t", "text_key", "size", "runs", "pos", "task",
    "_k", "_text_key", "_place", "_h", "_host", "_lines", "_stay", "_drop", "_mark", "_pages", "_with", "_hex", "_assign", "_access", "_base",
    "_weak", "_all", "_group", "_slice", "_cuts", "_parcel", "_p", "_l", "_before", "_whole", "_rest", "_cut", "_s", "_m", "_give", "_tied",
    "_node", "_n", "Text", "DOC_ID", "in_0", "in_text_col", "host", "item_id", "host_rate",
]

OPERATORS = {
    "substrings": lambda d: substrings.remove_repeats(d, length=40, gram=16),
    "sets": setjoin.similar_components,
    "keep_one": setjoin.keep_one,
    "tokens": lambda d: tokencount.count_tokens(d, __import__("public_tokenizers").path("byte_bpe_50k.json")),
    "mix": mixing.mix_sources,
    "shards": lambda d: sharding.shard_documents(d, shards=3),
    "quality": quality.host_quality,
    "leaks": lambda d: decontaminate.find_leaks(d, d.sparkSession.createDataFrame([(1, "w1 w2 w3")], "item_id long, text string")),
    "clean": lambda d: decontaminate.decontaminate(d, d.sparkSession.createDataFrame([(1, "w1 w2 w3")], "item_id long, text string")),
    "secrets": secrets.find_secrets,
    "lines": lambda d: lines.drop_site_boilerplate(d, host_col="source"),
}
REPLACED = {"shards": {"size"}, "mix": {"size"}, "quality": {"host_rate"}}


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_columns_come_back(spark, name):
    texts = ["w1 w2 w3 w4 " * 9, "w1 w2 w3", None, "", "other words here and there"]
    rows = [(k, t, f"s{k % 2}", *[f"{c}-{k}" for c in NAMES]) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"`{c}` string" for c in NAMES))
    out = OPERATORS[name](df)
    kept = [c for c in NAMES if c not in REPLACED.get(name, ())]
    assert [c for c in out.columns if c in kept] == kept and len(set(out.columns)) == len(out.columns)
    at = {c: k for k, c in enumerate(out.columns)}
    got = out.collect()
    assert 0 < len(got) <= len(texts)
    for row in got:
        assert all(row[at[c]] == f"{c}-{row[at['doc_id']]}" for c in kept)


def test_guard_renames_and_replaces(spark):
    @apart(("made",), ("col",))
    def shout(df, col="text"):
        return df.withColumn("made", F.upper(F.col(col)))

    df = spark.createDataFrame([("a", "x", "old", 1)], "text string, Text string, MADE string, n int")
    out = shout(df, col="text")
    assert out.columns == ["text", "Text", "n", "made"] and [tuple(r) for r in out.collect()] == [("a", "x", 1, "A")]
    assert shout(df, "MADE").columns == ["text", "Text", "MADE", "n", "made"]
    with pytest.raises(ValueError):
        shout(df, col="none")
