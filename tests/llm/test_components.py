"""Components without a limit on rounds."""

from pyspark.sql import functions as F

from slantwise.llm import components


def test_components_are_never_left_unfinished(spark, monkeypatch):
    monkeypatch.setattr(components, "MAX_ROUNDS", 1, raising=False)
    links = spark.range(30).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.root for r in components.connected_components(links).collect()} == {0}
