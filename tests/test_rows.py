"""Terms stay with their row: repeated and null ids, and models too large for a constant."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from slantwise.operators import features as ft
from slantwise.operators import linear as ln

TEXTS = ["public taxes and public schools", "market taxes market", "public taxes and public schools", None, "", "weather", "schools market schools public taxes weather"]


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "doc_id long, text string")
    vocab = ft.vocabulary(docs, max_features=40, min_df=1, max_df=1.0).persist()
    weights = vocab.select("term", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("class_idx")).withColumn(
        "coef", (F.char_length("term") * (F.col("class_idx") + 2) % 7 - 3) / 4.0
    )
    intercepts = spark.createDataFrame([(0, 0.1), (2, -0.2)], "class_idx int, intercept double")
    return vocab, ln.wide_weights(vocab, weights), intercepts


def table(spark, ids):
    return spark.createDataFrame(list(zip(ids, TEXTS, range(len(TEXTS)))), "doc_id long, text string, tag int").repartition(3)


def outputs(docs, model):
    vocab, wide, intercepts = model
    return {
        "tfidf": ft.tfidf_transform(docs, vocab),
        "explain": ln.explain_terms(docs, wide, intercepts, top_k=100),
        "explain_plain": ln.explain_terms(docs, wide, None, top_k=100),
        "leave_one_out": ln.leave_one_out(docs, wide, intercepts, top_k=100),
        "capped": ln.leave_one_out(docs, wide, intercepts, top_k=2, max_tokens=2),
    }


def rounded(rows):
    return Counter(tuple(round(x, 5) if isinstance(x, float) else x for x in r) for r in rows)


def test_ids_may_repeat_or_be_null(spark, model):
    unique = {name: [tuple(r) for r in df.collect()] for name, df in outputs(table(spark, range(len(TEXTS))), model).items()}
    ids = [1, 1, None, None, 1, 2, None]
    for name, df in outputs(table(spark, ids), model).items():
        assert unique[name]
        assert rounded(df.collect()) == rounded((ids[r[0]], *r[1:]) for r in unique[name]), name


def test_large_models_are_joined(spark, model, monkeypatch):
    docs = table(spark, [1, 1, None, None, 1, 2, None])
    small = {name: rounded(df.collect()) for name, df in outputs(docs, model).items()}
    monkeypatch.setattr(ft, "BROADCAST_ROWS", 3)
    monkeypatch.setattr(ln, "BROADCAST_ROWS", 3)
    assert {name: rounded(df.collect()) for name, df in outputs(docs, model).items()} == small


def test_term_lookup_leaves_no_exchange(spark, model):
    vocab, wide, intercepts = model
    docs = table(spark, range(len(TEXTS)))
    for df in (ft.tfidf_transform(docs, vocab, vocab_rows=40), ln.explain_terms(docs, wide, intercepts, rows=40), ln.leave_one_out(docs, wide, intercepts, rows=40)):
        plan = df._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
        assert "hashpartitioning" not in plan and "Sort " not in plan


def test_phrases_per_group(spark):
    rows = [("a", "tax tax school")] * 4 + [("b", "rain wind tax")] * 3 + [("c", "rain")] + [(None, "school wind")] * 2
    docs = spark.createDataFrame(rows, "g string, text string").withColumn("doc_id", F.monotonically_increasing_id())
    analyzer = ft.Analyzer((1, 1))
    vocab = ft.vocabulary(docs, analyzer, min_df=1, max_df=1.0)
    got = {(r.group_name, r["rank"]): (r.phrase, r.score) for r in ft.group_phrases(docs, vocab, F.col("g"), 2, 3, analyzer).collect()}
    x = {(r.doc_id, r.term): r.tfidf for r in ft.tfidf_transform(docs, vocab, analyzer).collect()}
    groups = {r.doc_id: r.g for r in docs.collect()}
    want = {}
    for g, size in (("a", 4), ("b", 3)):
        p, scores = size / len(rows), []
        for term in {t for _, t in x}:
            total = sum(v for (_, t), v in x.items() if t == term)
            own = sum(v for (d, t), v in x.items() if t == term and groups[d] == g)
            if own > p * total:
                scores.append((-round((own - p * total) ** 2 / (p * (1 - p) * total), 6), term))
        want |= {(g, k + 1): (term, -score) for k, (score, term) in enumerate(sorted(scores)[:2])}
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert all(got[k][1] == pytest.approx(want[k][1], abs=2e-6) for k in want)


def test_sums_do_not_depend_on_how_often_they_are_passed_on(spark, model):
    import pyarrow as pa

    from slantwise.functions import grams

    vocab = model[0].orderBy("idx").toPandas()
    parts, idf = grams.index_of(vocab["term"].tolist()), vocab["idf"].to_numpy()
    tokens = [["public", "taxes"], [], None, ["market", "taxes", "market"], ["weather"]] * 30
    groups = pa.array([None if k % 7 == 0 else f"g{k % 4}" for k in range(len(tokens))])
    batches = [pa.record_batch([groups[k : k + 10], pa.array(tokens[k : k + 10], pa.list_(pa.string()))], ["group", "tokens"]) for k in range(0, len(tokens), 10)]

    def summed(most):
        got, rows = {}, 0
        for batch in grams.group_sums(iter(batches), parts, idf, 1, 3, True, most):
            for r in batch.to_pylist():
                w, n, top = got.get((r["group"], r["number"]), (0.0, 0, 0.0))
                got[r["group"], r["number"]] = (w + r["w"], n + r["n"], max(top, r["top"]))
                rows += 1
        return got, rows

    whole, rows = summed(1 << 20)
    often, more = summed(5)
    assert rows == len(whole) < more and whole.keys() == often.keys()
    assert all(often[key] == pytest.approx(whole[key]) for key in whole)


def test_scores_need_no_exchange_and_no_second_look_at_the_model(spark, model):
    vocab, wide, intercepts = model
    docs = table(spark, range(len(TEXTS)))
    scored = ln.score_documents(docs, wide, intercepts, rows=40)
    assert "Exchange" not in scored._jdf.queryExecution().executedPlan().toString().replace("Exchange RoundRobinPartitioning", "").replace("RoundRobin", "")
    again = ln.score_documents(docs, None, intercepts, table=ln.scoring_table(wide, 3))
    assert [tuple(r) for r in again.orderBy("doc_id").collect()] == [tuple(r) for r in scored.orderBy("doc_id").collect()]


def test_known_terms_leave_a_worker_a_slice_at_a_time(spark, model, monkeypatch):
    import pyarrow as pa

    from slantwise.functions import grams

    monkeypatch.setattr(grams, "SLICE_TOKENS", 8)
    vocab = model[0].orderBy("idx").toPandas()
    parts, idf = grams.index_of(vocab["term"].tolist()), vocab["idf"].to_numpy()
    tokens = pa.array([["public", "taxes"], [], None, ["market", "taxes", "market"], ["weather"]] * 30, pa.list_(pa.string()))
    batch = pa.record_batch([pa.array(range(len(tokens))), tokens], ["doc_id", "tokens"])
    got = list(grams.with_terms([batch], parts, idf, 1, 3, True))
    assert max(len(b) for b in got) <= 10 < sum(len(b) for b in got) == len(tokens)
    whole = grams.vectors(tokens, parts, idf, idf.reshape(-1, 1)[:, :0], 1, 3, True)
    assert [r for b in got for r in b.column("terms").to_pylist()] == whole.field("terms").to_pylist()
    assert [r for b in got for r in b.column("doc_id").to_pylist()] == list(range(len(tokens)))


def test_tokens_that_are_not_listed_stay_in_the_worker(spark, model, monkeypatch):
    import random
    from decimal import ROUND_HALF_UP, Decimal

    import numpy as np
    import pyarrow as pa

    from slantwise.functions import grams, leaveout

    rng = random.Random(3)
    falls = np.array([rng.choice([0.0, 2.5e-6, -2.5e-6, 1e-9, rng.uniform(-4e-6, 4e-6)]) for _ in range(500)])
    exact = [Decimal(repr(float(abs(x)))).quantize(Decimal("1e-6"), ROUND_HALF_UP) for x in falls]
    for k in (1, 15, 400, 600):
        best = sorted(range(len(falls)), key=lambda i: (-exact[i], i))[:k]
        assert set(best) <= set(leaveout._leading(falls, k, 6).tolist())

    monkeypatch.setattr(grams, "SLICE_TOKENS", 50)
    vocab = model[1].orderBy("term").toPandas()
    parts, idf, coefs = grams.index_of(vocab["term"].tolist()), vocab["idf"].to_numpy(), vocab[["coef_0", "coef_1", "coef_2"]].to_numpy()
    texts = [[rng.choice(["public", "taxes", "market", "other"]) for _ in range(n)] for n in (40, 1, 200, 0, 30, 30)]
    batch = pa.record_batch([pa.array(range(6)), pa.array(texts, pa.list_(pa.string()))], ["doc_id", "tokens"])
    got = list(leaveout.with_falls([batch], parts, (idf, coefs, np.zeros(3)), 1, 3, True, 5, None, 6))
    lists = [r for b in got for r in b.column("falls").to_pylist()]
    assert len(got) > 2 and [len(x) for x in lists] == [5, 0, 5, 0, 5, 5]
    assert all(text[x["position"]] == x["token"] for text, row in zip(texts, lists) for x in row)
