import numpy as np
import pyarrow as pa
import pytest

from slantwise.catalog import fixtures as fx
from slantwise.catalog import queries as qs
from slantwise.functions import grams
from slantwise.functions import text as tx
from slantwise.functions import textgrams
from slantwise.operators import features as ft
from slantwise.operators import linear as ln
from slantwise.operators import training as tr

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["chi2_phrases", "group_phrases", "explain_terms"])
def test_texts_are_cleaned_once(spark, monkeypatch, name):
    calls = []
    monkeypatch.setattr(fx, "normalize", lambda df, real=fx.normalize: calls.append(1) or real(df))
    qs.REGISTRY[name](spark, SF_DIR).count()
    assert len(calls) == 1


def test_bucket_counts_leave_a_task_as_parts():
    lists = pa.array([["a", "b", "a"], None, ["b", "a"]], pa.list_(pa.string()))
    batch = pa.RecordBatch.from_arrays([lists], ["tokens"])
    tasks = [list(grams.bucket_counts([batch], 1, 2, 16)) for _ in range(2)]
    assert all(part.num_rows <= (1 << 16) // grams.PART for task in tasks for part in task)
    sums = pa.Table.from_batches(grams.bucket_sums(part for task in tasks for part in task))
    # a, b, and "b a" twice and "a b" once, in two tasks.
    assert sorted(sums["n"].to_pylist()) == [2, 4, 4, 6]
    assert len(np.unique(sums["bucket"])) == 4


def test_guarded_patterns_still_meet_what_others_leave(spark):
    raw = ["copyrightadvertisement2024 x", "ADVERTISEMENT y", "Clickhttp://a.b here", "“a”—b", "see a@b.c ok", "Copyright 2024\nz All Rights Reserved"]
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "k int, text string")
    found = [r.t for r in frame.select("k", tx.normalize_text(frame.text).alias("t")).orderBy("k").collect()]
    assert found == ["", "y", "Click here", '"a" -- b', "see ok", "z"]


def test_leading_grams_name_few():
    words = [f"w{i % 97}x{i % 31}" for i in range(3000)]
    lists = pa.array([words, [], None, ["only"], ["the"], ["b", "the", "a", "b", "a"]], pa.list_(pa.string()))
    found = textgrams.leading_grams(lists, frozenset(["the"]), 1, 3, 5, 2e-6).to_pylist()
    assert [len(x) for x in found[1:5]] == [0, 0, 1, 0]
    assert 5 <= len(found[0]) < 3000
    assert {x["keyword"] for x in found[5]} >= {"b a b", "b a", "a b"}


@pytest.mark.parametrize("heavy", [1, 1000])
def test_topic_leakage_counts_only_pairs_of_frequent_tokens(spark, monkeypatch, heavy):
    rng = np.random.default_rng(3)
    rows = [(None if k % 5 == 0 else f"c{k % 3}", " ".join(f"w{min(int(x), 60)}" for x in rng.zipf(1.6, 40))) for k in range(60)]
    rows += [("tiny", "alpha beta alpha beta"), ("tiny", "alpha beta"), ("c1", None)]
    counted = {}
    for name, text in rows:
        words = (text or "").split()
        for term in {*words, *map(" ".join, zip(words, words[1:]))}:
            n = sum(" ".join(words[i : i + 1 + term.count(" ")]) == term for i in range(len(words)))
            df, total = counted.get((name, term), (0, 0))
            counted[name, term] = (df + 1, total + n)
    expected = {}
    for (name, term), (df, total) in counted.items():
        if df >= 2:
            expected.setdefault(name, []).append((-total, term))
    pairs = []
    monkeypatch.setattr(ft, "HEAVY_TOKENS", heavy)
    monkeypatch.setattr(ft, "_class_totals", lambda *given, real=ft._class_totals: pairs.append(real(*given)) or pairs[-1])
    frame = spark.createDataFrame(rows, "pred_label string, text string")
    got = {}
    for r in ft.topic_leakage(frame, top_k=4, stop_words=()).collect():
        got.setdefault(r.class_name, []).append((r["rank"], -r["count"], r.term))
    assert got == {name: [(i + 1, *x) for i, x in enumerate(sorted(found)[:4])] for name, found in expected.items()}
    if heavy > 1:
        # The pairs of all tokens would be ten times as many.
        assert pairs[1].count() * 10 < len([1 for _, term in counted if " " in term])


@pytest.mark.parametrize("name", ["train_logreg", "model_tables"])
def test_training_cleans_and_tokenises_once(spark, monkeypatch, name):
    calls, tokenised = [], []
    monkeypatch.setattr(fx, "normalize", lambda df, real=fx.normalize: calls.append(1) or real(df))
    monkeypatch.setattr(tx, "content_tokens", lambda *a, real=tx.content_tokens: tokenised.append(1) or real(*a))
    assert qs.REGISTRY[name](spark, SF_DIR).count()
    assert len(calls) == len(tokenised) == 1


def test_a_table_of_tokens_gives_the_same_model(spark):
    docs = fx.clean_docs(spark, SF_DIR).where("label is not null")
    tokens, tokenized = ft.token_table(docs)
    plain, read = ft.vocabulary(docs, max_features=300), ft.vocabulary(tokens, tokenized, 300)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, read.collect()))
    assert sorted(map(tuple, ft.tfidf_transform(docs, plain).collect())) == sorted(map(tuple, ft.tfidf_transform(tokens, plain, tokenized).collect()))
    assert ft.vocabulary(tokens, tokenized).count() == ft.vocabulary(docs).count()
    model = tr.train_logreg(tokens, plain, max_iter=3, analyzer=tokenized)
    assert not model.analyzer.tokenized
    scored = ln.linear_scores(docs, model.wide(), model.intercepts, analyzer=model.analyzer, normalize=False)
    assert scored.count() == docs.count() and scored.where("z_0 is null").isEmpty()
