import itertools
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from slantwise import constants as K
from slantwise.operators import features as ft
from slantwise.operators import keywords as kw
from slantwise.operators import linear as ln

CLASSES = K.CLASSES
DOCS = [
    (0, "left", "public health care funding and public schools funding"),
    (1, "left", "fund public health clinics for working families"),
    (2, "center", "the council debated the public budget for hours"),
    (3, "center", "weather report: rain and wind, wind and rain"),
    (4, "right", "lower taxes and less regulation help small business"),
    (5, "right", "small business owners want lower taxes taxes taxes"),
    (6, "right", "of the and"),
    (7, None, "public taxes"),
]


def grams(text, low=1, high=3):
    words = [w for w in re.findall(r"\w{2,}", text.lower()) if w not in set(K.STOP_WORDS)]
    return [" ".join(words[i : i + n]) for n in range(low, high + 1) for i in range(len(words) - n + 1)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, label string, text string").repartition(3)


@pytest.fixture(scope="module")
def vocab(docs):
    return ft.vocabulary(docs, max_features=25, min_df=1, max_df=0.9).persist()


def brute_vocab(max_features, min_df, max_df):
    df, cf = Counter(), Counter()
    for _, _, text in DOCS:
        found = grams(text)
        cf.update(found)
        df.update(set(found))
    kept = [t for t in df if min_df <= df[t] <= max_df * len(DOCS)]
    kept = sorted(sorted(kept, key=lambda t: (-cf[t], t))[:max_features])
    return {t: (i, df[t], cf[t], math.log((1 + len(DOCS)) / (1 + df[t])) + 1) for i, t in enumerate(kept)}


def brute_tfidf(table):
    out = {}
    for number, _, text in DOCS:
        counts = {t: c for t, c in Counter(grams(text)).items() if t in table}
        weights = {t: (1 + math.log(c)) * table[t][3] for t, c in counts.items()}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        out[number] = {t: w / norm for t, w in weights.items()}
    return out


@pytest.mark.parametrize("max_features, min_df, max_df", [(25, 1, 0.9), (1000, 2, 0.4), (5, 1, 1.0)])
def test_vocabulary(docs, max_features, min_df, max_df):
    got = {r.term: (r.idx, r.df, r.cf, r.idf) for r in ft.vocabulary(docs, max_features=max_features, min_df=min_df, max_df=max_df).collect()}
    expected = brute_vocab(max_features, min_df, max_df)
    assert set(got) == set(expected)
    for term in got:
        assert got[term] == pytest.approx(expected[term])


def test_tfidf(docs, vocab):
    expected = brute_tfidf(brute_vocab(25, 1, 0.9))
    got = {}
    for r in ft.tfidf_transform(docs, vocab).collect():
        got.setdefault(r.doc_id, {})[r.term] = r.tfidf
    assert set(got) == {k for k, v in expected.items() if v}
    for number, weights in got.items():
        assert weights == pytest.approx(expected[number])
        assert sum(w * w for w in weights.values()) == pytest.approx(1.0)


def test_term_lists_agree_with_long_form(docs, vocab):
    index = {r.term: r.idx for r in vocab.collect()}
    long = {(r.doc_id, index[r.term]): r.tfidf for r in ft.tfidf_transform(docs, vocab).collect()}
    lists = {(r.doc_id, i): v for r in ft.term_weight_lists(docs, vocab).collect() for i, v in zip(r.indices, r["values"])}
    assert lists == pytest.approx(long)


def test_chi2_is_observed_against_expected(docs, vocab):
    labeled = docs.where("label is not null")
    table = brute_vocab(25, 1, 0.9)
    weights = brute_tfidf(table)
    known = [(n, l) for n, l, _ in DOCS if l]
    got = {(r.class_name, r.phrase): (r.rank, r.score) for r in ft.chi2_phrases(labeled, vocab, top_k=100).collect()}
    for name in CLASSES:
        share = sum(l == name for _, l in known) / len(known)
        for term in table:
            inside = sum(weights[n].get(term, 0) for n, l in known if l == name)
            outside = sum(weights[n].get(term, 0) for n, l in known if l != name)
            total = inside + outside
            if not total:
                continue
            chi = (inside - share * total) ** 2 / (share * total) + (outside - (1 - share) * total) ** 2 / ((1 - share) * total)
            assert got[(name, term)][1] == pytest.approx(chi, abs=2e-6)
    for name in CLASSES:
        ranks = sorted((v[0], -v[1], k[1]) for k, v in got.items() if k[0] == name)
        assert [r[0] for r in ranks] == list(range(1, len(ranks) + 1))
        assert [r[1:] for r in ranks] == sorted(r[1:] for r in ranks)


def test_chi2_skips_an_absent_class(docs, vocab):
    some = docs.where("label in ('left', 'right')")
    assert {r.class_name for r in ft.chi2_phrases(some, vocab).collect()} == {"left", "right"}
    assert ft.chi2_phrases(docs.where("label = 'left'"), vocab).count() == 0
    with pytest.raises(ValueError):
        ft.discriminative_phrases(docs, vocab, "other")


def test_mutual_information(docs, vocab):
    labeled = docs.where("label is not null")
    table, known = brute_vocab(25, 1, 0.9), [(n, l) for n, l, _ in DOCS if l]
    weights, n = brute_tfidf(table), len(known)
    info = {}
    for term in table:
        value = 0.0
        for present, name in itertools.product((True, False), CLASSES):
            joint = sum((term in weights[d]) == present and l == name for d, l in known) / n
            p_term = sum((term in weights[d]) == present for d, _ in known) / n
            p_class = sum(l == name for _, l in known) / n
            if joint:
                value += joint * math.log(joint / (p_term * p_class))
        info[term] = value
    got = ft.discriminative_phrases(labeled, vocab, "mutual_info", top_k=30).collect()
    for r in got:
        members = [d for d, l in known if l == r.class_name]
        mean = sum(weights[d].get(r.phrase, 0) for d in members) / len(members)
        assert r.score == pytest.approx(mean * info[r.phrase], abs=3e-6)


def test_topic_leakage(spark):
    rows = [("left", "cats dogs cats"), ("left", "cats birds"), ("right", "fish"), ("right", "boats")]
    df = spark.createDataFrame(rows, "pred_label string, text string")
    assert [tuple(r) for r in ft.topic_leakage(df).collect()] == [("left", 1, "cats", 3)]


def brute_keywords(text, top_k):
    words = re.findall(r"\w{2,}", text.lower())
    candidates = sorted(set(grams(text)))
    documents = [Counter(words)] + [Counter(c.split(" ")) for c in candidates]
    n = len(documents)
    df = Counter(t for d in documents for t in d)
    idf = {t: math.log((1 + n) / (1 + df[t])) + 1 for t in df}
    vectors = [{t: c * idf[t] for t, c in d.items()} for d in documents]
    norm = [math.sqrt(sum(v * v for v in vec.values())) for vec in vectors]
    scores = [
        (-round(sum(vectors[0][t] * w for t, w in vectors[i + 1].items()) / (norm[0] * norm[i + 1]), 6), c)
        for i, c in enumerate(candidates)
    ]
    return [(c, -s) for s, c in sorted(scores)[:top_k]]


@pytest.mark.parametrize("top_k", [3, 200])
def test_doc_keywords(spark, top_k):
    texts = [t for _, _, t in DOCS] + ["", "word", "very very very good very good good", "a b c", "rain rain"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in kw.doc_keywords(df, top_k=top_k).orderBy("doc_id", "rank").collect():
        got.setdefault(r.doc_id, []).append((r.keyword, r.score))
    for number, text in enumerate(texts):
        expected = brute_keywords(text, top_k)
        assert [k for k, _ in got.get(number, [])] == [k for k, _ in expected]
        assert [s for _, s in got.get(number, [])] == pytest.approx([s for _, s in expected], abs=2e-6)


def test_class_keywords_read_all_documents(spark):
    rows = [(3, "left", "zebra"), (1, "left", "apple banana"), (2, "left", "cherry"), (9, "right", "pear"), (7, "other", "fig")]
    df = spark.createDataFrame(rows, "doc_id long, label string, text string")

    def found(**options):
        return {(r.class_name, r.keyword) for r in kw.class_keywords(df, **options).collect()}

    near = {("left", "apple"), ("left", "banana"), ("left", "apple banana"), ("left", "cherry"), ("right", "pear")}
    assert found() == near | {("left", "zebra")}
    assert found(max_docs=2) == near


def test_class_keywords_of_one_document_match_the_document(spark):
    text = "The cat sat near the other cat, and the dog sat far off"
    df = spark.createDataFrame([(1, "left", text)], "doc_id long, label string, text string")
    one = [(r.keyword, r.score) for r in kw.doc_keywords(df).orderBy("rank").collect()]
    assert [(r.keyword, r.score) for r in kw.class_keywords(df).orderBy("rank").collect()] == one


def test_all_terms_are_indexed_in_order(spark):
    df = spark.createDataFrame([(i, f"term{i:03d} shared") for i in range(200)], "doc_id long, text string")
    rows = ft.vocabulary(df, ft.Analyzer((1, 1)), min_df=1, max_df=1.0).collect()
    assert [r.idx for r in sorted(rows, key=lambda r: r.term)] == list(range(201))


@pytest.fixture(scope="module")
def model(spark, vocab):
    weights = vocab.select("term", F.explode(F.array(*[F.lit(i) for i in range(3)])).alias("class_idx")).select(
        "term", "class_idx", (((F.length("term") * (F.col("class_idx") + 2)) % 7 - 3) / F.lit(4.0)).alias("coef")
    )
    intercepts = spark.createDataFrame([(0, 0.2), (1, 0.0), (2, -0.2)], "class_idx int, intercept double")
    return ln.wide_weights(vocab, weights), intercepts, weights


def brute_proba(tokens):
    table = brute_vocab(25, 1, 0.9)
    found = [" ".join(tokens[i : i + n]) for n in (1, 2, 3) for i in range(len(tokens) - n + 1)]
    counts = {t: c for t, c in Counter(found).items() if t in table}
    w = {t: (1 + math.log(c)) * table[t][3] for t, c in counts.items()}
    norm = math.sqrt(sum(v * v for v in w.values()))
    z = [
        b + sum(v / norm * ((len(t) * (i + 2)) % 7 - 3) / 4.0 for t, v in w.items())
        for i, b in enumerate((0.2, 0.0, -0.2))
    ]
    e = np.exp(np.array(z) - max(z))
    return e / e.sum()


def test_scores(docs, model):
    wide, intercepts, _ = model
    rows = {r.doc_id: r for r in ln.score_documents(docs, wide, intercepts).collect()}
    assert len(rows) == len(DOCS)
    for number, _, text in DOCS:
        p = brute_proba(grams(text, 1, 1))
        r = rows[number]
        assert [r.prob_left, r.prob_center, r.prob_right] == pytest.approx(list(p))
        assert r.polarity_score == pytest.approx(p[2] - p[0]) and -1 <= r.polarity_score <= 1
        assert r.pred_label == CLASSES[int(np.argmax(p))]
        assert r.entropy == pytest.approx(-float(np.sum(p * np.log(p + 1e-10))))


def test_score_one_text(spark, model):
    wide, intercepts, _ = model
    row = ln.score_text(spark, "Public  taxes", wide, intercepts).first()
    assert row.prob_left == pytest.approx(brute_proba(["public", "taxes"])[0])


def test_rows_score_by_their_own_text(spark, model):
    wide, intercepts, _ = model
    texts = [(1, "public taxes"), (1, "market"), (None, "public taxes"), (None, None), (2, "public taxes")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    for got in (ln.score_documents(df, wide, intercepts).collect(), ln.score_documents(df, wide, intercepts, rows=25).collect()):
        assert len(got) == len(texts)
        for row in got:
            tokens = row.text.split() if row.text else []
            assert [row.prob_left, row.prob_center, row.prob_right] == pytest.approx(list(brute_proba(tokens)))


def test_leave_one_out_matches_rescoring(docs, model):
    wide, intercepts, _ = model
    got = {(r.doc_id, r.position): (r.token, r.importance) for r in ln.leave_one_out(docs, wide, intercepts, top_k=1000).collect()}
    expected = {}
    for number, _, text in DOCS:
        tokens = grams(text, 1, 1)
        if len(tokens) < 2:
            continue
        p = brute_proba(tokens)
        best = int(np.argmax(p))
        for i, token in enumerate(tokens):
            expected[(number, i)] = (token, p[best] - brute_proba(tokens[:i] + tokens[i + 1 :])[best])
    assert set(got) == set(expected)
    for key in expected:
        assert got[key][0] == expected[key][0]
        assert got[key][1] == pytest.approx(expected[key][1], abs=2e-6)
    capped = ln.leave_one_out(docs, wide, intercepts, top_k=2, max_tokens=3).collect()
    assert max(r.position for r in capped) <= 2 and max(r["rank"] for r in capped) == 2


def test_explain_terms(docs, model):
    wide, intercepts, _ = model
    weights = brute_tfidf(brute_vocab(25, 1, 0.9))
    rows = ln.explain_terms(docs, wide, intercepts, top_k=100).collect()
    assert {r.doc_id for r in rows} == {n for n, w in weights.items() if w}
    for r in rows:
        best = CLASSES.index(r.pred_label)
        assert r.contribution == pytest.approx(((len(r.term) * (best + 2)) % 7 - 3) / 4.0 * weights[r.doc_id][r.term], abs=2e-6)
    plain = ln.explain_terms(docs, wide, None, top_k=100).collect()
    assert all(r.contribution == pytest.approx(weights[r.doc_id][r.term], abs=2e-6) for r in plain)


def test_top_coefficients_are_positive(model):
    rows = ln.top_coefficients(model[2], top_k=4).collect()
    assert rows and all(r.coef > 0 and r["rank"] <= 4 for r in rows)


def test_only_frequent_terms_are_counted_by_name(spark, monkeypatch):
    rows = [(k, " ".join([f"common{k % 5}", "shared", *[f"rare{k}x{i}" for i in range(40)]])) for k in range(60)]
    sizes = {}
    write = ft.materialize

    def noted(df, name):
        stored = write(df, name)
        sizes[name] = stored.count()
        return stored

    monkeypatch.setattr(ft, "materialize", noted)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r.term, r.cf) for r in ft.vocabulary(df, ft.Analyzer((1, 1)), max_features=6, min_df=2, max_df=1.0).collect()]
    assert sorted(got) == [*[(f"common{k}", 12) for k in range(5)], ("shared", 60)]
    assert sizes["term-stats"] < 100


@pytest.mark.parametrize("max_features", [1, 7, 60, 5000])
def test_the_floor_does_not_change_the_vocabulary(spark, monkeypatch, max_features):
    # Few buckets: most terms share one, so the first floor is wrong.
    monkeypatch.setattr(ft, "LEAST_BITS", 5)
    monkeypatch.setattr(ft, "BUCKETS_A_TERM", 1)
    texts = [" ".join(f"w{(k * i * i) % 23}" for i in range(2, 30)) for k in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    cf, counted = Counter(), Counter()
    for text in texts:
        cf.update(grams(text))
        counted.update(set(grams(text)))
    kept = [t for t in cf if 2 <= counted[t] <= 0.9 * len(texts)]
    want = {(t, counted[t], cf[t]) for t in sorted(kept, key=lambda t: (-cf[t], t))[:max_features]}
    assert {(r.term, r.df, r.cf) for r in ft.vocabulary(df, max_features=max_features, min_df=2, max_df=0.9).collect()} == want
