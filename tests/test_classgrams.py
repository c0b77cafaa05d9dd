"""Keywords of classes: distinct n-grams and their terms counted in arrays, candidates bounded by the heaviest terms."""

import functools
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from slantwise.functions import classgrams
from slantwise.operators import keywords as kw

STOP = np.array([0, 1], np.int64)


def made(seed, rows=60, terms=30):
    rng = random.Random(seed)
    return [(rng.choice("ab"), [min(int(rng.expovariate(0.15)), terms) for _ in range(rng.randrange(0, 25))]) for _ in range(rows)]


def batches(rows, size=17):
    for at in range(0, len(rows), size):
        part = rows[at : at + size]
        terms = pa.array([t for _, t in part], pa.list_(pa.int64()))
        words = pa.array([[f"w{x}" for x in t] for _, t in part], pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in part]), terms, words], ["class_name", "terms", "words"])


def grams(rows):
    out = defaultdict(set)
    for name, terms in rows:
        kept = [t for t in terms if t > 1]
        out[name] |= {tuple(kept[i : i + n]) for n in (1, 2, 3) for i in range(len(kept) - n + 1)}
    return out


def test_terms_are_counted_over_distinct_ngrams(monkeypatch):
    monkeypatch.setattr(classgrams, "TOKENS", 100)
    monkeypatch.setattr(classgrams, "PAIRS", 10)
    rows = made(1)
    parts = [r for b in classgrams.gram_parts(batches(rows), STOP, 1, 3, 4) for r in zip(*(c.to_pylist() for c in b.columns))]
    parts.sort(key=lambda r: r[:3])
    columns = [pa.array(c) for c in zip(*parts)]
    got = Counter(), Counter()
    for b in classgrams.term_counts([pa.RecordBatch.from_arrays(columns, ["bucket", "class_name", "n", "data"])]):
        for name, term, tf, held in zip(*(c.to_pylist() for c in b.columns)):
            got[0][name, term] += tf or 0
            got[1][name, term] += held
    found = grams(rows)
    held = Counter((name, t) for name, own in found.items() for gram in own for t in {*gram, None})
    assert +got[1] == held
    assert +got[0] == Counter((name, t) for name, terms in rows for t in terms)


def test_few_candidates_hold_all_the_best():
    rows, rng, top_k = made(2, rows=400, terms=200), random.Random(3), 5
    found = grams(rows)
    weights = {name: {t: (rng.uniform(1, 2) if t % 3 else rng.uniform(0, 0.4), rng.uniform(1, 4)) for g in own for t in g} for name, own in found.items()}

    def score(name, gram):
        own = [(tf * weights[name][t][1], weights[name][t][0]) for t, tf in Counter(gram).items()]
        return sum(a * b for a, b in own) / sum(a * a for a, _ in own) ** 0.5

    for rest in (0.0, 0.4, 1.5):
        known, least = {}, {}
        for name, own in weights.items():
            listed = sorted(t for t in own if own[t][0] > rest)
            known[name] = (np.array(listed, np.int64), *(np.array([own[t][k] for t in listed]) for k in (0, 1)))
            least[name] = min((own[t][1] for t in own if own[t][0] <= rest), default=0.0)
        zero = dict.fromkeys(found, 0.0)
        got = {
            (name, word)
            for b in classgrams.reaching(batches(rows, 100), STOP, 1, 3, top_k, known, rest, least, zero, dict.fromkeys(found, 1e-9))
            for name, word in zip(*(c.to_pylist() for c in b.columns))
        }
        for name, own in found.items():
            best = sorted(own, key=lambda g: -score(name, g))[:top_k]
            assert {(name, " ".join(f"w{t}" for t in g)) for g in best} <= got
        # Where all weights are known, little more than the best of four batches.
        assert rest or len(got) <= 2 * 4 * (top_k + 1) < sum(map(len, found.values())) / 10


def test_class_keywords_do_not_depend_on_the_list_of_terms(spark, monkeypatch):
    rows = [(i, name, " ".join(f"word{t}" if t > 1 else "the" for t in terms)) for i, (name, terms) in enumerate(made(4))]
    df = spark.createDataFrame(rows, "doc_id long, label string, text string")

    def best():
        return [tuple(r) for r in kw.class_keywords(df, classes=("a", "b", "c"), top_k=7).orderBy("class_name", "rank").collect()]

    whole = best()
    assert len(whole) == 14
    for limit in (0, 6):
        monkeypatch.setattr(kw, "_heaviest", functools.partial(kw._heaviest, limit=limit))
        assert best() == whole
        monkeypatch.undo()
