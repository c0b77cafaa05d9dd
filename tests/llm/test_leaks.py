"""Benchmark leaks with test sets of several passes."""

import inspect

import numpy as np

from slantwise.llm.decontaminate import find_leaks


def test_any_size_of_test_set_gives_the_same_result(spark):
    draw = np.random.default_rng(2)
    items = [(f"i{k}", " ".join(f"q{k}w{n}" for n in range(int(draw.integers(3, 40))))) for k in range(60)]
    texts = [(k, "a b " + " c ".join(items[int(i)][1] for i in draw.integers(0, 60, 3)) + " q1w2") for k in range(40)] + [(99, None), (100, "clean")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    whole, cut = (sorted(find_leaks(docs, bench, block_bytes=n).collect()) for n in (4 << 20, 400))
    assert whole == cut and sum(r.contaminated for r in whole) == 40
    for r in whole[:40]:
        want = {i for i, t in items if f" {' '.join(t.split()[:10])} " in f" {texts[r.doc_id][1]} "}
        assert r.n_items == len(want)


def test_no_size_is_refused_unless_asked_for(spark):
    assert inspect.signature(find_leaks).parameters["pass_bytes"].default is None
    docs = spark.createDataFrame([(1, "x " + " ".join(f"k{n}" for n in range(12)))], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(f"k{n}" for n in range(12))), (2, "y" * (17 << 20))], "item_id long, text string")
    assert [(r.n_hit, r.n_items) for r in find_leaks(docs, bench).collect()] == [(12, 1)]


def _words(text):
    import re

    return re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").lower())


def _brute(text, items, window):
    """Hit words, item ids, and the longest match from each place where a window occurs."""
    words, hit, ids, longest = _words(text), set(), set(), {}
    for name, item in items:
        own = _words(item)
        size = min(window, len(own))
        for at in range(len(own) - size + 1 if size else 0):
            for p in range(len(words) - size + 1):
                if words[p : p + size] == own[at : at + size]:
                    hit.update(range(p, p + size))
                    ids.add(name)
                    n = size
                    while size == window and own[at + n : at + n + 1] == words[p + n : p + n + 1] != []:
                        n += 1
                    longest[p] = max(n, longest.get(p, 0))
    starts = {(p, n) for p, n in longest.items() if longest.get(p - 1) != n + 1}
    return len(hit), ids, max(longest.values(), default=0), starts


def test_leaks_in_repetitive_texts_match_brute_force(spark):
    rng = np.random.default_rng(11)
    items = [(f"i{k}", " ".join(rng.choice(["a", "b", "a", "c"], int(rng.integers(0, 14))))) for k in range(25)] + [("i0", "a b a"), ("z", None), ("r", "a " * 30)]
    texts = [" ".join(rng.choice(["a", "b", "a", "c", "x"], int(rng.integers(0, 60)))) for _ in range(40)] + [None, "", "a " * 70, "A, a-a"]
    docs = spark.createDataFrame([(k, t, "clash") for k, t in enumerate(texts)], "doc_id long, text string, n_hit string").repartition(3)
    bench = spark.createDataFrame(items, "item_id string, text string")
    for block in (4 << 20, 60):
        for r in find_leaks(docs, bench, window=4, block_bytes=block).collect():
            n_hit, ids, longest, starts = _brute(r.text, items, 4)
            assert (r.n_hit, r.n_items, r.longest_match, r.contaminated) == (n_hit, len(ids), longest, n_hit > 0)
            if block > 60:  # in one pass a place has one longest match
                spots = [m.split(":") for m in r.matches]
                assert {(int(p), int(n)) for p, n, *_ in spots} == starts
                for p, n, name, at in ((int(p), int(n), name, int(at)) for p, n, name, at in spots):
                    assert any(_words(t)[at : at + n] == _words(r.text)[p : p + n] for i, t in items if i == name)


def test_repetition_stays_linear():
    import time

    import pyarrow as pa

    from slantwise.llm.suffixes import TestItems, leak_columns

    for item, text in ((["0 " * 4000], ["0 " * 4000]), ([" ".join(map(str, range(4000)))], [" ".join(map(str, range(4000)))])):
        began = time.time()
        out = leak_columns([TestItems(["i"], pa.array(item), 10)], pa.array(text))
        assert out.column(1)[0].as_py() == 4000 and out.column(5)[0].as_py() == 4000
        assert out.column(6)[0].as_py() == ["0:4000:i:0"]
        assert time.time() - began < 5
