"""Fingerprints and their components against brute force, and the index of bytes."""

import re
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from slantwise.llm import simhash
from slantwise.llm.fingerprints import fingerprint_links, similar_fingerprints


def plain_fingerprint(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))] if words else []
    values = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def roots_of(prints, max_bits):
    """Least member of each component, by comparing all pairs."""
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in combinations(sorted(root), 2):
        if (a ^ b).bit_count() <= max_bits:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {p: find(p) for p in root}


WORDS = [f"w{k % 97}x{k % 31}" for k in range(2000)]
TEXTS = [
    None, "", " \t\n", "One", "one two three", "ONE two\tthree  four", "one two three four five", "É é A a",
    " ".join(WORDS), " ".join(WORDS).upper(), " ".join(WORDS[:1000] + ["new"] + WORDS[1000:]), " ".join(WORDS * 20),
    " ".join(WORDS[5:1990]), "same " * 40, "same " * 3, "x" * 200_000, "\x1c a \x85 b",
]


def test_components_of_documents(spark):
    rng = np.random.default_rng(3)
    texts = list(TEXTS)
    for _ in range(120):  # chains of small changes
        base = list(WORDS[: int(rng.integers(60, 900))])
        base[int(rng.integers(0, len(base)))] = f"c{rng.integers(0, 5)}"
        texts.append(" ".join(base))
    rows = [(None if k % 9 == 8 else k, t, "clash", "clash", 1) for k, t in enumerate(texts)] + [(4, "one two three", "", "", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id string, id long").repartition(4)
    prints = [plain_fingerprint(r[1]) for r in rows]
    root = roots_of(prints, 4)
    least = {}
    for (i, *_), p in zip(rows, prints):
        if i is not None:
            least[root[p]] = min(i, least.get(root[p], i))
    want = Counter((r[0], f"{p:016x}", least.get(root[p])) for r, p in zip(rows, prints))
    assert Counter(tuple(r) for r in similar_fingerprints(df).collect()) == want
    assert similar_fingerprints(df.limit(0)).collect() == []


def test_hash_is_the_one_spark_has(spark):
    texts = ["a", "one two three four", "é" * 40, "x" * 1000]
    ours = [xxhash.xxh64_intdigest(t.encode(), 42) for t in texts]
    found = [r[0] % 2**64 for r in spark.createDataFrame(list(enumerate(texts)), "k int, t string").orderBy("k").select(F.xxhash64("t")).collect()]
    assert found == ours


def some_prints(seed, n):
    """Random fingerprints, chains of near ones and a dense group."""
    rng = np.random.default_rng(seed)
    out = {int(x) for x in rng.integers(0, 2**64, n, dtype=np.uint64)}
    for p in list(out)[: n // 3]:
        for _ in range(4):
            for b in rng.integers(0, 64, int(rng.integers(1, 6))):
                p ^= 1 << int(b)
            out.add(p)
    return sorted(out | {0xABCD_0000_0000_1234 ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a)})


@pytest.mark.parametrize("max_bits,depth,hot_list", [(4, 1, 1 << 14), (4, 2, 1 << 14), (4, 4, 1 << 14), (4, 2, 20), (2, 3, 5), (6, 1, 50), (0, 8, 9)])
def test_no_link_is_lost(spark, max_bits, depth, hot_list):
    prints = some_prints(max_bits + depth, 150)
    df = spark.createDataFrame([(p - 2**64 if p >= 2**63 else p,) for p in prints], "fp long").repartition(3)
    links = [(r.a % 2**64, r.b % 2**64) for r in fingerprint_links(df, max_bits, depth, hot_list).collect()]
    assert all((a ^ b).bit_count() <= max_bits or max_bits > 0 for a, b in links)
    want = roots_of(prints, max_bits)
    joined = {p: p for p in prints}
    for _ in prints:
        before = dict(joined)
        for a, b in links:
            joined[a] = joined[b] = min(joined[a], joined[b])
        if joined == before:
            break
    assert joined == want


def test_lists_cut_by_batches_say_the_same():
    rng = np.random.default_rng(1)
    names = np.sort(rng.integers(0, 12, 400)).astype(np.int64)
    prints = rng.integers(0, 2**20, 400).astype(np.int64)

    def run(cuts):
        parts = [(names[a:b], prints[a:b]) for a, b in zip([0, *cuts], [*cuts, 400])]
        batches = [pa.RecordBatch.from_arrays([pa.array(n), pa.array(p)], ["list", "fp"]) for n, p in parts]
        got = [tuple(r.values()) for x in simhash.linked(iter(batches), 4, 35) for r in x.to_pylist()]
        return {r for r in got if r[1] is None}, len({r for r in got if r[1] is not None}) > 0

    assert run([]) == run([1, 2, 50, 50, 51, 333]) == run(list(range(7, 400, 7)))


def test_bytes_are_tallied():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 2**64, 500, dtype=np.uint64) & rng.choice(np.array([0, 0xFF, 0xFF00, 2**64 - 1, 0x80FF00], np.uint64), 500)
    assert simhash.shared_bytes(x).tolist() == [int(v).to_bytes(8, "little").count(0) for v in x]


def test_depth_follows_cost():
    assert [simhash.list_depth(n, 4) for n in (10, 10**6, 10**9, 10**11)] == sorted(simhash.list_depth(n, 4) for n in (10, 10**6, 10**9, 10**11))
    assert simhash.list_depth(10, 4) == 1 and simhash.list_depth(10**11, 4) == 4
