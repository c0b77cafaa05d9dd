"""Vector bin packing against a plain loop, and the law of the shards."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from slantwise.llm.sharding import pack, shard_documents


def plain_pack(demand, shards):
    total = [max(sum(row[d] for row in demand), 0) or 1 for d in range(3)]
    share = [[row[d] / total[d] for d in range(3)] for row in demand]
    room, out = [[1 / shards] * 3 for _ in range(shards)], [0] * len(demand)
    for item in sorted(range(len(demand)), key=lambda k: (-max(share[k]), k)):
        fit = [sum(r * s for r, s in zip(room[k], share[item])) for k in range(shards)]
        best = max(fit)
        out[item] = next(k for k in range(shards) if fit[k] >= best - 1e-15)
        room[out[item]] = [r - s for r, s in zip(room[out[item]], share[item])]
    return out


@pytest.mark.parametrize("shards,n", [(3, 40), (24, 200), (5, 3), (4, 0)])
def test_items_go_where_room_and_demand_align(shards, n):
    rng = np.random.default_rng(n)
    demand = rng.integers(1, 1000, (n, 3)).astype(float)
    assert pack(demand, shards).tolist() == plain_pack(demand.tolist(), shards)


def test_ties_go_to_the_lowest_shard():
    assert pack(np.ones((4, 3)), 4).tolist() == [0, 1, 2, 3]


def test_shards_of_odd_rows(spark):
    rng = random.Random(6)
    words = lambda n: " ".join(rng.choices(["alpha", "beta", "é", "x" * 9], k=n))
    texts = [words(rng.randint(1, 60)) for _ in range(900)] + ["hot " * 30] * 700 + [None, None, "", "z" * 20_000]
    texts += texts[:200] + texts[100:150]
    rows = [(None if k % 50 == 3 else k, t, "clash") for k, t in enumerate(texts)] + [(7, texts[7], "clash")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, law string").repartition(5)
    got = shard_documents(df, shards=6).collect()
    want = Counter((i, t, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert Counter((r.doc_id, r.text, r["size"], r.text_crc32) for r in got) == want
    assert {(r.law, r.grown_shard) for r in got} == {("bytes", None)}
    bytes_, counts, slots, homes = Counter(), Counter(), defaultdict(list), defaultdict(set)
    for r in got:
        bytes_[r.shard] += r["size"]
        counts[r.shard] += 1
        slots[r.shard].append(r.slot)
        homes[r.text].add(r.shard)
    assert set(bytes_) == set(range(6)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    # Equal texts stay together unless they fill half a shard.
    half = len(rows) / 6 / 2
    sizes = Counter(t for _, t, _ in rows)
    assert all(len(shards) == 1 for t, shards in homes.items() if sizes[t] < half)
    assert len(homes["hot " * 30]) > 1
    mean = sum(bytes_.values()) / 6
    assert max(bytes_.values()) < 1.3 * mean  # one text alone is 0.2 of a shard
