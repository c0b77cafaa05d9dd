"""Operators against brute force on small tables with odd rows."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from slantwise.llm import passages, pairs, quality, secrets, setjoin, sharding, substrings
from slantwise.llm.bwt import repeated_suffixes
from slantwise.llm.components import connected_components
from slantwise.llm.decontaminate import decontaminate, find_leaks
from slantwise.llm.lines import drop_site_boilerplate
from slantwise.llm.mixing import mix_sources
from slantwise.llm.tokencount import Counter as TokenCounter
from slantwise.llm.tokencount import count_tokens, splice_count

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string"
WORDS = [f"w{k}" for k in range(200)]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0d]+", text or "")


@pytest.fixture(scope="module")
def docs(spark):
    base = " ".join(WORDS)
    near = base.replace("w100", "other")
    rows = [
        (1, base), (2, base), (2, base), (3, near), (4, "a tail " + " ".join(WORDS[40:140]) + " and more"),
        (5, None), (6, ""), (7, "x"), (8, "One two"), (None, "one two"), (9, "äö " * 40 + "\n" + "same line\nsame line\n"),
        (10, "z" * 900), (11, " ".join(f"u{k}" for k in range(3000))),
    ]
    data = [(i, t, "en", None if k % 5 == 0 else f"s{k % 3}", 1, "clash") for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def bag(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


OPERATORS = {
    "substrings": lambda d: substrings.remove_repeats(d, length=40, gram=16),
    "sets": setjoin.similar_components,
    "passages": passages.find_passages,
    "mix": mix_sources,
    "shards": lambda d: sharding.shard_documents(d, shards=3),
    "quality": quality.host_quality,
    "leaks": lambda d: find_leaks(d, d.select(F.col("doc_id").alias("item_id"), "text").where("doc_id = 4")),
    "secrets": secrets.find_secrets,
    "lines": lambda d: drop_site_boilerplate(d, host_col="source"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(docs, name):
    assert OPERATORS[name](docs.limit(0)).count() == 0


@pytest.mark.parametrize("name", [n for n in OPERATORS if n != "passages"])
def test_every_row_once(docs, name):
    assert bag(OPERATORS[name](docs), "doc_id") == bag(docs, "doc_id")


@pytest.mark.parametrize("hot_list", [8192, 0])
def test_removed_bytes(docs, hot_list):
    texts = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    size = 40
    starts = Counter(t[k : k + size] for _, t in texts for k in range(len(t) - size + 1))
    want = Counter()
    for i, t in texts:
        drop = bytearray(len(t))
        for k in range(len(t) - size + 1):
            if starts[t[k : k + size]] > 1:
                drop[k : k + size] = b"\1" * size
        left = bytes(b for b, d in zip(t, drop) if not d)
        want[i, len(t), sum(drop), len(re.findall(b"\1+", bytes(drop))), hashlib.sha256(left).hexdigest()] += 1
    got = substrings.remove_repeats(docs, length=size, gram=16, hot_list=hot_list, collection_bytes=2000)
    assert bag(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want


def test_transform_finds_repeats():
    strings = [b"abcabcabcx", b"yabcabca", b"qq", b"", b"abcabcab"]
    for size in (2, 3, 5, 8):
        starts = Counter(s[k : k + size] for s in strings for k in range(len(s) - size + 1))
        for s, mask in zip(strings, repeated_suffixes(strings, size)):
            assert mask.tolist() == [k <= len(s) - size and starts[s[k : k + size]] > 1 for k in range(len(s))]


def shingles(text, size):
    words = words_of(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1)))


@pytest.mark.parametrize("small,block", [(None, 1 << 20), (0, 1 << 20), (30, 150)])
def test_similar_components(spark, small, block):
    texts = [" ".join(WORDS[a : a + n]) for n in (3, 9, 10, 11, 12, 25, 60) for a in (0, 0, 1, 5)]
    texts += [" ".join(WORDS[:60]).replace(f"w{k} ", f"q{k} ") for k in (2, 30, 31, 55)] + [None, "", "One two", "one TWO"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [shingles(t, 3) for t in texts]
    root = list(range(len(texts)))
    for _ in texts:
        for a, x in enumerate(sets):
            for b, y in enumerate(sets):
                if x and y and 100 * len(x & y) >= 80 * len(x | y):
                    root[a] = root[b] = min(root[a], root[b])
    got = setjoin.similar_components(rows, percent=80, small=small, block_elements=block)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == {k: (len(s), root[k]) for k, s in enumerate(sets)}


def test_sketches_rule_out_no_link():
    rng = np.random.default_rng(5)
    base = rng.integers(1, 2**63, 400, dtype=np.uint64)
    sets = [np.unique(base[a : a + n]) for n in (1, 5, 63, 64, 65, 120, 130, 256, 300) for a in (0, 3, 20, 90)]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    words = [np.frombuffer(x, np.uint64) for x in pairs.sketches(np.concatenate(sets), bounds)]
    label = pairs.plausible_groups(np.diff(bounds), words, 80)
    for a, x in enumerate(sets):
        for b, y in enumerate(sets):
            common = len(np.intersect1d(x, y))
            if 100 * common >= 80 * (len(x) + len(y) - common):
                assert label[a] == label[b]
    assert label[0] != label[3] and len(set(label.tolist())) > 5


def test_keep_one_leaves_one_of_each_group(docs):
    kept = bag(setjoin.keep_one(docs), "doc_id")
    assert kept == Counter((k,) for k in (1, 4, 5, 6, 7, 8, 9, 10, 11))


def test_boundary_follows_cost():
    assert pairs.boundary({5: 100}, 90) >= 5
    assert pairs.boundary({40: 1000}, 90) < 40


def test_components_of_a_path(spark):
    links = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert bag(connected_components(links), "root") == Counter({(0,): 201})


def test_passages_cover_all_copies(docs):
    rows = docs.where("doc_id is not null").collect()
    words = {r.doc_id: words_of(r.text) for r in rows}
    seen = defaultdict(set)
    for k, r in enumerate(rows):
        for a in range(len(words[r.doc_id]) - 49):
            seen[tuple(words[r.doc_id][a : a + 50])].add(k)
    want = {r.doc_id for k, r in enumerate(rows) for a in range(len(words[r.doc_id]) - 49) if len(seen[tuple(words[r.doc_id][a : a + 50])]) > 1}
    got = passages.find_passages(docs).collect()
    assert want <= {r.doc_id for r in got} and not {r.doc_id for r in got} & {5, 6, 7, 8, 11}
    assert all(r.first_word <= 2 and r.first_word + r.n_words >= 102 for r in got if r.doc_id == 4)


def test_mix_meets_targets(docs):
    rows = mix_sources(docs, seed=3).collect()
    assert all(0 <= r.taken <= 3 * r["size"] for r in rows)
    by = defaultdict(int)
    for r in rows:
        by[r.source] += r.taken
    target = {r.source: r.target for r in rows}
    assert all(target[s] - 2 < by[s] <= target[s] + 1e-6 for s in by)
    assert Counter(rows) == Counter(mix_sources(docs, seed=3).collect())


def test_shards_balance_and_count(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot " * 20).otherwise(F.repeat(F.hex("id"), 20)).alias("text"))
    got = sharding.shard_documents(rows, shards=6).collect()
    size, slots = Counter(), defaultdict(list)
    for r in got:
        size[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert max(size.values()) < 1.02 * min(size.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_leaks_report_longest_match(spark):
    item = " ".join(WORDS[10:40])
    docs = spark.createDataFrame([(1, "a b " + " ".join(WORDS[12:30]) + " c"), (2, "clean"), (3, None), (4, "see W5, w6!")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (8, None), (9, "w5 w6")], "item_id long, text string")
    got = {r.doc_id: r for r in find_leaks(docs, bench).collect()}
    assert (got[1].n_hit, got[1].n_items, got[1].longest_match) == (18, 1, 18)
    assert got[4].n_hit == 2 and got[4].items_sha256 == hashlib.sha256(b"9").hexdigest()
    assert [r.doc_id for r in decontaminate(docs, bench).orderBy("doc_id").collect()] == [2, 3]
    with pytest.raises(ValueError):
        find_leaks(docs, bench, pass_bytes=3)


def test_weak_secrets_need_each_other(spark):
    key = "Ab1" + "xY9/" * 9 + "q"
    texts = ["AKIA" + "Z" * 16 + f" with {key}", key, f"access_key_id=abcdef99 {'.' * 400} {key}", "password = 'abcdefghijkl' token: short"]
    got = [r.spans for r in secrets.find_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert got == ["access:0:20,key:26:66", "", "", "assign:0:24"]


def test_site_lines(spark):
    rows = [(k, "a" if k < 8 else None, f"menu\nown {k}\n menu \n") for k in range(10)]
    got = drop_site_boilerplate(spark.createDataFrame(rows, "page_id long, host string, text string"), max_ratio=0.5)
    assert {r.page_id: (r.n_lines, r.n_dropped, r.text) for r in got.collect()} == {
        k: (3, 2, f"own {k}") if k < 8 else (3, 0, f"menu\nown {k}\nmenu") for k in range(10)
    }


def test_token_counts_match_the_library(spark):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    texts = [None, "", "it's  a <|endoftext|> b", "a  b \x1c c\n\n d", "é" * 50, "ab " * 400, "x" * 700, " \t\n" * 90]
    got = count_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path, chunk=300, overlap=20)
    want = [len(library.encode(t or "", add_special_tokens=False)) for t in texts]
    assert [r.n_tokens for r in got.orderBy("doc_id").collect()] == want
    counter = TokenCounter(path, 300, 20)
    for text, n in zip(texts, want):
        assert splice_count(text or "", counter.token_starts, 60, 7) == n


def test_host_verdict_drops_a_bad_host(spark):
    good = " ".join(WORDS)
    rows = [(k, good if k % 10 or k >= 50 else "bad", "a" if k < 50 else "b") for k in range(100)]
    rows += [(100 + k, "bad" if k else good, "c") for k in range(50)]
    got = quality.host_quality(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert {r.source: r.kept for r in got if not r.base_failed} == {"a": True, "b": True, "c": False}
