"""Every stage of the corpus pipeline against SQL or brute force, on a table with odd rows."""

import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

import corpus_pipeline
from slantwise.llm import oracle

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, size long"
STAGE = dict(corpus_pipeline.STAGES)


def make_rows():
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [prose(30), prose(12), prose(6), None, ""]
    texts = [prose(rng.randint(25, 90)) for _ in range(60)]
    texts += [t.upper() for t in texts[:5]] + texts[5:10] * 2  # copies
    texts += [t.replace(t.split()[20], "changed", 1) for t in texts[10:20]]  # near copies, or not
    texts += [f"{t} {items[k % 3]} {prose(5)}" for k, t in enumerate(texts[20:29])]  # leaks
    texts += [None, "", " \n", "short one", "same words here " * 20, "x" * 5000 + " " + prose(30)]
    rows = [(k, t, "en", None if k % 11 == 0 else f"s{k % 4}", len(t or ""), "clash", k) for k, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, prose(40), None, "s1", 1, None, None), (None, prose(40), None, "s1", 1, None, None)]
    return rows, items


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    rows, items = make_rows()
    folder = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache(), folder


def keyed(df):
    return Counter(tuple(r) for r in df.select("doc_id", "text", "source", "kept").collect())


def in_sql(spark, table, statement):
    """Rows of a statement over the stage's input, one per input row."""
    docs, folder = table
    con = duckdb.connect()
    frame = docs.toPandas()
    frame["row"] = range(len(frame))
    frame["doc_id_"], frame["doc_id"] = frame["doc_id"], frame["row"]
    con.register("frame", frame)
    con.sql("CREATE TABLE documents AS SELECT * FROM frame")
    con.sql(f"CREATE VIEW benchmark AS SELECT * FROM read_parquet('{folder}/benchmark.parquet/*.parquet')")
    found = {r[0]: r for r in con.sql(f"SELECT * FROM ({statement}) ORDER BY doc_id").fetchall()}
    names = [d[0] for d in con.sql(f"SELECT * FROM ({statement}) LIMIT 0").description]
    return [(r, dict(zip(names, found[k]))) for k, r in enumerate(docs.collect())]


def key(r):
    return (r.doc_id, r.text, r.source, r.kept)


def test_quality_rules(spark, table):
    want = Counter(key(r) for r, v in in_sql(spark, table, oracle.HOST_QUALITY) if v["kept"])
    out = STAGE["quality rules"](spark, table[0], table[1])
    assert keyed(out) == want and out.columns == table[0].columns
    assert 0 < sum(want.values()) < table[0].count()


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def test_near_copies(spark, table):
    rows = table[0].collect()
    sets, root = [shingles(r.text) for r in rows], list(range(len(rows)))
    for _ in rows:
        for a, x in enumerate(sets):
            for b, y in enumerate(sets[:a]):
                if x and y and 100 * len(x & y) >= 80 * len(x | y):
                    root[a] = root[b] = min(root[a], root[b])
    groups = defaultdict(list)
    for k, r in enumerate(rows):
        groups[root[k]].append(r)
    out = Counter(key(r) for r in STAGE["n-gram Jaccard join"](spark, *table).collect())
    for k, members in groups.items():
        if not sets[k]:
            continue
        kept = [m for m in set(map(key, members)) if out[m]]
        least = min((m[0] is None, m[0] or 0) for m in map(key, members))
        assert len(kept) == 1 and out[kept[0]] == 1 and (kept[0][0] is None, kept[0][0] or 0) == least
    wordless = Counter(key(r) for r, s in zip(rows, sets) if not s)
    assert Counter({k: n for k, n in out.items() if not shingles(k[1])}) == wordless
    assert sum(out.values()) < len(rows)


def test_benchmark_decontamination(spark, table):
    want = Counter(key(r) for r, v in in_sql(spark, table, oracle.BENCHMARK_LEAKS) if not v["contaminated"])
    out = STAGE["benchmark decontamination"](spark, *table)
    assert keyed(out) == want and out.columns == table[0].columns
    assert sum(want.values()) < table[0].count()


def test_mixing(spark, table):
    docs, folder = table
    out = STAGE["mixing sources"](spark, docs, folder)
    got, rows = keyed(out), Counter(key(r) for r in docs.collect())
    size = {k: len(re.findall(r"[^\x20\x09-\x0d]+", k[1] or "")) for k in rows}
    sources = sorted({k[2] for k in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(size[k] * n for k, n in rows.items() if k[2] == s) for s in sources}
    weight, target, left = {s: i % 3 + 1 for i, s in enumerate(sources)}, {}, sum(total.values())
    while open_ := [s for s in sources if s not in target]:  # clamp and share again
        level = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if level * weight[s] > 3 * total[s]]
        for s in full:
            target[s] = 3 * total[s]
            left -= target[s]
        if not full:
            target |= {s: level * weight[s] for s in open_}
    for s in sources:
        ratio = target[s] / total[s]
        repeats = {k: got[k] / n for k, n in rows.items() if k[2] == s and size[k]}
        # A source taken r times has each text floor(r) or one more time, three at most.
        assert all(int(ratio) <= x <= min(3, int(ratio) + 1) for x in repeats.values())
        words = sum(size[k] * got[k] for k in repeats)
        longest = max(size[k] for k in repeats)
        assert target[s] - 1 <= words <= target[s] + longest + len(repeats) * (ratio % 1 == 0)
    assert all(got[k] == n for k, n in rows.items() if not size[k]) and out.columns == docs.columns
    assert keyed(STAGE["mixing sources"](spark, docs, folder)) == got


def test_sharding(spark, table):
    docs, folder = table
    rows = STAGE["sharding"](spark, docs, folder).collect()
    want = Counter((r.doc_id, r.source, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert Counter((r.doc_id, r.source, r["size"], r.text_crc32) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert set(slots) <= set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {r.law for r in rows} == {"bytes"}


def test_whole_run_and_empty_table(spark, table, tmp_path):
    docs, folder = table
    sf = str(tmp_path / "sf")
    docs.select(*COLUMNS).write.parquet(f"{sf}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{sf}/benchmark.parquet")
    whole = corpus_pipeline.run(spark, sf)
    step = docs.select(*COLUMNS)
    for name, stage in corpus_pipeline.STAGES:
        step = stage(spark, step, sf)
        if name != "sharding":
            assert step.columns == COLUMNS
            path = str(tmp_path / name.replace(" ", "-"))
            step.write.parquet(path)
            step = spark.read.parquet(path)
    drop = lambda df: Counter((r.doc_id, r.source, r["size"], r.text_crc32) for r in df.collect())
    assert drop(whole) == drop(step) and sum(drop(whole).values()) > 20
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.select(*COLUMNS).limit(0), sf).collect() == [], name
