"""Secret scans against Python: base spans, linked spans, and many matches in one text."""

import hashlib
import random
import re
import time
from collections import Counter

from pyspark.sql import functions as F

from slantwise.functions.arrays import running
from slantwise.llm import secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)


def base_spans(text):
    kinds = [("assign", [m.span() for m in ASSIGN.finditer(text) if len(m[2]) >= 12])]
    kinds.append(("access", [m.span() for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]))
    kinds.append(("hex", [m.span() for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]))
    return [(a, rank, b) for rank, (_, found) in enumerate(kinds) for a, b in found]


def weak_spans(text):
    return [(m.start(), secrets.KINDS.index(kind), m.end()) for kind, pattern in secrets.WEAK for m in re.finditer(pattern, text)]


def linked(base, weak, scope):
    def near(part, names):
        ranks = {secrets.KINDS.index(n) for n in names}
        return any(p is not part and p[1] in ranks and (p < part and part[0] - p[2] <= scope or p > part and p[0] - part[2] <= scope) for p in base + weak)

    out = []
    for part in weak:
        by_id, by_key = near(part, ("access", "identifier")), near(part, ("assign", "hex", "key"))
        needs = {"identifier": by_key, "key": by_id, "endpoint": by_id and by_key}
        out += [part] * needs[secrets.KINDS[part[1]]]
    return out


def spelled(spans):
    return ",".join(f"{secrets.KINDS[rank]}:{a}:{b}" for a, rank, b in sorted(spans))


def test_spans_match_brute_force(spark):
    rng = random.Random(5)
    bits = ["AKIA" + "Z9" * 9, "deadbeef" * 3, "Ab1" + "xY9/" * 9 + "q", "user_id=someone77", "https://host.example/x", "token: abcdefghijkl",
            "api_key='short'", "word", "é" * 30, "." * 260, "\n", "password = \"long.enough.value\"", "0123456789abcde"]
    texts = [None, "", "nothing here"] + [" ".join(rng.choice(bits) for _ in range(rng.randint(1, 14))) for _ in range(150)]
    data = [(k, t, "clash", "clash", "clash") for k, t in enumerate(texts)]
    df = spark.createDataFrame(data, "doc_id long, text string, _hex string, _all string, spans string").repartition(4)
    rows = secrets.find_secrets(df).collect()
    assert Counter(r.doc_id for r in rows) == Counter(range(len(texts)))
    some = 0
    for r in rows:
        base, weak = base_spans(r.text or ""), weak_spans(r.text or "")
        found = linked(base, weak, secrets.SCOPE)
        some += bool(found)
        counts = Counter(rank for _, rank, _ in base)
        assert (r.n_assign, r.n_access, r.n_hex) == (counts[0], counts[1], counts[2])
        assert r.base_sha256 == hashlib.sha256(spelled(base).encode()).hexdigest()
        assert r.spans == spelled(base + found), r.text
        assert r["_hex"] == r["_all"] == "clash"
    assert 20 < some < 140


def test_running_sums_of_any_length(spark):
    df = spark.range(70).select(F.col("id"), F.expr("transform(sequence(1, id + 1), x -> cast(x as int))").alias("v"))
    df = df.withColumn("v", F.filter("v", lambda x: x <= F.col("id")))
    got = df.select("id", running(F.col("v"), "int", F.lit(0), lambda a, b: a + b).alias("s")).collect()
    assert all(r.s == [k * (k + 1) // 2 for k in range(r.id)] for r in got)


def test_many_matches_in_one_text(spark):
    text = " ".join(f"{k:018x}" for k in range(40_000)) + " user_id=someone77"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    query = secrets.find_secrets(df)
    began = time.time()
    row = query.first()
    took = time.time() - began
    assert row.n_hex == 40_000 and row.spans.endswith(f"hex:{19 * 39_999}:{19 * 40_000 - 1},identifier:{19 * 40_000}:{len(text)}")
    assert took < 5
