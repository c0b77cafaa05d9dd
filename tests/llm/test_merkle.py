"""Hash trees against a plain tree in Python, for several shapes and odd rows."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from slantwise.llm.merkle import merkle_manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, idx long, load string"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return digest(*("-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in FIELDS))


def build(leaves, fanout):
    """Root, and for each leaf its siblings left and right per level."""
    level, at, paths = leaves, list(range(len(leaves))), [[] for _ in leaves]
    while len(level) > 1:
        runs = [level[k : k + fanout] for k in range(0, len(level), fanout)]
        for k, place in enumerate(at):
            run, slot = runs[place // fanout], place % fanout
            paths[k].append(("".join(run[:slot]), "".join(run[slot + 1 :])))
            at[k] = place // fanout
        level = [digest(*run) for run in runs]
    return level[0], paths


def expected(rows, fanout, found):
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    built = {}
    for name in names:
        groups[name].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        built[name] = build([leaf_of(r) for r in groups[name]], fanout)
    root, over = build([built[name][0] for name in names], fanout)
    want = Counter()
    for name, above in zip(names, over):
        for row, path in zip(groups[name], built[name][1]):
            path, leaf = path + above, leaf_of(row)
            folded = leaf_of(row | {"text": found(row["text"])})
            for left, right in path:
                folded = digest(left, folded, right)
            want[row["doc_id"], leaf, built[name][0], root, digest(*(a + b for a, b in path)), folded, folded == root] += 1
    return want


def got(df, fanout):
    found = merkle_manifest(df, fanout=fanout, found={"text": F.lower("text")})
    return Counter(tuple(r) for r in found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect())


ODD = [(None, None, None, None, None), (None, "", None, "s", 0), (3, "Éa", "", None, -5), (3, "éA", "", None, -5), (4, "x" * 300_000, "en", "s", 1), (4, "same", "en", "s", 1), (4, "same", "en", "s", 1)]


@pytest.mark.parametrize("fanout,size", [(8, 70), (2, 9), (3, 28)])
def test_proofs_of_every_row(spark, fanout, size):
    rows = [(k, f"Text {k}", "de" if k % 3 else "fr", "s", k) for k in range(100, 100 + size)] + ODD
    data = [(i, t, g, s, n, "clash", 1, "clash") for i, t, g, s, n in rows]
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    plain = [dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r)) for r in rows]
    assert got(df, fanout) == expected(plain, fanout, lambda t: None if t is None else t.lower())


def test_one_row_and_no_row(spark):
    df = spark.createDataFrame([(1, "A", "en", "s", 1, "", 1, "")], SCHEMA)
    row = merkle_manifest(df).first()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.verified and row.proof == []
    assert row.proof_sha256 == digest("")
    assert merkle_manifest(df.limit(0)).collect() == []
