"""Language profiles: learned, held out, and compared with plain counting."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from slantwise.operators import language as lg
from slantwise.operators import prep

SF = "/root/testdata/sf0.01"


def padded(text):
    out = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    return f" {' '.join(out.split())} " if out.split() else ""


def grams(text):
    s = padded(text)
    return Counter(s[i : i + n] for n in lg.SIZES for i in range(len(s) - n + 1))


def plain_profiles(rows, top):
    counts = {}
    for lang, text in rows:
        if lang is not None:
            counts.setdefault(lang, Counter()).update(grams(text))
    ranked = {lang: sorted(c.items(), key=lambda x: (-x[1], x[0]))[:top] for lang, c in counts.items() if c}
    return {lang: {g: (k + 1, n) for k, (g, n) in enumerate(own)} for lang, own in ranked.items()}


def plain_detect(text, profiles, top):
    own = grams(text)
    scores = {lang: sum(n * (top + 1 - p[g][0]) for g, n in own.items() if g in p) for lang, p in profiles.items()}
    best = max(sorted(scores), key=lambda lang: scores[lang], default=None)
    return best if best is not None and scores[best] > 0 else lg.UNKNOWN


def test_held_out_confusion(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = F.col("doc_id") % 5 == 0
    profiles = lg.learn_profiles(docs.where(~held))
    rows = lg.language_confusion(docs.where(held), profiles).collect()
    for r in sorted(rows):
        print(r["lang"], r["detected"], r["count"])
    total, right = sum(r["count"] for r in rows), sum(r["count"] for r in rows if r["lang"] == r["detected"])
    assert total == docs.where(held).count() and {r["lang"] for r in rows} == {"de", "en", "es", "fr"}
    assert right >= 0.99 * total


@pytest.mark.parametrize("top", [7, 60])
def test_profiles_and_verdicts_match_plain_counting(spark, top):
    rng = random.Random(top)
    sounds = {f"l{k}": [rng.choice("abcdéßñü") + rng.choice("aeiou") for _ in range(5)] for k in range(9)}
    rows = [(lang, " ".join("".join(rng.choices(own, k=3)) for _ in range(rng.randint(0, 30)))) for lang, own in sounds.items() for _ in range(6)]
    rows += [(None, "aa bb"), ("l0", None), ("l1", ""), ("l2", "12 !"), ("l3", "A" * 5000), ("empty", None), ("greek", "\U0001d6d2 αβγ")]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    want = plain_profiles(rows, top)
    table = lg.language_profiles(df, top=top)
    assert {(r.lang, r.gram): (r["rank"], r.n) for r in table.collect()} == {(lang, g): x for lang, p in want.items() for g, x in p.items()}
    profiles = lg.load_profiles(table, top=top)
    assert profiles.languages == tuple(sorted(want))
    got = df.select("text", profiles.detect(F.col("text")).alias("d")).collect()
    assert [r.d for r in got] == [plain_detect(r.text, want, top) for r in got]


def test_filter_uses_the_profiles(spark):
    rows = [("aa", "ta ta ta"), ("bb", "ko ko ko"), ("bb", "ko ko ta")]
    df = spark.createDataFrame(rows, "lang string, text string")
    profiles = lg.learn_profiles(df)
    assert sorted(r.text for r in prep.filter_language(df, "bb", profiles=profiles).collect()) == ["ko ko ko", "ko ko ta"]
    assert prep.filter_language(df, None, profiles=profiles).count() == 3
    nothing = lg.learn_profiles(df.limit(0))
    assert {r.d for r in df.select(nothing.detect(F.col("text")).alias("d")).collect()} == {lg.UNKNOWN}


def test_bounds(spark):
    df = spark.createDataFrame([("a", "x y"), ("b", "z")], "lang string, text string")
    with pytest.raises(ValueError):
        lg.language_profiles(df, sizes=(4,))
    with pytest.raises(ValueError):
        lg.load_profiles(lg.language_profiles(df), max_languages=1)
