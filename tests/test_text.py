import unicodedata

import pytest
from pyspark.sql import functions as F

from slantwise import constants as K
from slantwise.functions import text as tx
from slantwise.functions.arrays import contiguous_ngrams, value_counts
from slantwise.operators import prep


def apply(spark, texts, function):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [r[0] for r in df.select("i", function(F.col("text")).alias("x")).orderBy("i").select("x").collect()]


def test_hash_ignores_case_and_whitespace_only(spark):
    a, b, c, d = apply(spark, ["Hello  World", "hello world ", "hello world", "hello worlds"], tx.text_hash)
    assert a == b == c != d
    assert len(a) == 64


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("  a \t b  c \n", "a b c"),
        ("see https://x.org/a?b=c now", "see now"),
        ("“quoted” ‘it’s’", "\"quoted\" 'it's'"),
        ("wide—dash and–small", "wide -- dash and - small"),
        ("link https://x.org/a–b end", "link - b end"),
        ("write to <me@x.org>, please", "write to please"),
        ("@nobody.here stays", "@nobody.here stays"),
        ("a@b has no dot", "a@b has no dot"),
        ("text Subscribe to our newsletter today\nnext", "text next"),
        ("x Click here to read more\rstill\ny", "x y"),
        ("an ADVERTISEMENT \n inside", "an inside"),
        ("Copyright 2024 by us\nCopyright 20 kept", "Copyright 20 kept"),
        ("share this article advertisement\njoined", ""),
        ("All Rights Reserved. More", ""),
        ("café", "café"),
        ("Å", "Å"),
        ("", ""),
        ("   ", ""),
    ],
)
def test_normalize(spark, raw, clean):
    assert apply(spark, [raw], tx.normalize_text) == [clean]


def test_normalize_null(spark):
    assert apply(spark, [None, "a"], tx.normalize_text) == [None, "a"]


def test_characters_kept_from_python_are_stable_under_composition():
    second = set()
    for point in range(0x110000):
        parts = unicodedata.decomposition(chr(point)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            second.add(int(parts[1], 16))
    for low, high in ((0x0, 0x2FF), (0x2002, 0x2064)):
        for point in range(low, high + 1):
            char = chr(point)
            assert unicodedata.normalize("NFC", char) == char
            assert unicodedata.combining(char) == 0
            assert point not in second


def test_tokens_and_ngrams(spark):
    got = apply(spark, ["The Cat, a déjà vu x_1 sat."], lambda c: tx.ngrams(c, (1, 2)))[0]
    assert got == ["cat", "déjà", "vu", "x_1", "sat", "cat déjà", "déjà vu", "vu x_1", "x_1 sat"]
    assert apply(spark, ["", "a", None], tx.ngrams) == [[], [], None]
    assert apply(spark, ["It's  state-of-the-art: 100%!"], tx.simple_tokens)[0] == ["it's", "state-of-the-art", "100"]


def test_value_counts(spark):
    df = spark.createDataFrame([(["b", "a", "b", "c", "b"],), ([],)], "x array<string>")
    got = [[tuple(s) for s in r[0]] for r in df.select(value_counts(F.col("x"))).collect()]
    assert got == [[("a", 1), ("b", 3), ("c", 1)], []]


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_ngrams_of_any_size(spark, n):
    words = ["w%d" % i for i in range(5)]
    df = spark.createDataFrame([(words,)], "x array<string>")
    got = df.select(contiguous_ngrams(F.col("x"), 1, n)).first()[0]
    expected = [" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]
    assert got == expected


def test_language(spark):
    texts = [
        "the house of the king and the queen",
        "le chat est dans la maison pour une nuit",
        "der Hund und die Katze ist nicht auf dem Tisch",
        "el perro y los gatos por la casa del rey",
        "12345 ###",
        "",
    ]
    assert apply(spark, texts, tx.detect_language) == ["en", "fr", "de", "es", "unknown", "unknown"]
    late = "x " * 500 + "the of and to"
    assert apply(spark, [late], tx.detect_language) == ["en"]
    assert apply(spark, [late], lambda t: tx.detect_language(t, sample_chars=1000)) == ["unknown"]


def test_length_filter_is_inclusive(spark):
    texts = ["a" * n for n in (49, 50, 70, 100, 101)] + [None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    assert sorted(r.doc_id for r in prep.filter_length(df, 50, 100).collect()) == [1, 2, 3]


def test_dedup_keeps_first_and_limits_on_the_map_side(spark):
    rows = [(3, "Same text"), (1, "same  TEXT"), (2, "other")] + [(i, "hot copy") for i in range(100, 400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = prep.deduplicate(df)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 100]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_preprocess_options(spark):
    long_en = "the cat and the dog of the house is on the table for the king "
    rows = [(1, long_en), (2, long_en.upper()), (3, "le chat est dans la maison pour une nuit " * 2), (4, "short")]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    assert [r.doc_id for r in prep.preprocess(df).collect()] == [1]
    assert sorted(r.doc_id for r in prep.preprocess(df, language=None).collect()) == [1, 3]
    assert sorted(r.doc_id for r in prep.preprocess(df, dedup=False).collect()) == [1, 2]


def test_entities_and_html(spark):
    html = (
        "<!DOCTYPE html><html><head><title> T &amp; U </title><style>p{}</style></head><body><!-- no -->"
        "<nav>menu</nav><p>a&nbsp;&lt;b&gt; &#233;&#x4E2D;</p><p>one<b>two</b>\n three </p>"
        "<script>var x='</p>';</script><footer>f</footer></body></html>"
    )
    df = spark.createDataFrame([(1, html)], "page_id int, html string")
    from slantwise.sources.documents import html_documents

    row = html_documents(df).first()
    assert row.title == "T & U"
    assert row.text == "T & U a <b> é中 one two three"


def test_references_are_decoded_once(spark):
    cases = {
        "&#38;lt;b": "&lt;b",
        "&amp;amp; &lt;": "&amp; <",
        "&#9999999; &#0; &#xD800;": "\ufffd \ufffd \ufffd",
        "&#128; &#x41; &#99999999999999999999999999;": "\u20ac A \ufffd",
        "&nosuch; & &copy 1": "&nosuch; & \u00a9 1",
        "&Aacute;&hearts;": "\u00c1\u2665",
        "": "",
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r.t: r.d for r in df.select("t", tx.decode_entities(F.col("t")).alias("d")).collect()}
    assert got == cases


def test_open_subtree_reaches_to_the_end(spark):
    df = spark.createDataFrame([("<p>a</p><script>var x = 1",)], "t string")
    assert df.select(tx.html_text(tx.drop_subtrees(F.col("t")))).first()[0] == "a"


def test_language_of_the_whole_text(spark):
    text = "the " + "x " * 2000 + "le la les des"
    row = spark.createDataFrame([(text,)], "t string").select(
        tx.detect_language(F.col("t")), tx.detect_language(F.col("t"), sample_chars=100)
    ).first()
    assert tuple(row) == ("fr", "en")
