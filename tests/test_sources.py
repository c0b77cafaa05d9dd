import pytest
from pyspark.sql import functions as F

from slantwise import constants as K
from slantwise.operators import labels as lb
from slantwise.sinks import writers as wr
from slantwise.sources import documents as sd
from slantwise.sources import label_files as lf


def write(path, text, mode="w", **kw):
    with open(path, mode, **kw) as out:
        out.write(text)
    return str(path)


LINES = [
    '{"doc_id": "1", "text": "one", "extra": 5, "subset_meta": {"region": "north", "synthetic": true}}',
    "  ",
    "not json",
    '{"doc_id": "2"}',
    "[1, 2]",
    '{"doc_id": "3", "text": null}',
    '{"doc_id": "4", "text": "x"} trailing',
    '{"doc_id": "5", "doc_id": "6", "text": "x"}',
    '   {"doc_id": 7, "text": "seven", "title": "t", "date": "2024-01-02"}  ',
]


def test_jsonl_skips_what_is_not_a_document(spark, tmp_path):
    path = write(tmp_path / "a.jsonl", "\n".join(LINES), encoding="utf-8")
    rows = {r.doc_id: r for r in sd.read_jsonl(spark, path).withColumn(
        "region", F.try_variant_get("subset_meta", "$.region", "string")).withColumn(
        "extra", F.try_variant_get("record", "$.extra", "int")).collect()}
    assert set(rows) == {"1", "3", "7"}
    assert rows["1"].region == "north" and rows["1"].extra == 5
    assert rows["3"].text is None and rows["7"].title == "t"


def test_jsonl_dir(spark, tmp_path):
    write(tmp_path / "b.jsonl", '{"doc_id": "b", "text": "x"}\n')
    write(tmp_path / "a.jsonl", '{"doc_id": "a", "text": "y"}\n')
    write(tmp_path / "c.json", '{"doc_id": "c", "text": "z"}\n')
    got = sd.read_jsonl_dir(spark, str(tmp_path)).orderBy("file_name").collect()
    assert [(r.file_name, r.doc_id) for r in got] == [("a.jsonl", "a"), ("b.jsonl", "b")]
    empty = tmp_path / "empty"
    empty.mkdir()
    assert sd.read_jsonl_dir(spark, str(empty)).count() == 0


def test_txt_and_html_dirs(spark, tmp_path):
    write(tmp_path / "one.txt", b"a\r\nb\rc \xff end", mode="wb")
    write(tmp_path / "two.html", "<title>T</title><p>body</p>")
    row = sd.read_txt_dir(spark, str(tmp_path), "me").first()
    assert (row.doc_id, row.text, row.source, row.title) == ("one", "a\nb\nc � end", "me", "")
    page = sd.read_html_dir(spark, str(tmp_path)).first()
    assert (page.doc_id, page.title, page.text) == ("two", "T", "T body")


def test_source_labels(spark, tmp_path):
    path = write(tmp_path / "s.csv", "outlet_name,label\nAlpha,Left\nbeta,right\nALPHA,center\n")
    assert {tuple(r) for r in lf.read_source_labels(spark, path).collect()} == {("alpha", "center"), ("beta", "right")}
    assert lf.read_source_labels(spark, str(tmp_path / "none.csv")).count() == 0
    with pytest.raises(ValueError, match="invalid"):
        lf.read_source_labels(spark, write(tmp_path / "bad.csv", "outlet_name,label\na,up\n"))
    with pytest.raises(ValueError, match="invalid"):
        lf.read_source_labels(spark, write(tmp_path / "blank.csv", "outlet_name,label\na,\n"))
    with pytest.raises(ValueError, match="columns"):
        lf.read_source_labels(spark, write(tmp_path / "cols.csv", "name,label\na,left\n"))


def test_human_labels_and_template_round_trip(spark, tmp_path):
    docs = spark.createDataFrame([(i, "t") for i in range(6)], "doc_id long, text string")
    known = spark.createDataFrame([(0, "left")], "doc_id long, label string")
    path = str(tmp_path / "sheet")
    wr.write_label_template(wr.label_template(docs, known), path)
    assert lf.read_human_labels(spark, path, "bigint").count() == 0
    text = "".join(r.value + "\n" for r in spark.read.text(path).collect())
    assert text.startswith("# How to fill in this sheet") and "doc_id,label,confidence,notes" in text
    filled = write(tmp_path / "filled.csv", "# c\ndoc_id,label,confidence,notes\n1,left,,\n2,,,\n1,RIGHT,high,ok\n")
    assert [tuple(r) for r in lf.read_human_labels(spark, filled, "bigint").collect()] == [(1, "right")]


def test_label_tiers(spark):
    docs = spark.createDataFrame(
        [(1, "Alpha"), (2, "beta"), (3, "none"), (4, None)], "doc_id long, source string"
    )
    by_source = spark.createDataFrame([("alpha", "left"), ("beta", "center")], "outlet_name string, label string")
    by_doc = spark.createDataFrame([("2", "right"), ("3", "left")], "doc_id string, label string")
    labeled = lb.assign_labels(docs, by_source, by_doc)
    assert {r.doc_id: r.label for r in labeled.collect()} == {1: "left", 2: "right", 3: "left", 4: None}
    counts = lb.label_tier_counts(lb.label_tiers(docs, by_source, by_doc)).first()
    assert (counts.documents, counts.tier1, counts.tier2, counts.labeled, counts.unlabeled) == (4, 2, 2, 3, 1)
    assert counts.tier1_percent == 50.0
    assert {r.label for r in lb.assign_labels(docs, None, None).collect()} == {None}
    assert {r.label for r in lb.assign_source_labels(docs.drop("source"), by_source).collect()} == {None}
    codes = {r.label: r.label_int for r in lb.encode_labels(labeled).collect()}
    assert codes == {"left": 0, "right": 2, None: None}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, "left", "train", 'a "q"\n b '), (2, None, None, "x,y")], "doc_id long, label string, split string, text string"
    )
    wr.write_splits(df, str(tmp_path / "s"))
    back = sd.read_split(spark, str(tmp_path / "s"))
    assert {(r.doc_id, r.split, r.label_int) for r in back.collect()} == {(1, "train", 0), (2, "unlabeled", None)}
    assert sd.read_split(spark, str(tmp_path / "s"), "train").count() == 1
    wr.write_csv(df, str(tmp_path / "c"))
    csv = spark.read.schema(df.schema).options(header=True, multiLine=True, quote='"', escape='"').csv(str(tmp_path / "c"))
    assert {r.text for r in csv.collect()} == {'a "q"\n b ', "x,y"}
    wr.write_jsonl(df, str(tmp_path / "j"))
    assert {tuple(r) for r in spark.read.schema(df.schema).json(str(tmp_path / "j")).collect()} == {
        tuple(r) for r in df.collect()
    }


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "doc_id long, a string")
    b = spark.createDataFrame([(2, "y")], "doc_id long, b string")
    assert {tuple(r) for r in sd.union_documents(a, b).select("doc_id", "a", "b").collect()} == {
        (1, "x", None),
        (2, None, "y"),
    }
