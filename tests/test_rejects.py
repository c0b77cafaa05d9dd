"""No input record disappears uncounted: JSON quarantine, very large records, label files as CSV has them."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from slantwise.sinks import writers as wr
from slantwise.sources import documents as sd
from slantwise.sources import label_files as lf

BAD = {
    "not json": "not one object",
    '{"doc_id": "2"}': "missing field: text",
    "{}": "missing field: doc_id, text",
    "[1, 2]": "not one object",
    '{"doc_id": "4", "text": "x"} trailing': "not one object",
    '{"doc_id": "5", "doc_id": "6", "text": "x"}': "malformed",
    '{"doc_id": "7", "text": }': "malformed",
}
GOOD = ['{"doc_id": "1", "text": "one"}', '  {"text": "b", "doc_id": 3}  ', '{"doc_id": "e", "text": ""}']


def test_every_line_is_a_document_a_reject_or_blank(spark, tmp_path):
    lines = [*GOOD[:1], *BAD, "   ", "", *GOOD[1:]]
    (tmp_path / "a.jsonl").write_text("\n".join(lines))
    (tmp_path / "b.jsonl").write_text("broken\n")
    docs = sd.read_jsonl_dir(spark, str(tmp_path))
    rejects = sd.read_jsonl_rejects(spark, str(tmp_path), "*.jsonl")
    assert sorted(r.doc_id for r in docs.collect()) == ["1", "3", "e"]
    rows = rejects.orderBy("file_name", "block", "place").collect()
    assert [(r.file_name, r.line, r.reason) for r in rows] == [("a.jsonl", *x) for x in BAD.items()] + [("b.jsonl", "broken", "not one object")]


def test_records_past_the_variant_limit_stay(spark, monkeypatch):
    text = "x" * (17 << 20)
    big = f'{{"doc_id": "big", "text": "{text}", "title": "t", "extra": [1]}}'
    df = spark.createDataFrame([(GOOD[0],), (big,), (big + "]",), (big.replace('"text"', '"tekst"'),)], "value string")
    docs = sd.parse_json_lines(df).select("doc_id", F.length("text").alias("n"), "title").collect()
    assert Counter(map(tuple, docs)) == Counter([("1", 3, None), ("big", len(text), "t")])
    assert Counter(r.reason for r in sd.rejected_json_lines(df).collect()) == Counter(["not one object", "missing field: text"])


def csv_file(folder, name, text):
    (folder / name).write_text(text, encoding="utf-8")
    return str(folder / name)


def test_labels_as_csv_has_them(spark, tmp_path):
    text = (
        '﻿# a note, with commas\n\n"label","outlet_name"\n'
        'left,"Daily\nNews"\nRight,"say ""hi"", all"\n# not a note,#hash\nleft,#hash\nlabel,outlet_name\ncenter,plain\nleft,plain\n'
    )
    path = csv_file(tmp_path, "a.csv", text.replace("# not a note,#hash\n", "").replace("label,outlet_name\n", ""))
    got = {r.outlet_name: r.label for r in lf.read_source_labels(spark, path).collect()}
    assert got == {"daily\nnews": "left", 'say "hi", all': "right", "#hash": "left", "plain": "left"}
    with pytest.raises(ValueError, match="invalid labels"):  # a repeated header is a row
        lf.read_source_labels(spark, csv_file(tmp_path, "b.csv", "outlet_name,label\na,left\noutlet_name,label\n"))
    marked = csv_file(tmp_path, "d.csv", '﻿"outlet_name",label\na,left\n')
    assert [tuple(r) for r in lf.read_source_labels(spark, marked).collect()] == [("a", "left")]
    with pytest.raises(ValueError, match="must have the columns"):
        lf.read_source_labels(spark, csv_file(tmp_path, "c.csv", "outlet,label\na,left\n"))


def test_files_of_a_folder(spark, tmp_path):
    folder = tmp_path / "labels"
    folder.mkdir()
    csv_file(folder, "a.csv", "doc_id,label,notes\n1,left,x\n2,right,\n3,,\n")
    csv_file(folder, "b.csv", "# note\ndoc_id,label,notes\n2,center,\"two\nlines\"\n")
    got = {r.doc_id: r.label for r in lf.read_human_labels(spark, str(folder), "long").collect()}
    assert got == {1: "left", 2: "center"}
    csv_file(folder, "c.csv", "label,doc_id\nleft,4\n")
    with pytest.raises(ValueError, match="different headers"):
        lf.read_human_labels(spark, str(folder))


def test_written_labels_come_back(spark, tmp_path):
    rows = [("a\nb", "left"), ("#x", "right"), ('q"q', "center"), (" s ", "left"), ("c,d", "right")]
    path = str(tmp_path / "out")
    wr.write_csv(spark.createDataFrame(rows, "outlet_name string, label string").repartition(3), path)
    assert sorted((r.outlet_name, r.label) for r in lf.read_source_labels(spark, path).collect()) == sorted(rows)
