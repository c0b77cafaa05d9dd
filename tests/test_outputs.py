"""Stored outputs: report sections, JSON values, label sheets, and the scored stream."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from slantwise.functions import scores as sc
from slantwise.functions import textfiles
from slantwise.operators import reports as rp
from slantwise.operators.training import LinearModel
from slantwise.plans import flows
from slantwise.sinks import writers as wr
from slantwise.sources import documents
from slantwise.sources.documents import read_txt_dir
from slantwise.sources.label_files import read_human_labels
from slantwise.streaming.score_stream import read_scored_stream, score_stream


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(k, "a" if k < 6 else "b" if k < 9 else None, 0.2, 0.3, 0.5) if k % 2 else (k, "a" if k < 6 else "b", 0.6, 0.3, 0.1) for k in range(11)]
    df = spark.createDataFrame(rows, "doc_id long, source string, prob_left double, prob_center double, prob_right double")
    probs = sc.probabilities()
    return df.withColumn("pred_label", sc.argmax_label(probs)).withColumn("polarity_score", sc.signed_score(probs))


@pytest.mark.parametrize("k", [1, 4, 100])
def test_report_keeps_its_sections(spark, scored, tmp_path, k):
    path = str(tmp_path / "report")
    rp.write_report(rp.report_sections(scored, ("source", "missing"), k), path)
    stored = rp.read_report(spark, path)
    parts = {name: stored.where(F.col("section") == name) for name in rp.SECTIONS}
    plain = flows.report(scored, ("source", "missing"), k)
    for name, want in zip(rp.SECTIONS, (plain.groups, plain.suppressed, plain.summary)):
        assert Counter(map(tuple, parts[name].select(want.columns).collect())) == Counter(map(tuple, want.collect()))
    assert {r.k for r in stored.collect()} <= {k}
    sizes = {"a": 6, "b": 4, "unknown": 1}
    lines = {(r.section, r.group_name, r.line_no): r.line for r in rp.section_lines(stored).collect()}
    for name, n in sizes.items():
        if n >= k:
            assert lines["groups", name, 0] == f"{name} | {n} documents"
        else:
            assert lines["suppressed_groups", name, 0] == f"{name} | not shown: Group size ({n}) < k-anonymity threshold ({k})"
    shown = sum(n >= k for n in sizes.values())
    assert (("summary", None, 0) in lines) == (shown > 0)
    if shown:
        assert lines["summary", None, 0].startswith(f"source | {shown} groups shown, {3 - shown} not shown, means from ")


def test_masked_sizes_stay_out_of_the_file(scored, tmp_path):
    rp.write_report(rp.report_sections(scored, ["source"], 5, mask_sizes=True), str(tmp_path / "r"))
    rows = [json.loads(line) for f in (tmp_path / "r").glob("part*") for line in f.read_text().splitlines()]
    hidden = [r for r in rows if r["section"] == "suppressed_groups"]
    assert len(hidden) == 2 and all("size" not in r for r in hidden)


def test_json_values_keep_their_types(spark, tmp_path):
    meta = '{"n":1,"x":1.5,"yes":true,"none":null,"list":[1,"a",{"b":false}],"text":"é\\"q"}'
    df = spark.createDataFrame([(1, meta), (2, None), (3, "[]")], "doc_id int, meta string").withColumn("meta", F.try_parse_json("meta"))
    wr.write_jsonl(df, str(tmp_path / "j"))
    rows = {r["doc_id"]: r["meta"] for f in (tmp_path / "j").glob("part*") for r in map(json.loads, f.read_text().splitlines())}
    assert rows == {1: json.loads(meta), 2: None, 3: []}


def test_sheet_without_rows_has_its_header(spark, tmp_path):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    path = str(tmp_path / "sheet")
    wr.write_label_template(wr.label_template(docs, docs.select("doc_id")), path)
    lines = [line for f in (tmp_path / "sheet").glob("part*") for line in f.read_text().splitlines()]
    assert lines[-1] == "doc_id,label,confidence,notes" and all(line.startswith("#") for line in lines[:-1]) and len(lines) > 1
    assert read_human_labels(spark, path, "long").count() == 0


def test_stream_keeps_rows_that_share_or_lack_an_id(spark, tmp_path):
    vocab = spark.createDataFrame([("tax", 0, 1.0), ("school", 1, 2.0)], "term string, idx int, idf double")
    weights = spark.createDataFrame([("tax", 2, 1.0), ("school", 0, 1.5)], "term string, class_idx int, coef double")
    model = LinearModel(vocab, weights, spark.createDataFrame([(0, 0.1)], "class_idx int, intercept double"), rows=2)
    rows = [("1", "tax"), ("1", "school"), (None, "tax"), (None, "school tax"), (None, "tax"), ("2", "")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    incoming, out, log = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "log")
    options = {"ignoreNullFields": "false"}

    def send(df):
        df.coalesce(1).select(F.to_json(F.struct("doc_id", "text"), options).alias("value")).write.mode("append").text(incoming)
        score_stream(spark, incoming, out, log, model).awaitTermination()

    def seen(df):
        return Counter((r.doc_id, r.text, round(r.polarity_score, 9)) for r in df.collect())

    send(docs)
    assert seen(read_scored_stream(spark, out)) == seen(flows.score(docs, model)) and read_scored_stream(spark, out).count() == 6
    send(spark.createDataFrame([("2", "tax"), (None, "tax")], docs.schema))
    now = [r for r in rows if r[0] != "2"] + [("2", "tax"), (None, "tax")]
    assert seen(read_scored_stream(spark, out)) == seen(flows.score(spark.createDataFrame(now, docs.schema), model))


def test_text_files_stand_in_few_folders_and_are_told_apart(spark, tmp_path):
    rows = [(7 * k - 3000, f"text {k}" if k % 50 else None) for k in range(2500)] + [(None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    path = tmp_path / "txt"
    names = wr.write_txt_files(docs, str(path))
    assert len(list(path.glob("*/*.txt"))) == len(rows) and len(list(path.glob("folder=*"))) <= 3
    files = read_txt_dir(spark, str(path), recursive=True).select("text", *wr.txt_file_place(F.col("path")))
    got = names.join(files, ["folder", "place"]).select("doc_id", "text")
    assert Counter(tuple(r) for r in got.collect()) == Counter((i, f"{t or ''}\n") for i, t in rows)


def test_a_tree_of_files_is_read_as_spark_reads_it(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(textfiles, "CHUNK_FILES", 2)
    monkeypatch.setattr(textfiles, "BATCH_BYTES", 5)
    for name, content in {"a.txt": b"one\r\ntwo", "b c%20.txt": b" ", "empty.txt": b"", "d=1/e.txt": b"\xff?", "d=1/.f.txt": b"no", "_g/h.txt": b"no", "i/j/k.txt": b"deep", "i/l.md": b"no", "i/\xe9.txt": "\xe9".encode()}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(content)
    rows = {(r.doc_id, r.text, r.path) for r in read_txt_dir(spark, str(tmp_path), recursive=True).collect()}
    monkeypatch.setattr(documents, "local_folder", lambda spark, path: None)
    scan = read_txt_dir(spark, str(tmp_path), recursive=True)
    assert {(r.doc_id, r.text, r.path) for r in scan.collect()} == rows and len(rows) == 5


def test_files_of_rows_that_share_an_id_and_of_null_text(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (3, "")], "doc_id long, text string")
    names = wr.write_txt_files(docs, str(tmp_path / "txt"))
    files = read_txt_dir(spark, str(tmp_path / "txt"), recursive=True).select("text", *wr.txt_file_place(F.col("path")))
    got = [(r.doc_id, r.text) for r in names.join(files, ["folder", "place"]).collect()]
    assert sorted(got) == [(1, "a\n"), (1, "b\n"), (2, "\n"), (3, "\n")]
    assert "BinaryFile" not in files._jdf.queryExecution().toString()
