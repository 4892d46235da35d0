import warnings

import pytest

from reportlens.operators import models
from reportlens.sources import readers, writers

XML = """<r><a><uId id="R1"/></a><Abstract>
<AbstractText Label="FINDINGS"> first </AbstractText><AbstractText Label="FINDINGS">second &amp; last <b>bold</b> tail</AbstractText>
<AbstractText Label="IMPRESSION">old</AbstractText><AbstractText Label="IMPRESSION"/>
</Abstract><MeSH><major> normal </major><major>x/y</major></MeSH><parentImage id="i1"/><deep><parentImage id="i2"/></deep></r>"""


def test_xml_reports(spark, tmp_path):
    (tmp_path / "1.xml").write_text(XML)
    (tmp_path / "2.xml").write_text(XML[:120])
    (tmp_path / "3.xml").write_text("<r><pmcId id='7'/></r>")
    (tmp_path / "note.txt").write_text("not a report")
    got = {r["filename"]: r for r in readers.scan_xml_reports(spark, str(tmp_path)).collect()}
    assert set(got) == {"1.xml", "3.xml"}
    a, c = got["1.xml"], got["3.xml"]
    assert (a["uid"], a["pmc_id"], a["findings"], a["impression"], a["indication"]) == ("R1", None, "second & last", "", "")
    assert (a["mesh_major"], a["mesh_minor"], a["num_images"], a["image_ids"]) == ("normal|x/y", "", 2, "i1|i2")
    assert (c["uid"], c["pmc_id"], c["findings"], c["num_images"], c["image_ids"]) == (None, "7", "", 0, "")
    bad = readers.quarantine(readers.scan_xml_reports(spark, str(tmp_path), keep_malformed=True)).collect()
    assert [r["filename"] for r in bad] == ["2.xml"]
    assert "line" in bad[0]["error"] and "column" in bad[0]["error"]


def test_xml_encodings_mixed_content_and_errors(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.xml").write_bytes("<?xml version='1.0' encoding='ISO-8859-1'?><r><x><AbstractText Label='FINDINGS'> é <b>c</b> d</AbstractText>"
                                             "</x><MeSH><major> </major><major/><major>m</major></MeSH><MeSH><major>second</major></MeSH></r>".encode("latin-1"))
    (tmp_path / "empty.xml").write_text(" ")
    (tmp_path / "twice.xml").write_text("<r><AbstractText Label='IMPRESSION'>first</AbstractText><AbstractText Label='IMPRESSION'/></r>")
    (tmp_path / "wrong.xml").write_text("<r>\n<a></b></r>")
    got = {r["filename"]: r for r in readers.scan_xml_reports(spark, str(tmp_path), keep_malformed=True).collect()}
    assert (got["a.xml"]["findings"], got["a.xml"]["mesh_major"]) == ("é", "|m")
    assert got["twice.xml"]["impression"] == "" and not got["twice.xml"]["malformed"]
    assert got["empty.xml"]["malformed"] and got["empty.xml"]["findings"] is None
    assert got["wrong.xml"]["error"] == "mismatched tag: line 2, column 5"
    texts = spark.createDataFrame([("<?xml version='1.0' encoding='ISO-8859-1'?><r><uId id='é'/></r>", "t"), (None, "n")], "value string, filename string")
    rows_ = {r["filename"]: r for r in readers.parse_xml_reports(texts).collect()}
    assert rows_["t"]["uid"] == "é" and rows_["n"]["malformed"]


def test_csv_without_line_breaks_can_be_split(spark, tmp_path):
    (tmp_path / "m.csv").write_text("a,b\n1,x\n2,\n")
    assert readers.read_csv(spark, str(tmp_path / "m.csv")).count() == 2
    d = readers.scan_labelled_csv(spark, {"Mass": str(tmp_path / "m.csv")}, "s", multi_line=False)
    assert sorted(r["b"] or "" for r in d.collect()) == ["", "x"]


def test_labelled_csv(spark, tmp_path):
    (tmp_path / "m.csv").write_bytes("﻿ExamID,Findings,EndHere\n1,\"a \"\"q\"\"\nb\",\n".encode())
    (tmp_path / "p.csv").write_text("ExamID,Other\n2,z\n")
    with warnings.catch_warnings(record=True) as w:
        warnings.simplefilter("always")
        d = readers.scan_labelled_csv(spark, {"Mass": str(tmp_path / "m.csv"), "Pneumonia": str(tmp_path / "p.csv"), "None": str(tmp_path / "n.csv")}, "secondary")
    assert any("no file for class None" in str(x.message) for x in w)
    assert d.columns == ["ExamID", "Findings", "condition", "dataset_source", "Other"] or set(d.columns) == {"ExamID", "Findings", "Other", "condition", "dataset_source"}
    got = {r["ExamID"]: r for r in d.collect()}
    assert got["1"]["Findings"] == 'a "q"\nb' and got["1"]["condition"] == "Mass" and got["2"]["Findings"] is None
    with pytest.raises(FileNotFoundError):
        readers.scan_labelled_csv(spark, {"x": str(tmp_path / "none.csv")}, "s")


def test_csv_round_trip_turns_empty_into_null(spark, tmp_path):
    d = spark.createDataFrame([(1, "", " a\n\"b\" "), (2, None, "c")], "id int, x string, y string")
    writers.write_stage(d, str(tmp_path / "t"), "csv")
    got = sorted(tuple(r) for r in readers.read_table(spark, str(tmp_path / "t"), "csv").collect())
    assert got == [("1", None, " a\n\"b\" "), ("2", None, "c")]


def test_metrics_and_model_round_trip(spark, tmp_path):
    m = writers.metrics_table(spark, {"primary": {"lr": {"auc": 0.9, "f1": 0.8}}})
    assert m.count() == 2 and m.columns == ["dataset", "model", "metric", "value"]
    d = models.prepare(spark.createDataFrame([(i, float(i), "ab"[i % 2]) for i in range(20)], "uid int, F01_x double, y string"), ["F01_x"], "y")
    rf = models.forest(trees=3, depth=3).fit(d)
    writers.save_model(rf, str(tmp_path / "m"))
    a = rf.transform(d).select("uid", "prediction").orderBy("uid").collect()
    assert a == writers.load_model(str(tmp_path / "m")).transform(d).select("uid", "prediction").orderBy("uid").collect()


def test_xml_files_are_one_a_document_in_few_folders(spark, tmp_path):
    from catalog.source_queries import xml_files
    rows = [(i, f"line {i}\nand <more> & more" if i % 7 else None, "en", "web", i) for i in range(1, 201)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    path = xml_files(spark, str(tmp_path))
    parsed = readers.scan_xml_reports(spark, path, keep_malformed=True, pattern="*.txt")
    files = parsed.select("filename").count()
    folders = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).selectExpr("regexp_replace(path, '/[^/]*$', '') AS f").distinct().count()
    assert folders <= 64
    # A null text makes a null document, an empty file, which is left out or malformed.
    good = parsed.filter("not malformed")
    assert sorted(int(r["uid"]) for r in good.select("uid").collect()) == [i for i in range(1, 201) if i % 7 and i % 50] and files <= 200


def test_many_small_files_are_read_by_few_tasks(spark, tmp_path):
    for k in range(40):
        (tmp_path / f"{k}.xml").write_text(f"<r><uId id='{k}'/></r>")
    most = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")  # a file a task
    try:
        d = readers.scan_xml_reports(spark, str(tmp_path))
        assert d.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism
        assert sorted(int(r["uid"]) for r in d.collect()) == list(range(40))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", most)


def test_xml_files_are_whole_and_named_by_their_tasks(spark, tmp_path):
    from catalog.source_queries import _file_writer
    values = [None if k == 7 else f"<r>é{k}\n</r>" for k in range(50)]
    d = spark.createDataFrame([(v,) for v in values], "value string").repartition(3)
    (tmp_path / "1").mkdir()  # an attempt that was first
    (tmp_path / "1" / "mark").write_text("")
    d.mapInArrow(_file_writer(str(tmp_path), 8), "n long").collect()
    at = d.rdd.glom().map(len).collect()
    assert [len(list((tmp_path / str(k)).rglob("*.txt"))) for k in range(3)] == [at[0], 0, at[2]]
    assert max(len(list(f.iterdir())) for f in (tmp_path / "0").iterdir()) <= 8
    got = sorted(p.read_text() for k in (0, 2) for p in (tmp_path / str(k)).rglob("*.txt"))
    want = sorted((r["value"] or "") + "\n" for k in (0, 2) for r in d.rdd.glom().collect()[k])
    assert got == want
