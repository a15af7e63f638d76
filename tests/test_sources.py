"""Manifests, Office packages, sinks and streams on files made here."""

import json
import zipfile

import pytest
from pyspark.sql import functions as F

from factloom.sources import manifest, sinks
from factloom.streaming import intake

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
S = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
P = 'xmlns:p="http://schemas.openxmlformats.org/presentationml/2006/main" xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main"'


def package(path, parts):
    with zipfile.ZipFile(path, "w") as z:
        for name, text in parts.items():
            z.writestr(name, text)


@pytest.fixture()
def corpus(tmp_path):
    root = tmp_path / "in"
    root.mkdir()
    (root / "a.md").write_text("﻿# Title\n\ntext", encoding="utf-8")
    (root / "q.txt").write_text("question", encoding="utf-8")
    (root / "bad.docx").write_bytes(b"no zip")
    package(root / "d.docx", {"word/document.xml": f'<w:document {W}><w:body><w:p><w:pPr><w:pStyle w:val="Heading1"/></w:pPr><w:r><w:t>Head</w:t></w:r></w:p><w:p><w:r><w:t>Body</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>x</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>'})
    package(
        root / "s.xlsx",
        {
            "xl/workbook.xml": f'<workbook {S}><sheets><sheet name="One" r:id="r1"/></sheets></workbook>',
            "xl/_rels/workbook.xml.rels": '<Relationships xmlns="x"><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>',
            "xl/sharedStrings.xml": f"<sst {S}><si><t>Name</t></si></sst>",
            "xl/worksheets/sheet1.xml": f'<worksheet {S}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c></row><row r="2" hidden="1"><c r="A2"><f>1+1</f><v>2</v></c></row></sheetData></worksheet>',
        },
    )
    package(root / "p.pptx", {"ppt/slides/slide1.xml": f'<p:sld {P}><p:sp><p:cNvPr id="2" name="T"/><a:p><a:r><a:t>Slide text</a:t></a:r></a:p></p:sp></p:sld>'})
    files = [{"path": p, "role": "questions" if p == "q.txt" else "corpus"} for p in ("a.md", "q.txt", "bad.docx", "d.docx", "s.xlsx", "p.pptx")]
    (tmp_path / "m.json").write_text(json.dumps({"root": "in", "files": files}), encoding="utf-8")
    return tmp_path


def test_documents_and_units(spark, corpus):
    m = manifest.check(manifest.read_manifest(spark, str(corpus / "m.json")))
    docs, units = manifest.documents(spark, m, str(corpus / "in"))
    status = {r["path"]: r["parse_status"] for r in docs.collect()}
    assert status == {"a.md": "parsed", "q.txt": "excluded", "bad.docx": "failed", "d.docx": "parsed", "s.xlsx": "parsed", "p.pptx": "parsed"}
    content = {r["path"]: [] for r in docs.collect()}
    for r in units.join(docs, "document_id").orderBy("locator").collect():
        content[r["path"]].append(r["content"])
    assert content["a.md"] == ["# Title\n\ntext"] and sorted(content["d.docx"]) == ["Body", "| x |"] and content["p.pptx"] == ["Slide text"]
    sheet = json.loads(units.filter("format = 'xlsx'").first()["structured"])
    assert sheet["records"][1]["hidden"] and sheet["records"][1]["cells"][0]["formula"] == "=1+1" and content["s.xlsx"] == ["| Name |\n| 2 |"]
    text = {r["document_id"]: r["markdown"] for r in sinks.enriched_markdown(units, docs).collect()}
    assert len(text) == 4 and all(t.startswith("# ") for t in text.values()) and sinks.duplicate_units(units).isEmpty()


@pytest.mark.parametrize("files", [[], [{"path": "../x.md"}], [{"path": "a.md"}, {"path": "a.md"}], [{"path": "a.exe"}], [{"path": "a.md", "role": "boss"}]])
def test_bad_manifests(spark, tmp_path, files):
    (tmp_path / "m.json").write_text(json.dumps({"root": "in", "files": files}))
    with pytest.raises(manifest.ManifestError):
        manifest.check(manifest.read_manifest(spark, str(tmp_path / "m.json")))


def test_run_tables(spark, tmp_path):
    df = spark.range(3)
    path = sinks.write_table(df, str(tmp_path), "run_1", "graph")
    assert sinks.read_run(spark, str(tmp_path), "run_1", "graph").count() == 3
    with pytest.raises(sinks.ProtectedPath):
        sinks.write_table(df, str(tmp_path), "run_1", "graph", (path,))
    sinks.drop_derived(spark, str(tmp_path), "run_1")
    assert not (tmp_path / "run=run_1" / "graph").exists()
    runs = [("a", 5, "native", "x", "x", True, False), ("b", 9, "native", "x", "y", True, False), ("c", 7, "native", "x", "x", True, False), ("d", 8, "native", "x", "x", True, True)]
    runs = spark.createDataFrame(runs, "work_dir string, mtime_ns long, backend string, fingerprint_graph string, fingerprint_units string, complete boolean, archived boolean")
    assert sinks.latest_run(runs, "other").first()["work_dir"] == "c"


def test_replayed_responses_change_nothing(spark, tmp_path):
    (tmp_path / "r").mkdir()
    put = lambda n, *rows: (tmp_path / "r" / n).write_text("\n".join(json.dumps(dict(zip(("task_id", "fingerprint", "seq", "payload"), r, strict=True))) for r in rows))
    tasks = spark.createDataFrame([("t1",), ("t2",)], "task_id string")
    run = lambda: intake.accept_stream(spark, str(tmp_path / "r"), tasks, str(tmp_path / "a"), "run", str(tmp_path / "c")).awaitTermination()
    put("1.json", ("t1", "run", 1, "x"), ("t2", "old", 1, "y"))
    run()
    put("2.json", ("t1", "run", 2, "z"), ("t2", "run", 3, "w"))
    run()
    got = spark.read.parquet(str(tmp_path / "a"))
    assert sorted((r["task_id"], r["seq"]) for r in got.collect()) == [("t1", 1), ("t2", 3)]


def test_windows(spark):
    e = spark.createDataFrame([("2024-01-01 00:10:00", "a", 1.0), ("2024-01-01 00:50:00", "a", 2.0), ("2024-01-01 01:00:00", "a", 4.0)], "ts string, event_type string, value double")
    assert sorted(r["total"] for r in intake.windowed_counts(e).select(F.col("total")).collect()) == [3.0, 4.0]
