"""Office files: DOCX, XLSX and PPTX packages as units, read with the standard library inside tasks."""

from __future__ import annotations

import io
import json
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame

OFFICE = ("docx", "xlsx", "pptx")
W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
P = "{http://schemas.openxmlformats.org/presentationml/2006/main}"
R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"

Unit = tuple[dict, str, dict | None]


def xml(package: zipfile.ZipFile, name: str):
    raw = package.read(name)
    if b"<!DOCTYPE" in raw[:2000] or b"<!ENTITY" in raw:
        raise ValueError(f"{name}: entities aren't allowed")
    return ElementTree.fromstring(raw)


def docx_units(package: zipfile.ZipFile) -> Iterator[Unit]:
    """A unit for the paragraphs under each heading, and one for each table."""
    body = xml(package, "word/document.xml").find(f"{W}body")
    section: list[str] = []
    held: list[str] = []
    first = place = table = 0

    def told() -> Iterator[Unit]:
        if any(h.strip() for h in held):
            yield {"section": list(section), "paragraph_start": first, "paragraph_end": place - 1}, "\n\n".join(held), None

    for node in body if body is not None else ():
        if node.tag == f"{W}p":
            text = "".join(t.text or "" for t in node.iter(f"{W}t"))
            style = node.find(f"{W}pPr/{W}pStyle")
            level = re.search(r"(?:heading|标题)\s*(\d)", style.get(f"{W}val", "") if style is not None else "", re.I)
            if level and text.strip():
                yield from told()
                held, first = [], place
                section = [*section[: int(level[1]) - 1], text.strip()]
            elif text.strip():
                held.append(text)
            place += 1
        elif node.tag == f"{W}tbl":
            table += 1
            rows = []
            for r, tr in enumerate(node.iter(f"{W}tr")):
                row = []
                for c, tc in enumerate(tr.findall(f"{W}tc")):
                    span, merge = tc.find(f"{W}tcPr/{W}gridSpan"), tc.find(f"{W}tcPr/{W}vMerge")
                    text = "\n".join("".join(t.text or "" for t in p.iter(f"{W}t")) for p in tc.findall(f"{W}p"))
                    row.append({"row": r, "cell": c, "text": text, "grid_span": int(span.get(f"{W}val", 1)) if span is not None else 1, "vertical_merge": merge.get(f"{W}val", "continue") if merge is not None else None})
                rows.append(row)
            content = "\n".join("| " + " | ".join(c["text"].replace("|", "\\|").replace("\n", "<br>") for c in row) + " |" for row in rows)
            yield {"section": list(section), "table": table}, content, {"kind": "source_xml_table", "records": rows}
    yield from told()


def xlsx_units(package: zipfile.ZipFile, max_rows: int = 80) -> Iterator[Unit]:
    """A unit for every ``max_rows`` rows of a sheet, cells with formula, cached value and hidden rows."""
    names = package.namelist()
    shared = ["".join(t.text or "" for t in si.iter(f"{S}t")) for si in xml(package, "xl/sharedStrings.xml").findall(f"{S}si")] if "xl/sharedStrings.xml" in names else []
    rels = {r.get("Id"): r.get("Target").lstrip("/") for r in xml(package, "xl/_rels/workbook.xml.rels")}
    for sheet in xml(package, "xl/workbook.xml").iter(f"{S}sheet"):
        target = rels[sheet.get(f"{R}id")]
        root = xml(package, target if target.startswith("xl/") else f"xl/{target}")
        hidden = [c.get("min") + "-" + c.get("max") for c in root.iter(f"{S}col") if c.get("hidden") == "1"]
        merged = [m.get("ref") for m in root.iter(f"{S}mergeCell")]
        records = []
        for row in root.iter(f"{S}row"):
            cells = []
            for c in row.findall(f"{S}c"):
                v, f = c.find(f"{S}v"), c.find(f"{S}f")
                kind, raw = c.get("t"), v.text if v is not None else None
                if kind == "s" and raw is not None:
                    raw = shared[int(raw)]
                elif kind == "inlineStr":
                    raw = "".join(t.text or "" for t in c.iter(f"{S}t"))
                if raw is not None or f is not None:
                    cells.append({"coordinate": c.get("r"), "value": raw, "formula": "=" + (f.text or "") if f is not None else None, "cached": raw is not None})
            if cells:
                records.append({"row": int(row.get("r", len(records) + 1)), "hidden": row.get("hidden") == "1", "cells": cells})
        heads = [[c["value"] for c in r["cells"]] for r in records[:3]]
        for i in range(0, len(records), max_rows):
            part = records[i : i + max_rows]
            content = "\n".join("| " + " | ".join((c["value"] or c["formula"] or "").replace("|", "\\|") for c in r["cells"]) + " |" for r in part)
            yield {"sheet": sheet.get("name"), "sheet_state": sheet.get("state", "visible"), "row_start": part[0]["row"], "row_end": part[-1]["row"]}, content, {"kind": "xlsx_cells", "records": part, "header_candidates": heads, "merged_ranges": merged, "hidden_columns": hidden}


def pptx_units(package: zipfile.ZipFile) -> Iterator[Unit]:
    """A unit for each slide: its shapes' texts, tables and notes."""
    slides = sorted((int(m[1]), n) for n in package.namelist() if (m := re.fullmatch(r"ppt/slides/slide(\d+)\.xml", n)))
    for number, name in slides:
        shapes = []
        for shape in xml(package, name).iter():
            if shape.tag in (f"{P}sp", f"{P}graphicFrame"):
                about = next(iter(shape.iter(f"{P}cNvPr")), None)
                rows = [["".join(t.text or "" for t in tc.iter(f"{A}t")) for tc in tr.findall(f"{A}tc")] for tr in shape.iter(f"{A}tr")]
                text = "" if rows else "\n".join("".join(t.text or "" for t in p.iter(f"{A}t")) for p in shape.iter(f"{A}p"))
                shapes.append({"shape_id": about.get("id") if about is not None else None, "name": about.get("name") if about is not None else None, "text": text, "table": rows or None})
        notes = f"ppt/notesSlides/notesSlide{number}.xml"
        note = "\n".join(t.text or "" for t in xml(package, notes).iter(f"{A}t")) if notes in package.namelist() else ""
        content = "\n\n".join(s["text"] or "\n".join("| " + " | ".join(r) + " |" for r in s["table"] or ()) for s in shapes if s["text"] or s["table"])
        yield {"slide": number}, content, {"kind": "pptx_shapes", "shapes": shapes, "notes": note}


READERS = {"docx": docx_units, "xlsx": xlsx_units, "pptx": pptx_units}


def read_office(files: DataFrame) -> DataFrame:
    """document_id, format, locator, content, structured, error of files (document_id, suffix, content). A
    file that can't be read gives one row with its error."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in found:
            out = []
            for doc, suffix, raw in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(raw)) as package:
                        for locator, content, structured in READERS[suffix](package):
                            out.append((doc, suffix, json.dumps(locator, ensure_ascii=False), content, json.dumps(structured, ensure_ascii=False) if structured else None, None))
                except Exception as e:  # a broken file must not stop the others
                    out = [r for r in out if r[0] != doc] + [(doc, suffix, "{}", "", None, f"{type(e).__name__}: {e}"[:300])]
            cols = list(zip(*out, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], names=["document_id", "format", "locator", "content", "structured", "error"])

    return files.select("document_id", "suffix", "content").mapInArrow(run, "document_id string, format string, locator string, content string, structured string, error string")
