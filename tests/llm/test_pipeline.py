"""The pipeline's stages, each on what the one before kept, against brute force."""

from test_operators import brute_components

import corpus_pipeline
from factloom.llm import line_dedup, quality

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "best-fit packing"]
    bench = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    good, lines, one, clean = (f for _, f in corpus_pipeline.STAGES[:4])
    a = good(spark, docs, SF)
    kept = {r["doc_id"] for r in quality.quality_report(docs).filter("kept").collect()}
    assert {r["doc_id"] for r in a.collect()} == kept and a.columns == docs.columns
    b = lines(spark, a, SF)
    classes = {(r["doc_id"], r["line"]): r["kept"] for r in line_dedup.line_classes(a).collect()}
    want = {}
    for r in a.collect():
        rows = r["text"].split("\n")
        left = [s for n, s in enumerate(rows) if classes.get((r["doc_id"], n), True)]
        if any(classes.get((r["doc_id"], n)) for n in range(len(rows))):
            want[r["doc_id"]] = "\n".join(left)
    assert {r["doc_id"]: r["text"] for r in b.collect()} == want
    c = one(spark, b, SF)
    groups = brute_components([(r["doc_id"], r["text"]) for r in b.collect()])
    assert {r["doc_id"] for r in c.collect()} == {d for d, _, low in groups if d == low}
    d = clean(spark, c, SF)
    gone = {r["doc_id"] for r in c.collect()} - {r["doc_id"] for r in d.collect()}
    lower = {r["doc_id"]: " ".join(r["text"].lower().split()) for r in c.collect()}
    assert gone == {i for i, t in lower.items() if any(" ".join(x.lower().split()) in t for x in bench)}


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.count() > 0 and {"doc_id", "sequence_id", "offset", "length"} <= set(rows.columns)
