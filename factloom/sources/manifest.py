"""Manifests: the files of a run, checked, fingerprinted and read by role."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions.ids import ident
from factloom.sources.office import OFFICE, read_office

ROLES = ("corpus", "questions", "reference")
TEXT = ("md", "txt", "markdown")
IMAGES = ("png", "jpg", "jpeg", "webp")
SUFFIXES = (*TEXT, *IMAGES, *OFFICE)


class ManifestError(ValueError):
    """A manifest that can't be run."""


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """path, role, suffix of a JSON manifest ``{"root": ..., "files": [{"path": ..., "role": ...}]}``."""
    raw = spark.read.schema("root string, files array<struct<path:string,role:string>>").json(path, multiLine=True)
    files = raw.select("root", F.explode("files").alias("f")).select("root", "f.path", F.coalesce("f.role", F.lit("corpus")).alias("role"))
    return files.withColumn("suffix", F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1)))


def problems(manifest: DataFrame) -> DataFrame:
    """path, problem of every entry that breaks a rule."""
    from pyspark.sql import Window

    n = F.count("*").over(Window.partitionBy("path"))
    rule = (
        F.when(F.trim("path") == "", "empty path")
        .when(F.col("path").rlike(r"(^|[/\\])\.\.([/\\]|$)") | F.col("path").rlike(r"^([/\\]|[A-Za-z]:)"), "path leaves the root")
        .when(~F.col("role").isin(*ROLES), "unknown role")
        .when(~F.col("suffix").isin(*SUFFIXES), "unsupported suffix")
        .when(n > 1, "duplicate path")
    )
    return manifest.withColumn("problem", rule).filter("problem is not null").select("path", "problem").distinct()


def check(manifest: DataFrame, max_chars: int = 12_000, max_rows: int = 80) -> DataFrame:
    """The manifest, or an error that names its first problems."""
    if max_chars < 500 or max_rows < 1:
        raise ManifestError("max_chars must be 500 or more and max_rows 1 or more")
    found = [f"{r['path']}: {r['problem']}" for r in problems(manifest).orderBy("path").limit(20).collect()]
    if found or manifest.isEmpty():
        raise ManifestError("; ".join(found) or "no files")
    return manifest


def documents(spark: SparkSession, manifest: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """(documents, units) of the manifest's files under ``root``.

    Only files of the corpus role are read for their content; one that fails keeps its error, and the
    others go on. documents: document_id, path, sha256, format, role, parse_status, parse_error; units:
    document_id, unit_id, format, locator, content, structured.
    """
    base = root.rstrip("/")
    binary = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base)
    short = F.expr(f"substring(path, instr(path, '{base.split(':')[-1]}') + {len(base.split(':')[-1]) + 1})")
    files = binary.select(short.alias("path"), "content").join(F.broadcast(manifest.select("path", "role", "suffix").distinct()), "path")
    files = files.withColumn("sha256", F.sha2("content", 256)).withColumn("document_id", ident("doc", F.col("path"), F.col("sha256")))
    corpus = files.filter("role = 'corpus'")
    texts = corpus.filter(F.col("suffix").isin(*TEXT))
    body = F.regexp_replace(F.decode("content", "UTF-8"), "^\ufeff", "")
    lines = texts.select("document_id", F.col("suffix").alias("format"), F.lit("{}").alias("locator"), body.alias("content"), F.lit(None).cast("string").alias("structured"), F.lit(None).cast("string").alias("error"))
    images = corpus.filter(F.col("suffix").isin(*IMAGES)).select("document_id", F.col("suffix").alias("format"), F.concat(F.lit('{"image":"'), F.col("path"), F.lit('"}')).alias("locator"), F.lit("").alias("content"), F.lit(None).cast("string").alias("structured"), F.lit(None).cast("string").alias("error"))
    units = lines.unionByName(images).unionByName(read_office(corpus.filter(F.col("suffix").isin(*OFFICE))))
    failed = units.filter("error is not null").groupBy("document_id").agg(F.min("error").alias("parse_error"))
    docs = files.select("document_id", "path", "sha256", F.col("suffix").alias("format"), "role").join(failed, "document_id", "left")
    status = F.when(F.col("role") != "corpus", "excluded").when(F.col("parse_error").isNotNull(), "failed").otherwise("parsed")
    good = units.filter("error is null").drop("error")
    good = good.withColumn("unit_id", ident("unit", F.col("document_id"), F.col("locator"), F.col("content"), F.coalesce("structured", F.lit(""))))
    return docs.withColumn("parse_status", status), good
