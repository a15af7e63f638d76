"""Sinks: versioned checkpoint tables, a registry of runs, and enriched Markdown."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


class ProtectedPath(ValueError):
    """An output that would overwrite an input."""


def write_table(df: DataFrame, work: str, fingerprint: str, name: str, inputs: tuple[str, ...] = ()) -> str:
    """Write one logical table of a run to ``work/run=<fingerprint>/<name>``; older runs stay as they are."""
    path = f"{work.rstrip('/')}/run={fingerprint}/{name}"
    if any(path == i.rstrip("/") or path.startswith(i.rstrip("/") + "/") for i in inputs):
        raise ProtectedPath(path)
    df.write.mode("overwrite").parquet(path)
    return path


def read_run(spark: SparkSession, work: str, fingerprint: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{work.rstrip('/')}/run={fingerprint}/{name}")


def drop_derived(spark: SparkSession, work: str, fingerprint: str, names: tuple[str, ...] = ("alignment", "graph")) -> None:
    """Remove what was derived from an extraction that has changed."""
    for n in names:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{work.rstrip('/')}/run={fingerprint}/{n}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def latest_run(runs: DataFrame, backend: str, fallback: str = "native") -> DataFrame:
    """The newest complete, unarchived run whose graph and units agree: of the backend, else the fallback."""
    good = runs.filter("complete and not archived and fingerprint_graph = fingerprint_units").filter(F.col("backend").isin(backend, fallback))
    w = Window.orderBy(F.when(F.col("backend") == backend, 0).otherwise(1), F.desc("mtime_ns"), "work_dir")  # a registry of runs
    return good.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def enriched_markdown(units: DataFrame, documents: DataFrame) -> DataFrame:
    """document_id, markdown: each document's units in order under a block of their provenance."""
    block = F.concat(F.lit("<!-- unit "), F.col("unit_id"), F.lit(" at "), F.col("locator"), F.lit(" -->\n\n"), F.col("content"))
    own = units.groupBy("document_id").agg(F.array_sort(F.collect_list(F.struct("locator", "unit_id", block.alias("b")))).alias("u"))
    text = F.concat(F.lit("# "), F.col("path"), F.lit("\n\n"), F.array_join(F.transform("u", lambda x: x["b"]), "\n\n"))
    return own.join(documents.select("document_id", "path"), "document_id").select("document_id", text.alias("markdown"))


def duplicate_units(units: DataFrame) -> DataFrame:
    return units.groupBy("unit_id").count().filter("count > 1").select("unit_id")
