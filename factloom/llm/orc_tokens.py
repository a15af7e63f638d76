"""Token-ID output: ORC files of ids in ascending document order, and readers for them.

Integer columns use ORC's run-length encoding. Each file has stripes of bounded size, a row index every
``ROW_STRIDE`` rows and a Bloom filter on doc_id, so a scan splits at stripes and a look-up by document
reads only the stripes and row groups that may hold it.

Defined cases: a null or empty text has the end id alone; null ids come first and stay null; rows that
share an id stay apart, in the order in which they stand in their file; an empty table gives files
without rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factloom.llm.common import cut, lean, long_list, small_batches, texts_of
from factloom.llm.tokens import encoder

STRIPE_BYTES = 32 << 20
ROW_STRIDE = 1000
#: Plain words whose ids a worker keeps.
WORDS = 900_000


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int | None) -> DataFrame:
    """doc_id, pos (place in its partition) and ids, in the order of ``docs``' partitions."""
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, pos = encoder(tokenizer, WORDS), 0
        end = b"" if end_id is None else np.uint32(end_id).tobytes()
        for big in found:
            for at in range(0, big.num_rows, 500):
                b = big.slice(at, 500)
                ids = [x + end for x in enc.encode(texts_of(b))]
                offsets = np.cumsum([0, *(len(x) // 4 for x in ids)])
                flat = np.frombuffer(b"".join(ids), "<i4")
                places = pa.array(range(pos, pos + b.num_rows), pa.int64())
                pos += b.num_rows
                yield pa.RecordBatch.from_arrays([b.column(0), places, long_list(flat, offsets, pa.int32())], names=["doc_id", "pos", "ids"])

    return docs.select("doc_id", "text").mapInArrow(lean(run), f"doc_id {kind}, pos long, ids array<int>")


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 1) -> str:
    """Write the ids of every text to ``path``, documents in ascending order over the files."""
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    (
        encode_documents(ordered, tokenizer, end_id)
        .write.option("compression", "snappy")
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", str(ROW_STRIDE))
        .option("orc.stripe.size", str(STRIPE_BYTES))
        .orc(path)
    )
    return path


def read_tokens(spark: SparkSession, path: str, kind: str = "bigint") -> DataFrame:
    """doc_id, pos and ids as written; the scan splits at stripes."""
    return spark.read.schema(f"doc_id {kind}, pos bigint, ids array<int>").orc(path)


def look_up(spark: SparkSession, path: str, doc_ids: list, kind: str = "bigint") -> DataFrame:
    """The documents with these ids; files, stripes and row groups without them are not read."""
    return read_tokens(spark, path, kind).filter(F.col("doc_id").isin(doc_ids))


def token_digest(spark: SparkSession, path: str, kind: str = "bigint") -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in found:
            ids = b.column(3)
            flat, offsets = memoryview(ids.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)).cast("B"), ids.offsets.to_pylist()
            crc = [zlib.crc32(flat[4 * x : 4 * y]) for x, y in zip(offsets, offsets[1:], strict=False)]
            n = np.diff(offsets)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(n, pa.int64()), pa.array(crc, pa.int64())], names=["file", "doc_id", "pos", "n_tokens", "ids_crc32"])

    part = F.regexp_extract(F.input_file_name(), r"part-(\d+)", 1).cast("long")
    rows = read_tokens(spark, path, kind).select(part.alias("file"), "doc_id", "pos", "ids")
    rows = cut(rows.mapInArrow(lean(run), f"file long, doc_id {kind}, pos long, n_tokens long, ids_crc32 long"), "token-digest")
    within = Window.partitionBy("file").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    files = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    before = rows.groupBy("file").agg(F.sum("n_tokens").alias("n")).select("file", F.coalesce(F.sum("n").over(files), F.lit(0)).alias("before"))
    return (
        rows.withColumn("inside", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
        .join(before, "file")
        .select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
    )
