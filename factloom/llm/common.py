"""Helpers that the training-data operators share."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

#: ASCII white space; a word is a longest run of other characters. bytes.split() splits at exactly these.
SPACES = " \t\n\x0b\x0c\r"
#: Bytes of texts that go to a Python worker at once.
BATCH_BYTES = 4 << 20
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Lower the session's bytes of an Arrow batch to ``BATCH_BYTES``: a batch stands several times in the
    memory of an executor and its workers, whatever the length of the texts."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    told = spark.conf.get(key).lower()
    size = int(told.rstrip("bkmg")) << {"k": 10, "m": 20, "g": 30}.get(told.rstrip("b")[-1], 0)
    if size > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Where that is unset, a
    temporary folder in local mode (one machine, as in tests) and the warehouse on a cluster."""
    set_dir = spark.conf.get("spark.checkpoint.dir", None)
    if set_dir:
        return set_dir.rstrip("/")
    if spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local":
        return "file://" + os.path.join(tempfile.gettempdir(), "factloom-scratch")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/factloom-scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later steps neither recompute it nor
    depend on the executors that made it."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def boxed(docs: DataFrame, *columns: str) -> DataFrame:
    """The whole row as the struct ``box`` beside the named columns: an operator's own names can't clash
    with those of other columns. ``unboxed`` gives the row back."""
    from pyspark.sql import functions as F

    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("box"), *columns)


def unboxed(df: DataFrame, docs: DataFrame, **new) -> DataFrame:
    """The rows that ``boxed`` put away, with new values for some columns."""
    from pyspark.sql import functions as F

    row = F.struct(*[(new[c] if c in new else F.col("box")[c]).alias(c) for c in docs.columns])
    return df.select(row.alias("row")).select("row.*")


def release() -> None:
    """Give memory that this worker has freed back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


#: Arrays of more bytes are mapped one by one; by default and where a task makes many large ones in a row.
MAPPED, MAPPED_MOST = 256 << 10, 32 << 20


def return_large(mapped: int = MAPPED) -> None:
    """Let the C library map arrays over ``mapped`` bytes one by one, so that each goes back when it is
    freed, and keep one heap instead of one for each thread. Fewer are mapped, and less of the heap is
    given back before the task's end, where that would cost more than it saves."""
    try:
        libc = ctypes.CDLL(None)
        libc.mallopt(-3, mapped)  # M_MMAP_THRESHOLD
        libc.mallopt(-1, 8 * mapped)  # M_TRIM_THRESHOLD
        libc.mallopt(-8, 1)  # M_ARENA_MAX
    except (AttributeError, OSError):  # another C library
        pass


def lean(run, mapped: int = MAPPED):
    """``run`` for mapInArrow, which leaves a small worker behind: workers outlive their tasks, beside
    the executor's own memory."""

    def wrapped(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return_large(mapped)
        yield from run(found)
        release()

    return wrapped


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str | None]:
    return batch.column(batch.schema.get_field_index(column)).to_pylist()


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) words as UTF-8 bytes."""
    return text.encode().lower().split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_hashes(h: np.ndarray, k: int = 5) -> np.ndarray:
    """The hash of each run of ``k`` words in order; a shorter sequence is one shingle, an empty one none."""
    if not len(h):
        return h
    k = min(k, len(h))
    n = len(h) - k + 1
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = mix(out * GOLDEN + h[i : i + n])
    return out


def long_list(flat: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, kind))


def bitmap_of(df: DataFrame, column: str, bits: int = 26) -> np.ndarray:
    """A membership bitmap of a long column with 2**bits bits, whatever the input: ``may_hold`` never
    misses a value, and the share of others that it lets through is at most values / bits."""
    from pyspark.sql import functions as F

    slot = F.shiftrightunsigned(F.xxhash64(column), 64 - bits)
    words = df.select((F.shiftright(slot, 6)).alias("w"), F.pmod(slot, F.lit(64)).alias("b")).distinct()
    words = words.groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, cast(b as int))")).alias("v")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[words.column(0).to_numpy()] = words.column(1).to_numpy().astype(np.int64).view(np.uint64)
    return out


def may_hold(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of the values (int64) the bitmap may hold; the hash is Spark's xxhash64 of a long."""
    bits = len(bitmap).bit_length() + 5
    slot = spark_hash(values.view(np.uint64)) >> np.uint64(64 - bits)
    return (bitmap[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def spark_hash(x: np.ndarray) -> np.ndarray:
    """xxhash64 of longs with Spark's seed 42 (the public XXH64 definition for 8 bytes)."""
    p1, p2, p3, p4, p5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))

    def left(v, r):
        return (v << np.uint64(r)) | (v >> np.uint64(64 - r))

    h = np.uint64((42 + int(p5) + 8) % (1 << 64)) ^ (left(x * p2, 31) * p1)
    h = left(h, 27) * p1 + p4
    h = (h ^ (h >> np.uint64(33))) * p2
    h = (h ^ (h >> np.uint64(29))) * p3
    return h ^ (h >> np.uint64(32))
