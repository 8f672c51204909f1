"""Reading, text batches, hashes, digests and tables kept between jobs."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows per Arrow batch: with texts of 100 kB a batch stays near 25 MB.
BATCH_ROWS = 256

#: Bytes of text that are worked on at once inside a task.
CHUNK_BYTES = 1_000_000

#: Stands for a missing doc_id wherever ids are ordered: it comes last.
NO_ID = 2**63 - 1

MIX = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the input folder, through Spark's reader."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bound_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Lower the session's Arrow batch size to `rows`, as texts may be long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`.

    A local session without one gets a folder of its own; on a cluster the
    setting is required.
    """
    context = spark.sparkContext
    given = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if given:
        return given
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="grainline-"))
    return context.getCheckpointDir()


def stored(frame: DataFrame) -> DataFrame:
    """`frame` written once under the shared folder and read back.

    Later jobs read the files instead of computing it again, also after an
    executor was lost.  The files go when the session's JVM ends.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(frame.schema).parquet(path)


def keyed(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, text (null: empty), `d` (doc_id, null last) and `h` (hash of the text).

    `d` and `h` together stand for a row: rows that share both are equal.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        whole.alias("text"),
        id_or_last(F.col("doc_id")).alias("d"),
        F.xxhash64(whole).alias("h"),
    )


def id_or_last(column: Column) -> Column:
    return F.coalesce(column.cast("long"), F.lit(NO_ID))


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of doc_id as text, modulo `divisor`; a missing id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def hex_sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


def chunks(lengths: Iterable[int], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts with at most `limit` bytes, or of one text."""
    start = held = i = 0
    for i, n in enumerate(lengths, 1):
        if held and held + n > limit:
            yield start, i - 1
            start, held = i - 1, 0
        held += n
    if i > start:
        yield start, i


def texts_of(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes, null as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def starts_of(lengths: np.ndarray) -> np.ndarray:
    """Offsets of consecutive pieces, with the end as last entry."""
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out

