"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import os
import sys
import uuid
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlift.sources.staging import stage, staging_root

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def workers_can_import(spark: SparkSession) -> None:
    """Put the folder of this package on the Python path of the workers, where it exists there."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *known])


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def give_back_memory() -> None:
    """Return what a task has freed to the system: workers live on, and would keep it for tasks of other kinds."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None
    if trim is not None:
        trim(0)


def map_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    """mapInArrow, with this package importable on the workers.

    Where the session does not say how large Arrow batches may be, they are held at 8 MB, since a batch is in
    memory several times over."""
    spark = df.sparkSession
    workers_can_import(spark)
    if BATCH_BYTES not in spark.conf.getAll:
        spark.conf.set(BATCH_BYTES, "8m")

    def run(batches):
        yield from function(batches)
        give_back_memory()

    return df.mapInArrow(run, schema)


def read(spark: SparkSession, folder: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """True where crc32 of the id as text leaves 2 on division by 4; a missing id is never held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def text_slices(texts: Iterable[str | bytes], limit: int = 1 << 18, rows: int = 1024) -> Iterator[tuple[int, int]]:
    """Ranges of at most `rows` neighbouring texts with about `limit` characters in all; a longer text has a
    range of its own. Together they hold every text."""
    start = size = stop = 0
    for stop, text in enumerate(texts):
        if size and (size + len(text) > limit or stop - start >= rows):
            yield start, stop
            start, size = stop, 0
        size += len(text) + 1
    if size:
        yield start, stop + 1


def strings(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """Python texts of an Arrow column; a missing text is an empty one."""
    return [t if t is not None else "" for t in column.to_pylist()]


def byte_strings(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of an Arrow text column; a missing text is an empty one."""
    return [t if t is not None else b"" for t in column.cast(pa.binary()).to_pylist()]


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.ones(max(n, 1), np.uint64)
    out[1:] = np.uint64(base)
    return np.multiply.accumulate(out)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit over the whole word."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder of spark.checkpoint.dir."""
    return f"{staging_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def discard(table: DataFrame) -> None:
    """Delete the folders of a written table of this run that nothing will read any more."""
    spark = table.sparkSession
    root = staging_root(spark).split(":", 1)[-1].lstrip("/")
    for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
        if root in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free_name(df: DataFrame, name: str) -> str:
    """`name`, longer if the table has a column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


__all__ = [
    "ASCII_UPPER",
    "byte_strings",
    "discard",
    "free_name",
    "held_out",
    "map_arrow",
    "mixed",
    "powers",
    "read",
    "scratch",
    "stage",
    "strings",
    "text_slices",
    "workers_can_import",
]
