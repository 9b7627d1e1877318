"""Helpers shared by the corpus operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z, every other character unchanged."""
    return F.translate(c, UPPER, LOWER)


def shared_folder(spark: SparkSession) -> str:
    """A new path below ``spark.checkpoint.dir`` (a temporary folder only for a local master without one)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = os.path.join(tempfile.gettempdir(), "segmetrics-shared")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage is cut and survives lost executors."""
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


ARROW_BYTES = 8 << 20          # of a batch that a task hands to its Python worker
PART_BYTES = 4 << 20           # of rows that a worker has as Python objects at once


def small_batches(df: DataFrame) -> DataFrame:
    """Bound the session's Arrow batches by ARROW_BYTES, so that long texts don't pile up beside the heap."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = df.sparkSession.conf.get(key)
    if not now.rstrip("bB").isdigit() or not 0 < int(now.rstrip("bB")) <= ARROW_BYTES:
        df.sparkSession.conf.set(key, str(ARROW_BYTES))
    return df


def parts(batches, most: int = PART_BYTES):
    """Slices of about ``most`` bytes of the record batches."""
    for batch in batches:
        step = max(1, batch.num_rows * most // max(1, batch.nbytes))
        for lo in range(0, batch.num_rows, step):
            yield batch.slice(lo, step)
    release()


def release() -> None:
    """Give freed memory back to the system: a reused worker otherwise keeps the peak of every task it ran."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):             # only where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer (multiply, xor-shift)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


_SALT = np.random.default_rng(20240607).integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(int(_BASE), -1, 2**64))


class SpanHasher:
    """64-bit hashes of byte spans ``data[start:end]``, from one running polynomial sum over ``data``."""

    def __init__(self):
        self.power = self.back = np.ones(1, np.uint64)

    def __call__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        if not len(start):
            return np.zeros(0, np.uint64)
        with np.errstate(over="ignore"):
            if len(self.power) <= len(data):
                self.power, self.back = (np.cumprod(np.concatenate(([np.uint64(1)], np.full(len(data), x, np.uint64)))) for x in (_BASE, _INV))
            total = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(_SALT[data] * self.power[:len(data)], out=total[1:])
            return mix64((total[end] - total[start]) * self.back[start] + (end - start).astype(np.uint64))


def spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of True."""
    wide = np.zeros(len(inside) + 2, bool)
    wide[1:-1] = inside
    edge = np.flatnonzero(wide[1:] != wide[:-1])
    return edge[0::2], edge[1::2]
