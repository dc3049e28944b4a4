"""What several operators share: the shared folder, written tables, words."""

from __future__ import annotations

import ctypes
import functools
import gc
import os
import tempfile
import uuid
import zlib
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The system's allocator gives freed memory back to it at `tidied`; Arrow's own holds on to it.
pa.set_memory_pool(pa.system_memory_pool())

#: A side of at most so many rows may be broadcast (ids and hashes: tens of MB).
BROADCAST_ROWS = 1_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from spark.checkpoint.dir.

    Only where that is unset and the master is local, as in tests, is a local folder taken.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        d = "file://" + os.path.join(tempfile.gettempdir(), "kinfold-shared")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


#: Tables that `written` made in this process, for `release`.
_made: list[str] = []


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a Parquet table in the shared folder, read back: its lineage ends there.

    The table stays until `release`, since results read it.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, paths: list[str]) -> int:
    for p in paths:
        _made.remove(p)
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return len(paths)


def release(spark: SparkSession, since: int = 0) -> int:
    """Deletes the tables of all steps so far (but the first `since`), once the results that
    read them are stored."""
    return dropped(spark, _made[since:])


def made() -> int:
    """How many tables there are: `release(spark, n)` later drops those made after."""
    return len(_made)


def forgotten(spark: SparkSession) -> None:
    """The driver lets go of past steps' plans and of the code that was made for them: a long
    chain of steps would otherwise hold it all until its heap is full."""
    gc.collect()
    spark._jvm.System.gc()
    trimmed()


@contextmanager
def steps(spark: SparkSession, *kept: str):
    """Tables written within are dropped at the end, but for those of the names `kept`, which
    the result reads."""
    n = len(_made)
    yield
    forgotten(spark)
    names = tuple(f"{shared_dir(spark)}/{k}-" for k in kept)
    dropped(spark, [p for p in _made[n:] if not p.startswith(names)] if names else _made[n:])


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df`, marked for broadcast only if a count shows at most `rows` rows.

    Above that it stays unmarked and Spark joins by shuffle, splitting skewed partitions.
    """
    return F.broadcast(df) if df.count() <= rows else df


def text_of(df: DataFrame, col: str = "text") -> DataFrame:
    return df.withColumn(col, F.coalesce(F.col(col), F.lit("")))


WHITE = " \t\n\x0b\x0c\r"


def words_of(text: str | None) -> list[bytes]:
    r"""Words `[^\x20\x09-\x0D]+` in UTF-8: bytes.split() splits at just these six."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def lower_az(text: str) -> bytes:
    """UTF-8 with A-Z, and no other letter, in lower case."""
    return text.encode("utf-8", "surrogatepass").lower()


def trimmed() -> None:
    """Freed memory goes back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidied(batches):
    """The batches; after the last, what the task has freed goes back to the system.

    Python workers live on between tasks, and would keep the most that any task took.
    """
    try:
        yield from batches
    finally:
        trimmed()


@functools.cache
def freed_stays() -> None:
    """From here on memory that this process frees stays with it until `trimmed`: arrays of some
    MB, made and freed window by window, else come from the system page by page each time."""
    try:
        mallopt = ctypes.CDLL(None).mallopt
    except (OSError, AttributeError):  # another allocator
        return
    mallopt(-1, 128 << 20)  # M_TRIM_THRESHOLD
    mallopt(-3, 32 << 20)  # M_MMAP_THRESHOLD


@functools.cache
def one_thread() -> None:
    """From here on this process' matrix products take one thread: a task has one core, and the
    library's threads would spin on the others while they wait."""
    try:
        with open("/proc/self/maps") as f:
            loaded = {line.split()[-1] for line in f if "openblas" in line}
    except OSError:  # another system: products then take what the environment says
        return
    for path in loaded:
        lib = ctypes.CDLL(path)
        for name in ("scipy_openblas_set_num_threads64_", "scipy_openblas_set_num_threads", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            if hasattr(lib, name):
                getattr(lib, name)(1)


class WordHash(dict):
    """word -> crc32, remembered up to a bound, then computed again."""

    def __missing__(self, w: bytes) -> int:
        h = zlib.crc32(w)
        if len(self) < 500_000:
            self[w] = h
        return h


def flat_hashes(token_lists: list[list[bytes]], cache: WordHash) -> tuple[np.ndarray, np.ndarray]:
    """crc32 of all words, end to end, and where each text begins (one more at the end)."""
    lengths = np.fromiter((len(x) for x in token_lists), np.int64, len(token_lists))
    starts = np.zeros(len(token_lists) + 1, np.int64)
    np.cumsum(lengths, out=starts[1:])
    get = cache.__getitem__
    flat = np.fromiter((get(w) for ws in token_lists for w in ws), np.uint64, int(starts[-1]))
    return flat, starts


def crc_rest(col: str, mod: int):
    """crc32(col as text) mod `mod`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % mod


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
