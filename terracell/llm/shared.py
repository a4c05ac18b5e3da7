"""What the operators share: the shared folder, written tables, checked broadcasts."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import functools
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast only when it was counted and has at most so many (narrow) rows.
BROADCAST_ROWS = 1_000_000

#: ASCII white space, as every contract here defines it.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor and the driver share: spark.checkpoint.dir.

    Only where the session names none (local tests) a temporary folder is
    made and set as the session's checkpoint folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = Path(tempfile.mkdtemp(prefix="terracell-")).as_uri()
        spark.conf.set("spark.checkpoint.dir", named)
    return named


#: Folders of written tables that are still there; they go when the program ends.
_left: dict[str, SparkSession] = {}


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df once to the shared folder and read it back.

    This cuts the lineage: a lost executor costs no recomputation beyond the
    table, and several readers do not scan the source again. A table that only
    feeds other written tables is given to ``discard`` after them; the rest,
    which results read lazily, goes when the program ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/terracell/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _left[path] = spark
    out.written_at = path
    return out


def _removed(path: str) -> None:
    spark = _left.pop(path, None)
    if spark is not None and spark.sparkContext._jsc is not None:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def discard(*tables: DataFrame) -> None:
    """Deletes tables that ``written`` returned and that nothing reads any more."""
    for table in tables:
        _removed(table.written_at)


@atexit.register
def _discard_all() -> None:
    with contextlib.suppress(Exception):  # the session may have ended before
        for path in list(_left):
            _removed(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if a count shows that it has few rows, else df for a shuffle join.

    df should be a written table, so that the count is cheap.
    """
    return F.broadcast(df) if df.count() <= rows else df


#: Keys with more than this share of all rows are hot; there are fewer of them, which bounds their broadcast.
HOT_SHARE = 1_000


def share_join(rows: DataFrame, keyed: DataFrame, on: list[str], total: int, how: str = "inner") -> DataFrame:
    """rows joined to keyed, which has for each key its number of rows, ``weight``, of ``total``, on all of the key's rows.

    Hot keys meet their row by broadcast, where their rows are; the others in a
    shuffle join, where no key has more than total / HOT_SHARE rows. keyed is
    read three times, so it is a written table or an aggregate, whose exchange
    Spark reuses.
    """
    hot = F.col("weight") * HOT_SHARE > total
    few = F.broadcast(keyed.filter(hot).drop("weight"))
    rest = rows.join(few.select(*on), on, "left_anti").join(keyed.filter(~hot).drop("weight"), on, how)
    return rows.join(few, on).unionByName(rest)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: Text that a Python worker works on at a time.
SLICE_BYTES = 2 << 20


def slices(batches: Iterator[pa.RecordBatch], column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that a slice has at most so many bytes of the column, or is a single longer row."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        first, held = 0, 0
        for row, size in enumerate(sizes.tolist()):
            if row > first and held + size > most:
                yield batch.slice(first, row - first)
                first, held = row, 0
            held += size
        if first < batch.num_rows:
            yield batch.slice(first)


def release() -> None:
    """Gives freed memory back to the system: workers live on between tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(f: Callable) -> Callable:
    """A function over an iterator of batches that releases its memory when it ends."""

    @functools.wraps(f)
    def run(batches):
        try:
            yield from f(batches)
        finally:
            release()

    return run
