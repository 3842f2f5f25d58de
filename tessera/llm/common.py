"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path
from tessera.sources.tables import table

__all__ = ["table", "saved", "drop_saved", "let", "texts_of", "word_pattern", "Registry"]

#: Words of the contracts: anything but the ASCII space, tab, LF, VT, FF, CR.
word_pattern = "[^\\x20\\x09-\\x0D]+"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Registry:
    """Queries and their DuckDB SQL, filled by the query modules."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracle: dict[str, str] = {}

    def __call__(self, name: str, sql: str | None = None):
        def put(fn):
            self.queries[name] = fn
            if sql is not None:
                self.oracle[name] = sql
            return fn
        return put


REGISTRY = Registry()


@contextmanager
def _shuffles_removed(spark: SparkSession):
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts lineage like ``checkpoint()`` but columnar and compressed; the shuffle
    files of the job that wrote it are removed once the table stands.  The
    table goes when :func:`drop_saved` is called or the session ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with _shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    out = spark.read.schema(df.schema).parquet(path)
    out._tessera_path = path
    return out


def drop_saved(*frames: DataFrame) -> None:
    """Delete tables made by :func:`saved` that no later step reads."""
    for df in frames:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df._tessera_path)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A lambda variable is bound to the computed value, so no optimizer rule can
    copy the expression into the loops of ``body``.
    """
    return F.transform(F.array(value), body)[0]


def texts_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the ``n + 1`` offsets (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that ``column`` holds about ``limit`` bytes at most (or one row)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            done = size[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(size, done + limit, side="right")))
            yield batch.slice(at, end - at)
            at = end
