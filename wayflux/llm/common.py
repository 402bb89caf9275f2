"""Shared plumbing: stored stages, columns added by Arrow functions, folds."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayflux.session import shared_folder


BATCH_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of BATCH_BYTES at most from here on in this session, however long the texts are."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(str(spark.conf.get(name)).lower().removesuffix("b")) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


class Stages:
    """Written tables of one run in the folder that the cluster shares (`spark.checkpoint.dir`).

    `keep` writes a DataFrame and reads it back, which cuts the lineage and survives lost executors; `drop`
    removes a table that is no longer read. What is left goes when the session ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        bound_batches(spark)
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        path, files = self._files(self.root)
        files.deleteOnExit(path)

    def _files(self, where: str):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(where)
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        where = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(where)
        return self.spark.read.schema(df.schema).parquet(where)

    def drop(self, *names: str) -> None:
        for name in names:
            path, files = self._files(f"{self.root}/{name}")
            files.delete(path, True)


def free_name(df: DataFrame, wanted: str) -> str:
    """`wanted`, with underscores added until no column of `df` has that name (in any case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def release() -> None:
    """Give the memory that this process has freed back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def freeing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """`run` for mapInArrow; when its task ends, the worker gives freed memory back to the system.

    Workers are kept for later tasks, and several of them wait beside the one at work; without this each
    holds on to the most that it ever needed.
    """

    def freed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return freed


def add_column(df: DataFrame, name: str, kind: T.DataType, make: Callable[[], Callable[[pa.RecordBatch], pa.Array]], drop: Iterable[str] = ()) -> DataFrame:
    """`df` with a column computed per Arrow batch, without the columns in `drop`.

    `make` runs once in each task and returns the function of a batch. A column that has the
    name already is replaced.
    """
    bound_batches(df.sparkSession)
    kept = [f for f in df.schema.fields if f.name not in set(drop) and f.name != name]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for b in batches:
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), fn(b)], names=[*names, name])

    return df.mapInArrow(freeing(run), T.StructType([*kept, T.StructField(name, kind)]))


def crc_fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo `folds`; 0 for a null key."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(folds)), F.lit(0))


def label_sample(labels: DataFrame, label: str, rows: int, where: Column, id_col: str = "doc_id") -> DataFrame:
    """At most about `rows` labelled ids, (id, label), chosen by a hash of the id.

    Rows without an id or a label do not count; an id with several labels takes the largest.
    """
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label).isNotNull() & where).groupBy(id_col).agg(F.max(F.col(label).cast("int")).alias("label"))
    n = known.count()
    if n <= rows:
        return known
    return known.filter(F.pmod(F.xxhash64(F.col(id_col), F.lit(17)), F.lit(1 << 30)) < int((1 << 30) * rows / n))
