"""Helpers shared by the corpus operators: text rules, scratch tables, Arrow slices."""

from __future__ import annotations

import ctypes
import functools
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import checkpoint_dir

WHITE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z only; other letters keep their case."""
    return F.translate(c, UPPER, LOWER)


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/llm-{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, and
    whatever was not deterministic in it is fixed from here on."""
    path = scratch_path(df.sparkSession, tag)
    df.write.option("compression", compression).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete materialised tables that no plan still to be run reads."""
    for t in tables:
        jvm = t.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(t._scratch)
        path.getFileSystem(t.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def byte_slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``limit`` text bytes (one row at least)."""
    n = batch.num_rows
    if n == 0:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False),
                       dtype=np.int64)
    ends, start = np.cumsum(sizes), 0
    while start < n:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def utf8(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The column's texts as UTF-8 bytes, null as empty."""
    return [b if b is not None else b"" for b in batch.column(column).cast(pa.binary()).to_pylist()]


def give_back() -> None:
    """Return what this process's allocators hold free (Arrow's, and glibc's where there is one) to the system."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


Batches = Iterator[pa.RecordBatch]


def tidy(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run`` of a ``mapInArrow`` whose worker gives its free memory back when the task ends: Spark keeps workers for
    later tasks, and what they hold counts as the executor's while others work."""
    @functools.wraps(run)
    def task(batches: Batches) -> Batches:
        yield from run(batches)
        give_back()

    return task


def doc_hash(c: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(parts))


def frequent_items(rows: DataFrame, column: str, support: float, parts: int = 64) -> list[str]:
    """Every value of a string column that holds at least ``support`` of the rows, and some others;
    ``parts / support`` values at most.  Misra-Gries counters (Spark's frequent-items sketch, whose size bounds
    the count error below ``support``) run over ``parts`` parts of the input: a value frequent in the whole is
    frequent in one part at least, so no task has to merge all counters."""
    k = int(np.ceil(1 / support))
    size = 1 << int(np.ceil(np.log2(4 * k)))
    tops = (rows.where(F.col(column).isNotNull())
            .select(F.col(column).alias("__item"), F.pmod(F.spark_partition_id(), F.lit(parts)).alias("__part"))
            .groupBy("__part").agg(F.expr(f"approx_top_k(__item, {k}, {size})").alias("__top"), F.count("__item").alias("__n")))
    found = (tops.select("__n", F.explode("__top").alias("__t")).where(F.col("__t.count") >= F.col("__n") * support / 2)
             .where(F.col("__t.count") > 1).select("__t.item").distinct())
    return [r["item"] for r in found.collect()]
