"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import math
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabspark.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """(doc_id long, text string) only: other columns cannot clash, a null text is empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written as a table in the shared checkpoint folder and read back: its lineage is cut there.

    A written table also tells its real size.  ``checkpoint()`` keeps the size
    estimate of the plan that it cuts, and in a loop of joins these estimates
    multiply without end.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"tables/{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts (one scan, one row to the driver)."""
    return int(docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0)


def buckets_for(total_bytes: int, bytes_each: int) -> int:
    """Groups so that each holds about ``bytes_each``; grows with the data, at least 1."""
    return max(1, math.ceil(total_bytes / bytes_each))


def tasks_for(spark: SparkSession, groups: int) -> int:
    """Shuffle partitions for ``groups`` groups: one each, but no fewer than the session's setting."""
    return max(groups, int(spark.conf.get("spark.sql.shuffle.partitions")))


def bucket_of(n: int, *keys: Column) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n).cast("long")).cast("int")


def private(name: str, docs: DataFrame) -> str:
    """A column name that ``docs`` does not have, in any spelling."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` (for ``mapInArrow``), after which the worker gives freed memory back.

    Workers live on between tasks; what they keep would add to every later stage of an executor.
    """
    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
            if trim:
                trim(0)

    return own
