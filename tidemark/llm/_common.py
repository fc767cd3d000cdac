"""What the training-data operators share: scratch tables and Arrow helpers."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.io import scratch_path as scratch_dir


def materialize(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage without depending on any executor staying alive. The table
    stays until ``tidemark.sources.io.clear_scratch``.
    """
    spark = df.sparkSession
    path = scratch_dir(spark)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def quoted(name: str) -> str:
    """A column name as Spark reads it literally."""
    return "`" + name.replace("`", "``") + "`"


def as_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct, whatever their names."""
    return F.struct(*(F.col(quoted(c)).alias(c) for c in df.columns))


def of_row(row: str, names: list[str]) -> list[Column]:
    """The columns of such a struct."""
    return [F.col(f"{row}.{quoted(c)}").alias(c) for c in names]


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


#: Keys that a broadcast may hold: about 50 MB on an executor.
FEW_KEYS = 1_000_000


def with_keys(df: DataFrame, keys: DataFrame, column: str, few: int = FEW_KEYS) -> DataFrame:
    """Inner join with a table of keys, which is counted first.

    Up to ``few`` keys are broadcast, so that rows of ``df`` without one are left
    out where they are read; more are joined by a shuffle of both sides.
    """
    return df.join(F.broadcast(keys) if keys.count() <= few else keys, column)


def without_keys(df: DataFrame, keys: DataFrame, column: str, few: int = FEW_KEYS) -> DataFrame:
    """Rows whose key isn't in a table of keys; counted and joined like ``with_keys``. Null keys stay."""
    return df.join(F.broadcast(keys) if keys.count() <= few else keys, column, "left_anti")


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The text column with nulls as empty strings."""
    return [t or "" for t in batch.column(column).to_pylist()]


def byte_slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches at about ``limit`` bytes of a text column, a row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for at, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, at - start)
                start, held = at, 0
            held += size + 1
        if held:
            yield batch.slice(start)
