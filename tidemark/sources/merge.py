"""Merging rows into a partitioned table by rewriting only the partitions that they touch."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import files
from tidemark.sources.io import scratch_path, write_overwrite

#: How Spark names the folder of a null partition value.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _same(a: DataFrame, b: DataFrame, columns: list[str]) -> Column:
    return reduce(lambda x, y: x & y, (a[c].eqNullSafe(b[c]) for c in columns))


def _values(folder: str) -> tuple[str | None, ...]:
    """The partition values that a folder's name stands for."""
    found = (unquote(level.partition("=")[2]) for level in folder.split("/"))
    return tuple(None if v == NULL_FOLDER else v for v in found)


def _in(columns: list[str], values: set[tuple[str | None, ...]]) -> Column:
    """Whether a row is of one of these partitions; a plain condition on partition columns, so others aren't listed."""
    if len(columns) == 1:
        name, some = columns[0], [v for (v,) in values if v is not None]
        within = F.col(name).cast("string").isin(some)
        return within | F.col(name).isNull() if len(some) < len(values) else within
    key = F.concat_ws("\x01", *(F.coalesce(F.col(c).cast("string"), F.lit("\x02")) for c in columns))
    return key.isin(["\x01".join("\x02" if v is None else v for v in value) for value in values])


def touched_partitions(target: DataFrame, source: DataFrame, keys: list[str], partition_by: list[str]) -> set[tuple[str | None, ...]]:
    """Partition values (as text) that a merge has to rewrite: where the source's rows go, and where rows with their keys lie.

    Reads keys and partition columns of the target only, and of those keys that
    are partition columns only the source's partitions. There are as many results
    as partitions at most.
    """
    columns = [F.col(c).cast("string").alias(c) for c in partition_by]
    goes = {tuple(r) for r in source.select(*columns).distinct().collect()}
    if set(partition_by) <= set(keys):
        return goes
    lie = target.select(*dict.fromkeys([*keys, *partition_by]))
    wanted = source.select(*keys).distinct()
    lie = lie.join(wanted, _same(lie, wanted, keys), "left_semi")
    return goes | {tuple(r) for r in lie.select(*columns).distinct().collect()}


def merge_into(spark: SparkSession, path: str, source: DataFrame, keys: list[str], partition_by: list[str]) -> list[str]:
    """Update and insert: rows of ``source`` replace those with equal keys of the Parquet table at ``path``.

    Copy on write: the new content of the touched partitions is written aside and
    then takes their places by renaming; files of other partitions aren't read
    beyond their keys and stay as they are. A row whose partition changes leaves
    its old one, and a partition that loses its last row goes. Null keys match
    each other; the source's keys should be unique. A table that isn't there yet is
    written. Columns that only one side has are null in the other's rows. Returns the
    folders of the partitions that were touched.
    """
    depth = len(partition_by)
    files.restore(spark, path, depth)
    present = files.folders(spark, path, depth)
    if not present:
        write_overwrite(source, path, partition_by)
        return files.folders(spark, path, depth)
    kinds = {f.name: f.dataType for f in source.schema.fields}
    # partition values come back with the source's types, whatever their folders look like
    target = spark.read.parquet(path)
    target = target.withColumns({c: F.col(c).cast(kinds[c]) for c in partition_by})
    touched = touched_partitions(target, source, keys, partition_by)
    old = target.where(_in(partition_by, touched))
    kept = old.join(source, _same(old, source, keys), "left_anti")
    staged = scratch_path(spark)
    write_overwrite(kept.unionByName(source, allowMissingColumns=True), staged, partition_by)
    names = sorted({n for n in present if _values(n) in touched} | set(files.folders(spark, staged, depth)))
    files.swap(spark, staged, path, names)
    files.delete(spark, staged)
    return names
