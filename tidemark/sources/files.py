"""Folders of a shared store, through the file systems that Spark itself is set up with."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder; the one it goes to has no such entry yet."""
    fs, where = _at(spark, path)
    _, there = _at(spark, to)
    fs.mkdirs(there.getParent())
    if not fs.rename(where, there):
        raise OSError(f"{path} can't be renamed to {to}")


def folders(spark: SparkSession, path: str, depth: int = 1) -> list[str]:
    """Names of the visible folders ``depth`` levels below, with / between levels; none if the path isn't there."""
    fs, where = _at(spark, path)
    if not depth or not fs.exists(where):
        return [] if depth else [""]
    names = sorted(s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory())
    names = [n for n in names if not n.startswith(("_", "."))]
    return names if depth == 1 else [f"{n}/{x}" for n in names for x in folders(spark, f"{path}/{n}", depth - 1)]


REPLACED = "_replaced"


def restore(spark: SparkSession, target: str, depth: int = 1) -> list[str]:
    """Put partitions back that a swap had set aside when it broke off; returns those it did.

    A partition whose new folder had already come stays new.
    """
    aside = f"{target}/{REPLACED}"
    if not exists(spark, aside):
        return []
    back = []
    for run in _children(spark, aside):
        for name in folders(spark, f"{aside}/{run}", depth):
            if not exists(spark, f"{target}/{name}"):
                move(spark, f"{aside}/{run}/{name}", f"{target}/{name}")
                back.append(name)
    delete(spark, aside)
    return back


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, where = _at(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(where)]


def swap(spark: SparkSession, staged: str, target: str, names: list[str]) -> None:
    """Replace these partition folders of ``target`` by those of ``staged``; one that isn't staged goes.

    Old folders are set aside by renaming, the new ones come by renaming, then
    the old ones go, so that a reader misses a partition for the time between two
    renames at most, and ``restore`` can undo what broke off.
    """
    run = uuid.uuid4().hex
    for name in names:
        if exists(spark, f"{target}/{name}"):
            move(spark, f"{target}/{name}", f"{target}/{REPLACED}/{run}/{name}")
        if exists(spark, f"{staged}/{name}"):
            move(spark, f"{staged}/{name}", f"{target}/{name}")
    delete(spark, f"{target}/{REPLACED}/{run}")
