"""Runs of a book: each snapshot is written aside, counted, swapped in and recorded, and can fail alone."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.plans.book_engine import build_book
from tidemark.plans.book_spec import BookSpec
from tidemark.sources import files
from tidemark.sources.io import scratch_path, write_overwrite

MANIFEST = "run string, snapshot long, cutoff string, definition string, status string, rows long, error string, at timestamp"
#: Statuses of a snapshot that has landed; one without rows has, too, but is worth a look.
LANDED = ("SUCCESS", "EMPTY")

Build = Callable[[DataFrame, BookSpec, dict[int, str]], DataFrame]


def manifest(spark: SparkSession, target: str) -> DataFrame:
    """All that the runs have recorded at a book's path."""
    path = f"{target}/_manifest"
    return spark.read.schema(MANIFEST).parquet(path) if files.exists(spark, path) else spark.createDataFrame([], MANIFEST)


def latest(spark: SparkSession, target: str) -> DataFrame:
    """The last record of each snapshot."""
    w = Window.partitionBy("snapshot").orderBy(F.desc("at"), "status")
    return manifest(spark, target).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def definition(spec: BookSpec, cutoff: str) -> str:
    """What a snapshot's rows are made by, so that a changed book is built anew."""
    return hashlib.sha256(repr((spec, cutoff)).encode()).hexdigest()


def _record(spark: SparkSession, target: str, rows: list[tuple]) -> None:
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{target}/_manifest")


def _stage(spark: SparkSession, facts: DataFrame, spec: BookSpec, cutoffs: dict[int, str], build: Build) -> tuple[str, dict[int, int]]:
    """Write these snapshots aside; returns where, and their numbers of rows from the files' footers."""
    staged = scratch_path(spark)
    book = build(facts, spec, cutoffs)
    write_overwrite(book, staged, ["snapshot"])
    counts = spark.read.schema(book.schema).parquet(staged).groupBy("snapshot").count().collect()
    return staged, {int(r["snapshot"]): r["count"] for r in counts}


def _is_date(spark: SparkSession, cutoff: str) -> bool:
    """Whether a cut-off can be read at all, told without the facts."""
    try:
        spark.range(1).select(F.lit(cutoff).cast("timestamp")).collect()
    except Exception:  # the snapshot's own build tells what is wrong
        return False
    return True


def run_book(facts: DataFrame, spec: BookSpec, cutoffs: dict[int, str], target: str, again: bool = False, build: Build = build_book) -> DataFrame:
    """Build the snapshots of a book that haven't landed yet; returns this run's records.

    All pending snapshots are first built in one pass over the facts. If that
    fails, those whose cut-offs are dates are built in one pass, and what is then
    left each alone, so that one with a bad cut-off or bad events leaves the others to land. A snapshot is written aside and counted, takes the place of its
    partition folder by renaming, and only then is recorded; a run that broke off
    before a record is repeated for that snapshot by the next one. Snapshots
    landed with the same definition and cut-off are left alone unless ``again``.
    """
    spark, run = facts.sparkSession, uuid.uuid4().hex
    files.restore(spark, target)
    have = {r["snapshot"]: (r["status"], r["definition"]) for r in latest(spark, target).collect()}
    landed = lambda k, c: have.get(k, ("", ""))[0] in LANDED and have[k][1] == definition(spec, c)
    pending = {k: c for k, c in cutoffs.items() if again or not landed(k, c)}
    if not pending:
        return spark.createDataFrame([], MANIFEST)

    def commit(k: int, staged: str, n: int) -> None:
        files.swap(spark, staged, target, [f"snapshot={k}"])
        _record(spark, target, [(run, k, pending[k], definition(spec, pending[k]), "SUCCESS" if n else "EMPTY", n, None, datetime.now(timezone.utc))])

    def land(ks: list[int]) -> None:
        staged, counts = _stage(spark, facts, spec, {k: pending[k] for k in ks}, build)
        for k in ks:
            commit(k, staged, counts.get(k, 0))
        files.delete(spark, staged)

    def left() -> list[int]:
        done = {r["snapshot"] for r in manifest(spark, target).where(F.col("run") == run).collect()}
        return sorted(pending.keys() - done)

    try:
        land(sorted(pending))
    except Exception:  # whatever it is, the others go on, and those that fail are told
        dated = [k for k in left() if _is_date(spark, pending[k])]
        if 1 < len(dated) < len(left()):
            try:
                land(dated)
            except Exception:  # noqa: S110  # those that haven't landed follow one by one
                pass
        for k in left():
            try:
                land([k])
            except Exception as e:  # the record holds what went wrong with this snapshot
                _record(spark, target, [(run, k, pending[k], definition(spec, pending[k]), "FAILED", None, str(e)[:1000], datetime.now(timezone.utc))])
    return manifest(spark, target).where(F.col("run") == run)


def book_counts(spark: SparkSession, target: str) -> DataFrame:
    """(snapshot, rows, status): rows that lie at the path, beside the last record of each snapshot."""
    records = latest(spark, target).select("snapshot", "status")
    if not files.folders(spark, target):
        return records.select("snapshot", F.lit(0).cast("long").alias("rows"), "status")
    lie = spark.read.parquet(target).groupBy(F.col("snapshot").cast("long").alias("snapshot")).agg(F.count(F.lit(1)).alias("rows"))
    return records.join(lie, "snapshot", "full").select("snapshot", F.coalesce("rows", F.lit(0).cast("long")).alias("rows"), "status")


def book_rollup(book: DataFrame, segment: str, measures: dict[str, str]) -> DataFrame:
    """Rows for each (snapshot, segment), each snapshot and the whole book from one pass.

    ``measures`` names SQL aggregates. ``level`` tells the rows apart, as a null
    segment may also be a client's: segment, snapshot or total.
    """
    g = book.groupingSets([["snapshot", segment], ["snapshot"], []], "snapshot", segment)
    out = g.agg(F.grouping_id().alias("_g"), F.count(F.lit(1)).alias("n"), *(F.expr(e).alias(m) for m, e in measures.items()))
    level = F.when(F.col("_g") == 0, "segment").when(F.col("_g") == 1, "snapshot").otherwise("total")
    return out.withColumn("level", level).select("level", "snapshot", segment, "n", *measures)
