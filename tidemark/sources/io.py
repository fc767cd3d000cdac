"""Reading, landing and writing tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import files

RUN_LOG = "execution_id string, schema string, table string, started_at timestamp, ended_at timestamp, status string, rows long, error string"


@dataclass(frozen=True)
class Source:
    """Where a table comes from and where it lands."""

    name: str
    path: str
    format: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()


@dataclass(frozen=True)
class TableStore:
    """Paths of layered tables: root/layer/schema/table."""

    root: str
    layer: str

    def path(self, schema: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{self.layer}/{schema}/{table}"


def read_source(spark: SparkSession, source: Source) -> DataFrame:
    return spark.read.format(source.format).options(**source.options).load(source.path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """A table in a format that this Spark can read; csv has a header unless told otherwise."""
    defaults = {"header": "true"} if fmt == "csv" else {}
    return spark.read.format(fmt).options(**defaults | options).load(path)


def read_columns(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Only the named columns, so that the scan reads no others."""
    return spark.read.parquet(path).select(*columns)


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Characters that Parquet names may not hold become underscores, in one projection."""
    return df.toDF(*(re.sub(r"[ ,;{}()\n\t=]", "_", c) for c in df.columns))


#: Where a session's scratch tables lie; set by the first of them.
SCRATCH = "tidemark.scratch.root"


def scratch_path(spark: SparkSession) -> str:
    """A new path in the session's scratch folder.

    That is inside the folder that driver and executors share and the cluster
    names in ``spark.checkpoint.dir``; where that is unset on a local master it is a
    temporary one, elsewhere an error.
    """
    root = spark.conf.get(SCRATCH, None)
    if not root:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            master = spark.sparkContext.master
            if master != "local" and not master.startswith("local["):
                raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
            shared = "file://" + tempfile.mkdtemp(prefix="tidemark-")
            spark.conf.set("spark.checkpoint.dir", shared)
        root = f"{shared.rstrip('/')}/scratch-{uuid.uuid4().hex}"
        spark.conf.set(SCRATCH, root)
    return f"{root}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The rows as a table of the scratch folder, so that all that reads them sees the same ones."""
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete the session's scratch tables; DataFrames that still read them can't be run any more."""
    root = spark.conf.get(SCRATCH, None)
    if root:
        files.delete(spark, root)
        spark.conf.unset(SCRATCH)


def with_audit(df: DataFrame, execution_id: str, at: Column | None = None) -> DataFrame:
    """Add _execution_id and _ingested_at."""
    return df.withColumns({"_execution_id": F.lit(execution_id), "_ingested_at": at if at is not None else F.current_timestamp()})


def write_overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_replace_partition(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace only the partitions that the rows belong to; the others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def append_run_log(spark: SparkSession, path: str, rows: list[tuple]) -> None:
    spark.createDataFrame(rows, RUN_LOG).coalesce(1).write.mode("append").parquet(path)


def ingest_batch(spark: SparkSession, sources: list[Source], store: TableStore, schema: str, log_path: str | None = None) -> DataFrame:
    """Land every source with audit columns; one that fails doesn't stop the others.

    Rows are counted from the footers of the files that were written: no second
    pass over the rows, and nothing that stays with the session. Returns the run
    log of this batch.
    """
    from datetime import datetime, timezone

    run = uuid.uuid4().hex
    rows = []
    for source in sources:
        began = datetime.now(timezone.utc)
        try:
            df = with_audit(sanitize_columns(read_source(spark, source)), run)
            path = store.path(schema, source.name)
            write_overwrite(df, path, list(source.partition_by))
            outcome = ("SUCCESS", spark.read.schema(df.schema).parquet(path).count(), None)
        except Exception as e:  # the log holds what went wrong with this source
            outcome = ("FAILED", None, str(e)[:1000])
        rows.append((run, schema, source.name, began, datetime.now(timezone.utc), *outcome))
    if log_path:
        append_run_log(spark, log_path, rows)
    return spark.createDataFrame(rows, RUN_LOG)


def create_external_view(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> None:
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} USING {fmt} OPTIONS (path '{path}')")


def register_views(spark: SparkSession, paths: dict[str, str]) -> None:
    for name, path in paths.items():
        spark.read.parquet(path).createOrReplaceTempView(name)


def lookup_view(df: DataFrame, name: str, columns: list[str]) -> None:
    """A view of the named columns only, for lookups by key."""
    df.select(*columns).createOrReplaceTempView(name)


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the source, and those of the target whose keys it hasn't.

    Null keys match each other. The source's keys should be unique; the result
    goes to a new path, as Parquet has no merge.
    """
    match = None
    for k in keys:
        one = target[k].eqNullSafe(source[k])
        match = one if match is None else match & one
    return target.join(source, match, "left_anti").unionByName(source, allowMissingColumns=True)


def write_final_features(df: DataFrame, path: str, features: list[str], keys: list[str], label: str, partition_by: str) -> None:
    columns = list(dict.fromkeys([*keys, partition_by, *features, label]))
    write_overwrite(df.select(*columns), path, [partition_by])


def build_key_dimension(df: DataFrame, key: str, name: str = "key_id") -> DataFrame:
    """Distinct non-blank keys with a stable 64-bit id of their text; ``key_collisions`` tells whether two keys share one."""
    text = F.trim(F.col(key).cast("string"))
    return df.where(text.isNotNull() & (text != "")).select(F.col(key)).distinct().withColumn(name, F.xxhash64(key))


def key_collisions(dimension: DataFrame, key: str, name: str = "key_id") -> DataFrame:
    """Ids that stand for several keys; of n keys about n * n / 2**65 are to be expected."""
    return dimension.groupBy(name).agg(F.min(key).alias("a"), F.max(key).alias("b")).where("a != b")
