"""Data-quality checks with one shape of result: layer, entity, check, status, detail."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clean import LEAKAGE

RESULT = "layer string, entity string, check string, status string, detail string"


def _said(spark: SparkSession, layer: str, entity: str, check: str, ok: bool, detail: str, other: str = "FAIL") -> DataFrame:
    """A result that the schema alone decides."""
    return spark.createDataFrame([(layer, entity, check, "PASS" if ok else other, detail)], RESULT)


def _counted(df: DataFrame, layer: str, entity: str, check: str, value: Column, ok: Column, other: str = "FAIL") -> DataFrame:
    """A result from one aggregate over the rows."""
    v = df.agg(value.alias("_v"))
    return v.select(F.lit(layer).alias("layer"), F.lit(entity).alias("entity"), F.lit(check).alias("check"),
                    F.when(F.coalesce(ok, F.lit(False)), "PASS").otherwise(other).alias("status"), F.col("_v").cast("string").alias("detail"))


def has_rows(df: DataFrame, layer: str, entity: str) -> DataFrame:
    return _counted(df.limit(1), layer, entity, "has rows", F.count(F.lit(1)), F.col("_v") > 0)


def row_count_at_most(df: DataFrame, other: DataFrame, layer: str, entity: str) -> DataFrame:
    """As many rows as the layer below, or fewer."""
    both = df.select(F.lit(1).alias("s")).unionByName(other.select(F.lit(-1).alias("s")))
    return _counted(both, layer, entity, "rows at most the source's", F.coalesce(F.sum("s"), F.lit(0)), F.col("_v") <= 0)


def row_count_equals(df: DataFrame, other: DataFrame, layer: str, entity: str) -> DataFrame:
    both = df.select(F.lit(1).alias("s")).unionByName(other.select(F.lit(-1).alias("s")))
    return _counted(both, layer, entity, "rows equal the spine's", F.coalesce(F.sum("s"), F.lit(0)), F.col("_v") == 0)


def keys_not_null(df: DataFrame, keys: list[str], layer: str, entity: str) -> DataFrame:
    missing = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))
    return _counted(df, layer, entity, "key not null", F.count_if(missing), F.col("_v") == 0)


def keys_unique(df: DataFrame, keys: list[str], layer: str, entity: str) -> DataFrame:
    return _counted(df.groupBy(*keys).count().where("count > 1"), layer, entity, "key unique", F.count(F.lit(1)), F.col("_v") == 0)


#: Types that a declared type may have come as, besides itself.
WIDER = {"int": {"bigint", "float", "double"}, "bigint": {"float", "double"}, "float": {"double"}, "date": {"timestamp", "timestamp_ntz"},
         "timestamp": {"date", "timestamp_ntz"}}


def type_fits(declared: str, found: str) -> bool:
    declared = declared.lower()
    if declared.startswith(("varchar", "char", "string")):
        return found == "string"
    if declared.startswith("decimal"):
        return found.startswith("decimal")
    declared = {"long": "bigint", "integer": "int", "datetime": "timestamp"}.get(declared, declared)
    return found == declared or found in WIDER.get(declared, set())


def types_conform(df: DataFrame, declared: dict[str, str], layer: str, entity: str) -> DataFrame:
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    bad = [f"{c}: {found.get(c, 'absent')} for {d}" for c, d in declared.items() if c not in found or not type_fits(d, found[c])]
    return _said(df.sparkSession, layer, entity, "types conform", not bad, "; ".join(bad) or "all")


def columns_present(df: DataFrame, columns: list[str], layer: str, entity: str, check: str = "columns present") -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    return _said(df.sparkSession, layer, entity, check, not missing, ", ".join(missing) or "all")


def audit_columns(df: DataFrame, layer: str, entity: str, columns: list[str] | None = None) -> DataFrame:
    return columns_present(df, columns or ["_execution_id", "_ingested_at"], layer, entity, "audit columns")


def column_count(df: DataFrame, expected: int, layer: str, entity: str) -> DataFrame:
    return _said(df.sparkSession, layer, entity, "column count", len(df.columns) == expected, f"{len(df.columns)} of {expected}")


def column_is_int(df: DataFrame, column: str, layer: str, entity: str) -> DataFrame:
    kind = df.schema[column].dataType
    return _said(df.sparkSession, layer, entity, "snapshot is int", isinstance(kind, (T.IntegerType, T.LongType)), kind.simpleString())


def snapshots_are(df: DataFrame, snapshot: str, expected: list[int], layer: str, entity: str) -> DataFrame:
    """Missing and unexpected snapshots, the distinct ones being few."""
    have = F.array_sort(F.collect_set(F.col(snapshot).cast("int")))
    want = F.array(*map(F.lit, sorted(expected)))
    wrong = F.concat_ws(",", F.array_sort(F.array_union(F.array_except(have, want), F.array_except(want, have))))
    return _counted(df.select(snapshot).distinct(), layer, entity, "snapshots as expected", wrong, F.col("_v") == "")


def no_leakage(df: DataFrame, layer: str, entity: str, pattern: str = LEAKAGE) -> DataFrame:
    bad = [c for c in df.columns if re.search(pattern, c)]
    return _said(df.sparkSession, layer, entity, "no leakage columns", not bad, ", ".join(bad) or "none")


def prefixes_present(df: DataFrame, prefixes: list[str], layer: str, entity: str) -> DataFrame:
    missing = [p for p in prefixes if not any(c.startswith(p) for c in df.columns)]
    return _said(df.sparkSession, layer, entity, "prefixes present", not missing, ", ".join(missing) or "all")


def snapshots_balanced(df: DataFrame, snapshot: str, layer: str, entity: str, least: float = 0.10) -> DataFrame:
    """The smallest snapshot has at least this share of the largest one's rows."""
    counts = df.groupBy(snapshot).agg(F.count(F.lit(1)).alias("n"))
    return _counted(counts, layer, entity, "snapshots balanced", F.round(F.min("n") / F.max("n"), 4), F.col("_v") >= least, "WARN")


def volume_near(df: DataFrame, expected: int, layer: str, entity: str, tolerance: float = 0.30) -> DataFrame:
    return _counted(df, layer, entity, "volume near expected", F.count(F.lit(1)), F.abs(F.col("_v") - expected) <= tolerance * expected, "WARN")


def partitioned_by(spark: SparkSession, path: str, column: str, layer: str, entity: str) -> DataFrame:
    """Whether the table's files lie in folders named by the column."""
    outside = [f for f in spark.read.parquet(path).inputFiles() if f"/{column}=" not in f]
    return _said(spark, layer, entity, "partitioned", not outside, str(len(outside)))


def null_rates(df: DataFrame, columns: list[str], layer: str, entity: str, limit: float = 0.50) -> DataFrame:
    """A result for each column from one aggregate."""
    one = df.agg(*(F.round(F.avg(F.col(c).isNull().cast("double")), 4).alias(c) for c in columns))
    rows = F.explode(F.array(*(F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in columns)))
    return one.select(rows.alias("x")).select(
        F.lit(layer).alias("layer"), F.lit(entity).alias("entity"), F.concat(F.lit("null rate of "), "x.c").alias("check"),
        F.when(F.col("x.v") < limit, "PASS").otherwise("WARN").alias("status"), F.col("x.v").cast("string").alias("detail"))


def run_suite(results: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


def summarise(results: DataFrame) -> DataFrame:
    """Counts by status, pass rate and overall status."""
    n = {s: F.count_if(F.col("status") == s) for s in ("PASS", "FAIL", "WARN", "SKIP")}
    out = results.agg(F.count(F.lit(1)).alias("n"), *(c.alias(f"n_{s.lower()}") for s, c in n.items()))
    return out.withColumns({
        "pass_rate": F.col("n_pass") / F.col("n"), "overall": F.when(F.col("n_fail") > 0, "FAIL").when(F.col("n_warn") > 0, "WARN").otherwise("PASS")})
