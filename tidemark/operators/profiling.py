"""Column profiles, one aggregate for all columns of a kind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.curves import exact_quantiles, join_groups


def column_kind(kind: T.DataType) -> str:
    if isinstance(kind, T.NumericType):
        return "numeric"
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "date"
    if isinstance(kind, T.BooleanType):
        return "boolean"
    return "string" if isinstance(kind, T.StringType) else "other"


def column_kinds(df: DataFrame) -> dict[str, str]:
    return {f.name: column_kind(f.dataType) for f in df.schema.fields}


def of_kind(df: DataFrame, kind: str) -> list[str]:
    return [c for c, k in column_kinds(df).items() if k == kind]


def _unpivoted(df: DataFrame, columns: list[str], aggregates: dict[str, Column], names: list[str]) -> DataFrame:
    """One row of many aggregates named <stat>_<i> turned into a row for each column."""
    one = df.agg(*(a.alias(n) for n, a in aggregates.items()))
    rows = F.array(*(F.struct(F.lit(c).alias("column"), *(F.col(f"{n}_{i}").alias(n) for n in names)) for i, c in enumerate(columns)))
    return one.select(F.explode(rows).alias("x")).select("x.*")


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows, nulls, percent filled and a grade for each column."""
    columns = columns or df.columns
    aggs = {f"n_{i}": F.count(F.lit(1)) for i, _ in enumerate(columns)} | {f"n_null_{i}": F.count_if(F.col(c).isNull()) for i, c in enumerate(columns)}
    out = _unpivoted(df, columns, aggs, ["n", "n_null"])
    filled = (F.col("n") - F.col("n_null")) * 100 / F.col("n")
    return out.withColumn("filled", filled).withColumn("grade", F.when(F.col("filled") >= 99, "EXCELENTE").when(
        F.col("filled") >= 90, "BOM").when(F.col("filled") >= 70, "ATENCAO").otherwise("CRITICO"))


def cardinality_profile(df: DataFrame, columns: list[str] | None = None, exact: bool = False) -> DataFrame:
    """Distinct values of each column, their class, and whether it may be a key."""
    columns = columns or df.columns
    count = F.count_distinct if exact else (lambda c: F.approx_count_distinct(c, 0.02))
    aggs = {f"n_{i}": F.count(F.lit(1)) for i, _ in enumerate(columns)} | {f"n_distinct_{i}": count(F.col(c)) for i, c in enumerate(columns)}
    out = _unpivoted(df, columns, aggs, ["n", "n_distinct"])
    share = F.col("n_distinct") / F.col("n")
    kind = F.when(F.col("n_distinct") <= 1, "CONSTANTE").when(F.col("n_distinct") <= 10, "BAIXA").when(
        F.col("n_distinct") <= 100, "MEDIA").when(share > 0.95, "MUITO ALTA").otherwise("ALTA")
    return out.withColumns({"cardinality": kind, "may_be_key": share > 0.99, "is_constant": F.col("n_distinct") <= 1})


PERCENTS = [0.25, 0.5, 0.75, 0.9, 0.95, 0.99]


def numeric_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, sum, moments, range, percentiles, zeros, negatives and IQR fences of numeric columns."""
    columns = columns or of_kind(df, "numeric")
    aggs: dict[str, Column] = {}
    for i, c in enumerate(columns):
        v = F.col(c).cast("double")
        aggs |= {f"n_{i}": F.count(v), f"total_{i}": F.sum(v), f"mean_{i}": F.avg(v), f"std_{i}": F.stddev_samp(v), f"least_{i}": F.min(v), f"most_{i}": F.max(v),
                 f"n_zero_{i}": F.count_if(v == 0), f"n_negative_{i}": F.count_if(v < 0)}
    out = _unpivoted(df, columns, aggs, ["n", "total", "mean", "std", "least", "most", "n_zero", "n_negative"])
    quantiles = exact_quantiles(df, {c: F.col(c) for c in columns}, PERCENTS).withColumnRenamed("feature", "column")
    out = out.join(quantiles, "column", "left").withColumns({f"p{round(p * 100)}": F.col("quantiles")[i] for i, p in enumerate(PERCENTS)}).drop("quantiles")
    iqr = F.col("p75") - F.col("p25")
    return out.withColumns({"low_fence": F.col("p25") - 1.5 * iqr, "high_fence": F.col("p75") + 1.5 * iqr})


def outlier_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Values beyond the fences of each numeric column, by a second aggregate."""
    columns = columns or of_kind(df, "numeric")
    fences = {r["column"]: (r["low_fence"], r["high_fence"]) for r in numeric_profile(df, columns).collect()}  # a row for each column
    aggs: dict[str, Column] = {}
    for i, c in enumerate(columns):
        low, high = fences[c]
        v = F.col(c).cast("double")
        aggs |= {f"n_low_{i}": F.count_if(v < F.lit(low)), f"n_high_{i}": F.count_if(v > F.lit(high)), f"n_{i}": F.count(v)}
    out = _unpivoted(df, columns, aggs, ["n", "n_low", "n_high"])
    return out.withColumn("percent", F.try_divide((F.col("n_low") + F.col("n_high")) * 100.0, F.col("n").cast("double")))


def string_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    columns = columns or of_kind(df, "string")
    aggs: dict[str, Column] = {}
    for i, c in enumerate(columns):
        v, n = F.col(c), F.char_length(c)
        aggs |= {f"n_{i}": F.count(v), f"shortest_{i}": F.min(n), f"longest_{i}": F.max(n), f"mean_length_{i}": F.avg(n), f"n_empty_{i}": F.count_if(F.trim(v) == ""),
                 f"n_digits_{i}": F.count_if(v.rlike("^[0-9]+$")), f"n_letters_{i}": F.count_if(v.rlike("^[A-Za-z]+$"))}
    return _unpivoted(df, columns, aggs, ["n", "shortest", "longest", "mean_length", "n_empty", "n_digits", "n_letters"])


def date_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    columns = columns or of_kind(df, "date")
    aggs: dict[str, Column] = {}
    for i, c in enumerate(columns):
        d = F.col(c).cast("date")
        aggs |= {f"n_{i}": F.count(d), f"least_{i}": F.min(d), f"most_{i}": F.max(d), f"span_{i}": F.datediff(F.max(d), F.min(d)),
                 f"n_months_{i}": F.count_distinct(F.date_format(d, "yyyyMM")), f"n_years_{i}": F.count_distinct(F.year(d))}
    return _unpivoted(df, columns, aggs, ["n", "least", "most", "span", "n_months", "n_years"])


def month_histogram(df: DataFrame, date: str) -> DataFrame:
    return df.groupBy(F.date_format(date, "yyyyMM").alias("month")).agg(F.count(F.lit(1)).alias("n"))


def exact_duplicates(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows, distinct rows and copies, over all or some columns."""
    t = df.groupBy(*(columns or df.columns)).agg(F.count(F.lit(1)).alias("n"))
    return t.agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct"), (F.sum("n") - F.count(F.lit(1))).alias("n_copies"))


def date_agreement(df: DataFrame, dates: list[str]) -> DataFrame:
    """Counts of every combination of which date columns are present and which agree with the first."""
    flags = {f"{d}_present": F.col(d).isNotNull().cast("int") for d in dates}
    flags |= {f"{d}_equal": F.coalesce((F.col(d).cast("date") == F.col(dates[0]).cast("date")).cast("int"), F.lit(0)) for d in dates[1:]}
    return df.select(*(e.alias(n) for n, e in flags.items())).groupBy(*flags).agg(F.count(F.lit(1)).alias("n"))


def label_summary(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """Mean, deviation and median of each column by label."""
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns)))
    t = df.select(label, pairs.alias("x")).groupBy("x.column", label).agg(
        F.count("x.v").alias("n"), F.avg("x.v").alias("mean"), F.stddev_samp("x.v").alias("std"))
    medians = exact_quantiles(df, {c: F.col(c) for c in columns}, [0.5], [label]).select(label, F.col("feature").alias("column"), F.col("quantiles")[0].alias("median"))
    return join_groups(t, medians, ["column", label], "left")


def monthly_activity(df: DataFrame, date: str, client: str, value: str, start: str, end: str) -> DataFrame:
    """Active clients and volumes by month, and whether the month is in the study window."""
    month = F.trunc(F.col(date), "month").cast("date")
    t = df.groupBy(month.alias("month")).agg(F.count_distinct(client).alias("n_clients"), F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return t.withColumn("inside", F.col("month").between(F.lit(start).cast("date"), F.lit(end).cast("date")).cast("int"))


def enriched_metadata(df: DataFrame, table: str, n_top: int = 5) -> DataFrame:
    """A row for each column: kind, role, quality, suggested aggregates and features, top values."""
    kinds = df.sparkSession.createDataFrame([(c, k) for c, k in column_kinds(df).items()], "column string, kind string")
    out = kinds.join(null_profile(df).drop("n"), "column").join(cardinality_profile(df, exact=True), "column")
    role = F.when(F.col("is_constant"), "constant").when(F.col("kind") == "date", "date").when(F.col("may_be_key"), "key").when(
        (F.col("kind") == "numeric") & (F.col("n_distinct") > 10), "measure").otherwise("category")
    suggest = F.when(F.col("role") == "measure", "sum, avg, max, min, stddev").when(F.col("role") == "date", "min, max, datediff").when(
        F.col("role") == "key", "count distinct").when(F.col("role") == "category", "count by value, mode").otherwise("none")
    out = out.withColumn("role", role).withColumns({
        "aggregates": suggest, "use_in_book": (F.col("role") != "constant") & (F.col("grade") != "CRITICO"), "table": F.lit(table),
        "feature_prefix": F.concat(F.when(F.col("role") == "measure", "val_").when(F.col("role") == "date", "days_").otherwise("qty_"), F.lower("column"))})
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in df.columns)))
    counts = df.select(pairs.alias("x")).groupBy("x.column", "x.value").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("column").orderBy(F.desc("n"), F.asc_nulls_last("value"))
    top = counts.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n_top).groupBy("column").agg(
        F.array_sort(F.collect_list(F.struct("_r", "value"))).alias("_t")).select("column", F.transform("_t", lambda t: t["value"]).alias("top_values"))
    return out.join(top, "column", "left")
