"""Typing and cleansing of columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.curves import quantile_values

INTERNAL = "_"
# fixed value: names of columns that tell the label
LEAKAGE = r"VLR_FPD|TARGET_FPD|_LEAKAGE"


def safe_divide(a: Column, b: Column, fill: float | None = 0.0) -> Column:
    out = F.try_divide(a.cast("double"), b.cast("double"))
    return out if fill is None else F.coalesce(out, F.lit(fill))


def parse_stamp(c: Column) -> Column:
    """Timestamps like 01MAY2024:00:00:00; what doesn't parse is null."""
    return F.try_to_timestamp(F.initcap(c), F.lit("ddMMMyyyy:HH:mm:ss"))


def cast_by_metadata(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Select and cast the columns named, in their order; values that don't fit are null."""

    def one(name: str, kind: str) -> Column:
        kind = kind.lower()
        if kind in ("date", "timestamp", "datetime"):
            return parse_stamp(F.col(name)).cast("date" if kind == "date" else "timestamp").alias(name)
        return F.col(name).try_cast(kind).alias(name)

    return df.select(*(one(n, k) for n, k in kinds.items()))


def metadata_kinds(metadata: DataFrame, table: str) -> tuple[dict[str, str], list[str]]:
    """Types and primary key of a table from (table_name, column_name, type, primary_key); tiny."""
    rows = metadata.where(F.col("table_name") == table).collect()
    return {r["column_name"]: r["type"] for r in rows}, [r["column_name"] for r in rows if str(r["primary_key"]).lower() in ("1", "true", "s", "y")]


def type_cast(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Cast by kind: int, long, double, date (a time of midnight is cut), stamp, string (trimmed); other columns stay."""

    def one(c: Column, kind: str) -> Column:
        if kind == "date":
            return F.to_date(F.try_to_timestamp(F.initcap(F.regexp_replace(c, ":00:00:00$", "")), F.lit("ddMMMyyyy")))
        if kind == "stamp":
            return parse_stamp(c)
        if kind == "string":
            return F.trim(c)
        return c.try_cast(kind)

    return df.withColumns({n: one(F.col(n), k) for n, k in kinds.items() if n in df.columns})


def clean_strings(df: DataFrame) -> DataFrame:
    """Trim and upper-case every string column that isn't internal, in one projection."""
    return df.select(*(F.upper(F.trim(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) and not f.name.startswith(INTERNAL) else F.col(f.name)
                       for f in df.schema.fields))


def drop_internal(df: DataFrame) -> DataFrame:
    return df.drop(*(c for c in df.columns if c.startswith(INTERNAL)))


def select_with_prefix(df: DataFrame, prefix: str, exclude: list[str]) -> DataFrame:
    """All columns but the excluded ones (whatever their case), each with the prefix."""
    out = {x.lower() for x in exclude}
    return df.select(*(F.col(c).alias(f"{prefix}_{c}") for c in df.columns if c.lower() not in out))


def rename_matching(df: DataFrame, start: str, new_start: str) -> DataFrame:
    return df.toDF(*(new_start + c[len(start):] if c.startswith(start) else c for c in df.columns))


def downcast(df: DataFrame) -> DataFrame:
    """double to float, long to int where it fits; a value out of range is null."""
    kinds = {T.DoubleType(): "float", T.LongType(): "int"}
    return df.select(*(F.col(f.name).try_cast(kinds[f.dataType]).alias(f.name) if f.dataType in kinds else F.col(f.name) for f in df.schema.fields))


def filter_snapshots(df: DataFrame, column: str, snapshots: list[int]) -> DataFrame:
    return df.where(F.col(column).isin(snapshots))


def filter_approved(df: DataFrame, flag: str) -> DataFrame:
    return df.where(F.col(flag) == 1)


def snapshot_to_cutoff(snapshot: Column) -> Column:
    """First day of a yyyyMM month; null where it is none."""
    return F.to_date(F.try_to_timestamp(F.concat(snapshot.cast("string"), F.lit("01")), F.lit("yyyyMMdd")))


def validate_snapshot(snapshot: int) -> int:
    if not (1900 <= snapshot // 100 <= 2999 and 1 <= snapshot % 100 <= 12):
        raise ValueError(f"{snapshot} is not a month yyyyMM")
    return snapshot


def snapshot_of(date: Column) -> Column:
    return F.date_format(date, "yyyyMM").cast("int")


def flag_equals(c: Column, value: object) -> Column:
    return F.coalesce((c == value).cast("int"), F.lit(0))


def flag_like(c: Column, pattern: str) -> Column:
    return F.coalesce(c.like(pattern).cast("int"), F.lit(0))


def flag_in(c: Column, values: list) -> Column:
    return F.coalesce(c.isin(values).cast("int"), F.lit(0))


def group_rare(c: Column, keep: list, other: str = "OUTROS") -> Column:
    return F.when(c.isin(keep), c).otherwise(other)


def drop_empty_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.dropna(subset=keys)


def map_prefix(df: DataFrame, column: str, table: DataFrame, prefix: str, values: list[str], other: str = "OUTROS", width: int = 2) -> DataFrame:
    """Add the values of a small prefix table (one row a prefix) by the column's first characters."""
    small = table.select(F.col(prefix).alias("_p"), *values).dropDuplicates(["_p"])
    out = df.join(small, F.substring(F.col(column).cast("string"), 1, width) == F.col("_p"), "left").drop("_p")
    return out.na.fill(other, values)


def dates_to_day_offsets(df: DataFrame, reference: Column) -> DataFrame:
    """Each date column becomes <name>_days, its days before the reference."""
    dates = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))]
    return df.withColumns({f"{c}_days": F.datediff(reference, F.col(c)) for c in dates}).drop(*dates)


def missing_shares(df: DataFrame) -> dict[str, float]:
    row = df.agg(*(F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns)).first()
    return {c: row[c] or 0.0 for c in df.columns}


def drop_high_missing(df: DataFrame, limit: float = 0.75) -> DataFrame:
    """Drop columns with more than this share of nulls, told in one pass."""
    return df.drop(*(c for c, share in missing_shares(df).items() if share > limit))


def drop_low_cardinality(df: DataFrame) -> DataFrame:
    """Drop columns with one value or none: their least and greatest values are equal."""
    row = df.agg(*(F.coalesce(F.min(c) != F.max(c), F.lit(False)).alias(c) for c in df.columns)).first()
    return df.drop(*(c for c in df.columns if not row[c]))


def inf_to_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Infinite values and NaN become null."""
    return df.withColumns({c: F.when(~(F.isnan(c) | F.abs(c).eqNullSafe(float("inf"))), F.col(c)) for c in columns})


def impute_median(df: DataFrame, columns: list[str], fit_on: Column) -> DataFrame:
    """Fill nulls with exact medians of the rows of ``fit_on``; a column without any stays null."""
    medians = quantile_values(df.where(fit_on), {c: F.col(c) for c in columns}, [0.5])
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(medians[c][0]).cast("double")) for c in columns})


def impute_mode(df: DataFrame, columns: list[str], fit_on: Column) -> DataFrame:
    """Fill nulls with the most frequent value of the rows of ``fit_on``, the least one if tied."""
    row = df.where(fit_on).agg(*(F.expr(f"mode() within group (order by `{c}`)").alias(c) for c in columns)).first()
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(row[c])) for c in columns})


def temporal_split(snapshot: Column, train: list[int], oos: list[int], oot: list[int]) -> Column:
    """train, oos or oot by snapshot, null for others; the lists must not overlap."""
    every = [*train, *oos, *oot]
    if len(set(every)) < len(every):
        raise ValueError("a snapshot is in more than one split")
    return F.when(snapshot.isin(train), "train").when(snapshot.isin(oos), "oos").when(snapshot.isin(oot), "oot")


def tag_population(snapshot: Column, train: list[int]) -> Column:
    return F.when(snapshot.isin(train), "TREINO").otherwise("PRODUCAO")


def in_window(date: Column, start: str, end: str) -> Column:
    return F.when(date.between(F.lit(start).cast("date"), F.lit(end).cast("date")), 1).otherwise(0)


def dedup_latest(df: DataFrame, keys: list[str] | None, order: list[str] | None = None, ties: list[str] | None = None) -> DataFrame:
    """The latest row of each key by the order columns, ties by further columns.

    Without order columns any one row of a key stays, the least by ``ties`` or
    by all columns; without keys exact copies go.
    """
    if not keys:
        return df.dropDuplicates()
    rest = ties or [c for c in df.columns if c not in keys and c not in (order or [])]
    by = [F.desc_nulls_last(c) for c in order or []] + [F.asc_nulls_last(c) for c in rest]
    w = Window.partitionBy(*keys).orderBy(*(by or keys))
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def hash_split(key: Column, percent: int, salt: str = "split") -> Column:
    """A repeatable sample by key: true for about this percentage, its negation is the rest."""
    return hash_number(key, salt) % 100 < percent


def hash_number(key: Column, salt: str) -> Column:
    """A whole number of 32 bits from a key's text, which any engine with md5 gives as well."""
    return F.conv(F.substring(F.md5(F.concat(key.cast("string"), F.lit(f":{salt}"))), 1, 8), 16, 10).cast("long")
