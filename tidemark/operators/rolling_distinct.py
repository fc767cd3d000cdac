"""Distinct counts over rolling horizons, exactly or by sketches that are made once a day and merge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Registers of a sketch, as a power of two; the relative standard error is about 1.04 / sqrt(2**LG).
LG = 12
ERROR = 1.04 / 2 ** (LG / 2)


def daily_sketches(df: DataFrame, by: list[str], date: str, values: dict[str, str], lg: int = LG) -> DataFrame:
    """(by, day, one sketch a value): what later days' windows need of the rows; a new day adds its own only."""
    sketches = [F.hll_sketch_agg(F.col(column).cast("string"), lg).alias(name) for name, column in values.items()]
    return df.where(F.col(date).isNotNull()).groupBy(*by, F.to_date(date).alias("day")).agg(*sketches)


def _windows(cutoffs: dict[int, str], horizons: list[int], day: str):
    """(snapshot, horizon) of the windows that a day is in: up to the cut-off's day, and no more than ``horizon`` days before it."""
    found = [
        F.when(F.datediff(F.lit(c).cast("date"), F.col(day)).between(0, h), F.struct(F.lit(k).cast("long").alias("snapshot"), F.lit(h).alias("horizon")))
        for k, c in cutoffs.items() for h in horizons]
    return F.explode(F.filter(F.array(*found), lambda x: x.isNotNull()))


def sketched_counts(daily: DataFrame, by: list[str], names: list[str], cutoffs: dict[int, str], horizons: list[int]) -> DataFrame:
    """(by, snapshot, horizon, estimates) from daily sketches; they merge on the way to the shuffle and after it."""
    rows = daily.withColumn("_w", _windows(cutoffs, horizons, "day"))
    return rows.groupBy(*by, F.col("_w.snapshot").alias("snapshot"), F.col("_w.horizon").alias("horizon")).agg(
        *(F.hll_sketch_estimate(F.hll_union_agg(n)).alias(n) for n in names))


def exact_counts(df: DataFrame, by: list[str], date: str, values: dict[str, str], cutoffs: dict[int, str], horizons: list[int]) -> DataFrame:
    """The same exactly: a value counts in a window by its last day before the cut-off, for all values and windows in one shuffle.

    A value is in the window of a horizon if its last day up to the cut-off is, so
    the rows first shrink to the last days by (value, interval between cut-offs).
    """
    days = df.where(F.col(date).isNotNull()).select(*by, F.to_date(date).alias("_day"), F.explode(F.array(*(
        F.struct(F.lit(n).alias("name"), F.col(c).cast("string").alias("v")) for n, c in values.items()))).alias("_x")).where("_x.v is not null")
    order = sorted(cutoffs.items(), key=lambda x: x[1])
    first = F.coalesce(*(F.when(F.col("_day") <= F.lit(c).cast("date"), i) for i, (_, c) in enumerate(order)))
    last = days.withColumn("_at", first).where("_at is not null").groupBy(*by, "_x.name", "_x.v", "_at").agg(F.max("_day").alias("_day"))
    rows = last.withColumn("_w", _windows(cutoffs, horizons, "_day")).select(*by, "name", "v", "_w")
    counts = rows.groupBy(*by, "_w", "name", "v").agg(F.lit(1).alias("one")).groupBy(*by, "_w").agg(*(F.count_if(F.col("name") == n).alias(n) for n in values))
    return counts.select(*by, F.col("_w.snapshot").alias("snapshot"), F.col("_w.horizon").alias("horizon"), *values)


def compared(df: DataFrame, by: list[str], date: str, values: dict[str, str], cutoffs: dict[int, str], horizons: list[int], lg: int = LG) -> DataFrame:
    """Exact counts beside the estimates, with the relative error of each (``<name>_error``)."""
    exact = exact_counts(df, by, date, values, cutoffs, horizons)
    near = sketched_counts(daily_sketches(df, by, date, values, lg), by, list(values), cutoffs, horizons)
    near = near.select(*by, "snapshot", "horizon", *(F.col(n).alias(f"{n}_estimate") for n in values))
    joined = exact.join(near, [*by, "snapshot", "horizon"])
    return joined.withColumns({f"{n}_error": F.abs(F.try_divide(F.col(f"{n}_estimate") - F.col(n), F.col(n))) for n in values})
