"""A calendar at day grain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def generate_calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row a day with 21 attributes, both ends included."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("day"))
    d = F.col("day")
    month, year, quarter, dow = F.month(d), F.year(d), F.quarter(d), F.dayofweek(d)
    half = F.when(month <= 6, 1).otherwise(2)
    return days.select(
        d, F.date_format(d, "yyyyMMdd").cast("int").alias("day_key"), year.alias("year"), month.alias("month"), F.dayofmonth(d).alias("day_of_month"),
        dow.alias("day_of_week"), F.dayofyear(d).alias("day_of_year"), F.weekofyear(d).alias("week_of_year"), quarter.alias("quarter"), half.alias("semester"),
        (year * 100 + month).alias("year_month"), F.concat(year.cast("string"), F.lit("Q"), quarter.cast("string")).alias("year_quarter"),
        F.concat(year.cast("string"), F.lit("S"), half.cast("string")).alias("year_semester"), F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "EEEE").alias("day_name"), F.lpad(month.cast("string"), 2, "0").alias("month_text"),
        F.trunc(d, "month").cast("date").alias("month_start"), F.last_day(d).alias("month_end"), (d == F.last_day(d)).alias("is_month_end"),
        dow.isin(1, 7).alias("is_weekend"), (~dow.isin(1, 7)).alias("is_weekday"))
