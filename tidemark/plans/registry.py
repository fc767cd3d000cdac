"""Queries over the star-schema tables, each with the SQL that defines its rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Added before rounding, so that exact halves don't hang on the order of a sum.
NUDGE = 3.1e-7

Tables = Callable[[str], DataFrame]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    return lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None, name: str | None = None):
    """Register a function of the tables, with the SQL of the same rows if there is one."""

    def register(f: Callable[[Tables], DataFrame]):
        key = name or f.__name__

        def run(spark: SparkSession, sf_dir: str, f=f) -> DataFrame:
            return f(tables(spark, sf_dir))

        QUERIES[key] = run
        if sql:
            ORACLE[key] = sql
        return f

    return register


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles rounded, without negative zeros; dates and times as text; whole numbers as long."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        kind = f.dataType.typeName()
        if kind in ("double", "float", "decimal"):
            c = F.round(c.cast("double") + F.lit(NUDGE), digits) + F.lit(0.0)
        elif kind in ("date", "timestamp", "timestamp_ntz"):
            c = F.date_format(c, "yyyy-MM-dd")
        elif kind in ("integer", "short", "byte"):
            c = c.cast("long")
        out.append(c.alias(f.name))
    return df.select(*out)


def shown(sql: str, digits: int = 4, **kinds: str) -> str:
    """SQL with its columns brought to the form of ``rounded``; kinds: d double, i whole, t date, s as is."""
    forms = {"d": f"round(cast({{c}} as double) + {NUDGE}, {digits}) + 0.0", "i": "cast({c} as bigint)", "t": "strftime({c}, '%Y-%m-%d')", "s": "{c}"}
    return "select " + ", ".join(f"{forms[k].format(c=c)} as {c}" for c, k in kinds.items()) + f" from ({sql}) shown"
