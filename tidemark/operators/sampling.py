"""Samples of an exact size by the order of a hash, without sorting a stratum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.clean import hash_number

#: Leading bits of the hash by which rows are counted; a stratum's boundary lies within one of these parts.
BITS = 16


def exact_sample(df: DataFrame, key: str, strata: list[str] | None = None, percent: int | None = None, size: int | None = None, salt: str = "sample", bits: int = BITS) -> DataFrame:
    """The rows with the least hashes of their key in each stratum: floor(percent % of its rows), or ``size`` of them.

    The same rows as the first ones by (hash, key). Rows are counted by stratum and
    leading bits of the hash; these counts merge, and cumulated they tell which
    parts are in the sample whole. Only the part in which a stratum's sample ends
    is put in order, about 2**-bits of its rows. Of rows with one key any may be
    the last ones. Null keys have no hash and are never chosen, nor counted; a null
    stratum is one as well.
    """
    if (percent is None) == (size is None):
        raise ValueError("a sample has either a percentage or a size")
    strata = strata or []
    names = [f"_s{i}" for i in range(len(strata))]
    h = hash_number(F.col(key), salt)
    rows = df.where(F.col(key).isNotNull()).withColumns({**{n: F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for n, c in zip(names, strata)}, "_h": h, "_part": F.shiftright(h, 32 - bits)})
    counts = rows.groupBy(*names, "_part").agg(F.count(F.lit(1)).alias("_n"))
    # parts of a stratum, 2**bits at most; without strata they are few enough for one task
    along = Window.partitionBy(*names).orderBy("_part")
    wanted: Column = F.lit(size).cast("long") if size is not None else F.floor(F.sum("_n").over(Window.partitionBy(*names)) * F.lit(percent) / 100).cast("long")
    parts = counts.withColumns({"_upto": F.sum("_n").over(along), "_k": wanted})
    parts = parts.where(F.col("_upto") - F.col("_n") < F.col("_k")).select(*names, "_part", F.when(F.col("_upto") > F.col("_k"), F.col("_k") - F.col("_upto") + F.col("_n")).alias("_some"))
    found = rows.join(parts, [*names, "_part"])
    inside = found.where("_some is null").select(*df.columns)
    order = Window.partitionBy(*names, "_part").orderBy("_h", key)
    edge = found.where("_some is not null").withColumn("_rn", F.row_number().over(order)).where("_rn <= _some").select(*df.columns)
    return inside.unionByName(edge)


def adaptive_sample(df: DataFrame, key: str, share: float = 0.1, most: int = 1_000_000, salt: str = "42") -> DataFrame:
    """A table of more than ``most`` rows by a sample of ``share`` of them, ``most`` at most; a smaller one whole."""
    n = df.count()
    return exact_sample(df, key, size=min(int(n * share), most), salt=salt) if n > most else df
