"""Joins, grouped statistics, windows, top-k and set operations on tables."""

from __future__ import annotations

import re
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.clean import LEAKAGE, rename_matching, select_with_prefix
from tidemark.operators.curves import exact_quantiles, global_rank, join_groups, prefix_sums, tile
from tidemark.sources.io import written

# ---- joins ----------------------------------------------------------------------


def join_dimensions(fact: DataFrame, dims: list[tuple[DataFrame, str, str, list[str]]]) -> DataFrame:
    """Left join each (dimension, fact key, dimension key, columns) that is used.

    Dimensions keep one row a key, or counts would fan out; key types must be
    equal, or nothing would match. Spark picks a broadcast where a dimension is
    small enough.
    """
    for dim, key, dim_key, columns in dims:
        kinds = fact.schema[key].dataType, dim.schema[dim_key].dataType
        if kinds[0] != kinds[1]:
            raise TypeError(f"{key} is {kinds[0].simpleString()}, {dim_key} is {kinds[1].simpleString()}")
        one = dim.dropDuplicates([dim_key]).select(F.col(dim_key).alias(f"_{dim_key}"), *columns)
        fact = fact.join(one, F.col(key) == F.col(f"_{dim_key}"), "left").drop(f"_{dim_key}")
    return fact


def consolidate(spine: DataFrame, sources: dict[str, DataFrame | None], keys: list[str], exclude: list[str] | None = None,
                leakage: list[str] | None = None) -> DataFrame:
    """Left join books to the spine on the keys; columns get their book's prefix, absent books are skipped.

    Columns whose names match a leakage pattern stay out.
    """
    out = spine
    for name, book in sources.items():
        if book is None:
            continue
        bad = [c for c in book.columns if any(re.search(p, c, re.I) for p in leakage or [])]
        part = select_with_prefix(book, name, [*keys, *(exclude or []), *bad])
        kept = book.select(*(F.col(k) for k in keys), *(F.col(c[len(name) + 1:]).alias(c) for c in part.columns))
        out = out.join(kept, keys, "left")
    return out


def seen_by(events: DataFrame, date: str, snapshots: dict[int, str], within_days: int | None = None) -> DataFrame:
    """Each event once for every snapshot at or after its date: a range join by array.

    The snapshots are few and known, so they are an array that each event
    filters and explodes; no join runs at all. With ``within_days`` only
    snapshots that many days after the event count.
    """
    all_of = F.array(*(F.struct(F.lit(k).alias("snapshot"), F.lit(d).cast("date").alias("ref_date")) for k, d in snapshots.items()))
    day = F.col(date).cast("date")

    def sees(s: Column) -> Column:
        ok = s["ref_date"] >= day
        return ok & (F.datediff(s["ref_date"], day) <= within_days) if within_days is not None else ok

    out = events.withColumn("_s", F.explode(F.filter(all_of, sees)))
    return out.withColumns({"snapshot": F.col("_s.snapshot"), "ref_date": F.col("_s.ref_date"), "days_before": F.datediff(F.col("_s.ref_date"), day)}).drop("_s")


def flag_combinations(df: DataFrame, flags: list[str]) -> DataFrame:
    """Counts of every combination of 0/1 flags, also those without rows."""
    counts = df.groupBy(*flags).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.createDataFrame(list(product((0, 1), repeat=len(flags))), ", ".join(f"{f} int" for f in flags))
    return every.join(counts, flags, "left").na.fill(0, ["n"])


def side_by_side(df: DataFrame, keys: list[str], model: str, models: list[str], values: list[str]) -> DataFrame:
    """Values of several models in one row for each key."""
    return df.groupBy(*keys).pivot(model, models).agg(*(F.first(v).alias(v) for v in values))


def scores_with_labels(scores: DataFrame, labels: DataFrame, keys: list[str]) -> DataFrame:
    """Scored rows that have a label, with it; a key's labels should be unique."""
    return scores.join(labels, keys)


def feature_store(spine: DataFrame, books: dict[str, DataFrame | None], scores: DataFrame | None, keys: list[str], score_prefix: str, to: str,
                  exclude: list[str] | None = None, at: Column | None = None) -> DataFrame:
    """The consolidated table: books with their prefixes, scores with theirs renamed, and ``processed_at``.

    Columns that match the leakage patterns stay out of books and scores alike.
    """
    out = consolidate(spine, books, keys, exclude, [LEAKAGE])
    if scores is not None:
        named = rename_matching(scores.select(*[c for c in scores.columns if not re.search(LEAKAGE, c, re.I)]), score_prefix, to)
        out = out.join(named, keys, "left")
    return out.withColumn("processed_at", at if at is not None else F.current_timestamp())


# ---- aggregates ------------------------------------------------------------------


def label_rate(df: DataFrame, label: str, by: list[str]) -> DataFrame:
    """total, bad, good, unlabeled and rate by group; a null label is not a good one."""
    y = F.col(label)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(y == 1).alias("bad"), F.count_if(y == 0).alias("good"),
        F.count_if(y.isNull()).alias("unlabeled"), F.avg(F.when(y.isin(0, 1), y)).alias("rate"))


def horizon_stats(df: DataFrame, by: list[str], days_before: str, value: str, horizons: list[int]) -> DataFrame:
    """count, avg, max and min of a value over several horizons in one pass."""
    out = []
    for h in horizons:
        v = F.when(F.col(days_before) <= h, F.col(value))
        out += [F.count(v).alias(f"n_{h}"), F.avg(v).alias(f"mean_{h}"), F.max(v).alias(f"max_{h}"), F.min(v).alias(f"min_{h}")]
    return df.groupBy(*by).agg(*out)


def engagement_ratios(df: DataFrame, short: str = "n_30", long: str = "n_360") -> DataFrame:
    """Monthly frequency over both horizons and their ratio, null without events in the long one."""
    a, b = F.col(short).cast("double"), F.col(long) / 12
    return df.withColumns({"monthly_short": a, "monthly_long": b, "engagement": F.try_divide(a, b)})


def percentile_columns(df: DataFrame, by: list[str], value: str, levels: list[float], accuracy: int | None = None) -> DataFrame:
    """p<percent> of a value by group, with its mean and number of rows: exact, or estimates of the given accuracy."""
    t = df.groupBy(*by).agg(F.avg(value).alias("mean"), F.count(F.lit(1)).alias("n"))
    if accuracy is None:
        found = exact_quantiles(df, {value: F.col(value)}, levels, by)
    else:
        found = df.groupBy(*by).agg(F.percentile_approx(F.col(value).cast("double"), levels, accuracy).alias("quantiles"))
    return join_groups(t, found, by, "left").select(*by, *(F.col("quantiles")[i].alias(f"p{round(q * 100)}") for i, q in enumerate(levels)), "mean", "n")


def crosstab(df: DataFrame, rows: str, column: str, values: list) -> DataFrame:
    return df.groupBy(rows).pivot(column, values).count().na.fill(0)


def delay_bucket(days: Column) -> Column:
    return F.when(days <= 0, "EM_DIA").when(days <= 5, "01_05").when(days <= 15, "06_15").when(days <= 30, "16_30").when(days > 30, "30_PLUS")


def delay_book(df: DataFrame, client: str, due: str, paid: str) -> DataFrame:
    """Per client: bills by delay, late share and delay statistics; unpaid bills count apart."""
    d = F.datediff(F.col(paid), F.col(due))
    rows = df.withColumns({"_d": d, "_b": delay_bucket(d)})
    buckets = ["EM_DIA", "01_05", "06_15", "16_30", "30_PLUS"]
    return rows.groupBy(client).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("_d") > 0).alias("n_late"), F.count_if(F.col("_d") == 0).alias("n_on_time"),
        F.count_if(F.col("_d") < 0).alias("n_early"), F.count_if(F.col("_d").isNull()).alias("n_unpaid"),
        *(F.count_if(F.col("_b") == b).alias(f"n_{b.lower()}") for b in buckets),
        (F.count_if(F.col("_d") > 0) * 100 / F.count("_d")).alias("late_percent"), F.avg("_d").alias("mean_delay"), F.max("_d").alias("max_delay"))


def delinquency_vs_payment(bills: DataFrame, payments: DataFrame, client: str, contract: str, due: str, open_value: str, first_bill: Column,
                           paid_client: str, paid_contract: str, paid_date: str) -> DataFrame:
    """Monthly by client and contract: open value, due dates, first-bill flag, paid flag and days late."""
    month = F.date_format(due, "yyyyMM").cast("int")
    a = bills.groupBy(F.col(client).alias("client"), F.col(contract).alias("contract"), month.alias("month")).agg(
        F.sum(open_value).alias("open_value"), F.min(F.col(due).cast("date")).alias("oldest_due"), F.max(F.col(due).cast("date")).alias("newest_due"),
        F.max(first_bill.cast("int")).alias("has_first_bill"))
    b = payments.groupBy(F.col(paid_client).alias("client"), F.col(paid_contract).alias("contract"), F.date_format(paid_date, "yyyyMM").cast("int").alias("month")).agg(
        F.min(F.col(paid_date).cast("date")).alias("first_paid"))
    out = a.join(b, ["client", "contract", "month"], "left")
    return out.withColumns({"paid": F.col("first_paid").isNotNull().cast("int"), "days_late": F.datediff("first_paid", "oldest_due")})


# ---- windows, top-k, sets -----------------------------------------------------------


def relative_bands(df: DataFrame, by: list[str], value: str, bands: int) -> DataFrame:
    """Add ``band`` 0..bands - 1 by the share of the group's rows with no greater value, nulls being the least.

    Rows are counted by (group, value) and the counts cumulated in parts of the
    value's range, so that no group's rows meet in one task.
    """
    counts = df.groupBy(*by, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("n"))
    placed = prefix_sums(counts, ["_v"], ["n"], by)
    band = F.least(F.floor((F.col("before_n") + F.col("n")) / F.col("total_n") * bands), F.lit(bands - 1))
    bands_of = placed.select(*by, "_v", band.alias("band"))
    return join_groups(df.withColumn("_v", F.col(value)), bands_of, [*by, "_v"]).drop("_v")


def score_tiles(df: DataFrame, score: str, key: str, tiles: int = 10, by: list[str] | None = None) -> DataFrame:
    """Add ``tile``, 1 the highest scores; over the whole table by global ranks, within groups by a window."""
    if by:
        w = Window.partitionBy(*by).orderBy(F.desc(score), key)
        return df.withColumn("tile", F.ntile(tiles).over(w))
    return global_rank(df, score, key).withColumn("tile", tile(F.col("rank"), F.col("n_rows"), tiles)).drop("rank", "n_rows")


def steady_sum(df: DataFrame, value: str) -> Column:
    """Sum of a column that doesn't hang on the order of its rows: doubles as decimals, and what is left of them."""
    if df.schema[value].dataType.typeName() not in ("double", "float"):
        return F.sum(value)
    x = F.col(value).cast("double")
    whole = F.coalesce(F.when(F.abs(x) < 1e18, x).try_cast("decimal(26,6)"), F.lit(0).cast("decimal(26,6)"))
    return F.sum(F.when(x.isNotNull(), whole)).cast("double") + F.sum(x - whole.cast("double"))


def share_of_total(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Sum of a value by group, its share, and the share cumulated from the greatest on.

    The sums are written once: read again, a sum of doubles may move in its last
    digits, and a group then lies in one part for the cumulation and in another
    for the parts' totals.
    """
    t = written(df.groupBy(*by).agg(steady_sum(df, value).alias("total")))
    t = prefix_sums(t.withColumn("_o", -F.col("total").cast("double")), ["_o", *by], ["total"])
    return t.select(*by, "total", (F.col("total") / F.col("total_total")).alias("share"), ((F.col("before_total") + F.col("total")) / F.col("total_total")).alias("cum_share"))


def until_share(df: DataFrame, by: list[str], value: str, limit: float = 0.9) -> DataFrame:
    """The greatest groups until their shares reach the limit, the crossing one included."""
    t = share_of_total(df, by, value)
    return t.where(F.col("cum_share") - F.col("share") < limit)


def rank_changes(df: DataFrame, feature: str, snapshot: str, value: str, limit: int = 5) -> DataFrame:
    """Rank of each feature within its snapshot, and by how much it changes over snapshots."""
    w = Window.partitionBy(snapshot).orderBy(F.desc(value), feature)
    r = df.withColumn("rank", F.row_number().over(w))
    return r.groupBy(feature).agg(F.min("rank").alias("best"), F.max("rank").alias("worst"), (F.max("rank") - F.min("rank")).alias("change")).withColumn(
        "unstable", F.col("change") > limit)


def top_values(df: DataFrame, columns: list[str], n: int = 10) -> DataFrame:
    """The n most frequent values of each column, as text, ties by value."""
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns)))
    counts = df.select(pairs.alias("x")).groupBy("x.column", "x.value").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("column").orderBy(F.desc("n"), F.asc_nulls_last("value"))
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def top_share(df: DataFrame, score: str, key: str, share: float) -> DataFrame:
    """Rows among the highest-scored share of all rows."""
    return global_rank(df, score, key).where(F.col("rank") <= F.floor(F.col("n_rows") * share))


def at_least(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= n).orderBy(F.desc("n"), key)


def timeline(df: DataFrame, key: str, value: object, date: str) -> DataFrame:
    return df.where(F.col(key) == value).orderBy(date)


def category_order(column: str, order: list[str]) -> Column:
    """Sort key for a custom order of categories, others last."""
    out = F.lit(len(order))
    for i, v in reversed(list(enumerate(order))):
        out = F.when(F.col(column) == v, i).otherwise(out)
    return out


def union_books(books: list[DataFrame]) -> DataFrame:
    """Union by name; columns that a book hasn't are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), books)


def row_counts(named: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, (df.agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("n")) for name, df in named.items()))


def snapshot_differences(df: DataFrame, snapshot: str, expected: list[int]) -> DataFrame:
    """Snapshots that are missing or unexpected."""
    want = df.sparkSession.createDataFrame([(s,) for s in expected], "snapshot int")
    have = df.select(F.col(snapshot).cast("int").alias("snapshot")).distinct()
    return want.exceptAll(have).withColumn("problem", F.lit("missing")).unionByName(have.join(want, "snapshot", "left_anti").withColumn("problem", F.lit("unexpected")))


def top_set_jaccard(df: DataFrame, item: str, snapshot: str, value: str, n: int) -> DataFrame:
    """Jaccard similarity of the top-n items of each snapshot and the next one."""
    w = Window.partitionBy(snapshot).orderBy(F.desc(value), item)
    sets = df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).groupBy(snapshot).agg(F.collect_set(item).alias("items"))
    pairs = sets.withColumn("next_items", F.lead("items").over(Window.orderBy(snapshot))).withColumn("next", F.lead(snapshot).over(Window.orderBy(snapshot)))
    both, either = F.size(F.array_intersect("items", "next_items")), F.size(F.array_union("items", "next_items"))
    return pairs.where("next is not null").select(snapshot, "next", (both / either).alias("jaccard"))


def set_overlap(df: DataFrame, a: Column, b: Column) -> DataFrame:
    """How many rows two conditions choose alone and together."""
    return df.agg(F.count_if(a & b).alias("both"), F.count_if(a & ~b).alias("only_a"), F.count_if(~a & b).alias("only_b"))
