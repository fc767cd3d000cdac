"""Point-in-time books for all snapshots in one pass over the facts.

An event counts for every snapshot whose cut-off lies after it. Instead of
reading the facts once for each snapshot, each event goes to the first snapshot
that sees it; mergeable states are aggregated by (client, first snapshot) and
cumulated over snapshots. A distinct value counts from its own first snapshot.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.book_spec import Agg, BookSpec


def first_snapshot(date: str, cutoffs: list[str]) -> Column:
    """Index of the first cut-off after the date, null if there is none."""
    chain = F.lit(None).cast("int")
    for i, c in reversed(list(enumerate(cutoffs))):
        chain = F.when(F.col(date) < F.lit(c).cast("timestamp"), i).otherwise(chain)
    return chain


def _states(a: Agg, date: str) -> dict[str, tuple[Column, str]]:
    """Partial states of an aggregate, and how they merge over snapshots."""
    x, on = F.expr(a.value), F.expr(a.where) if a.where else F.lit(True)
    n = F.count_if(on & x.isNotNull())
    value = F.when(on, x)
    number = F.when(on, x.cast("double"))
    match a.kind:
        case "count":
            return {"n": (F.count_if(on), "sum")}
        case "sum":
            return {"s": (F.sum(number), "sum")}
        case "avg":
            return {"n": (n, "sum"), "s": (F.sum(number), "sum")}
        case "stddev":
            return {"n": (n, "sum"), "s": (F.sum(number), "sum"), "q": (n * F.var_pop(number), "sum")}
        case "max" | "last_date":
            return {"m": (F.max(value), "max")}
        case "min" | "first_date":
            return {"m": (F.min(value), "min")}
        case "latest":
            return {"m": (F.max(F.struct(F.col(date).alias("d"), x.alias("v"))), "max")}
    raise ValueError(f"{a.name}: no kind {a.kind}")


def _final(a: Agg, c: str) -> Column:
    """The aggregate's value from its cumulated states, columns named c_*."""
    n, s, q, m = (F.col(f"{c}_{k}") for k in "nsqm")  # q: sum of squared deviations from the mean
    match a.kind:
        case "count":
            return n
        case "sum":
            return F.coalesce(s, F.lit(0.0))
        case "avg":
            return F.when(n > 0, s / n)
        case "stddev":
            # n * mean offset and its square, from the client's first mean
            d, e = F.col(f"{c}_d"), F.col(f"{c}_e")
            return F.when(n > 1, F.sqrt(F.greatest(q + e - d * d / n, F.lit(0.0)) / (n - 1)))
        case "latest":
            return m["v"]
    return m


def enrich(facts: DataFrame, spec: BookSpec) -> DataFrame:
    """Facts with the book's flags as 0/1 columns; a null condition is 0."""
    return facts.withColumns({f: F.coalesce(F.expr(f"({c})").cast("int"), F.lit(0)) for f, c in spec.flags.items()}) if spec.flags else facts


def derived_layers(spec: BookSpec) -> list[list[str]]:
    """The derived columns in as few layers as they take, each of columns of the layers before."""
    level: dict[str, int] = {}
    for name, expression in spec.derived.items():
        level[name] = 1 + max((level[w] for w in re.findall(r"\w+", expression) if w in level), default=-1)
    return [[n for n in level if level[n] == k] for k in range(max(level.values(), default=-1) + 1)]


def build_book(facts: DataFrame, spec: BookSpec, cutoffs: dict[int, str]) -> DataFrame:
    """(client, snapshot, cutoff, features): a row for each snapshot from the client's first event on.

    ``cutoffs`` maps snapshot labels to dates; an event on a cut-off's day isn't
    seen by it. Snapshots before a client's first event have no row.
    """
    labels = sorted(cutoffs, key=lambda k: cutoffs[k])
    dates = [cutoffs[k] for k in labels]
    client = spec.client
    # the last cut-off is a plain comparison with a literal, which reaches the scan
    seen = enrich(facts.where(F.col(spec.date) < F.lit(dates[-1]).cast("timestamp")), spec).withColumn("_at", first_snapshot(spec.date, dates))

    plain = [a for a in spec.aggregates if a.kind != "distinct"]
    counted = [a for a in spec.aggregates if a.kind == "distinct"]
    partial = {f"{a.name}_{k}": (agg, how) for a in plain for k, (agg, how) in _states(a, spec.date).items()}
    state = seen.groupBy(client, "_at").agg(F.count(F.lit(1)).alias("_rows"), *(agg.alias(c) for c, (agg, _) in partial.items()))
    merge = {c: how for c, (_, how) in partial.items()}
    if counted:
        # all distinct counts from one shuffle: (client, which, value) -> first snapshot
        pairs = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.expr(a.value).cast("string").alias("v")) for i, a in enumerate(counted))))
        firsts = seen.select(client, "_at", pairs.alias("p")).where("p.v is not null").groupBy(client, "p.i", "p.v").agg(F.min("_at").alias("_at"))
        news = firsts.groupBy(client, "_at").agg(*(F.count_if(F.col("i") == i).alias(f"{a.name}_n") for i, a in enumerate(counted)))
        state = state.join(news, [client, "_at"], "left")
        merge |= {f"{a.name}_n": "sum" for a in counted}

    # the squared deviations of snapshots merge around the client's first mean, so that no large squares cancel
    first = Window.partitionBy(client).orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    for a in (a for a in plain if a.kind == "stddev"):
        n, mean = F.col(f"{a.name}_n"), F.try_divide(f"{a.name}_s", f"{a.name}_n")
        off = mean - F.first(mean, ignorenulls=True).over(first)
        state = state.withColumns({f"{a.name}_d": n * off, f"{a.name}_e": n * off * off})
        merge |= {f"{a.name}_d": "sum", f"{a.name}_e": "sum"}
    so_far = Window.partitionBy(client).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    running = {c: {"sum": F.sum, "max": F.max, "min": F.min}[how](c).over(so_far).alias(c) for c, how in merge.items()}
    until = F.coalesce(F.lead("_at").over(Window.partitionBy(client).orderBy("_at")), F.lit(len(dates)))
    held = state.select(client, "_at", *running.values(), until.alias("_until"))
    # a state holds until the client's next snapshot with news
    rows = held.withColumn("_at", F.explode(F.sequence(F.col("_at"), F.col("_until") - 1)))
    # found anew in each layer: a filter has no generated code, and without it Spark would make one method of each wide
    # layer, too long for the JVM to compile, so that it is interpreted; with it the columns are split into short ones
    cutoff = F.get(F.filter(F.array(*map(F.lit, dates)), lambda _, i: i == F.col("_at")), 0).cast("date").alias("cutoff")
    out = rows.select(
        client, "_at", cutoff, *(_final(a, a.name).alias(a.name) for a in plain),
        *(F.coalesce(F.col(f"{a.name}_n"), F.lit(0)).alias(a.name) for a in counted))
    for layer in derived_layers(spec):
        out = out.select(*(c for c in out.columns if c != "cutoff"), cutoff, *(F.expr(spec.derived[name]).alias(name) for name in layer))
    return out.select(client, F.element_at(F.array(*map(F.lit, labels)), F.col("_at") + 1).alias("snapshot"), cutoff, *spec.features)


def build_book_by_snapshot(facts: DataFrame, spec: BookSpec, cutoffs: dict[int, str]) -> DataFrame:
    """The same book with one scan of the facts for each snapshot (the slow definition)."""
    parts = [build_book(facts, spec, {k: d}) for k, d in cutoffs.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
