"""A compiler of data-quality checks: one scan and one shuffle for all checks of a table.

Checks say what they need of a table: its rows, missing or repeated keys, rows of
a snapshot, null rates. What they need is computed together, by grouping sets
over the key and snapshot columns with the whole table as one of the sets; checks
of the schema are settled at once. The tables' one-row results stand side by side,
so that checks may also compare tables, and become one row a check.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clean import LEAKAGE
from tidemark.operators.quality import type_fits


def _graded(ok: Column, other: str) -> Column:
    return F.when(F.coalesce(ok, F.lit(False)), "PASS").otherwise(other)


@dataclass
class Table:
    """A table under check; each method adds a check to its suite."""

    suite: Suite
    df: DataFrame
    entity: str
    number: int
    #: Column groups by which rows are counted, row conditions that are counted, and snapshots' expected values.
    sets: list[tuple[str, ...]] = field(default_factory=list)
    counts: dict[str, Column] = field(default_factory=dict)
    expected: dict[str, list[int]] = field(default_factory=dict)

    # ---- what checks refer to -------------------------------------------------

    def _fact(self, name: str) -> Column:
        return F.col(f"t{self.number}_{name}")

    @property
    def rows(self) -> Column:
        return self._fact("rows")

    def _counted(self, condition: Column) -> Column:
        name = f"c{len(self.counts)}"
        self.counts[name] = condition
        return self._fact(name)

    def _group(self, *columns: str) -> int:
        if columns not in self.sets:
            self.sets.append(columns)
        return self.sets.index(columns)

    def _add(self, layer: str, check: str, ok: Column | bool, detail: Column | str, other: str = "FAIL") -> Table:
        status = _graded(ok, other) if isinstance(ok, Column) else F.lit("PASS" if ok else other)
        text = detail.cast("string") if isinstance(detail, Column) else F.lit(detail)
        self.suite.results.append(F.struct(*(F.lit(v).alias(n) for n, v in (("layer", layer), ("entity", self.entity), ("check", check))), status.alias("status"), text.alias("detail")))
        return self

    # ---- checks of rows -------------------------------------------------------

    def has_rows(self, layer: str) -> Table:
        return self._add(layer, "has rows", self.rows > 0, self.rows)

    def rows_at_most(self, layer: str, other: Table) -> Table:
        """As many rows as the layer below, or fewer."""
        return self._add(layer, "rows at most the source's", self.rows <= other.rows, self.rows - other.rows)

    def rows_equal(self, layer: str, other: Table) -> Table:
        return self._add(layer, "rows equal the spine's", self.rows == other.rows, self.rows - other.rows)

    def keys_not_null(self, layer: str, keys: list[str]) -> Table:
        missing = self._counted(reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys)))
        return self._add(layer, "key not null", missing == 0, missing)

    def keys_unique(self, layer: str, keys: list[str]) -> Table:
        repeated = self._fact(f"repeated{self._group(*keys)}")
        return self._add(layer, "key unique", repeated == 0, repeated)

    def null_rates(self, layer: str, columns: list[str], limit: float = 0.50) -> Table:
        for c in columns:
            rate = F.round(F.try_divide(self._counted(F.col(c).isNull()).cast("double"), self.rows), 4)
            self._add(layer, f"null rate of {c}", rate < limit, rate, "WARN")
        return self

    def snapshots_are(self, layer: str, snapshot: str, expected: list[int]) -> Table:
        """No expected snapshot is missing, and no other one there; of unexpected ones the number and the least are told."""
        g = self._group(snapshot)
        self.expected[snapshot] = sorted(expected)
        missing = F.array_except(F.array(*map(F.lit, sorted(expected))), self._fact(f"found{g}"))
        strange = self._fact(f"strange{g}")
        told = F.concat(F.lit("missing "), F.concat_ws(",", missing), F.lit("; unexpected "), strange.cast("string"), F.coalesce(F.concat(F.lit(", first "), self._fact(f"first{g}")), F.lit("")))
        return self._add(layer, "snapshots as expected", (F.size(missing) == 0) & (strange == 0), told)

    def snapshots_balanced(self, layer: str, snapshot: str, least: float = 0.10) -> Table:
        """The smallest snapshot has at least this share of the largest one's rows."""
        g = self._group(snapshot)
        share = F.round(F.try_divide(self._fact(f"least{g}").cast("double"), self._fact(f"most{g}")), 4)
        return self._add(layer, "snapshots balanced", share >= least, share, "WARN")

    def volume_near(self, layer: str, expected: int, tolerance: float = 0.30) -> Table:
        return self._add(layer, "volume near expected", F.abs(self.rows - expected) <= tolerance * expected, self.rows, "WARN")

    # ---- checks of the schema -------------------------------------------------

    def types_conform(self, layer: str, declared: dict[str, str]) -> Table:
        found = {f.name: f.dataType.simpleString() for f in self.df.schema.fields}
        bad = [f"{c}: {found.get(c, 'absent')} for {d}" for c, d in declared.items() if c not in found or not type_fits(d, found[c])]
        return self._add(layer, "types conform", not bad, "; ".join(bad) or "all")

    def columns_present(self, layer: str, columns: list[str], check: str = "columns present") -> Table:
        missing = sorted(set(columns) - set(self.df.columns))
        return self._add(layer, check, not missing, ", ".join(missing) or "all")

    def audit_columns(self, layer: str, columns: list[str] | None = None) -> Table:
        return self.columns_present(layer, columns or ["_execution_id", "_ingested_at"], "audit columns")

    def column_count(self, layer: str, expected: int) -> Table:
        return self._add(layer, "column count", len(self.df.columns) == expected, f"{len(self.df.columns)} of {expected}")

    def column_is_int(self, layer: str, column: str) -> Table:
        kind = self.df.schema[column].dataType
        return self._add(layer, "snapshot is int", isinstance(kind, (T.IntegerType, T.LongType)), kind.simpleString())

    def no_leakage(self, layer: str, pattern: str = LEAKAGE) -> Table:
        bad = [c for c in self.df.columns if re.search(pattern, c)]
        return self._add(layer, "no leakage columns", not bad, ", ".join(bad) or "none")

    def prefixes_present(self, layer: str, prefixes: list[str]) -> Table:
        missing = [p for p in prefixes if not any(c.startswith(p) for c in self.df.columns)]
        return self._add(layer, "prefixes present", not missing, ", ".join(missing) or "all")

    # ---- compiling --------------------------------------------------------------

    def facts(self) -> DataFrame:
        """One row with all that the table's checks refer to: one scan, and one shuffle if there are keys or snapshots."""
        columns = list(dict.fromkeys(c for s in self.sets for c in s))
        rows = self.df.select(*(F.col(c).alias(f"k{i}") for i, c in enumerate(columns)), *(c.cast("int").alias(n) for n, c in self.counts.items()))
        sums = [F.count(F.lit(1)).alias("n"), *(F.sum(n).alias(n) for n in self.counts)]
        name = f"t{self.number}_"
        if not columns:
            return rows.agg(*sums).select(F.col("n").alias(f"{name}rows"), *(F.coalesce(n, F.lit(0)).alias(name + n) for n in self.counts))
        at = {c: i for i, c in enumerate(columns)}
        keys = [f"k{i}" for i in range(len(columns))]
        grouped = rows.groupingSets([[], *([f"k{at[c]}" for c in s] for s in self.sets)], *keys).agg(F.grouping_id().alias("g"), *sums)

        def of(columns_in: tuple[str, ...]) -> Column:
            """The rows of one grouping set: a bit is set for each column that is not in it."""
            return F.col("g") == sum(1 << (len(columns) - 1 - i) for c, i in at.items() if c not in columns_in)

        whole = of(())
        out = [F.coalesce(F.max(F.when(whole, F.col(c))), F.lit(0)).alias(name + to) for c, to in (("n", "rows"), *((c, c) for c in self.counts))]
        for i, s in enumerate(self.sets):
            own = of(s)
            out += [F.count_if(own & (F.col("n") > 1)).alias(f"{name}repeated{i}"), F.min(F.when(own, F.col("n"))).alias(f"{name}least{i}"), F.max(F.when(own, F.col("n"))).alias(f"{name}most{i}")]
            if len(s) == 1 and s[0] in self.expected:
                value = F.col(f"k{at[s[0]]}").cast("int")
                known = F.coalesce(value.isin(self.expected[s[0]]), F.lit(False))
                out += [F.collect_set(F.when(own & known, value)).alias(f"{name}found{i}"), F.count_if(own & ~known).alias(f"{name}strange{i}"),
                        F.min(F.when(own & ~known, value.cast("string"))).alias(f"{name}first{i}")]
        return grouped.agg(*out)


class Suite:
    """Checks of several tables, compiled into one result: layer, entity, check, status, detail."""

    def __init__(self) -> None:
        self.tables: list[Table] = []
        self.results: list[Column] = []

    def table(self, df: DataFrame, entity: str) -> Table:
        self.tables.append(Table(self, df, entity, len(self.tables)))
        return self.tables[-1]

    def result(self) -> DataFrame:
        """A row for each check, in order; every table is scanned once."""
        # a row each
        one = reduce(lambda a, b: a.join(F.broadcast(b)), (t.facts() for t in self.tables))
        return one.select(F.explode(F.array(*self.results)).alias("x")).select("x.*")
