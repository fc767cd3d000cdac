"""What a feature book holds: a declaration that compiles to columns or to SQL."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Agg:
    """One aggregate of a book.

    kind: count, sum, avg, max, min, stddev, first_date, last_date, latest
    (value of the last event), distinct. ``value`` and ``where`` are SQL
    expressions over the enriched fact; ``where`` limits the rows. Sums and
    counts of no rows are 0, the other kinds null.
    """

    name: str
    kind: str
    value: str = "1"
    where: str | None = None


@dataclass(frozen=True)
class BookSpec:
    """A book per (client, snapshot) over the events before each cut-off.

    ``flags`` are 0/1 columns named by SQL conditions, ``derived`` expressions
    over aggregates, in order (later ones may use earlier ones); both see
    ``cutoff``, the snapshot's date, where they need it.
    """

    client: str
    date: str
    aggregates: list[Agg]
    flags: dict[str, str] = field(default_factory=dict)
    derived: dict[str, str] = field(default_factory=dict)

    @property
    def features(self) -> list[str]:
        return [a.name for a in self.aggregates] + list(self.derived)


# ---- builders: short names for the shapes that books repeat ------------------

def equals(prefix: str, column: str, codes: dict[str, str]) -> dict[str, str]:
    """Flags that a column equals each of the codes."""
    return {f"{prefix}_{name}": f"{column} = '{code}'" for name, code in codes.items()}


def flag_counts(flags: list[str], prefix: str = "qty") -> list[Agg]:
    return [Agg(f"{prefix}_{f}", "count", where=f"{f} = 1") for f in flags]


def flag_sums(flags: list[str], value: str, prefix: str = "val") -> list[Agg]:
    return [Agg(f"{prefix}_{f}", "sum", f"coalesce({value}, 0)", f"{f} = 1") for f in flags]


def value_stats(name: str, value: str, kinds: str = "sum avg max") -> list[Agg]:
    """Statistics over a zero-filled value."""
    names = {"sum": "total", "avg": "mean"}
    return [Agg(f"{name}_{names.get(k, k)}", k, f"coalesce({value}, 0)") for k in kinds.split()]


def least_positive(name: str, value: str) -> Agg:
    return Agg(name, "min", value, f"{value} > 0")


def distinct_counts(columns: dict[str, str]) -> list[Agg]:
    return [Agg(f"n_{name}", "distinct", column) for name, column in columns.items()]


def ratio(a: str, b: str, digits: int | None = None) -> str:
    text = f"cast({a} as double) / nullif(cast({b} as double), 0)"
    return text if digits is None else f"round({text}, {digits})"


def rates(names: list[str], total: str, prefix: str = "rate", digits: int | None = None) -> dict[str, str]:
    return {f"{prefix}_{n.partition('_')[2]}": ratio(n, total, digits) for n in names}


def weighted_score(terms: dict[str, float], scale: float = 1) -> str:
    """Sum of weighted terms, clamped to 0..100; a term is capped by its own text.

    With ``scale`` the clamp applies to the scaled sum.
    """
    total = " + ".join(f"coalesce({t}, 0) * {w}" for t, w in terms.items())
    return f"least(100.0, greatest(0.0, ({total}) * {scale}))"


def segments(rules: dict[str, str], other: str) -> str:
    """The first segment whose condition holds."""
    return "case " + " ".join(f"when {c} then '{s}'" for s, c in rules.items()) + f" else '{other}' end"


def flag_of(condition: str) -> str:
    return f"case when {condition} then 1 else 0 end"


def naive_sql(spec: BookSpec, facts: str, cutoffs: dict[int, str]) -> str:
    """The book as plain SQL: one aggregate over every event before each cut-off.

    The definition that the single-pass engine is held against.
    """

    def one(a: Agg) -> str:
        within = f" filter (where {a.where})" if a.where else ""
        return {
            "count": f"count(*){within}",
            "sum": f"coalesce(sum({a.value}){within}, 0)",
            "avg": f"avg({a.value}){within}", "max": f"max({a.value}){within}", "min": f"min({a.value}){within}",
            "stddev": f"stddev_samp({a.value}){within}",
            "first_date": f"min({a.value}){within}", "last_date": f"max({a.value}){within}",
            "latest": f"max(struct_pack(d := {spec.date}, v := {a.value})).v",
            "distinct": f"count(distinct {a.value})",
        }[a.kind] + f" as {a.name}"

    snapshots = ", ".join(f"({k}, date '{d}')" for k, d in cutoffs.items())
    flags = "".join(f", case when {c} then 1 else 0 end as {f}" for f, c in spec.flags.items())
    layers = f"select *{flags} from ({facts}) f"
    aggregates = ",\n".join(one(a) for a in spec.aggregates)
    text = (f"select {spec.client}, snapshot, cutoff, {aggregates} from ({layers}) e "
            f"join (values {snapshots}) s(snapshot, cutoff) on {spec.date} < cutoff group by {spec.client}, snapshot, cutoff")
    for name, expression in spec.derived.items():
        text = f"select *, {expression} as {name} from ({text})"
    return text.replace("datediff(day,", "datediff('day',")
