"""Profiling, data quality, feature selection and fitting queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import compiled, fitting, forest, profiling, quality, sampling, scoring, selection
from tidemark.operators.metrics import quality_gate, ranking_metrics
from tidemark.operators.quality_plan import Suite
from tidemark.plans.q_metrics import FEATURES, IV, SCORED, psi_sql, ranking_sql, scored
from tidemark.plans.registry import Tables, query, rounded, shown
from tidemark.sources import io

# ---- profiling -------------------------------------------------------------------

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
PARTIAL = "select c_custkey, case when c_custkey % 3 = 0 then null else c_name end as c_name, case when c_custkey % 20 = 0 then null else c_mktsegment end as c_mktsegment, c_acctbal from customer"


def partial(t: Tables) -> DataFrame:
    return t("customer").selectExpr("c_custkey", "case when c_custkey % 3 = 0 then null else c_name end as c_name",
                                    "case when c_custkey % 20 = 0 then null else c_mktsegment end as c_mktsegment", "c_acctbal")


GRADE = "case when filled >= 99 then 'EXCELENTE' when filled >= 90 then 'BOM' when filled >= 70 then 'ATENCAO' else 'CRITICO' end"


@query(shown(f"""select *, {GRADE} as grade from (select *, (n - n_null) * 100.0 / n as filled from (""" + " union all ".join(
    f"select '{c}' as \"column\", count(*) as n, count(*) - count({c}) as n_null from ({PARTIAL})" for c in ("c_custkey", "c_name", "c_mktsegment", "c_acctbal")) + "))",
    **{'"column"': "s", "n": "i", "n_null": "i", "filled": "d", "grade": "s"}))
def profile_nulls(t: Tables) -> DataFrame:
    return rounded(profiling.null_profile(partial(t)))


@query("""select *, case when n_distinct <= 1 then 'CONSTANTE' when n_distinct <= 10 then 'BAIXA' when n_distinct <= 100 then 'MEDIA' when n_distinct / n > 0.95 then 'MUITO ALTA' else 'ALTA' end as cardinality,
    n_distinct / n > 0.99 as may_be_key, n_distinct <= 1 as is_constant from (""" + " union all ".join(
    f"select '{c}' as \"column\", count(*) as n, count(distinct {c}) as n_distinct from orders" for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")) + ")")
def profile_cardinality(t: Tables) -> DataFrame:
    return profiling.cardinality_profile(t("orders"), ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"], exact=True)


PERCENT_SQL = ", ".join(f"quantile_cont({{0}}, {p}) as p{round(p * 100)}" for p in profiling.PERCENTS)
NUMERIC_SQL = "select *, p25 - 1.5 * (p75 - p25) as low_fence, p75 + 1.5 * (p75 - p25) as high_fence from (" + " union all ".join(
    f"select '{c}' as \"column\", count({c}) as n, sum({c}) as total, avg({c}) as mean, stddev_samp({c}) as std, min({c}) as least, max({c}) as most, count(*) filter (where {c} = 0) as n_zero, "
    f"count(*) filter (where {c} < 0) as n_negative, {PERCENT_SQL.format(c)} from lineitem" for c in NUMERIC) + ")"
NUMERIC_FORMS = {'"column"': "s", "n": "i", "n_zero": "i", "n_negative": "i"} | dict.fromkeys(["total", "mean", "std", "least", "most", "p25", "p50", "p75", "p90", "p95", "p99", "low_fence", "high_fence"], "d")


@query(shown(NUMERIC_SQL, **NUMERIC_FORMS))
def profile_numeric(t: Tables) -> DataFrame:
    return rounded(profiling.numeric_profile(t("lineitem"), NUMERIC))


@query(shown(" union all ".join(
    f"select '{c}' as \"column\", count({c}) as n, count(*) filter (where {c} < lo) as n_low, count(*) filter (where {c} > hi) as n_high, (count(*) filter (where {c} < lo) + count(*) filter (where {c} > hi)) * 100.0 / count({c}) as percent "
    f"from customer, (select quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) as lo, quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) as hi from customer)"
    for c in ("c_acctbal", "c_nationkey")), **{'"column"': "s", "n": "i", "n_low": "i", "n_high": "i", "percent": "d"}))
def profile_outliers(t: Tables) -> DataFrame:
    return rounded(profiling.outlier_counts(t("customer"), ["c_acctbal", "c_nationkey"]))


@query(shown(" union all ".join(
    f"select '{c}' as \"column\", count({c}) as n, min(length({c})) as shortest, max(length({c})) as longest, avg(length({c})) as mean_length, count(*) filter (where trim({c}) = '') as n_empty, "
    f"count(*) filter (where regexp_full_match({c}, '[0-9]+')) as n_digits, count(*) filter (where regexp_full_match({c}, '[A-Za-z]+')) as n_letters from customer" for c in ("c_name", "c_mktsegment")),
    **{'"column"': "s", "n": "i", "shortest": "i", "longest": "i", "mean_length": "d", "n_empty": "i", "n_digits": "i", "n_letters": "i"}))
def profile_strings(t: Tables) -> DataFrame:
    return rounded(profiling.string_profile(t("customer"), ["c_name", "c_mktsegment"]))


@query(shown("""select 'o_orderdate' as "column", count(*) as n, min(o_orderdate) as least, max(o_orderdate) as most, date_diff('day', min(cast(o_orderdate as date)), max(cast(o_orderdate as date))) as span,
    count(distinct year(o_orderdate) * 100 + month(o_orderdate)) as n_months, count(distinct year(o_orderdate)) as n_years from orders""",
             **{'"column"': "s", "n": "i", "least": "t", "most": "t", "span": "i", "n_months": "i", "n_years": "i"}))
def profile_dates(t: Tables) -> DataFrame:
    return rounded(profiling.date_profile(t("orders"), ["o_orderdate"]))


@query("select strftime(o_orderdate, '%Y%m') as month, count(*) as n from orders group by all")
def profile_month_histogram(t: Tables) -> DataFrame:
    return profiling.month_histogram(t("orders"), "o_orderdate")


@query("select cast(sum(n) as bigint) as n_rows, count(*) as n_distinct, cast(sum(n) - count(*) as bigint) as n_copies from (select o_custkey, o_orderstatus, count(*) as n from orders group by all)")
def profile_duplicates(t: Tables) -> DataFrame:
    return profiling.exact_duplicates(t("orders"), ["o_custkey", "o_orderstatus"])


@query("""select case when l_shipdate is null then 0 else 1 end as l_shipdate_present, 1 as o_orderdate_present, case when l_shipdate = o_orderdate then 1 else 0 end as o_orderdate_equal, count(*) as n
    from lineitem join orders on l_orderkey = o_orderkey group by all""")
def profile_date_agreement(t: Tables) -> DataFrame:
    b = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return profiling.date_agreement(b, ["l_shipdate", "o_orderdate"])


@query(shown(" union all ".join(f"select '{c}' as \"column\", label, count({c}) as n, avg({c}) as mean, stddev_samp({c}) as std, quantile_cont({c}, 0.5) as median from ({SCORED}) group by label" for c in ("p1", "price")),
             **{'"column"': "s", "label": "i", "n": "i", "mean": "d", "std": "d", "median": "d"}))
def profile_label_summary(t: Tables) -> DataFrame:
    return rounded(profiling.label_summary(scored(t), ["p1", "price"], "label"))


@query(shown("""select date_trunc('month', o_orderdate) as month, count(distinct o_custkey) as n_clients, count(*) as n, sum(o_totalprice) as total,
    case when date_trunc('month', o_orderdate) between date '1996-01-01' and date '1998-12-31' then 1 else 0 end as inside from orders group by all""", month="t", n_clients="i", n="i", total="d", inside="i"))
def profile_monthly_activity(t: Tables) -> DataFrame:
    return rounded(profiling.monthly_activity(t("orders"), "o_orderdate", "o_custkey", "o_totalprice", "1996-01-01", "1998-12-31"))


@query(shown(" union all ".join(f"select '{a}' as a, '{b}' as b, corr({a}, {b}) as correlation from lineitem" for i, a in enumerate(NUMERIC) for b in NUMERIC[i + 1:]), a="s", b="s", correlation="d"))
def profile_correlations(t: Tables) -> DataFrame:
    return rounded(selection.correlation_pairs(t("lineitem"), NUMERIC).select("a", "b", "correlation"))


@query()
def profile_enriched_metadata(t: Tables) -> DataFrame:
    return profiling.enriched_metadata(t("orders"), "orders").select(
        "table", "column", "kind", "role", "grade", "cardinality", "aggregates", "use_in_book", "feature_prefix", F.array_join("top_values", ",").alias("top_values"))


# ---- data quality ------------------------------------------------------------------


def suite(t: Tables) -> DataFrame:
    """All checks of the three tables; the spine's are its rows only."""
    s = Suite()
    o = s.table(t("orders").withColumn("yr", F.year("o_orderdate")), "orders")
    li, spine = s.table(t("lineitem"), "lineitem"), s.table(t("orders").select("o_orderkey").distinct(), "spine")
    o.has_rows("silver").rows_at_most("silver", li).rows_equal("gold", spine).keys_not_null("silver", ["o_orderkey"]).keys_unique("silver", ["o_orderkey"])
    li.keys_unique("silver", ["l_orderkey", "l_linenumber"])
    o.types_conform("silver", {"o_orderkey": "bigint", "o_orderdate": "datetime", "o_orderstatus": "varchar(10)"}).audit_columns("bronze").column_count("silver", 7)
    o.column_is_int("gold", "yr").snapshots_are("gold", "yr", list(range(1995, 2003))).no_leakage("gold").prefixes_present("gold", ["o_", "x_"])
    o.columns_present("gold", ["o_orderkey", "o_custkey"]).snapshots_balanced("gold", "yr").volume_near("gold", 1).null_rates("gold", ["o_custkey", "o_totalprice"])
    return s.result()


def suite_by_check(t: Tables) -> DataFrame:
    """The same checks one by one, each with a scan of its own (the slow definition)."""
    o, li = t("orders"), t("lineitem")
    years = o.withColumn("yr", F.year("o_orderdate"))
    return quality.run_suite([
        quality.has_rows(o, "silver", "orders"), quality.row_count_at_most(o, li, "silver", "orders"), quality.row_count_equals(o, o.select("o_orderkey").distinct(), "gold", "orders"),
        quality.keys_not_null(o, ["o_orderkey"], "silver", "orders"), quality.keys_unique(o, ["o_orderkey"], "silver", "orders"), quality.keys_unique(li, ["l_orderkey", "l_linenumber"], "silver", "lineitem"),
        quality.types_conform(o, {"o_orderkey": "bigint", "o_orderdate": "datetime", "o_orderstatus": "varchar(10)"}, "silver", "orders"), quality.audit_columns(o, "bronze", "orders"),
        quality.column_count(years, 7, "silver", "orders"), quality.column_is_int(years, "yr", "gold", "orders"), quality.snapshots_are(years, "yr", list(range(1995, 2003)), "gold", "orders"),
        quality.no_leakage(o, "gold", "orders"), quality.prefixes_present(o, ["o_", "x_"], "gold", "orders"), quality.columns_present(o, ["o_orderkey", "o_custkey"], "gold", "orders"),
        quality.snapshots_balanced(years, "yr", "gold", "orders"), quality.volume_near(o, 1, "gold", "orders"), quality.null_rates(o, ["o_custkey", "o_totalprice"], "gold", "orders")])


#: Columns of the checked table and their types, as the database describes them.
NAMES = "names as (select column_name as c, data_type as d from information_schema.columns where table_name = 'orders' union all select 'yr', typeof(year(min(o_orderdate))) from orders)"
CHECKS = "with " + NAMES + """ select 'silver' as layer, 'orders' as entity, 'has rows' as "check", case when n > 0 then 'PASS' else 'FAIL' end as status from (select count(*) as n from orders)
    union all select 'silver', 'orders', 'rows at most the source''s', case when (select count(*) from orders) <= (select count(*) from lineitem) then 'PASS' else 'FAIL' end
    union all select 'gold', 'orders', 'rows equal the spine''s', case when (select count(*) from orders) = (select count(distinct o_orderkey) from orders) then 'PASS' else 'FAIL' end
    union all select 'silver', 'orders', 'key not null', case when (select count(*) from orders where o_orderkey is null) = 0 then 'PASS' else 'FAIL' end
    union all select 'silver', 'orders', 'key unique', case when (select count(*) - count(distinct o_orderkey) from orders) = 0 then 'PASS' else 'FAIL' end
    union all select 'silver', 'lineitem', 'key unique', case when (select count(*) from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)) = 0 then 'PASS' else 'FAIL' end
    union all select 'silver', 'orders', 'types conform', case when (select count(*) from names where (c, d) in (('o_orderkey', 'BIGINT'), ('o_orderdate', 'TIMESTAMP'), ('o_orderstatus', 'VARCHAR'))) = 3 then 'PASS' else 'FAIL' end
    union all select 'bronze', 'orders', 'audit columns', case when (select count(*) from names where c in ('_execution_id', '_ingested_at')) = 2 then 'PASS' else 'FAIL' end
    union all select 'silver', 'orders', 'column count', case when (select count(*) from names) = 7 then 'PASS' else 'FAIL' end
    union all select 'gold', 'orders', 'snapshot is int', case when (select d from names where c = 'yr') in ('INTEGER', 'BIGINT') then 'PASS' else 'FAIL' end
    union all select 'gold', 'orders', 'snapshots as expected', case when (select list_sort(list(distinct year(o_orderdate))) from orders) = range(1995, 2003) then 'PASS' else 'FAIL' end
    union all select 'gold', 'orders', 'no leakage columns', case when (select count(*) from names where regexp_matches(c, 'VLR_FPD|TARGET_FPD|_LEAKAGE')) = 0 then 'PASS' else 'FAIL' end
    union all select 'gold', 'orders', 'prefixes present', case when (select bool_or(c like 'o\\_%' escape '\\') and bool_or(c like 'x\\_%' escape '\\') from names) then 'PASS' else 'FAIL' end
    union all select 'gold', 'orders', 'columns present', case when (select count(*) from names where c in ('o_orderkey', 'o_custkey')) = 2 then 'PASS' else 'FAIL' end
    union all select 'gold', 'orders', 'snapshots balanced', case when (select min(n) / max(n) from (select count(*) as n from orders group by year(o_orderdate))) >= 0.1 then 'PASS' else 'WARN' end
    union all select 'gold', 'orders', 'volume near expected', case when (select abs(count(*) - 1) from orders) <= 0.3 then 'PASS' else 'WARN' end
    union all select 'gold', 'orders', 'null rate of o_custkey', case when (select avg(case when o_custkey is null then 1.0 else 0.0 end) from orders) < 0.5 then 'PASS' else 'WARN' end
    union all select 'gold', 'orders', 'null rate of o_totalprice', case when (select avg(case when o_totalprice is null then 1.0 else 0.0 end) from orders) < 0.5 then 'PASS' else 'WARN' end"""


@query(CHECKS)
def quality_suite(t: Tables) -> DataFrame:
    return suite(t).drop("detail")


@query(shown(f"""select count(*) as n, count(*) filter (where status = 'PASS') as n_pass, count(*) filter (where status = 'FAIL') as n_fail, count(*) filter (where status = 'WARN') as n_warn, count(*) filter (where status = 'SKIP') as n_skip,
    count(*) filter (where status = 'PASS') / count(*) as pass_rate, case when count(*) filter (where status = 'FAIL') > 0 then 'FAIL' when count(*) filter (where status = 'WARN') > 0 then 'WARN' else 'PASS' end as overall from ({CHECKS})""",
             n="i", n_pass="i", n_fail="i", n_warn="i", n_skip="i", pass_rate="d", overall="s"))
def quality_summary(t: Tables) -> DataFrame:
    return rounded(quality.summarise(suite(t)))


@query("""select 'by status' as entity, 'PASS' as status from orders having count(*) > 0 union all select 'whole', 'FAIL' from orders having count(*) > 0""")
def quality_partitioned(t: Tables) -> DataFrame:
    """A table in folders by the column, and the same table without."""
    spark = t("orders").sparkSession
    parts, whole = io.scratch_path(spark), io.scratch_path(spark)
    io.write_overwrite(t("orders"), parts, ["o_orderstatus"])
    io.write_overwrite(t("orders"), whole)
    return quality.run_suite([quality.partitioned_by(spark, p, "o_orderstatus", "gold", e) for p, e in ((parts, "by status"), (whole, "whole"))]).select("entity", "status")


# ---- selection --------------------------------------------------------------------------


@query(shown(f"select feature, iv, row_number() over (order by iv desc, feature) as rank, case when iv > 0.02 then 'true' else 'false' end as kept from ({IV})", feature="s", iv="d", rank="i", kept="s"))
def selection_iv_filter(t: Tables) -> DataFrame:
    f = selection.iv_filter(scored(t), FEATURES, "label")
    return rounded(f.select("feature", "iv", "rank", F.col("kept").cast("string").alias("kept")))


@query(shown(" union all ".join(f"select '{c}' as feature, corr({c}, label) as correlation from ({SCORED})" for c in FEATURES), feature="s", correlation="d"))
def selection_label_correlations(t: Tables) -> DataFrame:
    return rounded(selection.label_correlations(scored(t), FEATURES, "label"))


@query("select feature, by_name, by_name or abs(correlation) > 0.95 as leaks from (" + " union all ".join(
    f"select '{c}' as feature, {'true' if 'LEAK' in c else 'false'} as by_name, corr({e}, label) as correlation from ({SCORED})" for c, e in (("p1", "p1"), ("copy", "label"), ("x_LEAKAGE", "p2"))) + ")")
def selection_leakage_filter(t: Tables) -> DataFrame:
    s = scored(t).withColumns({"copy": F.col("label"), "x_LEAKAGE": F.col("p2")})
    return selection.leakage_filter(s, ["p1", "copy", "x_LEAKAGE"], "label").select("feature", "by_name", "leaks")


@query(shown(f"select *, case when psi < 0.25 then 'true' else 'false' end as kept from ({psi_sql(FEATURES, 'yr <= 1998', 'yr > 1998')})", feature="s", psi="d", kept="s"))
def selection_stability_filter(t: Tables) -> DataFrame:
    f = selection.stability_filter(scored(t), FEATURES, F.col("yr") <= 1998, F.col("yr") > 1998)
    return rounded(f.withColumn("kept", F.col("kept").cast("string")))


@query(shown(f"select feature, max(psi) as max_psi, count(*) filter (where psi > 0.2) as n_unstable, case when count(*) filter (where psi > 0.2) = 0 then 'true' else 'false' end as stable from ({psi_sql(FEATURES, 'yr = 1995', 'yr <> 1995', 'yr')}) group by feature",
             feature="s", max_psi="d", n_unstable="i", stable="s"))
def selection_snapshot_stability(t: Tables) -> DataFrame:
    f = selection.snapshot_stability(scored(t), FEATURES, "yr", 1995)
    return rounded(f.withColumn("stable", F.col("stable").cast("string")))


WIDE = ["p1", "p2", "quantity", "price", "tax"]


def pairs_sql(columns: list[str]) -> str:
    """(i, j, a, b, r, loser): pairs of columns with the size of their correlation, and which of them varies less."""
    return " union all ".join(
        f"select {i} as i, {j} as j, '{a}' as a, '{b}' as b, abs(corr({a}, {b})) as r, case when var_samp({a}) < var_samp({b}) then '{a}' else '{b}' end as narrower from ({SCORED})"
        for i, a in enumerate(columns) for j, b in enumerate(columns) if i < j)


def listed(columns: list[str]) -> str:
    return "[" + ", ".join(f"'{c}'" for c in columns) + "]"


GREEDY = f"""with recursive pairs as (select *, row_number() over (order by i, j) as place, case when coalesce(map {{'quantity': 0.2, 'p2': 0.1}}[a], 0) >= coalesce(map {{'quantity': 0.2, 'p2': 0.1}}[b], 0) then b else a end as loser from ({pairs_sql(WIDE)})),
    steps as (select cast(0 as bigint) as place, cast([] as varchar[]) as gone union all
        select p.place, case when list_contains(gone, a) or list_contains(gone, b) or r <= 0.9 then gone else list_append(gone, loser) end from steps s join pairs p on p.place = s.place + 1)
    select feature from (select unnest({listed(WIDE)}) as feature), (select gone from steps order by place desc limit 1) where not list_contains(gone, feature)"""
WORST_FIRST = f"""with recursive ranked as (select list({{'a': a, 'b': b, 'narrower': narrower}} order by r desc, i, j) as pairs from ({pairs_sql(WIDE)}) where r >= 0.8),
    steps as (select cast(0 as bigint) as n, {listed(WIDE)} as rest union all
        select n + 1, list_filter(rest, lambda c: c <> list_filter(pairs, lambda p: list_contains(rest, p.a) and list_contains(rest, p.b))[1].narrower) from steps, ranked
        where len(list_filter(pairs, lambda p: list_contains(rest, p.a) and list_contains(rest, p.b))) > 0)
    select unnest(rest) as feature from (select rest from steps order by n desc limit 1)"""


@query(GREEDY)
def selection_correlation_filter(t: Tables) -> DataFrame:
    left = selection.correlation_filter(scored(t), WIDE, {"quantity": 0.2, "p2": 0.1})
    return t("lineitem").sparkSession.createDataFrame([(x,) for x in left], "feature string")


@query(WORST_FIRST)
def selection_drop_most_correlated(t: Tables) -> DataFrame:
    left = selection.drop_most_correlated(scored(t), WIDE)
    return t("lineitem").sparkSession.createDataFrame([(x,) for x in left], "feature string")


def determinant(m: list[list[str]]) -> str:
    """A determinant by its first row, as SQL."""
    if not m:
        return "1"
    return "(" + " ".join(f"{'+' if j % 2 == 0 else '-'} {x} * {determinant([r[:j] + r[j + 1:] for r in m[1:]])}" for j, x in enumerate(m[0])) + ")"


def without(m: list[list[str]], k: int) -> list[list[str]]:
    return [r[:k] + r[k + 1:] for i, r in enumerate(m) if i != k]


CORRELATIONS = [["1" if a == b else f"c_{min(i, j)}_{max(i, j)}" for j, b in enumerate(FEATURES)] for i, a in enumerate(FEATURES)]
INFLATION = " union all ".join(
    f"select '{f}' as feature, {determinant(without(CORRELATIONS, k))} / {determinant(CORRELATIONS)} as vif from (select "
    + ", ".join(f"corr({a}, {b}) as c_{i}_{j}" for i, a in enumerate(FEATURES) for j, b in enumerate(FEATURES) if i < j) + f" from ({SCORED}))" for k, f in enumerate(FEATURES))


@query(shown(INFLATION, feature="s", vif="d"))
def selection_variance_inflation(t: Tables) -> DataFrame:
    return rounded(selection.variance_inflation(scored(t), FEATURES))


@query()
def selection_lasso_filter(t: Tables) -> DataFrame:
    return rounded(selection.lasso_filter(scored(t), FEATURES, "label"))


@query()
def selection_funnel(t: Tables) -> DataFrame:
    s = scored(t).withColumn("good_sign", F.col("label") * 0.4 + F.col("p1"))
    f = selection.feature_funnel(s, [*FEATURES, "good_sign"], "label", F.col("yr") <= 1998, F.col("yr") > 1998)
    return f.table(s.sparkSession)


def hash_sql(key: str, salt: str) -> str:
    return f"cast(('0x' || substr(md5({key} || ':{salt}'), 1, 8)) as bigint)"


@query(f"""select rid, cast(yr as bigint) as yr, cast(label as bigint) as label from (select *, row_number() over (partition by yr, label order by {hash_sql('rid', 'sample')}, rid) as place, count(*) over (partition by yr, label) as n
    from ({SCORED})) where place <= n * 25 // 100""")
def selection_stratified_sample(t: Tables) -> DataFrame:
    """A quarter of the rows of each year and label, by the order of a hash."""
    s = selection.stratified_sample(scored(t), ["yr", "label"], "rid", 25)
    return s.select("rid", F.col("yr").cast("long").alias("yr"), F.col("label").cast("long").alias("label"))


@query(f"""select o_orderkey from (select o_orderkey, row_number() over (order by {hash_sql('o_orderkey', '42')}, o_orderkey) as place, count(*) over () as n from orders)
    where place <= case when n > 1000 then least(n * 10 // 100, 1000) else n end""")
def profile_adaptive_sample(t: Tables) -> DataFrame:
    """A tenth of a table of more than 1,000 rows, 1,000 at most."""
    return sampling.adaptive_sample(t("orders"), "o_orderkey", most=1000).select("o_orderkey")


# ---- fitting ----------------------------------------------------------------------------

FOLDS = fitting.expanding_folds([1996, 1997, 1998, 1999], 2)


def prepared(t: Tables) -> DataFrame:
    s = scored(t).withColumn("quantity", F.col("quantity").cast("double"))
    return fitting.prepare(s, "label", ["status"], F.col("yr") <= 1998)


INPUTS = ["p1", "price", "tax", "status_freq"]


@query()
def fit_lasso(t: Tables) -> DataFrame:
    s = prepared(t)
    model = fitting.lasso_pipeline(INPUTS).fit(s.where("yr <= 1998"))
    return rounded(ranking_metrics(fitting.predict(model, s, "p"), "label", "p", ["yr"]))


@query()
def fit_boosted_scores(t: Tables) -> DataFrame:
    s = prepared(t)
    model = fitting.boosted_pipeline(INPUTS, validation="held").fit(s.where("yr <= 1998").withColumn("held", F.col("yr") == 1998))
    return rounded(scoring.batch_score(model, s, ["rid", "yr"], "v1", "run").drop("scored_at", "execution_id"))


@query()
def fit_forest_importances(t: Tables) -> DataFrame:
    return rounded(forest.forest_importances(prepared(t).where("yr <= 1998"), INPUTS))


@query()
def fit_temporal_cv(t: Tables) -> DataFrame:
    return rounded(fitting.cross_validate(fitting.lasso_pipeline(INPUTS), prepared(t), "label", "yr", FOLDS))


@query()
def fit_random_search(t: Tables) -> DataFrame:
    grid = {"penalty": [0.0001, 0.001, 0.01]}
    return rounded(fitting.random_search(lambda penalty: fitting.lasso_pipeline(INPUTS, penalty), grid, 3, prepared(t), "label", "yr", FOLDS))


BLENDS = " union all ".join(f"select {k - 1} as setting, '{k / 10},{(10 - k) / 10}' as w, ks, auc from ({ranking_sql(f'round(p1 * {k / 10} + p2 * {(10 - k) / 10}, 9)')})" for k in range(1, 10))


@query(shown(BLENDS, setting="i", w="s", ks="d", auc="d"))
def fit_blend_weights(t: Tables) -> DataFrame:
    b = fitting.blend_weights(scored(t), "label", ["p1", "p2"], 10)
    return rounded(b.select("setting", F.array_join(F.transform("weights", lambda w: w.cast("string")), ",").alias("w"), "ks", "auc"))


@query()
def fit_stacking(t: Tables) -> DataFrame:
    s = prepared(t)
    oof = fitting.out_of_fold({"m1": fitting.lasso_pipeline(INPUTS), "m2": fitting.lasso_pipeline(["p1", "tax"])}, s, "label", "yr", FOLDS)
    model = fitting.stack(oof, "label", ["m1", "m2"])
    return rounded(ranking_metrics(fitting.predict(model, oof, "p"), "label", "p"))


CHAMPION = "select model, ks, auc, gini from (" + " union all ".join(f"select '{c}' as model, ks, auc, gini from ({ranking_sql(c)})" for c in ("p1", "p2")) + """)
    order by ks > 0.20 and auc > 0.65 and gini > 30 desc, ks desc, model limit 1"""


@query(shown(CHAMPION, model="s", ks="d", auc="d", gini="d"))
def fit_champion(t: Tables) -> DataFrame:
    s = scored(t)
    m = None
    for name in ("p1", "p2"):
        one = quality_gate(ranking_metrics(s, "label", name)).withColumn("model", F.lit(name))
        m = one if m is None else m.unionByName(one)
    return rounded(fitting.champion(m).select("model", "ks", "auc", "gini"))


@query()
def fit_odds_ratios(t: Tables) -> DataFrame:
    s = prepared(t)
    return rounded(fitting.odds_ratios(fitting.lasso_pipeline(INPUTS).fit(s), INPUTS, s))


@query()
def fit_incremental_ks(t: Tables) -> DataFrame:
    return rounded(fitting.incremental_ks(prepared(t), "label", {"offer": ["p1"], "value": ["price"], "terms": ["tax", "status_freq"]}, F.col("yr") <= 1998, F.col("yr") > 1998))


@query()
def fit_permutation_importance(t: Tables) -> DataFrame:
    s = prepared(t)
    model = fitting.lasso_pipeline(INPUTS).fit(s.where("yr <= 1998"))
    return rounded(fitting.permutation_importance(model, s.where("yr in (1999, 2000)"), "label", ["p1", "price"], "rid", ["yr"]))


@query(shown(f"select rid, (p1 + p2) / 2 as p from ({SCORED})", rid="i", p="d"))
def fit_ensemble_average(t: Tables) -> DataFrame:
    return rounded(scored(t).select("rid", fitting.average(["p1", "p2"]).alias("p")))


CARD = f"""with n as (select count(*) filter (where label = 1 and status = 'O') as b1, count(*) filter (where label = 0 and status = 'O') as g1, count(*) filter (where label = 1 and status <> 'O') as b0,
        count(*) filter (where label = 0 and status <> 'O') as g0, count(*) filter (where label = 1) / count(*) as share from ({SCORED}) where yr <= 1998),
    m as (select ln(b1 / g1) - ln(b0 / g0) as w, ln(b0 * (0.5 / share) / (g0 * (0.5 / (1 - share)))) as i from n)
    select 'is_open' as feature, w as coefficient, -w * 50 / ln(2) as points, 600 - i * 50 / ln(2) as base from m"""


@query(shown(CARD, 2, feature="s", coefficient="d", points="d", base="d"))
def fit_scorecard(t: Tables) -> DataFrame:
    """Points of a fitted logistic model; of one 0/1 feature they have a closed form."""
    s = prepared(t).withColumn("is_open", (F.col("status") == "O").cast("double"))
    model = fitting.lasso_pipeline(["is_open"], 0.0, tolerance=1e-12).fit(s.where("yr <= 1998"))
    return rounded(compiled.card(model, s), 2)
