"""Sources, cleansing, joins, aggregates, windows, top-k and set queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import clean, features
from tidemark.operators import relational as rel
from tidemark.operators import rolling_distinct
from tidemark.plans.registry import Tables, query, rounded, shown
from tidemark.sources import calendar, io, merge

# ---- sources ----------------------------------------------------------------------

CALENDAR = """select d as day, cast(strftime(d, '%Y%m%d') as bigint) as day_key, year(d) as year, month(d) as month, day(d) as day_of_month, dayofweek(d) + 1 as day_of_week,
    dayofyear(d) as day_of_year, weekofyear(d) as week_of_year, quarter(d) as quarter, case when month(d) <= 6 then 1 else 2 end as semester,
    year(d) * 100 + month(d) as year_month, year(d) || 'Q' || quarter(d) as year_quarter, year(d) || 'S' || case when month(d) <= 6 then 1 else 2 end as year_semester,
    monthname(d) as month_name, dayname(d) as day_name, lpad(cast(month(d) as varchar), 2, '0') as month_text, date_trunc('month', d) as month_start,
    last_day(d) as month_end, cast(d = last_day(d) as varchar) as is_month_end, cast(dayofweek(d) in (0, 6) as varchar) as is_weekend, cast(dayofweek(d) not in (0, 6) as varchar) as is_weekday
    from (select distinct cast(o_orderdate as date) as d from orders)"""
CALENDAR_FORMS = {c: "i" for c in ("day_key", "year", "month", "day_of_month", "day_of_week", "day_of_year", "week_of_year", "quarter", "semester", "year_month")} | {
    c: "s" for c in ("year_quarter", "year_semester", "month_name", "day_name", "month_text", "is_month_end", "is_weekend", "is_weekday")} | {c: "t" for c in ("day", "month_start", "month_end")}


@query(shown(CALENDAR, **CALENDAR_FORMS))
def source_calendar(t: Tables) -> DataFrame:
    """The calendar of the days on which orders were made."""
    days = t("orders").select(F.col("o_orderdate").cast("date").alias("day")).distinct()
    span = days.agg(F.min("day").cast("string").alias("a"), F.max("day").cast("string").alias("b")).first()
    c = calendar.generate_calendar(days.sparkSession, span["a"], span["b"]).join(days, "day", "left_semi")
    return rounded(c.withColumns({x: F.col(x).cast("string") for x in ("is_month_end", "is_weekend", "is_weekday")}))


@query("select count(distinct c_name) as n_keys, count(distinct c_name) as n_ids, 0 as n_collisions from customer where trim(c_name) <> ''")
def source_key_dimension(t: Tables) -> DataFrame:
    """As many ids as keys, and no id with several keys."""
    dim = io.build_key_dimension(t("customer").union(t("customer")), "c_name")
    n = dim.agg(F.count("c_name").alias("n_keys"), F.count_distinct("key_id").alias("n_ids"))
    return n.join(F.broadcast(io.key_collisions(dim, "c_name").agg(F.count(F.lit(1)).cast("int").alias("n_collisions"))))  # a row each


def ingested(t: Tables) -> tuple[io.TableStore, str, DataFrame]:
    """Orders and customers from CSV files, and a source that isn't there, landed in one batch."""
    spark = t("orders").sparkSession
    files, root = io.scratch_path(spark), io.scratch_path(spark)
    for name in ("orders", "customer"):
        t(name).write.option("header", "true").csv(f"{files}/{name}")
    sources = [io.Source(n, f"{files}/{n}", "csv", {"header": "true"}) for n in ("orders", "customer", "missing")]
    store = io.TableStore(root, "bronze")
    io.ingest_batch(spark, sources, store, "raw", f"{root}/log")
    return store, f"{root}/log", spark


@query("select 'orders' as name, 'SUCCESS' as status, count(*) as n from orders union all select 'customer', 'SUCCESS', count(*) from customer union all select 'missing', 'FAILED', null")
def source_ingest_log(t: Tables) -> DataFrame:
    """The run log of a batch: a source that fails doesn't stop the others."""
    _, log, spark = ingested(t)
    return io.read_table(spark, log).select(F.col("table").alias("name"), "status", F.col("rows").alias("n"))


@query(shown("select o_orderstatus, count(*) as n, sum(o_totalprice) as total, min(o_orderdate) as first_day, 0 as n_unnamed from orders group by o_orderstatus", o_orderstatus="s", n="i", total="d", first_day="t", n_unnamed="i"))
def source_ingested_rows(t: Tables) -> DataFrame:
    """What a batch has landed, typed again, with its audit columns filled in every row."""
    store, _, spark = ingested(t)
    rows = io.read_columns(spark, store.path("raw", "orders"), ["o_orderstatus", "o_totalprice", "o_orderdate", "_execution_id", "_ingested_at"])
    return rounded(rows.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("double")).alias("total"), F.min(F.col("o_orderdate").cast("timestamp")).alias("first_day"),
        F.count_if(F.col("_execution_id").isNull() | F.col("_ingested_at").isNull()).alias("n_unnamed")))


UPSERT = """select o_orderkey, o_totalprice, o_orderstatus from orders where o_orderkey % 5 <> 0
    union all select o_orderkey, o_totalprice * 2, 'X' from orders where o_orderkey % 5 = 0
    union all select o_orderkey + 100000000, o_totalprice, 'N' from orders where o_orderkey % 50 = 0"""


@query(shown(UPSERT, o_orderkey="i", o_totalprice="d", o_orderstatus="s"))
def source_upsert(t: Tables) -> DataFrame:
    o = t("orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    changed = o.where("o_orderkey % 5 = 0").select("o_orderkey", (F.col("o_totalprice") * 2).alias("o_totalprice"), F.lit("X").alias("o_orderstatus"))
    new = o.where("o_orderkey % 50 = 0").select((F.col("o_orderkey") + 100000000).alias("o_orderkey"), "o_totalprice", F.lit("N").alias("o_orderstatus"))
    return rounded(io.upsert(o, changed.unionByName(new), ["o_orderkey"]))


@query(shown(UPSERT.replace("* 2, 'X'", "* 2, case when o_orderkey % 10 = 0 then 'X' else 'F' end"), o_orderkey="i", o_totalprice="d", o_orderstatus="s"))
def source_merge(t: Tables) -> DataFrame:
    """The upsert as a merge into a table with a partition for each status; rows also move between partitions."""
    o = t("orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    spark = o.sparkSession
    path = io.scratch_path(spark)
    io.write_overwrite(o, path, ["o_orderstatus"])
    status = F.when(F.col("o_orderkey") % 10 == 0, "X").otherwise("F")
    changed = o.where("o_orderkey % 5 = 0").select("o_orderkey", (F.col("o_totalprice") * 2).alias("o_totalprice"), status.alias("o_orderstatus"))
    new = o.where("o_orderkey % 50 = 0").select((F.col("o_orderkey") + 100000000).alias("o_orderkey"), "o_totalprice", F.lit("N").alias("o_orderstatus"))
    merge.merge_into(spark, path, changed.unionByName(new), ["o_orderkey"], ["o_orderstatus"])
    return rounded(io.read_columns(spark, path, ["o_orderkey", "o_totalprice", "o_orderstatus"]))


@query("select 'orders' as \"table\", count(*) as n from orders union all select 'lineitem', count(*) from lineitem union all select 'customer', count(*) from customer")
def source_row_counts(t: Tables) -> DataFrame:
    return rel.row_counts({n: t(n) for n in ("orders", "lineitem", "customer")})


@query(shown("select o_orderkey, o_custkey, 'run' as _execution_id from orders", o_orderkey="i", o_custkey="i", _execution_id="s"))
def source_land_with_audit(t: Tables) -> DataFrame:
    o = t("orders").select(F.col("o_orderkey").alias("order key"), F.col("o_custkey").alias("cust=key"))
    landed = io.with_audit(io.sanitize_columns(o), "run").toDF("o_orderkey", "o_custkey", "_execution_id", "_ingested_at")
    return landed.drop("_ingested_at")


@query(shown("""select o_orderkey, case when o_orderstatus = 'P' then o_totalprice * 2 else o_totalprice end as o_totalprice, o_orderstatus from orders""", o_orderkey="i", o_totalprice="d", o_orderstatus="s"))
def source_replace_partition(t: Tables) -> DataFrame:
    """A partitioned table of which one partition is replaced."""
    o = t("orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    path = io.scratch_path(o.sparkSession)
    io.write_overwrite(o, path, ["o_orderstatus"])
    changed = o.where("o_orderstatus = 'P'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    io.write_replace_partition(changed, path, ["o_orderstatus"])
    return rounded(io.read_columns(o.sparkSession, path, ["o_orderkey", "o_totalprice", "o_orderstatus"]))


@query(shown("select o_orderkey, o_orderstatus, o_totalprice from orders where o_orderdate < date '1998-01-01'", o_orderkey="i", o_orderstatus="s", o_totalprice="d"))
def source_final_features(t: Tables) -> DataFrame:
    """Features, keys and label written by snapshot and read through a view."""
    o = t("orders").where("o_orderdate < date'1998-01-01'").withColumn("yr", F.year("o_orderdate"))
    spark = o.sparkSession
    path = io.scratch_path(spark)
    io.write_final_features(o, path, ["o_totalprice"], ["o_orderkey"], "o_orderstatus", "yr")
    io.create_external_view(spark, "tidemark_final_features", path)
    return rounded(spark.table("tidemark_final_features").select("o_orderkey", "o_orderstatus", "o_totalprice"))


@query(shown("select c_custkey, c_name, n_name, c_acctbal from customer join nation on c_nationkey = n_nationkey where c_acctbal > 0", c_custkey="i", c_name="s", n_name="s", c_acctbal="d"))
def source_lookup_view(t: Tables) -> DataFrame:
    """A customer lookup over registered views."""
    spark = t("customer").sparkSession
    root = io.scratch_path(spark)
    for name in ("customer", "nation"):
        io.write_overwrite(t(name), f"{root}/{name}")
    io.register_views(spark, {f"tidemark_{name}": f"{root}/{name}" for name in ("customer", "nation")})
    rows = spark.table("tidemark_customer").join(spark.table("tidemark_nation"), F.col("c_nationkey") == F.col("n_nationkey")).where("c_acctbal > 0")
    io.lookup_view(rows, "tidemark_lookup", ["c_custkey", "c_name", "n_name", "c_acctbal"])
    return rounded(spark.table("tidemark_lookup"))


# ---- cleansing ------------------------------------------------------------------------


@query("select o_orderkey, o_custkey from orders")
def clean_drop_internal(t: Tables) -> DataFrame:
    return clean.drop_internal(io.with_audit(t("orders").select("o_orderkey", "o_custkey"), "run"))


@query(shown("select o_orderkey, o_totalprice as score_price, o_orderstatus as score_status from orders", o_orderkey="i", score_price="d", score_status="s"))
def clean_rename_matching(t: Tables) -> DataFrame:
    o = t("orders").selectExpr("o_orderkey", "o_totalprice as PROB_price", "o_orderstatus as PROB_status")
    return rounded(clean.rename_matching(o, "PROB_", "score_"))


@query("select o_orderkey from orders where o_orderstatus = 'F'")
def clean_filter_approved(t: Tables) -> DataFrame:
    o = t("orders").withColumn("approved", F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 0))
    return clean.filter_approved(o, "approved").select("o_orderkey")

STAMPS = "upper(strftime(o_orderdate, '%d%b%Y')) || ':00:00:00'"


@query(shown("select o_orderkey, cast(o_orderdate as timestamp) as made_at, o_totalprice as price, o_custkey as cust, null as bad from orders",
             o_orderkey="i", made_at="t", price="d", cust="i", bad="i"))
def clean_cast_by_metadata(t: Tables) -> DataFrame:
    text = t("orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"), F.concat(F.upper(F.date_format("o_orderdate", "ddMMMyyyy")), F.lit(":00:00:00")).alias("made_at"),
        F.col("o_totalprice").cast("string").alias("price"), F.col("o_custkey").cast("string").alias("cust"), F.col("o_orderpriority").alias("bad"))
    return rounded(clean.cast_by_metadata(text, {"o_orderkey": "bigint", "made_at": "timestamp", "price": "double", "cust": "int", "bad": "int"}))


@query(shown("select o_orderkey, cast(o_orderdate as date) as day, trim(o_orderpriority) as priority from orders", o_orderkey="i", day="t", priority="s"))
def clean_type_cast(t: Tables) -> DataFrame:
    text = t("orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"), F.concat(F.upper(F.date_format("o_orderdate", "ddMMMyyyy")), F.lit(":00:00:00")).alias("day"),
        F.concat(F.lit("  "), "o_orderpriority", F.lit(" ")).alias("priority"))
    return rounded(clean.type_cast(text, {"o_orderkey": "long", "day": "date", "priority": "string"}))


@query("select c_custkey, upper(trim(c_name)) as c_name, upper(trim(c_mktsegment)) as c_mktsegment from customer")
def clean_strings(t: Tables) -> DataFrame:
    return clean.clean_strings(t("customer").select("c_custkey", "c_name", "c_mktsegment"))


@query("select c_custkey, c_name as cli_c_name, c_mktsegment as cli_c_mktsegment from customer")
def clean_select_with_prefix(t: Tables) -> DataFrame:
    c = t("customer")
    part = clean.select_with_prefix(c.select("c_custkey", "c_name", "c_mktsegment"), "cli", ["C_CUSTKEY"])
    return c.select("c_custkey", *(F.col(x[4:]).alias(x) for x in part.columns))


@query("""select c_custkey, case when c_mktsegment = 'BUILDING' then 1 else 0 end as is_building, case when c_mktsegment like 'A%' then 1 else 0 end as starts_a,
    case when c_mktsegment in ('MACHINERY', 'HOUSEHOLD') then 1 else 0 end as is_listed, case when c_mktsegment in ('BUILDING', 'MACHINERY') then c_mktsegment else 'OUTROS' end as grouped from customer""")
def clean_flags(t: Tables) -> DataFrame:
    s = F.col("c_mktsegment")
    return t("customer").select("c_custkey", clean.flag_equals(s, "BUILDING").alias("is_building"), clean.flag_like(s, "A%").alias("starts_a"),
                                clean.flag_in(s, ["MACHINERY", "HOUSEHOLD"]).alias("is_listed"), clean.group_rare(s, ["BUILDING", "MACHINERY"]).alias("grouped"))


@query(shown("""select c_custkey, coalesce(region, 'OUTROS') as region from customer left join (select '1' as p, 'north' as region union all select '2', 'south')
    on substr(cast(c_custkey as varchar), 1, 1) = p""", c_custkey="i", region="s"))
def clean_map_prefix(t: Tables) -> DataFrame:
    c = t("customer")
    table = c.sparkSession.createDataFrame([("1", "north"), ("2", "south")], "p string, region string")
    return rounded(clean.map_prefix(c.select("c_custkey"), "c_custkey", table, "p", ["region"], width=1))


@query(shown("select o_orderkey, date_diff('day', cast(o_orderdate as date), date '2002-01-01') as o_orderdate_days from orders", o_orderkey="i", o_orderdate_days="i"))
def clean_dates_to_offsets(t: Tables) -> DataFrame:
    return rounded(clean.dates_to_day_offsets(t("orders").select("o_orderkey", "o_orderdate"), F.lit("2002-01-01").cast("date")))


SPARSE = "select o_orderkey, case when o_orderkey % 10 = 0 then o_totalprice end as rare, case when o_orderkey % 3 > 0 then o_totalprice end as often, 7 as fixed, o_orderstatus from orders"


def sparse(t: Tables) -> DataFrame:
    return t("orders").selectExpr("o_orderkey", "case when o_orderkey % 10 = 0 then o_totalprice end as rare",
                                  "case when o_orderkey % 3 > 0 then o_totalprice end as often", "7 as fixed", "o_orderstatus")


@query(shown(f"select o_orderkey, often, o_orderstatus from ({SPARSE})", o_orderkey="i", often="d", o_orderstatus="s"))
def clean_drop_columns(t: Tables) -> DataFrame:
    return rounded(clean.drop_low_cardinality(clean.drop_high_missing(sparse(t))))


@query(shown(f"""select o_orderkey, coalesce(often, (select quantile_cont(often, 0.5) from ({SPARSE}) where o_orderstatus = 'F')) as often from ({SPARSE})""", o_orderkey="i", often="d"))
def clean_impute_median(t: Tables) -> DataFrame:
    return rounded(clean.impute_median(sparse(t), ["often"], F.col("o_orderstatus") == "F").select("o_orderkey", "often"))


@query("""select o_orderkey, coalesce(case when o_orderkey % 4 > 0 then o_orderpriority end, (select p from (select o_orderpriority as p, count(*) as n from orders where o_orderkey % 4 > 0 group by 1)
    order by n desc, p limit 1)) as priority from orders""")
def clean_impute_mode(t: Tables) -> DataFrame:
    o = t("orders").selectExpr("o_orderkey", "case when o_orderkey % 4 > 0 then o_orderpriority end as priority")
    return clean.impute_mode(o, ["priority"], F.lit(True)).select("o_orderkey", "priority")


@query(shown("select p_partkey, case when p_size % 7 = 0 then null else p_size end as ratio from part", p_partkey="i", ratio="d"))
def clean_inf_to_null(t: Tables) -> DataFrame:
    p = t("part").selectExpr("p_partkey", "case when p_size % 14 = 0 then double('infinity') when p_size % 7 = 0 then double('nan') else double(p_size) end as ratio")
    return rounded(clean.inf_to_null(p, ["ratio"]))


@query(shown("""select o_orderkey, year(o_orderdate) * 100 + month(o_orderdate) as snapshot, date_trunc('month', o_orderdate) as cutoff,
    case when year(o_orderdate) < 1998 then 'train' when year(o_orderdate) = 1998 then 'oos' when year(o_orderdate) = 1999 then 'oot' end as split,
    case when year(o_orderdate) < 1998 then 'TREINO' else 'PRODUCAO' end as population, case when o_orderdate between date '1998-01-01' and date '1998-06-30' then 1 else 0 end as inside
    from orders""", o_orderkey="i", snapshot="i", cutoff="t", split="s", population="s", inside="i"))
def clean_snapshots(t: Tables) -> DataFrame:
    d, year = F.col("o_orderdate"), F.year("o_orderdate")
    train = [1995, 1996, 1997]
    return rounded(t("orders").select(
        "o_orderkey", clean.snapshot_of(d).alias("snapshot"), clean.snapshot_to_cutoff(clean.snapshot_of(d)).alias("cutoff"),
        clean.temporal_split(year, train, [1998], [1999]).alias("split"), clean.tag_population(year, train).alias("population"),
        clean.in_window(d, "1998-01-01", "1998-06-30").alias("inside")))


@query(shown("select o_orderkey, cast(o_totalprice as float) as o_totalprice, o_custkey from orders where o_orderstatus = 'F' and o_custkey is not null", o_orderkey="i", o_totalprice="d", o_custkey="i"))
def clean_filter_and_downcast(t: Tables) -> DataFrame:
    o = clean.drop_empty_keys(clean.filter_snapshots(t("orders"), "o_orderstatus", ["F"]), ["o_custkey"])
    return rounded(clean.downcast(o.select("o_orderkey", "o_totalprice", "o_custkey")))


VERSIONS = """select o_orderkey, o_totalprice, o_orderdate, 1 as version from orders union all select o_orderkey, o_totalprice + 1, o_orderdate + interval 1 day, 2 from orders where o_orderkey % 3 = 0
    union all select o_orderkey, o_totalprice + 2, o_orderdate, 3 from orders where o_orderkey % 7 = 0"""


@query(shown(f"select o_orderkey, o_totalprice, o_orderdate, version from ({VERSIONS}) qualify row_number() over (partition by o_orderkey order by o_orderdate desc, o_totalprice) = 1",
             o_orderkey="i", o_totalprice="d", o_orderdate="t", version="i"))
def window_dedup_latest(t: Tables) -> DataFrame:
    o = t("orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    day = F.expr("interval 1 day")
    rows = o.withColumn("version", F.lit(1)).unionByName(
        o.where("o_orderkey % 3 = 0").select("o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"), (F.col("o_orderdate") + day).alias("o_orderdate"), F.lit(2).alias("version"))).unionByName(
        o.where("o_orderkey % 7 = 0").select("o_orderkey", (F.col("o_totalprice") + 2).alias("o_totalprice"), "o_orderdate", F.lit(3).alias("version")))
    return rounded(clean.dedup_latest(rows, ["o_orderkey"], ["o_orderdate"], ["o_totalprice"]))


# ---- joins ------------------------------------------------------------------------------


@query("""select c_custkey, n_name, r_name from customer left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey""")
def join_dimensions(t: Tables) -> DataFrame:
    c = rel.join_dimensions(t("customer"), [(t("nation"), "c_nationkey", "n_nationkey", ["n_name", "n_regionkey"])])
    return rel.join_dimensions(c, [(t("region"), "n_regionkey", "r_regionkey", ["r_name"])]).select("c_custkey", "n_name", "r_name")


CONSOLIDATED = """select client, snapshot, orders_n, orders_total, lines_n from (select distinct o_custkey as client, year(o_orderdate) as snapshot from orders)
    left join (select o_custkey as c1, year(o_orderdate) as s1, count(*) as orders_n, sum(o_totalprice) as orders_total from orders where o_orderstatus = 'F' group by all) on c1 = client and s1 = snapshot
    left join (select o_custkey as c2, year(l_shipdate) as s2, count(*) as lines_n from lineitem join orders on l_orderkey = o_orderkey group by all) on c2 = client and s2 = snapshot"""


@query(shown(CONSOLIDATED, client="i", snapshot="i", orders_n="i", orders_total="d", lines_n="i"))
def join_consolidate(t: Tables) -> DataFrame:
    o = t("orders").withColumns({"client": F.col("o_custkey"), "snapshot": F.year("o_orderdate")})
    spine = o.select("client", "snapshot").distinct()
    book = o.where("o_orderstatus = 'F'").groupBy("client", "snapshot").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total"), F.max("o_totalprice").alias("TARGET_FPD"))
    lines = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).groupBy(
        F.col("o_custkey").alias("client"), F.year("l_shipdate").alias("snapshot")).agg(F.count(F.lit(1)).alias("n"))
    return rounded(rel.consolidate(spine, {"orders": book, "lines": lines, "absent": None}, ["client", "snapshot"], leakage=["VLR_FPD|TARGET_FPD|_LEAKAGE"]))


FEATURE_STORE = CONSOLIDATED.replace("orders_n, orders_total, lines_n", "orders_n, orders_total, lines_n, score_orders, '2002-01-01' as processed_at") + """
    left join (select o_custkey as c3, year(o_orderdate) as s3, avg(o_totalprice) as score_orders from orders group by all) on c3 = client and s3 = snapshot"""


@query(shown(FEATURE_STORE, client="i", snapshot="i", orders_n="i", orders_total="d", lines_n="i", score_orders="d", processed_at="s"))
def join_feature_store(t: Tables) -> DataFrame:
    """Books and scores consolidated: scores have their prefix renamed, and rows say when they were made."""
    o = t("orders").withColumns({"client": F.col("o_custkey"), "snapshot": F.year("o_orderdate")})
    spine = o.select("client", "snapshot").distinct()
    book = o.where("o_orderstatus = 'F'").groupBy("client", "snapshot").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total"), F.max("o_totalprice").alias("x_LEAKAGE"))
    scores = o.groupBy("client", "snapshot").agg(F.avg("o_totalprice").alias("PROB_orders"), F.max("o_totalprice").alias("VLR_FPD_max"))
    lines = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).groupBy(
        F.col("o_custkey").alias("client"), F.year("l_shipdate").alias("snapshot")).agg(F.count(F.lit(1)).alias("n"))
    return rounded(rel.feature_store(spine, {"orders": book, "lines": lines}, scores, ["client", "snapshot"], "PROB_", "score_", at=F.lit("2002-01-01").cast("timestamp")).withColumn(
        "processed_at", F.date_format("processed_at", "yyyy-MM-dd")))


WEEKS = {20240107: "2024-01-07", 20240114: "2024-01-14", 20240121: "2024-01-21", 20240131: "2024-01-31"}
SEEN = "select e.*, snapshot, date_diff('day', cast(ts as date), ref) as days_before from events e join (values {}) s(snapshot, ref) on cast(ts as date) <= ref".format(
    ", ".join(f"({k}, date '{d}')" for k, d in WEEKS.items()))


@query(shown(f"select snapshot, event_type, count(*) as n, avg(days_before) as age from ({SEEN}) group by all", snapshot="i", event_type="s", n="i", age="d"))
def join_range_snapshots(t: Tables) -> DataFrame:
    return rounded(rel.seen_by(t("events"), "ts", WEEKS).groupBy("snapshot", "event_type").agg(F.count(F.lit(1)).alias("n"), F.avg("days_before").alias("age")))


HORIZONS = [360, 14, 7, 3]
HORIZON = "select user_id, snapshot, " + ", ".join(
    f"count(*) filter (where days_before <= {h}) as n_{h}, avg(value) filter (where days_before <= {h}) as mean_{h}, max(value) filter (where days_before <= {h}) as max_{h}, min(value) filter (where days_before <= {h}) as min_{h}"
    for h in HORIZONS) + f" from ({SEEN}) group by all"
HORIZON_FORMS = {"user_id": "i", "snapshot": "i"} | {f"{k}_{h}": "i" if k == "n" else "d" for h in HORIZONS for k in ("n", "mean", "max", "min")}


DISTINCT = " union all ".join(f"select event_type, snapshot, {h} as horizon, count(distinct user_id) as users, count(distinct cast(ts as date)) as days from ({SEEN}) where days_before <= {h} group by all" for h in HORIZONS)


@query(shown(DISTINCT, event_type="s", snapshot="i", horizon="i", users="i", days="i"))
def book_distinct_horizons(t: Tables) -> DataFrame:
    """Active users and days over rolling horizons, exactly."""
    return rounded(rolling_distinct.exact_counts(t("events").withColumn("day", F.to_date("ts")), ["event_type"], "ts", {"users": "user_id", "days": "day"}, WEEKS, HORIZONS))


@query(shown(f"select event_type, snapshot, horizon, users, days, true as users_near, true as days_near from ({DISTINCT})", event_type="s", snapshot="i", horizon="i", users="i", days="i", users_near="s", days_near="s"))
def book_distinct_sketches(t: Tables) -> DataFrame:
    """The same beside estimates from daily sketches, which are within four standard errors."""
    c = rolling_distinct.compared(t("events").withColumn("day", F.to_date("ts")), ["event_type"], "ts", {"users": "user_id", "days": "day"}, WEEKS, HORIZONS)
    near = {f"{n}_near": F.col(f"{n}_error") <= 4 * rolling_distinct.ERROR for n in ("users", "days")}
    return rounded(c.withColumns(near).select("event_type", "snapshot", "horizon", "users", "days", *near))


@query(shown(HORIZON, **HORIZON_FORMS))
def book_horizons(t: Tables) -> DataFrame:
    return rounded(rel.horizon_stats(rel.seen_by(t("events"), "ts", WEEKS), ["user_id", "snapshot"], "days_before", "value", HORIZONS))


@query(shown(f"select user_id, snapshot, cast(n_7 as double) as monthly_short, n_360 / 12 as monthly_long, n_7 / nullif(n_360 / 12, 0) as engagement from ({HORIZON})",
             user_id="i", snapshot="i", monthly_short="d", monthly_long="d", engagement="d"))
def book_engagement(t: Tables) -> DataFrame:
    h = rel.horizon_stats(rel.seen_by(t("events"), "ts", WEEKS), ["user_id", "snapshot"], "days_before", "value", HORIZONS)
    return rounded(rel.engagement_ratios(h, "n_7", "n_360").select("user_id", "snapshot", "monthly_short", "monthly_long", "engagement"))


@query("""select a, b, c, coalesce(n, 0) as n from (select unnest([0, 1]) as a), (select unnest([0, 1]) as b), (select unnest([0, 1]) as c) left join (
    select case when l_discount > 0.05 then 1 else 0 end as a1, case when l_tax > 0.04 then 1 else 0 end as b1, case when l_discount > 0.02 then 1 else 0 end as c1, count(*) as n from lineitem group by all)
    on a = a1 and b = b1 and c = c1""")
def join_flag_combinations(t: Tables) -> DataFrame:
    flags = t("lineitem").selectExpr("case when l_discount > 0.05 then 1 else 0 end as a", "case when l_tax > 0.04 then 1 else 0 end as b", "case when l_discount > 0.02 then 1 else 0 end as c")
    return rel.flag_combinations(flags, ["a", "b", "c"])


@query(shown("""select o_custkey, sum(o_totalprice) filter (where o_orderstatus = 'F') as f, sum(o_totalprice) filter (where o_orderstatus = 'O') as o from orders group by o_custkey""",
             o_custkey="i", f="d", o="d"))
def join_side_by_side(t: Tables) -> DataFrame:
    sums = t("orders").groupBy("o_custkey", "o_orderstatus").agg(F.sum("o_totalprice").alias("total"))
    return rounded(rel.side_by_side(sums, ["o_custkey"], "o_orderstatus", ["F", "O"], ["total"]).toDF("o_custkey", "f", "o"))


@query(shown("""select client, contract, month, open_value, oldest_due, newest_due, has_first_bill, case when first_paid is null then 0 else 1 end as paid, date_diff('day', oldest_due, first_paid) as days_late
    from (select o_custkey as client, l_suppkey % 3 as contract, year(o_orderdate) * 100 + month(o_orderdate) as month, sum(l_extendedprice) as open_value, min(cast(o_orderdate as date)) as oldest_due,
      max(cast(o_orderdate as date)) as newest_due, max(case when l_linenumber = 1 then 1 else 0 end) as has_first_bill from lineitem join orders on l_orderkey = o_orderkey group by all)
    left join (select o_custkey as c2, l_suppkey % 3 as k2, year(l_shipdate) * 100 + month(l_shipdate) as m2, min(cast(l_shipdate as date)) as first_paid
      from lineitem join orders on l_orderkey = o_orderkey group by all) on c2 = client and k2 = contract and m2 = month""",
             client="i", contract="i", month="i", open_value="d", oldest_due="t", newest_due="t", has_first_bill="i", paid="i", days_late="i"))
def book_delinquency(t: Tables) -> DataFrame:
    b = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).withColumn("contract", F.col("l_suppkey") % 3)
    d = rel.delinquency_vs_payment(b, b, "o_custkey", "contract", "o_orderdate", "l_extendedprice", F.col("l_linenumber") == 1, "o_custkey", "contract", "l_shipdate")
    return rounded(d.drop("first_paid"))


LATE = "date_diff('day', cast(o_orderdate as date), cast(l_shipdate as date))"


@query(shown(f"""select o_custkey, count(*) as n, count(*) filter (where d > 0) as n_late, count(*) filter (where d = 0) as n_on_time, count(*) filter (where d < 0) as n_early,
    count(*) filter (where d is null) as n_unpaid, count(*) filter (where d <= 0) as n_em_dia, count(*) filter (where d between 1 and 5) as n_01_05, count(*) filter (where d between 6 and 15) as n_06_15,
    count(*) filter (where d between 16 and 30) as n_16_30, count(*) filter (where d > 30) as n_30_plus, count(*) filter (where d > 0) * 100.0 / count(d) as late_percent, avg(d) as mean_delay, max(d) as max_delay
    from (select o_custkey, {LATE} as d from lineitem join orders on l_orderkey = o_orderkey) group by o_custkey""",
             o_custkey="i", n="i", n_late="i", n_on_time="i", n_early="i", n_unpaid="i", n_em_dia="i", n_01_05="i", n_06_15="i", n_16_30="i", n_30_plus="i", late_percent="d", mean_delay="d", max_delay="i"))
def book_delays(t: Tables) -> DataFrame:
    b = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return rounded(rel.delay_book(b, "o_custkey", "o_orderdate", "l_shipdate"))


# ---- aggregates ----------------------------------------------------------------------------


@query(shown("""select lang, count(*) as total, count(*) filter (where quality = 1) as bad, count(*) filter (where quality = 0) as good, count(*) filter (where quality is null) as unlabeled, avg(quality) as rate
    from documents left join (select doc_id, quality from labels) using (doc_id) group by lang""", lang="s", total="i", bad="i", good="i", unlabeled="i", rate="d"))
def aggregate_label_rate(t: Tables) -> DataFrame:
    return rounded(rel.label_rate(t("documents").join(t("labels"), "doc_id", "left"), "quality", ["lang"]))


@query(shown("""select o_custkey, count(*) as n, count(distinct o_orderpriority) as n_priorities, sum(o_totalprice) as total, avg(o_totalprice) as mean, min(o_totalprice) as low, max(o_totalprice) as high,
    stddev_samp(o_totalprice) as std, coalesce(sum(o_totalprice) filter (where o_orderstatus = 'F'), 0) as total_f, avg(o_totalprice) filter (where o_orderstatus = 'P') as mean_p,
    min(o_totalprice) filter (where o_totalprice > 0) as low_positive, date_diff('day', min(cast(o_orderdate as date)), max(cast(o_orderdate as date))) as span, count(distinct year(o_orderdate) * 100 + month(o_orderdate)) as months,
    min_by(o_orderpriority, o_orderdate) as first_priority from (select * from orders) group by o_custkey""",
             o_custkey="i", n="i", n_priorities="i", total="d", mean="d", low="d", high="d", std="d", total_f="d", mean_p="d", low_positive="d", span="i", months="i"))
def aggregate_statistics(t: Tables) -> DataFrame:
    v, s = F.col("o_totalprice"), F.col("o_orderstatus")
    return rounded(t("orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("o_orderpriority").alias("n_priorities"), F.sum(v).alias("total"), F.avg(v).alias("mean"), F.min(v).alias("low"), F.max(v).alias("high"),
        F.stddev_samp(v).alias("std"), F.sum(F.when(s == "F", v).otherwise(0)).alias("total_f"), F.avg(F.when(s == "P", v)).alias("mean_p"), F.min(F.when(v > 0, v)).alias("low_positive"),
        F.datediff(F.max("o_orderdate"), F.min("o_orderdate")).alias("span"), F.count_distinct(F.date_format("o_orderdate", "yyyyMM")).alias("months")))


@query(shown("""select l_returnflag, quantile_cont(l_extendedprice, 0.1) as p10, quantile_cont(l_extendedprice, 0.5) as p50, quantile_cont(l_extendedprice, 0.9) as p90, avg(l_extendedprice) as mean, count(*) as n
    from lineitem group by l_returnflag""", l_returnflag="s", p10="d", p50="d", p90="d", mean="d", n="i"))
def aggregate_percentiles(t: Tables) -> DataFrame:
    return rounded(rel.percentile_columns(t("lineitem"), ["l_returnflag"], "l_extendedprice", [0.1, 0.5, 0.9]))


@query(shown("select l_returnflag, quantile_disc(l_quantity, 0.25) as p25, quantile_disc(l_quantity, 0.5) as p50, avg(l_quantity) as mean, count(*) as n from lineitem group by l_returnflag",
             l_returnflag="s", p25="d", p50="d", mean="d", n="i"))
def aggregate_percentiles_approximate(t: Tables) -> DataFrame:
    """A column of few distinct values, where the estimate is the value itself."""
    return rounded(rel.percentile_columns(t("lineitem"), ["l_returnflag"], "l_quantity", [0.25, 0.5], accuracy=1_000_000))


@query(shown("""select user_id, max(case when event_type like 'p%' then value end) as top_p, max(case when event_type like 'c%' then value end) as top_c, count(distinct event_type) as kinds from events group by user_id""",
             user_id="i", top_p="d", top_c="d", kinds="i"))
def aggregate_pivot_by_pattern(t: Tables) -> DataFrame:
    v, kind = F.col("value"), F.col("event_type")
    return rounded(t("events").groupBy("user_id").agg(
        F.max(F.when(kind.like("p%"), v)).alias("top_p"), F.max(F.when(kind.like("c%"), v)).alias("top_c"), F.count_distinct("event_type").alias("kinds")))


@query(shown("select o_orderkey, least(floor(cume_dist() over (partition by o_custkey order by o_totalprice) * 5), 4) as band from orders", o_orderkey="i", band="i"))
def window_relative_rank(t: Tables) -> DataFrame:
    return rounded(rel.relative_bands(t("orders"), ["o_custkey"], "o_totalprice", 5).select("o_orderkey", "band"))


@query(shown("select d.doc_id as doc_id, lang, quality from documents d join labels l on d.doc_id = l.doc_id", doc_id="i", lang="s", quality="i"))
def join_scores_labels(t: Tables) -> DataFrame:
    return rounded(rel.scores_with_labels(t("documents").select("doc_id", "lang"), t("labels").select("doc_id", "quality"), ["doc_id"]))


@query(shown("select o_orderpriority, count(*) filter (where o_orderstatus = 'F') as f, count(*) filter (where o_orderstatus = 'O') as o, count(*) filter (where o_orderstatus = 'P') as p from orders group by all",
             o_orderpriority="s", f="i", o="i", p="i"))
def aggregate_crosstab(t: Tables) -> DataFrame:
    return rel.crosstab(t("orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"]).toDF("o_orderpriority", "f", "o", "p")


@query("select o_orderpriority, o_orderstatus, count(*) as n from orders group by all having count(*) > 1")
def aggregate_duplicates(t: Tables) -> DataFrame:
    return t("orders").groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


# ---- windows, top-k, sets ---------------------------------------------------------------------


@query("select tile, count(*) as n, cast(sum(o_orderkey) % 1000003 as bigint) as keys from (select o_orderkey, ntile(10) over (order by o_totalprice desc, o_orderkey) as tile from orders) group by tile")
def window_score_tiles(t: Tables) -> DataFrame:
    tiles = rel.score_tiles(t("orders"), "o_totalprice", "o_orderkey")
    return tiles.groupBy("tile").agg(F.count(F.lit(1)).alias("n"), (F.sum("o_orderkey") % 1000003).alias("keys")).withColumn("tile", F.col("tile").cast("long"))


SHARES = """select *, total / sum(total) over () as share, sum(total) over (order by total desc, c_nationkey rows between unbounded preceding and current row) / sum(total) over () as cum_share
    from (select c_nationkey, sum(o_totalprice) as total from orders join customer on o_custkey = c_custkey group by c_nationkey)"""


def by_nation(t: Tables) -> DataFrame:
    return t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey"))


@query(shown(SHARES, c_nationkey="i", total="d", share="d", cum_share="d"))
def window_share_of_total(t: Tables) -> DataFrame:
    return rounded(rel.share_of_total(by_nation(t), ["c_nationkey"], "o_totalprice"))


@query(shown(f"select * from ({SHARES}) where cum_share - share < 0.5", c_nationkey="i", total="d", share="d", cum_share="d"))
def window_until_share(t: Tables) -> DataFrame:
    return rounded(rel.until_share(by_nation(t), ["c_nationkey"], "o_totalprice", 0.5))


YEARLY = "select c_nationkey, cast(year(o_orderdate) as bigint) as yr, sum(o_totalprice) as total from orders join customer on o_custkey = c_custkey group by all"


def yearly(t: Tables) -> DataFrame:
    return by_nation(t).groupBy("c_nationkey", F.year("o_orderdate").cast("long").alias("yr")).agg(F.sum("o_totalprice").alias("total"))


@query(f"""select c_nationkey, min(r) as best, max(r) as worst, max(r) - min(r) as change, max(r) - min(r) > 5 as unstable
    from (select c_nationkey, row_number() over (partition by yr order by total desc, c_nationkey) as r from ({YEARLY})) group by c_nationkey""")
def window_rank_changes(t: Tables) -> DataFrame:
    out = rel.rank_changes(yearly(t), "c_nationkey", "yr", "total")
    return out.withColumns({c: F.col(c).cast("long") for c in ("best", "worst", "change")})


@query(shown(f"""select yr, nxt as "next", len(list_intersect(s, n)) / len(list_distinct(list_concat(s, n))) as jaccard from (select yr, s, lead(s) over (order by yr) as n, lead(yr) over (order by yr) as nxt from (
    select yr, list(c_nationkey) as s from (select *, row_number() over (partition by yr order by total desc, c_nationkey) as r from ({YEARLY})) where r <= 8 group by yr)) where nxt is not null""",
             yr="i", next="i", jaccard="d"))
def set_top_jaccard(t: Tables) -> DataFrame:
    return rounded(rel.top_set_jaccard(yearly(t), "c_nationkey", "yr", "total", 8))


@query("""select "column", value, n, rank from (select *, row_number() over (partition by "column" order by n desc, value) as rank from (
    select 'o_orderpriority' as "column", o_orderpriority as value, count(*) as n from orders group by all union all select 'o_orderstatus', o_orderstatus, count(*) from orders group by all)) where rank <= 3""")
def topk_values(t: Tables) -> DataFrame:
    return rel.top_values(t("orders"), ["o_orderpriority", "o_orderstatus"], 3).withColumn("rank", F.col("rank").cast("long"))


@query("select o_orderkey from (select o_orderkey, row_number() over (order by o_totalprice desc, o_orderkey) as r, count(*) over () as n from orders) where r <= floor(n * 0.1)")
def topk_share(t: Tables) -> DataFrame:
    return rel.top_share(t("orders"), "o_totalprice", "o_orderkey", 0.1).select("o_orderkey")


@query("select user_id, count(*) as n from events group by user_id having count(*) >= 60")
def topk_at_least(t: Tables) -> DataFrame:
    return rel.at_least(t("events"), "user_id", 60)


@query(shown("select event_id, ts, event_type from events where user_id = (select min(user_id) from events)", event_id="i", ts="t", event_type="s"))
def topk_timeline(t: Tables) -> DataFrame:
    e = t("events")
    first = e.agg(F.min("user_id").alias("u")).first()["u"]
    return rounded(rel.timeline(e, "user_id", first, "ts").select("event_id", "ts", "event_type"))


@query("select o_orderpriority, count(*) as n, case left(o_orderpriority, 1) when '3' then 0 when '1' then 1 else 2 end as place from orders group by all")
def topk_category_order(t: Tables) -> DataFrame:
    o = t("orders").groupBy("o_orderpriority", F.substring("o_orderpriority", 1, 1).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    return o.withColumn("place", rel.category_order("p", ["3", "1"])).orderBy("place", "o_orderpriority").drop("p")


@query(shown("select o_custkey, count(*) as n, sum(o_totalprice) as total, null as top from orders where o_orderstatus = 'F' group by 1 union all select o_custkey, count(*), null, max(o_totalprice) from orders where o_orderstatus = 'O' group by 1",
             o_custkey="i", n="i", total="d", top="d"))
def set_union_books(t: Tables) -> DataFrame:
    o = t("orders")
    a = o.where("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total"))
    b = o.where("o_orderstatus = 'O'").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top"))
    return rounded(rel.union_books([a, b]))


@query("""select * from (select cast(unnest([1994, 1995, 1996]) as integer) as snapshot except select cast(year(o_orderdate) as integer) from orders), (select 'missing' as problem) union all
    select * from (select cast(year(o_orderdate) as integer) as snapshot from orders except select unnest([1994, 1995, 1996])), (select 'unexpected' as problem)""")
def set_snapshot_differences(t: Tables) -> DataFrame:
    return rel.snapshot_differences(t("orders").withColumn("yr", F.year("o_orderdate")), "yr", [1994, 1995, 1996])


@query("select count(*) filter (where l_discount > 0.05 and l_tax > 0.04) as both, count(*) filter (where l_discount > 0.05 and not l_tax > 0.04) as only_a, count(*) filter (where not l_discount > 0.05 and l_tax > 0.04) as only_b from lineitem")
def set_overlap(t: Tables) -> DataFrame:
    return rel.set_overlap(t("lineitem"), F.col("l_discount") > 0.05, F.col("l_tax") > 0.04)


@query("select o_orderkey, cast(('0x' || substr(md5(o_orderkey || ':split'), 1, 8)) as bigint) % 100 < 25 as chosen from orders")
def set_hash_split(t: Tables) -> DataFrame:
    """The keys of a sample, and those of its complement."""
    return t("orders").select("o_orderkey", clean.hash_split(F.col("o_orderkey"), 25).alias("chosen"))


# ---- derived features ------------------------------------------------------------------------------


@query(shown(f"""select o_orderkey, case when rare is null then 1 else 0 end + case when often is null then 1 else 0 end as v_n_missing,
    (case when rare is null then 1 else 0 end + case when often is null then 1 else 0 end) / 2 as v_missing_share, case when rare is null and often is null then 1 else 0 end as missing_pattern,
    case when rare is null then 1 else 0 end as rare_is_null from ({SPARSE})""", o_orderkey="i", v_n_missing="i", v_missing_share="d", missing_pattern="i", rare_is_null="i"))
def features_missing(t: Tables) -> DataFrame:
    f = features.null_flags(features.missing_features(sparse(t), {"v": ["rare", "often"]}), ["rare"])
    return rounded(f.select("o_orderkey", "v_n_missing", "v_missing_share", "missing_pattern", "rare_is_null"))


@query(shown("""select l_orderkey, l_linenumber, l_discount * l_tax as l_discount_x_l_tax, l_discount - l_tax as l_discount_minus_l_tax, abs(l_discount - l_tax) as l_discount_gap_l_tax,
    coalesce(l_discount / nullif(l_tax, 0), 0) as l_discount_per_l_tax, case when l_discount > (select quantile_cont(l_discount, 0.5) from lineitem) and l_tax > (select quantile_cont(l_tax, 0.5) from lineitem) then 1 else 0 end as l_discount_l_tax_both_high
    from lineitem""", l_orderkey="i", l_linenumber="i", l_discount_x_l_tax="d", l_discount_minus_l_tax="d", l_discount_gap_l_tax="d", l_discount_per_l_tax="d", l_discount_l_tax_both_high="i"))
def features_interactions(t: Tables) -> DataFrame:
    li = t("lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    out = features.combination_flags(features.interactions(li, [("l_discount", "l_tax")]), [("l_discount", "l_tax")])
    return rounded(out.drop("l_discount", "l_tax"))


@query(shown("select l_orderkey, l_linenumber, least(greatest(coalesce(l_extendedprice / nullif(l_quantity, 0), 0), 100), 1500) as unit, coalesce(l_discount / nullif(l_tax, 0), 0) as relief from lineitem",
             l_orderkey="i", l_linenumber="i", unit="d", relief="d"))
def features_ratios(t: Tables) -> DataFrame:
    li = features.domain_ratios(t("lineitem"), {"unit": ("l_extendedprice", "l_quantity")}, 100.0, 1500.0)
    return rounded(features.domain_ratios(li, {"relief": ("l_discount", "l_tax")}).select("l_orderkey", "l_linenumber", "unit", "relief"))


CLIENTS = """select o_custkey, date_diff('day', min(cast(o_orderdate as date)), date '2001-09-01') as since_first, date_diff('day', max(cast(o_orderdate as date)), date '2001-09-01') as since_last,
    count(*) as n, date_diff('day', min(cast(o_orderdate as date)), max(cast(o_orderdate as date))) as span from orders group by o_custkey"""


@query(shown(f"""select o_custkey, case when since_first > -1 and since_first <= 30 then 0 when since_first <= 90 then 1 when since_first <= 180 then 2 when since_first <= 365 then 3 else 4 end as tenure_bucket,
    case when since_last <= 7 then 0 when since_last <= 30 then 1 when since_last <= 90 then 2 when since_last <= 180 then 3 else 4 end as recency_bucket,
    case when since_last > 90 then 'lapsed' when since_first <= 90 then 'new' else 'active' end as lifecycle, since_first - since_last as recency_gap, n / since_first as velocity, n / (span + 1) as density,
    span / since_first as active_window, (since_first - since_last) / since_first as recent_trend, coalesce(span / nullif(n, 0), 0) as regularity from ({CLIENTS})""",
             o_custkey="i", tenure_bucket="i", recency_bucket="i", lifecycle="s", recency_gap="d", velocity="d", density="d", active_window="d", recent_trend="d", regularity="d"))
def features_temporal(t: Tables) -> DataFrame:
    end = F.lit("2001-09-01").cast("date")
    c = t("orders").groupBy("o_custkey").agg(
        F.datediff(end, F.min("o_orderdate")).alias("since_first"), F.datediff(end, F.max("o_orderdate")).alias("since_last"), F.count(F.lit(1)).alias("n"),
        F.datediff(F.max("o_orderdate"), F.min("o_orderdate")).alias("span"))
    return rounded(features.temporal_features(c, "since_first", "since_last", "n", "span").drop("since_first", "since_last", "n", "span"))


@query(shown("select c_custkey, sign(c_acctbal) * ln(1 + abs(c_acctbal)) as log_bal, sign(c_acctbal) * sqrt(abs(c_acctbal)) as sqrt_bal from customer", c_custkey="i", log_bal="d", sqrt_bal="d"))
def features_signed_transforms(t: Tables) -> DataFrame:
    b = F.col("c_acctbal")
    return rounded(t("customer").select("c_custkey", features.signed_log(b).alias("log_bal"), features.signed_sqrt(b).alias("sqrt_bal")))


@query(shown("""select c_custkey, len(list_filter(list_slice(e, 2, len(e) - 1), lambda x: c_acctbal > x)) as c_acctbal_q4 from customer,
    (select list_sort(list_distinct(quantile_cont(c_acctbal, [0, 0.25, 0.5, 0.75, 1]))) as e from customer)""", c_custkey="i", c_acctbal_q4="i"))
def features_score_quantile(t: Tables) -> DataFrame:
    return rounded(features.score_quantile(t("customer"), "c_acctbal", 4).select("c_custkey", "c_acctbal_q4"))


@query(shown("""select c_custkey, coalesce(n / tot, 0) as c_mktsegment_freq from customer left join (select c_mktsegment as s, count(*) as n from customer where c_acctbal > 0 group by 1) on s = c_mktsegment,
    (select count(*) as tot from customer where c_acctbal > 0)""", c_custkey="i", c_mktsegment_freq="d"))
def features_frequency_encode(t: Tables) -> DataFrame:
    return rounded(features.frequency_encode(t("customer"), "c_mktsegment", F.col("c_acctbal") > 0).select("c_custkey", "c_mktsegment_freq"))


@query()
def features_domain_pca(t: Tables) -> DataFrame:
    li = t("lineitem").withColumn("l_qty", F.col("l_quantity").cast("double"))
    domains = {"price": (["l_qty", "l_extendedprice"], 2), "terms": (["l_discount", "l_tax"], 1)}
    model = features.fit_domain_pca(li.where("l_shipdate < '1999-01-01'"), domains)
    out = features.apply_domain_pca(model, li, domains)
    return rounded(out.select("l_orderkey", "l_linenumber", "price_pc1", "price_pc2", "terms_pc1"))
