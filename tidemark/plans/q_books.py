"""Books over the star-schema tables in the roles of recharges, payments and bills."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.book_engine import build_book, build_book_by_snapshot
from tidemark.plans.book_run import book_counts, book_rollup, run_book
from tidemark.plans.book_spec import BookSpec, naive_sql
from tidemark.plans.books import billing_book, payment_book, recharge_book
from tidemark.plans.registry import Tables, query, rounded, shown
from tidemark.sources.io import scratch_path

WEEKS = {20240108: "2024-01-08", 20240115: "2024-01-15", 20240122: "2024-01-22", 20240129: "2024-01-29"}
YEARS = {y * 100 + 1: f"{y}-01-01" for y in range(1996, 2002)}


def forms(spec: BookSpec) -> dict[str, str]:
    """How each column of a book is shown."""
    kinds = {a.name: {"count": "i", "distinct": "i", "first_date": "t", "last_date": "t", "latest": "s"}.get(a.kind, "d") for a in spec.aggregates}
    whole = {"span_days", "days_since_last", "days_since_first", "days_active", "high_risk", "low_risk"}
    return {spec.client: "i", "snapshot": "i", "cutoff": "t", **kinds, **{d: "i" if d in whole else "s" if d == "risk_segment" else "d" for d in spec.derived}}


def oracle(spec: BookSpec, facts: str, cutoffs: dict[int, str]) -> str:
    return shown(naive_sql(spec, facts, cutoffs), **forms(spec))


# ---- recharges: events ---------------------------------------------------------

#: Event types in the roles of the code columns.
EVENT_ROLES = """
    user_id, ts, value, case when event_id % 11 = 0 then null else value * 0.1 end as bonus, value * 0.9 as real_value,
    case event_type when 'click' then 'PREPG' when 'view' then 'CTLFC' when 'purchase' then 'AUTOC' when 'signup' then 'FLEXD' else 'POSPG' end as platform,
    case event_id % 4 when 0 then 'A' when 1 then 'A' when 2 then 'ZB1' else 'ZB2' end as status,
    case event_id % 3 when 0 then 'NaoSeAplica' when 1 then 'Rec.Online' else 'ChipPre' end as card,
    case user_id % 2 when 0 then 'Varejo' else 'Mid' end as plan, case event_id % 2 when 0 then 'Street Seller' else 'Venda Direta' end as institution,
    case when event_id % 9 = 0 then 1 when event_id % 5 = 0 then null else 0 end as sos, event_id, event_type"""

RECHARGE = recharge_book(
    client="user_id", date="ts", credit="value", bonus="bonus", real="real_value", platform="platform", status="status", card="card",
    plan="plan", institution="institution", sos="sos", distinct={"plataformas": "platform", "tipos": "event_type", "cards": "card"})


def recharges(t: Tables) -> DataFrame:
    return t("events").selectExpr(*_columns(EVENT_ROLES))


def _columns(text: str) -> list[str]:
    """Split a select list at its top-level commas."""
    out, depth, at = [], 0, 0
    for i, c in enumerate(text):
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append(text[at:i])
            at = i + 1
    return [x.strip() for x in [*out, text[at:]]]


@query(oracle(RECHARGE, f"select {EVENT_ROLES} from events", WEEKS))
def book_recharge(t: Tables) -> DataFrame:
    return rounded(build_book(recharges(t), RECHARGE, WEEKS))


@query(oracle(RECHARGE, f"select {EVENT_ROLES} from events", WEEKS))
def book_recharge_by_snapshot(t: Tables) -> DataFrame:
    return rounded(build_book_by_snapshot(recharges(t), RECHARGE, WEEKS))


# ---- payments: orders ----------------------------------------------------------

ORDER_ROLES = """
    o_custkey, o_orderdate, o_totalprice, o_totalprice * 0.5 as credit, case when o_orderkey % 3 = 0 then o_totalprice * 0.02 else 0 end as interest,
    case when o_orderkey % 17 = 0 then 10.0 else null end as fine, o_totalprice * 1.05 as original, o_totalprice * 0.97 as current_value,
    case o_orderstatus when 'F' then 'C' when 'O' then 'R' else 'P' end as status, case o_orderstatus when 'O' then 'O' else 'C' end as invoice,
    substring(o_orderpriority, 1, 1) as priority, case substring(o_orderpriority, 1, 1) when '1' then 'CA' when '2' then 'PB' when '3' then 'DD' else 'PA' end as form,
    case o_orderkey % 3 when 0 then 'O' when 1 then 'P' else 'D' end as kind, case o_orderkey % 2 when 0 then 'PYM' else 'CRT' end as allocation, o_orderkey"""

PAYMENT = payment_book(
    client="o_custkey", date="o_orderdate", paid="o_totalprice", values={"half": "credit"}, credit="credit", interest="interest", fine="fine",
    original="original", current="current_value", status="status", invoice="invoice", form="form", kind="kind", allocation="allocation",
    created="o_orderdate", settled="o_orderdate", deposited="o_orderdate", loaded="o_orderdate",
    distinct={"contratos": "o_orderkey % 7", "priorities": "priority"}, main={"form": "form", "kind": "kind"})


def payments(t: Tables) -> DataFrame:
    return t("orders").selectExpr(*_columns(ORDER_ROLES))


@query(oracle(PAYMENT, f"select {ORDER_ROLES} from orders", YEARS))
def book_payment(t: Tables) -> DataFrame:
    return rounded(build_book(payments(t), PAYMENT, YEARS))


# ---- bills: lineitem with its order ---------------------------------------------

BILL_ROLES = """
    o_custkey, o_orderdate as reference, o_orderdate as created, o_orderdate as due, l_shipdate as settled, l_extendedprice as gross,
    l_extendedprice * (1 - l_discount) as net, l_extendedprice * l_discount as credit,
    case when l_linestatus = 'O' then l_extendedprice else 0 end as open_value, l_tax * l_extendedprice as interest, l_orderkey % 13 as contract,
    case l_returnflag when 'R' then 'W' else 'R' end as write_off, case l_linestatus when 'O' then 'S' else 'N' end as provision,
    case l_returnflag when 'A' then 'C' else 'W' end as pccr, case when l_quantity > 40 then 'S' else 'N' end as aca,
    case when l_linenumber = 1 then 'S' else 'N' end as first_bill, case when l_quantity = 50 then 'S' else null end as fraud,
    case l_linenumber when 1 then 'Y' when 2 then 'S' else 'N' end as exempt,
    case l_suppkey % 4 when 0 then 'AUTOC' when 1 then 'POSPG' when 2 then 'PREPG' else '-2' end as platform,
    case l_suppkey % 3 when 0 then 'Pós Pago' when 1 then 'Pré Pago' else 'Controle' end as platform_group"""

BILLING = billing_book(
    client="o_custkey", date="reference", gross="gross", net="net", credit="credit", open_value="open_value", open_net="open_value",
    interest="interest", cancel="credit", totals={"paid": "net"}, contract="contract", created="created", due="due", settled="settled",
    activated="created", platform="platform", group="platform_group", write_off="write_off", provision="provision", pccr="pccr", aca="aca",
    first_bill="first_bill", fraud="fraud", exempt="exempt")
BILL_SQL = f"select {BILL_ROLES} from lineitem join orders on l_orderkey = o_orderkey"


def bills(t: Tables) -> DataFrame:
    return t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(*_columns(BILL_ROLES))


@query(oracle(BILLING, BILL_SQL, YEARS))
def book_billing(t: Tables) -> DataFrame:
    return rounded(build_book(bills(t), BILLING, YEARS))


# ---- runs and rollups ---------------------------------------------------------------

ROLLUP = f"""select case when grouping(snapshot) = 1 then 'total' when grouping(risk_segment) = 1 then 'snapshot' else 'segment' end as level,
    snapshot, risk_segment, count(*) as n, sum(credit_total) as total, max(n_total) as most from ({naive_sql(RECHARGE, f"select {EVENT_ROLES} from events", WEEKS)}) group by rollup (snapshot, risk_segment)"""


@query(shown(ROLLUP, level="s", snapshot="i", risk_segment="s", n="i", total="d", most="i"))
def book_rollup_by_segment(t: Tables) -> DataFrame:
    """Segments, snapshots and the total of a book from one pass."""
    book = build_book(recharges(t), RECHARGE, WEEKS)
    return rounded(book_rollup(book, "risk_segment", {"total": "sum(credit_total)", "most": "max(n_total)"}))


RUNS = " union all ".join(
    f"select {k} as snapshot, count(distinct o_custkey) as rows, 'SUCCESS' as status, {2 if k == max(YEARS) else 1} as run from orders where o_orderdate < timestamp '{c}'" for k, c in YEARS.items())


@query(shown(RUNS, snapshot="i", rows="i", status="s", run="i"))
def book_run_resumed(t: Tables) -> DataFrame:
    """A run in which the last snapshot's cut-off is no date, and a second one that adds only this snapshot."""
    facts = payments(t)
    target = scratch_path(facts.sparkSession)
    bad = YEARS | {max(YEARS): "2001-13-01"}
    first = run_book(facts, PAYMENT, bad, target).where("status = 'SUCCESS'").withColumn("run", F.lit(1))
    second = run_book(facts, PAYMENT, YEARS, target).withColumn("run", F.lit(2))
    landed = first.unionByName(second).select("snapshot", F.col("run").alias("landed_in"))
    return rounded(book_counts(facts.sparkSession, target).join(landed, "snapshot").select("snapshot", "rows", "status", F.col("landed_in").alias("run")))
