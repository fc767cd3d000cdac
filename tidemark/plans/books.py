"""The three client books: recharge, payment and billing.

Each function takes the names of the fact's columns, so any table with these
roles will do; codes and weights are the published ones of the risk policy.
"""

from __future__ import annotations

from tidemark.plans.book_spec import (
    Agg,
    BookSpec,
    distinct_counts,
    equals,
    flag_counts,
    flag_of,
    flag_sums,
    least_positive,
    rates,
    ratio,
    segments,
    value_stats,
    weighted_score,
)


def recharge_book(
    client: str = "NUM_CPF", date: str = "DAT_INSERCAO_CREDITO", credit: str = "VAL_CREDITO_INSERIDO", bonus: str = "VAL_BONUS",
    real: str = "VAL_REAL", platform: str = "COD_PLATAFORMA_ATU", status: str = "COD_STATUS_PLATAFORMA", card: str = "DSC_GRUPO_CARTAO_WPP",
    plan: str = "DSC_TIPO_PLANO_BI", institution: str = "DSC_TIPO_INSTITUICAO", sos: str = "FLAG_SOS",
    distinct: dict[str, str] | None = None,
) -> BookSpec:
    """Recharges per client: counts, values, channels, recency and a risk score."""
    # fixed values: the codes of the source system
    platforms = {"prepg": "PREPG", "autoc": "AUTOC", "flexd": "FLEXD", "ctlfc": "CTLFC", "pospg": "POSPG"}
    states = {"a": "A", "zb1": "ZB1", "zb2": "ZB2", "ndf": "NDF"}
    cards = {"na": "NaoSeAplica", "online": "Rec.Online", "promo": "AtivPromocao"}
    plans = {"varejo": "Varejo", "corp": "Corporativos", "mid": "Mid"}
    places = {"dist_reg": "Distribuidor Regional", "street": "Street Seller", "direta": "Venda Direta", "varejo": "Varejo"}
    flags = {
        **equals("plat", platform, platforms), "plat_controle": f"{platform} in ('CTLFC', 'FLEXD')",
        **equals("status", status, states), **equals("cartao", card, cards), "cartao_chippre": f"{card} like 'ChipPre%'",
        **equals("plano", plan, plans), **equals("inst", institution, places), "sos": f"{sos} = 1",
    }
    if distinct is None:
        distinct = {
            "linhas": "DW_NUM_NTC", "clientes_dw": "DW_NUM_CLIENTE", "plataformas": platform, "tipos_recarga": "DW_TIPO_RECARGA",
            "tipos_insercao": "DW_TIPO_INSERCAO", "formas_pagto": "DW_FORMA_PAGAMENTO", "instituicoes": "DW_INSTITUICAO",
            "planos": "DW_PLANO_TARIFACAO"}
    distinct = {**distinct, "dias": f"cast({date} as date)", "meses_ativos": f"year({date}) * 100 + month({date})"}
    lines = "n_linhas" if "linhas" in distinct else "n_plataformas"
    valued = ["plat_prepg", "plat_autoc", "plat_flexd", "plat_ctlfc", "status_a", "status_zb1", "status_zb2", "cartao_online", "cartao_promo",
              "plano_varejo", "plano_corp", "inst_street", "inst_direta", "sos"]
    aggregates = [
        Agg("n_total", "count"), *distinct_counts(distinct),
        *value_stats("credit", credit, "sum avg max stddev"), least_positive("credit_min", credit),
        *value_stats("bonus", bonus), *value_stats("real", real, "sum avg max stddev"),
        *flag_counts(list(flags)), *flag_sums(valued, credit),
        Agg("first_at", "first_date", date), Agg("last_at", "last_date", date),
        Agg("main_plan", "latest", plan), Agg("main_institution", "latest", institution),
        Agg("main_card", "latest", card), Agg("main_platform", "latest", platform),
    ]
    blocked = "(qty_status_zb1 + qty_status_zb2)"
    derived = {
        "span_days": "cast(datediff(day, cast(first_at as date), cast(last_at as date)) as bigint)",
        "days_since_last": "cast(datediff(day, cast(last_at as date), cutoff) as bigint)",
        "days_since_first": "cast(datediff(day, cast(first_at as date), cutoff) as bigint)",
        **rates(["qty_plat_prepg", "qty_plat_autoc", "qty_plat_controle", "qty_status_a", "qty_status_zb1", "qty_status_zb2",
                 "qty_cartao_online", "qty_cartao_promo", "qty_sos"], "n_total"),
        **rates(["val_plat_prepg", "val_plat_autoc", "val_cartao_online"], "credit_total", "share"),
        "cv_credit": ratio("credit_stddev", "credit_mean"), "cv_real": ratio("real_stddev", "real_mean"),
        "concentration": ratio("credit_max", "credit_total"), "ticket_per_line": ratio("credit_total", lines),
        "daily_frequency": ratio("n_total", "greatest(span_days, 1)"), "bonus_ratio": ratio("bonus_total", "credit_total"),
        "risk_score": weighted_score({
            "rate_plat_controle": 30, ratio(blocked, "n_total"): 25, "least(1, coalesce(rate_sos, 0) * 3)": 20,
            "least(1, coalesce(cv_credit, 0))": 15, "least(1, coalesce(concentration, 0))": 10}),
        "high_risk": flag_of(f"qty_plat_controle > n_total * 0.5 or {blocked} > n_total * 0.3 or qty_sos > n_total * 0.2"),
        "low_risk": flag_of("qty_plat_prepg = n_total and qty_status_a > n_total * 0.95 and qty_sos = 0"),
        "risk_segment": segments({
            "CRITICO": f"qty_plat_controle > n_total * 0.5 or {blocked} > n_total * 0.3",
            "ALTO": "qty_plat_controle > 0 or qty_sos > n_total * 0.1", "MEDIO": "qty_status_zb1 > 0 or qty_sos > 0"}, "BAIXO"),
    }
    return BookSpec(client, date, aggregates, flags, derived)


def payment_book(
    client: str = "NUM_CPF", date: str = "DAT_STATUS_FATURA", paid: str = "VAL_PAGAMENTO_FATURA", values: dict[str, str] | None = None,
    credit: str = "VAL_PAGAMENTO_CREDITO", interest: str = "VAL_JUROS_MULTAS_ITEM", fine: str = "VAL_MULTA_EQUIP_ITEM",
    original: str = "VAL_ORIGINAL_PAGAMENTO", current: str = "VAL_ATUAL_PAGAMENTO", status: str = "IND_STATUS_PAGAMENTO",
    invoice: str = "IND_STATUS_FATURA", form: str = "COD_FORMA_PAGAMENTO", kind: str = "COD_TIPO_PAGAMENTO",
    allocation: str = "COD_ALOCACAO_CREDITO", created: str = "DAT_CRIACAO_ATIVIDADE", settled: str = "DAT_BAIXA_ATIVIDADE",
    deposited: str = "DAT_DEPOSITO_ATIVIDADE", loaded: str = "DAT_CRIACAO_DW", distinct: dict[str, str] | None = None,
    main: dict[str, str] | None = None,
) -> BookSpec:
    """Payments per client: amounts by status, form, type and allocation, delays and a risk score."""
    # fixed values: the codes of the source system
    statuses = {"r": "R", "c": "C", "p": "P", "b": "B"}
    invoices = {"fechada": "C", "aberta": "O"}
    forms = {"ca": "CA", "pb": "PB", "dd": "DD", "pa": "PA"}
    kinds = {"o": "O", "p": "P", "d": "D", "b": "B"}
    allocations = {"pym": "PYM", "crt": "CRT", "crtw": "CRTW"}
    by_paid = {**equals("status", status, statuses), **equals("fatura", invoice, invoices), **equals("forma", form, forms), **equals("tipo", kind, kinds)}
    flags = {**by_paid, **equals("alocacao", allocation, allocations)}
    if values is None:
        values = {"item": "VAL_PAGAMENTO_ITEM", "baixa": "VAL_BAIXA_ATIVIDADE"}
    if distinct is None:
        distinct = {"contratos": "CONTRATO", "faturas": "SEQ_FATURA", "formas": "DW_FORMA_PAGAMENTO", "bancos": "DW_BANCO",
                    "tipos_fatura": "DW_TIPO_FATURA", "un_negocios": "DW_UN_NEGOCIO", "areas": "DW_AREA", "tipos_inst": "DSC_TIPO_INSTITUICAO"}
    if main is None:
        main = {"form": "DSC_FORMA_PAGAMENTO", "institution": "DSC_TIPO_INSTITUICAO", "billing": "DSC_TIPO_FATURAMENTO_ABREV"}
    distinct = {**distinct, "meses_ativos": f"year({date}) * 100 + month({date})"}

    def days(a: str, b: str) -> str:
        return f"cast(datediff(day, cast({b} as date), cast({a} as date)) as bigint)"

    aggregates = [
        Agg("n_total", "count"), *distinct_counts(distinct),
        *value_stats("paid", paid, "sum avg max stddev"), *value_stats("credit", credit),
        *value_stats("current", current, "sum avg"), *value_stats("original", original, "sum avg"),
        *(a for name, v in values.items() for a in value_stats(name, v, "sum avg")),
        *value_stats("interest", interest), Agg("n_with_interest", "count", where=f"{interest} > 0"),
        Agg("fine_total", "sum", f"coalesce({fine}, 0)"), Agg("n_fines", "count", where=f"{fine} > 0"),
        *flag_counts(list(flags)), *flag_sums(list(by_paid), paid), *flag_sums(["alocacao_pym", "alocacao_crt"], credit),
        Agg("first_at", "first_date", date), Agg("last_at", "last_date", date),
        Agg("first_loaded", "first_date", loaded), Agg("last_loaded", "last_date", loaded),
        Agg("settle_days_mean", "avg", days(settled, created)), Agg("deposit_days_mean", "avg", days(deposited, created)),
        *(Agg(f"main_{n}", "latest", c) for n, c in main.items()),
    ]
    contracts = "n_contratos" if "contratos" in distinct else "n_total"
    derived = {
        "span_days": "cast(datediff(day, cast(first_at as date), cast(last_at as date)) as bigint)",
        "days_since_last": "cast(datediff(day, cast(last_at as date), cutoff) as bigint)",
        **rates(["qty_status_r", "qty_status_c", "qty_status_p", "qty_status_b", "qty_forma_ca", "qty_forma_pb", "qty_forma_dd", "qty_forma_pa",
                 "qty_fatura_aberta"], "n_total"),
        "rate_with_interest": ratio("n_with_interest", "n_total"), "rate_interest": ratio("interest_total", "paid_total"),
        "cv_paid": ratio("paid_stddev", "paid_mean"), "concentration": ratio("paid_max", "paid_total"),
        "ticket_per_contract": ratio("paid_total", contracts), "original_less_current": "original_total - current_total",
        "risk_score": weighted_score({
            "rate_fatura_aberta": 25, "least(1, coalesce(rate_interest, 0) * 5)": 25, "rate_status_b": 20,
            "least(1, coalesce(cv_paid, 0))": 15, flag_of("n_fines > 0"): 15}),
        "high_risk": flag_of("qty_fatura_aberta > qty_fatura_fechada or interest_total > paid_total * 0.1 or qty_status_b > n_total * 0.3"),
        "low_risk": flag_of("qty_fatura_aberta = 0 and interest_total = 0 and qty_status_c > n_total * 0.9"),
        "risk_segment": segments({
            "CRITICO": "qty_fatura_aberta > qty_fatura_fechada or interest_total > paid_total * 0.2",
            "ALTO": "qty_fatura_aberta > 0 or interest_total > paid_total * 0.1",
            "MEDIO": "interest_total > 0 or qty_status_p > n_total * 0.1"}, "BAIXO"),
    }
    return BookSpec(client, date, aggregates, flags, derived)


def billing_book(
    client: str = "NUM_CPF", date: str = "DAT_REFERENCIA", gross: str = "VAL_FAT_BRUTO", net: str = "VAL_FAT_LIQUIDO", credit: str = "VAL_FAT_CREDITO",
    open_value: str = "VAL_FAT_ABERTO", open_net: str = "VAL_FAT_ABERTO_LIQ", interest: str = "VAL_MULTA_JUROS", cancel: str = "VAL_MULTA_CANCELAMENTO",
    totals: dict[str, str] | None = None, contract: str = "CONTRATO", created: str = "DAT_CRIACAO_FAT", due: str = "DAT_VENCIMENTO_FAT",
    settled: str = "DAT_STATUS_FAT", activated: str = "DAT_ATIVACAO_CONTA_CLI", platform: str = "COD_PLATAFORMA", group: str = "DSC_GRUPO_PLATAFORMA",
    write_off: str = "IND_WO", provision: str = "IND_PDD", pccr: str = "IND_PCCR", aca: str = "IND_ACA", first_bill: str = "IND_PRIMEIRA_FAT",
    fraud: str = "IND_FRAUDE", exempt: str = "IND_ISENCAO_COB_FAT", scale: float = 100,
) -> BookSpec:
    """Bills per client: values, platforms, delays and a risk score.

    The score's weights add up to 100 and the sum is multiplied by ``scale``
    before it is clamped, as published; 1 gives the plain weighted score. The
    label table isn't joined, so nothing of the target leaks into the book.
    """
    # fixed values: the codes of the source system
    platforms = {"autoc": "AUTOC", "pospg": "POSPG", "prepg": "PREPG", "posbl": "POSBL", "sem_plataforma": "-2"}
    groups = {"pos_pago": "Pós Pago", "pre_pago": "Pré Pago", "controle": "Controle", "telemetria": "Telemetria", "outros": "Outros"}
    marks = {
        "primeira": f"{first_bill} = 'S'", "wo": f"{write_off} = 'W'", "regular": f"{write_off} = 'R'", "pdd": f"{provision} = 'S'",
        "sem_pdd": f"{provision} = 'N'", "pccr_c": f"{pccr} = 'C'", "pccr_w": f"{pccr} = 'W'", "aca": f"{aca} = 'S'", "sem_aca": f"{aca} = 'N'",
        "fraude": f"{fraud} = 'S'", "isentas": f"{exempt} in ('Y', 'S')", "nao_isentas": f"{exempt} = 'N'"}
    flags = {**{f"fat_{k}": c for k, c in marks.items()}, **equals("plat", platform, platforms), **equals("grupo", group, groups)}
    if totals is None:
        totals = {"adjust": "VAL_FAT_AJUSTE", "paid": "VAL_FAT_PAGAMENTO_BRUTO", "device": "VAL_PARC_APARELHO_LIQ", "net_jm_mc": "VAL_FAT_LIQ_JM_MC"}

    def days(a: str, b: str) -> str:
        return f"cast(datediff(day, cast({b} as date), cast({a} as date)) as bigint)"

    late = days(settled, due)
    aggregates = [
        Agg("n_total", "count"), *distinct_counts({"contratos": contract, "referencias": date}),
        *flag_counts([f"fat_{k}" for k in marks]),
        *value_stats("gross", gross, "sum avg max min stddev"), *value_stats("net", net), *value_stats("credit", credit),
        *value_stats("open", open_value), *value_stats("open_net", open_net, "sum avg"), *value_stats("interest", interest),
        *value_stats("cancel", cancel, "sum avg"), *(Agg(f"{n}_total", "sum", f"coalesce({v}, 0)") for n, v in totals.items()),
        *flag_counts([f"plat_{k}" for k in platforms] + [f"grupo_{k}" for k in groups]),
        *flag_sums([f"plat_{k}" for k in platforms] + [f"grupo_{k}" for k in groups], net),
        *flag_sums(["fat_wo", "fat_regular", "fat_pdd", "fat_sem_pdd", "fat_aca", "fat_fraude", "fat_primeira"], net),
        *(Agg(f"{k}_mean", "avg", f"coalesce({net}, 0)", f"fat_{k} = 1") for k in ("wo", "pdd", "primeira")),
        *(Agg(f"{k}_max", "max", f"coalesce({net}, 0)", f"fat_{k} = 1") for k in ("wo", "pdd")),
        Agg("first_at", "first_date", created), Agg("last_at", "last_date", created), Agg("active_from", "first_date", activated),
        *(Agg(f"term_{k}", k2, days(due, created)) for k, k2 in (("mean", "avg"), ("max", "max"), ("min", "min"))),
        *(Agg(f"delay_{k}", k2, late) for k, k2 in (("mean", "avg"), ("max", "max"), ("min", "min"))),
        Agg("qty_late", "count", where=f"{late} > 0"), *(Agg(f"qty_late_{d}", "count", where=f"{late} > {d}") for d in (30, 60, 90)),
        Agg("qty_on_time", "count", where=f"{late} <= 0"),
    ]
    sum_score = {"rate_raw_wo": 30, "rate_raw_pdd": 25, "rate_raw_late_30": 20, "rate_raw_fraude": 15, "rate_raw_aca": 10}
    raw = {
        "rate_raw_wo": ratio("qty_fat_wo", "n_total"), "rate_raw_pdd": ratio("qty_fat_pdd", "n_total"), "rate_raw_late_30": ratio("qty_late_30", "n_total"),
        "rate_raw_fraude": ratio("qty_fat_fraude", "n_total"), "rate_raw_aca": ratio("qty_fat_aca", "n_total")}
    derived = {
        "days_since_first": "cast(datediff(day, cast(first_at as date), cutoff) as bigint)", "days_since_last": "cast(datediff(day, cast(last_at as date), cutoff) as bigint)",
        "span_days": "cast(datediff(day, cast(first_at as date), cast(last_at as date)) as bigint)", "days_active": "cast(datediff(day, cast(active_from as date), cutoff) as bigint)",
        **rates(["qty_fat_wo", "qty_fat_pdd", "qty_fat_aca", "qty_fat_fraude", "qty_fat_primeira", "qty_fat_isentas", "qty_late", "qty_late_30",
                 "qty_late_60", "qty_late_90"], "n_total", digits=4),
        "rate_credit": ratio("credit_total", "gross_total", 4), "rate_open": ratio("open_total", "gross_total", 4),
        "rate_interest": ratio("interest_total", "net_total", 4), "rate_val_wo": ratio("val_fat_wo", "net_total", 4),
        "rate_val_pdd": ratio("val_fat_pdd", "net_total", 4), "cv_gross": ratio("gross_stddev", "gross_mean", 4),
        "concentration": ratio("gross_max", "gross_total", 4),
        "platform_concentration": ratio("greatest(val_plat_autoc, val_plat_pospg, val_plat_prepg, val_plat_posbl)", "net_total", 4),
        "relative_amplitude": ratio("(gross_max - gross_min)", "gross_mean", 4),
        **{f"wallet_{g}": ratio(f"val_grupo_{g}", "net_total", 4) for g in ("pos_pago", "pre_pago", "controle", "telemetria")},
        **raw,
        "risk_raw": "(" + " + ".join(f"coalesce({t}, 0) * {w}" for t, w in sum_score.items()) + f") * {scale}",
        "risk_score": "round(least(100.0, greatest(0.0, risk_raw)), 2)",
        "high_risk": flag_of("risk_raw >= 70"), "low_risk": flag_of("risk_raw < 30"),
        "risk_segment": segments({"CRITICO": "risk_raw >= 80", "ALTO": "risk_raw >= 50", "MEDIO": "risk_raw >= 30"}, "BAIXO"),
    }
    return BookSpec(client, date, aggregates, flags, derived)
