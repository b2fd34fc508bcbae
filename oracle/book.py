"""Oracle SQL for the feature books, generated from its own grammar."""

from oracle.base import PIPE, days_late_sql, months_between, pipe, stage_sql, with_ctes

# FIXED VALUES: class codes and look-back windows of the book (months).
BOOK_CLASSES = ("PAGO_EM_ATRASO", "NAO_PAGO", "PAGO_EM_DIA", "PAGAMENTO_ANTECIPADO", "PAGAMENTO_PARCIAL")
BOOK_WINDOWS = (("total", None), ("u1m", 1), ("u3m", 3), ("u6m", 6), ("u12m", 12))


def _metric_columns() -> list[str]:
    cols = []
    for c in BOOK_CLASSES:
        t = c.lower()
        for w, k in BOOK_WINDOWS:
            cond = f"fbc_classificacao_pagamento = '{c}'" + ("" if k is None else f" AND mb <= {k}")
            v = f"CASE WHEN {cond} THEN fvl_valor_fatura END"
            d = f"CASE WHEN {cond} THEN fvl_numero_dias_atraso END"
            cols += [
                f"CAST(COALESCE(SUM(CASE WHEN {cond} THEN fvl_qtd_transacoes END), 0) AS BIGINT) AS qtd_transacoes_{t}_{w}",
                f"CAST(COALESCE(SUM({v}), 0) AS DOUBLE) AS valor_fatura_sum_{t}_{w}",
                f"round(CAST(SUM({v}) AS DOUBLE) / COUNT({v}), 6) AS valor_fatura_avg_{t}_{w}",
                f"CAST(MIN({v}) AS DOUBLE) AS valor_fatura_min_{t}_{w}",
                f"CAST(MAX({v}) AS DOUBLE) AS valor_fatura_max_{t}_{w}",
                f"AVG({d}) AS dias_atraso_avg_{t}_{w}",
                f"MIN({d}) AS dias_atraso_min_{t}_{w}",
                f"MAX({d}) AS dias_atraso_max_{t}_{w}",
            ]
    return cols


def book_sql(dt_proc: str, ref_date: str | None = None) -> str:
    anchor = "max(data_emissao) OVER (PARTITION BY id_cliente)" if ref_date is None else f"DATE '{ref_date}'"
    ctes = list(pipe(ref_date))
    ctes += [days_late_sql(ref_date), stage_sql(dt_proc)]
    ctes.append(
        "fl AS (SELECT *, " + months_between("anchor", "data_emissao") + " AS mb FROM "
        f"(SELECT *, {anchor} AS anchor FROM stg))"
    )
    body = "SELECT ref, dt_proc, id_cliente,\n  " + ",\n  ".join(_metric_columns()) + "\nFROM fl GROUP BY ref, dt_proc, id_cliente"
    return with_ctes(*ctes, body=body)


def client_book_sql(run_date: str, ts_proc: str) -> str:
    order = ("PAGO_EM_DIA", "PAGO_EM_ATRASO", "PAGAMENTO_ANTECIPADO", "NAO_PAGO", "PAGAMENTO_PARCIAL")
    run = "DATE '" + run_date + "'"
    tm = f"CAST(trunc({months_between(run, 'data_emissao')}) AS INTEGER)"
    cols = [f"CAST(SUM(CASE WHEN st = '{c}' THEN 1 END) AS BIGINT) AS qtd_st_{c.lower()}" for c in order]
    for w, k in BOOK_WINDOWS:
        if k is None:
            continue
        cols += [
            f"CAST(SUM(CASE WHEN tm <= {k} AND st = '{c}' THEN 1 END) AS BIGINT) AS qtd_st_{c.lower()}_{w}"
            for c in order
        ]
    cols += [f"CAST(SUM(CASE WHEN st = '{c}' THEN valor_fatura END) AS DOUBLE) AS sum_st_{c.lower()}" for c in order]
    rows = (
        "r AS (SELECT *, "
        "CASE WHEN data_pagamento IS NULL THEN 'NAO_PAGO' "
        "WHEN valor_pagamento < valor_fatura THEN 'PAGAMENTO_PARCIAL' "
        "WHEN data_pagamento < data_vencimento THEN 'PAGAMENTO_ANTECIPADO' "
        "WHEN data_pagamento <= data_vencimento THEN 'PAGO_EM_DIA' ELSE 'PAGO_EM_ATRASO' END AS st, "
        f"{tm} AS tm FROM jn)"
    )
    ymd = run_date.replace("-", "")
    body = (
        f"SELECT id_cliente, '{ymd}' AS ref, '{ts_proc}' AS ts_proc,\n  " + ",\n  ".join(cols)
        + "\nFROM r GROUP BY id_cliente"
    )
    return with_ctes(*PIPE[:3], PIPE[3].split(",\ncls AS")[0], rows, body=body)
