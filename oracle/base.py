"""Shared CTEs: invoices and payments bound from orders/lineitem, the
deduplicated join and the integrated mart view, in DuckDB dialect."""

AS_OF = "DATE '2001-12-31'"

INV = """inv AS (
    SELECT strftime(o_orderdate, '%Y%m') AS ref,
           '20020101000000' AS dt_proc,
           CAST(o_custkey AS BIGINT) AS id_cliente,
           CAST(o_orderkey AS BIGINT) AS id_fatura,
           CAST(o_orderdate AS DATE) AS data_emissao,
           CAST(o_orderdate AS DATE) + 30 AS data_vencimento,
           CAST(o_totalprice AS DECIMAL(15,2)) AS valor_fatura,
           CAST(0 AS DECIMAL(15,2)) AS valor_pagamento_minimo
    FROM orders)"""

PAY = """pay_x AS (
    SELECT i.id_cliente, i.id_fatura,
           CAST(l.l_orderkey * 100 + l.l_linenumber AS BIGINT) AS id_pagamento,
           i.data_vencimento + (CASE WHEN l.l_returnflag = 'R' THEN -l.l_linenumber
                                     WHEN l.l_returnflag = 'N' THEN 0
                                     ELSE CAST(trunc(l.l_quantity) AS INTEGER) END) AS data_pagamento,
           CAST(CASE WHEN l.l_discount >= 0.08 THEN i.valor_fatura - 100.00 ELSE i.valor_fatura END
                AS DECIMAL(15,2)) AS valor_pagamento,
           strftime(l.l_shipdate, '%Y%m%d') || '000000' AS dt_proc
    FROM lineitem l JOIN inv i ON l.l_orderkey = i.id_fatura),
pay AS (
    SELECT strftime(data_pagamento, '%Y%m') AS ref, dt_proc, id_cliente, id_fatura, id_pagamento,
           data_pagamento, valor_pagamento
    FROM pay_x)"""

def dedup_sql(inv_where: str = "") -> str:
    """Latest invoice and payment per (client, invoice); optional invoice filter."""
    return """inv_l AS (
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY id_cliente, id_fatura ORDER BY dt_proc DESC, ref DESC,
                                  data_emissao DESC, data_vencimento DESC, valor_fatura DESC) AS rn
        FROM inv""" + inv_where + """)
    WHERE rn = 1),
pay_l AS (
    SELECT * EXCLUDE (rn) FROM (
        SELECT strftime(data_pagamento, '%Y%m') AS ref, *,
               row_number() OVER (PARTITION BY id_cliente, id_fatura
                                  ORDER BY dt_proc DESC, id_pagamento DESC, strftime(data_pagamento, '%Y%m') DESC,
                                           data_pagamento DESC, valor_pagamento DESC) AS rn
        FROM pay_x)
    WHERE rn = 1)"""


DEDUP = dedup_sql()

JOINED = """jn AS (
    SELECT a.id_cliente, a.id_fatura, a.ref, a.data_emissao, a.data_vencimento, a.valor_fatura,
           a.valor_pagamento_minimo, b.id_pagamento, b.data_pagamento, b.valor_pagamento
    FROM inv_l a LEFT JOIN pay_l b ON a.id_fatura = b.id_fatura AND a.id_cliente = b.id_cliente),
cls AS (
    SELECT *,
        CASE WHEN data_pagamento IS NULL THEN 'NAO_PAGO'
             WHEN valor_pagamento < valor_fatura THEN 'PAGAMENTO_PARCIAL'
             WHEN data_pagamento < data_vencimento THEN 'PAGAMENTO_ANTECIPADO'
             WHEN data_pagamento = data_vencimento THEN 'PAGO_EM_DIA'
             WHEN data_pagamento > data_vencimento THEN 'PAGO_EM_ATRASO' END AS fbc_classificacao_pagamento
    FROM jn)"""


def days_late_sql(ref_date: str | None) -> str:
    ev = "coalesce(data_pagamento, data_vencimento)" if ref_date is None else f"DATE '{ref_date}'"
    return f"""dl AS (
    SELECT *,
        CASE WHEN fbc_classificacao_pagamento = 'NAO_PAGO' THEN date_diff('day', data_vencimento, {ev})
             WHEN fbc_classificacao_pagamento = 'PAGO_EM_ATRASO' THEN date_diff('day', data_vencimento, data_pagamento)
             ELSE 0 END AS fvl_numero_dias_atraso
    FROM cls)"""


def stage_sql(dt_proc: str) -> str:
    return f"""stg AS (
    SELECT ref, '{dt_proc}' AS dt_proc, id_cliente, fbc_classificacao_pagamento, data_emissao,
           valor_fatura AS fvl_valor_fatura, CAST(fvl_numero_dias_atraso AS INTEGER) AS fvl_numero_dias_atraso,
           1 AS fvl_qtd_transacoes
    FROM dl)"""


def months_between(a: str, e: str) -> str:
    """Spark's months_between on two dates, in DuckDB."""
    months = f"((year({a}) - year({e})) * 12 + month({a}) - month({e}))"
    return (
        f"(CASE WHEN day({a}) = day({e}) OR ({a} = last_day({a}) AND {e} = last_day({e})) "
        f"THEN CAST({months} AS DOUBLE) "
        f"ELSE round({months} + (day({a}) - day({e})) / 31.0::DOUBLE, 8) END)"
    )


VW = f"""vw AS (
    SELECT f.ref, f.dt_proc, f.id_fatura, f.id_cliente,
           CAST(strptime(f.ref, '%Y%m') AS DATE) AS data_referencia,
           strftime(strptime(f.ref, '%Y%m'), '%m/%Y') AS mes_ano,
           f.data_emissao, f.data_vencimento, f.valor_fatura, f.valor_pagamento_minimo, p.data_pagamento,
           COALESCE(p.valor_pagamento, CAST(0 AS DECIMAL(15,2))) AS valor_pagamento,
           CAST(GREATEST(0, date_diff('day', f.data_vencimento, COALESCE(p.data_pagamento, {AS_OF}))) AS INTEGER) AS dias_atraso,
           CASE WHEN p.data_pagamento IS NULL THEN 'Inadimplente'
                WHEN p.valor_pagamento < f.valor_fatura THEN 'Pagamento Parcial'
                WHEN p.data_pagamento < f.data_vencimento THEN 'Pagamento Antecipado'
                WHEN p.data_pagamento = f.data_vencimento THEN 'Pagamento em Dia'
                ELSE 'Em Atraso' END AS status
    FROM inv f LEFT JOIN pay p ON f.id_fatura = p.id_fatura AND f.id_cliente = p.id_cliente)"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


BASE = (INV, PAY)
PIPE = (INV, PAY, DEDUP, JOINED)


def pipe(ref_date: str | None = None) -> tuple:
    where = "" if ref_date is None else f" WHERE ref = '{ref_date.replace('-', '')[:6]}'"
    return (INV, PAY, dedup_sql(where), JOINED)
MART = (INV, PAY, VW)
