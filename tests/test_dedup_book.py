import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from billbook.operators import book as B
from billbook.operators.dedup import dedup_join_max_key, dedup_latest, snapshot_latest_batch
from billbook.schemas import PAYMENTS

D = dt.date


def test_dedup_keeps_newest_version_and_breaks_ties(spark):
    rows = [
        ("202301", "20230101000000", 1, 10, 100, D(2023, 1, 5), Decimal("10.00")),
        ("202301", "20230102000000", 1, 10, 101, D(2023, 1, 6), Decimal("11.00")),   # newer batch wins
        ("202301", "20230102000000", 2, 20, 200, D(2023, 1, 6), Decimal("1.00")),
        ("202301", "20230102000000", 2, 20, 201, D(2023, 1, 7), Decimal("2.00")),    # same batch: higher id wins
    ]
    df = spark.createDataFrame(rows, PAYMENTS)
    out = dedup_latest(df, ["id_cliente", "id_fatura"], lead=["id_pagamento"])
    got = sorted((r.id_cliente, r.id_pagamento) for r in out.collect())
    assert got == [(1, 101), (2, 201)]
    # idempotent
    again = dedup_latest(out, ["id_cliente", "id_fatura"], lead=["id_pagamento"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.collect()))


def test_dedup_join_max_key_keeps_ties_and_snapshot(spark):
    df = spark.createDataFrame([(1, "a", "v1"), (1, "b", "v2"), (1, "b", "v3"), (2, "a", "v4")], "k int, dedup_key string, x string")
    got = sorted(r.x for r in dedup_join_max_key(df, ["k"], "dedup_key").collect())
    assert got == ["v2", "v3", "v4"]
    assert sorted(r.x for r in snapshot_latest_batch(df, "dedup_key").collect()) == ["v2", "v3"]


def test_dedup_does_not_depend_on_the_row_order(spark):
    rows = [("202301", "s", 1, 10, 7, D(2023, 1, 1 + i % 3), Decimal(i % 5)) for i in range(30)]
    df = spark.createDataFrame(rows, PAYMENTS)
    seen = {tuple(dedup_latest(df.orderBy(F.xxhash64(F.lit(i), "data_pagamento", "valor_pagamento")), ["id_cliente", "id_fatura"]).first())
            for i in range(4)}
    assert len(seen) == 1


def test_book_keys_first_reorders(spark):
    df = spark.createDataFrame([(1.0, "r", "202301", 5)], "qtd double, dt_proc string, ref string, id_cliente long")
    assert B.book_keys_first(df).columns[:3] == [c for c in B.BOOK_KEYS][:3]


def test_join_keeps_large_payment_ids(spark):
    from billbook.operators.joins import invoice_payment_join
    from billbook.plans.output import to_output
    from billbook.schemas import INVOICES

    big = 2 ** 53 + 1
    inv = spark.createDataFrame([("202301", "s", 1, k, D(2023, 1, 1), D(2023, 1, 31), Decimal("1.00"), Decimal("0.00")) for k in (10, 11)], INVOICES)
    pay = spark.createDataFrame([("202301", "s", 1, 10, big, D(2023, 1, 5), Decimal("1.00"))], PAYMENTS)
    got = to_output(invoice_payment_join(inv, pay)).select("id_fatura", "id_pagamento")
    assert dict(got.dtypes)["id_pagamento"] == "bigint" and sorted(map(tuple, got.collect())) == [(10, big), (11, None)]


def test_one_decimal_rounds_the_exact_value(spark):
    from billbook.operators.marts import one_decimal

    values = [10.25, 10.35, 10.75, 10.05, 11.95, 19.96, 10.0, 123456.25, 123456.35, 99.949999999, 10.45]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", one_decimal(F.col("v")).alias("t")).collect()
    assert {r.v: r.t for r in got} == {v: f"{v:.1f}" for v in values}


def test_metric_specs_grammar():
    specs = B.metric_specs()
    assert len(specs) == 200 and len({s.name for s in specs}) == 200
    names = [s.name for s in specs[:8]]
    assert names == [
        "qtd_transacoes_pago_em_atraso_total",
        "valor_fatura_sum_pago_em_atraso_total",
        "valor_fatura_avg_pago_em_atraso_total",
        "valor_fatura_min_pago_em_atraso_total",
        "valor_fatura_max_pago_em_atraso_total",
        "dias_atraso_avg_pago_em_atraso_total",
        "dias_atraso_min_pago_em_atraso_total",
        "dias_atraso_max_pago_em_atraso_total",
    ]
    assert specs[-1].name == "dias_atraso_max_pagamento_parcial_u12m"


def _stage(spark, rows):
    schema = ("ref string, dt_proc string, id_cliente bigint, fbc_classificacao_pagamento string, data_emissao date, "
              "fvl_valor_fatura decimal(15,2), fvl_numero_dias_atraso int, fvl_qtd_transacoes int")
    return spark.createDataFrame(rows, schema)


def test_book_values_flags_and_null_class(spark):
    rows = [
        ("202301", "x", 1, "PAGO_EM_ATRASO", D(2023, 1, 20), Decimal("100.00"), 5, 1),
        ("202301", "x", 1, "PAGO_EM_ATRASO", D(2023, 1, 10), Decimal("50.00"), 3, 1),
        ("202303", "x", 1, "NAO_PAGO", D(2023, 3, 15), Decimal("70.00"), 0, 1),
        ("202303", "x", 2, None, D(2023, 3, 15), Decimal("70.00"), 0, 1),   # only a NULL class
    ]
    book = B.book_by_cohort(_stage(spark, rows), "run").collect()
    by = {(r.ref, r.id_cliente): r for r in book}
    assert set(by) == {("202301", 1), ("202303", 1), ("202303", 2)}
    r = by[("202301", 1)]
    assert r.qtd_transacoes_pago_em_atraso_total == 2
    assert r.valor_fatura_sum_pago_em_atraso_total == Decimal("150.00")
    assert r.valor_fatura_avg_pago_em_atraso_total == Decimal("75.000000")
    assert r.dias_atraso_avg_pago_em_atraso_total == 4.0
    # anchor = client's latest emission (2023-03-15): 20 Jan is 1.84 months back
    assert r.qtd_transacoes_pago_em_atraso_u1m == 0 and r.qtd_transacoes_pago_em_atraso_u3m == 2
    assert r.valor_fatura_avg_nao_pago_total is None and r.qtd_transacoes_nao_pago_total == 0
    n = by[("202303", 2)]
    assert n.qtd_transacoes_nao_pago_total == 0 and n.valor_fatura_max_nao_pago_total is None


def test_book_future_invoice_passes_every_flag(spark):
    rows = [("202301", "x", 1, "PAGO_EM_DIA", D(2023, 5, 1), Decimal("1.00"), 0, 1)]
    r = B.book_by_cohort(_stage(spark, rows), "run", anchor="2023-01-01").first()
    assert all(getattr(r, f"qtd_transacoes_pago_em_dia_{w}") == 1 for w in ("u1m", "u3m", "u6m", "u12m"))


def test_book_properties_on_test_tables(spark, sf_small):
    from billbook.plans.book_pipeline import build_book
    from billbook.sources.bindings import load_tables

    t = load_tables(spark, sf_small)
    res = build_book(t.invoices, t.payments, "run")
    book = res.book
    classes = [c.lower() for c in B.CLASSES]
    # windows are nested: u1m <= u3m <= u6m <= u12m <= total
    nested = F.lit(True)
    for c in classes:
        w = [F.col(f"qtd_transacoes_{c}_{x}") for x in ("u1m", "u3m", "u6m", "u12m", "total")]
        for a, b in zip(w, w[1:]):
            nested = nested & (a <= b)
    assert book.where(~nested).count() == 0
    # class counts over the whole book equal staged rows with a class
    total = book.select(sum(F.col(f"qtd_transacoes_{c}_total") for c in classes).alias("n")).agg(F.sum("n")).first()[0]
    assert total == res.stage.where(F.col("fbc_classificacao_pagamento").isNotNull()).count()
    assert book.count() == res.stage.select("ref", "id_cliente").distinct().count()


def test_row_flags_anchor_null_clients_together(spark):
    rows = [
        ("202301", "x", None, "PAGO_EM_DIA", D(2023, 1, 10), Decimal("1.00"), 0, 1),
        ("202303", "x", None, "PAGO_EM_DIA", D(2023, 3, 10), Decimal("1.00"), 0, 1),
        ("202301", "x", 5, "PAGO_EM_DIA", D(2023, 1, 10), Decimal("1.00"), 0, 1),
    ]
    got = sorted((r.id_cliente or 0, str(r.data_emissao), r.flg_u1m, r.flg_u3m) for r in B.window_flags(_stage(spark, rows)).collect())
    # NULL clients: anchor 2023-03-10, so January is 2 months back (u1m 0, u3m 1); client 5 anchors on itself
    assert got == [(0, "2023-01-10", 0, 1), (0, "2023-03-10", 1, 1), (5, "2023-01-10", 1, 1)]
    wide = {r.id_cliente: r for r in B.book_by_cohort(_stage(spark, rows), "x").collect() if r.ref == "202301"}
    assert wide[None].qtd_transacoes_pago_em_dia_u1m == 0 and wide[5].qtd_transacoes_pago_em_dia_u1m == 1
