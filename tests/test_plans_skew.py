"""Plan-shape and skew tests: the scale properties the README claims."""

import datetime as dt
import re
from decimal import Decimal

from pyspark.sql import functions as F

from billbook.operators import book as B
from billbook.plans.catalog import QUERIES

ROUND_TRIPS = {
    "scan_csv_raw", "scan_csv_folder", "latest_file_batch", "filename_metadata", "scan_parquet_partitioned",
    "scan_parquet_merge_schema", "audit_latest_runs", "audit_history", "control_row_book", "stage_invoices_clustered", "sink_partitioned_roundtrip",
    "sink_two_level_partition_roundtrip", "export_csv_semicolon",
}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _static_plan(spark, df) -> str:
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return _plan(df)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_no_cartesian_or_nested_loop_join_anywhere(spark, sf_small):
    for name, fn in QUERIES.items():
        if name in ROUND_TRIPS:
            continue
        p = _static_plan(spark, fn(spark, sf_small))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_dedup_limits_before_the_shuffle(spark, sf_small):
    p = _static_plan(spark, QUERIES["dedup_latest_payments"](spark, sf_small))
    partial = p.index("row_number(), 1, Partial")
    exchange = p.index("Exchange hashpartitioning(id_cliente")
    assert exchange < partial          # printed top-down: the partial limit sits below the exchange


def test_book_shuffles_its_stage_once(spark, sf_small):
    """One exchange by client above the stage; for heavy clients the anchor
    window runs over rows combined before the shuffle."""
    stage = _skewed_stage(spark)
    p = _static_plan(spark, B.book_by_cohort(stage, "x"))
    assert p.count("Exchange") == p.count("Exchange hashpartitioning(id_cliente") == 1
    assert "SortAggregate" not in p
    p = _static_plan(spark, B.book_by_cohort(stage, "x", heavy=[1]))
    window = p.rindex("Window [max(data_emissao")
    partial_agg = re.search(r"HashAggregate\(keys=\[ref#\d+, id_cliente#\d+L, fbc_classificacao_pagamento#\d+, data_emissao", p)
    assert partial_agg and partial_agg.start() > window


def test_risk_ranking_is_hash_aggregated_top_k(spark, sf_small):
    p = _static_plan(spark, QUERIES["top_risk_clients"](spark, sf_small))
    assert "SortAggregate" not in p and "TakeOrderedAndProject" in p


def test_month_filter_prunes_lake_partitions(spark, sf_small, tmp_path):
    from billbook.operators.marts import for_month
    from billbook.schemas import INVOICES
    from billbook.sinks.parquet import append_partitioned
    from billbook.sources.bindings import load_tables
    from billbook.sources.lake import read_table

    path = str(tmp_path / "inv")
    append_partitioned(load_tables(spark, sf_small).invoices, path, ["ref"])
    p = _plan(for_month(read_table(spark, path, INVOICES), "200106"))
    assert "PartitionFilters: [isnotnull(ref" in p and "(ref#" in p and "= 200106)" in p


def _skewed_stage(spark, n_hot=3000, n_cold=6000):
    """A third of all rows belong to client 1."""
    classes = B.CLASSES + [None]
    base = dt.date(2023, 1, 1)
    rows = []
    for i in range(n_hot + n_cold):
        client = 1 if i < n_hot else 2 + i % 400
        d = base + dt.timedelta(days=(i * 7) % 700)
        rows.append((d.strftime("%Y%m"), "x", client, classes[i % 6], d, Decimal(i % 997) + Decimal("0.25"),
                     None if i % 11 == 0 else i % 90, 1))
    schema = ("ref string, dt_proc string, id_cliente bigint, fbc_classificacao_pagamento string, data_emissao date, "
              "fvl_valor_fatura decimal(15,2), fvl_numero_dias_atraso int, fvl_qtd_transacoes int")
    return spark.createDataFrame(rows, schema).repartition(8)


def _brute_force_book(stage):
    """The one-pass form: client window over raw rows, 200 conditional aggregates."""
    rows = B.window_flags(stage)
    cols = []
    for s in B.metric_specs():
        cond = F.col("fbc_classificacao_pagamento") == s.cls
        if s.window != "total":
            cond = cond & (F.col(f"flg_{s.window}") == 1)
        v = F.when(cond, F.col(s.value_col))
        agg = {"SUM": F.sum, "AVG": F.avg, "MIN": F.min, "MAX": F.max}[s.agg](v)
        if s.agg == "SUM":
            agg = F.coalesce(agg, F.lit(0))
        cols.append(agg.alias(s.name))
    return rows.groupBy("ref", "id_cliente").agg(*cols)


def test_book_matches_brute_force_on_a_hot_client(spark):
    stage = _skewed_stage(spark)
    assert B.heavy_clients(stage, heavy_rows=2000) == [1]
    slow = _brute_force_book(stage)
    for heavy in ([], [1], [1, 5, None, 99999]):
        fast = B.book_by_cohort(stage, "x", heavy=heavy).drop("dt_proc")
        names = [c for c in fast.columns]
        a = sorted(tuple(r) for r in fast.select(*names).collect())
        b = sorted(tuple(r) for r in slow.select(*names).collect())
        assert len(a) == len(b) > 0
        for x, y in zip(a, b):
            for u, v in zip(x, y):
                if isinstance(u, float) or isinstance(v, float):
                    assert (u is None and v is None) or abs(u - v) < 1e-9
                else:
                    assert u == v


def test_per_key_max_is_joined_back(spark, sf_small):
    """Rows of a hot key that tie at its maximum must not meet in one window."""
    p = _static_plan(spark, QUERIES["dedup_join_max_key"](spark, sf_small))
    assert "Window" not in p and "LeftSemi" in p and "partial_max" in p


def _hot_payments(spark, n=6000):
    """Invoice 1 holds a third of all payments; every seventh has none."""
    invoices = spark.createDataFrame(
        [("202301", v, i, i % 50, dt.date(2023, 1, 5), dt.date(2023, 2, 5), Decimal("100.00"), Decimal("0.00"))
         for i in range(700) for v in (("a", "b") if i in (1, 3) else ("a",))] + [("202301", "a", None, 1, None, None, None, None)],
        "ref string, dt_proc string, id_fatura long, id_cliente long, data_emissao date, data_vencimento date, "
        "valor_fatura decimal(15,2), valor_pagamento_minimo decimal(15,2)")
    keys = [1 if k < n // 3 else 2 + k % 690 for k in range(n)]
    payments = spark.createDataFrame(
        [("202302", "a", k % 50 if k != 9 else 77, k, j, dt.date(2023, 2, 1 + j % 20), Decimal(j)) for j, k in enumerate(keys) if k == 1 or k % 7]
        + [("202302", "a", None, 1, -1, None, None)],
        "ref string, dt_proc string, id_cliente long, id_fatura long, id_pagamento long, data_pagamento date, valor_pagamento decimal(15,2)")
    return invoices, payments.repartition(6)


def test_a_hot_invoice_is_dealt_to_several_tasks(spark):
    from billbook.operators.joins import JOIN_KEYS, heavy_keys, split_left_join

    invoices, payments = _hot_payments(spark)
    right = payments.drop("ref", "dt_proc")
    heavy = heavy_keys(payments, JOIN_KEYS, heavy_rows=300)
    assert heavy == [(1, 1, 7)]
    got = split_left_join(invoices, right, JOIN_KEYS, [*heavy, (999, 9, 5), (7, 7, 3)])  # one absent, one without payments
    plain = invoices.join(right, JOIN_KEYS, "left")
    assert got.columns == plain.columns and sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def largest(df):
            return max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())

        assert largest(got) < 0.6 * largest(plain)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_view_is_the_same_however_payments_are_dealt(spark):
    from billbook.operators.joins import integrated_view

    invoices, payments = _hot_payments(spark)
    views = [integrated_view(invoices, payments, "2023-12-31", heavy=h) for h in ([], [(1, 1, 7), (3, 3, 2)], None)]
    rows = [sorted(map(str, v.collect())) for v in views]
    assert rows[0] == rows[1] == rows[2] and len(rows[0]) > 7000
    month = integrated_view(invoices, payments, "2023-12-31", month="2023-01", heavy=[(1, 1, 7)])
    assert sorted(map(str, month.collect())) == rows[0]


def test_month_filter_reaches_the_payment_scan(spark, tmp_path):
    """The keys of the month's invoices become a Bloom filter on the payments."""
    from billbook.operators.joins import integrated_view
    from billbook.operators.marts import mart_kpis
    from billbook.schemas import INVOICES, PAYMENTS

    invoices, payments = _hot_payments(spark)
    invoices.write.partitionBy("ref").parquet(str(tmp_path / "i"))
    payments.write.partitionBy("ref").parquet(str(tmp_path / "p"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        view = integrated_view(spark.read.schema(INVOICES).parquet(str(tmp_path / "i")), spark.read.schema(PAYMENTS).parquet(str(tmp_path / "p")),
                               "2023-12-31", month="202301", heavy=[])
        plan = _static_plan(spark, mart_kpis(view, month="202301"))
    finally:
        for k, v in {**conf, "spark.sql.autoBroadcastJoinThreshold": str(10 << 20), "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "10GB"}.items():
            spark.conf.set(k, v)
    scan = [line for line in plan.splitlines() if "might_contain" in line]
    assert scan and "id_fatura" in scan[0]


def test_stage_from_clustered_tables_needs_no_exchange(spark, sf_small):
    from billbook.plans.catalog import RAW_QUERIES

    stage = RAW_QUERIES["stage_invoices_clustered"](spark, sf_small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _static_plan(spark, stage)
        assert "Exchange" not in plan and plan.count("Bucketed: true") == 2
        plain = RAW_QUERIES["stage_invoices"](spark, sf_small)
        assert sorted(map(str, stage.collect())) == sorted(map(str, plain.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))
