"""Registered questions: ``name -> (spark, sf_dir) -> DataFrame``.

Each entry reads the driver's tables through the bindings, runs one library
operator over the whole tables and returns a DataFrame whose money columns
are doubles (the output boundary). Fixed parameters (evaluation date, cohort
month, client id) make every result repeatable.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billbook import schemas as S
from billbook.functions import days_late_as_of, month_start, months_between, payment_status, payment_status_total
from billbook.functions import ref_from_date, ref_from_text, truncated_months, version_key
from billbook.functions.parsing import parse_id
from billbook.operators import book as B
from billbook.operators import marts as M
from billbook.operators import observability as O
from billbook.operators.dedup import dedup_join_max_key, distinct_by, snapshot_latest_batch
from billbook.operators.joins import (
    JOIN_KEYS,
    LOOK,
    classified,
    heavy_keys,
    integrated_view,
    invoice_payment_join,
    latest_invoices,
    latest_payments,
)
from billbook.plans.book_pipeline import build_book, invoices_for_cohort, lookback, run_book
from billbook.plans.output import decimals_to_double, to_output
from billbook.plans.trusted import (
    PAYMENT_REQUIRED,
    PAYMENT_SPEC_KEYS,
    load_trusted,
    trusted_invoices,
    trusted_invoices_daily,
    trusted_payments,
    trusted_payments_daily,
)
from billbook.sinks.clustered import read_clustered, write_clustered
from billbook.sinks.commits import commit, new_run, write_run
from billbook.sinks.csv import export_csv
from billbook.sinks.parquet import append_partitioned
from billbook.sources import lake, raw
from billbook.sources.bindings import AS_OF, load_tables, raw_invoice_text, raw_payment_text, read_table
from billbook.sources.paths import scratch_dir, set_times

# ---------------------------------------------------------------------------
# FIXED VALUES: parameters of the registered questions.
DT_PROC = "20020101000000"       # run stamp of the book build
REF_DATE = "2001-06-15"          # cohort run date for the --ref-date variant
FIXED_ANCHOR = "2001-06-30"      # fixed window anchor
MONTH = "200106"                 # month filter of the month variants
LOOKBACK_DAYS = 180
CLIENT_ID = 13                   # client of the point lookups
TS_PROC = "20020101120000"       # run stamp of the prototype tables
FILE_STAMP = "20011231235959"    # file generation stamp of written raw files
EXECUTED_AT = "2002-01-01 00:00:00"
# ---------------------------------------------------------------------------

Query = Callable[[SparkSession, str], DataFrame]


def _tables(spark, sf):
    return load_tables(spark, sf)


def _joined(spark, sf):
    t = _tables(spark, sf)
    return invoice_payment_join(latest_invoices(t.invoices), latest_payments(t.payments))


def _stage(spark, sf, ref_date=None):
    return build_book(*_inputs(spark, sf), DT_PROC, ref_date).stage


def _inputs(spark, sf):
    t = _tables(spark, sf)
    return t.invoices, t.payments


#: Heavy payment keys by folder, found once: an outdated list changes no result.
_heavy: dict[str, list[tuple]] = {}


def _vw(spark, sf, month=None):
    t = _tables(spark, sf)
    if sf not in _heavy:
        _heavy[sf] = heavy_keys(t.some_payments, JOIN_KEYS, LOOK)
    return integrated_view(t.invoices, t.payments, AS_OF, month, _heavy[sf])


#: Heavy clients by folder, found once: an outdated list changes no result.
_hot_clients: dict[str, list] = {}


#: Invoices of a book by folder and cohort, counted once: an outdated number changes no result.
_book_rows: dict[tuple[str, str | None], int] = {}


def _book(spark, sf, ref_date=None):
    invoices, payments = _inputs(spark, sf)
    if sf not in _hot_clients:
        _hot_clients[sf] = B.heavy_clients(invoices.select("id_cliente").sample(LOOK, seed=7), LOOK)
    if (sf, ref_date) not in _book_rows:
        _book_rows[sf, ref_date] = (invoices if ref_date is None else invoices_for_cohort(invoices, ref_date)).count()
    tasks = B.book_tasks(spark, _book_rows[sf, ref_date])
    return build_book(invoices, payments, DT_PROC, ref_date, heavy=_hot_clients[sf], tasks=tasks).book


def _out(fn):
    """Wrap a query for the output boundary (money -> double, days ->
    midnight timestamps)."""
    def run(spark, sf):
        return to_output(fn(spark, sf))
    run.__name__ = getattr(fn, "__name__", "query")
    return run


# ------------------------------------------------------------------ pipeline

def q_book_by_cohort(spark, sf):
    return _book(spark, sf)


def q_book_for_cohort(spark, sf):
    return _book(spark, sf, REF_DATE)


def q_invoices_for_cohort(spark, sf):
    return invoices_for_cohort(_tables(spark, sf).invoices, REF_DATE)


def q_invoices_lookback_180d(spark, sf):
    import datetime as dt
    since = (dt.date.fromisoformat(AS_OF) - dt.timedelta(days=LOOKBACK_DAYS)).strftime("%Y%m%d")
    return lookback(q_trusted_invoices_daily(spark, sf), since)


def q_payments_lookback_180d(spark, sf):
    import datetime as dt
    since = (dt.date.fromisoformat(AS_OF) - dt.timedelta(days=LOOKBACK_DAYS)).strftime("%Y%m%d")
    return lookback(q_trusted_payments_daily(spark, sf), since)


def q_dedup_latest_invoices(spark, sf):
    return latest_invoices(_tables(spark, sf).invoices)


def q_dedup_latest_payments(spark, sf):
    return latest_payments(_tables(spark, sf).payments)


def q_invoice_payment_join(spark, sf):
    # The join keeps BIGINT. Dataframe libraries turn a BIGINT column with
    # NULLs (unpaid invoices) into doubles, so the id leaves as text, exact.
    return _joined(spark, sf).withColumn("id_pagamento", F.col("id_pagamento").cast("string"))


def q_payment_status(spark, sf):
    return _joined(spark, sf).select("id_cliente", "id_fatura", payment_status().alias("fbc_classificacao_pagamento"))


def q_payment_status_total(spark, sf):
    return _joined(spark, sf).select("id_cliente", "id_fatura", payment_status_total().alias("status_pagamento"))


def q_days_late(spark, sf):
    c = classified(_joined(spark, sf))
    return c.select("id_cliente", "id_fatura", "fbc_classificacao_pagamento", F.col("fvl_numero_dias_atraso").cast("int").alias("fvl_numero_dias_atraso"))


def q_days_late_ref_date(spark, sf):
    c = classified(_joined(spark, sf), REF_DATE)
    return c.select("id_cliente", "id_fatura", "fbc_classificacao_pagamento", F.col("fvl_numero_dias_atraso").cast("int").alias("fvl_numero_dias_atraso"))


def q_days_late_as_of(spark, sf):
    j = _joined(spark, sf)
    return j.select("id_cliente", "id_fatura", days_late_as_of("data_vencimento", "data_pagamento", AS_OF).alias("dias_atraso"))


def q_stage_invoices(spark, sf):
    return _stage(spark, sf)


def q_stage_invoices_clustered(spark, sf):
    """The stage from invoices and payments clustered by (client, invoice):
    no exchange between their scans and the result."""
    root = scratch_dir(spark, "clustered")
    t = _tables(spark, sf)
    found = []
    for name, rows in (("tb_01_fatura", t.invoices), ("tb_02_pagamento", t.payments)):
        write_clustered(rows, f"{root}/{name}", S.INVOICE_KEYS, DT_PROC, buckets=8)
        found.append(read_clustered(spark, f"{root}/{name}", S.INVOICE_KEYS, buckets=8))
    return build_book(*found, DT_PROC).stage


def q_window_flags_client_anchor(spark, sf):
    return B.window_flags(_stage(spark, sf))


def q_window_flags_fixed_anchor(spark, sf):
    return B.window_flags(_stage(spark, sf), FIXED_ANCHOR)


def q_window_flags_truncated(spark, sf):
    rows = B.client_book_rows(_joined(spark, sf), AS_OF)
    return rows.select("id_cliente", "id_fatura", "status_pagamento", "flag_u1m", "flag_u3m", "flag_u6m", "flag_u12m")


def q_months_between_values(spark, sf):
    j = _joined(spark, sf)
    asof = F.to_date(F.lit(AS_OF))
    return j.select(
        "id_fatura",
        months_between(asof, "data_emissao").alias("meses"),
        truncated_months(asof, "data_emissao").alias("meses_inteiros"),
    )


def q_book_by_client(spark, sf):
    return B.book_by_client(_joined(spark, sf), AS_OF, TS_PROC)


def q_book_keys_first(spark, sf):
    book = _book(spark, sf)
    return B.book_keys_first(book.select(*reversed(book.columns)))


def q_book_filled(spark, sf):
    return B.book_filled(_book(spark, sf))


def q_book_sample(spark, sf):
    return B.book_sample(_book(spark, sf), 100)


def q_view_book(spark, sf):
    b = _book(spark, sf)
    return b.select("*", month_start("ref").alias("data_referencia"))


def _versioned_payments(spark, sf):
    # Payments arrive in monthly files: the file's stamp, then the run's.
    p = _tables(spark, sf).payments
    file_stamp = F.concat(F.substring("dt_proc", 1, 6), F.lit("01000000"))
    return p.select("*", version_key(file_stamp, F.lit(TS_PROC)).alias("dedup_key"))


def q_version_key(spark, sf):
    return _versioned_payments(spark, sf).select("id_cliente", "id_fatura", "id_pagamento", "dedup_key")


def q_dedup_join_max_key(spark, sf):
    return dedup_join_max_key(_versioned_payments(spark, sf), ["id_cliente", "id_fatura"], "dedup_key")


def q_snapshot_latest_batch(spark, sf):
    return snapshot_latest_batch(_versioned_payments(spark, sf), "dedup_key")


# ------------------------------------------------------------------ trusted loads

def _orders(spark, sf):
    return read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"])


def q_trusted_invoices(spark, sf):
    return trusted_invoices(raw_invoice_text(_orders(spark, sf)), DT_PROC)


def q_trusted_payments(spark, sf):
    return trusted_payments(raw_payment_text(_tables(spark, sf).payments), DT_PROC)


def _plain_ids(df):
    return df.withColumn("id_fatura", parse_id("id_fatura").cast("string"))


def q_trusted_invoices_daily(spark, sf):
    rawt = _plain_ids(raw_invoice_text(_orders(spark, sf))).withColumn("ts_file_generation", F.lit(FILE_STAMP))
    return trusted_invoices_daily(rawt, TS_PROC)


def q_trusted_payments_daily(spark, sf):
    rawt = raw_payment_text(_tables(spark, sf).payments)
    rawt = rawt.withColumn("id_pagamento", parse_id("id_pagamento").cast("string")).withColumn("ts_file_generation", F.lit(FILE_STAMP))
    return trusted_payments_daily(rawt, TS_PROC)


def q_parse_ids(spark, sf):
    r = raw_invoice_text(_orders(spark, sf))
    return r.select(F.col("id_fatura").alias("id_fatura_texto"), parse_id("id_fatura").alias("id_fatura"))


def q_ref_from_text(spark, sf):
    r = raw_invoice_text(_orders(spark, sf))
    return r.select("dt_emissao_fatura", ref_from_text("dt_emissao_fatura").alias("ref"),
                    ref_from_text("dt_emissao_fatura", 8).alias("ref_diaria"))


def q_ref_from_date(spark, sf):
    p = _tables(spark, sf).payments
    return p.select("id_pagamento", "data_pagamento", ref_from_date("data_pagamento").alias("ref"))


def q_typed_casts(spark, sf):
    r = raw_payment_text(_tables(spark, sf).payments)
    return r.select(
        F.col("id_cliente").try_cast("bigint").alias("id_cliente"),
        F.col("dt_pagamento").try_cast("date").alias("data_pagamento"),
        F.col("valor_pagamento").try_cast("decimal(15,2)").alias("valor_pagamento"),
        F.col("id_pagamento").try_cast("bigint").alias("id_pagamento_sem_limpeza"),
    )


# ------------------------------------------------------------------ observability

def _typed_payments(spark, sf):
    return trusted_payments(raw_payment_text(_tables(spark, sf).payments), DT_PROC)


def q_integrity_duplicate_keys(spark, sf):
    return O.duplicate_key_groups(_typed_payments(spark, sf), PAYMENT_SPEC_KEYS)


def q_integrity_nulls(spark, sf):
    return O.null_counts(_vw(spark, sf), ["id_cliente", "id_fatura", "data_pagamento", "valor_fatura"])


def q_integrity_reconcile(spark, sf):
    t = _tables(spark, sf)
    expected = t.payments.agg(F.count(F.lit(1))).scalar()
    return O.reconcile(latest_payments(t.payments), expected, 0.05)


def q_integrity_report(spark, sf):
    t = _tables(spark, sf)
    expected = t.payments.agg(F.count(F.lit(1))).scalar()
    spec = O.IntegritySpec(PAYMENT_SPEC_KEYS, PAYMENT_REQUIRED, expected, 0.0)
    return O.integrity_report(_typed_payments(spark, sf), "tb_02_pagamento", DT_PROC, spec)


def q_integrity_report_book(spark, sf):
    spec = O.IntegritySpec(B.BOOK_KEYS, B.BOOK_KEYS)
    return O.integrity_report(_book(spark, sf), "book_fatura", DT_PROC, spec)


def q_integrity_report_dedup(spark, sf):
    t = _tables(spark, sf)
    deduped = latest_payments(t.payments)
    expected = t.payments.agg(F.count(F.lit(1))).scalar()
    spec = O.IntegritySpec(["id_cliente", "id_fatura"], ["id_cliente"], expected, 0.5)
    return O.integrity_report(deduped, "pagamento_dedup", DT_PROC, spec)


def q_lineage_row(spark, sf):
    count = _book(spark, sf).agg(F.count(F.lit(1))).scalar()
    return O.lineage_row(spark, "book_fatura", DT_PROC, count, "trusted/tb_01_fatura + tb_02_pagamento",
                         "safras_consolidadas", executed_at=EXECUTED_AT)


def q_control_row(spark, sf):
    rawt = _plain_ids(raw_invoice_text(_orders(spark, sf))).withColumn("ts_file_generation", F.lit(FILE_STAMP))
    return O.control_row(trusted_invoices_daily(rawt, TS_PROC), "fatura", TS_PROC)


def q_control_row_payments(spark, sf):
    return O.control_row(q_trusted_payments_daily(spark, sf), "pagamento", TS_PROC)


def q_control_row_book(spark, sf):
    table = scratch_dir(spark, "refined") + "/book_01"
    book = write_run(B.book_by_client(_joined(spark, sf), AS_OF, TS_PROC), table, new_run(TS_PROC), ["ref", "ts_proc"])
    return O.book_control_row(spark, "Book_transacoes_01", AS_OF.replace("-", ""), TS_PROC, book.rows)


def q_row_counts_by_table(spark, sf):
    t = _tables(spark, sf)
    return O.row_counts({
        "tb_01_fatura": t.invoices,
        "tb_02_pagamento": t.payments,
        "vw_join": _vw(spark, sf),
        "book_fatura": _book(spark, sf),
    })


def q_dup_invoice_ids(spark, sf):
    return M.ids_across_cohorts(_tables(spark, sf).invoices, "id_fatura", "dup_fat")


def q_dup_payment_ids(spark, sf):
    return M.ids_across_cohorts(_tables(spark, sf).payments, "id_pagamento", "dup_pag")


# ------------------------------------------------------------------ marts

def q_view_invoices(spark, sf):
    inv = _tables(spark, sf).invoices
    return inv.select("*", month_start("ref").alias("data_referencia"))


def q_view_payments(spark, sf):
    p = _tables(spark, sf).payments
    return p.select("*", month_start("ref").alias("data_referencia"))


def _mart(fn, **kw):
    """A mart over the integrated view."""
    def run(spark, sf):
        return fn(_vw(spark, sf), **kw)
    return run


def _month_mart(fn, **kw):
    """A mart of one month: the view joins only that month's invoices and payments."""
    def run(spark, sf):
        return fn(_vw(spark, sf, kw["month"]), **kw)
    return run


def q_mart_kpi_shares(spark, sf):
    return M.mart_kpi_shares(M.mart_kpis(_vw(spark, sf)))


def q_status_share(spark, sf):
    return M.status_share(M.status_distribution(_vw(spark, sf)))


def q_churn_diagnosis_share(spark, sf):
    return M.churn_diagnosis_share(M.churn_diagnosis(_vw(spark, sf)))


def q_client_summary_labels(spark, sf):
    return M.client_summary_labels(M.client_summary(_vw(spark, sf)))


# ------------------------------------------------------------------ sources & sinks (round trips)

def q_scan_csv_raw(spark, sf):
    base = scratch_dir(spark, "raw")
    official, b1, b2 = f"{base}/fatura", f"{base}/backup_01/fatura", f"{base}/backup_02/fatura"
    name = f"tb_faturas_{FILE_STAMP}.csv"
    raw_invoice_text(_orders(spark, sf)).write.option("header", True).csv(f"{b1}/{name}")
    return raw.scan_with_fallback(spark, name, [official, b1, b2], S.RAW_INVOICE)


def q_scan_csv_folder(spark, sf):
    """One folder, files of two loads whose columns stand in different orders."""
    folder = scratch_dir(spark, "raw_folder")
    r = raw_invoice_text(_orders(spark, sf))
    early = F.col("dt_emissao_fatura") < F.lit("1998-01-01")
    r.where(early).write.option("header", True).csv(folder)
    r.where(~early).select(*reversed(r.columns), F.lit("x").alias("extra")).write.mode("append").option("header", True).csv(folder)
    return raw.read_csv(spark, folder, S.RAW_INVOICE)


def q_latest_file_batch(spark, sf):
    folder = scratch_dir(spark, "landing")
    r = raw_invoice_text(_orders(spark, sf))
    early = F.col("dt_emissao_fatura") < F.lit("1998-01-01")
    old, new = f"{folder}/tb_faturas_20011130000000.csv", f"{folder}/tb_faturas_20011231000000.csv"
    r.where(~early).write.option("header", True).csv(old)
    r.where(early).write.option("header", True).csv(new)
    set_times(spark, old, 1_000_000_000_000)
    set_times(spark, new, 1_100_000_000_000)
    return raw.read_csv(spark, raw.latest_entry(spark, [f"{folder}/missing", folder]), S.RAW_INVOICE)


def q_filename_metadata(spark, sf):
    folder = scratch_dir(spark, "named")
    r = raw_invoice_text(_orders(spark, sf)).withColumn("_ref", F.substring(F.replace("dt_emissao_fatura", F.lit("-"), F.lit("")), 1, 6))
    raw.write_named_batches(r, folder, "fatura_raw", "_ref", FILE_STAMP)
    df = raw.read_csv(spark, folder + "/*.csv", S.RAW_INVOICE, with_metadata=True)
    return raw.with_file_metadata(df)


def q_scan_parquet_partitioned(spark, sf):
    path = scratch_dir(spark, "tb_01_fatura")
    append_partitioned(_tables(spark, sf).invoices, path, ["ref"])
    return lake.read_table(spark, path, S.INVOICES).select(*S.INVOICES.fieldNames())


def q_scan_parquet_merge_schema(spark, sf):
    """Two loads: the first without the minimum payment and with a narrower value."""
    table = scratch_dir(spark, "versions") + "/tb_01_fatura"
    inv = _tables(spark, sf).invoices
    old = F.col("ref") < F.lit("199801")
    narrow = inv.where(old).drop("valor_pagamento_minimo").withColumn("valor_fatura", F.col("valor_fatura").cast("decimal(11,2)"))
    for run, rows in (("v1", narrow), ("v2", inv.where(~old))):
        commit(spark, run, DT_PROC, [write_run(rows, table, run)])
    folder = F.regexp_extract("filename", "^(.*)/[^/]*$", 1)  # a file's own name is random
    return lake.read_merged(spark, table).select(*S.INVOICES.fieldNames(), folder.alias("filename"))


def q_audit_latest_runs(spark, sf):
    lake_root = scratch_dir(spark, "lake")
    load_trusted(raw_invoice_text(_orders(spark, sf)), "fatura", DT_PROC, f"{lake_root}/trusted/tb_01_fatura",
                 f"{lake_root}/qualidade", f"{lake_root}/controle", "tb_faturas.csv")
    return lake.latest_runs(spark.read.schema(S.QUALITY).parquet(f"{lake_root}/qualidade"))


def q_audit_history(spark, sf):
    """Two loads of invoices and payments and the book of the second."""
    root = scratch_dir(spark, "audited")
    invoices, payments = raw_invoice_text(_orders(spark, sf)), raw_payment_text(_tables(spark, sf).payments)
    first = F.col("dt_emissao_fatura") < F.lit("1998-01-01")
    paid_first = F.col("dt_pagamento") < F.lit("1998-01-01")
    for dt_proc, inv, pay in ((DT_PROC, invoices.where(first), payments.where(paid_first)),
                              (TS_PROC, invoices.where(~first), payments.where(~paid_first))):
        load_trusted(inv, "fatura", dt_proc, f"{root}/trusted/tb_01_fatura", f"{root}/qualidade", f"{root}/controle", "a.csv")
        load_trusted(distinct_by(pay, ["id_pagamento"]), "pagamento", dt_proc, f"{root}/trusted/tb_02_pagamento",
                     f"{root}/qualidade", f"{root}/controle", "b.csv")
    run_book(spark, root, TS_PROC)
    return lake.audit_history(spark, root)


def q_sink_partitioned_roundtrip(spark, sf):
    path = scratch_dir(spark, "stage_fatura")
    append_partitioned(_stage(spark, sf), path, ["ref"])
    return lake.read_table(spark, path, S.STAGE).select(*S.STAGE.fieldNames())


def q_sink_two_level_partition_roundtrip(spark, sf):
    path = scratch_dir(spark, "book_01")
    book = B.book_by_client(_joined(spark, sf), AS_OF, TS_PROC)
    append_partitioned(book, path, ["ref", "ts_proc"])
    return spark.read.schema(book.schema).parquet(path).select(*book.columns)


def q_export_csv_semicolon(spark, sf):
    path = scratch_dir(spark, "export")
    dist = decimals_to_double(M.status_distribution(_vw(spark, sf), month=None))
    export_csv(dist, path, sep=";")
    schema = "status string, qtd bigint, volume_bruto double"
    return spark.read.schema(schema).option("header", True).option("sep", ";").csv(path)


QUERIES: dict[str, Query] = {
    # pipeline and book
    "book_by_cohort": q_book_by_cohort,
    "book_for_cohort": q_book_for_cohort,
    "invoices_for_cohort": q_invoices_for_cohort,
    "invoices_lookback_180d": q_invoices_lookback_180d,
    "payments_lookback_180d": q_payments_lookback_180d,
    "dedup_latest_invoices": q_dedup_latest_invoices,
    "dedup_latest_payments": q_dedup_latest_payments,
    "invoice_payment_join": q_invoice_payment_join,
    "payment_status": q_payment_status,
    "payment_status_total": q_payment_status_total,
    "days_late": q_days_late,
    "days_late_ref_date": q_days_late_ref_date,
    "days_late_as_of": q_days_late_as_of,
    "stage_invoices": q_stage_invoices,
    "stage_invoices_clustered": q_stage_invoices_clustered,
    "window_flags_client_anchor": q_window_flags_client_anchor,
    "window_flags_fixed_anchor": q_window_flags_fixed_anchor,
    "window_flags_truncated": q_window_flags_truncated,
    "months_between_values": q_months_between_values,
    "book_by_client": q_book_by_client,
    "book_keys_first": q_book_keys_first,
    "book_filled": q_book_filled,
    "book_sample": q_book_sample,
    "view_book": q_view_book,
    "version_key": q_version_key,
    "dedup_join_max_key": q_dedup_join_max_key,
    "snapshot_latest_batch": q_snapshot_latest_batch,
    # trusted loads
    "trusted_invoices": q_trusted_invoices,
    "trusted_payments": q_trusted_payments,
    "trusted_invoices_daily": q_trusted_invoices_daily,
    "trusted_payments_daily": q_trusted_payments_daily,
    "parse_ids": q_parse_ids,
    "ref_from_text": q_ref_from_text,
    "ref_from_date": q_ref_from_date,
    "typed_casts": q_typed_casts,
    # observability
    "integrity_duplicate_keys": q_integrity_duplicate_keys,
    "integrity_nulls": q_integrity_nulls,
    "integrity_reconcile": q_integrity_reconcile,
    "integrity_report": q_integrity_report,
    "integrity_report_book": q_integrity_report_book,
    "integrity_report_dedup": q_integrity_report_dedup,
    "lineage_row": q_lineage_row,
    "control_row": q_control_row,
    "control_row_payments": q_control_row_payments,
    "control_row_book": q_control_row_book,
    "row_counts_by_table": q_row_counts_by_table,
    "dup_invoice_ids": q_dup_invoice_ids,
    "dup_payment_ids": q_dup_payment_ids,
    # marts
    "view_invoices": q_view_invoices,
    "view_payments": q_view_payments,
    "view_integrated": _mart(lambda vw: vw),
    "latest_cohort_rows": _mart(M.latest_cohort_rows),
    "mart_kpis": _mart(M.mart_kpis),
    "mart_kpis_month": _month_mart(M.mart_kpis, month=MONTH),
    "mart_kpi_shares": q_mart_kpi_shares,
    "status_evolution": _mart(M.status_evolution),
    "status_distribution": _mart(M.status_distribution),
    "status_distribution_month": _month_mart(M.status_distribution, month=MONTH),
    "status_share": q_status_share,
    "churn_evolution": _mart(M.churn_evolution),
    "churn_diagnosis": _mart(M.churn_diagnosis),
    "churn_diagnosis_month": _mart(M.churn_diagnosis, month=MONTH),
    "churn_diagnosis_share": q_churn_diagnosis_share,
    "inactive_clients": _mart(M.inactive_clients),
    "client_lifetime": _mart(M.client_lifetime),
    "client_summary": _mart(M.client_summary),
    "client_summary_one": _mart(M.client_summary, client_id=CLIENT_ID),
    "client_summary_labels": q_client_summary_labels,
    "client_history": _mart(M.client_history),
    "client_recent_6": _mart(M.client_recent, n=6),
    "client_lookup": _mart(M.client_lookup, client_id=CLIENT_ID),
    "top_risk_clients": _mart(M.top_risk_clients),
    "top_risk_clients_month": _month_mart(M.top_risk_clients, month=MONTH),
    "invoice_detail_top": _mart(M.invoice_detail_by_status),
    "invoice_detail_by_status": _mart(M.invoice_detail_by_status, status=S.STATUS_LATE),
    "invoice_detail_by_behaviour": _mart(M.invoice_detail_by_behaviour, behaviour=S.BEHAVIOUR_MIN),
    "invoice_detail_by_delay_band": _mart(M.invoice_detail_by_delay_band, band=S.DELAY_BANDS[0][1]),
    "invoice_detail_by_delay_band_month": _month_mart(M.invoice_detail_by_delay_band, band=S.DELAY_BANDS[1][1], month=MONTH),
    "invoice_value_bands": _mart(M.invoice_value_bands),
    "minimum_payment_behaviour": _mart(M.minimum_payment_behaviour),
    "delay_bands": _mart(M.delay_bands),
    "delay_bands_month": _month_mart(M.delay_bands, month=MONTH),
    "month_dimension": _mart(M.month_dimension),
    "client_dimension": _mart(M.client_dimension),
    # sources and sinks
    "scan_csv_raw": q_scan_csv_raw,
    "scan_csv_folder": q_scan_csv_folder,
    "latest_file_batch": q_latest_file_batch,
    "filename_metadata": q_filename_metadata,
    "scan_parquet_partitioned": q_scan_parquet_partitioned,
    "scan_parquet_merge_schema": q_scan_parquet_merge_schema,
    "audit_latest_runs": q_audit_latest_runs,
    "audit_history": q_audit_history,
    "sink_partitioned_roundtrip": q_sink_partitioned_roundtrip,
    "sink_two_level_partition_roundtrip": q_sink_two_level_partition_roundtrip,
    "export_csv_semicolon": q_export_csv_semicolon,
}

def _nullable_int_columns() -> dict[str, list[str]]:
    """Integer outputs that are NULL by definition when nothing matches (book
    MIN/MAX of days, prototype-book counts). They leave as DOUBLE like money, so a NULL-bearing integer
    column has one representation across engines and dataframe libraries."""
    days = [s.name for s in B.metric_specs() if s.value_col == B.DAYS_COL and s.agg in ("MIN", "MAX")]
    counts = [f"qtd_st_{c.lower()}" for c in B.CLIENT_BOOK_CLASSES]
    counts += [f"qtd_st_{c.lower()}_{w}" for w, k in S.WINDOWS.items() if k is not None for c in B.CLIENT_BOOK_CLASSES]
    return {
        **{q: days for q in ("book_by_cohort", "book_for_cohort", "book_keys_first", "book_sample", "view_book")},
        "book_by_client": counts,
        "sink_two_level_partition_roundtrip": counts,
    }


NULLABLE_INTS = _nullable_int_columns()


def _as_double(fn, cols):
    def run(spark, sf):
        df = fn(spark, sf)
        wanted = set(cols)
        return df.selectExpr(*[f"CAST(`{c}` AS DOUBLE) AS `{c}`" if c in wanted else f"`{c}`" for c in df.columns])
    return run


RAW_QUERIES = dict(QUERIES)
QUERIES = {k: _out(_as_double(v, NULLABLE_INTS[k]) if k in NULLABLE_INTS else v) for k, v in QUERIES.items()}
