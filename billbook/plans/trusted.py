"""Trusted loads: raw text -> typed, checked, ``ref``-partitioned tables.

The typed projections are single ``select``s of built-in expressions
(whole-stage codegen). A load parses its raw text once: it writes to
staging, checks the staged Parquet, then publishes (see ``load_trusted``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billbook.functions import money, parse_date, parse_id, ref_from_date, ref_from_text
from billbook.operators.observability import IntegritySpec, check_integrity, lineage_row, record_lineage
from billbook.schemas import MONEY

INVOICE_SPEC_KEYS = ["ref", "dt_proc", "id_cliente", "id_fatura"]
INVOICE_REQUIRED = ["ref", "dt_proc", "id_cliente", "id_fatura", "data_emissao", "valor_fatura"]
PAYMENT_SPEC_KEYS = ["ref", "dt_proc", "id_cliente", "id_fatura", "id_pagamento"]
PAYMENT_REQUIRED = ["ref", "dt_proc", "id_cliente", "id_fatura", "id_pagamento", "data_pagamento", "valor_pagamento"]


def trusted_invoices(raw: DataFrame, dt_proc: str) -> DataFrame:
    """Typed invoices. ``ref`` comes from the raw emission text (first six
    characters without dashes); the minimum payment is a constant 0.00."""
    return raw.select(
        ref_from_text("dt_emissao_fatura").alias("ref"),
        F.lit(dt_proc).alias("dt_proc"),
        F.col("id_cliente").cast("string").try_cast("bigint").alias("id_cliente"),
        parse_id("id_fatura").alias("id_fatura"),
        parse_date("dt_emissao_fatura").alias("data_emissao"),
        parse_date("dt_vencimento_fatura").alias("data_vencimento"),
        money("valor_fatura").alias("valor_fatura"),
        F.lit(0).cast(MONEY).alias("valor_pagamento_minimo"),
    )


def trusted_payments(raw: DataFrame, dt_proc: str) -> DataFrame:
    """Typed payments; ``ref`` is the payment month of the parsed date; ids
    are bigint (an int would overflow)."""
    paid_on = parse_date("dt_pagamento")
    return raw.select(
        ref_from_date(paid_on).alias("ref"),
        F.lit(dt_proc).alias("dt_proc"),
        F.col("id_cliente").cast("string").try_cast("bigint").alias("id_cliente"),
        parse_id("id_fatura").alias("id_fatura"),
        parse_id("id_pagamento").alias("id_pagamento"),
        paid_on.alias("data_pagamento"),
        money("valor_pagamento").alias("valor_pagamento"),
    )


def trusted_invoices_daily(raw: DataFrame, ts_proc: str) -> DataFrame:
    """Prototype variant: daily ``ref`` (``yyyyMMdd``), run and file stamps."""
    stamp = F.col("ts_file_generation") if "ts_file_generation" in raw.columns else F.lit(None).cast("string")
    return raw.select(
        ref_from_text("dt_emissao_fatura", 8).alias("ref"),
        F.lit(ts_proc).alias("ts_proc"),
        stamp.cast("string").alias("ts_file_generation"),
        F.col("id_cliente").cast("string").try_cast("bigint").alias("id_cliente"),
        F.col("id_fatura").cast("string").try_cast("bigint").alias("id_fatura"),
        parse_date("dt_emissao_fatura").alias("dt_emissao_fatura"),
        parse_date("dt_vencimento_fatura").alias("dt_vencimento_fatura"),
        money("valor_fatura").alias("valor_fatura"),
    )


def trusted_payments_daily(raw: DataFrame, ts_proc: str) -> DataFrame:
    stamp = F.col("ts_file_generation") if "ts_file_generation" in raw.columns else F.lit(None).cast("string")
    return raw.select(
        ref_from_text("dt_pagamento", 8).alias("ref"),
        stamp.cast("string").alias("ts_file_generation"),
        F.lit(ts_proc).alias("ts_proc"),
        F.col("id_pagamento").cast("string").try_cast("bigint").alias("id_pagamento"),
        F.col("id_fatura").cast("string").try_cast("bigint").alias("id_fatura"),
        F.col("id_cliente").cast("string").try_cast("bigint").alias("id_cliente"),
        parse_date("dt_pagamento").alias("dt_pagamento"),
        money("valor_pagamento").alias("valor_pagamento"),
    )


def load_trusted(
    raw: DataFrame,
    kind: str,
    dt_proc: str,
    table_path: str,
    quality_path: str | None = None,
    lineage_path: str | None = None,
    source_name: str = "",
) -> dict:
    """Type, check and append one raw load to its ``ref``-partitioned table.

    The raw text is parsed once: typed rows are written as a run of the table
    that no reader sees yet, and counted on the way. The checks then read that
    Parquet (the key and required columns), reconciling against the count; the
    quality row is appended either way. Only when every check passes is the
    run published, by one commit record; a failed load leaves the table
    untouched, and loading again with the same ``dt_proc`` replaces the load.
    """
    from billbook.schemas import INVOICES, PAYMENTS
    from billbook.sinks.commits import commit, drop_run, new_run, read_runs, write_run

    if kind == "fatura":
        typed, keys, req, table, schema = trusted_invoices(raw, dt_proc), INVOICE_SPEC_KEYS, INVOICE_REQUIRED, "tb_01_fatura", INVOICES
    elif kind == "pagamento":
        typed, keys, req, table, schema = trusted_payments(raw, dt_proc), PAYMENT_SPEC_KEYS, PAYMENT_REQUIRED, "tb_02_pagamento", PAYMENTS
    else:
        raise ValueError(f"unknown load kind {kind!r}")
    spark = raw.sparkSession
    run = new_run(dt_proc)
    try:
        written = write_run(typed, table_path, run)
        spec = IntegritySpec(keys=keys, not_null=req, expected=written.rows, tolerance=0.0)
        report = check_integrity(read_runs(spark, table_path, [run], schema), table, dt_proc, spec, quality_path)
    except Exception:
        drop_run(spark, table_path, run)
        raise
    commit(spark, f"{table}-{dt_proc}", dt_proc, [written])
    if lineage_path:
        record_lineage(
            lineage_path,
            lineage_row(spark, table, dt_proc, report["total_registros"], f"raw/{kind}", source_name),
        )
    return report
