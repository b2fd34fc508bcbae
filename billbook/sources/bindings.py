"""Bind the driver's test tables to the invoice/payment contracts.

Invoices come from ``orders``; payments from ``lineitem`` joined to their
invoice. The same derivation is written independently in DuckDB SQL for the
oracle (``oracle/``), so both engines see identical inputs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billbook.operators.joins import LOOK
from billbook.schemas import MONEY

# ---------------------------------------------------------------------------
# FIXED VALUES of the binding (see FIXTURES.md §3).
INVOICE_BATCH = "20020101000000"   # dt_proc stamped on every invoice row
DUE_DAYS = 30                      # due date = emission + 30 days
PARTIAL_DISCOUNT = 0.08            # discount at or above it pays 100.00 less
PARTIAL_SHORTFALL = "100.00"
AS_OF = "2001-12-31"               # fixed evaluation date (after last payment)
# Payment tie-breakers after dt_proc, all descending.
# ---------------------------------------------------------------------------


# Declared schemas of the source tables this library binds: with a schema
# the reader skips the footer-inference job and reads only these columns.
SOURCE_SCHEMAS = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ",
    "lineitem": ("l_orderkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_discount DOUBLE, l_returnflag STRING, l_shipdate TIMESTAMP_NTZ"),
}


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    reader = spark.read
    if name in SOURCE_SCHEMAS:
        reader = reader.schema(SOURCE_SCHEMAS[name])
    df = reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def invoices_from_orders(orders: DataFrame) -> DataFrame:
    emitted = F.to_date(F.col("o_orderdate"))
    return orders.select(
        F.date_format(F.col("o_orderdate"), "yyyyMM").alias("ref"),
        F.lit(INVOICE_BATCH).alias("dt_proc"),
        F.col("o_custkey").cast("bigint").alias("id_cliente"),
        F.col("o_orderkey").cast("bigint").alias("id_fatura"),
        emitted.alias("data_emissao"),
        F.date_add(emitted, DUE_DAYS).alias("data_vencimento"),
        F.col("o_totalprice").cast(MONEY).alias("valor_fatura"),
        F.lit(0).cast(MONEY).alias("valor_pagamento_minimo"),
    )


def payments_from_lineitem(lineitem: DataFrame, invoices: DataFrame) -> DataFrame:
    """One payment per line item."""
    li = lineitem.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag",
        "l_shipdate",
    )
    inv = invoices.select("id_cliente", "id_fatura", "data_vencimento", "valor_fatura")
    j = li.join(inv, li["l_orderkey"] == inv["id_fatura"], "inner")
    shift = (
        F.when(F.col("l_returnflag") == "R", -F.col("l_linenumber"))
        .when(F.col("l_returnflag") == "N", F.lit(0))
        .otherwise(F.col("l_quantity").cast("int"))
    )
    paid_on = F.date_add(F.col("data_vencimento"), shift)
    paid = (
        F.when(F.col("l_discount") >= F.lit(PARTIAL_DISCOUNT), F.col("valor_fatura") - F.lit(PARTIAL_SHORTFALL).cast(MONEY))
        .otherwise(F.col("valor_fatura"))
        .cast(MONEY)
    )
    cols = [
        F.date_format(paid_on, "yyyyMM").alias("ref"),
        F.concat(F.date_format(F.col("l_shipdate"), "yyyyMMdd"), F.lit("000000")).alias("dt_proc"),
        F.col("id_cliente"),
        F.col("id_fatura"),
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).cast("bigint").alias("id_pagamento"),
        paid_on.alias("data_pagamento"),
        paid.alias("valor_pagamento"),
    ]
    return j.select(*cols)


@dataclass
class Tables:
    """Invoices and payments bound from one scale-factor folder."""

    invoices: DataFrame
    payments: DataFrame
    #: A sample of the payments, taken before they are bound to their invoice.
    some_payments: DataFrame
    as_of: str = AS_OF


def load_tables(spark: SparkSession, sf_dir: str) -> Tables:
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"])
    lineitem = read_table(spark, sf_dir, "lineitem")
    invoices = invoices_from_orders(orders)
    return Tables(
        invoices=invoices,
        payments=payments_from_lineitem(lineitem, invoices),
        some_payments=payments_from_lineitem(lineitem.sample(LOOK, seed=7), invoices),
    )


def raw_invoice_text(orders: DataFrame) -> DataFrame:
    """Raw invoice rows as text (the CSV contract) made from ``orders``.
    Invoice ids carry a ``FAT-`` prefix, so the digit strip is exercised."""
    emitted = F.to_date(F.col("o_orderdate"))
    return orders.select(
        F.col("o_custkey").cast("string").alias("id_cliente"),
        F.concat(F.lit("FAT-"), F.col("o_orderkey").cast("string")).alias("id_fatura"),
        F.date_format(emitted, "yyyy-MM-dd").alias("dt_emissao_fatura"),
        F.date_format(F.date_add(emitted, DUE_DAYS), "yyyy-MM-dd").alias("dt_vencimento_fatura"),
        F.col("o_totalprice").cast(MONEY).cast("string").alias("valor_fatura"),
    )


def raw_payment_text(payments: DataFrame) -> DataFrame:
    """Raw payment rows as text made from bound payments; payment ids carry
    a ``PAG-`` prefix."""
    return payments.select(
        F.col("id_cliente").cast("string").alias("id_cliente"),
        F.col("id_fatura").cast("string").alias("id_fatura"),
        F.concat(F.lit("PAG-"), F.col("id_pagamento").cast("string")).alias("id_pagamento"),
        F.date_format(F.col("data_pagamento"), "yyyy-MM-dd").alias("dt_pagamento"),
        F.col("valor_pagamento").cast("string").alias("valor_pagamento"),
    )
