"""Invoice/payment joins."""

from __future__ import annotations

import datetime as _dt
import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from billbook.functions import days_late, days_late_as_of, mart_status, month_label, month_start, payment_status
from billbook.operators.dedup import dedup_latest
from billbook.schemas import INVOICE_KEYS

JOIN_KEYS = ["id_fatura", "id_cliente"]


def invoice_payment_join(invoices: DataFrame, payments: DataFrame) -> DataFrame:
    """Deduplicated invoices LEFT JOIN deduplicated payments on (invoice, client).

    Both sides are deduplicated on the same key, so the join is 1:1 and reuses
    the dedup shuffle (no extra exchange).
    """
    a = invoices.select(
        "id_cliente", "id_fatura", "ref", "data_emissao", "data_vencimento", "valor_fatura", "valor_pagamento_minimo"
    )
    b = payments.select("id_cliente", "id_fatura", "id_pagamento", "data_pagamento", "valor_pagamento")
    return a.join(b, JOIN_KEYS, "left").select(
        "id_cliente", "id_fatura", "ref", "data_emissao", "data_vencimento", "valor_fatura",
        "valor_pagamento_minimo", "id_pagamento", "data_pagamento", "valor_pagamento",
    )


def latest_invoices(invoices: DataFrame) -> DataFrame:
    return dedup_latest(invoices, INVOICE_KEYS)


def latest_payments(payments: DataFrame) -> DataFrame:
    """Latest payment per (client, invoice); several payments of one invoice
    collapse to one. Of one version the greatest payment id stays."""
    return dedup_latest(payments, INVOICE_KEYS, lead=["id_pagamento"])


def classified(joined: DataFrame, ref_date=None) -> DataFrame:
    """Add the pipeline class and days late to the joined rows."""
    out = joined.withColumn("fbc_classificacao_pagamento", payment_status())
    return out.withColumn("fvl_numero_dias_atraso", days_late(ref_date=ref_date))


def stage_invoices(classified_rows: DataFrame, dt_proc: str) -> DataFrame:
    """Stage projection: class, value, days late and a constant counter."""
    return classified_rows.select(
        "ref",
        F.lit(dt_proc).alias("dt_proc"),
        "id_cliente",
        "fbc_classificacao_pagamento",
        "data_emissao",
        F.col("valor_fatura").alias("fvl_valor_fatura"),
        F.col("fvl_numero_dias_atraso").cast("int").alias("fvl_numero_dias_atraso"),
        F.lit(1).alias("fvl_qtd_transacoes"),
    )


#: A key with more rows on the right is dealt to several tasks; the
#: MOST_HEAVY heaviest are (the next one has under a thousandth of all rows).
HEAVY_ROWS, MOST_HEAVY = 1_000_000, 1000
#: Part of the rows looked at to find such keys.
LOOK = 0.01


def heavy_keys(rows: DataFrame, keys: Sequence[str], looked: float = 1.0, heavy_rows: int = HEAVY_ROWS) -> list[tuple]:
    """(key..., pieces of about ``heavy_rows`` rows) for the keys with more
    rows than that, MOST_HEAVY at most. ``rows`` may be a sample of ``looked``
    of all rows, or an older state of the table: which keys are named changes
    where rows are joined, never what comes out."""
    counts = rows.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    heavy = counts.where(F.col("n") > heavy_rows * looked).orderBy(F.desc("n"), *keys).limit(MOST_HEAVY)
    return [(*[r[k] for k in keys], math.ceil(r["n"] / (heavy_rows * looked))) for r in heavy.collect()]


def split_left_join(left: DataFrame, right: DataFrame, keys: Sequence[str], heavy: Sequence[tuple]) -> DataFrame:
    """``left`` LEFT JOIN ``right`` on ``keys`` where single keys may hold a
    large part of ``right``, which no left outer join can split by itself.

    The right rows of a ``heavy`` key (``heavy_keys``; without any this is the
    plain join) are dealt to ``pieces`` parts by a hash of the whole row, and
    its left rows stand once in every part; other keys have one part. A heavy
    key that does stand in ``right`` has a match, so the empty rows that parts
    without one give go. Only the heavy keys, MOST_HEAVY at most, are broadcast.
    Rows that equal each other in all columns stay together."""
    if not heavy:
        return left.join(right, list(keys), "left")
    schema = StructType([*[right.schema[k] for k in keys], StructField("_pieces", IntegerType())])
    named = F.broadcast(right.sparkSession.createDataFrame(list(heavy), schema))
    # Looked up in ``right`` itself, so an outdated key is a plain one.
    present = right.select(*keys).join(named, list(keys)).distinct()
    marks = F.broadcast(present.select(*[F.col(k).alias(f"_h_{k}") for k in keys], "_pieces"))

    def marked(df: DataFrame) -> DataFrame:
        same = reduce(lambda a, b: a & b, [df[k] == marks[f"_h_{k}"] for k in keys])
        return df.join(marks, same, "left").drop(*[f"_h_{k}" for k in keys])

    one = F.coalesce("_pieces", F.lit(1))
    a = marked(left).select(*left.columns, "_pieces", F.explode(F.sequence(F.lit(0), one - 1)).alias("_piece"))
    b = marked(right).withColumn("_right_piece", F.pmod(F.xxhash64(*right.columns), one).cast("int"))
    rest = [c for c in right.columns if c not in keys]
    b = b.select(*[F.col(k).alias(f"_r_{k}") for k in keys], "_right_piece", *rest)
    same = reduce(lambda x, y: x & y, [a[k] == b[f"_r_{k}"] for k in keys]) & (a["_piece"] == b["_right_piece"])
    whole = a.join(b, same, "left").where(F.col("_pieces").isNull() | F.col("_right_piece").isNotNull())
    return whole.select(*keys, *[c for c in left.columns if c not in keys], *rest)


def integrated_view(
    invoices: DataFrame, payments: DataFrame, as_of: str | _dt.date, month: str | None = None, heavy: Sequence[tuple] | None = None
) -> DataFrame:
    """All invoice versions LEFT JOIN all payment versions (not deduplicated;
    fans out on repeated payments), with the mart status and days late as of
    ``as_of`` (the wall clock is an argument, so results repeat).

    With ``month`` only that cohort's invoices, and only payments of their
    keys: the semi join is planned with a runtime Bloom filter of the keys
    where payments are large, so the others stop at their scan. Payments of a
    hot invoice are dealt to several tasks (``heavy``, by default found in a
    sample of the payments)."""
    f = invoices.select(
        "ref", "dt_proc", "id_fatura", "id_cliente", "data_emissao", "data_vencimento",
        "valor_fatura", "valor_pagamento_minimo",
    )
    p = payments.select("id_fatura", "id_cliente", "data_pagamento", F.col("valor_pagamento").alias("valor_pagamento_raw"))
    if month is not None:
        f = f.where(F.col("ref") == F.lit(month.replace("-", "")[:6]))
        p = p.join(f.select(*JOIN_KEYS), JOIN_KEYS, "left_semi")
    j = split_left_join(f, p, JOIN_KEYS, heavy_keys(payments.sample(LOOK, seed=7), JOIN_KEYS, LOOK) if heavy is None else heavy)
    ref_month = month_start(F.col("ref"))
    return j.select(
        "ref", "dt_proc", "id_fatura", "id_cliente",
        ref_month.alias("data_referencia"),
        month_label(ref_month).alias("mes_ano"),
        "data_emissao", "data_vencimento", "valor_fatura", "valor_pagamento_minimo", "data_pagamento",
        F.coalesce(F.col("valor_pagamento_raw"), F.lit(0).cast("decimal(15,2)")).alias("valor_pagamento"),
        days_late_as_of("data_vencimento", "data_pagamento", as_of).alias("dias_atraso"),
        mart_status().alias("status"),
    )
