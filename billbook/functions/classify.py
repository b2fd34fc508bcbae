"""Domain classifiers, each a single CASE expression."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from billbook import schemas as S


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _date(d) -> Column:
    if isinstance(d, Column):
        return d
    if isinstance(d, (_dt.date, _dt.datetime)):
        d = d.strftime("%Y-%m-%d")
    return F.to_date(F.lit(str(d)))


def payment_status(
    paid_on: Column | str = "data_pagamento",
    paid: Column | str = "valor_pagamento",
    billed: Column | str = "valor_fatura",
    due: Column | str = "data_vencimento",
) -> Column:
    """Pipeline class. Falls through to NULL when no branch decides
    (e.g. NULL due date on a fully paid invoice)."""
    paid_on, paid, billed, due = map(_col, (paid_on, paid, billed, due))
    return (
        F.when(paid_on.isNull(), F.lit("NAO_PAGO"))
        .when(paid < billed, F.lit("PAGAMENTO_PARCIAL"))
        .when(paid_on < due, F.lit("PAGAMENTO_ANTECIPADO"))
        .when(paid_on == due, F.lit("PAGO_EM_DIA"))
        .when(paid_on > due, F.lit("PAGO_EM_ATRASO"))
    )


def payment_status_total(
    paid_on: Column | str = "data_pagamento",
    paid: Column | str = "valor_pagamento",
    billed: Column | str = "valor_fatura",
    due: Column | str = "data_vencimento",
) -> Column:
    """Prototype class: every row gets a class (ELSE -> late)."""
    paid_on, paid, billed, due = map(_col, (paid_on, paid, billed, due))
    return (
        F.when(paid_on.isNull(), F.lit("NAO_PAGO"))
        .when(paid < billed, F.lit("PAGAMENTO_PARCIAL"))
        .when(paid_on < due, F.lit("PAGAMENTO_ANTECIPADO"))
        .when(paid_on <= due, F.lit("PAGO_EM_DIA"))
        .otherwise(F.lit("PAGO_EM_ATRASO"))
    )


def mart_status(
    paid_on: Column | str = "data_pagamento",
    paid: Column | str = "valor_pagamento_raw",
    billed: Column | str = "valor_fatura",
    due: Column | str = "data_vencimento",
) -> Column:
    """Status label used by the marts (ELSE -> late)."""
    paid_on, paid, billed, due = map(_col, (paid_on, paid, billed, due))
    return (
        F.when(paid_on.isNull(), F.lit(S.STATUS_UNPAID))
        .when(paid < billed, F.lit(S.STATUS_PARTIAL))
        .when(paid_on < due, F.lit(S.STATUS_EARLY))
        .when(paid_on == due, F.lit(S.STATUS_ON_TIME))
        .otherwise(F.lit(S.STATUS_LATE))
    )


def days_late(
    status: Column | str = "fbc_classificacao_pagamento",
    paid_on: Column | str = "data_pagamento",
    due: Column | str = "data_vencimento",
    ref_date=None,
) -> Column:
    """Pipeline days late: unpaid -> evaluation date minus due; late -> paid
    minus due; anything else 0. Without ``ref_date`` the evaluation date is
    ``coalesce(paid_on, due)``, so unpaid invoices get 0."""
    status, paid_on, due = map(_col, (status, paid_on, due))
    eval_date = F.coalesce(paid_on, due) if ref_date is None else _date(ref_date)
    return (
        F.when(status == F.lit("NAO_PAGO"), F.datediff(eval_date, due))
        .when(status == F.lit("PAGO_EM_ATRASO"), F.datediff(paid_on, due))
        .otherwise(F.lit(0))
    )


def days_late_as_of(due: Column | str, paid_on: Column | str, as_of) -> Column:
    """Mart days late: ``max(0, coalesce(paid_on, as_of) - due)``."""
    due, paid_on = _col(due), _col(paid_on)
    return F.greatest(F.lit(0), F.datediff(F.coalesce(paid_on, _date(as_of)), due))


def _on_time_or_early(status: Column) -> Column:
    return status.contains("em Dia") | status.contains("Antecipado")


def retention_category(status: Column | str, invoice_id: Column | str) -> Column:
    """Client activity category of one joined row."""
    status, invoice_id = _col(status), _col(invoice_id)
    return (
        F.when(invoice_id.isNull(), F.lit(S.RET_INACTIVE))
        .when(_on_time_or_early(status), F.lit(S.RET_ON_TIME))
        .otherwise(F.lit(S.RET_LATE))
    )


def value_band(v: Column | str = "valor_fatura") -> Column:
    v = _col(v)
    expr = None
    for edge, label in S.VALUE_BANDS:
        if edge is None:
            return expr.otherwise(F.lit(label))
        cond = v <= F.lit(edge)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def minimum_behaviour(
    paid: Column | str = "valor_pagamento",
    billed: Column | str = "valor_fatura",
    minimum: Column | str = "valor_pagamento_minimo",
) -> Column:
    paid, billed, minimum = map(_col, (paid, billed, minimum))
    return (
        F.when(paid >= billed, F.lit(S.BEHAVIOUR_FULL))
        .when(paid >= minimum, F.lit(S.BEHAVIOUR_MIN))
        .otherwise(F.lit(S.BEHAVIOUR_BELOW))
    )


def minimum_behaviour_filter(label: str | None) -> Column | None:
    """Row predicate selecting one behaviour (None -> no filter)."""
    paid, billed, minimum = F.col("valor_pagamento"), F.col("valor_fatura"), F.col("valor_pagamento_minimo")
    if label is None:
        return None
    if label == S.BEHAVIOUR_FULL:
        return paid >= billed
    if label == S.BEHAVIOUR_MIN:
        return (paid >= minimum) & (paid < billed)
    if label == S.BEHAVIOUR_BELOW:
        return paid < minimum
    raise ValueError(f"unknown behaviour {label!r}")


def delay_band(status: Column | str = "status", days: Column | str = "dias_atraso") -> Column:
    status, days = _col(status), _col(days)
    expr = F.when(_on_time_or_early(status), F.lit(S.DELAY_BAND_ON_TIME))
    for edge, label in S.DELAY_BANDS:
        expr = expr.otherwise(F.lit(label)) if edge is None else expr.when(days <= F.lit(edge), F.lit(label))
    return expr


def delay_band_filter(label: str | None) -> Column | None:
    """Row predicate for the delay-band drill-down, as one parenthesised
    Column so it composes safely with other filters. The ranges start at
    ``> 0`` days, unlike the band CASE (kept as defined)."""
    status, days = F.col("status"), F.col("dias_atraso")
    if label is None:
        return None
    if label == S.DELAY_BAND_ON_TIME:
        return _on_time_or_early(status)
    lower = 0
    for edge, band in S.DELAY_BANDS:
        if band == label:
            cond = days > F.lit(lower)
            return cond if edge is None else cond & (days <= F.lit(edge))
        lower = edge
    raise ValueError(f"unknown delay band {label!r}")


STATUS_LABELS = [S.STATUS_UNPAID, S.STATUS_PARTIAL, S.STATUS_EARLY, S.STATUS_ON_TIME, S.STATUS_LATE]


def label_rank(c: Column | str, labels=STATUS_LABELS) -> Column:
    """Position (1-based) of a label in the *sorted* label set: an integer
    whose max is the max label, so it aggregates in a hash aggregate
    (a ``max`` over strings would force a sort-based aggregate)."""
    c = _col(c)
    ordered = sorted(labels)
    expr = None
    for i, label in enumerate(ordered, start=1):
        expr = F.when(c == F.lit(label), F.lit(i)) if expr is None else expr.when(c == F.lit(label), F.lit(i))
    return expr


def label_from_rank(rank: Column, labels=STATUS_LABELS) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in sorted(labels)]), rank)
