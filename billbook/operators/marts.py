"""Portfolio marts over the integrated view (``joins.integrated_view``).

Every mart takes the view plus plain parameters and returns a DataFrame.
``month`` accepts ``yyyyMM`` or ``yyyy-MM-dd``; it filters on the ``ref``
partition column, so on a lake table it prunes partitions. Where the source
system answered "latest cohort" with a scalar subquery, so do these.

No mart materialises a client x month grid: retention and churn counts come
from per-month distinct counts and the global client total.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billbook import schemas as S
from billbook.functions.classify import label_from_rank, label_rank
from billbook.functions import (
    delay_band,
    delay_band_filter,
    minimum_behaviour,
    minimum_behaviour_filter,
    month_label,
    retention_category,
    value_band,
)

LATEST = "latest"


def _ym(month: str) -> str:
    return month.replace("-", "")[:6]


def for_month(vw: DataFrame, month: str | None) -> DataFrame:
    """Rows of one cohort month; ``None`` = all history; ``"latest"`` = the
    newest cohort (scalar subquery, evaluated once)."""
    if month is None:
        return vw
    if month == LATEST:
        newest = vw.agg(F.max("ref")).scalar()
        return vw.where(F.col("ref") == newest)
    return vw.where(F.col("ref") == F.lit(_ym(month)))


def latest_cohort_rows(vw: DataFrame) -> DataFrame:
    return for_month(vw, LATEST)


def _money(c: Column) -> Column:
    return F.coalesce(c, F.lit(0).cast("decimal(25,2)"))


# --------------------------------------------------------------------------- KPIs

def mart_kpis(vw: DataFrame, month: str | None = None) -> DataFrame:
    """Clients in total and per status (distinct), billed, paid and owed.

    Distinct counts are done as a per-client pre-aggregate (partial, map-side)
    followed by plain sums, instead of five DISTINCT aggregates (which Spark
    would expand five-fold).
    """
    rows = for_month(vw, month)
    st = F.col("status")

    def has(label):
        return F.max(F.when(st == label, F.lit(1)).otherwise(F.lit(0)))

    per_client = rows.groupBy("id_cliente").agg(
        has(S.STATUS_EARLY).alias("e"),
        has(S.STATUS_ON_TIME).alias("d"),
        has(S.STATUS_LATE).alias("a"),
        has(S.STATUS_UNPAID).alias("i"),
        F.sum("valor_fatura").alias("vf"),
        F.sum("valor_pagamento").alias("vp"),
        F.sum(F.col("valor_fatura") - F.col("valor_pagamento")).alias("vd"),
    )
    cid = F.col("id_cliente").isNotNull()
    return per_client.agg(
        F.count(F.when(cid, F.lit(1))).alias("total_clientes"),
        F.sum(F.when(cid, F.col("e")).otherwise(0)).cast("bigint").alias("cli_antecipados"),
        F.sum(F.when(cid, F.col("d")).otherwise(0)).cast("bigint").alias("cli_em_dia"),
        F.sum(F.when(cid, F.col("a")).otherwise(0)).cast("bigint").alias("cli_atraso"),
        F.sum(F.when(cid, F.col("i")).otherwise(0)).cast("bigint").alias("cli_inad"),
        _money(F.sum("vf")).alias("vol_faturado"),
        _money(F.sum("vp")).alias("vol_pago"),
        _money(F.sum("vd")).alias("vol_devedor"),
    )


def mart_kpi_shares(kpis: DataFrame) -> DataFrame:
    """Each client count as a percentage of the base (base 0 counts as 1)."""
    base = F.when(F.col("total_clientes") == 0, F.lit(1)).otherwise(F.col("total_clientes")).cast("double")

    def pct(c):
        return (F.col(c).cast("double") / base * F.lit(100.0)).alias(f"pct_{c[4:]}")

    return kpis.select(
        "total_clientes", pct("cli_antecipados"), pct("cli_em_dia"), pct("cli_atraso"), pct("cli_inad")
    )


# --------------------------------------------------------------------------- status

def status_evolution(vw: DataFrame) -> DataFrame:
    """Billed volume (millions) per cohort month and status."""
    g = vw.groupBy("data_referencia", "status").agg(F.sum("valor_fatura").alias("_v"))
    return g.select(
        "data_referencia",
        month_label("data_referencia").alias("mes_ano"),
        "status",
        (F.col("_v").cast("double") / F.lit(1e6)).alias("volume_m"),
    ).orderBy("data_referencia", "status")


def status_distribution(vw: DataFrame, month: str | None = LATEST) -> DataFrame:
    """Invoice rows and gross volume per status for one month (default: the
    newest cohort), largest first."""
    rows = for_month(vw, month)
    return (
        rows.groupBy("status")
        .agg(F.count(F.lit(1)).alias("qtd"), F.sum("valor_fatura").alias("volume_bruto"))
        .orderBy(F.desc("qtd"), "status")
    )


def status_share(dist: DataFrame) -> DataFrame:
    """Share of each status in the month's invoice count (percent)."""
    # One row per status, a handful: the total is a window over them.
    total = F.sum("qtd").over(Window.partitionBy())
    return dist.select(
        "status", "qtd", "volume_bruto", (F.col("qtd").cast("double") / total.cast("double") * F.lit(100.0)).alias("pct_qtd")
    )


# --------------------------------------------------------------------------- churn

def churn_evolution(vw: DataFrame) -> DataFrame:
    """Distinct clients per (month, retention category).

    The view is read once: one aggregate, combined map-side, gives a row per
    (month, client) with the categories the client shows in that month, and a
    row per client for the base. A second one sums them per month. Clients of
    the base with no row in a month count as inactive: ``base -
    present(month)``. No client x month grid is built. The months come from
    all rows, also those without a client.
    """
    cat = retention_category("status", "id_fatura")

    def shows(label):
        return F.max(F.when(cat == F.lit(label), F.lit(1)).otherwise(F.lit(0)))

    per_client = vw.groupingSets(
        [["data_referencia", "id_cliente"], ["id_cliente"]], "data_referencia", "id_cliente"
    ).agg(
        F.grouping("data_referencia").alias("_base"),
        shows(S.RET_ON_TIME).alias("_on_time"), shows(S.RET_LATE).alias("_late"), shows(S.RET_INACTIVE).alias("_inactive"),
    )
    known = F.col("id_cliente").isNotNull()
    per_month = per_client.groupBy("_base", "data_referencia").agg(
        F.count("id_cliente").alias("_present"),
        *[F.sum(F.when(known, F.col(f"_{c}")).otherwise(0)).alias(f"_{c}") for c in ("on_time", "late", "inactive")],
    )
    # A row per month and one for the base: the base is taken from it by a window over these few.
    base = F.max(F.when(F.col("_base") == 1, F.col("_present"))).over(Window.partitionBy())
    every = per_month.withColumn("_inactive", F.col("_inactive") + base - F.col("_present")).where(F.col("_base") == 0)
    stacked = every.select(
        "data_referencia",
        F.inline(F.array(*[
            F.struct(F.lit(label).alias("categoria_retencao"), F.col(c).cast("bigint").alias("qtd_clientes"))
            for label, c in ((S.RET_ON_TIME, "_on_time"), (S.RET_LATE, "_late"), (S.RET_INACTIVE, "_inactive"))
        ])),
    ).where(F.col("qtd_clientes") > 0)
    return stacked.select(
        "data_referencia", month_label("data_referencia").alias("mes_ano"), "categoria_retencao", "qtd_clientes"
    ).orderBy("data_referencia", "categoria_retencao")


def churn_diagnosis(vw: DataFrame, month: str | None = LATEST) -> DataFrame:
    """Clients of the base by diagnosis for one month: a client counts once
    per distinct status it has in the month; absent clients are inactive."""
    rows = for_month(vw, month).where(F.col("id_cliente").isNotNull())
    pairs = rows.select("id_cliente", "status").distinct()
    on_time = F.col("status").contains("em Dia") | F.col("status").contains("Antecipado")
    active = pairs.select(
        F.when(on_time, F.lit(S.RET_ON_TIME)).otherwise(F.lit(S.RET_LATE)).alias("diagnostico"),
        F.lit(1).cast("bigint").alias("n"),
    )
    base = vw.agg(F.count_distinct("id_cliente")).scalar()
    present = rows.agg(F.count_distinct("id_cliente")).scalar()
    inactive = vw.sparkSession.range(1).select(
        F.lit(S.RET_INACTIVE).alias("diagnostico"), (base - present).cast("bigint").alias("n")
    )
    return (
        active.unionByName(inactive)
        .groupBy("diagnostico")
        .agg(F.sum("n").alias("total"))
        .where(F.col("total") > 0)
        .orderBy(F.desc("total"), "diagnostico")
    )


def churn_diagnosis_share(diag: DataFrame) -> DataFrame:
    total = diag.agg(F.sum("total")).scalar()
    return diag.select("diagnostico", "total", (F.col("total").cast("double") / total.cast("double") * F.lit(100.0)).alias("pct"))


# --------------------------------------------------------------------------- clients

def client_lifetime(vw: DataFrame) -> DataFrame:
    """Per client: distinct invoices, billed, paid, last active cohort."""
    return vw.groupBy("id_cliente").agg(
        F.count_distinct("id_fatura").alias("historico_faturas"),
        F.sum("valor_fatura").alias("historico_faturado"),
        F.sum("valor_pagamento").alias("historico_pago"),
        F.max("data_referencia").alias("ultima_safra_ativa"),
    )


def inactive_clients(vw: DataFrame, month: str | None = LATEST) -> DataFrame:
    """Clients with no row in the month, with their lifetime history, by
    open balance (anti join, then the per-client aggregate)."""
    active = for_month(vw, month).select("id_cliente").distinct()
    hist = client_lifetime(vw).where(F.col("id_cliente").isNotNull())
    gone = hist.join(active, "id_cliente", "left_anti")
    saldo = F.col("historico_faturado") - F.col("historico_pago")
    return gone.select(
        "id_cliente",
        month_label("ultima_safra_ativa").alias("ultima_safra_ativa"),
        F.col("historico_faturas").alias("faturas_totais"),
        F.col("historico_faturado").alias("total_faturado"),
        F.col("historico_pago").alias("total_pago"),
        saldo.alias("saldo_devedor"),
    ).orderBy(F.desc("saldo_devedor"), "id_cliente")


def client_summary(vw: DataFrame, client_id: int | None = None) -> DataFrame:
    """Per client (or one client): distinct invoices, billed, paid, mean delay."""
    rows = vw if client_id is None else vw.where(F.col("id_cliente") == F.lit(client_id))
    return rows.groupBy("id_cliente").agg(
        F.count_distinct("id_fatura").alias("total_faturas"),
        F.sum("valor_fatura").alias("total_faturado"),
        F.sum("valor_pagamento").alias("total_pago"),
        F.avg("dias_atraso").alias("media_atraso"),
    )


def one_decimal(d: Column) -> Column:
    """Text of a non-negative double with one decimal, rounded by the exact
    binary value and ties to even. ``format_string`` rounds the shortest
    decimal form half up, so 10.25 would become 10.3 and 10.35 10.4."""
    whole = F.floor(d)
    # The part below one has at most 52 binary digits from 1 up, so this is exact.
    part = ((d - whole) * F.lit(float(1 << 52))).cast("bigint") * 10
    tenth, left, half = F.shiftright(part, 52), part.bitwiseAND(F.lit((1 << 52) - 1)), F.lit(1 << 51)
    up = F.when((left > half) | ((left == half) & (tenth % 2 == 1)), 1).otherwise(0)
    tenths = whole * 10 + tenth + up
    return F.concat(F.floor(tenths.cast("decimal(20,0)") / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"))


def amount_label(v: Column) -> Column:
    """``R$ 12.3k`` from 10,000 up, else ``R$ 1,234.56``."""
    d = v.cast("double")
    return F.when(d >= 10000, F.concat(F.lit("R$ "), one_decimal(d / 1e3), F.lit("k"))).otherwise(F.concat(F.lit("R$ "), F.format_number(d, 2)))


def client_summary_labels(summary: DataFrame) -> DataFrame:
    return summary.select(
        "id_cliente",
        amount_label(F.coalesce(F.col("total_faturado"), F.lit(0))).alias("lbl_faturado"),
        amount_label(F.coalesce(F.col("total_pago"), F.lit(0))).alias("lbl_pago"),
        F.format_string("%.0f dias", F.rint(F.coalesce(F.col("media_atraso"), F.lit(0.0)))).alias("lbl_media_atraso"),
    )


def _history_order() -> list[Column]:
    return [F.desc("data_referencia"), F.desc("id_fatura"), F.desc("valor_pagamento"), F.desc("status"), F.desc("valor_fatura")]


def client_history(vw: DataFrame, client_id: int | None = None) -> DataFrame:
    """Invoice history: one client's newest first, or all clients' rows in no
    order (sorting the whole view would be a range shuffle of it)."""
    rows = vw if client_id is None else vw.where(F.col("id_cliente") == F.lit(client_id))
    history = rows.select(
        "id_cliente", "data_referencia", "id_fatura",
        F.col("mes_ano").alias("mes"), F.col("valor_fatura").alias("fatura"),
        F.col("valor_pagamento").alias("pago"), F.col("status").alias("categoria"),
    )
    if client_id is None:
        return history
    return history.orderBy(F.desc("data_referencia"), F.desc("id_fatura"), F.desc("pago"), F.desc("categoria"))


def client_recent(vw: DataFrame, n: int = 6) -> DataFrame:
    """The ``n`` newest invoice rows of every client.

    ``row_number() <= n`` becomes a partial ``WindowGroupLimit`` before the
    shuffle, so a hot client sends at most ``n`` rows per map task.
    """
    w = Window.partitionBy("id_cliente").orderBy(*_history_order())
    ranked = vw.withColumn("posicao", F.row_number().over(w)).where(F.col("posicao") <= n)
    return ranked.select(
        "id_cliente", "posicao", F.col("mes_ano").alias("mes"), F.col("valor_fatura").alias("fatura"),
        F.col("valor_pagamento").alias("pago"), F.col("status").alias("categoria"),
    )


def client_lookup(vw: DataFrame, client_id: int) -> DataFrame:
    """All view columns of one client, newest cohort first."""
    return vw.where(F.col("id_cliente") == F.lit(client_id)).orderBy(*_history_order())


def top_risk_clients(vw: DataFrame, month: str | None = None, n: int = 20) -> DataFrame:
    """Clients with the largest open balance on late or unpaid invoices."""
    rows = for_month(vw, month).where(F.col("status").contains("Atraso") | F.col("status").contains("Inadimplente"))
    g = rows.groupBy("id_cliente").agg(
        F.count_distinct("id_fatura").alias("faturas_inadimplentes"),
        F.sum(F.col("valor_fatura") - F.col("valor_pagamento")).alias("saldo_devedor"),
        F.max("dias_atraso").alias("maior_atraso"),
        F.max(label_rank("status")).alias("_status_rank"),
    )
    g = g.select(
        "id_cliente", "faturas_inadimplentes", "saldo_devedor", "maior_atraso",
        label_from_rank(F.col("_status_rank")).alias("categoria_principal"),
    )
    return g.orderBy(F.desc_nulls_last("saldo_devedor"), "id_cliente").limit(n)


# --------------------------------------------------------------------------- drill-downs (top-k)

def _detail_order() -> list[Column]:
    return [F.desc("valor_fatura"), F.desc("id_fatura"), F.desc("id_cliente"), F.desc("valor_pago"),
            F.desc("dias_atraso"), F.desc("categoria"), F.desc("mes")]


def _detail(rows: DataFrame, with_minimum: bool = False) -> DataFrame:
    cols = [
        "id_cliente", "id_fatura", F.col("mes_ano").alias("mes"), "valor_fatura",
        F.col("valor_pagamento").alias("valor_pago"), "dias_atraso", F.col("status").alias("categoria"),
    ]
    if with_minimum:
        cols.insert(4, F.col("valor_pagamento_minimo").alias("valor_minimo"))
    return rows.select(*cols)


def _apply(rows: DataFrame, pred: Column | None) -> DataFrame:
    return rows if pred is None else rows.where(pred)


def invoice_detail_by_status(vw: DataFrame, status: str | None = None, month: str | None = None, n: int = 100) -> DataFrame:
    """Top ``n`` invoices by value, optionally of one status (global top-k:
    each task keeps its own top ``n``; no full sort)."""
    pred = None if status is None else F.col("status") == F.lit(status)
    return _detail(_apply(for_month(vw, month), pred)).orderBy(*_detail_order()).limit(n)


def invoice_detail_by_behaviour(vw: DataFrame, behaviour: str | None = None, month: str | None = None, n: int = 100) -> DataFrame:
    rows = _apply(for_month(vw, month), minimum_behaviour_filter(behaviour))
    return _detail(rows, with_minimum=True).orderBy(*_detail_order()).limit(n)


def invoice_detail_by_delay_band(vw: DataFrame, band: str | None = None, month: str | None = None, n: int = 100) -> DataFrame:
    """Top ``n`` by delay then value within one delay band. The band is one
    parenthesised predicate, so the month filter cannot leak through an OR."""
    rows = _apply(for_month(vw, month), delay_band_filter(band))
    order = [F.desc("dias_atraso"), *_detail_order()]
    return _detail(rows).orderBy(*order).limit(n)


# --------------------------------------------------------------------------- bands

def invoice_value_bands(vw: DataFrame, month: str | None = None) -> DataFrame:
    rows = for_month(vw, month)
    return rows.groupBy(value_band().alias("faixa_valor")).agg(F.count(F.lit(1)).alias("qtd")).orderBy("faixa_valor")


def minimum_payment_behaviour(vw: DataFrame, month: str | None = None) -> DataFrame:
    rows = for_month(vw, month)
    return (
        rows.groupBy(minimum_behaviour().alias("comportamento_minimo"))
        .agg(F.count(F.lit(1)).alias("qtd"))
        .orderBy("qtd", "comportamento_minimo")
    )


def delay_bands(vw: DataFrame, month: str | None = None) -> DataFrame:
    rows = for_month(vw, month)
    return (
        rows.groupBy(delay_band().alias("bucket_atraso"))
        .agg(F.count(F.lit(1)).alias("qtd"), (F.sum("valor_fatura").cast("double") / F.lit(1e6)).alias("volume_m"))
        .orderBy("bucket_atraso")
    )


# --------------------------------------------------------------------------- dimensions & quality

def month_dimension(vw: DataFrame) -> DataFrame:
    months = vw.select("data_referencia").distinct()
    return months.select(
        "data_referencia",
        month_label("data_referencia").alias("label_mes"),
        F.date_format("data_referencia", "yyyy-MM-dd").alias("data_sql"),
    ).orderBy("data_referencia")


def client_dimension(vw: DataFrame) -> DataFrame:
    return vw.select("id_cliente").distinct().orderBy("id_cliente")


def ids_across_cohorts(df: DataFrame, id_col: str, alias: str) -> DataFrame:
    """Distinct (id, ref) pairs minus distinct ids: how often an id appears
    in more than one cohort. One grouped pass: per id, distinct refs - 1."""
    # A NULL ref is still a distinct pair.
    per_id = df.groupBy(id_col).agg(
        (F.count_distinct("ref") + F.max(F.when(F.col("ref").isNull(), 1).otherwise(0))).alias("_r")
    )
    extra = F.when(F.col(id_col).isNull(), F.col("_r")).otherwise(F.col("_r") - 1)
    return per_id.agg(F.coalesce(F.sum(extra), F.lit(0)).cast("bigint").alias(alias))
