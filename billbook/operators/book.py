"""Feature book: conditional aggregates per (cohort, client).

Metric grammar (200 columns = 5 classes x 5 windows x 8 metrics)::

    qtd_transacoes_{class}_{win}                       COALESCE(SUM(1), 0)
    valor_fatura_{sum|avg|min|max}_{class}_{win}       SUM is COALESCE(.., 0)
    dias_atraso_{avg|min|max}_{class}_{win}

Plan (chosen for skew and width, see README):

1. pre-aggregate stage rows by (ref, client, class, emission date): partial
   aggregation map-side, so a hot client collapses before the shuffle;
2. per-client anchor ``max(data_emissao)`` as a window over those partial
   rows, whose count per client is bounded by classes x distinct dates, not
   by the client's row count;
3. look-back flags, then a long aggregate by (ref, client, class) that reuses
   the window's client partitioning (no shuffle);
4. pivot the (at most five) class rows of each (ref, client) into 200
   columns through a class -> metrics map, again without a shuffle.
"""

from __future__ import annotations

import datetime as _dt
import math
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from billbook.functions import flag_within, months_between, payment_status_total, truncated_months
from billbook.schemas import CLASSES, WINDOWS

CLASS_COL = "fbc_classificacao_pagamento"
VALUE_COL = "fvl_valor_fatura"
DAYS_COL = "fvl_numero_dias_atraso"
COUNT_COL = "fvl_qtd_transacoes"


@dataclass(frozen=True)
class MetricSpec:
    """One book column: ``agg`` of ``value_col`` over rows of class ``cls``
    inside window ``window``."""

    name: str
    value_col: str
    agg: str        # SUM | AVG | MIN | MAX
    cls: str
    window: str     # key of WINDOWS


# FIXED VALUES: the measures of the book, in column order.
MEASURES = (
    ("qtd_transacoes", COUNT_COL, "SUM"),
    ("valor_fatura_sum", VALUE_COL, "SUM"),
    ("valor_fatura_avg", VALUE_COL, "AVG"),
    ("valor_fatura_min", VALUE_COL, "MIN"),
    ("valor_fatura_max", VALUE_COL, "MAX"),
    ("dias_atraso_avg", DAYS_COL, "AVG"),
    ("dias_atraso_min", DAYS_COL, "MIN"),
    ("dias_atraso_max", DAYS_COL, "MAX"),
)


def metric_specs(classes=CLASSES, windows=WINDOWS) -> list[MetricSpec]:
    """The book's metric list, in column order."""
    return [MetricSpec(f"{stem}_{cls.lower()}_{win}", col, agg, cls, win)
            for cls, win, (stem, col, agg) in product(classes, windows, MEASURES)]


def _anchor_col(anchor) -> Column | None:
    if anchor is None:
        return None
    if isinstance(anchor, Column):
        return anchor
    if isinstance(anchor, (_dt.date, _dt.datetime)):
        anchor = anchor.strftime("%Y-%m-%d")
    return F.to_date(F.lit(str(anchor)))


def window_flags(stage: DataFrame, anchor=None) -> DataFrame:
    """Row-level look-back flags ``flg_u{k}m`` = months_between(anchor,
    emission) <= k. ``anchor=None`` uses each client's latest emission date.

    The per-client anchor is a partial aggregate joined back on the client
    (an equi-join AQE can split when one client is hot), not a window that
    would put a hot client's rows into one task.
    """
    a = _anchor_col(anchor)
    if a is None:
        anchors = stage.groupBy("id_cliente").agg(F.max("data_emissao").alias("_anchor"))
        anchors = anchors.withColumnRenamed("id_cliente", "_anchor_client")
        # Null-safe: rows without a client share one anchor, as a window
        # partition would give them (still an equi-join for the planner).
        rows = stage.join(anchors, stage["id_cliente"].eqNullSafe(anchors["_anchor_client"]), "left")
        a = F.col("_anchor")
    else:
        rows = stage
    m = months_between(a, F.col("data_emissao"))
    flags = [flag_within(m, k).alias(f"flg_{w}") for w, k in WINDOWS.items() if k is not None]
    return rows.select(*stage.columns, *flags)


def window_flags_truncated(df: DataFrame, run_date, date_col: str = "data_emissao") -> DataFrame:
    """Prototype flags: whole months (truncated) between a run date and the
    row's date, ``<= k``."""
    m = truncated_months(_anchor_col(run_date), F.col(date_col))
    flags = [flag_within(m, k).alias(f"flag_{w}") for w, k in WINDOWS.items() if k is not None]
    return df.select(*df.columns, *flags)


#: Stage rows a task of the book is dealt. A row is 26 shuffled bytes, but 2 to
#: 3 KB in a task (45 aggregates, twice, and their map), so tasks are dealt by
#: rows: Spark's own size of a partition would put gigabytes in one.
TASK_ROWS = 50_000


def book_tasks(spark: SparkSession, rows: int, task_rows: int = TASK_ROWS) -> int:
    """Into how many tasks a stage of about ``rows`` rows is dealt: one per
    ``task_rows`` rows, and one per core at least."""
    return max(spark.sparkContext.defaultParallelism, math.ceil(rows / task_rows))


def _rows(stage: DataFrame, tasks: int | None = None) -> DataFrame:
    """The stage dealt out by client, each row as the partial of one: all that
    follows (anchor, flags, classes, pivot) is grouped by client and more, so
    this is the book's only shuffle."""
    v, d = F.col(VALUE_COL), F.col(DAYS_COL)
    dealt = stage.repartition(tasks, "id_cliente") if tasks else stage.repartition("id_cliente")
    return dealt.select(
        "ref", "id_cliente", CLASS_COL, "data_emissao",
        F.col(COUNT_COL).cast("long").alias("n"),
        v.cast("decimal(25,2)").alias("v_sum"), F.when(v.isNotNull(), 1).otherwise(0).cast("long").alias("v_cnt"),
        v.alias("v_min"), v.alias("v_max"),
        d.cast("long").alias("d_sum"), F.when(d.isNotNull(), 1).otherwise(0).cast("long").alias("d_cnt"),
        d.alias("d_min"), d.alias("d_max"),
    )


def _partials(stage: DataFrame) -> DataFrame:
    """For heavy clients: one row per (ref, client, class, emission date),
    combined before the shuffle. Their number is bounded by classes x dates,
    whatever rows a client has."""
    v, d = F.col(VALUE_COL), F.col(DAYS_COL)
    return stage.groupBy("ref", "id_cliente", CLASS_COL, "data_emissao").agg(
        F.sum(COUNT_COL).alias("n"),
        F.sum(v).alias("v_sum"),
        F.count(v).alias("v_cnt"),
        F.min(v).alias("v_min"),
        F.max(v).alias("v_max"),
        F.sum(d).alias("d_sum"),
        F.count(d).alias("d_cnt"),
        F.min(d).alias("d_min"),
        F.max(d).alias("d_max"),
    )


#: A client with more rows than this is combined before it is dealt out.
HEAVY_CLIENT_ROWS, MOST_HEAVY = 1_000_000, 1000


def heavy_clients(rows: DataFrame, looked: float = 1.0, heavy_rows: int = HEAVY_CLIENT_ROWS) -> list[int | None]:
    """The clients (or none: NULL) with over ``heavy_rows`` rows, from a sample
    of ``looked`` of them; the MOST_HEAVY heaviest at most (the next has under a
    thousandth of all rows). Which clients are named changes the plan, not the
    book."""
    counts = rows.groupBy("id_cliente").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > heavy_rows * looked)
    return [r["id_cliente"] for r in counts.orderBy(F.desc("n"), "id_cliente").limit(MOST_HEAVY).collect()]


def book_long(stage: DataFrame, anchor=None, combine: bool = False, tasks: int | None = None) -> DataFrame:
    """Book in long form: one row per (ref, client, class) with 8 metrics x 5
    windows (``{metric}__{window}`` columns). ``combine``: for heavy clients;
    ``tasks``: how many the others are dealt to."""
    p = _partials(stage) if combine else _rows(stage, tasks)
    a = _anchor_col(anchor)
    if a is None:
        # One window aggregate, referenced by all four flags.
        p = p.withColumn("_anchor", F.max("data_emissao").over(Window.partitionBy("id_cliente")))
        a = F.col("_anchor")
    m = months_between(a, F.col("data_emissao"))
    flags = {w: (F.lit(True) if k is None else (m <= F.lit(k))) for w, k in WINDOWS.items()}
    p = p.select("*", *[F.coalesce(c, F.lit(False)).alias(f"_in_{w}") for w, c in flags.items()])

    # Wide expression lists are written as SQL expression strings: one
    # JVM-side parse per column instead of a Py4J round trip per node.
    aggs = []
    for w in WINDOWS:
        def only(c, w=w):
            return f"CASE WHEN _in_{w} THEN {c} END"

        aggs += [
            f"sum({only('n')}) AS n__{w}",
            f"CAST(sum({only('v_sum')}) AS DECIMAL(25,2)) AS v_sum__{w}",
            f"sum({only('v_cnt')}) AS v_cnt__{w}",
            f"min({only('v_min')}) AS v_min__{w}",
            f"max({only('v_max')}) AS v_max__{w}",
            f"sum({only('d_sum')}) AS d_sum__{w}",
            f"sum({only('d_cnt')}) AS d_cnt__{w}",
            f"min({only('d_min')}) AS d_min__{w}",
            f"max({only('d_max')}) AS d_max__{w}",
        ]
    g = p.groupBy("ref", "id_cliente", CLASS_COL).agg(*[F.expr(a) for a in aggs])
    out = ["ref", "id_cliente", CLASS_COL]
    for w in WINDOWS:
        # AVG(decimal) = SUM / COUNT as decimal(20,0), then decimal(19,6):
        # the same evaluation Spark's Average uses, so results are identical.
        out += [
            f"n__{w} AS qtd__{w}",
            f"v_sum__{w} AS vsum__{w}",
            f"CAST(v_sum__{w} / CAST(v_cnt__{w} AS DECIMAL(20,0)) AS DECIMAL(19,6)) AS vavg__{w}",
            f"v_min__{w} AS vmin__{w}",
            f"v_max__{w} AS vmax__{w}",
            f"CAST(d_sum__{w} AS DOUBLE) / CAST(d_cnt__{w} AS DOUBLE) AS davg__{w}",
            f"CAST(d_min__{w} AS INT) AS dmin__{w}",
            f"CAST(d_max__{w} AS INT) AS dmax__{w}",
        ]
    return g.selectExpr(*out)


_LONG_NAME = {
    (COUNT_COL, "SUM"): "qtd",
    (VALUE_COL, "SUM"): "vsum",
    (VALUE_COL, "AVG"): "vavg",
    (VALUE_COL, "MIN"): "vmin",
    (VALUE_COL, "MAX"): "vmax",
    (DAYS_COL, "AVG"): "davg",
    (DAYS_COL, "MIN"): "dmin",
    (DAYS_COL, "MAX"): "dmax",
}


def book_by_cohort(stage: DataFrame, dt_proc: str, anchor=None, specs: list[MetricSpec] | None = None,
                   heavy: Sequence[int | None] = (), tasks: int | None = None) -> DataFrame:
    """The 200-metric book, one row per (ref, client), keys first.

    A client whose rows all have a NULL class still gets a row (sums 0,
    others NULL). Only SUM metrics are COALESCEd to 0. The clients in ``heavy``
    (``heavy_clients``) are read on their own and combined before they are
    dealt out, so that none of them is one task's work. The others are dealt to
    ``tasks`` tasks (``book_tasks``; by default as Spark sizes partitions).
    """
    if heavy:
        known = [c for c in heavy if c is not None]
        hot = F.coalesce(F.col("id_cliente").isin(known), F.lit(None in heavy))
        parts = [book_by_class(stage.where(rows), dt_proc, anchor, specs, combine, tasks) for rows, combine in ((~hot, False), (hot, True))]
        return parts[0].unionAll(parts[1])
    return book_by_class(stage, dt_proc, anchor, specs, False, tasks)


def book_by_class(stage: DataFrame, dt_proc: str, anchor, specs: list[MetricSpec] | None, combine: bool,
                  tasks: int | None = None) -> DataFrame:
    """The long form pivoted to one row per (ref, client)."""
    specs = specs or metric_specs()
    long = book_long(stage, anchor, combine, tasks)
    # Pivot: each (ref, client) has at most one long row per class (five),
    # so its rows are gathered into a class -> metrics map (a collect bounded
    # by the number of classes; NULL-class rows add nothing) and the 200
    # columns are map lookups. Same result as 200 max(CASE ...) aggregates,
    # with far less generated code; no shuffle (client partitioning reused).
    metrics = [c for c in long.columns if "__" in c]
    value = "named_struct(" + ", ".join(f"'{m}', {m}" for m in metrics) + ")"
    entry = f"CASE WHEN {CLASS_COL} IS NOT NULL THEN named_struct('key', {CLASS_COL}, 'value', {value}) END"
    by_class = long.groupBy("ref", "id_cliente").agg(F.expr(f"map_from_entries(collect_list({entry})) AS _by_class"))
    cols = []
    for s in specs:
        picked = f"_by_class['{s.cls}'].{_LONG_NAME[(s.value_col, s.agg)]}__{s.window}"
        if s.agg == "SUM":
            picked = f"coalesce({picked}, CAST(0 AS {src_type(s)}))"
        cols.append(f"{picked} AS {s.name}")
    return by_class.selectExpr("ref", f"'{dt_proc}' AS dt_proc", "id_cliente", *cols)


def src_type(s: MetricSpec) -> str:
    return "bigint" if s.value_col == COUNT_COL else "decimal(25,2)"


# ----------------------------------------------------------------------------
# Prototype client book (30 metrics, grouped by client only)

# FIXED VALUES: class order of the prototype book's columns.
CLIENT_BOOK_CLASSES = ["PAGO_EM_DIA", "PAGO_EM_ATRASO", "PAGAMENTO_ANTECIPADO", "NAO_PAGO", "PAGAMENTO_PARCIAL"]


def client_book_rows(joined: DataFrame, run_date) -> DataFrame:
    """Prototype row prep: total status (no NULL class) and truncated
    month flags against the run date."""
    rows = joined.withColumn("status_pagamento", payment_status_total())
    return window_flags_truncated(rows, run_date)


def book_by_client(joined: DataFrame, run_date, ts_proc: str) -> DataFrame:
    """Prototype client book: per client, counts per class overall and per
    window and invoice sums per class; NULL (not 0) when nothing matches.

    A single grouped aggregate with 30 buffers: partial aggregation map-side,
    so a hot client is combined before the shuffle.
    """
    run = _anchor_col(run_date)
    rows = client_book_rows(joined, run)
    cols = [f"sum(CASE WHEN status_pagamento = '{c}' THEN 1 END) AS qtd_st_{c.lower()}" for c in CLIENT_BOOK_CLASSES]
    for w, k in WINDOWS.items():
        if k is None:
            continue
        cols += [f"sum(CASE WHEN flag_{w} = 1 AND status_pagamento = '{c}' THEN 1 END) AS qtd_st_{c.lower()}_{w}"
                 for c in CLIENT_BOOK_CLASSES]
    cols += [f"sum(CASE WHEN status_pagamento = '{c}' THEN valor_fatura END) AS sum_st_{c.lower()}"
             for c in CLIENT_BOOK_CLASSES]
    g = rows.groupBy("id_cliente").agg(*[F.expr(c) for c in cols])
    ref = F.date_format(run, "yyyyMMdd")
    names = [c.rsplit(" AS ", 1)[1] for c in cols]
    return g.select("id_cliente", ref.alias("ref"), F.lit(ts_proc).alias("ts_proc"), *names)


# ----------------------------------------------------------------------------
# Presentation helpers over a stored book

BOOK_KEYS = ["ref", "dt_proc", "id_cliente"]


def book_keys_first(book: DataFrame, keys=BOOK_KEYS) -> DataFrame:
    return book.select(*keys, *[c for c in book.columns if c not in keys])


def book_filled(book: DataFrame) -> DataFrame:
    """Numeric NULLs -> 0 (strings and dates untouched)."""
    return book.na.fill(0)


def book_sample(book: DataFrame, n: int = 100) -> DataFrame:
    """First ``n`` rows in key order (a deterministic sample)."""
    return book_keys_first(book).orderBy("ref", "id_cliente", "dt_proc").limit(n)
