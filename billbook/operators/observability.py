"""Integrity checks, lineage and control rows.

Checks are expressed as *one-row DataFrames*. The full report is one
grouped pass over the keys: total rows, every NULL count and the number of
duplicate key groups fall out of the same aggregation, so nothing has to be
cached between checks and write. ``check_integrity`` is the fail-fast wrapper: it collects that single
row, appends it to the quality table and raises when a check failed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from billbook import schemas as S


@dataclass(frozen=True)
class IntegritySpec:
    """Keys that must be unique, columns that must be non-NULL, and an
    optional expected row count with a relative tolerance."""

    keys: Sequence[str]
    not_null: Sequence[str] = field(default_factory=tuple)
    expected: int | Column | None = None
    tolerance: float = 0.0


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def duplicate_key_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: the number of key groups with more than one row.

    The grouped count is partially aggregated map-side, so a hot key costs
    one partial count per task."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return g.agg(F.count(F.lit(1)).alias("chaves_duplicadas"))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per required column with its NULL count (single scan)."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(columns)])
    pairs = F.array(*[F.struct(F.lit(c).alias("coluna"), F.col(f"_{i}").alias("nulos")) for i, c in enumerate(columns)])
    return agg.select(F.inline(pairs))


def reconcile(df: DataFrame, expected, tolerance: float = 0.0) -> DataFrame:
    """One row: expected, obtained, difference and whether it is within
    ``expected * tolerance``."""
    total = df.agg(F.count(F.lit(1)).alias("obtido"))
    exp = _lit(expected).cast("bigint")
    diff = F.abs(F.col("obtido") - exp)
    return total.select(
        exp.alias("esperado"), "obtido", diff.alias("diferenca"),
        (diff.cast("double") <= exp.cast("double") * F.lit(float(tolerance))).alias("dentro_tolerancia"),
    )


def integrity_report(df: DataFrame, tabela: str, dt_proc: str, spec: IntegritySpec) -> DataFrame:
    """The quality row (``schemas.QUALITY``) for ``df``, lazily."""
    nn = list(spec.not_null)
    # One pass: group by the keys (partial aggregation map-side), then sum.
    # Total, NULL counts and duplicate groups all come from this one shuffle.
    per_key = df.groupBy(*spec.keys).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(nn)],
    )
    stats = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_registros"),
        F.count_if(F.col("_n") > 1).alias("chaves_duplicadas"),
        *[F.coalesce(F.sum(f"_null_{i}"), F.lit(0)).alias(f"_null_{i}") for i in range(len(nn))],
    )

    msgs = [
        F.when(
            F.col("chaves_duplicadas") > 0,
            F.concat(F.col("chaves_duplicadas").cast("string"),
                     F.lit(S.MSG_DUPLICATES.replace("{n}", "").replace("{keys}", repr(list(spec.keys))))),
        )
    ]
    for i, c in enumerate(nn):
        n = F.col(f"_null_{i}")
        msgs.append(F.when(n > 0, F.concat(n.cast("string"), F.lit(S.MSG_NULLS.replace("{n}", "").replace("{col}", c)))))
    if spec.expected is not None:
        exp = _lit(spec.expected).cast("bigint")
        diff = F.abs(F.col("total_registros") - exp)
        head, rest = S.MSG_RECONCILE.split("{expected}")
        mid, tail = rest.split("{total}")
        mid2, end = tail.split("{diff}")
        msgs.append(
            F.when(
                diff.cast("double") > exp.cast("double") * F.lit(float(spec.tolerance)),
                F.concat(F.lit(head), exp.cast("string"), F.lit(mid), F.col("total_registros").cast("string"),
                         F.lit(mid2), diff.cast("string"), F.lit(end)),
            )
        )
    falhas = F.concat_ws(S.MSG_SEPARATOR, *msgs)
    return stats.select(
        F.lit(tabela).alias("tabela"),
        F.lit(dt_proc).alias("dt_proc"),
        F.when(falhas == "", F.lit(S.CHECK_OK)).otherwise(F.lit(S.CHECK_FAILED)).alias("status"),
        falhas.alias("falhas"),
        F.col("total_registros").cast("bigint").alias("total_registros"),
        F.col("chaves_duplicadas").cast("bigint").alias("chaves_duplicadas"),
    )


class IntegrityError(RuntimeError):
    pass


def check_integrity(
    df: DataFrame,
    tabela: str,
    dt_proc: str,
    spec: IntegritySpec,
    quality_path: str | None = None,
) -> dict:
    """Run the checks, append the quality row (if a path is given) and raise
    ``IntegrityError`` when any check failed. Only one row reaches the
    driver."""
    report = integrity_report(df, tabela, dt_proc, spec)
    row = report.collect()[0].asDict()
    if quality_path:
        df.sparkSession.createDataFrame([row], S.QUALITY).write.mode("append").parquet(quality_path)
    if row["status"] != S.CHECK_OK:
        raise IntegrityError(f"integrity checks failed for {tabela!r}: {row['falhas']}")
    return row


def lineage_row(
    spark: SparkSession,
    tabela: str,
    dt_proc: str,
    qtd_registros: int | Column,
    camada_origem: str,
    arquivo_origem: str,
    executed_at: str | None = None,
) -> DataFrame:
    """One lineage row (``schemas.LINEAGE``). ``qtd_registros`` may be a
    scalar-subquery Column so the count is taken inside the same plan."""
    when = F.current_timestamp().cast("string") if executed_at is None else F.lit(executed_at)
    return spark.range(1).select(
        F.lit(tabela).alias("tabela"),
        F.lit(dt_proc).alias("dt_proc"),
        _lit(qtd_registros).cast("bigint").alias("qtd_registros"),
        F.lit(camada_origem).alias("camada_origem"),
        F.lit(arquivo_origem).alias("arquivo_origem"),
        when.alias("executado_em"),
    )


def record_lineage(path: str, row: DataFrame) -> None:
    row.write.mode("append").parquet(path)


def control_row(df: DataFrame, assunto: str, ts_proc: str) -> DataFrame:
    """Control row of a load: subject, cohort and file stamp of the load
    (smallest, so it is deterministic), run stamp and row count."""
    aggs = [F.min("ref").alias("ref")]
    if "ts_file_generation" in df.columns:
        aggs.append(F.min("ts_file_generation").alias("ts_file_generation"))
    aggs.append(F.count(F.lit(1)).alias("qtd_registros"))
    g = df.agg(*aggs)
    cols = [F.lit(assunto).alias("assunto"), "ref"]
    if "ts_file_generation" in df.columns:
        cols.append("ts_file_generation")
    return g.select(*cols, F.lit(ts_proc).alias("ts_proc"), "qtd_registros")


def book_control_row(spark: SparkSession, assunto: str, ref: str, ts_proc: str, qtd_registros: int | Column) -> DataFrame:
    """Control row of a book: subject, run date, run stamp and its rows (the
    count that its write observed, or a scalar subquery)."""
    return spark.range(1).select(
        F.lit(assunto).alias("assunto"), F.lit(ref).alias("ref"), F.lit(ts_proc).alias("ts_proc"),
        _lit(qtd_registros).cast("bigint").alias("qtd_registros"))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per named table with its row count (a union of global
    counts, planned as one job)."""
    parts = [df.agg(F.count(F.lit(1)).alias("qtd_registros")).select(F.lit(name).alias("tabela"), "qtd_registros")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
