"""Parquet sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def append_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str] = ("ref",), cluster: bool = True) -> None:
    """Append ``df`` as Parquet partitioned by ``partition_cols``.

    With ``cluster`` the rows are rebalanced on the partition columns first
    (``REBALANCE`` hint): each task writes few partition folders, so the file
    count stays bounded, and AQE splits a cohort that holds a large share of
    the rows across several writers instead of one (a plain
    ``repartition(col)`` would send a hot cohort to a single task).
    """
    out = df.hint("rebalance", *partition_cols) if cluster and partition_cols else df
    out.write.mode("append").partitionBy(*partition_cols).parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    """Unpartitioned append (audit rows)."""
    df.write.mode("append").parquet(path)
