"""Delimited export (``;`` separator, header, UTF-8)."""

from __future__ import annotations

from pyspark.sql import DataFrame

BYTE_ORDER_MARK = "\ufeff"


def export_csv(df: DataFrame, path: str, sep: str = ";", mark: bool = True) -> None:
    """Write ``df`` as header CSV with ``sep``. With ``mark`` every file starts
    with the UTF-8 byte-order mark that spreadsheets look for: it is written as
    the first character of the header line."""
    first, *rest = df.columns
    out = df.toDF(BYTE_ORDER_MARK + first, *rest) if mark else df
    out.write.mode("overwrite").option("sep", sep).option("header", True).option("encoding", "UTF-8").csv(path)
