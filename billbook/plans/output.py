"""Output boundary for registered questions.

Inside plans money stays decimal and calendar days stay DATE. At the
boundary money becomes double and days become midnight TIMESTAMP_NTZ (the
convention of the source tables, which store days as timestamps), so every
consumer sees the same representation from Spark and from SQL engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import DateType, DecimalType


def decimals_to_double(df: DataFrame) -> DataFrame:
    fields = df.schema.fields
    if not any(isinstance(f.dataType, DecimalType) for f in fields):
        return df
    cols = [f"CAST(`{f.name}` AS DOUBLE) AS `{f.name}`" if isinstance(f.dataType, DecimalType) else f"`{f.name}`"
            for f in fields]
    return df.selectExpr(*cols)


def to_output(df: DataFrame) -> DataFrame:
    fields = df.schema.fields
    if not any(isinstance(f.dataType, (DecimalType, DateType)) for f in fields):
        return df
    cols = []
    for f in fields:
        if isinstance(f.dataType, DecimalType):
            cols.append(f"CAST(`{f.name}` AS DOUBLE) AS `{f.name}`")
        elif isinstance(f.dataType, DateType):
            cols.append(f"CAST(`{f.name}` AS TIMESTAMP_NTZ) AS `{f.name}`")
        else:
            cols.append(f"`{f.name}`")
    return df.selectExpr(*cols)
