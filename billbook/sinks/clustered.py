"""Clustered copies of tables: rows bucketed by a business key.

A copy is laid out once, by one shuffle, and read many times without any:
deduplication per key and joins on the key find both sides' rows already dealt
out by it (same keys, same number of buckets). The copy is a table of its own
beside the source, published by a commit record like any load; making it again
replaces it. A key with very many rows is one bucket's, so the layout suits
keys with few rows each (an invoice and its versions); views over hot keys use
``operators.joins.split_left_join``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from billbook.sinks.commits import Run, commit, new_run, run_path, schema_history

#: Buckets of a table: about its bytes over 128 MB, the same for tables that meet.
BUCKETS = 64


def _columns(df_schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df_schema.fields)


def write_clustered(df: DataFrame, table: str, keys: Sequence[str], dt_proc: str, buckets: int = BUCKETS) -> None:
    """Write ``df`` as the clustered table ``table`` and publish it in place of
    the earlier copy. One file per bucket, sorted by ``keys``."""
    spark, run = df.sparkSession, new_run(dt_proc)
    name = f"billbook_{uuid.uuid4().hex}"
    seen = Observation(name)
    out = df.repartition(buckets, *keys).observe(seen, F.count(F.lit(1)).alias("n"))
    writer = out.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", run_path(table, run))
    writer.saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the name only: its files are the run's
    rows = int(seen.get.get("n") or 0)
    commit(spark, f"clustered-{table.rstrip('/').rsplit('/', 1)[-1]}", dt_proc, [Run(table.rstrip("/"), run, rows, df.schema.json())])


def read_clustered(spark: SparkSession, table: str, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """The published copy, known to Spark as bucketed by ``keys``."""
    history = schema_history(spark, table)
    if len(history) != 1:
        raise FileNotFoundError(f"{table}: no clustered copy has been published")
    run, schema = history[0]
    name, by = f"billbook_{uuid.uuid5(uuid.NAMESPACE_URL, run_path(table, run)).hex}", ", ".join(keys)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({_columns(schema)}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) "
              f"INTO {buckets} BUCKETS LOCATION '{run_path(table, run)}'")
    return spark.table(name)
