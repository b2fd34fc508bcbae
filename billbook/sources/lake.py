"""Lake Parquet sources."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    NullType,
    ShortType,
    StructField,
    StructType,
    TimestampNTZType,
)

from billbook.schemas import LINEAGE, QUALITY
from billbook.sinks.commits import RUNS, is_committed_table, read_committed, records, run_path, schema_history


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A ``ref``-partitioned table: plain Parquet folders, or one whose loads
    are published by commit records (``sinks.commits``). With a schema the partition column keeps
    its declared (string) type; partition-type inference is off in the
    library's session defaults either way."""
    if is_committed_table(spark, path):
        return read_committed(spark, path, schema)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


#: Types a column may grow through from load to load, narrow to wide.
WIDER = [(ByteType, ShortType, IntegerType, LongType), (FloatType, DoubleType)]


def wider(a: DataType, b: DataType) -> DataType:
    """The type that holds the values of both; an error if there is none."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    for chain in WIDER:
        if type(a) in chain and type(b) in chain:
            return a if chain.index(type(a)) > chain.index(type(b)) else b
    if isinstance(a, DecimalType) and isinstance(b, DecimalType):
        scale = max(a.scale, b.scale)
        return DecimalType(min(38, max(a.precision - a.scale, b.precision - b.scale) + scale), scale)
    if isinstance(a, DateType) and isinstance(b, TimestampNTZType):
        return b
    if isinstance(a, TimestampNTZType) and isinstance(b, DateType):
        return a
    raise ValueError(f"no type holds both {a.simpleString()} and {b.simpleString()}")


def merged_schema(versions: Sequence[StructType]) -> StructType:
    """All columns of all versions by name, in order of their first load, each
    as wide as its widest version."""
    fields: dict[str, DataType] = {}
    for version in versions:
        for f in version.fields:
            fields[f.name] = wider(fields[f.name], f.dataType) if f.name in fields else f.dataType
    return StructType([StructField(name, kind) for name, kind in fields.items()])


def read_merged(spark: SparkSession, table: str) -> DataFrame:
    """All loads of a committed table, whatever columns each was written with,
    and the file of each row (``filename``: its folder and name below the
    table's runs). The union of the columns comes from the schemas that the
    commit records keep, so no file is opened before the scan; loads without a
    column read it as NULL, narrower ones are widened by the scan."""
    history = schema_history(spark, table)
    if not history:
        raise FileNotFoundError(f"{table}: no load has been published")
    schema = merged_schema([s for _, s in history])
    df = spark.read.schema(schema).option("basePath", f"{table.rstrip('/')}/{RUNS}").parquet(*[run_path(table, r) for r, _ in history])
    name = F.regexp_extract("_metadata.file_path", f"/{RUNS}/(.*)$", 1)
    return df.select(*schema.fieldNames(), name.alias("filename"))


def latest_runs(audit: DataFrame, n: int | None = None) -> DataFrame:
    """Newest audit rows first (lineage or quality table); all of them unless
    ``n`` asks for the newest ``n``."""
    rows = audit.orderBy(F.desc("dt_proc"), "tabela")
    return rows if n is None else rows.limit(n)


def audit_history(spark: SparkSession, lake_root: str, n: int | None = None, layers: Sequence[str] = ("trusted", "refined")) -> DataFrame:
    """What happened to every table, newest run first: the quality rows, the
    lineage rows and what the layers' commit records publish, in one relation.
    ``posicao`` numbers the runs of each table and kind of record; ``n`` keeps
    the newest ``n`` of each (a partial limit per table before the shuffle)."""
    root = lake_root.rstrip("/")
    quality = spark.read.schema(QUALITY).parquet(f"{root}/qualidade").select(
        F.lit("qualidade").alias("registro"), "tabela", "dt_proc", "status", F.col("total_registros").alias("qtd_registros"))
    lineage = spark.read.schema(LINEAGE).parquet(f"{root}/controle").select(
        F.lit("linhagem").alias("registro"), "tabela", "dt_proc", F.lit(None).cast("string").alias("status"), "qtd_registros")
    parts = [quality, lineage]
    for layer in layers:
        published = [(layer, t, r["dt_proc"], "PUBLICADO", v["rows"]) for r in records(spark, f"{root}/{layer}") for t, v in r["tables"].items()]
        parts.append(spark.createDataFrame(published, "registro string, tabela string, dt_proc string, status string, qtd_registros long"))
    newest = Window.partitionBy("registro", "tabela").orderBy(F.desc("dt_proc"), F.desc("status"), F.desc("qtd_registros"))
    rows = reduce(DataFrame.unionByName, parts).withColumn("posicao", F.row_number().over(newest))
    return rows if n is None else rows.where(F.col("posicao") <= n)
