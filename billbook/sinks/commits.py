"""Tables whose loads are published by a commit record.

A load writes its files once, into a folder of its own under the table
(``<table>/_runs/run=<id>/ref=.../part-*``), where readers don't look. It is
published by one small file in ``<layer>/_commits`` that names the run of every
table it fills, so a stage and the book made from it appear together or not at
all, and nothing is moved: the cost doesn't grow with the number of files, and
object stores copy nothing.

A record has a key (such as ``book-<dt_proc>``) and a version. A load that runs
again writes the next version under its key, which replaces the runs of the
earlier one for all readers. Files of broken, checked-out or replaced loads are
never read; ``vacuum`` deletes them.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from billbook.sources.paths import exists, list_entries, list_files, make_file, remove, rename

RUNS, COMMITS = "_runs", "_commits"
RECORD = "key string, version bigint, dt_proc string, tables map<string, struct<run:string, rows:bigint, columns:string>>"


@dataclass(frozen=True)
class Run:
    """A written, not yet published load of one table."""
    table: str
    run: str
    rows: int
    #: The written columns and types, as JSON: the record keeps them, so that
    #: readers need no file's footer to know what a load holds.
    columns: str


def _split(table: str) -> tuple[str, str]:
    layer, _, name = table.rstrip("/").rpartition("/")
    return layer, name


def new_run(dt_proc: str) -> str:
    """A name that no other load has."""
    return f"{dt_proc}-{uuid.uuid4().hex[:12]}"


def run_path(table: str, run: str) -> str:
    return f"{table.rstrip('/')}/{RUNS}/run={run}"


def write_run(df: DataFrame, table: str, run: str, partition_cols: Sequence[str] = ("ref",)) -> Run:
    """Write ``df`` as the run ``run`` of ``table`` and count its rows on the
    way. The count is observed behind the rebalance, in the stage that writes,
    where a task that is run again counts once."""
    seen = Observation(f"rows_{uuid.uuid4().hex[:12]}")
    out = df.hint("rebalance", *partition_cols).observe(seen, F.count(F.lit(1)).alias("n"))
    out.write.mode("errorifexists").partitionBy(*partition_cols).parquet(run_path(table, run))
    return Run(table.rstrip("/"), run, int(seen.get.get("n") or 0), df.schema.json())


def read_runs(spark: SparkSession, table: str, runs: Sequence[str], schema: StructType | None = None) -> DataFrame:
    """The rows of the given runs of ``table``."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.option("basePath", f"{table.rstrip('/')}/{RUNS}").parquet(*[run_path(table, r) for r in runs])
    return df.select(*schema.fieldNames()) if schema is not None else df.drop("run")


def records(spark: SparkSession, layer: str) -> list[dict]:
    """The newest record of every key, oldest ``dt_proc`` first."""
    folder = f"{layer.rstrip('/')}/{COMMITS}"
    if not exists(spark, folder):
        return []
    newest: dict[str, dict] = {}
    # One line per load of the layer: metadata, not data.
    for r in spark.read.schema(RECORD).json(folder).toLocalIterator():
        if r["key"] not in newest or r["version"] > newest[r["key"]]["version"]:
            newest[r["key"]] = r.asDict(recursive=True)
    return sorted(newest.values(), key=lambda r: (r["dt_proc"], r["key"]))


def commit(spark: SparkSession, key: str, dt_proc: str, runs: Sequence[Run]) -> int:
    """Publish ``runs`` (tables of one layer) together; returns the version."""
    layer = _split(runs[0].table)[0]
    if any(_split(r.table)[0] != layer for r in runs):
        raise ValueError("a commit publishes tables of one layer")
    folder = f"{layer}/{COMMITS}"
    taken = [int(p.rsplit(".", 2)[1]) for p, _ in list_files(spark, folder, ".json") if p.rsplit("/", 1)[-1].startswith(f"{key}.")]
    version = max(taken, default=0) + 1
    record = {"key": key, "version": version, "dt_proc": dt_proc,
              "tables": {_split(r.table)[1]: {"run": r.run, "rows": r.rows, "columns": r.columns} for r in runs}}
    # Complete before it has a name that readers know.
    draft = f"{folder}/.{key}-{uuid.uuid4().hex[:12]}"
    make_file(spark, draft, json.dumps(record) + "\n")
    rename(spark, draft, f"{folder}/{key}.{version:06d}.json")
    return version


def committed_runs(spark: SparkSession, table: str) -> list[str]:
    layer, name = _split(table)
    return [r["tables"][name]["run"] for r in records(spark, layer) if name in r["tables"]]


def is_committed_table(spark: SparkSession, table: str) -> bool:
    return exists(spark, f"{table.rstrip('/')}/{RUNS}")


def read_committed(spark: SparkSession, table: str, schema: StructType | None = None) -> DataFrame:
    """The published rows of ``table``; with a schema, no rows if no load has
    been published yet."""
    runs = committed_runs(spark, table)
    if not runs:
        if schema is None:
            raise FileNotFoundError(f"{table}: no load has been published")
        return spark.createDataFrame([], schema)
    return read_runs(spark, table, runs, schema)


def schema_history(spark: SparkSession, table: str) -> list[tuple[str, StructType]]:
    """(run, its columns) of the published loads of ``table``."""
    layer, name = _split(table)
    found = [r["tables"][name] for r in records(spark, layer) if name in r["tables"]]
    return [(t["run"], StructType.fromJson(json.loads(t["columns"]))) for t in found]


def published_rows(spark: SparkSession, layer: str) -> Mapping[str, int]:
    """Rows of each table of a layer, from the records alone."""
    out: dict[str, int] = {}
    for r in records(spark, layer):
        for name, t in r["tables"].items():
            out[name] = out.get(name, 0) + t["rows"]
    return out


def drop_run(spark: SparkSession, table: str, run: str) -> None:
    """Delete the files of a run that will not be published."""
    remove(spark, run_path(table, run))


def vacuum(spark: SparkSession, table: str, keep_hours: float = 24.0) -> list[str]:
    """Delete runs that no newest record names and that are older than
    ``keep_hours`` (running loads and readers of a replaced run keep theirs)."""
    live, limit = set(committed_runs(spark, table)), (time.time() - keep_hours * 3600) * 1000
    gone = []
    for path, changed in list_entries(spark, f"{table.rstrip('/')}/{RUNS}"):
        run = path.rsplit("run=", 1)[-1].rstrip("/")
        if run not in live and changed < limit:
            remove(spark, path)
            gone.append(run)
    return sorted(gone)
