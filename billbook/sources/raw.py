"""Raw text sources: header CSV with explicit string schemas."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from billbook.sources.paths import exists, first_line, list_files

FILE = StructType([StructField("file_path", StringType()), StructField("file_name", StringType())])


def headers(spark: SparkSession, paths: Sequence[str], sep: str) -> dict[tuple[str, ...], list[str]]:
    """The files under ``paths`` by their header line. One line of each file is
    read, several files at a time; an empty file has none and is left out."""
    def header(file: str) -> tuple[str, ...]:
        if file.rsplit(".", 1)[-1].lower() in ("gz", "bz2", "zst", "lz4", "snappy", "deflate"):
            return tuple(spark.read.option("header", True).option("sep", sep).csv(file).columns)
        line = first_line(spark, file)
        return tuple(next(csv.reader([line], delimiter=sep))) if line else ()

    files = sorted(spark.read.text(list(paths)).inputFiles())
    found: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(16) as pool:
        for file, names in zip(files, pool.map(header, files)):
            found.setdefault(names, []).append(file)
    found.pop((), None)
    return found


def read_csv(
    spark: SparkSession, path: str | Sequence[str], schema: StructType, sep: str = ",", with_metadata: bool = False
) -> DataFrame:
    """Header CSV files, folders or patterns as one relation, with the columns
    of ``schema`` taken by header name. Every file has its own header: columns
    may stand in any order, further ones are left out and a missing one is an
    error. Files with one header are one scan. ``with_metadata`` adds each
    row's ``_metadata`` (``file_path``, ``file_name``)."""
    frames = []
    for names, files in sorted(headers(spark, [path] if isinstance(path, str) else list(path), sep).items()):
        missing = [c for c in schema.fieldNames() if c not in names]
        if missing:
            raise ValueError(f"{files[0]}: missing columns {missing}")
        # By place in this header; a name that stands twice is its first column.
        place = [names.index(c) for c in schema.fieldNames()]
        raw = StructType([StructField(f"_c{i}", StringType()) for i in range(len(names))])
        text = spark.read.option("header", True).option("sep", sep).schema(raw).csv(files)
        columns = [F.col(f"_c{i}").cast(f.dataType).alias(f.name) for i, f in zip(place, schema.fields)]
        if with_metadata:
            columns.append(F.struct("_metadata.file_path", "_metadata.file_name").alias("_metadata"))
        frames.append(text.select(*columns))
    if not frames:
        empty = StructType([*schema.fields, *([StructField("_metadata", FILE)] if with_metadata else [])])
        return spark.createDataFrame([], empty)
    return reduce(DataFrame.unionByName, frames)


def resolve_source(spark: SparkSession, candidates: Sequence[str]) -> str:
    """First candidate path that exists (official folder, then backups).
    Checked through the Hadoop FileSystem API, so object stores work."""
    for c in candidates:
        if exists(spark, c):
            return c
    raise FileNotFoundError(f"none of the candidate sources exist: {list(candidates)}")


def scan_with_fallback(spark: SparkSession, file_name: str, folders: Sequence[str], schema: StructType) -> DataFrame:
    """Read ``file_name`` from the first folder that has it."""
    path = resolve_source(spark, [f"{f.rstrip('/')}/{file_name}" for f in folders])
    return read_csv(spark, path, schema)


def latest_file(spark: SparkSession, folders: Sequence[str], suffix: str = ".csv") -> str:
    """Newest file (by modification time) of the first folder that has any."""
    for f in folders:
        files = list_files(spark, f, suffix)
        if files:
            return max(files, key=lambda t: (t[1], t[0]))[0]
    raise FileNotFoundError(f"no {suffix} file in {list(folders)}")


def with_file_metadata(df: DataFrame, ref_part: int = 2, stamp_part: int = 3) -> DataFrame:
    """Add ``filename`` (base name of the source file), ``ref`` and
    ``ts_file_generation`` taken from the ``_``-separated parts of the name
    (0-based ``ref_part``/``stamp_part``; NULL when the name is shorter). Takes
    the ``_metadata`` of ``read_csv(..., with_metadata=True)`` or of a scan."""
    name = F.col("_metadata.file_name")
    parts = F.split(name, "_")
    stamp = F.regexp_replace(F.get(parts, stamp_part), r"\.csv$", "")
    kept = [c for c in df.columns if c != "_metadata"]
    return df.select(*kept, name.alias("filename"), F.get(parts, ref_part).alias("ref"), stamp.alias("ts_file_generation"))


def latest_entry(spark: SparkSession, folders: Sequence[str], suffix: str = ".csv") -> str:
    """Like ``latest_file`` but a Spark-written dataset folder counts as one
    entry (the unit a batch load lands as)."""
    from billbook.sources.paths import list_entries

    for f in folders:
        entries = list_entries(spark, f, suffix)
        if entries:
            return max(entries, key=lambda t: (t[1], t[0]))[0]
    raise FileNotFoundError(f"no {suffix} entry in {list(folders)}")


def write_named_batches(df: DataFrame, folder: str, prefix: str, ref_col: str, stamp: str) -> list[str]:
    """Write ``df`` as CSV files named ``{prefix}_{ref}_{stamp}.csv``, further
    files of one ``ref`` ``{prefix}_{ref}_{stamp}_{n}.csv``, all in ``folder``
    (the naming contract of the prototype loads). The data is written by executors; only the file
    renames run on the driver (metadata operations)."""
    from billbook.sources.paths import glob_files, rename

    spark = df.sparkSession
    staging = folder.rstrip("/") + "/_staging"
    df.hint("rebalance", ref_col).write.partitionBy(ref_col).option("header", True).csv(staging)
    out: list[str] = []
    written: dict[str, int] = {}
    for path in sorted(glob_files(spark, f"{staging}/{ref_col}=*/part-*")):
        ref = path.split(f"{ref_col}=")[1].split("/")[0]
        n = written[ref] = written.get(ref, -1) + 1
        dst = f"{folder.rstrip('/')}/{prefix}_{ref}_{stamp}{f'_{n}' if n else ''}.csv"
        rename(spark, path, dst)
        out.append(dst)
    return out
