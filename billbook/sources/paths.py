"""Scratch and lake locations on the shared file system (Hadoop FS API)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from billbook.session import ensure_checkpoint_dir


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir; never machine-local
    on a cluster. Each call gets its own folder, so runs never collide."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/billbook/{name}-{uuid.uuid4().hex[:12]}"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_files(spark: SparkSession, folder: str, suffix: str = "") -> list[tuple[str, int]]:
    """(path, modification time ms) of the files directly in ``folder``."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        if st.isFile():
            path = st.getPath().toString()
            if path.endswith(suffix):
                out.append((path, int(st.getModificationTime())))
    return out


def rename(spark: SparkSession, src: str, dst: str) -> None:
    fs, p = _fs(spark, src)
    jvm = spark.sparkContext._jvm
    if not fs.rename(p, jvm.org.apache.hadoop.fs.Path(dst)):
        raise OSError(f"could not move {src} to {dst}")


def make_file(spark: SparkSession, path: str, text: str) -> None:
    """A small new file (metadata only)."""
    fs, p = _fs(spark, path)
    out = fs.create(p, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a UTF-8 text file, without a byte-order mark."""
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
    try:
        return (reader.readLine() or "").removeprefix("\ufeff")
    finally:
        reader.close()


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def list_entries(spark: SparkSession, folder: str, suffix: str = "") -> list[tuple[str, int]]:
    """(path, modification time ms) of files *and* folders directly in
    ``folder`` (a Spark-written dataset is a folder)."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        path = st.getPath().toString()
        name = st.getPath().getName()
        if name.startswith(("_", ".")):
            continue
        if path.endswith(suffix):
            out.append((path, int(st.getModificationTime())))
    return out


def set_times(spark: SparkSession, path: str, mtime_ms: int) -> None:
    """Best effort: some object stores keep no settable modification time
    (callers break mtime ties by name)."""
    fs, p = _fs(spark, path)
    try:
        fs.setTimes(p, int(mtime_ms), -1)
    except Exception:  # noqa: BLE001 - unsupported on this file system
        pass


def glob_files(spark: SparkSession, pattern: str) -> list[str]:
    fs, p = _fs(spark, pattern)
    st = fs.globStatus(p)
    return [] if st is None else [s.getPath().toString() for s in st if s.isFile()]
