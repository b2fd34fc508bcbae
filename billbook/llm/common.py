"""Helpers shared by the operators of this package."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from billbook.sources.paths import scratch_dir

#: ASCII white space that separates words: blank and \t \n \v \f \r.
SPACE_TABLE = np.zeros(256, dtype=bool)
SPACE_TABLE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: A-Z to a-z, other bytes unchanged.
LOWER_TABLE = np.arange(256, dtype=np.uint8)
LOWER_TABLE[65:91] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: later
    steps restart from these files when executors are lost, so the shuffle
    files of the step are given back at its end."""
    spark = df.sparkSession
    path = scratch_dir(spark, f"llm-{name}")
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` starts so."""
    while any(c.lower().startswith(name.lower()) for c in df.columns):
        name += "_"
    return name


def train_row(doc_id: Column) -> Column:
    """True for rows that models may learn from: crc32 of the id's text,
    modulo 3, is not 1. A null id is held out of training."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1, F.lit(False))


def held_out(doc_id: Column) -> Column:
    """True where crc32(doc_id as text) mod 3 is 1; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


#: Steps per halving of the hashed unit interval: a sample keeps at least
#: 2 ** (-1 / LEVELS) of its bound, give or take its own noise.
LEVELS = 16


def sample_cut(rows: DataFrame, size: int, group: str | None = None, by: Column | str = "doc_id") -> tuple[Column, dict, dict]:
    """A condition that keeps at most ``size`` rows (of each value of
    ``group``), chosen by the hash of ``by``; how many rows it keeps, and how
    many there are.

    A row's level grows as its hash gets smaller; levels are counted over all
    rows (map-side combined, at most 53 * LEVELS counts a group reach the
    driver) and rows from the lowest level up whose counts stay within ``size`` are
    kept. No sort or window, so a hot group is no task of its own. Rows of one
    ``by`` stand or fall together; if a group's rarest level alone is over
    ``size``, the group has no sample."""
    unit = (F.shiftrightunsigned(F.xxhash64(by), 11).cast("double") + 1) / float(1 << 53)
    level = F.floor(-F.log2(unit) * LEVELS).cast("int")
    key = F.col(group) if group else F.lit(None).cast("string")
    counted = rows.groupBy(key.alias("part"), level.alias("level")).count().collect()
    levels: dict = {}
    for r in counted:
        levels.setdefault(r["part"], {})[r["level"]] = r["count"]
    keep, sizes = F.lit(False), {}
    for part, found in levels.items():
        cut, total = None, 0
        for at in sorted(found, reverse=True):
            if total + found[at] > size:
                break
            cut, total = at, total + found[at]
        if cut is not None:
            keep = keep | (key.eqNullSafe(F.lit(part)) & (level >= cut))
            sizes[part] = total
    return keep, sizes, {part: sum(found.values()) for part, found in levels.items()}


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; row i is
    ``bytes[offsets[i]:offsets[i + 1]]``, a null is empty."""
    kind = pa.large_binary()
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string()).view(kind)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]: off[-1]], off - off[0]


def row_chunks(offsets: np.ndarray, limit: int = 1 << 20):
    """(first, last) row ranges whose bytes sum to about ``limit``; a single
    longer row is a range of its own."""
    n, first = len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last
        first = last


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i for i in 0..n, modulo 2^64."""
    if len(_powers.get("up", ())) <= n:
        size = max(n + 1, 1 << 20)
        for key, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[key] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


class RangeHash:
    """64-bit hashes of many byte ranges of one buffer, from prefix sums."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data) + 1)
        # Spread the byte values first, so that sums do not collide easily.
        spread = mix64(np.arange(1, 257, dtype=np.uint64))
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(spread[data] * up[: len(data)], dtype=np.uint64, out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of bytes[start:end] for each pair."""
        raw = (self.sums[end] - self.sums[start]) * self.down[start]
        return mix64(raw + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def long_array(x: np.ndarray) -> pa.Array:
    """uint64 hashes as Spark longs, bit for bit."""
    return pa.array(np.ascontiguousarray(x).view(np.int64))
