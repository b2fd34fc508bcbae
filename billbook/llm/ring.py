"""Operator 3: sharding on a consistent-hash ring with virtual nodes and
bounded loads.

Every shard owns many points of a ring; a row belongs to the first point
clockwise of its key's hash. A shard takes rows up to its bound; the rows over
it go on clockwise to the next point whose shard has room. The bounds are
``n // shards`` rows, one more for the first ``n % shards`` shards, so the law
is ``rows``: counts are at most one apart, while most rows stay on the shard
that the plain ring gives them.

The ring is cut into a fixed number of cells. Only the row counts of the cells
reach the driver (``cells`` numbers, whatever the data), where the overflow is
settled. Rows are counted before they are dealt: rows of one id, size and
checksum are one row with a number of copies, cut into bundles of BUNDLE copies
at most. Bundles are ranked inside a part of their cell (PARTS parts, by a hash
of the bundle), and the counts of the parts before are added. So an id, or no
id, that a third of all rows share is spread over the parts of its cell,
whether its texts are equal or not.

Edge cases: a null text has size 8 and crc32 0; null ids share a cell; equal
rows are interchangeable; an empty table gives no rows; extra columns are never
read. The result depends on the rows alone, not on their order or partitions.
"""

from __future__ import annotations

import bisect
import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from billbook.llm.common import materialize

VIRTUAL_NODES = 64
CELL_BITS = 14
PARTS = 256
BUNDLE = 1 << 16

PIECES = "cell int, from_rank long, to_rank long, shard int, slot_base long, home int"


def ring_points(shards: int, virtual_nodes: int = VIRTUAL_NODES, cell_bits: int = CELL_BITS) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node, in ring order."""
    return sorted(
        (int.from_bytes(hashlib.blake2b(f"{s}/{v}".encode(), digest_size=8).digest()) >> (64 - cell_bits), s)
        for s in range(shards) for v in range(virtual_nodes))


def settle(counts: dict[int, int], shards: int, points: list[tuple[int, int]], slack: float = 0.0) -> list[tuple]:
    """Deal cells' rows to shards: (cell, from_rank, to_rank, shard, slot_base,
    home shard). Round by round, each cell offers what it has left to its
    current point; shards take offers in ring order until their bound. With
    ``slack`` the bound is that share above the mean, and fewer rows move."""
    total = sum(counts.values())
    room = [int(total * (1 + slack)) // shards + (1 if s < int(total * (1 + slack)) % shards else 0) for s in range(shards)]
    used = [0] * shards
    starts = [c for c, _ in points]
    home = {c: bisect.bisect_left(starts, c) % len(points) for c in counts}
    offers = [(c, 0, counts[c], home[c]) for c in sorted(counts)]
    pieces = []
    while offers:
        left = []
        for cell, lo, hi, at in offers:
            shard = points[at][1]
            take = min(hi - lo, room[shard] - used[shard])
            if take:
                pieces.append((cell, lo, lo + take, shard, used[shard], points[home[cell]][1]))
                used[shard] += take
            if lo + take < hi:
                left.append((cell, lo + take, hi, at))
        offers = []
        for cell, lo, hi, at in left:
            while used[points[at][1]] >= room[points[at][1]]:
                at = (at + 1) % len(points)
            offers.append((cell, lo, hi, at))
    return pieces


def bundles(docs: DataFrame, doc_id: str, text: str, cell_bits: int, parts: int, bundle: int) -> DataFrame:
    """doc_id, size, text_crc32, bundle number, copies, and the cell and part
    that the bundle is ranked in."""
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(t) + 8).cast("long").alias("size"),
        F.crc32(t.cast("binary")).cast("long").alias("text_crc32"))
    same = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n"))
    cut = same.select("*", F.posexplode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(bundle).cast("long"))).alias("bundle", "first"))
    return cut.select(
        "doc_id", "size", "text_crc32", "bundle",
        F.least(F.col("n") - F.col("first"), F.lit(bundle)).cast("long").alias("copies"),
        F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - cell_bits).cast("int").alias("cell"),
        F.pmod(F.xxhash64("doc_id", "size", "text_crc32", "bundle"), F.lit(parts)).cast("int").alias("part"))


def shard_rows(docs: DataFrame, shards: int = 24, doc_id: str = "doc_id", text: str = "text",
               virtual_nodes: int = VIRTUAL_NODES, cell_bits: int = CELL_BITS,
               parts: int = PARTS, bundle: int = BUNDLE) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null: the law
    is not ``key``), home_shard (the plain ring's)."""
    spark = docs.sparkSession
    # Written, so that the texts are read once for the counts and the rows.
    rows = materialize(bundles(docs, doc_id, text, cell_bits, parts, bundle), "ring-bundles")
    by_part = rows.groupBy("cell", "part").agg(F.sum("copies").alias("n"))
    counts = {r["cell"]: r["n"] for r in by_part.groupBy("cell").agg(F.sum("n").alias("n")).collect()}  # 2 ** cell_bits at most
    pieces = settle(counts, shards, ring_points(shards, virtual_nodes, cell_bits))
    # At most 2 ** cell_bits + shards ** 2 rows: a fixed size, so broadcast.
    plan = F.broadcast(spark.createDataFrame(pieces, PIECES).withColumnRenamed("cell", "of_cell"))
    # At most 2 ** cell_bits * parts rows; both sides lie by (cell, part).
    before = Window.partitionBy("cell").orderBy("part")
    base = by_part.select("cell", "part", (F.sum("n").over(before) - F.col("n")).alias("base"))
    within = Window.partitionBy("cell", "part").orderBy("doc_id", "text_crc32", "size", "bundle").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (rows.withColumn("upto", F.sum("copies").over(within)).join(base, ["cell", "part"])
              .withColumn("begin", F.col("base") + F.col("upto") - F.col("copies")).withColumn("end", F.col("base") + F.col("upto")))
    hit = (F.col("cell") == F.col("of_cell")) & (F.col("begin") < F.col("to_rank")) & (F.col("end") > F.col("from_rank"))
    share = F.sequence(F.greatest("begin", "from_rank"), F.least("end", "to_rank") - 1)  # ``bundle`` numbers at most
    return ranked.join(plan, hit).select("*", F.explode(share).alias("rank")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("slot_base") + F.col("rank") - F.col("from_rank")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), F.col("home").alias("home_shard"))
