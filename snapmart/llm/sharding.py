"""Consistent-hash ring with virtual nodes and bounded loads.

The ring has ``cells`` places.  Each shard owns ``vnodes`` places drawn from its
number alone; a row's key hashes to a place and belongs to the next virtual node
clockwise.  A shard takes rows up to its bound; rows that find it full continue
clockwise to the next virtual node of a shard with room.  So the largest load is
guaranteed, and as virtual nodes stay put when shards are added, few rows move.

With ``slack = 0`` the bounds sum to the number of rows: all shards fill up and
counts differ by one at most (the ``rows`` law).  With more slack fewer rows move.

The driver sees one count per cell, at most ``cells`` numbers whatever the table's
size, walks the ring over these counts, and returns which ranks of a cell go to
which shard and slots.  Ranks within cells are found by a window over cells,
after equal rows have been summed; so no key, text or shard gathers in one task.

Defined cases: a null text has 0 bytes and the checksum of the empty text; rows
without a key are dealt by their size and checksum; repeated rows each get a slot
(which of two equal rows gets which is immaterial), and equal texts of different ids
are placed each for itself; keys that fall on one place keep the order of the window
(key, size, checksum); of a very long text only size and checksum are kept; an empty
table gives no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import shared

OVERHEAD = 16  # bytes counted for a row besides its text


def ring(shards: int, vnodes: int, cells: int) -> list[tuple[int, int]]:
    """(place, shard) of all virtual nodes, clockwise.  A shard's places do not depend on the others."""
    def draw(s: int, v: int) -> int:
        return int.from_bytes(hashlib.blake2b(f"{s}:{v}".encode(), digest_size=8).digest(), "big")

    nodes = sorted((draw(s, v), s) for s in range(shards) for v in range(vnodes))
    return [(at * cells >> 64, s) for at, s in nodes]


def bounds(n: int, shards: int, slack: float) -> list[int]:
    """Most rows of each shard."""
    if slack <= 0:
        return [n // shards + (s < n % shards) for s in range(shards)]
    return [int(-(-n * (1 + slack) // shards))] * shards


def walk(counts: dict[int, int], shards: int, vnodes: int, cells: int, slack: float) -> list[tuple[int, int, int, int, int]]:
    """Pieces (cell, first rank, rows, shard, first slot) that cover every rank of every cell once.

    First each virtual node offers its own rows to its shard; what is left then moves
    on, one virtual node a round, passing shards that are full.
    """
    nodes = ring(shards, vnodes, cells)
    room = bounds(sum(counts.values()), shards, slack)
    filled = [0] * shards
    waiting: list[list[tuple[int, int, int]]] = [[] for _ in nodes]
    k = 0
    for cell in sorted(counts):
        while k < len(nodes) and nodes[k][0] < cell:
            k += 1
        waiting[k % len(nodes)].append((cell, 0, counts[cell]))
    pieces = []
    while any(waiting):
        for k, queue in enumerate(waiting):
            s = nodes[k][1]
            rest = []
            for cell, first, n in queue:
                take = min(n, room[s] - filled[s])
                if take:
                    pieces.append((cell, first, take, s, filled[s]))
                    filled[s] += take
                if take < n:
                    rest.append((cell, first + take, n - take))
            waiting[k] = rest
        moved: list[list[tuple[int, int, int]]] = [[] for _ in nodes]
        for k, queue in enumerate(waiting):
            if queue:
                to = (k + 1) % len(nodes)
                while filled[nodes[to][1]] >= room[nodes[to][1]]:
                    to = (to + 1) % len(nodes)
                moved[to] += queue
        waiting = moved
    return pieces


def assign(docs: DataFrame, shards: int = 40, vnodes: int = 128, cells: int = 1 << 16, slack: float = 0.0) -> DataFrame:
    """Per row: ``doc_id, size, text_crc32, shard, slot``; slots of a shard are gapless from 0."""
    body = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       (F.length(body).cast("bigint") + OVERHEAD).alias("size"), F.crc32(body).alias("text_crc32"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.concat_ws(":", F.lit("none"), "size", "text_crc32"))
    counted = shared.cut(rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("copies"))
                         .withColumn("place", F.xxhash64(key)))
    shift = 64 - (cells.bit_length() - 1)
    counted = counted.withColumn("cell", F.shiftrightunsigned("place", shift))
    per_cell = {r["cell"]: r["n"] for r in counted.groupBy("cell").agg(F.sum("copies").alias("n")).collect()}
    plan = shared.small_table(docs.sparkSession, ("cell", "first", "n", "shard", "slot0"),
                              walk(per_cell, shards, vnodes, cells, slack))
    order = Window.partitionBy("cell").orderBy("place", "doc_id", "size", "text_crc32")
    ranked = counted.withColumn("rank0", F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("copies"))
    each = ranked.select("doc_id", "size", "text_crc32", "cell",
                         F.explode(F.sequence("rank0", F.expr("rank0 + copies - 1"))).alias("rank"))
    # One row per piece: at most cells + shards * vnodes rounds of them, a few MB at any table size.
    inside = (F.col("rank") >= F.col("p.first")) & (F.col("rank") < F.col("p.first") + F.col("p.n"))
    return (each.join(F.broadcast(plan.withColumnRenamed("cell", "p_cell").alias("p")),
                      (F.col("cell") == F.col("p.p_cell")) & inside)
            .select("doc_id", "size", "text_crc32", F.col("p.shard").cast("int").alias("shard"),
                    (F.col("p.slot0") + F.col("rank") - F.col("p.first")).alias("slot")))
