"""Approximate nearest neighbours by randomly rotated one-bit codes.

A vector minus the corpus mean is rotated by a random orthogonal matrix; its code
is the sign of each coordinate (one bit), with two correction scalars: its length and
the inner product of its direction with the code's direction.  A rotated query is
rounded to four bits a coordinate, so its product with a code is a weighted sum of bit
counts of 64-bit words: codes stay packed.  With the scalars an unbiased estimate of any
inner product follows, and with it a bound on its error; per query, only vectors whose
upper bound reaches the score of the best found so far are reranked on the original
vectors, in double precision.

Every vector is coded and compared: a stated query set meets all rows block by block.
Vectors are dealt evenly into blocks and these into groups that a task can hold; a group
is moved once, and only query blocks are sent to every group, where they stream past the
vectors.  A cell returns the best of its block per query; the best overall follow from a
per-query window whose input is cut to ``top`` rows per task before it is shuffled.

Defined cases: vectors that are null, zero, hold null or non-finite components, or
are not of the most frequent dimension (of equals the smallest) take no part, nor do
rows without a vec_id.  Repeated rows are candidates each; rows that share the
query's vec_id are its own and no candidates; of rows repeating a query's vec_id the
least vector asks.  Ties go to the smaller vec_id.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import shared

#: Rows of a block of vectors, and of a block of queries.
VECTORS, QUERIES = 8192, 512
#: Bytes of original vectors that a task holds while queries stream past them.
HELD = 64 << 20
#: Bits a coordinate of a rounded query, and queries whose bits are counted at once (in a core's cache).
LEVELS, AT_ONCE = 4, 16
#: Width of the error bounds in standard deviations (of the estimate over random rotations).
WIDTH = 1.9

RESULT = "query_id bigint, vec_id bigint, score double"


def valid(vectors: DataFrame) -> tuple[DataFrame, int]:
    """The rows that take part (``vec_id``, ``embedding`` of doubles) and their dimension; 0 if there are none."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    e = F.col("embedding")
    bad = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & e.isNotNull() & ~bad & F.exists(e, lambda x: x != 0))
    sizes = rows.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    return (rows.where(F.size("embedding") == sizes["d"]), sizes["d"]) if sizes else (rows, 0)


def mean(rows: DataFrame, dims: int) -> np.ndarray:
    """Mean vector: sums per batch in the tasks, then one aggregate of ``dims`` groups."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = _matrix(b.column(0), dims)
            yield pa.RecordBatch.from_pydict({"k": np.arange(dims, dtype=np.int32), "s": m.sum(axis=0),
                                              "n": np.full(dims, len(m), dtype=np.int64)})

    parts = shared.map_arrow(rows.select("embedding"), run, "k int, s double, n bigint")
    sums = parts.groupBy("k").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()
    out = np.zeros(dims)
    for r in sums:
        out[r["k"]] = r["s"] / r["n"]
    return out


def rotation(dims: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def encode(x: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed bits, length, inner product of direction and code) of each vector."""
    away = (x - centre) @ turn.T
    length = np.linalg.norm(away, axis=1)
    bits = away > 0
    unit = away / np.where(length > 0, length, 1)[:, None]
    agree = np.abs(unit).sum(axis=1) / np.sqrt(x.shape[1])
    return np.packbits(bits, axis=1), length, np.where(length > 0, agree, 1.0)


def _words(packed: np.ndarray) -> np.ndarray:
    """Packed bytes (last axis) as 64-bit words, padded with zeros."""
    padded = np.zeros((*packed.shape[:-1], -(-packed.shape[-1] // 8) * 8), dtype=np.uint8)
    padded[..., :packed.shape[-1]] = packed
    return padded.view(np.uint64)


def bit_products(level: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Sum of a query's levels (below 2^``LEVELS``) where a code's bit is set, for every (query, code), by counting bits."""
    planes = _words(np.packbits(level[None] >> np.arange(LEVELS, dtype=np.uint8)[:, None, None] & 1, axis=2))
    out = np.zeros((len(level), len(codes)), dtype=np.int32)
    columns = np.ascontiguousarray(codes.T)
    for k in range(0, len(level), AT_ONCE):
        for j in range(LEVELS):
            for w, column in enumerate(columns):
                out[k:k + AT_ONCE] += np.bitwise_count(planes[j, k:k + AT_ONCE, w, None] & column[None, :]).astype(np.int32) << j
    return out


def estimate(queries: np.ndarray, packed: np.ndarray, length: np.ndarray, agree: np.ndarray, centre: np.ndarray,
             turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products (query x vector) and one standard deviation of their error (rotation and rounding)."""
    dims = queries.shape[1]
    turned = queries @ turn.T
    low = turned.min(axis=1, keepdims=True)
    step = (turned.max(axis=1, keepdims=True) - low) / (2 ** LEVELS - 1)
    level = np.rint((turned - low) / np.where(step > 0, step, 1)).astype(np.uint8)
    codes = _words(packed)
    ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int32)
    # the rounded query times the signs: twice its sum where the bit is set, less its sum
    est = bit_products(level, codes).astype(np.float32)
    est *= (2 * step).astype(np.float32)
    est += (2 * low).astype(np.float32) * ones[None, :].astype(np.float32)
    est -= (low * dims + step * level.sum(axis=1, dtype=np.int64, keepdims=True)).astype(np.float32)
    scale = length / (agree * np.sqrt(dims))
    est *= scale[None, :].astype(np.float32)
    est += (queries @ centre)[:, None].astype(np.float32)
    turning = length * np.sqrt(np.maximum(0, 1 - agree ** 2)) / agree / np.sqrt(max(1, dims - 1))
    size = np.linalg.norm(queries, axis=1)
    rounding = step[:, 0] * np.sqrt(dims / 12)
    spread = np.sqrt((size ** 2).astype(np.float32)[:, None] * (turning ** 2).astype(np.float32)[None, :]
                     + (rounding ** 2).astype(np.float32)[:, None] * (scale ** 2).astype(np.float32)[None, :])
    return est, spread


def _exact(vectors: np.ndarray, v: np.ndarray, queries: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of listed pairs; their rounding depends on the two vectors only, not on their places."""
    out = np.empty(len(v))
    for k in range(0, len(v), 50_000):
        out[k:k + 50_000] = np.einsum("ij,ij->i", vectors[v[k:k + 50_000]], queries[q[k:k + 50_000]])
    return out


def search_cell(qid: np.ndarray, q: np.ndarray, vid: np.ndarray, x: np.ndarray, codes, centre, turn, top: int, width: float,
                least: np.ndarray | None = None):
    """(query ids, vector ids, scores) of each query's best ``top`` in the block; None if there are none.

    The best of the exact scores of a few times ``top`` best estimates give a floor; every
    vector whose upper bound reaches it is reranked.  ``least`` holds floors that ``top``
    vectors of earlier blocks have reached; it is raised by this block's.
    """
    est, spread = estimate(q, *codes, centre, turn)
    est[qid[:, None] == vid[None, :]] = -np.inf
    m = min(4 * top, len(vid))
    first = np.argpartition(-est, m - 1, axis=1)[:, :m]
    row = np.repeat(np.arange(len(qid)), m)
    seen = _exact(x, first.ravel(), q, row)
    seen[np.isneginf(est[row, first.ravel()])] = -np.inf
    floor = np.sort(seen.reshape(-1, m), axis=1)[:, -min(top, m)]
    if least is not None:
        if m >= top:
            np.maximum(least, floor, out=least)
        floor = np.where(np.isneginf(least), floor, least)
    est += (width * spread).astype(est.dtype)
    row, at = np.nonzero((est >= (floor - 1e-6 * np.abs(floor))[:, None]) & ~np.isneginf(est))
    score = _exact(x, at, q, row)
    row, at, score = (np.concatenate(c) for c in zip(  # the floor's own vectors, should a bound have missed them
        (row, at, score), (np.repeat(np.arange(len(qid)), m), first.ravel(), seen), strict=True))
    good = (score >= floor[row]) & ~np.isneginf(score)
    row, at, score = row[good], at[good], score[good]
    pair = np.unique(row * len(vid) + at, return_index=True)[1]
    row, at, score = row[pair], at[pair], score[pair]
    order = np.lexsort((vid[at], -score, row))
    row, at, score = row[order], at[order], score[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    best = place < top
    return (qid[row[best]], vid[at[best]], score[best]) if best.any() else None


def index(rows: DataFrame, dims: int, blocks: int, centre: np.ndarray, seed: int) -> DataFrame:
    """Numbered blocks of all vectors: ids, packed bits, correction scalars and the vectors themselves."""
    turn = rotation(dims, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId()
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            x = _matrix(b.column(1), dims)
            for k in range(0, len(ids), VECTORS):
                some = x[k:k + VECTORS]
                packed, length, agree = encode(some, centre, turn)
                yield pa.RecordBatch.from_pydict({
                    "block": [block], "ids": [ids[k:k + VECTORS].astype("<i8").tobytes()], "packed": [packed.tobytes()],
                    "scalars": [np.stack([length, agree]).astype("<f8").tobytes()], "vectors": [some.astype("<f8").tobytes()]},
                    schema=pa.schema([("block", pa.int64()), *((c, pa.binary()) for c in ("ids", "packed", "scalars", "vectors"))]))

    return shared.map_arrow(rows.repartition(blocks), run,
                            "block bigint, ids binary, packed binary, scalars binary, vectors binary")


def search(vectors: DataFrame, asks: Column, top: int = 20, seed: int = 7, width: float = WIDTH) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``top`` best found for each row that meets ``asks`` (on ``vec_id``)."""
    rows, dims = valid(vectors)
    spark = vectors.sparkSession
    if not dims:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    centre = mean(rows, dims)
    turn = rotation(dims, seed)
    n, n_asks = rows.agg(F.count("*"), F.count_if(asks)).first()
    blocks, asking = -(-n // VECTORS), max(1, -(-n_asks // QUERIES))
    per_group = max(1, HELD // (8 * dims * VECTORS))
    groups = max(-(-blocks // per_group), min(blocks, spark.sparkContext.defaultParallelism))
    indexed = shared.cut(index(rows, dims, blocks, centre, seed))

    def query_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, QUERIES):
                some = b.slice(k, QUERIES)
                yield pa.RecordBatch.from_pydict(
                    {"ids": [some.column(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes()],
                     "vectors": [_matrix(some.column(1), dims).astype("<f8").tobytes()]},
                    schema=pa.schema([("ids", pa.binary()), ("vectors", pa.binary())]))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []
        for b in batches:
            for r in (b.slice(k, 1).to_pylist()[0] for k in range(b.num_rows)):
                if r["group"] != group:
                    group, held = r["group"], []
                ids, x = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["vectors"], "<f8").reshape(-1, dims)
                if r["packed"] is not None:
                    held.append((ids, x, (np.frombuffer(r["packed"], np.uint8).reshape(len(ids), -1),
                                          *np.frombuffer(r["scalars"], "<f8").reshape(2, -1))))
                    continue
                least = np.full(len(ids), -np.inf)
                for vid, vectors, codes in held:
                    found = search_cell(ids, x, vid, vectors, codes, centre, turn, top, width, least)
                    if found:
                        yield pa.RecordBatch.from_pydict(dict(zip(("query_id", "vec_id", "score"), found, strict=True)))

    queries = rows.where(asks).groupBy("vec_id").agg(F.min("embedding").alias("embedding")).repartition(asking)
    asked = shared.map_arrow(queries, query_blocks, "ids binary, vectors binary")
    # The stated queries meet every group: a group's blocks come first and are held, its copies of the query blocks follow.
    met = indexed.withColumn("group", F.expr(f"block % {groups}L")).drop("block").withColumn("asks", F.lit(False)).unionByName(
        asked.select(F.explode(F.expr(f"sequence(0L, {groups - 1}L)")).alias("group"), "ids", "vectors", F.lit(True).alias("asks")),
        allowMissingColumns=True)
    dealt = met.repartitionById(groups, F.col("group").cast("int")).sortWithinPartitions("group", "asks")
    best = shared.map_arrow(dealt, cells, RESULT)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(f"rank <= {top}").select("query_id", "rank", "vec_id", "score")
