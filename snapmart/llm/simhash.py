"""SimHash near-duplicates by anchor-point covering.

Fingerprints are compared only around anchors.  The anchors are the pairs of code
words of two perfect [23, 12] binary Golay codes laid over bits 0-22 and 23-45:
every fingerprint lies within the covering radius (3 bits in each half) of exactly
one anchor, its home.  A fingerprint is replicated to every anchor within radius
plus threshold: those at 3 + a and 3 + b bits with a + b at most the threshold.  If
two fingerprints differ in at most that many bits, the replica of one meets the
home of the other, so no link is lost; and each ordered pair meets exactly once,
as a home is unique.  (The remaining bits are only compared.)

Links are never listed in full.  Within an anchor a block of homes meets a part of
the rows, and a union-find over the homes leaves a spanning forest: fewer edges
than rows.  A crowded anchor becomes a grid of blocks and parts, so each cell holds a
bounded share whatever the anchor's size.  Components are then contracted by
alternating star rounds over the edges, with a checkpoint each round.

Equal fingerprints are first reduced to one row, so copies cost one fingerprint.

Defined cases: null and empty texts have fingerprint zero and link like others;
texts of fewer words than a shingle hash their whole sequence; a very long text is
hashed whole, some 200,000 shingles at a time beyond its own; rows without an id
get the component of their fingerprint (null if no row in it has an id); repeated
rows have equal fingerprints and stay rows of their own; of equal smallest ids there
is but one value, so ties need no order; an empty table gives no rows; further
columns are not read unless they are in ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import components, shared

BITS = 23  # of a code word
RADIUS = 3
_GENERATOR = 0b101011100011  # of the cyclic [23, 12] code
#: Homes, and rows, of one cell of a crowded anchor's grid (about; rows are dealt by a hash).
BLOCK, PART = 2048, 65_536
#: Tasks over which an anchor's replicas are dealt while nobody's anchors are dropped.
SALTS = 16


# fingerprints ---------------------------------------------------------------

def shingle_hashes(text: str, words: int, seed: int) -> list[int]:
    """XXH64 of every shingle, repeats included; ASCII letters in lower case."""
    import xxhash
    parts = text.encode().lower().split()  # bytes: only A-Z fold, only \\x20 and \\x09-\\x0D split
    if not parts:
        return []
    hashed = xxhash.xxh64_intdigest
    if len(parts) <= words:
        return [hashed(b" ".join(parts), seed)]
    line = b" ".join(parts)
    starts = [0]
    at = 0
    for p in parts:
        at += len(p) + 1
        starts.append(at)
    return [hashed(line[a:b - 1], seed) for a, b in zip(starts, starts[words:], strict=False)]


def fingerprints_of(texts: list[str], words: int, seed: int) -> np.ndarray:
    """Unsigned 64-bit fingerprint of each text."""
    out = np.zeros(len(texts), dtype=np.uint64)
    hashes: list[int] = []
    rows, sizes = [], []

    def flush():
        bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        firsts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        counts = np.add.reduceat(bits, firsts, axis=0, dtype=np.int64)
        on = 2 * counts > np.array(sizes)[:, None]
        out[rows] = np.packbits(on, axis=1, bitorder="little").view("<u8")[:, 0]
        hashes.clear()
        rows.clear()
        sizes.clear()

    for k, text in enumerate(texts):
        h = shingle_hashes(text, words, seed)
        if h:
            hashes += h
            rows.append(k)
            sizes.append(len(h))
        if len(hashes) >= 200_000:
            flush()
    if hashes:
        flush()
    return out


def fingerprints(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), words: int = 3, seed: int = 42) -> DataFrame:
    """The ``keep`` columns and ``fp`` (the fingerprint's 64 bits as a bigint) of every row."""
    slim = docs.select(*keep, F.col("text").cast("string").alias("text"))
    return shared.text_append(slim, lambda texts: fingerprints_of(texts, words, seed).view(np.int64), "fp", "bigint").drop("text")


# anchors --------------------------------------------------------------------

def _syndrome(words: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit polynomials by the generator: zero exactly for code words."""
    rest = words.copy()
    for bit in range(BITS - 1, 10, -1):
        rest ^= np.where(rest >> bit & 1, _GENERATOR << (bit - 11), 0)
    return rest


@lru_cache(maxsize=1)
def _code() -> tuple[np.ndarray, np.ndarray]:
    """(leaders, code words).  The code is perfect, so its 2 ** 11 syndromes are those of the words of weight up to 3."""
    light = np.array([sum(1 << b for b in c) for w in range(RADIUS + 1) for c in combinations(range(BITS), w)])
    leader = np.zeros(1 << 11, dtype=np.int64)
    leader[_syndrome(light)] = light
    high = np.arange(1 << 12, dtype=np.int64) << 11
    return leader, high ^ _syndrome(high)


def home_words(x: np.ndarray) -> np.ndarray:
    """The code word within the covering radius of each 23-bit value."""
    return x ^ _code()[0][_syndrome(x)]


@lru_cache(maxsize=4)
def _reach(threshold: int) -> list[list[np.ndarray]]:
    """Per syndrome and excess e: the differences to code words at radius + e bits (e = 0: up to the radius)."""
    leader, code = _code()
    out = []
    for s in range(1 << 11):
        away = code ^ leader[s]
        weight = np.bitwise_count(away)
        out.append([away[weight <= RADIUS]] + [away[weight == RADIUS + e] for e in range(1, threshold + 1)])
    return out


def _halves(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    bits, low = fp.view(np.uint64), np.uint64((1 << BITS) - 1)
    return (bits & low).astype(np.int64), (bits >> np.uint64(BITS) & low).astype(np.int64)


def home_anchor(fp: np.ndarray) -> np.ndarray:
    """The anchor within the covering radius in both halves."""
    a, b = _halves(fp)
    return home_words(a) << BITS | home_words(b)


def anchors(fp: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(home anchor of each fingerprint, row of each replica, anchor of each replica); the home is not among replicas."""
    a, b = _halves(fp)
    home = home_anchor(fp)
    reach = _reach(threshold)
    sa, sb = _syndrome(a), _syndrome(b)
    rows, found = [], []
    for k in range(len(fp)):
        near_a, near_b = reach[sa[k]], reach[sb[k]]
        for ea in range(threshold + 1):
            left = (int(a[k]) ^ near_a[ea]) << BITS
            right = int(b[k]) ^ (near_b[0] if threshold == ea else np.concatenate(near_b[:threshold - ea + 1]))
            if len(left) and len(right):
                found.append((left[:, None] | right[None, :]).ravel())
                rows.append(np.full(len(found[-1]), k))
    row, anchor = np.concatenate(rows), np.concatenate(found)
    apart = anchor != home[row]
    return home, row[apart], anchor[apart]


def _match(homes: np.ndarray, others: np.ndarray, threshold: int, parent: dict[int, int]) -> list[tuple[int, int]]:
    """Edges that join ``others`` to the homes they match; ``parent`` (a union-find over homes) skips known ones."""
    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    edges = []
    step = max(1, 4_000_000 // len(homes))
    for k in range(0, len(others), step):
        some = others[k:k + step]
        hit, which = np.nonzero(np.bitwise_count(some[:, None] ^ homes[None, :]) <= threshold)
        row = first = -1
        for r, h in zip(hit.tolist(), homes[which].tolist(), strict=True):
            fp = int(some[r])
            if fp == h:
                continue
            if fp not in parent and r != row:  # the row's first home; others are joined to it
                row, first = r, h
                edges.append((fp, h))
                continue
            a, b = (fp, h) if fp in parent else (first, h)
            top, other = root(a), root(b)
            if top != other:
                parent[other] = top
                edges.append((fp, h))
    return edges


def _compare(threshold: int):
    """Edges of every (anchor, block, part) of rows sorted by it, homes first; holds one block's homes and one batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, homes, parent = None, np.zeros(0, dtype=np.uint64), {}
        for batch in batches:
            key = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)], axis=1)
            fp = batch.column(3).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            is_home = batch.column(4).to_numpy(zero_copy_only=False).astype(bool)
            firsts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)]))
            edges = []
            for a, b in zip(firsts.tolist(), [*firsts.tolist()[1:], len(fp)], strict=True):
                now = tuple(key[a].tolist())
                if now != cell:
                    cell, homes, parent = now, np.zeros(0, dtype=np.uint64), {}
                own = fp[a:b][is_home[a:b]]
                if len(own):
                    homes = np.concatenate([homes, own])
                    parent.update((int(x), int(x)) for x in own.tolist())
                others = fp[a:b][~is_home[a:b]]
                if len(homes) and len(others):
                    edges += _match(homes, others, threshold, parent)
            if edges:
                both = np.array(edges, dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_pydict({"a": both[:, 0], "b": both[:, 1]})

    return run


def _place(threshold: int, replicas: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for k in range(0, len(every), 2000):
                fp = every[k:k + 2000]
                if replicas:
                    _, row, anchor = anchors(fp, threshold)
                    yield pa.RecordBatch.from_pydict({"anchor": anchor, "fp": fp[row]})
                else:
                    yield pa.RecordBatch.from_pydict({"anchor": home_anchor(fp), "fp": fp})

    return run


def links(distinct: DataFrame, threshold: int = 2) -> DataFrame:
    """Edges (``a``, ``b``) between distinct fingerprints ``fp`` whose components are those of all links."""
    schema = "anchor bigint, fp bigint"
    homes = shared.map_arrow(distinct.select("fp"), _place(threshold, False), schema)
    crowd = homes.groupBy("anchor").agg(F.count("*").alias("n_homes"))
    # Most anchors are nobody's home: the join drops their replicas.  Replicas are many beside the anchors that are
    # homes, and a cluster's meet at the same ones, so each anchor is dealt over several tasks.
    salted = crowd.select("anchor", F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")).alias("salt"))
    replicas = (shared.map_arrow(distinct.select("fp"), _place(threshold, True), schema)
                .withColumn("salt", F.expr(f"pmod(xxhash64(fp), {SALTS}L)")).join(salted, ["anchor", "salt"]))
    met = shared.cut(replicas.select("anchor", "fp", F.lit(False).alias("home"))
                     .unionByName(homes.withColumn("home", F.lit(True))))
    grid = shared.cut(met.groupBy("anchor").agg(F.count("*").alias("n"), F.sum(F.col("home").cast("int")).alias("n_homes"))
                      .where("n > 1").select("anchor", F.expr(f"(n_homes - 1) div {BLOCK} + 1").alias("blocks"),
                                             F.expr(f"(n - 1) div {PART} + 1").alias("parts"), "n"))
    dealt = shared.join_hot(met, grid, "anchor", "n", met.count()).withColumn("h", F.xxhash64("fp"))
    # A home goes to its own block of every part, every row (homes too) to its own part of every block.
    as_home = (dealt.where("home").select("anchor", F.expr("pmod(h, blocks)").alias("block"),
                                          F.explode(F.expr("sequence(0L, parts - 1)")).alias("part"), "fp",
                                          F.lit(1).alias("home")))
    as_other = dealt.select("anchor", F.explode(F.expr("sequence(0L, blocks - 1)")).alias("block"),
                            F.expr("pmod(shiftright(h, 20), parts)").alias("part"), "fp", F.lit(0).alias("home"))
    cells = as_home.unionByName(as_other).repartition("anchor", "block", "part")
    ordered = cells.sortWithinPartitions("anchor", "block", "part", F.desc("home"))
    return shared.map_arrow(ordered, _compare(threshold), "a bigint, b bigint")


def _hex(fp: str):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_duplicates(docs: DataFrame, words: int = 3, seed: int = 42, threshold: int = 2,
                    keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per row: the ``keep`` columns, ``fingerprint`` (16 hex digits), ``component_id`` and ``component_fingerprint``.

    ``component_id`` is the smallest ``doc_id`` reachable by links; the component's
    fingerprint (one of its own) names it where there is no id.
    """
    fps = shared.cut(fingerprints(docs, keep, words, seed))
    least = shared.cut(fps.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    stars = components.stars(links(least.select("fp"), threshold))
    # Fingerprints in links only: few beside the rows.
    tops = shared.cut(stars.join(least, stars["node"] == least["fp"]).groupBy("root")
                      .agg(F.min("least").alias("top"), F.count("*").alias("n")))
    linked = (shared.join_hot(stars, tops, "root", "n", tops.agg(F.sum("n")).first()[0] or 0)
              .select(F.col("node").alias("fp"), "root", "top"))
    labels = shared.cut(least.join(linked, "fp", "left").select(
        "fp", "n", F.coalesce("top", "least").alias("component_id"), F.coalesce("root", "fp").alias("root")))
    some = shared.join_hot(fps, labels, "fp", "n", least.agg(F.sum("n")).first()[0] or 0)
    return some.select(*keep, _hex("fp").alias("fingerprint"), "component_id", _hex("root").alias("component_fingerprint"))
