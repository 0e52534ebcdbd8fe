import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from snapmart.llm import ann, packing, shared

from . import data

WORD = shared.vocabulary("word_bpe_49k.json")


def check_sequences(rows, capacity):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def plain_best_fit(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = [g for g in range(len(gaps)) if gaps[g] >= n]
        if fit:
            k = min(fit, key=lambda g: gaps[g])
            gaps[k] -= n
        else:
            gaps.append(capacity - n)
    return Counter(gaps)


@pytest.mark.parametrize("seed", range(8))
def test_sweep_equals_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice((10, 37, 100))
    lengths = [min(capacity, max(1, int(rng.expovariate(3 / capacity)))) for _ in range(rng.randint(0, 400))]
    plan = packing.sweep(Counter(lengths), capacity)
    covered, used = Counter(), {}
    for length, first, n, sequence, offset in plan:
        for i in range(n):
            covered[length, first + i] += 1
            used.setdefault(sequence + i, []).append((offset, length))
    assert covered == Counter({(n, i): 1 for n, c in Counter(lengths).items() for i in range(c)})
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
    assert Counter(capacity - sum(n for _, n in p) for p in used.values()) == plain_best_fit(lengths, capacity)


def test_documents_are_cut_and_packed_whole(spark):
    docs = spark.read.parquet(f"{data.SMALL}/documents.parquet").unionByName(
        data.hard_docs(spark).withColumn("doc_id", F.col("doc_id") + 10_000_000))
    library = Tokenizer.from_file(WORD)
    capacity = 256
    rows = [r.asDict() for r in packing.pack_documents(data.with_clashes(docs).drop("length"), WORD, capacity).collect()]
    want = Counter()
    for d in docs.collect():
        ids = library.encode(d["text"] or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), capacity):
            part = ids[k:k + capacity]
            want[d["doc_id"], k // capacity, k, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    sequences = check_sequences(rows, capacity)
    assert sequences <= 1.02 * sum(r["length"] for r in rows) / capacity + 1
    assert packing.pack_documents(docs.limit(0), WORD, capacity).count() == 0


def vectors(spark, n, dims, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dims)) + rng.standard_normal(dims) * 0.3
    rows = [(i, [float(v) for v in row], 0) for i, row in enumerate(x)]
    return x, rows, spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")


def exact(rows, query, top):
    q = np.array(rows[query], dtype=np.float32).astype(float)
    scored = sorted((-float(np.dot(q, np.array(v, dtype=np.float32).astype(float))), i) for i, v in rows.items() if i != query)
    return [i for _, i in scored[:top]]


def test_recall_order_and_scores(spark, monkeypatch):
    monkeypatch.setattr(ann, "VECTORS", 500)
    monkeypatch.setattr(ann, "QUERIES", 40)
    x, rows, df = vectors(spark, 3000, 24)
    table = {i: v for i, v, _ in rows}
    found = {}
    for r in ann.search(df, F.col("vec_id") % 20 == 0, top=20).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(found) == set(range(0, 3000, 20))
    hits = 0
    for q, some in found.items():
        some.sort()
        assert [r for r, *_ in some] == list(range(1, 21))
        assert [(-s, v) for _, v, s in some] == sorted((-s, v) for _, v, s in some)
        a = np.array(table[q], dtype=np.float32).astype(float)
        for _, v, s in some:
            assert s == pytest.approx(float(np.dot(a, np.array(table[v], dtype=np.float32).astype(float))), abs=1e-12)
        hits += len(set(exact(table, q, 20)) & {v for _, v, _ in some})
    assert hits >= 0.98 * 20 * len(found)


def test_estimates_are_unbiased_with_the_stated_spread():
    rng = np.random.default_rng(3)
    x, q = rng.standard_normal((2000, 64)), rng.standard_normal((20, 64))
    centre = x.mean(axis=0)
    turn = ann.rotation(64, 5)
    assert np.allclose(turn @ turn.T, np.eye(64))
    est, spread = ann.estimate(q, *ann.encode(x, centre, turn), centre, turn)
    z = (est - q @ x.T) / spread
    assert abs(z.mean()) < 0.05 and 0.9 < z.std() < 1.1


@pytest.mark.parametrize("dims", [1, 7, 64, 65, 130])
def test_bit_counts_equal_the_plain_product(dims):
    rng = np.random.default_rng(dims)
    level, bits = rng.integers(0, 16, (37, dims), dtype=np.uint8), rng.integers(0, 2, (50, dims), dtype=np.uint8)
    assert (ann.bit_products(level, ann._words(np.packbits(bits, axis=1))) == level.astype(int) @ bits.T.astype(int)).all()


def test_vectors_are_moved_once_whatever_the_number_of_query_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "VECTORS", 100)
    monkeypatch.setattr(ann, "QUERIES", 10)
    monkeypatch.setattr(ann, "HELD", 8 * 24 * 300)  # three blocks a group
    _, _, df = vectors(spark, 1000, 24)
    found = ann.search(df, F.col("vec_id") % 5 == 0, top=3)
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    got = {}
    for r in found.collect():
        got.setdefault(r["query_id"], []).append(r["rank"])
    assert set(got) == set(range(0, 1000, 5)) and all(sorted(v) == [1, 2, 3] for v in got.values())


def test_ties_repeats_and_rows_that_take_no_part(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, [2.0, 0.0]), (3, [2.0, 0.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]),
            (7, [1.0, None]), (8, [float("inf"), 0.0]), (9, [1.0, 2.0, 3.0]), (None, [5.0, 5.0]), (20, [-1.0, 0.5]), (20, [0.5, 0.5])]
    df = data.with_clashes(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    got = sorted(tuple(r) for r in ann.search(df, F.col("vec_id") % 20 == 0, top=20).collect())
    assert [(q, v, s) for q, _, v, s in got if q == 0] == [(0, 3, 2.0), (0, 3, 2.0), (0, 1, 1.0), (0, 2, 1.0), (0, 20, 0.5), (0, 20, -1.0)]
    assert {v for q, _, v, _ in got if q == 20} == {0, 1, 2, 3}
    assert ann.search(df.where("vec_id = 4"), F.col("vec_id") % 20 == 0).count() == 0
    assert ann.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert ann.search(df.where("vec_id = 0"), F.col("vec_id") % 20 == 0).count() == 0
