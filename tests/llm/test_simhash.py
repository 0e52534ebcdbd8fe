import random

import numpy as np
import xxhash

from snapmart.llm import components, simhash

from . import data


def plain_fingerprint(text, words=3, seed=42):
    parts = text.encode().lower().split()
    if not parts:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(parts[i:i + words]), seed) for i in range(max(1, len(parts) - words + 1))]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(fps, ids, threshold=2):
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    values = np.array(fps, dtype=np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1:] ^ values[i]) <= threshold):
            a, b = root(i), root(i + 1 + int(j))
            parent[max(a, b)] = min(a, b)
    least = {}
    for i, x in enumerate(ids):
        r = root(i)
        if x is not None:
            least[r] = min(x, least.get(r, x))
    return [least.get(root(i)) for i in range(len(fps))]


def test_code_is_perfect():
    leaders, code = simhash._code()
    weights = np.bincount(np.bitwise_count(code).astype(int), minlength=24)
    assert len(code) == 4096 and weights[7] == 253 and weights[1:7].sum() == 0
    x = np.random.default_rng(1).integers(0, 1 << 23, 2000)
    assert np.bitwise_count(x ^ simhash.home_words(x)).max() <= 3
    assert not simhash._syndrome(simhash.home_words(x)).any()


def test_a_replica_meets_every_home_within_the_threshold():
    rng = random.Random(2)
    for threshold in (0, 1, 2, 3):
        for _ in range(60):
            x = rng.getrandbits(64)
            y = x
            for b in rng.sample(range(64), rng.randint(0, threshold)):
                y ^= 1 << b
            both = np.array([x, y], dtype=np.uint64).view(np.int64)
            home, row, anchor = simhash.anchors(both, threshold)
            assert home[0] == home[1] or home[0] in anchor[row == 1]
            assert len(set(zip(row.tolist(), anchor.tolist()))) == len(row) and not (anchor == home[row]).any()


def texts(rng, n):
    out = []
    for _ in range(n):
        if out and rng.random() < 0.6:
            words = rng.choice(out).split(" ")
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(len(words))] = rng.choice(data.WORDS)
            out.append(" ".join(words))
        else:
            out.append(data.sentence(rng, rng.choice((2, 5, 40, 150))))
    return out


def test_documents_equal_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, t) for i, t in enumerate(texts(rng, 300))] + [(i and i + 1000, t) for i, t, *_ in data.hard_rows()]
    docs = data.with_clashes(spark.createDataFrame(rows, "doc_id bigint, text string"))
    fps = [plain_fingerprint(t or "") for _, t in rows]
    comp = plain_components(fps, [i for i, _ in rows])
    got = simhash.near_duplicates(docs).collect()
    want = sorted(((i if i is not None else -1), format(f, "016x"), c if c is not None else -1)
                  for (i, _), f, c in zip(rows, fps, comp))
    assert sorted(((r[0] if r[0] is not None else -1), r[1], r[2] if r[2] is not None else -1) for r in got) == want
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_crowded_anchors_split_into_cells_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 3)
    monkeypatch.setattr(simhash, "PART", 5)
    rng = random.Random(9)
    fps = set()
    for _ in range(6):
        base = rng.getrandbits(64)
        for _ in range(25):
            x = base
            for b in rng.sample(range(64), rng.randint(0, 4)):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    distinct = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    edges = simhash.links(distinct, 2)
    for e in edges.collect():
        assert 0 < bin((e["a"] ^ e["b"]) & (1 << 64) - 1).count("1") <= 2
    root = {r["node"]: r["root"] for r in components.stars(edges).collect()}
    want = plain_components(fps, list(range(len(fps))))
    group = {}
    for x, c in zip(signed, want):
        group.setdefault(c, set()).add(root.get(x, x))
    assert all(len(v) == 1 for v in group.values()) and len({next(iter(v)) for v in group.values()}) == len(group)


def test_components_of_paths_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(500, 500)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    root = {r["node"]: r["root"] for r in components.stars(df).collect()}
    assert root == {**{i: 0 for i in range(41)}, **{100 + k: 100 for k in range(30)}}
    assert components.stars(df.limit(0)).count() == 0


def test_components_with_hot_and_other_nodes(spark):
    rng = random.Random(12)
    edges = [(5000, k) for k in range(2000)] + [(k, k + 2000) for k in range(0, 900, 3)]
    edges += [(10_000 + rng.randrange(1500), 10_000 + rng.randrange(1500)) for _ in range(1300)]
    parent = {x: x for e in edges for x in e}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((top(a), top(b)))
        parent[high] = low
    want = {x: top(x) for e in edges if e[0] != e[1] for x in e}
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    assert {r["node"]: r["root"] for r in components.stars(df).collect()} == want


def test_shingles_fold_ascii_only():
    assert simhash.shingle_hashes("A É b", 3, 42) == [xxhash.xxh64_intdigest("a É b".encode(), 42)]
    assert simhash.shingle_hashes("\x1c \x0b", 3, 42) == [xxhash.xxh64_intdigest(b"\x1c", 42)]
