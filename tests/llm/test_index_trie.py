"""Positional index, ranked search and prefix trie against brute force over small hard tables."""

import hashlib
import math
import random
import re
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from snapmart.llm import positional_index, prefix_trie, ranked_search, term_segments

from . import data

LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORDS = ["a", "The", "b2", "né", "你好", "x", "of", "And", "zz", "q7"]
ITEM = "item_id bigint, text string"
DOC = "doc_id bigint, text string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def key(row):
    return str(row)


def plain_contamination(docs, items, window=10):
    owners = defaultdict(set)
    for i, t in items:
        w = words(t)
        for a in range(max(1, len(w) - window + 1) if w else 0):
            owners[tuple(w[a:a + window])].add("" if i is None else str(i))
    out = []
    for d, t in docs:
        w = words(t)
        hit, found = [0] * len(w), set()
        for n in {len(k) for k in owners}:
            for a in range(len(w) - n + 1):
                if tuple(w[a:a + n]) in owners:
                    found |= owners[tuple(w[a:a + n])]
                    hit[a:a + n] = [1] * n
        out.append((d, len(w), sum(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), any(hit)))
    return sorted(out, key=key)


def plain_near(docs, items):
    texts = [words(t) for _, t in docs]
    counts = Counter(w for t in texts for w in t)
    out = []
    for t in texts:
        near = set()
        for i, q in items:
            q = words(q)
            if not q:
                continue
            rare = min(q, key=lambda x: (counts[x], x.encode()))
            spans = [t[max(0, p - 2 * len(q)):p + 2 * len(q) + 1] for p, x in enumerate(t) if x == rare]
            if any(set(q) <= set(s) for s in spans):
                near.add("" if i is None else str(i))
        out.append(len(near))
    return out


def plain_search(docs, items, top=10):
    texts = [Counter(words(t)) for _, t in docs]
    sizes = [sum(c.values()) for c in texts]
    n, length = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(w for c in texts for w in c)
    out = []
    for i, t in items:
        scores = []
        for (d, _), c, size in zip(docs, texts, sizes):
            s = 0
            for w, times in Counter(words(t)).items():
                if c[w]:
                    weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1)))
                    s += times * weight * (10 ** 9 * c[w] // (1000 * c[w] + 8 * (25 + 75 * size * n // length)))
            if s:
                scores.append((-s, d is None, d or 0, d))
        out += [(i, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:top])]
    return sorted(out, key=key)


def hard_tables(rng):
    docs = [(rng.choice([None, 1, 2, 3, i]), rng.choice([None, "", " ", "..."]) if rng.random() < .1
             else rng.choice([" ", "-", "\n"]).join(rng.choice(WORDS) for _ in range(rng.randint(1, 200)))) for i in range(60)]
    docs += docs[:4] + [(500, "the " * 3000)]
    items = [(rng.choice([None, 7, i]), " ".join(rng.choice(WORDS) for _ in range(rng.choice([0, 1, 3, 5, 10, 12])))) for i in range(30)]
    return docs, [*items, (99, docs[0][1]), (100, None), (101, "word that no document has"), (102, "The the THE")]


def test_codes_equal_a_plain_split():
    rng = random.Random(5)
    signs = ["a", "Z", "é", "你", "\x00", " ", "_", "{", "`", "@", "0", "\x7f", "\x80", "-", "🙂"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 12))) for _ in range(2000)]
    coded = term_segments.code(pa.array(["skipped", *texts], pa.string()).slice(1))
    got = [[coded.terms[c].as_py().decode() for c in coded.codes[a:b]] for a, b in zip(coded.first[:-1], coded.first[1:], strict=True)]
    assert got == [words(t) for t in texts]
    assert len(term_segments.code(pa.array([], pa.string())).codes) == 0


@pytest.mark.parametrize("segment, block", [(4_000_000, 2_000_000), (300, 2_000_000), (300, 150)])
def test_index_and_search_equal_brute_force(spark, monkeypatch, segment, block):
    monkeypatch.setattr(term_segments, "SEGMENT", segment)
    docs, items = hard_tables(random.Random(segment))
    d = data.with_clashes(spark.createDataFrame(docs, DOC))
    i = data.with_clashes(spark.createDataFrame(items, ITEM))
    got = [tuple(r) for r in positional_index.contamination(d, i, block_words=block).collect()]
    assert sorted((r[:6] for r in got), key=key) == plain_contamination(docs, items)
    assert sorted((r[0] is None, r[0] or 0, r[1], r[6]) for r in got) == sorted(
        (x is None, x or 0, len(words(t)), n) for (x, t), n in zip(docs, plain_near(docs, items), strict=True))
    found = ranked_search.search(d, i, block_words=block)
    assert sorted((tuple(r) for r in found.collect()), key=key) == plain_search(docs, items)


def test_empty_tables(spark):
    none_d, none_i = spark.createDataFrame([], DOC), spark.createDataFrame([], ITEM)
    docs, items = spark.createDataFrame([(1, "one two")], DOC), spark.createDataFrame([(1, "one two")], ITEM)
    assert positional_index.contamination(none_d, items).collect() == ranked_search.search(none_d, items).collect() == []
    assert ranked_search.search(docs, none_i).collect() == []
    assert [tuple(r)[:4] for r in positional_index.contamination(docs, none_i).collect()] == [(1, 2, 0, 0)]
    assert prefix_trie.trie(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).collect() == []


def test_stopping_accumulators_keeps_the_best():
    rng = random.Random(8)
    for _ in range(300):
        n, k = rng.randint(1, 60), rng.randint(1, 6)
        lists = []
        for _ in range(rng.randint(1, 6)):
            docs = np.array(sorted(rng.sample(range(n), rng.randint(1, n))))
            gain = np.array([rng.randint(0, 5) for _ in docs])
            lists.append((docs, gain, int(gain.max())))
        scores = [0] * n
        for docs, gain, _ in lists:
            for d, g in zip(docs.tolist(), gain.tolist()):
                scores[d] += g
        ids = [rng.choice([None, rng.randint(0, 9)]) for _ in range(n)]
        floor = rng.choice([1, 1, 4])
        want = sorted(((s, ids[d] is None, ids[d] or 0) for d, s in enumerate(scores) if s >= floor), key=lambda x: (-x[0], x[1:]))[:k]
        got = ranked_search.best_of(ids, lists, n, k, floor)
        assert [(s, ids[d] is None, ids[d] or 0) for s, d in got] == want


def plain_trie(rows):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            convs[c].append((t is not None, t or 0, r or "", x or ""))
    convs = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in convs.items()}
    rebuilt = {}
    for c, v in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(convs.get(c - c % 20, [])[:h] + v[h:])
    members, children, saved, leaves = defaultdict(list), Counter(), Counter(), Counter()
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            members[rebuilt[c][:d]].append(c)
    for s in members:
        if s:
            children[s[:-1]] += 1
    for s, m in members.items():
        v = (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", s[-1][1])) if s else 0
        for d in range(len(s) + 1):
            saved[s[:d]] += v
            leaves[s[:d]] += not children[s]
    out = []
    for s, m in members.items():
        ends = ",".join(str(c) for c in m if len(rebuilt[c]) == len(s))
        out.append((m[0], len(s), members[s[:-1]][0] if s else None, len(m), children[s], leaves[s], saved[s], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=key)


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(prefix_trie, "BLOCK_BITS", 2)
    rng = random.Random(seed)
    rows = []
    for c in range(90):
        if rng.random() < 0.2:
            continue
        for t in range(400 if c == 47 else rng.choice([1, 2, 3, 5, 9])):  # one conversation lies in many partitions
            rows.append((c, None if rng.random() < 0.1 else t, rng.choice(["user", None, "a"]), rng.choice(["x y", None, "hello there", "", "z " * 50])))
    rows += [(None, 1, "user", "t"), *rows[:3]]
    rows += [(c, 0, "user", "hot") for c in range(1000, 1060)]  # one turn or none, in a family without its first conversation
    df = data.with_clashes(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    assert sorted((tuple(r) for r in prefix_trie.trie(df).collect()), key=key) == plain_trie(rows)
