import random
import zlib

import numpy as np
import pytest

from snapmart.llm import labelled, quality_pu, shared, toxicity

from . import data


def corpus(spark, n=700, seed=1):
    """Ordinary, junk and toxic documents with labels; a bad word stands anywhere in a toxic one."""
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(data.WORDS) + rng.choice(["", "s", "ly", "ing"]) for _ in range(rng.randint(30, 200))]
        toxic, junk = rng.random() < 0.25, rng.random() < 0.2
        if toxic:
            for _ in range(rng.randint(1, 3)):
                words[rng.randrange(len(words))] = rng.choice(["dreckwort", "schurkig", "vermaldeit"]) + rng.choice(["", "en", "es"])
        if junk:
            words = [w + rng.choice(["###", "$$$", "%%%"]) for w in words]
        docs.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, int(not junk), int(toxic)))
    return (spark.createDataFrame(docs, data.DOCS), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
            {i: (q, t) for i, q, t in labels})


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_held_out_rows_and_samples(spark):
    _, labels, truth = corpus(spark)
    learn = labelled.learn_labels(labels, "toxic")
    assert {r["doc_id"]: r["y"] for r in learn.collect()} == {i: t for i, (_, t) in truth.items() if not held(i)}
    some = labelled.sample(learn, 20, 30).collect()
    assert sum(r["y"] for r in some) == 20 and len(some) == 50
    assert sorted(map(tuple, some)) == sorted(map(tuple, labelled.sample(learn.repartition(3), 20, 30).collect()))


def accuracy(rows, truth, at):
    out = [(r["predicted"] == truth[r["doc_id"]][at]) for r in rows if r["held_out"]]
    assert all(r["held_out"] == held(r["doc_id"]) for r in rows) and len(out) > 100
    return np.mean(out)


def test_quality_on_held_out_rows(spark):
    docs, labels, truth = corpus(spark)
    model = quality_pu.train(docs, labels)
    rows = quality_pu.classify(docs, model).collect()
    assert accuracy(rows, truth, 0) >= 0.97 and all(0 <= r["score"] <= 1 for r in rows)


def test_quality_ignores_negatives_and_held_out_labels(spark):
    docs, labels, _ = corpus(spark, 300)
    from pyspark.sql import functions as F
    flipped = labels.withColumn("quality", F.when(shared.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality_pu.train(docs, labels) == quality_pu.train(docs, flipped)


def plain_fit(x, positive):
    """The fit over rows in memory."""
    mean, spread = x.mean(axis=0), np.sqrt(np.maximum((x * x).mean(axis=0) - x.mean(axis=0) ** 2, 0)) + 1e-6
    z = np.c_[(x - mean) / spread, np.ones(len(x))]

    def sums(w):
        return quality_pu.group_sums(z, positive, w)

    f = z @ quality_pu.tell_apart(sums, z.shape[1])
    prior = min((f >= t).mean() / (f[positive] >= t).mean() for t in np.arange(-20, 20, 0.01) if (f[positive] >= t).mean() >= 0.9)
    w, negative = quality_pu.minimise(sums, z.shape[1], prior)
    return 1 / (1 + np.exp(-z @ w)), prior, negative


def test_fit_equals_a_plain_one_over_all_rows(spark):
    docs, labels, truth = corpus(spark, 500)
    rows = [r for r in docs.collect() if not held(r["doc_id"])]
    x = np.array([quality_pu.measurements(r["text"]) for r in rows])
    want, prior, negative = plain_fit(x, np.array([truth[r["doc_id"]][0] == 1 for r in rows]))
    model = quality_pu.train(docs, labels)
    assert abs(model.prior - prior) < 0.01 and negative >= 0
    assert abs(prior - np.mean([truth[r["doc_id"]][0] for r in rows])) < 0.1
    got = {r["doc_id"]: r["score"] for r in quality_pu.classify(docs, model).collect()}
    assert max(abs(got[r["doc_id"]] - w) for r, w in zip(rows, want, strict=True)) < 0.02


def test_risk_on_negatives_stays_above_zero_and_the_prior_is_found():
    rng = np.random.default_rng(1)
    for share in (0.3, 0.75):
        n = int(4000 * share)
        x = np.concatenate([rng.standard_normal((800, 3)) + 2, rng.standard_normal((n, 3)) + 2, rng.standard_normal((4000 - n, 3)) - 2])
        positive = np.arange(len(x)) < 800
        score, prior, negative = plain_fit(x, positive)
        true = (800 + n) / len(x)
        assert negative >= 0 and abs(prior - true) < 0.05
        assert (score[800 + n:] < 0.5).mean() > 0.95 and (score[:800 + n] > 0.5).mean() > 0.95


def test_labels_of_other_ids_change_nothing(spark):
    docs, labels, _ = corpus(spark, 400)
    foreign = spark.range(10_000, 810_000).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS quality", "cast(id % 3 = 0 AS int) AS toxic")
    more = labels.unionByName(foreign)
    assert quality_pu.train(docs, labels) == quality_pu.train(docs, more)
    assert toxicity.train(docs, labels) == toxicity.train(docs, more) is not None


def test_toxicity_on_held_out_rows(spark):
    docs, labels, truth = corpus(spark)
    model = toxicity.train(docs, labels)
    rows = toxicity.classify(docs, model).collect()
    assert accuracy(rows, truth, 1) >= 0.95 and all(0 <= r["score"] <= 1 for r in rows)


def test_hard_rows_and_missing_labels(spark):
    docs, labels, _ = corpus(spark, 300)
    hard = data.with_clashes(data.hard_docs(spark))
    for module, score in ((quality_pu, 1.0), (toxicity, 0.0)):
        model = module.train(docs, labels)
        rows = module.classify(hard, model).collect()
        assert len(rows) == len(data.hard_rows()) and all(r["score"] is not None and 0 <= r["score"] <= 1 for r in rows)
        same = [r["score"] for r in rows if r["doc_id"] == 5]
        assert same[0] == same[1]
        assert module.classify(hard.limit(0), model).count() == 0
        bare = module.train(docs, labels.limit(0))
        assert all(abs(r["score"] - score) < 1e-9 for r in module.classify(hard, bare).collect())
        assert module.train(docs.limit(0), labels) is not False


def test_compression_tells_the_dictionaries_apart():
    good = toxicity.wide(b" " + b" ".join(w.encode() for w in data.WORDS) + b" ")
    bad = toxicity.wide(b" dreckwort schurkig ")
    rows = toxicity.features(["river stone", "a dreckwort here", "", "schurkigen schurkig dreckworts"], bad, good)
    assert rows[0][0] == 0 and rows[2][0] == 0 and rows[1][0] >= 5 and rows[3][3] > rows[1][3]


HAN = [chr(c) for c in range(0x4E00, 0x4E00 + 300)]


def _toxic_words(rng, kind, words):
    """Put what only toxic documents have into a list of ordinary words."""
    at = rng.randrange(1, len(words) - 2)
    if kind == "short":
        words[at] = "zyx"
    elif kind == "phrase":  # either word is ordinary
        words[at:at + 2] = ["river", "stone"]
    elif kind == "compound":
        words[at] = rng.choice(["haupt", "ober", "nach", "gross", "neben", "unter"]) + "dreckwort" + rng.choice(["chen", "lich", "schaft"])
    elif kind == "capitals":
        words[at] = rng.choice(["ärgerübel", "ÄRGERÜBEL", "Ärgerübel"])


@pytest.mark.parametrize("kind", ["short", "phrase", "compound", "capitals", "unspaced"])
def test_toxicity_sees_all_sorts_of_words(spark, kind):
    rng = random.Random(3)
    docs, labels, truth = [], [], {}
    for i in range(600):
        toxic = rng.random() < 0.3
        if kind == "unspaced":  # a text is one word; what is toxic stands anywhere in it
            some = rng.choices(HAN, k=rng.randint(60, 200))
            if toxic:
                some[rng.randrange(20, 50)] = "\u9f8d\u9f9c\u9f8e"
            text = "".join(some)
        else:
            some = [rng.choice(data.WORDS) + rng.choice(["", "s", "ly", "ing"]) for _ in range(rng.randint(30, 100))]
            while kind == "phrase" and any(p == ("river", "stone") for p in zip(some, some[1:])):
                rng.shuffle(some)
            if toxic:
                _toxic_words(rng, kind, some)
            text = " ".join(some)
        docs.append((i, text, "en", "s", 0))
        labels.append((i, 1, int(toxic)))
        truth[i] = (1, int(toxic))
    docs = spark.createDataFrame(docs, data.DOCS)
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    rows = toxicity.classify(docs, model).collect()
    assert accuracy(rows, truth, 1) >= 0.95
    caught = [r["predicted"] for r in rows if r["held_out"] and truth[r["doc_id"]][1]]
    assert len(caught) > 20 and np.mean(caught) >= 0.9


def test_windows_of_runs_without_spaces_overlap():
    text = "".join(HAN[:41]) + "abc " + "x" * 10 + "".join(map(chr, range(97, 123))) * 4
    words = [w.decode() for w in toxicity.words_of(text)]
    for size, run in ((5, text[:41]), (13, text.split()[1])):
        for k in range(len(run) - size + 1):
            assert any(run[k:k + size] in w for w in words)
    assert "abc" in words and toxicity.words_of("GRÖSSE\u3000Ça") == ["grösse".encode(), "ça".encode()]
