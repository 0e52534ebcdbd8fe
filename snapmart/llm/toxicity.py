"""Toxicity by compression distance: one zstandard dictionary of toxic and one of ordinary text.

A window is a word with the white space around it, and beside it every two and three
words in a row that are a learnt phrase (other rows of words hold nothing toxic that their
words do not).  Where there are no spaces - scripts written without them, and any run of
letters over ``LONG`` - windows are overlapping stretches of characters.  A window is
compressed with the ordinary dictionary and with both: the difference of the two lengths is
what the toxic one saves, whatever the ordinary one makes of the rest of the window.  Case is folded in all scripts.  A
document is scored from its largest differences and from how many windows exceed
each of a few thresholds, by a logistic curve calibrated on labelled documents that
the dictionaries have not seen.

Characters are written as two-byte codes before compression: a match then saves
several bytes, where on single bytes it barely pays for its own description (four
to six characters against about three bytes) and most differences round to zero.  A
short run of zeros before the window keeps the library from storing it raw, which
would round small differences away as well.

The ordinary dictionary holds the words that most ordinary documents share.  The
toxic one holds what toxic documents have and ordinary ones lack - beginnings of words,
whole short words, character runs inside words, phrases -, chosen to cover every toxic
document a few times; beginnings are lengthened while nearly all of their words go on
alike.  Frequency alone, as in zstandard's own trainer, fills both dictionaries with the
words common to both.

Counting is distributed; what reaches the driver is bounded by the stated sample and
candidate limits.  All documents are scored, each by its whole text.

Defined cases: a null or empty text has no windows and gets the lowest score of the
curve; without labels of both kinds every score is 0; repeated rows repeat their
score; an empty table gives no rows.
"""

from __future__ import annotations

import warnings
import random
import re
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import labelled, shared

#: Most labelled documents of either kind; half of them fit the dictionaries, half calibrate.
TOXIC, ORDINARY = 4000, 8000
#: Most toxic candidates of one sort considered, and words of the ordinary dictionary.
CANDIDATES, COMMON = 20_000, 6000
#: A candidate is toxic if its share of toxic documents is this many times that of ordinary ones.
LIFT = 6
#: Ordinary documents added to the count of a run or phrase (none among n leaves up to 3 in n by the rule of three).
UNSEEN = 3
#: Times that each toxic document is to be covered.
COVER = 8
LEVEL = 12
REJECT = 0.3

#: Thresholds on a window's difference (bytes), and those also counted as a share of the windows.
STEPS, SHARES = (2, 3, 4, 5, 6, 8), (3, 4, 5)

_PAD = bytes(16)
_WIDE = [random.Random(b).randbytes(2) for b in range(256)]


#: Letters of a run without spaces from which it is cut into stretches of ``STRETCH`` letters, half of them new.
LONG, STRETCH = 32, 24
#: Scripts without spaces (Thai to Khmer, kana, Han); their stretches have ``FEW`` characters, two of them new.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]+")
FEW = 6


def _stretches(run: str, size: int, step: int) -> list[str]:
    return [run[k:k + size] for k in range(0, max(1, len(run) - size + step), step)]


def words_of(text: str) -> list[bytes]:
    """The words in order, folded; a run without spaces gives its overlapping stretches."""
    text = text.casefold()
    words = text.split()
    unspaced = not text.isascii() and _UNSPACED.search(text) is not None
    if unspaced or (words and max(map(len, words)) > LONG):
        out = []
        for w in words:
            at = 0
            for m in _UNSPACED.finditer(w) if unspaced else ():
                out += _stretches(w[at:m.start()], STRETCH, STRETCH // 2) if m.start() - at > LONG else [w[at:m.start()]]
                out += _stretches(m[0], FEW, 2)
                at = m.end()
            out += _stretches(w[at:], STRETCH, STRETCH // 2) if len(w) - at > LONG else [w[at:]]
        words = [w for w in out if w]
    return "\n".join(words).encode().split(b"\n") if words else []


def phrases_of(words: list[bytes], known: frozenset[bytes] | None = None, firsts: frozenset[bytes] = frozenset()) -> list[bytes]:
    """Every two and three words in a row; with ``known`` those among them, which begin with one of ``firsts``."""
    starts = range(len(words) - 1) if known is None else [k for k, w in enumerate(words) if w in firsts]
    rows = (b" ".join(words[k:k + n]) for k in starts for n in (2, 3) if k + n <= len(words))
    return [r for r in rows if known is None or r in known]


def wide(raw: bytes) -> bytes:
    return b"".join([_WIDE[c] for c in raw])


def beginnings(word: bytes, least: int = 4, most: int = 12) -> list[bytes]:
    return [word[:k] for k in range(least, min(len(word), most) + 1)]


def inside(word: bytes, least: int = 5, most: int = 8) -> list[bytes]:
    """The runs of characters behind the first one; of a script without spaces all of one to five characters."""
    if word.isascii():
        return [word[a:b] for a in range(1, len(word) - least + 1) for b in range(a + least, min(len(word), a + most) + 1)]
    text = word.decode()
    if _UNSPACED.match(text):
        return [text[a:b].encode() for a in range(len(text)) for b in range(a + 1, min(len(text), a + 5) + 1)]
    return [text[a:b].encode() for a in range(1, len(text) - least + 1) for b in range(a + least, min(len(text), a + most) + 1)]


def candidates_of(words: list[bytes]) -> set[bytes]:
    """What the toxic dictionary may hold of a text: `` beginning``, `` short ``, ``inside`` and `` phrase of words ``."""
    some = set(words)
    out = {b" " + g for w in some for g in beginnings(w)}
    out.update(b" " + w + b" " for w in some if len(w) < 4)
    out.update(g for w in some for g in inside(w))
    out.update(b" " + r + b" " for r in phrases_of(words))
    return out


def _sort(gram: bytes) -> int:
    """0 a beginning or short word, 1 inside words, 2 a phrase."""
    return 1 if gram[:1] != b" " else 2 if b" " in gram[1:-1] else 0


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    weights: tuple[float, ...]
    bias: float
    phrases: frozenset[bytes] = frozenset()


def _meter(toxic: bytes, ordinary: bytes):
    """(window -> difference of compressed lengths, cache) of a pair of dictionaries."""
    import zstandard

    def compressor(content: bytes):
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(dict_data=held, level=LEVEL, write_checksum=False, write_content_size=False,
                                        write_dict_id=False)

    a, b = compressor(ordinary), compressor(ordinary + toxic)

    def difference(word: bytes) -> int:
        window = _PAD + wide(b" " + word + b" ")
        return len(a.compress(window)) - len(b.compress(window))

    return difference, shared.TwoGenerationCache(300_000)


def features(texts: list[str], toxic: bytes, ordinary: bytes, phrases: frozenset[bytes] = frozenset()) -> list[list[float]]:
    difference, cache = shared.resident(("toxicity", toxic, ordinary), lambda: _meter(toxic, ordinary))
    parts = [words_of(t) for t in texts]
    if phrases:
        firsts = frozenset(r.split(b" ", 1)[0] for r in phrases)
        parts = [some + phrases_of(some, phrases, firsts) for some in parts]
    table, missing = cache.take(set().union(*parts))
    new = {w: difference(w) for w in missing}
    cache.put({w: d for w, d in new.items() if len(w) <= 64})
    table.update(new)
    out = []
    for some in parts:
        d = np.array([table[w] for w in some], dtype=np.int64)
        top = np.sort(d)[-3:]
        best = np.concatenate([np.zeros(3 - len(top), dtype=np.int64), top]).clip(0)
        over = [int((d >= k).sum()) for k in STEPS]
        out.append([min(12, int(best[-1])), best.mean(), *np.log1p(over),
                    *[np.sqrt(over[STEPS.index(k)] / max(1, len(d))) for k in SHARES]])
    return out


def measured(docs: DataFrame, toxic: bytes, ordinary: bytes, phrases: frozenset[bytes] = frozenset()) -> DataFrame:
    """``doc_id`` and ``x`` (the features) of every row."""
    def rows(batches):
        for ids, texts in batches:
            yield {"doc_id": ids, "x": features(texts, toxic, ordinary, phrases)}

    return shared.text_map(docs, rows, "doc_id bigint, x array<double>")


def _counts(texts: DataFrame) -> DataFrame:
    """Toxic (``t``) and ordinary (``o``) documents by toxic candidate (``kind`` 0) and by whole word (1)."""
    schema = "kind int, gram binary, t bigint, o bigint"

    def run(batches):
        for b in (some.slice(k, 200) for some in batches for k in range(0, some.num_rows, 200)):
            found = {(k, y): Counter() for k in (0, 1) for y in (0, 1)}
            for y, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words = words_of(text)
                found[0, y].update(candidates_of(words))
                found[1, y].update(set(words))
            for kind in (0, 1):
                grams = list(found[kind, 0].keys() | found[kind, 1].keys())
                yield pa.RecordBatch.from_pydict(
                    {"kind": [kind] * len(grams), "gram": grams, "t": [found[kind, 1][g] for g in grams],
                     "o": [found[kind, 0][g] for g in grams]},
                    schema=pa.schema([("kind", pa.int32()), ("gram", pa.binary()), ("t", pa.int64()), ("o", pa.int64())]))

    parts = shared.map_arrow(texts.select("y", "text"), run, schema)
    return parts.groupBy("kind", "gram").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))


def _lengthened(start: bytes, toxic: dict[bytes, int]) -> bytes:
    """The longest beginning that still has nine tenths of the documents of the one before (other sorts as they are)."""
    while _sort(start) == 0 and start[-1:] != b" ":
        longer = max((g for g in toxic if len(g) == len(start) + 1 and g.startswith(start) and _sort(g) == 0),
                     key=lambda g: (toxic[g], g), default=None)
        if longer is None or toxic[longer] < 0.9 * toxic[start]:
            return start
        start = longer
    return start


def _covering(texts: DataFrame, toxic: dict[bytes, int], least: int) -> list[bytes]:
    """Candidates that cover each toxic document ``COVER`` times, the most useful (then the shortest) first.

    ``toxic`` has the candidates with their numbers of toxic documents.
    """
    known = set(toxic)

    def run(batches):
        for b in batches:
            hits = [sorted(candidates_of(words_of(t)) & known) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_pydict({"hits": hits}, schema=pa.schema([("hits", pa.list_(pa.binary()))]))

    rows = [[bytes(g) for g in r["hits"]] for r in shared.map_arrow(texts.select("text"), run, "hits array<binary>").collect()]
    where: dict[bytes, set[int]] = defaultdict(set)
    for i, hits in enumerate(rows):
        for g in hits:
            where[g].add(i)
    need, picked = [COVER] * len(rows), []
    live = dict(where)
    while live:
        best = min(live, key=lambda g: (-len(live[g]), len(g), g))
        if len(live[best]) < least:
            break
        picked.append(best)
        done = set()
        for i in live.pop(best):
            need[i] -= 1
            if not need[i]:
                done.add(i)
        if done:
            for g in {g for i in done for g in rows[i]} & live.keys():
                live[g] = live[g] - done
    return [_lengthened(g, toxic) for g in picked if not any(g != p and p in g for p in picked)]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.c_[(x - mean) / spread, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    keep = ridge * np.r_[np.ones(len(w) - 1), 1e-6]
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(keep), z.T @ (p - y) + keep * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    weights = w[:-1] / spread
    return weights, float(w[-1] - weights @ mean)


def train(docs: DataFrame, labels: DataFrame, toxic: int = TOXIC, ordinary: int = ORDINARY) -> Model | None:
    """Dictionaries and calibration from at most ``toxic`` and ``ordinary`` labelled documents; None without both."""
    learn = shared.cut(labelled.learn_labels(labels, "toxic", docs))
    texts = shared.cut(labelled.with_text(docs, labelled.sample(learn, toxic, ordinary), toxic + ordinary))
    n = {(r["half"], r["y"]): r["n"] for r in texts.groupBy("half", "y").agg(F.count("*").alias("n")).collect()}
    if not (n.get((0, 1)) and n.get((0, 0))):
        warnings.warn("too few documents are labelled toxic or ordinary: none will be marked", stacklevel=2)
        return None
    fit = texts.where("half = 0")
    n_toxic, n_ordinary = n[0, 1], n[0, 0]
    least = max(2, round(0.005 * n_toxic))
    counts = shared.cut(_counts(fit))
    rare = counts.where((F.col("kind") == 0) & (F.col("t") >= least)
                        & (F.col("o") * n_toxic * LIFT <= F.col("t") * n_ordinary))
    candidates: dict[bytes, int] = {}
    inner, phrase = ~F.col("gram").startswith(F.lit(b" ")), F.expr("gram rlike '^ [^ ]+ [^ ]'")
    # Runs and phrases are many, and most are rare by chance: up to UNSEEN more ordinary documents may have them.
    sure = (F.col("o") + UNSEEN) * n_toxic * LIFT <= F.col("t") * n_ordinary
    for sort in (~inner & ~phrase, inner & sure, phrase & sure):
        some = rare.where(sort).orderBy(F.desc("t"), "gram").limit(CANDIDATES).collect()
        candidates |= {bytes(r["gram"]): r["t"] for r in some}
    common = [bytes(r["gram"]) for r in counts.where("kind = 1 and o > 0").orderBy(F.desc("o"), "gram").limit(COMMON).collect()]
    picked = _covering(fit.where("y = 1"), candidates, least)
    if not picked:
        warnings.warn("nothing tells toxic documents from ordinary ones: none will be marked", stacklevel=2)
        return None
    # What a dictionary holds last is nearest and cheapest to name: the most useful entries go there.
    bad = wide(b"".join([p if p[:1] == b" " else b"\0" + p for p in reversed(picked)]) + b" ")
    phrases = frozenset(p[1:-1] for p in picked if _sort(p) == 2)
    good = wide(b" " + b" ".join(reversed(common)) + b" ")
    halves = texts.where("half = 1") if n.get((1, 1)) and n.get((1, 0)) else texts
    seen = {r["doc_id"]: r["y"] for r in halves.select("doc_id", "y").collect()}
    rows = measured(halves, bad, good, phrases).collect()
    weights, bias = _logistic(np.array([r["x"] for r in rows]), np.array([seen[r["doc_id"]] for r in rows], dtype=float))
    return Model(bad, good, tuple(map(float, weights)), bias, phrases)


def _score(model: Model, x: str):
    z = sum((F.get(x, k) * w for k, w in enumerate(model.weights)), F.lit(model.bias))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))


def judge(docs: DataFrame, model: Model | None, name: str = "_toxicity") -> DataFrame:
    """All rows and columns of ``docs`` with the score as column ``name``."""
    if model is None:
        return docs.withColumn(name, F.lit(0.0))
    toxic, ordinary, phrases = model.toxic, model.ordinary, model.phrases
    found = shared.text_append(docs, lambda texts: features(texts, toxic, ordinary, phrases), "_measured", "array<double>")
    return found.withColumn(name, _score(model, "_measured")).drop("_measured")


def classify(docs: DataFrame, model: Model | None) -> DataFrame:
    """Per row: ``doc_id, held_out, score, predicted``."""
    scored = judge(shared.doc_text(docs), model, "score").select("doc_id", "score")
    return scored.select("doc_id", shared.held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= REJECT).cast("int").alias("predicted"))
