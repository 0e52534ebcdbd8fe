"""Benchmark decontamination by a distributed positional inverted index.

``build`` stores, for every segment of the corpus (some MB of whole texts), the posting
list of each term: its positions, ascending, in the segment's numbering, in which every
document is followed by a gap.  With ``only`` the lists of other terms, which no query can
ask for, are left out; all other information is kept.

``search`` answers phrases and proximity from the lists alone.  Terms are counted over the
whole index first.  A window's candidates are the list of its rarest term, moved back by
that term's place in the window; they are intersected with the list of the next rarer
term, moved by its own place, and so on, until none is left or all terms agree: an exact
occurrence.  Nothing is shuffled but the term counts, so neither a common word nor a group
of copies meets in one task.  An item is near where all its terms lie within
``SPAN`` times its length of one occurrence of its rarest term (of equally rare ones the first by name).

Defined cases: a null or empty text has no words and no hits, and gives a row; repeated
rows repeat their result; a text of any length is one document of one segment; a null
``doc_id`` stays; items without words ask for nothing; rows of the benchmark with equal ids
are one item, and a null id counts as the empty one; without items nothing is hit;
without documents there are no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared, term_segments

WINDOW = 10
SPAN = 2
#: Candidates that are intersected at once (a bound on memory only).
AT_ONCE = 1_000_000
_SHIFT = np.int64(1 << 40)

INDEX = "first array<bigint>, terms array<binary>, lists array<bigint>, positions binary"


def _entry(coded: term_segments.Coded, only: pa.Array | None) -> dict:
    at, term, terms = term_segments.known(coded, only)
    doc = np.searchsorted(coded.first, at, side="right") - 1
    order = np.argsort(term, kind="stable")
    return {"first": coded.first + np.arange(len(coded.first)), "terms": terms, "lists": term_segments.lists_of(term, len(terms)),
            "positions": term_segments.packed((at + doc)[order])}


def build(docs: DataFrame, only: pa.Array | None = None) -> DataFrame:
    """The stored index: a row a segment (``first``: where documents begin; ``lists``: where each term's positions begin)."""
    return term_segments.write_index(docs, "positional-index", only, _entry, INDEX)


@dataclass
class Windows:
    """Distinct windows: per row terms and places, rarest first (unused ones -1), and which items have them."""

    terms: np.ndarray
    places: np.ndarray
    sizes: np.ndarray
    items: list[np.ndarray]


def words_of(items: pa.Array) -> tuple[pa.Array, list[np.ndarray]]:
    coded = term_segments.code(items)
    return coded.terms, [coded.codes[a:b] for a, b in zip(coded.first[:-1], coded.first[1:], strict=True)]


def windows_of(words: list[np.ndarray], counts: np.ndarray, window: int = WINDOW) -> Windows:
    """Windows whose terms all occur somewhere, their terms in the order of ``counts``."""
    owners: dict[bytes, set[int]] = {}
    for item, w in enumerate(words):
        w = w.astype(np.int64)
        for a in range(max(1, len(w) - window + 1) if len(w) else 0):
            owners.setdefault(w[a:a + window].tobytes(), set()).add(item)
    rows = [(np.frombuffer(k, np.int64), v) for k, v in owners.items()]
    rows = [(t, v) for t, v in rows if counts[t].all()]
    terms, places = np.full((len(rows), window), -1, np.int64), np.zeros((len(rows), window), np.int64)
    for i, (t, _) in enumerate(rows):
        order = np.argsort(counts[t], kind="stable")
        terms[i, :len(t)], places[i, :len(t)] = t[order], order
    return Windows(terms, places, np.array([len(t) for t, _ in rows], np.int64), [np.array(sorted(v)) for _, v in rows])


def _expand(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the ranges and the places in them: every range (start, size) written out."""
    which = np.repeat(np.arange(len(sizes)), sizes)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes)


def _phrases(windows: Windows, local: np.ndarray, lists: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(window, start) of every occurrence; ``keys`` holds list number and position, sorted."""
    here = np.where(windows.terms >= 0, local[windows.terms], 0)
    alive = np.flatnonzero((here >= 0).all(axis=1))
    if not len(alive):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rare = here[alive, 0]
    sizes = lists[rare + 1] - lists[rare]
    found = []
    cuts = np.searchsorted(np.cumsum(sizes), np.arange(AT_ONCE, int(sizes.sum()) + AT_ONCE, AT_ONCE), side="left") + 1
    a = 0
    for b in np.unique(np.minimum(cuts, len(alive))):
        if b <= a:
            continue
        which, at = _expand(lists[rare[a:b]], sizes[a:b])
        w = alive[a:b][which]
        start = keys[at] % _SHIFT - windows.places[w, 0]
        w, start = w[start >= 0], start[start >= 0]
        for k in range(1, windows.terms.shape[1]):
            if not len(w):
                break
            asked = windows.sizes[w] > k
            key = here[w, k] * _SHIFT + start + windows.places[w, k]
            to = np.searchsorted(keys, key)
            hit = keys[np.minimum(to, len(keys) - 1)] == key
            w, start = w[hit | ~asked], start[hit | ~asked]
        found.append((w, start))
        a = b
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _near(terms: np.ndarray, reach: int, local: np.ndarray, lists: np.ndarray, keys: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Documents (numbers) where all of ``terms`` (rarest first) lie within ``reach`` of an occurrence of the first."""
    here = local[terms]
    if not len(here) or (here < 0).any():
        return np.zeros(0, np.int64)
    at = keys[lists[here[0]]:lists[here[0] + 1]] % _SHIFT
    doc = np.searchsorted(first, at, side="right") - 1
    low, high = np.maximum(at - reach, first[doc]), np.minimum(at + reach, first[doc + 1] - 2)
    for t in here[1:]:
        to = np.searchsorted(keys, t * _SHIFT + low)
        hit = keys[np.minimum(to, len(keys) - 1)] <= t * _SHIFT + high
        hit &= to < len(keys)
        low, high, doc = low[hit], high[hit], doc[hit]
        if not len(doc):
            break
    return np.unique(doc)


RESULT = ("doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, "
          "n_near_items bigint")
_PARTIAL = "segment string, doc int, doc_id bigint, n_words bigint, hits binary, items array<string>, near array<string>"


def _verdict(doc_id, n_words: int, hits: list[bytes], items: set[str], near: set[str]) -> tuple:
    covered = 0
    for h in hits:
        covered |= int.from_bytes(h, "little")
    listed = ",".join(sorted(items))
    return doc_id, n_words, covered.bit_count(), len(items), hashlib.sha256(listed.encode()).hexdigest(), covered > 0, len(near)


def _answer(index: DataFrame, ids: list, texts: pa.Array, window: int, whole: bool) -> DataFrame:
    """Hits of one block of items in every document: results if it is the only block, else what ``_joined`` puts together."""
    terms, words = words_of(texts)
    found = term_segments.term_counts(index, terms, lambda row: np.diff(row["lists"].values.to_numpy()))
    counts = np.zeros(len(terms), np.int64)
    counts[list(found.keys())] = list(found.values())
    windows = windows_of(words, counts, window)
    names = ["" if i is None else str(i) for i in ids]
    near = []
    name = np.argsort(np.argsort(np.array(terms.to_pylist(), object))) if len(terms) else counts
    for item, w in enumerate(words):
        t = np.unique(w)
        if len(t) and counts[t].all():
            near.append((item, t[np.lexsort((name[t], counts[t]))], SPAN * len(w)))
    plan = index.sparkSession.sparkContext.broadcast((terms, windows, names, near))  # a block: its size is bounded
    schema = shared._arrow_schema(RESULT if whole else _PARTIAL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, windows, names, near = plan.value
        for row in term_segments.rows_of(batches):
            first, lists = row["first"].values.to_numpy(), row["lists"].values.to_numpy()
            local = term_segments.local_lists(row["terms"].values, terms)
            keys = term_segments.unpacked(row["positions"].as_py())
            keys = keys + np.repeat(np.arange(len(lists) - 1), np.diff(lists)) * _SHIFT
            w, start = _phrases(windows, local, lists, keys) if len(windows.sizes) else (np.zeros(0, np.int64),) * 2
            step = np.zeros(int(first[-1]) + 1, np.int64)
            np.add.at(step, start, 1)
            np.add.at(step, start + windows.sizes[w], -1)
            covered = np.cumsum(step) > 0
            items: dict[int, set[str]] = {}
            pairs = np.unique(np.stack([np.searchsorted(first, start, side="right") - 1, w]), axis=1) if len(w) else np.zeros((2, 0), np.int64)
            for d, k in pairs.T.tolist():
                items.setdefault(d, set()).update(names[i] for i in windows.items[k].tolist())
            close: dict[int, set[str]] = {}
            for item, t, reach in near:
                for d in _near(t, reach, local, lists, keys, first).tolist():
                    close.setdefault(d, set()).add(names[item])
            ids = row["doc_id"].values.to_pylist()
            out = []
            for d, n in enumerate((np.diff(first) - 1).tolist()):
                hits = [np.packbits(covered[first[d]:first[d] + n], bitorder="little").tobytes()] if d in items else []
                if whole:
                    out.append(_verdict(ids[d], n, hits, items.get(d, set()), close.get(d, set())))
                else:
                    out.append((row["segment"].as_py(), d, ids[d], n, hits[0] if hits else None, sorted(items.get(d, ())), sorted(close.get(d, ()))))
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return shared.map_arrow(index, run, RESULT if whole else _PARTIAL)


def _joined(partial: DataFrame) -> DataFrame:
    """Results of several blocks: a document's bit sets (one a block) joined."""
    each = partial.groupBy("segment", "doc", "doc_id", "n_words").agg(
        F.collect_list("hits").alias("hits"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")).select("doc_id", "n_words", "hits", "items", "near")
    schema = shared._arrow_schema(RESULT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [_verdict(r["doc_id"], r["n_words"], r["hits"], set(r["items"]), set(r["near"])) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], type=f.type) for k, f in enumerate(schema)], schema=schema)

    return shared.map_arrow(each, run, RESULT)


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_words: int = term_segments.BLOCK_WORDS) -> DataFrame:
    """Per document: words, words inside an occurrence of an item's window, the items so found, and those near.

    Items beyond ``block_words`` words are asked for in further passes over the index,
    which then keeps the lists of all terms.
    """
    blocks = term_segments.query_blocks(items, block_words)
    ids, texts = next(blocks)
    more = next(blocks, None)
    if more is None:
        return _answer(build(docs, words_of(texts)[0]), ids, texts, window, whole=True)
    index = build(docs)
    out = _answer(index, ids, texts, window, whole=False).unionByName(_answer(index, *more, window, whole=False))
    for block in blocks:
        out = out.unionByName(_answer(index, *block, window, whole=False))
    return _joined(out)
