"""Ranked lexical search: term at a time, rarest first, with a limit on accumulators.

The corpus is stored as segments (some MB of whole texts) of posting lists with term
frequencies, for the terms that queries hold.  Counts over the whole index give every
term's weight.  In a segment an item's terms are taken by ascending document frequency.
Each list adds its exact contributions to the documents' accumulators; before a list is
read, the sum of the largest contributions of all lists still to come is compared with the
k-th best score so far: the k-th partial score in the segment, or the k-th final score of
the segments the task has done.  Once the sum is smaller, a document without accumulator
cannot reach the best k (nor tie with the k-th), so no accumulator is created any more, and
the survivors are still updated exactly.  A task returns its best k per item; a window cut
to k rows per task, over parts of an item first, gives the answer.

Score: ``w * ((1000000000 * tf) div (1000 * tf + 8 * m))`` summed over the item's terms with
repeats, ``w = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))``, ``m = 25 + (75 * n * N) div L``;
N documents hold a term, L is the number of their terms, n that of the document's.

Defined cases: null and empty texts hold no term, count for nothing and are never found;
every row of either table stands for itself, so repeated rows are found (or asked) as often
as they are there; equal scores go by ``doc_id``, a null one last; items without terms or
hits have no rows; an empty table on either side gives none; further columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import shared, term_segments

TOP = 10
#: Parts in which an item's best rows are cut first, so that no task gets those of all others.
PARTS = 64

INDEX = "sizes array<bigint>, terms array<binary>, lists array<bigint>, docs binary, frequencies binary"
RESULT = "item_id bigint, rank int, doc_id bigint, score bigint"
_FOUND = "item int, item_id bigint, doc_id bigint, score bigint, part int"


def _entry(coded: term_segments.Coded, only: pa.Array | None) -> dict:
    at, term, terms = term_segments.known(coded, only)
    n = len(coded.first) - 1
    key, frequency = np.unique(term * n + (np.searchsorted(coded.first, at, side="right") - 1), return_counts=True)
    return {"sizes": np.diff(coded.first), "terms": terms, "lists": term_segments.lists_of(key // max(n, 1), len(terms)),
            "docs": term_segments.packed(key % max(n, 1)), "frequencies": term_segments.packed(frequency)}


def build(docs: DataFrame, only: pa.Array | None = None) -> DataFrame:
    """The stored index: a row a segment (``sizes``: terms of each document; ``lists``: where each term's documents begin)."""
    return term_segments.write_index(docs, "ranked-index", only, _entry, INDEX)


def best_of(ids: list, lists: list[tuple[np.ndarray, np.ndarray, int]], n: int, k: int, floor: int) -> list[tuple[int, int]]:
    """(score, document number) of what can be among the best ``k`` of a segment of ``n`` documents.

    ``lists``: (documents, contributions, the largest of these) of the item's terms, rarest first;
    ``floor``: what a score must reach at least.
    """
    rest = sum(most for _, _, most in lists)
    score, alive, creating = np.zeros(n, np.int64), np.zeros(n, bool), True
    for docs, gain, most in lists:
        if creating:
            least = floor
            live = score[alive]
            if len(live) >= k:
                least = max(least, int(np.partition(live, -k)[-k]))
            creating = rest >= least
        if creating:
            score[docs] += gain
            alive[docs] = True
        else:
            if not alive.any():
                return []
            some = alive[docs]
            score[docs[some]] += gain[some]
        rest -= most
    found = np.flatnonzero(alive & (score > 0) & (score >= floor))
    if len(found) > k:
        least = np.partition(score[found], -k)[-k]
        found = found[score[found] >= least]
    return sorted(((int(score[d]), int(d)) for d in found), key=lambda x: (-x[0], ids[x[1]] is None, ids[x[1]] or 0))[:k]


def _search(index: DataFrame, ids: list, texts: pa.Array, k: int) -> DataFrame:
    """Best rows of every task for one block of items."""
    coded = term_segments.code(texts)
    terms = coded.terms
    found = term_segments.term_counts(index, terms, lambda row: np.diff(row["lists"].values.to_numpy()))
    size = F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x)
    some = F.size(F.filter("sizes", lambda x: x > 0))
    total, length = index.agg(F.coalesce(F.sum(some), F.lit(0)), F.coalesce(F.sum(size), F.lit(0))).first()
    weight, df = np.zeros(len(terms), np.int64), np.zeros(len(terms), np.int64)
    for t, n in found.items():
        df[t], weight[t] = n, math.floor(1000 * math.log((2 * total + 2) / (2 * n + 1)))
    asked = []
    for item, (a, b) in enumerate(zip(coded.first[:-1], coded.first[1:], strict=True)):
        t, times = np.unique(coded.codes[a:b], return_counts=True)
        t, times = t[df[t] > 0], times[df[t] > 0]
        order = np.lexsort((t, df[t]))
        if len(t):
            asked.append((item, t[order], times[order]))
    plan = index.sparkSession.sparkContext.broadcast((terms, weight, asked, ids))  # a block: its size is bounded
    schema = shared._arrow_schema(_FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, weight, asked, names = plan.value
        best: dict[int, list[tuple]] = {}
        for row in term_segments.rows_of(batches):
            sizes, lists = row["sizes"].values.to_numpy(), row["lists"].values.to_numpy()
            docs, tf = term_segments.unpacked(row["docs"].as_py()), term_segments.unpacked(row["frequencies"].as_py())
            local = term_segments.local_lists(row["terms"].values, terms)
            m = 25 + (75 * sizes * total) // max(length, 1)
            gain = (1_000_000_000 * tf) // (1000 * tf + 8 * m[docs])
            most = np.maximum.reduceat(gain, lists[:-1]) if len(gain) else gain  # no list is empty
            doc_ids = row["doc_id"].values.to_pylist()
            for item, t, times in asked:
                here = local[t]
                use = np.flatnonzero(here >= 0)
                if not len(use):
                    continue
                each = weight[t] * times
                had = best.get(item, [])
                floor = -had[0][0][0] if len(had) == k else 1
                if sum(int(most[here[i]]) * int(each[i]) for i in use) < floor:
                    continue
                pick = [(docs[a:b], gain[a:b] * each[i], int(most[here[i]] * each[i])) for i in use for a, b in [lists[here[i]:here[i] + 2]]]
                got = best_of(doc_ids, pick, len(sizes), k, floor)
                if got:
                    every = had + [(_order(s, doc_ids[d]), s, doc_ids[d]) for s, d in got]
                    best[item] = heapq.nsmallest(k, every, key=lambda x: x[0])[::-1]
        part = TaskContext.get().partitionId() % PARTS
        rows = [(item, names[item], d, s, part) for item, some in best.items() for _, s, d in some]
        columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
        yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return shared.map_arrow(index, run, _FOUND)


def _order(score: int, doc_id) -> tuple:
    return -score, doc_id is None, doc_id or 0


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_words: int = term_segments.BLOCK_WORDS) -> DataFrame:
    """Every item's ``top`` best documents: ``item_id, rank, doc_id, score``."""
    blocks = term_segments.query_blocks(items, block_words)
    first, more = next(blocks), next(blocks, None)
    index = build(docs, term_segments.code(first[1]).terms if more is None else None)
    found = _search(index, *first, top).withColumn("block", F.lit(0))
    for number, block in enumerate(chain([more], blocks) if more else ()):
        found = found.unionByName(_search(index, *block, top).withColumn("block", F.lit(number + 1)))
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    for keys in (("block", "item", "part"), ("block", "item")):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
    return found.select("item_id", "rank", "doc_id", "score")
