"""Best-fit packing of token sequences in bulk-synchronous supersteps.

Documents become pieces of at most ``capacity`` tokens.  Pieces and the gaps of open
sequences are sorted by size; a superstep takes all pieces of one length, longest
first, sweeps them over the gaps that fit, smallest gap first (the successor), and
where more pieces want a gap than there are such gaps, the lower ranks get it and the
rest move on to the next larger gap; what no gap holds opens new sequences.  The
gaps are then updated and the next length follows.  As pieces of one length are
interchangeable, this is exactly best-fit decreasing.

Equal lengths and equal gaps are swept as runs (a size and a count), at most
``capacity`` of each whatever the number of documents; the sweep yields rank
intervals, ``pieces of length l with ranks r to r + n go to sequences s to s + n at
offset o``.  The matching itself is distributed: pieces get their rank within
their length from counts per (length, salt) and a window within those cells, so a
length that a third of all pieces share is dealt over many tasks, and each piece
finds its interval in a join.

Defined cases: a null or empty text is one piece holding the end mark only;
repeated rows are packed each for itself; an empty table gives no rows.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from bisect import bisect_left, insort

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bpe, shared

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
#: Cells per length over which ranks are counted.
SALTS = 64


#: Classes of Latin-1 characters: letters and digits, white space, full stops and commas, control, other marks.
_CLASS = bytes([ord("a" if chr(b).isalnum() else "x" if 28 <= b < 32 else " " if chr(b).isspace() else
                    "." if chr(b) in ".," else "#") for b in range(256)])


#: The pattern's runs in a lower-case Latin-1 chunk, and what keeps a chunk from being split by them:
#: contractions, numerals that are no digits, white space, control characters and special tokens.
_RUNS = re.compile(r"[^\W\d_]+|\d|(?:[^\w\s]|_)+")
_ODD = re.compile(r"['²³¹¼½¾\s\x1c-\x1f]|<\|")


class WordIds:
    """Ids of the ``tokenizers`` library for a vocabulary that drops white space and marks word ends.

    Pieces between white space do not depend on each other, so each distinct one is
    encoded once and a bounded cache keeps the frequent ones.  Runs of Latin letters
    are merged many at once (see ``bpe``), anything else goes to the library.
    """

    def __init__(self, path: str, cache: int = 400_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        letters = bpe.byte_letters()
        last = [vocab[c + model["end_of_word_suffix"]] for c in letters]
        pairs: dict[int, int] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            pairs.setdefault(bpe.pair_key(vocab[a], vocab[b]), bpe.pair_key(rank, vocab[a + b]))
        self.table = bpe.PairTable(pairs)
        self.letters = bpe.Letters([vocab[c] for c in letters], self.table, last)
        self.single = [int(i).to_bytes(4, "little") for i in last]
        self.chunks = shared.TwoGenerationCache(cache)

    def _library(self, words: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for k in range(0, len(words), 2000):
            for e in self.tokenizer.encode_batch_fast(words[k:k + 2000], add_special_tokens=False):
                out.append(b"".join([i.to_bytes(4, "little") for i in e.ids]))
        return out

    def _missing(self, chunks: list[str]) -> list[bytes]:
        """Ids of distinct chunks: Latin ones by their letter, digit and mark runs, others by the library."""
        pieces: dict[str, list[str]] = {}
        others, runs = [], set()
        for c in chunks:
            if c.isalpha() and c.islower() and (c.isascii() or max(c) < "Ā"):
                runs.add(c)
            elif c and c == c.lower() and max(c) < "Ā" and not _ODD.search(c):
                pieces[c] = _RUNS.findall(c)
                runs.update(pieces[c])
            else:
                others.append(c)
        ids = dict(zip(others, self._library(others), strict=True))
        by_width: dict[int, list[str]] = {w: [] for w in bpe.WIDTHS}
        long = []
        for r in runs:
            size = len(r) if r.isascii() else len(r.encode())
            if size == 1:
                ids[r] = self.single[ord(r)]
            elif size <= bpe.WIDTHS[-1] + 1:
                by_width[bpe.width_for(size)].append(r)
            else:
                long.append(r)
        ids.update(zip(long, self._library(long), strict=True))
        for width, some in by_width.items():
            for k in range(0, len(some), bpe.MANY):
                part = some[k:k + bpe.MANY]
                ids.update(zip(part, bpe.merge_many([c.encode() for c in part], self.letters, self.table, width), strict=True))
        for c, some in pieces.items():
            ids[c] = b"".join([ids[r] for r in some])
        return [ids[c] for c in chunks]

    @staticmethod
    def _chunks(text: str) -> list[str]:
        """Stretches that the pattern always splits apart."""
        try:
            kinds = text.encode("latin-1").translate(_CLASS)
        except UnicodeEncodeError:
            kinds = b"x"
        if b"x" in kinds or b".." in kinds or b".#" in kinds or b"#." in kinds or "<|" in text:
            return text.replace("\n", " ").split(" ")
        return text.lower().replace(".", " . ").replace(",", " , ").split()  # lone stops and commas are pieces

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers."""
        return shared.by_chunks([self._chunks(t) for t in texts], self.chunks, self._missing, {"": b""})


def pieces(docs: DataFrame, path: str, capacity: int, end: int = 0) -> DataFrame:
    """Pieces of every row: ids of the whole text and the ``end`` id, cut only where longer than ``capacity``."""
    def rows(batches):
        coder = shared.resident(("words", path), lambda: WordIds(path))
        mark, width = end.to_bytes(4, "little"), 4 * capacity
        for ids, texts in batches:
            out: list[tuple] = []
            for doc_id, code in zip(ids, coder.encode_many(texts), strict=True):
                code += mark
                for k in range(0, len(code), width):
                    part = code[k:k + width]
                    out.append((doc_id, k // width, k // 4, len(part) // 4, zlib.crc32(part)))
            yield dict(zip(("doc_id", "piece", "start", "length", "ids_crc32"), zip(*out, strict=True), strict=True))

    return shared.text_map(docs, rows, PIECES)


def sweep(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over runs: rows (length, first rank, n, first sequence, offset)."""
    plan = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # size: runs of (first sequence, count)
    sizes: list[int] = []  # of non-empty gaps, ascending
    sequences = 0

    def put(size: int, first: int, n: int) -> None:
        if n and size:
            if size not in gaps:
                gaps[size] = []
                insort(sizes, size)
            gaps[size].append((first, n))

    def fill(length: int, rank: int, left: int, gap: int, first: int, n: int) -> tuple[int, int]:
        """Put up to ``left`` pieces into ``n`` sequences with this gap, each filled before the next; (pieces, sequences) used."""
        each = gap // length
        whole = min(n, left // each)
        for k in range(each if whole else 0):
            plan.append((length, rank + k * whole, whole, first, capacity - gap + k * length))
        put(gap - each * length, first, whole)
        placed, rest = whole * each, left - whole * each
        if rest and whole < n:  # one more, in part
            for k in range(rest):
                plan.append((length, rank + placed + k, 1, first + whole, capacity - gap + k * length))
            put(gap - rest * length, first + whole, 1)
            return left, whole + 1
        return placed, whole

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(sizes, length)
            if at == len(sizes):
                break
            gap = sizes.pop(at)
            for first, n in gaps.pop(gap):
                placed, used = fill(length, rank, left, gap, first, n) if left else (0, 0)
                rank, left = rank + placed, left - placed
                put(gap, first + used, n - used)
        if left:
            fresh = -(-left // (capacity // length))
            fill(length, rank, left, capacity, sequences, fresh)
            sequences += fresh
    return plan


def pack(cut_pieces: DataFrame, capacity: int) -> DataFrame:
    """All columns of the pieces with ``sequence_id`` and ``offset``; every sequence is gapless from 0."""
    key = F.xxhash64("doc_id", "piece", "ids_crc32")
    dealt = cut_pieces.withColumn("h", key).withColumn("salt", F.pmod("h", F.lit(SALTS)))
    cells = dealt.groupBy("length", "salt").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    names = ("p_length", "first", "n", "sequence0", "offset")
    plan = shared.small_table(cut_pieces.sparkSession, names, sweep(counts, capacity))
    below = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = cells.select(F.col("length").alias("b_length"), F.col("salt").alias("b_salt"),
                         F.coalesce(F.sum("n").over(below), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "salt").orderBy("h", "doc_id", "piece", "ids_crc32")
    ranked = dealt.withColumn("r", F.row_number().over(within))
    # Both tables are bounded by the capacity (capacity * SALTS cells; intervals of runs), not by the documents.
    placed = ranked.join(F.broadcast(bases), (F.col("length") == F.col("b_length")) & (F.col("salt") == F.col("b_salt")))
    placed = placed.withColumn("rank", F.col("base") + F.col("r") - 1)
    inside = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("n"))
    out = placed.join(F.broadcast(plan), (F.col("length") == F.col("p_length")) & inside)
    return out.select(*cut_pieces.columns, (F.col("sequence0") + F.col("rank") - F.col("first")).alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, path: str, capacity: int = 2048, end: int = 0) -> DataFrame:
    """Tokenise, cut and pack all rows of ``docs``."""
    return pack(shared.cut(pieces(docs, path, capacity, end)), capacity)
