"""Whole texts as segments of dictionary-coded terms: what both term indexes are built from.

A term is a maximal run of ASCII letters, digits and characters beyond ASCII, only A-Z
lower-cased (what ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` takes of the lower-cased text, and
``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` of the text itself).  A segment is some
documents of one Arrow batch, about ``SEGMENT`` bytes of text (one document at least, however
long), so an index of a partition's segments needs no shuffle and its memory has a bound.

Defined cases: a null text has no terms, like an empty one or one without letters and digits.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared

#: Bytes of text in a segment, about.
SEGMENT = 4_000_000

# A-Z become a-z; ASCII characters that belong to no term become zero bytes.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 0 for b in range(256))


@dataclass
class Coded:
    """Terms of some texts: ``codes`` into ``terms``, those of text ``i`` at ``first[i]:first[i + 1]``."""

    codes: np.ndarray
    terms: pa.Array
    first: np.ndarray


def code(texts: pa.Array) -> Coded:
    """Terms of every text of an Arrow string array without nulls (32-bit offsets)."""
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    data = texts.buffers()[2] if len(texts) else None
    raw = bytes(memoryview(data)[ends[0]:ends[-1]]).translate(_FOLD) if data is not None else b""
    at = ends.astype(np.int64) - ends[0]
    byte = np.frombuffer(raw, np.uint8)
    inside = byte != 0
    before, after = np.zeros(len(byte), bool), np.zeros(len(byte), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    # two texts side by side never share a term
    before[at[at < len(byte)]] = False
    after[at[at > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    lengths = np.flatnonzero(inside & ~after) + 1 - starts
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(byte[inside])])
    coded = words.dictionary_encode()
    return Coded(coded.indices.to_numpy(), coded.dictionary, np.searchsorted(starts, at))


def parts(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``SEGMENT`` bytes in column ``at`` (one row at least)."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    a = done = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(ends, done + SEGMENT, side="right")))
        yield batch.slice(a, b - a)
        a, done = b, int(ends[b - 1])


def lists_of(term: np.ndarray, terms: int) -> np.ndarray:
    """Where the list of each of ``terms`` terms starts in entries sorted by term, and their end."""
    at = np.zeros(terms + 1, np.int64)
    np.cumsum(np.bincount(term, minlength=terms), out=at[1:])
    return at


def packed(numbers: np.ndarray) -> bytes:
    """Numbers as compressed differences of 64 bits."""
    return zstandard.ZstdCompressor(level=1).compress(np.diff(numbers.astype(np.int64), prepend=np.int64(0)).tobytes())


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.int64))


def known(coded: Coded, only: pa.Array | None) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Where the entries of wanted terms (``only``; all without it) are, their numbers, and the terms so numbered."""
    if only is None:
        return np.arange(len(coded.codes)), coded.codes.astype(np.int64), coded.terms
    wanted = pc.is_in(coded.terms, value_set=only).to_numpy(zero_copy_only=False)
    number = np.cumsum(wanted) - 1
    at = np.flatnonzero(wanted[coded.codes])
    return at, number[coded.codes[at]], coded.terms.filter(pa.array(wanted))


def write_index(docs: DataFrame, name: str, only: pa.Array | None, entry: Callable[[Coded, pa.Array | None], dict], schema: str) -> DataFrame:
    """Store one row a segment (``segment``, ``doc_id`` and what ``entry`` returns) in the shared folder, and read it."""
    spark = docs.sparkSession
    columns = f"segment string, doc_id array<bigint>, {schema}"
    target = shared._arrow_schema(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in parts(batch, 1):
                row = {"segment": f"{task}-{number}", "doc_id": part.column(0).to_pylist()} | entry(code(part.column(1)), only)
                number += 1
                yield pa.RecordBatch.from_arrays([pa.array([row[f.name].to_pylist() if isinstance(row[f.name], pa.Array) else row[f.name]], type=f.type)
                                                  for f in target], schema=target)

    path = f"{shared.shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    shared.map_arrow(shared.doc_text(docs), run, columns).write.parquet(path)
    return spark.read.schema(columns).parquet(path)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows of an index one at a time, so that one segment is unpacked at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(k)[i] for k, name in enumerate(batch.schema.names)}


def local_lists(terms: pa.Array, wanted: pa.Array) -> np.ndarray:
    """For every wanted term the number of its list in the segment, -1 where the segment lacks it."""
    found = pc.index_in(wanted, value_set=terms)
    return pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64)


#: Most words of the asked texts that one pass holds; further ones take further passes.
BLOCK_WORDS = 2_000_000


def query_blocks(items: DataFrame, most: int = BLOCK_WORDS) -> Iterator[tuple[list, pa.Array]]:
    """Blocks of the asked rows, as (ids, texts), of about ``most`` words each: what a pass sends to every task.

    The rows are counted first, and dealt to blocks by a hash of their content, so no
    block grows with the number of rows asked (equal rows share a block).
    """
    rows = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text") / 3 + 10), F.lit(0))).first()[0]
    blocks = max(1, int(np.ceil(float(size) / most)))
    for k in range(blocks):
        block = rows if blocks == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        found = block.orderBy("item_id", "text").toArrow().combine_chunks()
        text = found.column("text").cast(pa.string())
        yield found.column("item_id").to_pylist(), pa.concat_arrays(text.chunks) if text.num_chunks else pa.array([], pa.string())


def term_counts(index: DataFrame, wanted: pa.Array, entries: Callable[[dict], np.ndarray]) -> dict[int, int]:
    """Entries of every wanted term (by number) in the whole index: ``entries`` gives a segment's per list."""
    schema = "term int, n bigint"
    target = shared._arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(wanted), np.int64)
        for row in rows_of(batches):
            local = local_lists(row["terms"].values, wanted)
            has = local >= 0
            total[has] += entries(row)[local[has]]
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(total[there])], schema=target)

    # a row a wanted term at most, whose number query_blocks bounds
    return {r["term"]: r["n"] for r in shared.map_arrow(index, run, schema).groupBy("term").agg(F.sum("n").alias("n")).collect()}
