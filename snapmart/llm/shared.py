"""Helpers the corpus operators share: sources, byte-exact word splitting, lineage cuts.

Every operator reads only the columns it needs, so extra input columns (and any
clash of their names with output columns) never reach its plan.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows whose remainder is this one are held out from every fit.
HELD_OUT = 2
#: A key of more than one row in so many is hot.
HOT = 200


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` (bigint) and ``text`` with a null text as the empty one; all other columns dropped."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def held_out(key: str = "doc_id"):
    """The fixed split: crc32 of the id as text, modulo 4, equal to 2 (a null id is not held out)."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def ship(spark: SparkSession) -> None:
    """Give the executors' Python this package, once per application (they need not have it installed)."""
    sc = spark.sparkContext
    if getattr(sc, "_snapmart_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="snapmart-py-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(archive))
    sc._snapmart_shipped = True


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` with this package at hand in the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def text_slices(batch: pa.RecordBatch, at: int, most: int = 4_000_000) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of a batch of about ``most`` bytes of text (column ``at``; one row at least) with their texts, null as empty.

    Only one part's texts are Python strings at a time.
    """
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    a = done = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(ends, done + most, side="right")))
        part = batch.slice(a, b - a)
        yield part, [t or "" for t in part.column(at).to_pylist()]
        a, done = b, int(ends[b - 1])


def text_map(docs: DataFrame, rows: Callable[[Iterator[tuple[list, list[str]]]], Iterator[dict]],
             schema: str) -> DataFrame:
    """Run ``rows`` over (ids, texts) parts of ``doc_text(docs)`` inside the scan's own tasks.

    ``rows`` gets an iterator of parts (a few MB of text each, whatever the partition's
    size) and yields dicts of column lists.
    """
    target = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = ((part.column(0).to_pylist(), texts) for b in batches for part, texts in text_slices(b, 1))
        for out in rows(pairs):
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in target], schema=target)

    return map_arrow(doc_text(docs), run, schema)


def text_append(docs: DataFrame, values: Callable[[list[str]], list], name: str, kind: str) -> DataFrame:
    """``docs`` with one more column, computed from the whole texts (a null text as the empty one) in the scan's tasks."""
    if name in docs.columns:
        raise ValueError(f"the documents already have a column {name}")
    schema = T.StructType([*docs.schema.fields, T.StructType.fromDDL(f"{name} {kind}")[0]])
    at = docs.columns.index("text")
    out_type = _arrow_schema(f"v {kind}")[0].type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, texts in text_slices(b, at):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(values(texts), type=out_type)],
                                                 names=[*part.schema.names, name])

    return map_arrow(docs, run, schema)


def _arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(T.StructType.fromDDL(ddl))


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; only a ``local`` master without the setting gets a private one."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="snapmart-llm-")
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there: a lost executor costs a reread, not the lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def small_table(spark: SparkSession, names: tuple[str, ...], rows: list[tuple]) -> DataFrame:
    """A table of bigints from driver rows whose number has a bound of its own."""
    columns = np.array(rows, dtype=np.int64).reshape(-1, len(names)).T
    return spark.createDataFrame(pa.table({n: pa.array(c) for n, c in zip(names, columns, strict=True)}))


def sized(df: DataFrame, rows: int = 500_000) -> DataFrame:
    """``df`` marked for broadcasting if it has at most ``rows`` rows (slim ones: a few MB), else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def join_hot(rows: DataFrame, keyed: DataFrame, key: str, n: str, total: int) -> DataFrame:
    """``rows`` joined with ``keyed``: one row a ``key``, ``n`` (left out of the result) of the ``total`` rows having it.

    Hot keys (``HOT`` at most, as they share the rows) are broadcast and their rows stay where
    they are; the others are shuffled, none of them over one in ``HOT`` of the rows.
    """
    hot = F.broadcast(keyed.where(F.col(n) * HOT > total).drop(n))
    others = keyed.where(F.col(n) * HOT <= total).drop(n)
    return rows.join(hot, key).unionByName(rows.join(hot.select(key), key, "left_anti").join(others, key))


class TwoGenerationCache:
    """A dict of bounded size: when the young half is full it becomes the old half and the old one goes."""

    def __init__(self, limit: int):
        self.limit, self.young, self.old = max(2, limit) // 2, {}, {}

    def take(self, keys: set) -> tuple[dict, list]:
        """The known ones of ``keys`` with their values, and the others."""
        young = keys & self.young.keys()
        found = dict(zip(young, map(self.young.__getitem__, young), strict=True))
        rest = keys - young
        old = rest & self.old.keys()
        if old:
            again = dict(zip(old, map(self.old.__getitem__, old), strict=True))
            found.update(again)
            self.put(again)
            rest -= old
        return found, list(rest)

    def put(self, values: dict) -> None:
        self.young.update(values)
        if len(self.young) >= self.limit:
            self.old, self.young = self.young, {}


_RESIDENT: dict = {}


def resident(key: tuple, make: Callable):
    """What a worker process keeps across tasks: one heavy object, the one last asked for.

    Workers are reused from stage to stage; caches of an earlier operator would add up.
    """
    if key not in _RESIDENT:
        _RESIDENT.clear()
        _RESIDENT[key] = make()
    return _RESIDENT[key]


def by_chunks(parts: list[list[str]], cache: TwoGenerationCache, missing: Callable[[list[str]], list[bytes]],
              fixed: dict[str, bytes]) -> list[bytes]:
    """Join the codes of each row's chunks; distinct chunks not in the cache are encoded in one call.

    Chunks over 64 characters are not kept, so the cache's memory has a bound.
    """
    known = cache.young
    known.update(fixed)
    rest = set().union(*parts) - known.keys()
    again = rest & cache.old.keys()
    known.update(zip(again, map(cache.old.__getitem__, again), strict=True))
    unknown = list(rest - again)
    known.update(zip(unknown, missing(unknown), strict=True))
    code_of = known.__getitem__
    out = [b"".join(map(code_of, some)) for some in parts]
    for chunk in [c for c in unknown if len(c) > 64]:
        del known[chunk]
    cache.put({})
    return out


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file; a folder in ``SNAPMART_TOKENIZERS`` overrides the installed one."""
    folder = os.environ.get("SNAPMART_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers
    return public_tokenizers.path(name)
