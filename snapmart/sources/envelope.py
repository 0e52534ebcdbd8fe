"""S1 — wrap payload entries into landing envelopes.

An envelope is ``{"source", "extracted_at_utc", "payload": {<list_field>: [...]}}``.
The reference lands one envelope per snapshot; at scale that would put a whole
snapshot into one JSON value parsed by one task.  Here a snapshot is spread over
envelopes of at most ``per_envelope`` entries: inside each (source, snapshot) an
entry's chunk is a hash of its own row key modulo the number of chunks, which follows
from the snapshot's number of entries.  So the same rows give the same envelopes
however the input is split, small snapshots are not cut up, and a snapshot, or a
set of identical rows, holding a third of the data still becomes many envelopes.
All envelopes of a snapshot carry the same ``extracted_at_utc``, which is what the
snapshot cut keys on.

An ``EnvelopePlan`` knows its envelopes from narrow columns alone (row keys and
snapshots): which there are is counted without building or serializing an entry, and the
bodies of the wanted ones are then built in one pass and one shuffle.  That shuffle carries
the entries' fields; they are serialized behind it, a bounded number of rows a task.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.functions.timefmt import iso_utc

# Entries per envelope.  Small envelopes keep each VARIANT value small: the
# grouped collect stays in the hash aggregate and the explode touches short arrays.
DEFAULT_PER_ENVELOPE = 200
# A chunk is meant to hold this share of ``per_envelope``, so that few overflow by chance.
FILL = 0.85
# Chunks that are built by one task and, when landed, lie in one file.
CHUNKS_PER_FILE = 128
# Rows whose envelopes one task builds, about: their texts are grouped and sorted in its memory.
ROWS_PER_TASK = 50_000
# Snapshots whose sizes are sent to every task; beyond that their join shuffles.
MANY_SNAPSHOTS = 100_000


def with_row_key(scan: DataFrame, name: str = "_row_id") -> DataFrame:
    """Row key of a Parquet scan: file name and row number in it, whatever the splits; take it right after the scan."""
    return scan.withColumn(name, F.xxhash64(F.col("_metadata.file_name"), F.col("_metadata.row_index")))


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Shuffle partitions where texts of so many rows are grouped: as set, or more, so that a task's share stays bounded."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_TASK))


@dataclass
class EnvelopePlan:
    """Envelopes of entries, known before they are built (see ``plan_envelopes``).

    Every row gives one entry to each of ``sources`` (source, list field, entry's JSON), so
    the sources' envelopes hold the same rows and are counted and dealt once for all.  ``named``
    says under which names of the rows' entries the snapshot and the row key are moved.
    """

    rows: DataFrame
    narrow: DataFrame
    sources: list[tuple[str, str, Column]]
    order: Column
    named: dict[str, str]
    extra: list[str]
    per_envelope: int

    @property
    def by(self) -> list[str]:
        return ["extracted_at", *[f"_x_{n}" for n in self.extra]]

    @cached_property
    def sizes(self) -> tuple[DataFrame, int, int]:
        """Chunks of every (snapshot, extra values), written once, how many rows that are, and how many entries a source has."""
        from snapmart.session import fresh_dir

        path = fresh_dir(self.narrow.sparkSession, "envelope-sizes")
        chunks = F.ceil(F.count(F.lit(1)) / F.lit(self.per_envelope * FILL)).cast("bigint")
        self.narrow.groupBy(*self.by).agg(chunks.alias("_chunks"), F.count(F.lit(1)).alias("_rows")).write.parquet(path)
        sizes = self.narrow.sparkSession.read.parquet(path)
        n, entries = sizes.agg(F.count(F.lit(1)), F.coalesce(F.sum("_rows"), F.lit(0))).first()
        return sizes, n, entries

    def _chunked(self, rows: DataFrame) -> DataFrame:
        sizes, n, _ = self.sizes
        named = sizes.select(*[F.col(c).alias(f"_c{c}") for c in self.by], "_chunks")
        same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_c{c}")) for c in self.by])
        joined = rows.join(F.broadcast(named) if n <= MANY_SNAPSHOTS else named, same).drop(*[f"_c{c}" for c in self.by])
        chunked = joined.withColumn("_chunk", F.pmod(F.xxhash64("_id"), "_chunks"))
        return chunked.withColumn("file_no", F.floor(F.col("_chunk") / CHUNKS_PER_FILE).cast("bigint"))

    def _number(self) -> Column:
        return F.col("_chunk") + F.col("_part") * F.col("_chunks")

    def _parts(self, size: Column) -> Column:
        """A chunk that came out too large by chance is cut; numbers stay unique within a snapshot."""
        return F.explode(F.sequence(F.lit(0).cast("bigint"), ((size - 1) / self.per_envelope).cast("bigint")))

    def _per_source(self, with_entry: bool) -> Column:
        return F.inline(F.array(*[F.struct(F.lit(s).alias("source"), F.lit(f).alias("_field"), *[e.alias("_e")] * with_entry)
                                  for s, f, e in self.sources]))

    def keys(self) -> DataFrame:
        """Every envelope: (source, extracted_at, envelope_no, _chunk), from the narrow columns."""
        counted = self._chunked(self.narrow).groupBy(*self.by, "_chunks", "_chunk", "file_no").agg(F.count(F.lit(1)).alias("_n"))
        numbered = counted.withColumn("_part", self._parts(F.col("_n"))).select(*self.by, "_chunk", self._number().alias("envelope_no"), "file_no")
        return numbered.select("*", self._per_source(False)).select("source", "_field", *self.by, "_chunk", "envelope_no", "file_no")

    def bodies(self, wanted: DataFrame | None = None) -> DataFrame:
        """(source, extracted_at, envelope_no, extra values, body), of all envelopes or of the ``wanted`` chunks (rows of ``keys``), in all sources.

        Rows are dealt by snapshot and file, so that a file's envelopes are built in one task
        and need no further shuffle to be written; the more rows, the more tasks.
        """
        rows = self._chunked(self.rows)
        if wanted is not None:
            asked = wanted.select(*[F.col(c).alias(f"_w{c}") for c in (*self.by, "_chunk")]).distinct()
            rows = rows.join(asked, reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_w{c}")) for c in (*self.by, "_chunk")]), "left_semi")
        # a stated number of partitions, which stays: few bytes may be many files
        n = tasks_for(rows.sparkSession, self.sizes[2])
        dealt = rows.repartition(n, *self.by, "file_no").withColumns({c: F.col(at) for c, at in self.named.items()})
        grouped = (dealt.select(*self.by, "file_no", "_chunks", "_chunk", self.order.alias("_o"), "_id", self._per_source(True))
                   .groupBy("source", "_field", *self.by, "file_no", "_chunks", "_chunk")
                   .agg(F.array_sort(F.collect_list(F.struct("_o", F.xxhash64("_id").alias("_h"), "_e"))).alias("_items")))
        cut = grouped.withColumn("_part", self._parts(F.size("_items")))
        items = F.slice("_items", (F.col("_part") * self.per_envelope + 1).cast("int"), F.lit(self.per_envelope))
        arr = F.transform(items, lambda x: x["_e"])
        head = F.to_json(F.struct(F.col("source"), iso_utc("extracted_at").alias("extracted_at_utc")))
        tail = [F.concat(F.lit(f',"{n}":'), F.col(f"_x_{n}").cast("string")) for n in self.extra]
        # '{"source":…,"extracted_at_utc":…' + ',"payload":{"<list>":[' + entries + ']…}}'
        body = F.concat(F.regexp_replace(head, "}$", ""), F.lit(',"payload":{"'), F.col("_field"), F.lit('":['),
                        F.array_join(arr, ","), F.lit("]"), *tail, F.lit("}}"))
        return cut.select("source", "extracted_at", self._number().alias("envelope_no"), "file_no",
                          *[F.col(f"_x_{n}").alias(n) for n in self.extra], body.alias("body"))


def plan_envelopes(entries: DataFrame, source: str | dict[str, tuple[str, Column]], snapshot_col: str, entry_col: str | None = None,
                   row_id_col: str = "_row_id", list_field: str = "results",
                   per_envelope: int = DEFAULT_PER_ENVELOPE, order_col: str | None = None,
                   extra: dict | None = None, narrow: DataFrame | None = None) -> EnvelopePlan:
    """Plan the envelopes of entries.

    An entry (a struct, or a string that is JSON already) is serialized behind the shuffle,
    which so carries fields and not texts, and the envelope is assembled by string
    concatenation (no nested ``to_json`` over a large array).  Elements are ordered by
    ``order_col`` (default: the row key).  ``source`` may also be several sources of the same
    rows, each with its list field and its entry: they are enveloped in one pass (one
    shuffle).  ``extra`` (name → column, equal within a snapshot) adds fields to the payload
    and cuts chunks by their values.  ``narrow`` holds the same rows without what only the
    entries need (their joins, for instance); it is what envelopes are counted from.
    """
    extra = extra or {}
    several = {source: (list_field, F.col(entry_col))} if isinstance(source, str) else source
    types = entries.select(*[e.alias(s) for s, (_, e) in several.items()]).dtypes
    sources = [(s, f, e if t == "string" else F.to_json(e)) for (s, (f, e)), (_, t) in zip(several.items(), types)]
    slim = [F.col(snapshot_col).alias("extracted_at"), *[c.alias(f"_x_{n}") for n, c in extra.items()], F.col(row_id_col).alias("_id")]
    named = {c: at for c, at in ((snapshot_col, "extracted_at"), (row_id_col, "_id")) if c != at}
    kept = [F.col(c) for c in entries.columns if c not in (*named, "extracted_at", "_id")]
    return EnvelopePlan(entries.select(*kept, *slim), (entries if narrow is None else narrow).select(*slim), sources,
                        F.col(order_col or row_id_col), named, list(extra), per_envelope)


def build_envelopes(entries: DataFrame, *args, **kwargs) -> DataFrame:
    """All envelopes of ``plan_envelopes`` with these arguments: (source, extracted_at, envelope_no, extra values, body)."""
    return plan_envelopes(entries, *args, **kwargs).bodies().drop("file_no")
