"""Conversation prefix trie by whole-sequence collapse.

Turns get their places from one range sort of slim rows (digests, not texts), in which a
very long conversation is spread over many partitions.  A prefix is named by sums of
64-bit hashes of (depth, turn digest): sums need no order to be put together, so running
sums per partition and a handful of carries between partitions name every prefix of every
conversation, however long.

Identical rebuilt conversations then collapse into weighted sequences with the list of
conversations that end there.  Sequences that are proper prefixes of others fall out in an
anti-join; what stays are the leaves.  Only one conversation a sequence goes on: its
prefixes, weighted, are aggregated into nodes.

Sums over subtrees come from the sequences too, without a walk through the levels.  For a
node x, the words of its members below its top are ``sum(weight * T) - n * P`` (T: words of
a sequence, P: words above x).  The words of the subtree's distinct nodes are
``sum(O) - O* + T* - P``: every node is owned by the sequence of its smallest member, O are
the words of the nodes a sequence owns, and the star marks the owner of x itself.  Their
difference is ``saved_tokens``.

Defined cases: a null role or text is empty; rows without ``conv_id`` are in no
conversation; turns are ordered by number (null first), equal ones by role, by the first
64 characters of the text and by digest; repeated rows are turns of their own; texts of any
length count as one turn; an empty table gives no rows (there is no smallest member);
further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import shared

WORD = r"[^\x20\x09-\x0D]+"
#: Conversations with this distance of ids share the start of the first one.
FAMILY = 20
#: Ids in a block of an end list: 2 to this power.
BLOCK_BITS = 12
_WIDE = "decimal(38,0)"


def _sums(depth: Column, digest: Column) -> list[Column]:
    """Two independent hashes of a turn at its depth, wide enough to be summed."""
    return [F.xxhash64(F.lit(salt), depth.cast("bigint"), digest).cast(_WIDE) for salt in (1, 2)]


def _key(depth: Column, a: Column, b: Column) -> Column:
    return F.md5(F.concat_ws(":", depth.cast("string"), a.cast("string"), b.cast("string")))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, part, ord, digest, words``: slim turns in order (``ord``), partition ``part`` of the sort."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    slim = shared.cut(conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), role.alias("role"),
        F.substring(text, 1, 64).alias("start"), F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"), F.monotonically_increasing_id().alias("row")))
    keys = ["conv_id", F.asc_nulls_first("turn"), "role", "start", "digest", "row"]
    ranged = slim.repartitionByRange(*keys).sortWithinPartitions(*keys)
    number = F.monotonically_increasing_id()
    return shared.cut(ranged.select("conv_id", F.spark_partition_id().alias("part"), number.alias("ord"), "digest", "words"))


def _before(rows: DataFrame, names: list[str]) -> DataFrame:
    """Sums of ``names`` over a conversation's earlier parts: of the few conversations that lie in several."""
    w = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    several = rows.select("conv_id", "part", *names, F.count("*").over(Window.partitionBy("conv_id")).alias("_parts")).where("_parts > 1")
    return several.select("conv_id", "part", *[F.coalesce(F.sum(n).over(w), F.lit(0)).alias(f"{n}_before") for n in names])


def rebuilt_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, depth, key, parent, words, above, last``: every prefix of every rebuilt conversation, the root included.

    ``words`` are those of the prefix's last turn, ``above`` those of the turns before it;
    ``last`` marks the whole conversation.
    """
    zero = F.lit(0).cast("bigint")
    chunks = turns.groupBy("part", "conv_id").agg(F.min("ord").alias("low"), F.count("*").alias("n"))
    chunks = shared.cut(chunks.join(_before(chunks, ["n"]), ["part", "conv_id"], "left")
                        .select("part", "conv_id", "low", "n", F.coalesce("n_before", zero).alias("offset")))
    place = F.col("ord") - F.col("low") + F.col("offset") + 1
    firsts = chunks.where((F.col("conv_id") % FAMILY == 0) & (F.col("offset") < 3))
    heads = (turns.where(F.col("conv_id") % FAMILY == 0).join(firsts, ["part", "conv_id"]).withColumn("place", place).where("place <= 3")
             .groupBy(F.col("conv_id").alias("base")).agg(F.array_sort(F.collect_list(F.struct("place", "digest", "words"))).alias("head")))

    # one row a conversation: how many turns it takes over, which, and what they sum up to
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    convs = chunks.groupBy("conv_id").agg(F.sum("n").alias("n")).select(
        "conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"))
    convs = convs.join(heads, "base", "left").withColumn("head", F.slice(F.coalesce("head", F.expr("slice(array(named_struct('place', 0L, 'digest', '', 'words', 0L)), 1, 0)")), F.lit(1), F.col("h").cast("int")))
    hashed = F.transform("head", lambda x: F.struct(*[c.alias(n) for c, n in zip(_sums(x["place"], x["digest"]), "ab", strict=True)],
                                                    x["words"].cast(_WIDE).alias("w")))
    convs = convs.withColumn("k", F.size("head").cast("bigint")).withColumn("t", hashed)

    def upto(name: str, n: Column) -> Column:
        return F.aggregate(F.slice("t", F.lit(1), n.cast("int")), F.lit(0).cast(_WIDE), lambda s, x: (s + x[name]).cast(_WIDE))

    convs = shared.cut(convs.select("conv_id", "h", "k", "head", "t", (F.col("k") + F.greatest(F.col("n") - F.col("h"), zero)).alias("length"),
                                    *[upto(n, F.col("k")).alias(f"{n}0") for n in "abw"]))

    def named(rows: DataFrame, at: str, term: dict[str, Column], total: dict[str, Column]) -> DataFrame:
        depth = F.col(at)
        key = _key(depth, total["a"], total["b"])
        parent = _key(depth - 1, total["a"] - term["a"], total["b"] - term["b"])
        return rows.select("conv_id", depth.alias("depth"), key.alias("key"), F.when(depth > 0, parent).alias("parent"),
                           term["w"].cast("bigint").alias("words"), (total["w"] - term["w"]).cast("bigint").alias("above"),
                           (depth == F.col("length")).alias("last"))

    # prefixes of depth 0 to k, out of the turns taken over
    steps = convs.withColumn("depth", F.explode(F.sequence(zero, F.col("k"))))
    taken = steps.select("*", *[upto(n, F.col("depth")).alias(f"{n}_to") for n in "abw"],
                         *[upto(n, F.greatest(F.col("depth") - 1, zero)).alias(f"{n}_up") for n in "abw"])
    taken = named(taken, "depth", {n: (F.col(f"{n}_to") - F.col(f"{n}_up")).cast(_WIDE) for n in "abw"}, {n: F.col(f"{n}_to") for n in "abw"})

    # deeper ones, out of the conversation's own turns behind its first h
    slim = chunks.join(convs.select("conv_id", "h", "k", "length", "a0", "b0", "w0"), "conv_id")
    own = turns.join(slim, ["part", "conv_id"]).withColumn("place", place).where(F.col("place") > F.col("h"))
    own = own.withColumn("depth", F.col("k") + F.col("place") - F.col("h"))
    own = own.select("part", "conv_id", "ord", "depth", "length", *[c.alias(n) for c, n in zip(_sums(F.col("depth"), F.col("digest")), "ab", strict=True)],
                     F.col("words").cast(_WIDE).alias("w"), "a0", "b0", "w0")
    run = Window.partitionBy("part", "conv_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    own = shared.cut(own.select("*", *[F.sum(n).over(run).cast(_WIDE).alias(f"{n}_run") for n in "abw"]))
    carried = _before(own.groupBy("part", "conv_id").agg(*[F.sum(n).cast(_WIDE).alias(n) for n in "abw"]), list("abw"))
    # at most one conversation goes on from a part into the next, so there are fewer carries than parts
    own = own.join(F.broadcast(carried.where(reduce(Column.__or__, [F.col(f"{n}_before") != 0 for n in "abw"]))), ["part", "conv_id"], "left")
    total = {n: (F.col(f"{n}_run") + F.coalesce(f"{n}_before", F.lit(0).cast(_WIDE)) + F.col(f"{n}0")).cast(_WIDE) for n in "abw"}
    own = named(own, "depth", {n: F.col(n) for n in "abw"}, total)
    return shared.cut(taken.unionByName(own))


def _digests(whole: DataFrame) -> DataFrame:
    """``key, ends_sha256``: the digest of the ascending ids of each sequence's conversations.

    Ids are range-sorted and joined in blocks of at most 4096; the digest of a sequence with
    several blocks reads them one after the other and holds one at a time.
    """
    ranged = whole.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    ranged = shared.cut(ranged.withColumn("block", F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS)))
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    blocks = shared.cut(ranged.groupBy("key", "block").agg(ids.alias("ids")))
    per = blocks.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct("block", "ids")).alias("one"))
    single = per.where("n = 1").select("key", F.sha2(F.col("one.ids"), 256).alias("ends_sha256"))
    long = blocks.join(per.where("n > 1").select("key"), "key", "left_semi").repartition("key").sortWithinPartitions("key", "block")
    schema = "key string, ends_sha256 string"
    target = shared._arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            for k, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if k == key:
                    digest.update(b"," + ids.encode())
                    continue
                if key is not None:
                    yield pa.RecordBatch.from_pydict({"key": [key], "ends_sha256": [digest.hexdigest()]}, schema=target)
                key, digest = k, hashlib.sha256(ids.encode())
        if key is not None:
            yield pa.RecordBatch.from_pydict({"key": [key], "ends_sha256": [digest.hexdigest()]}, schema=target)

    return single.unionByName(shared.map_arrow(long.select("key", "ids"), run, schema))


def trie(conversations: DataFrame) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    prefixes = rebuilt_turns(ordered_turns(conversations))
    whole = prefixes.where("last").select("conv_id", "depth", "key", (F.col("above") + F.col("words")).alias("total"))
    sequences = shared.cut(whole.groupBy("key").agg(F.count("*").alias("weight"), F.min("conv_id").alias("conv_id"),
                                                    F.first("depth").alias("length"), F.first("total").alias("total")))
    weighted = shared.cut(prefixes.drop("last").join(sequences.select("conv_id", "weight", "length", "total"), "conv_id"))
    inner = weighted.where("depth < length").select("key").distinct()
    leaves = sequences.join(inner, "key", "left_anti").select("conv_id", F.lit(1).cast("bigint").alias("leaf"))
    nodes = shared.cut(weighted.join(leaves, "conv_id", "left").groupBy("key", "depth").agg(
        F.min(F.struct("conv_id", "total")).alias("top"), F.sum("weight").alias("n_convs"),
        F.sum(F.coalesce("leaf", F.lit(0))).alias("n_leaves"), F.sum(F.col("weight") * F.col("total")).alias("below"),
        F.first("parent").alias("parent"), F.first("words").alias("words"), F.first("above").alias("above")))
    nodes = nodes.select("key", "depth", F.col("top.conv_id").alias("conv_id"), F.col("top.total").alias("total"), "n_convs", "n_leaves", "below",
                         "parent", "words", "above")
    owned = shared.cut(nodes.groupBy("conv_id").agg(F.sum("words").alias("owned")))
    distinct = weighted.join(owned, "conv_id").groupBy("key").agg(F.sum("owned").alias("all_owned"))
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    out = (nodes.join(distinct, "key", "left").join(children, "key", "left").join(_digests(whole), "key", "left").join(owned, "conv_id"))
    zero, empty = F.lit(0).cast("bigint"), F.lit(hashlib.sha256(b"").hexdigest())
    saved = (F.col("below") - F.col("n_convs") * F.col("above")
             - (F.coalesce("all_owned", zero) - F.col("owned") + F.col("total") - F.col("above")))
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return out.withColumn("saved_tokens", saved).join(parents, "parent", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", empty).alias("ends_sha256"))
