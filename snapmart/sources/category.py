"""S16–S18 — flatten a store category map into an ordered item list.

A store document is an object whose dict-valued entries hold ``name`` and
``items``; other entries (scalars, strings) are skipped, and a category with no
``items`` yields nothing.  Document order matters (the head-N keeps the first
items), so the map is read with ``from_json(…, 'map<string,variant>')`` +
``posexplode``, which keep key order — unlike exploding the VARIANT object,
which returns keys sorted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapmart.functions.variant import as_number, as_string
from snapmart.operators.flatten import flatten

CATEGORY_MAP = "map<string,variant>"


def flatten_categories(docs: DataFrame, doc_col: str, keep: list[str]) -> DataFrame:
    """Rows (keep…, cat_pos, category_key, category_name, item_pos, item).

    A malformed document raises (S9): it must not pass as one without items.
    """
    cats = docs.select(*keep, F.posexplode(F.from_json(doc_col, CATEGORY_MAP, {"mode": "FAILFAST"}))
                       .alias("cat_pos", "category_key", "_cat"))
    # no object test needed: a scalar, string or array entry has no ``$.items``
    # path (it yields no rows), exactly like an object without ``items``
    cats = cats.withColumn("category_name", as_string("_cat", "$.name"))
    items = flatten(cats, "_cat", "$.items", "item",
                    keep=[*keep, "cat_pos", "category_key", "category_name"])
    return items


def after_cursor(items: DataFrame, last_appid: int | None, item_col: str = "item") -> DataFrame:
    """Drop items with ``id <= last_appid``; a missing or NULL id counts as 0."""
    if last_appid is None:
        return items
    return items.where(F.coalesce(as_number(item_col, "$.id"), F.lit(0)) > F.lit(last_appid))


def item_count(doc_col: str) -> Column:
    """Items of a whole document: the sum of its categories' array sizes, without exploding them."""
    sizes = F.transform(F.map_values(F.from_json(doc_col, CATEGORY_MAP, {"mode": "FAILFAST"})),
                        lambda c: F.coalesce(F.size(F.try_variant_get(c, "$.items", "array<variant>")), F.lit(0)))
    return F.aggregate(sizes, F.lit(0).cast("bigint"), lambda a, n: a + F.greatest(n, F.lit(0)))


#: Pairs of document and category sent to every task; beyond that their join shuffles.
MANY_PAIRS = 500_000


def head_in_place(docs: DataFrame, doc_col: str, by: list[str], order: list[str], limit: int) -> DataFrame:
    """S18/O4 over documents that belong together (equal ``by``): their first ``limit`` items, and ``total_available``.

    The documents of a group read as one whose categories go on from document to document
    (``order``): items are ordered by category position, document and place in it.  Only
    array sizes are read at first.  A category of a document that holds an item of the head
    is among the group's first ``limit`` ones that are not empty (a bounded top-N), and a running sum
    over those says how many of its items belong to the head.  Just these are sliced from
    its array, so no more than ``limit`` items of a group are ever exploded.
    """
    from snapmart.operators.dedup import keep_top
    from snapmart.session import fresh_dir

    spark = docs.sparkSession
    entries = F.map_entries(F.from_json(doc_col, CATEGORY_MAP, {"mode": "FAILFAST"}))
    sizes = F.transform(entries, lambda e: F.coalesce(F.greatest(F.size(F.try_variant_get(e["value"], "$.items", "array<variant>")), F.lit(0)), F.lit(0)))
    counted_dir, pairs_dir = fresh_dir(spark, "category-sizes"), fresh_dir(spark, "head-pairs")
    docs.select(*by, *order, F.posexplode(sizes).alias("cat_pos", "_n")).write.parquet(counted_dir)
    counted = spark.read.parquet(counted_dir)
    first = keep_top(counted.where("_n > 0"), by, [F.col("cat_pos"), *[F.col(c) for c in order]], limit)
    before = Window.partitionBy(*by).orderBy("cat_pos", *order).rowsBetween(Window.unboundedPreceding, -1)
    pairs = first.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).where(F.col("_before") < limit)
    pairs.groupBy(*by, *order).agg(F.collect_list(F.struct("cat_pos", "_before")).alias("_pairs")).write.parquet(pairs_dir)
    pairs = spark.read.parquet(pairs_dir)
    chosen = docs.join(F.broadcast(pairs) if pairs.count() <= MANY_PAIRS else pairs, [*by, *order])
    chosen = chosen.select(*by, *order, entries.alias("_cats"), F.explode("_pairs").alias("_pair"))
    cat = F.get("_cats", F.col("_pair.cat_pos"))
    items = F.slice(F.try_variant_get(cat["value"], "$.items", "array<variant>"), F.lit(1), (F.lit(limit) - F.col("_pair._before")).cast("int"))
    head = chosen.select(*by, *order, F.col("_pair.cat_pos").alias("cat_pos"), cat["key"].alias("category_key"),
                         as_string(cat["value"], "$.name").alias("category_name"), F.col("_pair._before").alias("_before"),
                         F.posexplode(items).alias("item_pos", "item"))
    totals = counted.groupBy(*by).agg(F.sum("_n").cast("bigint").alias("total_available"))
    ranked = head.withColumn("item_rank", (F.col("_before") + F.col("item_pos") + 1).cast("int")).drop("_before")
    return ranked.join(totals, by)


def head_with_total(items: DataFrame, doc_keys: list[str], order: list[Column], limit: int,
                    totals: DataFrame | None = None) -> DataFrame:
    """First ``limit`` items per document in order, with the pre-cut total.

    Without ``totals`` (``doc_keys`` and ``total_available``, for instance from
    ``item_count``) a document's items are counted in the sort that ranks them: one pass
    over the items, one shuffle.  Documents with a NULL key are left out, as by a join with totals.
    """
    from snapmart.operators.dedup import keep_top
    if totals is None:
        whole = items.where(reduce(Column.__and__, [F.col(k).isNotNull() for k in doc_keys]))
        counted = whole.withColumn("total_available", F.count(F.lit(1)).over(Window.partitionBy(*doc_keys)))
        return keep_top(counted, doc_keys, order, limit, rank_col="item_rank")
    head = keep_top(items, doc_keys, order, limit, rank_col="item_rank")
    return head.join(totals, on=doc_keys, how="inner")
