
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from snapmart.operators.merge import fold_latest, upsert

SCHEMA = "k long, v long, t int"

snapshot = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 99)), max_size=6)


def _dedup_run(rows):
    """One run's staged rows: one row per key (NULL keys collapse too), first wins."""
    seen, out = set(), []
    for k, v in rows:
        if k not in seen:
            seen.add(k)
            out.append((k, v))
    return out


def _sequential(history):
    """Brute force: upsert each run into the table in time order (NULL keys never match)."""
    table = []
    for t, rows in enumerate(history):
        run = [(k, v, t) for k, v in _dedup_run(rows)]
        keys = {k for k, _, _ in run if k is not None}
        table = run + [r for r in table if r[0] is None or r[0] not in keys]
    return sorted(table, key=lambda r: (r[0] is None, r[0] or 0, r[2], r[1]))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(snapshot, min_size=1, max_size=4))
def test_fold_equals_sequential_upserts(spark, history):
    rows = [(k, v, t) for t, snap in enumerate(history) for k, v in _dedup_run(snap)]
    df = spark.createDataFrame(rows, SCHEMA) if rows else spark.createDataFrame([], SCHEMA)
    folded = fold_latest(df, "k", [F.col("t").desc()], null_key_by=["t"])
    got = sorted(((r.k, r.v, r.t) for r in folded.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[2], r[1]))
    assert got == _sequential(history)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(snapshot, snapshot)
def test_upsert_is_idempotent_for_non_null_keys(spark, a, b):
    ta = spark.createDataFrame([(k, v, 0) for k, v in _dedup_run(a) if k is not None] or [], SCHEMA)
    ub = spark.createDataFrame([(k, v, 1) for k, v in _dedup_run(b) if k is not None] or [], SCHEMA)
    once = upsert(ta, ub, "k")
    twice = upsert(once, ub, "k")
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 3), st.integers(0, 50)),
                max_size=25, unique_by=lambda r: (r[0], r[1], r[2])))
def test_keep_first_equals_brute_force(spark, rows):
    from snapmart.operators.dedup import keep_first
    df = spark.createDataFrame(rows, "k int, t int, pos int") if rows else spark.createDataFrame([], "k int, t int, pos int")
    got = sorted(((r.k, r.t, r.pos) for r in keep_first(df, ["k"], [F.col("t").desc(), F.col("pos").asc()]).collect()),
                 key=lambda r: (r[0] is None, r[0] or 0))
    best = {}
    for k, t, pos in rows:
        if k not in best or (-t, pos) < (-best[k][1], best[k][2]):
            best[k] = (k, t, pos)
    assert got == sorted(best.values(), key=lambda r: (r[0] is None, r[0] or 0))
