"""Versioned merge by key."""

from pyspark.sql import functions as F

from ledgerline.operators.merge import merge_by_key, merge_by_key_outer_join, unchanged_rows


def _kv(spark, rows):
    return spark.createDataFrame(rows, "k int, v string")


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: (t[0] is None, t[0], t[1]))


def test_small_exact_case(spark):
    base = _kv(spark, [(1, "a"), (2, "b"), (None, "n")])
    deltas = _kv(spark, [(2, "B"), (3, "C"), (3, "C2"), (None, "dn")])
    got = _sorted(merge_by_key(base, deltas, "k"))
    assert got == [(1, "a"), (2, "B"), (3, "C"), (3, "C2"), (None, "dn"), (None, "n")]
    assert _sorted(merge_by_key_outer_join(base, deltas, "k")) == got


def test_unchanged_rows_keeps_null_keys_and_columns(spark):
    base = _kv(spark, [(1, "a"), (2, "b"), (None, "n")])
    deltas = _kv(spark, [(2, "B"), (None, "x")])
    out = unchanged_rows(base, deltas, ["k"])
    assert out.columns == ["k", "v"]
    assert _sorted(out) == [(1, "a"), (None, "n")]


def test_empty_deltas_is_identity(spark):
    base = _kv(spark, [(1, "a"), (2, "b"), (None, "n")])
    empty = base.limit(0)
    assert _sorted(merge_by_key(base, empty, "k")) == _sorted(base)


def test_merge_is_idempotent_without_null_delta_keys(spark):
    base = _kv(spark, [(1, "a"), (2, "b"), (4, "d")])
    deltas = _kv(spark, [(2, "B"), (3, "C"), (3, "C2")])
    once = merge_by_key(base, deltas, "k")
    twice = merge_by_key(once, deltas, "k")
    assert _sorted(once) == _sorted(twice)
    keys = {r[0] for r in once.collect()}
    assert keys == {1, 2, 3, 4}


def test_composite_key_and_union_by_name(spark):
    base = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (2, 1, "z")], "a int, b int, v string")
    # deltas with columns in another order: union is by name
    deltas = spark.createDataFrame([("Y", 2, 1)], "v string, b int, a int")
    got = sorted(tuple(r) for r in merge_by_key(base, deltas, ["a", "b"]).collect())
    assert got == [(1, 1, "x"), (1, 2, "Y"), (2, 1, "z")]


def test_deltas_missing_a_column_fail(spark):
    base = _kv(spark, [(1, "a")])
    import pytest

    with pytest.raises(ValueError):
        merge_by_key(base, base.select("k"), "k")


def test_plan_is_left_anti_and_keys_are_deduplicated(spark):
    base = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    deltas = spark.range(0, 1000, 3).select(F.lit(7).cast("long").alias("k"), F.lit(0).cast("long").alias("v"))
    plan = merge_by_key(base, deltas, "k")._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan
    assert "HashAggregate" in plan  # the hot delta key collapses before the join
    assert merge_by_key(base, deltas, "k").count() == 999 + deltas.count()


def test_hot_key_result_is_whole(spark):
    # a third of the base rows share one key; all of them stay when deltas miss it
    base = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
                                    F.col("id").alias("v"))
    deltas = spark.range(1, 3000, 3).select(F.col("id").alias("k"), F.lit(-5).cast("long").alias("v"))
    out = merge_by_key(base, deltas, "k")
    assert out.filter("k = -1").count() == 1000
    assert out.count() == 3000


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.sampled_from("abcxyz")), max_size=25)


@settings(max_examples=10, deadline=None, derandomize=True)
@given(base=_rows, deltas=_rows)
def test_merge_equals_outer_join_form(spark, base, deltas):
    b, d = _kv(spark, base), _kv(spark, deltas)
    got = _sorted(merge_by_key(b, d, "k"))
    assert got == _sorted(merge_by_key_outer_join(b, d, "k"))
    # and the definition: base rows whose key is not a non-null delta key, then all deltas
    delta_keys = {k for k, _ in deltas if k is not None}
    want = [r for r in base if r[0] is None or r[0] not in delta_keys] + list(deltas)
    assert got == sorted(want, key=lambda t: (t[0] is None, t[0], t[1]))
