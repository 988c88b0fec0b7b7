"""The merge with a filter over the delta keys, NULL keys, and chains of deltas."""

import random
from functools import reduce

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.keyfilter import asked, common_types, distinct_keys, key_filter
from ledgerline.operators.merge import merge_by_key, merge_chain, prefilter_for, unchanged_rows
from ledgerline.plans.versions import merge_chain_version, merge_version


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_filter_never_misses_and_rules_most_others_out(spark):
    keys = spark.range(0, 200_000, 2).select(F.col("id").alias("k"), F.concat(F.lit("x"), F.col("id") % 1000).alias("s"))
    rows = spark.range(400_000).select(F.col("id").alias("k"), F.concat(F.lit("x"), F.col("id") % 1000).alias("s"))
    ks, types = ["k", "s"], common_types(rows, keys, ["k", "s"])
    found = key_filter(distinct_keys(keys, ks, types), ks, types)
    told = asked(rows, found, ks, types, "maybe").groupBy((F.col("k") < 200_000) & (F.col("k") % 2 == 0), "maybe").count().collect()
    count = {(r[0], r["maybe"]): r["count"] for r in told}
    assert found.n_keys == 100_000 and (True, False) not in count and count[True, True] == 100_000
    assert count[False, True] < 0.05 * 300_000
    assert key_filter(found.distinct, ks, types, max_bytes=1000) is None


@pytest.mark.parametrize("types", [("int", "bigint"), ("bigint", "int"), ("string", "string"), ("double", "double"), ("date", "date"), ("decimal(9,2)", "decimal(12,3)")])
def test_filtered_merge_equals_the_plain_one(spark, types):
    rnd = random.Random(1)
    rows = lambda n, tag: [(rnd.choice([None, *range(300)]), rnd.choice([None, 1, 2]), f"{tag}{i}") for i in range(n)]
    cast = lambda df, t: df.withColumn("k", F.date_add(F.lit("2020-01-01").cast("date"), F.col("k")) if t == "date" else F.col("k").cast(t))
    base = cast(spark.createDataFrame(rows(800, "b"), "k int, l int, v string"), types[0])
    deltas = cast(spark.createDataFrame(rows(200, "d"), "k int, l int, v string"), types[1])
    for ks in ("k", ["k", "l"]):
        plain = merge_by_key(base, deltas, ks)
        found = prefilter_for(base, deltas, ks, few=0)
        assert _sorted(merge_by_key(base, deltas, ks, found)) == _sorted(plain)
        assert unchanged_rows(base, deltas, ks, found).schema["k"].dataType == base.schema["k"].dataType == unchanged_rows(base, deltas, ks).schema["k"].dataType
    assert _sorted(merge_by_key(base, deltas.limit(0), "k", prefilter_for(base, deltas.limit(0), "k", few=-1))) == _sorted(base)


def test_only_possible_matches_are_exchanged(spark, scratch):
    own = scratch("base")
    spark.range(100_000).select(F.col("id").alias("k"), F.lit("b").alias("v")).write.parquet(own)
    base = spark.read.parquet(own)
    deltas = spark.range(0, 100_000, 100).select(F.col("id").alias("k"), F.lit("d").alias("v"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = prefilter_for(base, deltas, "k", few=0)
        out = unchanged_rows(base, deltas, "k", found)
        assert out.count() == 99_000
        plan = _plan(out)
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" in plan and "Union" in plan
        passed = asked(base, found, ["k"], {"k": "bigint"}, "maybe").filter("maybe").count()
        assert 1_000 <= passed < 1_000 + 0.05 * 100_000  # what goes through the exchange
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_null_keys_are_dealt_over_the_tasks(spark):
    """With broadcast and AQE off the join's tasks hold about the same number of rows."""
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in off}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        base = spark.range(100_000).select(F.when(F.col("id") % 10 == 0, F.col("id")).alias("k"), F.col("id").alias("v"))
        out = unchanged_rows(base, spark.range(50).select(F.col("id").alias("k"), F.col("id").alias("v")), "k")
        assert "SortMergeJoin" in _plan(out)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 100_000 - 5 and max(sizes) < 3 * 100_000 / 16
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("prefilter", [False, True])
def test_a_chain_equals_single_merges(spark, prefilter):
    rnd = random.Random(6)
    table = lambda n, tag: spark.createDataFrame([(rnd.choice([None, *range(40)]), rnd.randrange(2), f"{tag}{i}") for i in range(n)], "k int, l int, v string")
    base, deltas = table(60, "b"), [table(25, "x"), table(0, "y"), table(30, "z").select("v", "l", "k")]
    for ks in ("k", ["k", "l"]):
        one_by_one = reduce(lambda b, d: merge_by_key(b, d, ks), deltas, base)
        assert _sorted(merge_chain(base, deltas, ks, prefilter=prefilter, **({"few": 0} if prefilter else {}))) == _sorted(one_by_one)
    assert _sorted(merge_chain(base, [], "k")) == _sorted(base)
    with pytest.raises(ValueError):
        merge_chain(base, [base.drop("v")], "k")


def test_a_chain_reads_the_base_once(spark, scratch):
    own = scratch("chain")
    spark.range(100).select(F.col("id").alias("k"), F.lit("only_base").alias("v")).write.parquet(own)
    base = spark.read.parquet(own)
    deltas = [spark.range(i, 100, 10).select(F.col("id").alias("k"), F.lit(str(i)).alias("v")) for i in range(4)]
    assert _plan(merge_chain(base, deltas, "k")).count("FileScan") == 1


def test_versions(spark, scratch):
    name = "chain_" + scratch("n").rsplit("/", 1)[-1]
    for table, rows in {name: [(1, "a"), (2, "b"), (3, "c")], f"{name}_deltas_v1": [(2, "B")], f"{name}_deltas_v2": [(2, "BB"), (4, "D")]}.items():
        spark.createDataFrame(rows, "k int, v string").write.option("path", scratch("t")).saveAsTable(table)
    out = merge_chain_version(spark, name, ["v1", "v2"], "k", path=scratch("t"))
    assert out == f"{name}_v2" and _sorted(spark.table(out)) == _sorted(spark.createDataFrame([(1, "a"), (3, "c"), (2, "BB"), (4, "D")], "k int, v string"))
    filtered = merge_version(spark, name, spark.table(f"{name}_deltas_v2"), "k", version="f", path=scratch("t"), few=0)
    assert _sorted(spark.table(filtered)) == _sorted(merge_by_key(spark.table(name), spark.table(f"{name}_deltas_v2"), "k"))
