"""K1, K4, K5/S6, K7, K9, K11."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerline.plans.versions import merge_version, version_stamp
from ledgerline.sinks.tables import (
    append_partitioned,
    create_like,
    insert_into,
    offset_deltas_name,
    overwrite_partitions,
    table_columns,
    version_names,
    write_delimited,
    write_version,
)
from ledgerline.sources.delimited import read_delimited


def _status(spark):
    return spark.createDataFrame(
        [(1, "a|b", 5, 1, 2, 3), (2, 'q"\nr', 5, 1, 3, 4), (3, None, 6, 2, 0, 0)],
        "id long, text string, mon int, day int, hour int, x int",
    )


def test_partitioned_append_prunes(spark, scratch):
    path = scratch("status")
    append_partitioned(_status(spark), path=path)
    append_partitioned(_status(spark), path=path)
    back = spark.read.parquet(path)
    assert back.count() == 6
    q = back.filter((F.col("mon") == 5) & (F.col("day") == 1))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "mon" in plan
    assert q.count() == 4
    local = path[len("file:"):] if path.startswith("file:") else path
    assert {d for d in os.listdir(local) if d.startswith("mon=")} == {"mon=5", "mon=6"}


def test_dynamic_overwrite_is_idempotent(spark, scratch):
    path = scratch("batches")
    df = _status(spark).withColumn("batch_id", F.lit(7))
    overwrite_partitions(df, path, ["batch_id"])
    overwrite_partitions(df, path, ["batch_id"])
    overwrite_partitions(df.withColumn("batch_id", F.lit(8)), path, ["batch_id"])
    assert spark.read.parquet(path).groupBy("batch_id").count().orderBy("batch_id").collect() == [(7, 3), (8, 3)]


def test_delimited_round_trip_with_pipes_quotes_newlines(spark, scratch):
    df = _status(spark)
    path = scratch("delim")
    write_delimited(df, path)
    back = read_delimited(spark, path, df.schema)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("sep", ["|", "\t", ";;"])
def test_delimited_plain_form_escapes(spark, scratch, sep):
    texts = ["", None, "\\N", "|", "\t", ";;", "a\nb", "\r\n", "\\", "\\n", "\\\\N|", '"', "\x01\x02", "\\1", " x ", "é\u2028"]
    df = spark.createDataFrame([(i, t, t, float(i)) for i, t in enumerate(texts)], "id long, a string, b string, c double")
    path = scratch("plain")
    write_delimited(df, path, sep=sep)
    assert sorted(map(tuple, read_delimited(spark, path, df.schema, sep=sep).collect())) == sorted(map(tuple, df.collect()))


def test_delimited_files_of_other_tools(spark, scratch):
    path = scratch("foreign")
    spark.createDataFrame([('1|say "hi"|2.5',), ("\\N|\\N|\\N",), ("3||0",)], "value string").write.text(path)
    got = read_delimited(spark, path, _foreign())
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, 'say "hi"', 2.5), (None, None, None), (3, "", 0.0)], key=str)
    with pytest.raises(Exception, match="has not 4 fields"):
        read_delimited(spark, path, _foreign().add("more", _foreign()["t"].dataType)).collect()


def _foreign():
    from pyspark.sql import types as T

    return T.StructType().add("k", T.IntegerType()).add("t", T.StringType()).add("v", T.DoubleType())


def test_quoted_form_round_trip(spark, scratch):
    df, path = _status(spark), scratch("quoted")
    write_delimited(df, path, quoted=True)
    back = read_delimited(spark, path, df.schema, quoted=True)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from ledgerline.session import ensure_checkpoint_dir

    conf = SimpleNamespace(get=lambda *a: None)
    spark = SimpleNamespace(sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="spark://host:1"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(spark)


def test_versions_and_create_like(spark, scratch):
    assert version_names("t", "20170120_1527") == {"version": "t_20170120_1527", "deltas": "t_deltas_20170120_1527"}
    assert offset_deltas_name("t", 41) == "t_41_deltas"
    assert len(version_stamp()) == len("20170120_1527")
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    base.write.option("path", scratch("base_tbl")).saveAsTable("base_tbl_t1")
    deltas = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    name = merge_version(spark, "base_tbl_t1", deltas, "k", version="v1", path=scratch("v1"))
    assert name == "base_tbl_t1_v1"
    assert sorted(map(tuple, spark.table(name).collect())) == [(1, "a"), (2, "B"), (3, "C")]
    with pytest.raises(Exception):
        write_version(deltas, "base_tbl_t1", "v1")  # a version is never overwritten
    _status(spark).limit(0).write.partitionBy("mon", "day", "hour").option("path", scratch("tmpl")).saveAsTable("tmpl_t1")
    create_like(spark, "clone_t1", "tmpl_t1", path=scratch("clone"))
    create_like(spark, "clone_t1", "tmpl_t1")  # if absent: second call is a no-op
    cols = table_columns(spark, "clone_t1").collect()
    assert [c["name"] for c in cols] == ["id", "text", "x", "mon", "day", "hour"]
    assert [c["is_partition"] for c in cols] == [False, False, False, True, True, True]
    insert_into(spark, _status(spark).select("id", "text", "x", "mon", "day", "hour"), "clone_t1")
    assert spark.table("clone_t1").count() == 3


def test_cluster_settings_scale_with_input():
    from ledgerline.session import cluster_settings

    small, big = cluster_settings(10 << 30), cluster_settings(100 << 40)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert big["spark.sql.shuffle.partitions"] == "102400"  # 100 TB at ~1 GB per partition
    assert cluster_settings(10 << 50)["spark.sql.shuffle.partitions"] == "200000"
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"
