"""Tasks of the derived exports stay small, whatever the number of rows."""

import hashlib
import os
import re

import pytest
from pyspark.sql import functions as F

from tessera.plans import export_frame as frames
from tessera.plans import export_import
from tessera.plans.wide_export import EXPORT_COLUMNS, wide_export_frame
from tessera.session import SHUFFLE_CLEANUP
from tessera.sources.sharded_csv import list_shards, read_sharded_csv, write_sharded_csv


@pytest.fixture()
def tables(spark, tmp_dir):
    spark.range(60).selectExpr(
        "id as l_orderkey", "id % 6 as l_partkey", "id % 5 as l_suppkey", "cast(id % 7 + 1 as int) as l_linenumber",
        "cast(id % 50 as double) as l_quantity", "0.08d as l_discount", "0.01d as l_tax", "'R' as l_returnflag", "'F' as l_linestatus",
        "timestamp'1998-01-01' as l_shipdate").write.parquet(os.path.join(tmp_dir, "lineitem.parquet"))
    spark.range(6).selectExpr("id as p_partkey", "concat('p', id) as p_name", "'t' as p_type").write.parquet(
        os.path.join(tmp_dir, "part.parquet"))
    return tmp_dir


def test_join_tasks_follow_the_rows(spark, tables, monkeypatch):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    want = sorted(map(repr, frames.export_frame(spark, tables).collect()))
    monkeypatch.setattr(frames, "JOIN_ROWS", 3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = frames.export_frame(spark, tables)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and plan.count(", 21)") >= 2  # both sides, in 60 // 3 + 1 parts
        assert sorted(map(repr, df.collect())) == want and len(want) == 60
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_large_shards_grow_in_number(spark, tables, monkeypatch):
    seen = []
    real = export_import.write_sharded_csv
    monkeypatch.setattr(export_import, "write_sharded_csv", lambda df, out, *a, **b: seen.append(out) or real(df, out, *a, **b))
    monkeypatch.setattr(export_import, "SPLIT_SHARD_ROWS", 10)
    assert export_import.q_import_in_splits(spark, tables).count() == 60
    assert 2 < len(list_shards(spark, seen[0])) <= 7


def test_packed_shards_read_like_plain_ones(spark, tmp_dir):
    df = spark.range(90).selectExpr("id as k", "concat('a\n\"', id, '\", b') as v")
    rows = []
    for codec, ending in ((None, ".csv"), ("gzip", ".csv.gz")):
        out = os.path.join(tmp_dir, f"out{codec}")
        paths = write_sharded_csv(df, out, "t", 11, ["G", "G"], ["k", "v"], shard_col=F.col("k") % 11, codec=codec)
        assert [p.rsplit("/", 1)[-1] for p in paths] == [f"t_{n:02d}{ending}" for n in range(11)]
        rows += [sorted(map(tuple, read_sharded_csv(spark, out, casts={"G - k": "bigint"}, split=split).collect())) for split in (None, True)]
    assert rows == [sorted(map(tuple, df.collect()))] * 4


def test_digests_sort_no_rows(spark):
    df = spark.createDataFrame([(1, None, "b"), (None, 2.5, "a"), (3, 0.5, None)], "i int, d double, s string")
    digests = export_import.column_digests(df)
    got = {r.column_name: tuple(r)[1:] for r in digests.collect()}
    want = sum(int(hashlib.md5(x).hexdigest()[:8], 16) for x in (b"a", b"b"))
    assert got == {"i": ("int", 3, 2, 8, 1.0, 3.0, None, None), "d": ("double", 3, 2, 6, 0.5, 2.5, None, None),
                   "s": ("string", 3, 2, None, None, None, want, "b")}
    assert " Sort " not in digests._jdf.queryExecution().executedPlan().toString()


def test_rows_are_dealt_before_they_widen(spark, tables):
    # one scan task and a broadcast join, but a task for each 10 rows that are widened
    wide = wide_export_frame(spark, tables, task_rows=10)
    assert wide.rdd.getNumPartitions() == 7
    assert sorted(map(repr, wide.collect())) == sorted(map(repr, wide_export_frame(spark, tables).collect()))


def test_wide_rows_are_dealt_as_narrow_ones(spark, tables, monkeypatch):
    width = []
    frame = type(spark.range(1))
    real = frame.repartitionById
    monkeypatch.setattr(frame, "repartitionById", lambda self, *a: width.append(len(self.columns)) or real(self, *a))
    n_rows = {r.n_rows for r in export_import.q_import_wide(spark, tables).collect()}
    assert n_rows == {60} and width == [len(EXPORT_COLUMNS) + 3]  # shard, rank and order beside E


def test_columns_made_where_shards_are_written(spark, tmp_dir):
    df = spark.range(40).selectExpr("id as k", "if(id % 3 = 0, null, id + 0.5d) as d")
    made = [F.col("k"), (F.col("k") + 1).alias("next"), F.concat(F.lit('a\n"'), F.col("d").cast("string")).alias("text")]
    rows = []
    for name, frame, columns in (("wide", df.select(*made), None), ("narrow", df, made)):
        out = os.path.join(tmp_dir, name)
        write_sharded_csv(frame, out, "t", 3, ["G", "", None], ["k", "n", "t"], shard_col=F.col("k") % 3, order_col=-F.col("k"), columns=columns)
        rows.append([open(p.removeprefix("file:"), newline="").read() for p in list_shards(spark, out)])
    assert rows[0] == rows[1] and rows[0][0].startswith('G,"",\nk,n,t\n39,40,\n')
    with pytest.raises(ValueError, match="one group and one field"):
        write_sharded_csv(df, out, "t", 3, ["G", "G"], ["k", "n"], shard_col=F.col("k") % 3, columns=made)


def test_shuffle_files_go_when_shards_are_written(spark, tmp_dir):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffle_files():
        return set(re.findall(r"shuffle_\d+_\d+_\d+\.\w+", blocks.getAllFiles().mkString(" ")))

    before = shuffle_files()
    write_sharded_csv(spark.range(90), os.path.join(tmp_dir, "out"), "t", 3, ["G"], ["k"], shard_col=F.col("id") % 3)
    assert shuffle_files() <= before
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"
