from __future__ import annotations

import pytest

from feedquality import size_shuffles
from feedquality.session import SHUFFLE_BYTES, scratch_path, shared_dir, stage, stage_buckets, staging

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def test_shuffles_start_with_partitions_for_the_input(spark):
    try:
        assert size_shuffles(spark, 1) == spark.sparkContext.defaultParallelism
        assert size_shuffles(spark, 1000 * SHUFFLE_BYTES) == 1000
        assert spark.conf.get(INITIAL) == "1000"
        assert size_shuffles(spark, 10**14) == 745_059
    finally:
        spark.conf.unset(INITIAL)


class FakeSession:
    def __init__(self, **configured):
        known = {k.replace("_", "."): v for k, v in configured.items()}
        self.conf = type("Conf", (), {"get": lambda self, key, *default: known.get(key, *default)})()


def test_the_shared_folder_is_the_clusters(spark):
    assert shared_dir(FakeSession(spark_checkpoint_dir="hdfs:///shared/")) == "hdfs:///shared"
    # never a folder of one machine: without a setting, where Spark keeps its tables
    assert shared_dir(FakeSession(spark_sql_warehouse_dir="hdfs:///warehouse")) == "hdfs:///warehouse"
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_threads_keep_their_staged_copies_apart(spark):
    from concurrent.futures import ThreadPoolExecutor
    from threading import Barrier
    both = Barrier(2)

    def work(last):
        with staging(spark):
            staged = stage(spark.range(7), "t")
            both.wait(60)
            if last:
                both.wait(60)
            rows = staged.count()
        if not last:
            both.wait(60)
        return rows

    with ThreadPoolExecutor(2) as pool:
        assert list(pool.map(work, [False, True])) == [7, 7]


def test_staging_cuts_the_lineage(spark):
    staged = stage(spark.range(10).selectExpr("id", "named_struct('a', id) as s"), "t")
    assert staged.count() == 10 and staged.schema.simpleString() == "struct<id:bigint,s:struct<a:bigint>>"
    assert "Range" not in staged._jdf.queryExecution().executedPlan().toString()


def test_staged_copies_go_with_their_context(spark, tmp_path):
    from pathlib import Path
    folder = Path(shared_dir(spark)) / "feedquality"
    before = set(folder.iterdir()) if folder.exists() else set()
    with staging(spark):
        stage(stage(spark.range(5).toDF("id"), "a"), "b").write.parquet(str(tmp_path / "kept"))
        assert len(set(folder.iterdir()) - before) == 2
    assert set(folder.iterdir()) == before
    with pytest.raises(ZeroDivisionError), staging(spark):
        stage(spark.range(5).toDF("id"), "a")
        1 / 0
    assert set(folder.iterdir()) == before


def test_a_copy_in_buckets_stays_where_it_lies_in_a_join(spark, monkeypatch):
    from pathlib import Path
    monkeypatch.setattr("feedquality.session.MOST_BUCKETS", 8)
    tables = len(spark.catalog.listTables())
    data = spark.range(200).selectExpr("cast(cast(id % 90 as string) as binary) as v", "id")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    with staging(spark):
        path = Path(shared_dir(spark)) / "feedquality"
        before = set(path.iterdir()) if path.exists() else set()
        staged = stage_buckets(data, "wide", "v")
        assert len(spark.catalog.listTables()) == tables and len(set(path.iterdir()) - before) == 1
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            other = spark.range(0, 200, 2).selectExpr("cast(cast(id as string) as binary) as b", "id as other")
            joined = other.join(staged.withColumnRenamed("v", "b"), "b")
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
            assert sorted(map(tuple, joined.select("other", "id").collect())) == sorted(
                (o, i) for o in range(0, 200, 2) for i in range(200) if i % 90 == o)
            assert stage_buckets(data.limit(0), "none", "v").count() == 0
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert set(path.iterdir()) == before
