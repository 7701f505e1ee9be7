"""Stores by source: what a scan opens, and joins without a shuffle."""

import re

import pytest
from pyspark.sql import functions as F

from waymark.operators import layout
from waymark.sources.shared import scratch

BUCKETS = 32


@pytest.fixture(scope="module")
def events(spark):
    rows = spark.range(20_000).selectExpr("if(id % 3 = 0, 'getsituation', 'gettraveltimedata') as feed", "concat('s', id % 500) as source_id", "lpad(cast(id as string), 19, '0') as row_key", "timestamp_seconds(1420070400 + id * 30) as publication_time", "concat('x', id) as xml")
    return rows


@pytest.fixture(scope="module")
def store(spark, events):
    return layout.write_by_source(events, layout.fresh_name(), scratch(spark), BUCKETS, 1000)


def buckets_read(spark, make):
    """Buckets, each of one file, that the scan of a query opens. A plan tells only where scans go by bucket throughout."""
    name = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    spark.conf.set(name, "false")
    try:
        plan = make()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(name)
    found = re.search(r"SelectedBucketsCount: (\d+) out of (\d+)", plan)
    return tuple(map(int, found.groups())), plan


def test_a_scan_of_ten_sources_opens_their_buckets(spark, events, store):
    ids = spark.createDataFrame([("GetSituation", f"s{k}") for k in range(0, 30, 3)] + [("gettraveltimedata", "s1")], "feed string, source_id string")
    found = layout.scan_by_source(store, ids, "getsituation")
    expect = events.filter("feed = 'getsituation'").filter(F.col("source_id").isin([f"s{k}" for k in range(0, 30, 3)]))
    assert sorted(r.row_key for r in found.collect()) == sorted(r.row_key for r in expect.collect())
    (some, every), plan = buckets_read(spark, lambda: layout.scan_by_source(store, ids, "getsituation"))
    assert len(store.inputFiles()) == every == BUCKETS and 0 < some <= 10
    assert "In(source_key" in plan or "Or(" in plan


def test_many_sources_are_joined(spark, events, store, monkeypatch):
    monkeypatch.setattr(layout, "_LISTED", 5)
    ids = spark.range(100).selectExpr("'getsituation' as feed", "concat('s', id) as source_id")
    got = layout.scan_by_source(store, ids, "getsituation", "2015-01-02", "2015-01-03")
    t = F.col("publication_time")
    expect = events.filter("feed = 'getsituation' and cast(substring(source_id, 2) as int) < 100").filter((t > "2015-01-02") & (t <= "2015-01-04"))
    assert sorted(r.row_key for r in got.collect()) == sorted(r.row_key for r in expect.collect()) and got.count() > 0


def test_stores_join_without_a_shuffle(spark, events, store):
    other = events.groupBy("feed", "source_id").agg(F.count("*").alias("n"), F.max("row_key").alias("row_key"))
    second = layout.write_by_source(other, layout.fresh_name(), scratch(spark), BUCKETS)
    joined = layout.join_by_source(store, second)
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    expect = events.join(other.drop("row_key"), ["feed", "source_id"]).select("feed", "source_id", "row_key", "n")
    assert sorted(map(tuple, joined.select("feed", "source_id", "row_key", "n").collect())) == sorted(map(tuple, expect.collect()))
    newest = layout.join_by_source(store, second, ("row_key",))
    assert "Exchange" not in newest._jdf.queryExecution().executedPlan().toString()
    assert newest.count() == other.count() and {r.row_key for r in newest.collect()} == {r.row_key for r in other.collect()}


def test_compaction_leaves_one_file_a_bucket(spark, events, store):
    more = spark.createDataFrame([("getsituation", "new/one", "9", None, "y"), ("gettraveltimedata", None, "8", None, None)], "feed string, source_id string, row_key string, publication_time timestamp, xml string")
    both = layout.compact_by_source(store, more, layout.fresh_name(), scratch(spark), BUCKETS)
    assert both.count() == 20_002 and len(both.inputFiles()) == BUCKETS and store.count() == 20_000
    ids = spark.createDataFrame([("getsituation", "new/one")], "feed string, source_id string")
    assert [r.xml for r in layout.scan_by_source(both, ids, "getsituation").collect()] == ["y"]
    assert layout.scan_by_source(both, ids.filter("false"), "getsituation").isEmpty()
