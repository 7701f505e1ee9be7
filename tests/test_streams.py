"""The by-name stream source, change detection over it, and what change detection moves."""

import json
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from waymark.operators import changes, convert, profile, select
from waymark.plans import jobs
from waymark.sources import records
from waymark.sources.registry import with_elements
from waymark.sources.shared import scratch
from waymark.sources.snapshots import read_snapshots
from waymark.streaming import feeds, source

FEED = "getsituation"


def snapshot(k, records, head="<m>"):
    own = "".join(f'<situation id="{i}"><v>{v}</v></situation>' for i, v in records)
    return f"{head}<publicationTime>2015-01-{1 + k // 24:02}T{k % 24:02}:00:00Z</publicationTime>{own}</m>"


def name_of(k):
    return f"2015/01/{1 + k // 24:02}/{k % 24:02}0000"


def land(root, name, text, feed=FEED):
    path = root / feed / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def history(seed, n):
    rng = np.random.default_rng(seed)
    out = []
    for k in range(n):
        own = [(f"s{i}", int(rng.integers(0, 3))) for i in range(12) if rng.random() < 0.8]
        out.append(snapshot(k, own) if rng.random() > 0.15 else "<m><broken")
    return out


def drained(spark, landing, out, checkpoint, per_feed, feeds_=(FEED,)):
    """Runs, of one batch each, until one takes nothing; the names of each batch."""
    batches, run = [], feeds.change_batch(str(out))

    def batch(df, number):
        batches.append(sorted((r.feed, r.seq, r.snapshot_name) for r in df.select("feed", "seq", "snapshot_name").collect()))
        run(df, number)

    while True:
        before = len(batches)
        stream = with_elements(source.stream_by_name(spark, str(landing), str(checkpoint), per_feed, feeds=feeds_))
        stream.writeStream.foreachBatch(batch).option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start().awaitTermination()
        if len(batches) == before or not batches[-1]:
            return [b for b in batches if b]


def events_of(spark, out):
    return sorted((r.source_id, r.snapshot_name, r.xml) for r in spark.read.parquet(f"{out}/events").collect())


@pytest.mark.parametrize("per_feed", [5, 20])
def test_stream_by_name_equals_the_batch(spark, tmp_path, per_feed):
    """Files that arrive in any order of time come by name, at most so many in a batch, over restarts of the query."""
    landing, texts = tmp_path / "in", history(1, 13)
    for k in np.random.default_rng(0).permutation(13):
        land(landing, name_of(int(k)), texts[k])
    batches = drained(spark, landing, tmp_path / "out", tmp_path / "cp", per_feed)
    assert [x for b in batches for x in b] == [(FEED, k + 1, name_of(k)) for k in range(13)]
    assert max(map(len, batches)) == min(per_feed, 13)
    events, _ = jobs.snapshots_to_events(with_elements(read_snapshots(spark, str(landing))))
    assert events_of(spark, tmp_path / "out") == sorted((r.source_id, r.snapshot_name, r.xml) for r in events.collect())


def test_names_at_or_below_the_offset_are_late(spark, tmp_path):
    landing, out, cp = tmp_path / "in", tmp_path / "out", tmp_path / "cp"
    for k in (2, 5):
        land(landing, name_of(k), snapshot(k, [("a", k)]))
    drained(spark, landing, out, cp, 10)
    for k in (1, 3, 5, 6):  # two are late, one is there already, one is new
        land(landing, name_of(k), snapshot(k, [("a", 10 + k)]))
    assert drained(spark, landing, out, cp, 10)[-1:] == [[(FEED, 3, name_of(6))]]
    assert [x for _, x, _ in events_of(spark, out)] == [name_of(2), name_of(5), name_of(6)]
    held = spark.read.parquet(str(out / "carry"))
    assert "xml" not in held.columns and "content_hash" in held.columns


def test_feeds_go_on_by_their_own_names(spark, tmp_path):
    landing = tmp_path / "in"
    for k in range(5):
        land(landing, name_of(k), snapshot(k, [("a", k)]))
        land(landing, name_of(k + 40), snapshot(k, [("b", k)]), "getpredefinedtraveltimelocations")
    batches = drained(spark, landing, tmp_path / "out", tmp_path / "cp", 3, (FEED, "getpredefinedtraveltimelocations"))
    assert [len(b) for b in batches] == [6, 4]


def test_a_planned_batch_is_the_same_on_a_replay(tmp_path):
    """What lands between two names of a batch after it was planned isn't in it; a new reader goes on where the log says."""
    landing = tmp_path / "in"
    for k in (1, 3, 4):
        land(landing, name_of(k), "x")
    options = {"path": str(landing), "perFeed": "2", "feeds": FEED, "checkpoint": str(tmp_path / "cp")}
    reader = source.SnapshotReader(options)
    start, end = reader.initialOffset(), reader.latestOffset()
    assert reader.latestOffset() == end
    (tmp_path / "cp" / "offsets").mkdir(parents=True)
    (tmp_path / "cp" / "offsets" / "0").write_text("v1\n{}\n" + json.dumps(end))
    land(landing, name_of(2), "x")
    again = source.SnapshotReader(options)
    for r in (reader, again):
        assert [(p.name, p.seq) for p in r.partitions(start, end)] == [(name_of(1), 1), (name_of(3), 2)]
        assert r.latestOffset()[FEED]["name"] == name_of(4) and r.latestOffset()[FEED]["seq"] == 3
        assert r.partitions(end, end) == []
    assert [x[0] for x in reader.read(reader.partitions(start, end)[0])] == [FEED]


def found_in(spark, size):
    """Events of 40 snapshots of 50 records, each of so many bytes, and the plan that found them."""
    rows = spark.range(2000).selectExpr("'f' as feed", "lpad(cast(id div 50 as string), 3, '0') as snapshot_name", "timestamp_seconds(id div 50) as publication_time", "cast(id % 50 as int) as ordinal", "cast(id % 50 as string) as source_id")
    rows = rows.withColumn("xml", F.concat(F.lpad(((F.col("snapshot_name").cast("int") * 7 + F.col("ordinal")) % 3).cast("string"), size, "x"), F.lit("")))
    kept = records.located(rows, scratch(spark))
    events = changes.upsert_events(changes.as_events(changes.change_events(kept)))
    got = records.fetched(events)
    out = got.select("source_id", "snapshot_name", F.length("xml").alias("n"), "length").collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    return out, plan


def test_shuffles_hold_no_payload(spark):
    few, plan = found_in(spark, 1000)
    many, _ = found_in(spark, 100_000)
    assert {(r.source_id, r.snapshot_name) for r in few} == {(r.source_id, r.snapshot_name) for r in many} and 0 < len(few) < 2000 + 1
    assert all(r.n == r.length == 1000 for r in few) and all(r.n == r.length == 100_000 for r in many)
    scans = re.findall(r"ReadSchema: (struct<[^\n]*)", plan)
    assert scans and all("xml" not in s for s in scans)


def test_fetched_texts_are_their_rows_own(spark):
    rows = spark.range(0, 3000, 1, 5).selectExpr("id", "case when id % 7 = 0 then null else concat('r', id) end as xml")
    spark.conf.set("parquet.block.size", "4096")
    try:
        got = records.fetched(records.located(rows, scratch(spark) + " a%b ø").filter("id % 3 = 1"))
        assert {(r.id, r.xml) for r in got.collect()} == {(i, None if i % 7 == 0 else f"r{i}") for i in range(1, 3000, 3)}
        assert got.columns == ["id", "length", "xml"] and records.fetched(records.located(rows.filter("false"), scratch(spark))).isEmpty()
    finally:
        spark.conf.unset("parquet.block.size")


@pytest.mark.parametrize("parts", [1, 7])
def test_partitioning_changes_nothing(spark, parts):
    rows = spark.createDataFrame([("f", f"{s}", f"{i}", f"{(s * i) % 4}") for s in range(9) for i in range(20) if (s + i) % 6], "feed string, snapshot_name string, source_id string, xml string").repartition(parts)
    for method in ("window", "join"):
        got = changes.change_events(rows, method=method)
        assert sorted((r.snapshot_name, r.source_id) for r in got.collect()) == sorted((r.snapshot_name, r.source_id) for r in changes.change_events(rows.coalesce(1)).collect())


def test_properties_of_odd_documents(spark):
    deep = '{"a":' * 50_000 + "1" + "}" * 50_000
    docs = spark.createDataFrame([("bad", "{bad"), ("deep", deep), ("null", None), ("list", "[1]"), ("good", '{"a":{"b":1},"c":[{"d":2}]}')], "doc_id string, json string")
    got = [(r.doc_id, r.position, r.path, r.kind) for r in convert.flatten_properties(docs).collect()]
    assert got == [("good", 0, "a", "object"), ("good", 1, "a.b", "int"), ("good", 2, "c", "array")]
    nested = '{"a":' * 900 + "1" + "}" * 900
    assert convert.flatten_properties(spark.createDataFrame([("n", nested)], "doc_id string, json string")).count() == 900


def test_quiet_feeds_have_zero_volume(spark):
    events = spark.createDataFrame([("f", "s", "1", 3000)], "feed string, source_id string, row_key string, length long").withColumn("event_date", F.lit("2024-01-08").cast("date"))
    listed = spark.createDataFrame([("f",), ("g",), ("g",)], "feed string")
    got = {r.feed: (r.sources, r.events, r.bytes, r.mean_kb) for r in profile.day_volume(events, "2024-01-08", listed).collect()}
    assert got == {"f": (1, 1, 3000, 2), "g": (0, 0, 0, None)}
    assert profile.day_volume(events, "2024-01-09").isEmpty()


def test_positions_need_no_checkpoint_folder_of_the_context(spark):
    assert sorted(tuple(r) for r in select.zip_by_position(spark.createDataFrame([(3,), (1,)], "a int"), ["a"], spark.createDataFrame([(9,), (8,), (7,)], "b int"), ["b"]).collect()) == [(0, 1, 7), (1, 3, 8)]
