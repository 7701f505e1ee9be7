"""The jobs over files: the extract job and its commits, the history build, document stores."""

import shutil
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from waymark.operators import store as stores
from waymark.operators.store import Conflict, Keyed, Store
from waymark.plans import jobs
from waymark.sources import files, snapshots
from waymark.streaming import feeds

WEATHER = "getmeasuredweatherdata"
#: The first five snapshots of the first day of 2015, and the first one's publication time and size.
FIRST_FIVE = ["2015/01/01/000001", "2015/01/01/000501", "2015/01/01/001503", "2015/01/01/002205", "2015/01/01/003000"]
FIRST_PUBLISHED, FIRST_RECORDS = "2015-01-01T00:59:59.897+01:00", 301


def snapshot(published, records, record="siteMeasurements", ident="measurementSiteReference"):
    own = "".join(f'<{record}><{ident} id="{i}"/><v>{v}</v></{record}>' if record != ident else f'<{record} id="{i}" version="1"><v>{v}</v></{record}>' for i, v in records)
    return f"<m><publicationTime>{published}</publicationTime>{own}</m>"


def land(root, feed, name, text):
    path = root / feed / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


@pytest.fixture
def landing(tmp_path):
    """The weather feed from the evening before on: unchanged, changed, gone, back, broken and repeated records."""
    root = tmp_path / "landing"
    land(root, WEATHER, "2014/12/31/235501", snapshot("2015-01-01T00:55:00+01:00", [("old", 0)]))
    for k, name in enumerate(FIRST_FIVE):
        published = FIRST_PUBLISHED if not k else f"2015-01-01T01:{5 * k:02}:00+01:00"
        land(root, WEATHER, name, snapshot(published, [(f"s{i}", i * (k if i % 10 == 3 else 1)) for i in range(FIRST_RECORDS) if (i + k) % 50 or not k] + [("s5", "later")]))
    land(root, WEATHER, "2015/01/01/003500", "<m><broken")
    for k in range(3):
        land(root, WEATHER, f"2015/01/02/00000{k}", snapshot(f"2015-01-02T01:00:0{k}+01:00", [("s1", k), ("new", 1)]))
    land(root, WEATHER, "LastModified", "2015-01-02T00:00:02")
    return root


def log(spark, root, table="events", feed=WEATHER):
    rows = jobs.read_log(spark, str(root), table, (feed,))
    return sorted(tuple(map(str, r)) for r in rows.select("source_id", "snapshot_name", "row_key", "xml").collect()) if table == "events" else sorted(tuple(r) for r in rows.collect())


def whole(spark, landing):
    """What one run over all snapshots gives."""
    snaps = snapshots.read_snapshots(spark, str(landing)).filter(F.col("feed") == WEATHER)
    events, bad = jobs.snapshots_to_events(jobs.with_elements(snaps))
    return sorted(tuple(map(str, r)) for r in events.select("source_id", "snapshot_name", "row_key", "xml").collect()), bad.count()


def test_first_five_names(landing):
    after = "2015/01/01/000000"
    assert [n for n, _ in snapshots.next_names(str(landing), WEATHER, after, 5)] == FIRST_FIVE
    assert [n for n, _ in snapshots.next_names(str(landing), "GetMeasuredWeatherData", FIRST_FIVE[1], 2)] == FIRST_FIVE[2:4]
    assert [n for n, _ in snapshots.next_names(str(landing), WEATHER, None, 1)] == ["2014/12/31/235501"]
    assert snapshots.next_names(str(landing), WEATHER, "2015/01/02/000002", 5) == [] and snapshots.next_names(str(landing), "getsituation", None, 5) == []


def test_names_of_the_file_layout(spark, tmp_path):
    for name in ("20141130-235959.xml", "20141201-000000.xml", "20150101-000001.xml", "20150101-000001.xml.tmp", "20141231-000000.xml", "LastModified"):
        land(tmp_path, "getsituation", name, "x")
    assert [n for n, _ in snapshots.next_names(str(tmp_path), "getsituation", None, 9, "file")] == ["20141231-000000", "20150101-000001"]
    rows = spark.createDataFrame([("f", n) for n in ("20141130-235959", "20141201-000001", "2014/11/30/235959", "2014/12/01/000001")], "feed string, snapshot_name string")
    none = spark.createDataFrame([], "feed string, last_extracted string")
    assert sorted(r.snapshot_name for r in snapshots.pending_snapshots(rows, none).collect()) == ["2014/12/01/000001", "20141201-000001"]


def test_records_of_the_first_snapshot(spark, landing, tmp_path):
    """From the start name on, the first run gives all records of the first snapshot, at its publication time."""
    shutil.rmtree(landing / WEATHER / "2014")
    done = jobs.extract_feed(spark, str(landing), str(tmp_path / "log"), WEATHER, 1)
    assert (done.snapshots, done.last) == (1, FIRST_FIVE[0])
    events = jobs.read_log(spark, str(tmp_path / "log"), feeds=(WEATHER,))
    assert events.count() == FIRST_RECORDS
    assert {r.t for r in events.select(F.date_format("publication_time", "yyyy-MM-dd HH:mm:ss.SSS").alias("t")).collect()} == {"2014-12-31 23:59:59.897"}


@pytest.mark.parametrize("n", [2, 20])
def test_runs_of_any_length_equal_one(spark, landing, tmp_path, n):
    root = str(tmp_path / "log")
    total = 0
    while (done := jobs.extract_feed(spark, str(landing), root, WEATHER, n, compact_after=3)).snapshots:
        total += done.snapshots
    events, bad = whole(spark, landing)
    assert total == 10 and done.last == "2015/01/02/000002"
    assert log(spark, root) == events and len(log(spark, root, "rejected")) == bad == 1
    assert [i for _, i in log(spark, root, "source_ids")] == sorted({e[0] for e in events})


def test_tasks_of_a_run_follow_its_records(spark, landing, tmp_path):
    """With more partitions set, a run of few records has no more tasks: a shuffle goes by bytes, fetched texts by files."""
    set_ = spark.conf.get("spark.sql.shuffle.partitions")
    tasks, logs = {}, {}
    try:
        for parts in (10, 200):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            spark.sparkContext.setJobGroup(f"tasks{parts}", "")
            root = str(tmp_path / f"log{parts}")
            jobs.extract_feed(spark, str(landing), root, WEATHER, 4)
            jobs.extract_feed(spark, str(landing), root, WEATHER, 6)
            tracker = spark.sparkContext.statusTracker()
            stages = {s for j in tracker.getJobIdsForGroup(f"tasks{parts}") for s in tracker.getJobInfo(j).stageIds}
            tasks[parts] = sum(s.numTasks for s in map(tracker.getStageInfo, stages) if s and s.numCompletedTasks)
            logs[parts] = log(spark, root)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", set_)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert logs[10] == logs[200] and tasks[200] < 2 * tasks[10], tasks


class Killed(Exception):
    pass


def test_a_kill_at_any_point_loses_and_doubles_nothing(spark, landing, tmp_path, monkeypatch):
    """A run is made to stop between any two of its writes, before and after its commit; then the job goes on."""
    expected, _ = whole(spark, landing)
    start = tmp_path / "start"
    jobs.extract_feed(spark, str(landing), str(start), WEATHER, 4)
    steps, stop = [0], [-1]

    def step():
        steps[0] += 1
        if steps[0] == stop[0]:
            raise Killed

    def watched(f):
        def run(*args, **more):
            step()
            out = f(*args, **more)
            if f is create:
                step()
            return out

        return run

    create = stores.files.create
    for owner, name in ((stores.Change, "_written"), (stores.Change, "stored"), (stores.files, "create"), (stores.files, "remove")):
        monkeypatch.setattr(owner, name, watched(getattr(owner, name)))
    at = 0
    while True:
        at += 1
        root = tmp_path / f"log{at}"
        shutil.copytree(start, root)
        before = (root / WEATHER / "_commits").exists() and sorted(p.name for p in (root / WEATHER / "_commits").glob("*.json"))
        steps[0], stop[0] = 0, at
        failed = jobs.extract_next(spark, str(landing), str(root), 9, (WEATHER,), compact_after=2)[0].error
        stop[0] = -1
        assert failed is None or isinstance(failed, Killed)
        if failed and before == sorted(p.name for p in (root / WEATHER / "_commits").glob("*.json")):
            assert jobs.markers(spark, str(root)).first().last_extracted == FIRST_FIVE[2]
        assert jobs.extract_next(spark, str(landing), str(root), 9, (WEATHER,), compact_after=2)[0].error is None
        assert log(spark, root) == expected, at
        if not failed:
            break
    assert at > 8


def test_feeds_fail_alone_and_restart_at_the_floor(spark, landing, tmp_path):
    root = str(tmp_path / "log")
    land(landing, "getsituation", "2015/01/01/000000", snapshot("2015-01-01T00:00:00Z", [("a", 1)], "situation", "situation"))
    assert jobs.extract_next(spark, str(landing), root)[-1].feed == "getsituation"
    (tmp_path / "log" / WEATHER / "_commits" / "000000000001.json").write_text("no json")
    land(landing, "getsituation", "2015/01/01/000001", snapshot("2015-01-01T00:00:01Z", [("a", 2)], "situation", "situation"))
    done = {d.feed: d for d in jobs.extract_next(spark, str(landing), root)}
    assert done[WEATHER].error is not None and done["getsituation"].error is None and done["getsituation"].snapshots == 1
    assert jobs.read_log(spark, root, feeds=("getsituation",)).count() == 2
    jobs.clear_marker(spark, root, "GetSituation")
    assert jobs.markers(spark, root, ("getsituation",)).isEmpty()
    again = jobs.extract_feed(spark, str(landing), root, "getsituation")
    assert again.snapshots == 2 and jobs.read_log(spark, root, feeds=("getsituation",)).count() == 2


@pytest.mark.parametrize("whole_bytes", [1 << 26, 3000])
def test_history_build(spark, landing, tmp_path, whole_bytes):
    """Once with files read whole, and once with most of them cut into ranges."""
    root = tmp_path / "history"
    jobs.build_history(spark, str(landing), str(root), whole=whole_bytes)
    events, bad = whole(spark, landing)
    read = lambda name: spark.read.parquet(f"{root}/{name}")
    assert sorted(tuple(map(str, r)) for r in read("events").select("source_id", "snapshot_name", "row_key", "xml").collect()) == events
    assert read("rejected").count() == bad and read("source_ids").count() == len({e[0] for e in events})
    assert read("documents").count() == len(events) and read("unconverted").isEmpty()
    doc = read("documents").filter("source_id = 's3'").orderBy("doc_id").first()
    assert doc.doc_id == "s3_2014-12-31T23:59:59" and doc.json.startswith('{"id":"s3_2014-12-31T23:59:59","publicationTime":"2014-12-31T23:59:59.897Z"')


# Stores

ROWS = {"t": Keyed("day string, k int, v int, w string", ("day", "k"), ("v desc",), "day")}


def test_store_against_a_dictionary(spark, tmp_path):
    """Appends, replacements and compactions in any order give what a dictionary of the best rows has."""
    store, best = Store(spark, str(tmp_path / "s"), ROWS), {}
    assert store.read("t").isEmpty() and store.days("t") == []
    batches = [[("a", 1, 5, "x"), ("b", 1, 1, "x")], [("a", 1, 4, "late"), ("c", 2, 0, "y")], [("b", 1, 1, "same v, later commit")], [], [("a", 1, 6, "z"), ("a", 2, None, "no v"), (None, 3, 1, "no day")]]
    for number, batch in enumerate(batches):
        change = store.change()
        change.append("t", spark.createDataFrame(batch, ROWS["t"].schema))
        for day, k, v, w in batch:
            old = best.get((day, k))
            if old is None or (v is not None and (old[0] is None or v >= old[0])):
                best[day, k] = (v, w)
        if number in (1, 4):
            change.compact("t")
        change.commit()
        got = {(r.day, r.k): (r.v, r.w) for r in store.read("t").collect()}
        assert got == best, number
    assert store.read("t", "b", "b").count() == 1
    store.clean(1)
    assert {(r.day, r.k): (r.v, r.w) for r in store.read("t").collect()} == best
    change = store.change()
    change.replace("t", spark.createDataFrame([("z", 1, 1, "only")], ROWS["t"].schema))
    assert store.read("t").count() == len(best)
    change.commit()
    assert [r.w for r in store.read("t").collect()] == ["only"]


def test_folders_do_not_grow_with_days(spark, tmp_path):
    """Days of a write of many lie together; replaced and unasked ones among them aren't read, null and empty ones are kept."""
    store, best = Store(spark, str(tmp_path / "s"), ROWS), {}
    days = [f"{d:04d}" for d in range(1000)]
    batches = [[(d, 1, 1, "a") for d in [*days, None, ""]], [(d, 1, 2, "b") for d in days[::3]], [(d, 1, 0, "late") for d in days[5:9]], [("0007", 1, 3, "c"), ("new", 1, 1, "c")], [(d, 2, 1, "d") for d in days[::2]]]
    for number, batch in enumerate(batches):
        change = store.change()
        change.append("t", spark.createDataFrame(batch, ROWS["t"].schema))
        best |= {(d, k): (v, w) for d, k, v, w in batch if v >= best.get((d, k), (0, ""))[0] and v}
        if number in (1, 3):
            change.compact("t")
        change.commit()
        if not number:
            assert len(list((tmp_path / "s" / "t").glob("*/store_*"))) <= 101
        assert {(r.day or None, r.k): (r.v, r.w) for r in store.read("t").filter("day <> '' or day is null").collect()} == {k: v for k, v in best.items() if k[0] != ""}
        assert store.read("t").filter("day = ''").count() == 1
    assert {(r.day, r.k, r.w) for r in store.read("t", "0005", "0008").collect()} == {(d, k, w) for (d, k), (_, w) in best.items() if d and "0005" <= d <= "0008"}
    assert len(store.read("t", "0005", "0008").inputFiles()) == 5  # the four days compacted alone, and what the last delta has of them
    store.compact("t")
    store.clean(1)
    assert store.read("t").count() == len(best)


def test_reads_cost_the_days_asked_for(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), ROWS)
    for number in range(4):
        change = store.change()
        change.append("t", spark.createDataFrame([(f"2024-01-0{d}", number, 1, "x") for d in range(1, 8)], ROWS["t"].schema))
        change.commit()
    one = store.read("t", "2024-01-03", "2024-01-03")
    assert len(one.inputFiles()) == 4 and all("day=2024-01-03" in f for f in one.inputFiles())
    store.compact("t")
    assert len(store.read("t", "2024-01-03", "2024-01-03").inputFiles()) == 1
    plan = store.read("t")._jdf.queryExecution().toString()
    assert "Window" not in plan and store.read("t").count() == 28


def test_second_writer_is_refused(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), ROWS)
    one, two = store.change(), store.change()
    one.append("t", spark.createDataFrame([("a", 1, 1, "one")], ROWS["t"].schema))
    two.append("t", spark.createDataFrame([("a", 2, 2, "two")], ROWS["t"].schema))
    one.commit()
    with pytest.raises(Conflict):
        two.commit()
    assert [r.w for r in store.read("t").collect()] == ["one"]


def test_files(tmp_path):
    files.create(f"{tmp_path}/d/f", b"1")
    with pytest.raises(FileExistsError):
        files.create(f"file://{tmp_path}/d/f", b"2")
    assert files.read(f"file:{tmp_path}/d/f") == b"1" and files.names(f"{tmp_path}/d") == ["f"] and files.names(f"{tmp_path}/none") == []
    files.remove(f"{tmp_path}/d")
    files.remove(f"{tmp_path}/d")
    assert not files.exists(f"{tmp_path}/d")


EVENT = "feed string, source_id string, publication_time timestamp, row_key string, xml string"


def moved(source, micros, body, feed="getpredefinedtraveltimelocations"):
    t = datetime(2015, 1, 1, 12, 0, 0, micros)
    return feed, source, t, f"{10**6 - micros:019}", f"<r>{body}</r>"


def test_documents_over_batches(spark, tmp_path):
    root = str(tmp_path / "docs")
    line = "<linearExtension><coordinates>1 2 3 4</coordinates></linearExtension>"
    batches = [
        [moved("A", 500, f"<v>new</v>{line}"), moved("B", 100, f"<v>first</v>{line}"), moved("X", 1, "<coordinates>1 x</coordinates>")],
        [moved("A", 200, "<v>old, late</v>"), moved("B", 300, "<v>second, without a line</v>")],
        [moved("A", 500, "<v>same key, later batch</v>"), moved("X", 1, "<coordinates>1 x</coordinates>"), moved("A", 400, "<v>old again</v>")],
    ]
    run = feeds.index_batch(root, "s", compact_after=2)
    for number, rows in enumerate(batches):
        for _ in range(2):  # each batch is replayed at once
            run(spark.createDataFrame(rows, EVENT), number)
        run(spark.createDataFrame(batches[0], EVENT), 0)  # and the first one much later
    texts = {r.source_id: r.json for r in feeds.read_documents(spark, root).collect()}
    assert set(texts) == {"A", "B"} and '"same key, later batch"' in texts["A"] and "second" in texts["B"]
    assert feeds.read_geometries(spark, root).isEmpty()
    assert [r.source_id for r in feeds.read_rejects(spark, root).collect()] == ["X"]
    assert feeds.read_documents(spark, root, "2015-01-02").isEmpty() and feeds.read_documents(spark, root, "2015-01-01", "2015-01-01").count() == 2


def test_geometries_follow_their_documents(spark, tmp_path):
    root, line = str(tmp_path / "docs"), "<linearExtension><coordinates>1 2 3 4</coordinates></linearExtension>"
    run = feeds.index_batch(root, "s")
    run(spark.createDataFrame([moved("A", 500, line), moved("W", 5, line, WEATHER)], EVENT), 0)
    run(spark.createDataFrame([moved("A", 100, "<v>older</v>")], EVENT), 1)
    assert [(r.source_id, r.geometry) for r in feeds.read_geometries(spark, root).collect()] == [("A", '{"coordinates":[[1.0,2.0],[3.0,4.0]]}')]


def test_document_stream_restarts(spark, tmp_path):
    source, root = str(tmp_path / "events"), str(tmp_path / "docs")
    for part in range(3):
        spark.createDataFrame([moved(f"D{k}", part + 1, f"<v>{part}</v>") for k in range(part, 5)], EVENT).write.mode("append").parquet(source)
        stream = spark.readStream.schema(EVENT).parquet(source)
        feeds.stream_documents(stream, root, str(tmp_path / "cp"), compact_after=2).awaitTermination()
    assert sorted((r.source_id, r.json[-3:-1]) for r in feeds.read_documents(spark, root).collect()) == [("D0", ":0"), ("D1", ":1"), ("D2", ":2"), ("D3", ":2"), ("D4", ":2")]


def test_upsert_creates_its_store(spark, tmp_path):
    from waymark.operators import sinks

    schema = "feed string, doc_id string, source_id string, event_time timestamp, row_key string, json string"
    root, day = str(tmp_path / "docs"), datetime(2024, 1, 1)
    for rows, expect in (([("f", "a", "s", day, "2", "old"), ("f", "a", "s", day, "1", "new")], [("a", "new")]), ([("f", "b", "s", day, "1", "b")], [("a", "new"), ("b", "b")])):
        sinks.upsert_into(spark, root, str(tmp_path / "stage"), spark.createDataFrame(rows, schema))
        assert sorted((r.doc_id, r.json) for r in sinks.get_documents(spark, root, "F").collect()) == expect


# Repair

HISTORY = {
    "2015/02/01/000000": snapshot("2015-02-01T00:00:00Z", [("a", 1), ("b", 1), ("c", 1)]),
    "2015/02/01/000500": snapshot("2015-02-01T00:05:00Z", [("a", 2), ("b", 1)]),
    "2015/02/01/001000": "<m><broken",
    "2015/02/01/001500": snapshot("2015-02-01T00:15:00Z", [("a", 2), ("b", 2), ("c", 1)]),
    "2015/02/01/002000": snapshot("2015-02-01T00:15:00Z", [("a", 3), ("b", 2), ("d", 1)]),
    "2015/02/02/000000": snapshot("2015-02-02T00:00:00Z", [("a", 3), ("b", 3)]),
    "2015/02/02/000500": snapshot("2015-02-02T00:05:00Z", [("a", 3), ("b", 2), ("c", 1)]),
}


def repaired(spark, tmp_path, first, mended=()):
    """A log of some snapshots, after the others landed and it was repaired; and what one run over all of them gives."""
    from waymark.plans import repair

    landing, root = tmp_path / "in", str(tmp_path / "log")
    for name, text in first.items():
        land(landing, WEATHER, name, text)
    while jobs.extract_feed(spark, str(landing), root, WEATHER, 20).snapshots:
        pass
    for name, text in HISTORY.items():
        land(landing, WEATHER, name, text)
    done = repair.repair_feed(spark, str(landing), root, WEATHER, mended=mended)
    expected, bad = whole(spark, landing)
    assert log(spark, root) == expected
    assert len(log(spark, root, "rejected")) == bad
    assert {i for _, i in log(spark, root, "source_ids")} >= {e[0] for e in expected}
    assert repair.repair_feed(spark, str(landing), root, WEATHER) == repair.Repaired(0, 0, 0)
    # The next snapshot is held against what the repair carried over.
    land(landing, WEATHER, "2015/02/03/000000", snapshot("2015-02-03T00:00:00Z", [("a", 3), ("b", 9), ("c", 1)]))
    jobs.extract_feed(spark, str(landing), root, WEATHER)
    assert log(spark, root) == whole(spark, landing)[0]
    return done


@pytest.mark.parametrize("late", [0, 3, 5])
def test_a_late_snapshot_is_worked_in(spark, tmp_path, late):
    name = list(HISTORY)[late]
    done = repaired(spark, tmp_path, {n: t for n, t in HISTORY.items() if n != name})
    assert done.snapshots == 1


def test_several_late_and_mended_snapshots(spark, tmp_path):
    names = list(HISTORY)
    first = {n: t for n, t in HISTORY.items() if n not in (names[1], names[2], names[4])}
    first[names[3]], first[names[6]] = "<m><was broken", snapshot("2015-02-02T00:05:00Z", [("a", 0)])
    done = repaired(spark, tmp_path, first, (names[3], names[6]))
    assert done.snapshots == 5 and done.added and done.withdrawn
