"""Edge cases on small tables made by hand."""

import os
import tracemalloc
import uuid
from datetime import datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from waymark.functions import keys, values
from waymark.operators import changes, convert, profile, select, sinks
from waymark.plans import fixtures as fx
from waymark.sources import records, registry, snapshots

HEAD = "<p:m xmlns:p='urn:x'><publicationTime>2015-01-01T00:59:59.897+01:00</publicationTime>"


def one(spark, column):
    return spark.range(1).select(column.alias("c")).first().c


def test_golden_keys(spark):
    for text, key in (("2015-01-01 00:00:00", "2519822304000000000"), ("2015-01-01 00:59:59.897", "2519822268001030000"), ("2015-04-02 00:00:00", "2519743680000000000")):
        ts = F.lit(text).cast("timestamp")
        assert one(spark, keys.row_key(ts)) == key
        assert one(spark, keys.row_key_to_time(F.lit(key)) == ts)
    assert one(spark, keys.time_id(F.lit("2014-12-31 23:59:59.897").cast("timestamp"), "Europe/Oslo")) == "2015-01-01T00:59:59"
    doc = keys.document_id(F.lit("getsituation"), F.lit("S_1"), F.lit(1), F.lit("2015-01-01 00:59:59.897").cast("timestamp"))
    assert one(spark, doc) == "S_1_2_2015-01-01T00:59:59"
    assert tuple(one(spark, keys.parse_document_id(doc))) == ("S_1_2", "2015-01-01T00:59:59")


def test_geohash_and_coordinates(spark):
    assert one(spark, values.geohash(F.lit(57.64911), F.lit(10.40744))) == "u4pruydqqvj"
    assert one(spark, values.geohash(F.lit(91.0), F.lit(0.0))) is None
    assert one(spark, values.parse_coordinates(F.lit("10.75 59.91,10.80;59.95 7"))) == [[10.75, 59.91], [10.8, 59.95]]
    assert one(spark, values.parse_coordinates(F.lit(""))) == []
    assert one(spark, values.parse_coordinates(F.lit("1\t2"))) is None


@pytest.mark.parametrize("text,kind", [(" TRUE ", "bool"), ("007", "int"), ("1e3", "double"), ("1,234", "double"), ("9223372036854775808", "double"), ("NaN", "string"), ("1d", "string"), ("", "string"), (None, "null"), ("1e999", "string")])
def test_infer_scalar(spark, text, kind):
    assert one(spark, values.infer_scalar(F.lit(text).cast("string")))["kind"] == kind


def test_extraction_edges():
    def run(body, record="situation", ident="situation", **more):
        return records.extract((HEAD + body + "</p:m>").encode(), record, ident, **more)

    assert [i for i, _ in run('<situation id="a"/><situation id="b"><situationRecord id="x"/></situation>')[1]] == ["a", "b"]
    assert run('<situation id="a"><![CDATA[</situation>]]></situation>')[1] == [("a", '<situation id="a"><![CDATA[</situation>]]></situation>')]
    assert run('<!-- <situation id="z"> --><situation id="a"></situation >')[1] == [("a", '<situation id="a"></situation >')]
    assert run('<p:situation id="a"/>')[1] == []
    assert run('<p:situation id="a"/>', match_local=True)[1] == [("a", '<p:situation id="a"/>')]
    assert run("<situation/>")[2] == "a record has no id"
    assert run('<siteMeasurements><x/><ref id="7"/><ref id="8"/></siteMeasurements>', "siteMeasurements", "ref")[1][0][0] == "7"
    assert records.extract("<m><situation id='a'><publicationTime>x</publicationTime></situation></m>", "situation", "situation")[2] == "no publication time"
    assert records.extract(b"", "situation", "situation")[2].startswith("malformed")
    assert records.extract("<!DOCTYPE m><m><publicationTime>x</publicationTime></m>", "a", "a")[2].startswith("malformed")
    latin = "<?xml version='1.0' encoding='iso-8859-1'?><m><publicationTime>2015-01-01</publicationTime><s id='ø'/></m>".encode("latin-1")
    assert records.extract(latin, "s", "s")[1] == [("ø", "<s id='ø'/>")]


def rows(spark, data):
    return spark.createDataFrame(data, "feed string, snapshot_name string, source_id string, xml string")


HISTORY = [("f", "1", "a", "x"), ("f", "2", "a", "x"), ("f", "2", "b", "y"), ("f", "4", "a", "x"), ("f", "5", "a", "z"), ("f", "6", "a", "x"), ("f", "6", "c", None)]
NAMES = [("f", str(k)) for k in range(1, 7)]


def test_change_events_cases(spark):
    names = spark.createDataFrame(NAMES, "feed string, snapshot_name string")
    expected = [("1", "a"), ("2", "b"), ("4", "a"), ("5", "a"), ("6", "a"), ("6", "c")]
    for method in ("window", "join"):
        got = changes.change_events(rows(spark, HISTORY), names, method=method).select("snapshot_name", "source_id").collect()
        assert sorted(map(tuple, got)) == expected
    bad = spark.createDataFrame([("f", "3")], "feed string, snapshot_name string")
    skip = changes.change_events(rows(spark, HISTORY), names, bad).select("snapshot_name", "source_id").collect()
    assert sorted(map(tuple, skip)) == [x for x in expected if x[0] != "4"]
    last = changes.change_events(rows(spark, HISTORY), names, bad, "last_good").select("snapshot_name", "source_id").collect()
    assert sorted(map(tuple, last)) == [x for x in expected if x != ("4", "a")]


@pytest.mark.parametrize("step", [1, 2, 4])
def test_increments_equal_one_run(spark, step):
    bad = [("f", "3")]
    carry = spark.createDataFrame([], "feed string, snapshot_name string, source_id string, xml string, broken boolean")
    found = []
    for at in range(0, 6, step):
        part = NAMES[at : at + step]
        r = rows(spark, [h for h in HISTORY if h[:2] in part and h[:2] not in bad])
        names = spark.createDataFrame(part, "feed string, snapshot_name string")
        events, carry, markers = changes.extract_increment(r, carry, names, spark.createDataFrame([b for b in bad if b in part], names.schema))
        found += [tuple(x) for x in events.select("snapshot_name", "source_id").collect()]
        carry = spark.createDataFrame(carry.collect(), carry.schema)
        assert markers.first().last_extracted == part[-1][1]
    assert sorted(found) == [("1", "a"), ("2", "b"), ("5", "a"), ("6", "a"), ("6", "c")]


def test_landing(spark):
    t = lambda s: datetime(2024, 1, 1, 0, 0, s)
    incoming = spark.createDataFrame([("f", t(1), b"a", 1), ("f", t(1), b"b", 2), ("f", t(0), b"old", 3), ("g", t(0), b"c", 4)], "feed string, last_modified timestamp, content binary, arrival int")
    existing = spark.createDataFrame([], "feed string, snapshot_name string")
    landed, markers = snapshots.land_snapshots(existing, incoming, spark.createDataFrame([("f", t(0))], "feed string, last_modified timestamp"))
    assert sorted((r.feed, bytes(r.content)) for r in landed.collect()) == [("f", b"a"), ("g", b"c")]
    assert {r.feed: r.last_modified for r in markers.collect()} == {"f": t(1), "g": t(0)}
    again, _ = snapshots.land_snapshots(landed, incoming, spark.createDataFrame([], "feed string, last_modified timestamp"))
    assert [bytes(r.content) for r in again.filter("feed = 'f'").collect()] == [b"old"]


def test_conversion_rules():
    f = lambda x: convert.to_value(convert.parse(x))
    assert f("<a/>") is None and f("<a>x</a>") == "x" and f('<a b="1">x</a>') == {"@b": "1", "#text": "x"}
    assert f("<a><b>1</b><c/><b>2</b></a>") == {"b": ["1", "2"], "c": None}
    assert f('<n:a xmlns:n="u" n:t="v"><n:b>1</n:b></n:a>') == {"@t": "v", "b": "1"}
    doc = {"linearExtension": {"coordinates": "1 2 3"}, "b": [{"linearExtension": 1}], "v": ["7"], "w": "7", "@xmlns": "u"}
    out = convert.normalized(doc, "i", "p")
    assert list(out)[:2] == ["id", "publicationTime"] and out["v"] == ["7"] and out["w"] == 7 and "@xmlns" not in out
    assert convert.cut_geometry(out) == {"coordinates": [[1.0, 2.0]]} and out["linearExtension"] is None and convert.cut_geometry({"b": out["b"]}) is None
    with pytest.raises(convert.ConversionError):
        convert.normalized({"coordinates": "1 x"}, "i", "p")
    with pytest.raises(convert.ConversionError):
        convert.split_situation(convert.parse('<situation id="1"/>'))
    assert convert.split_situation(convert.parse('<situation id="1" version="2"/>')) == []


def test_documents_of_a_situation(spark):
    xml = '<situation id="S_1" version="3"><overallSeverity>low</overallSeverity><situationRecord id="r1"/><situationRecord id="r2"/></situation>'
    events = spark.createDataFrame([("getsituation", "S_1", datetime(2015, 1, 1, 0, 59, 59, 897000), xml), ("getsituation", "S_2", datetime(2015, 1, 1), "<situation"), ("getsituation", "S_3", datetime(2015, 1, 1), None)], "feed string, source_id string, publication_time timestamp, xml string")
    docs, shapes, rejects = convert.convert_events(events)
    assert sorted(r.doc_id for r in docs.collect()) == ["S_1_1_2015-01-01T00:59:59", "S_1_2_2015-01-01T00:59:59"]
    assert shapes.isEmpty() and sorted(r.source_id for r in rejects.collect()) == ["S_2", "S_3"]


def test_registry(spark):
    assert registry.feed_registry(spark).count() == 5
    with pytest.raises(ValueError):
        registry.known_feed("none")
    assert registry.with_elements(spark.createDataFrame([("GetSituation",), ("x",)], "feed string")).orderBy("feed").collect()[0].record_element == "situation"


def test_empty_tables(spark):
    empty = rows(spark, []).withColumn("publication_time", F.lit(None).cast("timestamp"))
    events = changes.upsert_events(changes.as_events(changes.change_events(empty)))
    assert events.isEmpty() and profile.estimate_volume(events).isEmpty() and profile.day_volume(events, "2024-01-01").isEmpty()
    assert convert.converted(events).isEmpty()


def test_upsert_into_store(spark, tmp_path):
    schema = "feed string, doc_id string, source_id string, event_time timestamp, row_key string, json string"
    make = lambda *r: spark.createDataFrame(list(r), schema)
    root = str(tmp_path / "docs")
    sinks.write_documents(make(("f", "a", "s", datetime(2024, 1, 1), "2", "old"), ("f", "b", "s", datetime(2024, 1, 2), "2", "keep")), root)
    sinks.upsert_into(spark, root, str(tmp_path / "stage"), make(("f", "a", "s", datetime(2024, 1, 1), "1", "new"), ("f", "a", "s", datetime(2024, 1, 1), "3", "older")))
    assert sorted((r.doc_id, r.json) for r in sinks.get_documents(spark, root, "F").collect()) == [("a", "new"), ("b", "keep")]


def test_scalars_read_alike_as_columns_and_in_documents(spark):
    texts = ["\ttrue", " TRUE\n", "7", "+07", "7 ", " 7", "٧", "1" * 19, "-9223372036854775808", "9223372036854775808", "0" * 5000 + "7", "1" * 5000, "1e999", "1,2.5", ".5e1", "", " ", "truK", "5\x1c"]
    kinds = {bool: "bool", int: "int", float: "double", str: "string"}
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    for r in df.select("t", values.infer_scalar(F.col("t")).alias("v")).collect():
        x = convert.typed(r.t)
        assert r.v.kind == kinds[type(x)], r.t
        assert {"bool": r.v.b, "int": r.v.l, "double": r.v.d, "string": r.v.s}[r.v.kind] == x


def test_records_that_cannot_be_converted_are_rejected_alone(spark):
    deep = "<r>" * 3000 + "</r>" * 3000
    rows = [("f", "deep", deep), ("f", "good", "<r><v>1</v></r>"), ("f", "bad", "<r>"), ("f", "far", "<r><coordinates>1e999 2</coordinates></r>"), ("f", "long", f"<r><v>{'1' * 5000}</v></r>")]
    events = spark.createDataFrame(rows, "feed string, source_id string, xml string").withColumn("publication_time", F.lit("2015-01-01").cast("timestamp"))
    docs, _, rejects = convert.convert_events(events)
    assert {r.source_id for r in docs.collect()} == {"good", "long"} and {r.source_id for r in rejects.collect()} == {"deep", "bad", "far"}
    got = {r.source_id: r.j for r in events.select("source_id", convert.xml_to_json(F.col("xml")).alias("j")).collect()}
    assert got["deep"] is None and got["bad"] is None and got["good"] == '{"v":"1"}'
    far = spark.createDataFrame([('{"coordinates":"1e999 2"}',), ('{"coordinates":"1 2"}',)], "t string")
    assert [r[0] for r in far.select(convert.convert_coordinates_json(F.col("t"))).collect()] == [None, '{"coordinates":[[1.0,2.0]]}']


def test_volume_estimate_divides_scaled_figures(spark):
    events = spark.createDataFrame([("f", f"{s:02}", f"{k}", 10) for s in range(7) for k in range(s + 1)], "feed string, source_id string, row_key string, length long")
    # sources 3 and 4 (0-based 2, 3) are sampled: 3 + 4 events, 70 bytes
    r = profile.estimate_volume(events, 2, 2).first()
    assert (r.sources, r.est_events, r.est_bytes, r.mean_bytes) == (7, 21, 210, 10)
    assert profile.estimate_volume(events, 50, 50).first().mean_bytes is None


def test_each_snapshot_is_parsed_once(spark, tmp_path, monkeypatch):
    from waymark.plans.jobs import snapshots_to_events

    snaps = fx.snapshots(spark, "/root/testdata/sf0.001", broken=True)
    n, log, real = snaps.count(), str(tmp_path), records.extract

    def counted(*args):
        open(f"{log}/{uuid.uuid4().hex}", "w").close()
        return real(*args)

    monkeypatch.setattr(records, "extract", counted)
    events, bad = snapshots_to_events(snaps)
    assert events.count() and bad.count()
    assert len(os.listdir(log)) == n


def test_positions_are_those_of_a_sort(spark):
    df = spark.range(0, 5000, 1, 7).selectExpr("(id * 7919) % 5003 as k", "id as position")
    got = select.with_position(df, ["k"]).orderBy("position").collect()
    assert [r.position for r in got] == list(range(5000)) and [r.k for r in got] == sorted(r.k for r in got)


def test_stream_batches_can_be_replayed(spark, tmp_path):
    from waymark.streaming import feeds

    snaps = fx.snapshots(spark, "/root/testdata/sf0.001")
    run = feeds.change_batch(str(tmp_path))
    run(snaps.filter("day(snapshot_ts) <= 9"), 0)
    later = snaps.filter("day(snapshot_ts) > 9")
    run(later, 1)
    key = lambda: sorted((r.feed, r.source_id, r.row_key, r.snapshot_name) for r in spark.read.parquet(f"{tmp_path}/events").collect())
    first = key()
    run(later.repartition(5), 1)
    assert key() == first and len(first) == len(set(first))


def test_volume_by_periods(spark):
    times = [datetime(2024, 1, 1, 5, 0, 1), datetime(2024, 1, 1, 5, 0, 2), datetime(2024, 1, 1, 7), datetime(2024, 2, 3)]
    snaps = spark.createDataFrame([("f", t, 1000 * k) for k, t in enumerate(times, 1)], "feed string, snapshot_ts timestamp, length long")
    sizes = lambda by: sorted((r.snapshots, r.bytes, r.kb) for r in profile.snapshot_volume(snaps, by).collect())
    assert sizes("second") == [(1, 1000, 0), (1, 2000, 1), (1, 3000, 2), (1, 4000, 3)]
    assert sizes("hour") == [(1, 3000, 2), (1, 4000, 3), (2, 3000, 2)]
    assert sizes("month") == [(1, 4000, 3), (3, 6000, 5)]
    assert profile.snapshot_volume(snaps).columns[:2] == ["feed", "day"]
    with pytest.raises(ValueError):
        profile.snapshot_volume(snaps, "fortnight")


def test_large_snapshots_are_held_once(spark):
    """A snapshot's records are held as places in its text, and large snapshots reach the parser one by one."""
    body = "<m><publicationTime>2015-01-01T00:00:00Z</publicationTime>" + "".join(f'<s id="{k}"><v>{"y" * 200}</v></s>' for k in range(20_000)) + "</m>"
    content = body.encode()
    tracemalloc.start()
    published, found, error = records.extract(content, "s", "s")
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert error is None and len(found) == 20_000 and found[7] == ("7", f'<s id="7"><v>{"y" * 200}</v></s>')
    assert peak < 2.3 * len(content)
    text = F.array_join(F.collect_list("x"), "")
    rows = spark.range(90_000).selectExpr("id % 3 as s", "concat('<s id=\"', id, '\">', repeat('y', 300), '</s>') as x").groupBy("s").agg(text.alias("t")).coalesce(1)
    snaps = rows.selectExpr("'f' as feed", "cast(s as string) as snapshot_name", "cast(concat('<m><publicationTime>2015-01-01T00:00:00Z</publicationTime>', t, '</m>') as binary) as content", "'s' as record_element", "'s' as id_element")
    assert records.explode_records(snaps).filter("error is null").count() == 90_000
    sizes = snaps.select("content").mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n long").collect()
    assert sorted(r.n for r in sizes) == [1, 1, 1]
