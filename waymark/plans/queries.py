"""Queries over the given tables, one or more for each operator, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark.functions import keys, values
from waymark.operators import changes, convert, geo, layout, profile, select, sinks, typed
from waymark.plans import fixtures as fx
from waymark.plans import jobs, repair
from waymark.plans.jobs import snapshots_to_events
from waymark.sources import ranges, registry
from waymark.sources import records as rec
from waymark.sources import snapshots as snap
from waymark.streaming import feeds

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_FEEDS = ", ".join(f"('{f}', '{r}', '{i}')" for f, (r, i) in registry.FEEDS.items() if f in registry.DEFAULT_FEEDS)
_BASE = """
 rec AS (SELECT event_type AS feed, strftime(ts, '%Y/%m/%d/000000') AS snapshot_name, date_trunc('day', ts) AS t, event_id AS ordinal,
   CAST(user_id AS VARCHAR) AS source_id, CAST(CAST(floor(value / 20) AS BIGINT) AS VARCHAR) AS xml FROM events),
 one AS (SELECT * FROM rec QUALIFY row_number() OVER (PARTITION BY feed, snapshot_name, source_id ORDER BY ordinal) = 1),
 names AS (SELECT *, row_number() OVER (PARTITION BY feed ORDER BY snapshot_name) AS seq FROM (SELECT DISTINCT feed, snapshot_name, t FROM rec)),
 lagged AS (SELECT o.*, seq, lag(seq) OVER w AS ps, lag(xml) OVER w AS px FROM one o JOIN (SELECT feed, snapshot_name, seq FROM names) USING (feed, snapshot_name) WINDOW w AS (PARTITION BY feed, source_id ORDER BY seq)),
 ev AS (SELECT feed, source_id, snapshot_name, t, xml, seq, lpad(CAST(2534023008000000000 - epoch_us(t) * 10 AS VARCHAR), 19, '0') AS row_key, CAST(strlen(xml) AS BIGINT) AS length FROM lagged WHERE ps IS NULL OR ps <> seq - 1 OR px <> xml),
 snaps AS (SELECT n.feed, n.snapshot_name, n.t, '<d2LogicalModel><payloadPublication><publicationTime>' || strftime(n.t, '%Y-%m-%dT%H:%M:%SZ') || '</publicationTime>' || b.body || '</payloadPublication></d2LogicalModel>' AS content
   FROM names n JOIN (SELECT feed, snapshot_name, string_agg('<siteMeasurements><measurementSiteReference id="' || source_id || '" version="1"/><v>' || xml || '</v></siteMeasurements>', '' ORDER BY ordinal) AS body FROM rec GROUP BY ALL) b USING (feed, snapshot_name))
"""
_XML = "'<siteMeasurements><measurementSiteReference id=\"' || source_id || '\" version=\"1\"/><v>' || xml || '</v></siteMeasurements>'"
_EV = ["feed", "source_id", "snapshot_name", "xml"]


def query(oracle: str | None = None, base: bool = True):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = f"WITH {_BASE} {oracle}" if base else oracle
        return f

    return add


def _stamp(c: str = "publication_time"):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


# Sources


_MAPPED = "CASE event_type " + " ".join(f"WHEN '{t}' THEN '{f}'" for t, f in fx.TYPES.items()) + " END"


@query(f"SELECT v.feed, record_element, id_element, count(*) AS events, count(DISTINCT user_id) AS sources FROM (VALUES {_FEEDS}) v(feed, record_element, id_element) JOIN events e ON {_MAPPED} = v.feed GROUP BY ALL", base=False)
def s1_feed_registry(spark, sf):
    """The elements of each registered feed that the table has events of, with what it has."""
    rows = fx.raw_records(spark, sf).withColumn("feed", fx.feed_of(F.col("feed")))
    found = rows.groupBy("feed").agg(F.count("*").alias("events"), F.countDistinct("source_id").alias("sources"))
    return registry.feed_registry(spark).join(found, "feed").select("feed", "record_element", "id_element", "events", "sources")


def _read(spark, sf, layout):
    return snap.read_snapshots(spark, fx.landed(spark, sf, layout), layout).select("feed", F.date_format("snapshot_ts", "yyyy/MM/dd/HHmmss").alias("name"), F.col("content").cast("string").alias("content"), "length")


@query("SELECT feed, snapshot_name AS name, content, CAST(strlen(content) AS BIGINT) AS length FROM snaps")
def s2_read_blob_layout(spark, sf):
    return _read(spark, sf, "blob")


@query("SELECT feed, snapshot_name AS name, content, CAST(strlen(content) AS BIGINT) AS length FROM snaps")
def s3_read_file_layout(spark, sf):
    return _read(spark, sf, "file")


@query("SELECT feed, snapshot_name FROM names WHERE CASE WHEN feed = 'click' THEN snapshot_name > '2024/01/10/000000' ELSE true END QUALIFY row_number() OVER (PARTITION BY feed ORDER BY snapshot_name) <= 10")
def s4_pending_snapshots(spark, sf):
    markers = spark.createDataFrame([("click", "2024/01/10/000000")], "feed string, last_extracted string")
    return snap.pending_snapshots(fx.raw_records(spark, sf).select("feed", "snapshot_name").distinct(), markers)


@query("""SELECT feed, strftime(s, '%Y/%m/%d/%H%M%S') AS snapshot_name, content FROM (
  SELECT event_type AS feed, date_trunc('hour', ts) AS s, CAST(event_id AS VARCHAR) AS content FROM events
  WHERE event_type <> 'view' OR date_trunc('hour', ts) > TIMESTAMP '2024-01-15 00:00:00'
  QUALIFY row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY event_id) = 1)
  WHERE NOT (feed = 'click' AND s = TIMESTAMP '2024-01-02 00:00:00')""", base=False)
def s5_land_snapshots(spark, sf):
    e = fx.table(spark, sf, "events")
    incoming = e.select(F.col("event_type").alias("feed"), F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("last_modified"), F.col("event_id").cast("string").cast("binary").alias("content"), F.col("event_id").alias("arrival"))
    markers = spark.createDataFrame([("view",)], "feed string").select("feed", F.lit("2024-01-15").cast("timestamp").alias("last_modified"))
    existing = spark.createDataFrame([("click", "2024/01/02/000000")], "feed string, snapshot_name string")
    return snap.land_snapshots(existing, incoming, markers)[0].select("feed", "snapshot_name", F.col("content").cast("string").alias("content"))


@query(f"SELECT feed, snapshot_name, strftime(t, '%Y-%m-%d %H:%M:%S') AS published, CAST(row_number() OVER (PARTITION BY feed, snapshot_name ORDER BY ordinal) - 1 AS INTEGER) AS ordinal, source_id, {_XML} AS xml FROM rec")
def s6_explode_records(spark, sf):
    return rec.explode_records(fx.snapshots(spark, sf)).select("feed", "snapshot_name", _stamp().alias("published"), "ordinal", "source_id", "xml")


@query(f"SELECT feed, snapshot_name, strftime(t, '%Y-%m-%d %H:%M:%S') AS published, CAST(row_number() OVER (PARTITION BY feed, snapshot_name ORDER BY ordinal) - 1 AS INTEGER) AS ordinal, source_id, {_XML} AS xml FROM rec")
def s6_explode_ranges(spark, sf):
    """Records of files that are read in ranges."""
    listed = snap.list_snapshots(spark, fx.landed(spark, sf, "blob")).withColumns({"record_element": F.lit(fx.WEATHER[0]), "id_element": F.lit(fx.WEATHER[1])})
    return ranges.explode_ranges(listed, range_bytes=1 << 14).select("feed", "snapshot_name", _stamp().alias("published"), "ordinal", "source_id", "xml")


@query("SELECT feed, snapshot_name, source_id FROM rec")
def s7_record_ids(spark, sf):
    got = rec.explode_records(fx.snapshots(spark, sf))
    return got.select("feed", "snapshot_name", F.expr("xpath_string(xml, '//measurementSiteReference/@id')").alias("source_id"))


@query("SELECT feed, snapshot_name, strftime(t, '%Y-%m-%d %H:%M:%S') AS published FROM names")
def s8_publication_time(spark, sf):
    return rec.explode_records(fx.snapshots(spark, sf)).select("feed", "snapshot_name", _stamp().alias("published")).distinct()


@query(f"SELECT feed, snapshot_name, source_id, {_XML} AS xml FROM one")
def s9_dedupe_records(spark, sf):
    return rec.dedupe_records(rec.explode_records(fx.snapshots(spark, sf))).select("feed", "snapshot_name", "source_id", "xml")


@query("SELECT feed, snapshot_name, day(t) % 7 <> 0 AS good, CASE WHEN day(t) % 7 <> 0 THEN count(*) ELSE 1 END AS n FROM rec GROUP BY feed, snapshot_name, t")
def s10_split_valid(spark, sf):
    good, bad = rec.split_valid(rec.explode_records(fx.snapshots(spark, sf, broken=True)))
    g = good.groupBy("feed", "snapshot_name").agg(F.count("*").alias("n")).withColumn("good", F.lit(True))
    return g.unionByName(bad.select("feed", "snapshot_name", F.lit(1).cast("bigint").alias("n"), F.lit(False).alias("good")))


@query("SELECT 'getsituation' AS feed, snapshot_name, content FROM snaps WHERE feed = 'click' AND snapshot_name = '2024/01/05/000000'")
def s11_lookup_snapshot(spark, sf):
    snaps = fx.snapshots(spark, sf).filter("feed = 'click'").withColumn("feed", F.lit("getsituation"))
    return snap.lookup_snapshot(snaps, "GetSituation", "2024/01/05/000000").select("feed", "snapshot_name", F.col("content").cast("string").alias("content"))


@query("""SELECT f.feed, strftime(max(n.t), '%Y-%m-%d %H:%M:%S') AS last_modified, coalesce(string_agg(n.snapshot_name, ',' ORDER BY n.snapshot_name), '') AS entries
  FROM (SELECT DISTINCT feed FROM rec UNION ALL SELECT 'none') f LEFT JOIN names n USING (feed) GROUP BY f.feed""")
def s12_feed_catalog(spark, sf):
    rows = fx.raw_records(spark, sf).select("feed", "snapshot_name", F.col("publication_time").alias("snapshot_ts")).distinct()
    reg = rows.select("feed").distinct().unionByName(spark.createDataFrame([("none",)], "feed string"))
    return snap.feed_catalog(rows, reg).select("feed", _stamp("last_modified").alias("last_modified"), F.array_join("entries", ",").alias("entries"))


# Change detection


@query("SELECT feed, snapshot_name, CAST(seq AS INTEGER) AS seq, coalesce(lag(snapshot_name) OVER (PARTITION BY feed ORDER BY snapshot_name), CASE WHEN feed = 'click' THEN 'm' ELSE '' END) AS previous FROM names")
def d1_pair_snapshots(spark, sf):
    return changes.pair_snapshots(fx.raw_records(spark, sf), spark.createDataFrame([("click", "m")], "feed string, last_extracted string"))


@query("SELECT feed, source_id, xml FROM one n WHERE day(t) = 12 AND NOT EXISTS (SELECT 1 FROM one o WHERE day(o.t) = 11 AND o.feed = n.feed AND o.source_id = n.source_id AND o.xml = n.xml)")
def d2_diff_pair(spark, sf):
    r = fx.records(spark, sf)
    return changes.diff_pair(r.filter("snapshot_name = '2024/01/11/000000'"), r.filter("snapshot_name = '2024/01/12/000000'")).select("feed", "source_id", "xml")


@query("SELECT feed, source_id, snapshot_name, xml FROM ev")
def d3_change_events_window(spark, sf):
    return changes.change_events(fx.records(spark, sf)).select(*_EV)


@query("SELECT feed, source_id, snapshot_name, xml FROM ev")
def d3_change_events_join(spark, sf):
    return changes.change_events(fx.records(spark, sf), method="join").select(*_EV)


@query("SELECT feed, source_id, snapshot_name, xml FROM ev WHERE seq = 1")
def d4_first_snapshot(spark, sf):
    return changes.change_events(fx.records(spark, sf)).filter("seq = 1").select(*_EV)


@query("""SELECT feed, source_id, snapshot_name, xml FROM (
  SELECT o.*, n.seq, lag(n.seq) OVER w AS ps, lag(xml) OVER w AS px FROM one o JOIN names n USING (feed, snapshot_name) WHERE day(o.t) % 7 <> 0 WINDOW w AS (PARTITION BY o.feed, source_id ORDER BY n.seq)) x
  WHERE (ps IS NULL OR ps <> seq - 1 OR px <> xml) AND NOT EXISTS (SELECT 1 FROM names b WHERE b.feed = x.feed AND b.seq = x.seq - 1 AND day(b.t) % 7 = 0)""")
def d5_bad_predecessor(spark, sf):
    r = fx.records(spark, sf)
    return changes.change_events(r, r, fx.bad_snapshots(spark, sf)).select(*_EV)


@query("""SELECT feed, source_id, snapshot_name, xml FROM (
  SELECT o.*, n.q, lag(n.q) OVER w AS ps, lag(xml) OVER w AS px FROM one o JOIN (SELECT *, row_number() OVER (PARTITION BY feed ORDER BY snapshot_name) AS q FROM names WHERE day(t) % 7 <> 0) n USING (feed, snapshot_name) WINDOW w AS (PARTITION BY o.feed, source_id ORDER BY n.q))
  WHERE ps IS NULL OR ps <> q - 1 OR px <> xml""")
def d5_last_good(spark, sf):
    r = fx.records(spark, sf)
    return changes.change_events(r, r, fx.bad_snapshots(spark, sf), on_bad_predecessor="last_good").select(*_EV)


@query("SELECT feed, source_id, snapshot_name, xml FROM ev")
def d6_extract_increment(spark, sf):
    """Two increments: days up to the tenth, then the rest against what the first carried over."""
    r = fx.records(spark, sf)
    names = r.select("feed", "snapshot_name").distinct()
    empty = spark.createDataFrame([], "feed string, snapshot_name string, source_id string, xml string, broken boolean")
    early = F.col("snapshot_name") <= "2024/01/10/000000"
    first, carry, _ = changes.extract_increment(r.filter(early), empty, names.filter(early))
    second, _, _ = changes.extract_increment(r.filter(~early), carry, names.filter(~early))
    return first.select(*_EV).unionByName(second.select(*_EV))


_TYPE = "CASE feed " + " ".join(f"WHEN '{t}' THEN '{f}'" for t, f in fx.TYPES.items()) + " END"
_RECORD = "CASE feed " + " ".join(
    f"WHEN '{t}' THEN '<{r} id=\"' || source_id || '\"><v>' || xml || '</v></{r}>'" if r == i else f"WHEN '{t}' THEN '<{r}><{i} id=\"' || source_id || '\"/><v>' || xml || '</v></{r}>'"
    for t, f in fx.TYPES.items() for r, i in [registry.FEEDS[f]]) + " END"
#: Events of the job's feeds: of clicks every seventh day can't be read, and the day after it gives none.
_JOB = """SELECT feed, source_id, snapshot_name, xml, t FROM (SELECT o.*, n.seq, lag(n.seq) OVER w AS ps, lag(xml) OVER w AS px FROM one o JOIN names n USING (feed, snapshot_name)
  WHERE NOT (feed = 'click' AND day(o.t) % 7 = 0) WINDOW w AS (PARTITION BY o.feed, source_id ORDER BY n.seq)) x WHERE (ps IS NULL OR ps <> seq - 1 OR px <> xml) AND NOT (feed = 'click' AND day(t) % 7 = 1 AND seq > 1)"""


def _extracted(spark, sf, runs: int, n: int) -> str:
    landing, root = fx.feed_files(spark, sf), fx.scratch(spark)
    for _ in range(runs):
        for done in jobs.extract_next(spark, landing, root, n, compact_after=2):
            if done.error:
                raise done.error
    return root


@query(f"SELECT {_TYPE} AS feed, source_id, snapshot_name, {_RECORD} AS xml FROM ({_JOB})")
def d6_extract_job(spark, sf):
    """Three runs of the job, of fifteen snapshots for each feed; the second compacts and the last finds nothing new."""
    return jobs.read_log(spark, _extracted(spark, sf, 3, 15)).select(*_EV)


@query(f"""SELECT {_TYPE} AS feed, last_extracted, events, ids, rejected FROM
  (SELECT feed, max(snapshot_name) FILTER (seq <= 20) AS last_extracted, count(*) FILTER (feed = 'click' AND day(t) % 7 = 0 AND seq <= 20) AS rejected FROM names GROUP BY feed)
  JOIN (SELECT feed, count(*) AS events, count(DISTINCT source_id) AS ids FROM ({_JOB}) e JOIN (SELECT feed, snapshot_name, seq FROM names) USING (feed, snapshot_name) WHERE seq <= 20 GROUP BY feed) USING (feed)""")
def d6_markers_and_ids(spark, sf):
    """After two runs of ten snapshots: marker, events, known sources and rejected snapshots of each feed."""
    root = _extracted(spark, sf, 2, 10)
    per = lambda name: jobs.read_log(spark, root, name).groupBy("feed").agg(F.count("*").alias({"source_ids": "ids"}.get(name, name)))
    return jobs.markers(spark, root).join(per("events"), "feed").join(per("source_ids"), "feed").join(per("rejected"), "feed", "left").withColumn("rejected", F.coalesce("rejected", F.lit(0).cast("bigint")))


@query(f"SELECT {_TYPE} AS feed, source_id, snapshot_name, {_RECORD} AS xml FROM ({_JOB})")
def d5_repair_late_snapshots(spark, sf):
    """The job on a landing folder without every fifth day; then these land, and each feed's log is repaired."""
    landing, root = fx.feed_files(spark, sf, "day(publication_time) % 5 <> 0 or day(publication_time) = 30"), fx.scratch(spark)
    jobs.extract_next(spark, landing, root, 100)
    fx.feed_files(spark, sf, "day(publication_time) % 5 = 0", landing)
    for feed in registry.DEFAULT_FEEDS:
        repair.repair_feed(spark, landing, root, feed)
    return jobs.read_log(spark, root).select(*_EV)


@query("SELECT feed, source_id, row_key, max(snapshot_name) AS snapshot_name FROM (SELECT feed, source_id, snapshot_name, row_key FROM ev WHERE day(t) <= 20 UNION ALL SELECT feed, source_id, snapshot_name || 'x', row_key FROM ev WHERE day(t) > 15) GROUP BY ALL")
def d7_upsert_events(spark, sf):
    e = fx.events(spark, sf)
    day = F.dayofmonth("publication_time")
    got = changes.upsert_events(e.filter(day > 15).withColumn("snapshot_name", F.concat("snapshot_name", F.lit("x"))), e.filter(day <= 20))
    return got.select("feed", "source_id", "row_key", "snapshot_name")


@query("SELECT DISTINCT feed, source_id FROM ev UNION SELECT 'old', '1'")
def d8_source_ids(spark, sf):
    return changes.source_ids(fx.events(spark, sf), spark.createDataFrame([("old", "1")], "feed string, source_id string"))


@query(f"SELECT feed, source_id, {_XML} AS xml, row_key, snapshot_name FROM ev")
def workload_xml_to_events(spark, sf):
    return snapshots_to_events(fx.snapshots(spark, sf))[0].select("feed", "source_id", "xml", "row_key", "snapshot_name")


@query("SELECT feed, source_id, count(*) AS changes, min(row_key) AS newest FROM ev GROUP BY ALL")
def flagship_changes_per_source(spark, sf):
    return snapshots_to_events(fx.snapshots(spark, sf))[0].groupBy("feed", "source_id").agg(F.count("*").alias("changes"), F.min("row_key").alias("newest"))


# Keys

_KEY = "lpad(CAST(2534023008000000000 - epoch_us(o_orderdate + to_microseconds(o_orderkey * 1001)) * 10 AS VARCHAR), 19, '0')"


def _orders(spark, sf):
    t = F.timestamp_micros(F.unix_micros(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey") * 1001)
    return fx.table(spark, sf, "orders").withColumn("t", t)


@query(f"SELECT o_orderkey, {_KEY} AS row_key FROM orders", base=False)
def k1_row_key(spark, sf):
    return _orders(spark, sf).select("o_orderkey", keys.row_key(F.col("t")).alias("row_key"))


@query("SELECT o_orderkey, epoch_us(o_orderdate + to_microseconds(o_orderkey * 1001)) AS us FROM orders", base=False)
def k2_row_key_to_time(spark, sf):
    return _orders(spark, sf).select("o_orderkey", F.unix_micros(keys.row_key_to_time(keys.row_key(F.col("t")))).alias("us"))


@query("SELECT o_orderkey, strftime(o_orderdate + to_microseconds(o_orderkey * 1001), '%Y-%m-%dT%H:%M:%S') AS id, strftime(o_orderdate + to_microseconds(o_orderkey * 1001) + INTERVAL 9 HOUR, '%Y-%m-%dT%H:%M:%S') AS id_tokyo FROM orders", base=False)
def k3_time_id(spark, sf):
    return _orders(spark, sf).select("o_orderkey", keys.time_id(F.col("t")).alias("id"), keys.time_id(F.col("t"), "Asia/Tokyo").alias("id_tokyo"))


_DOC = "CASE WHEN o_orderkey % 2 = 0 THEN 'S_' || o_custkey || '_' || (o_orderkey % 5 + 1) || '_' ELSE 'S_' || o_custkey || '_' END || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')"


def _doc_ids(spark, sf):
    k = F.col("o_orderkey")
    return _orders(spark, sf).select("o_orderkey", keys.document_id(F.when(k % 2 == 0, "getsituation").otherwise("gettraveltimedata"), F.concat(F.lit("S_"), F.col("o_custkey").cast("string")), k % 5, F.col("o_orderdate").cast("timestamp")).alias("doc_id"))


@query(f"SELECT o_orderkey, {_DOC} AS doc_id FROM orders", base=False)
def k4_document_id(spark, sf):
    return _doc_ids(spark, sf)


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'S_' || o_custkey || '_' || (o_orderkey % 5 + 1) ELSE 'S_' || o_custkey END AS source_id, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS time_id FROM orders", base=False)
def k5_parse_document_id(spark, sf):
    return _doc_ids(spark, sf).select("o_orderkey", keys.parse_document_id(F.col("doc_id")).alias("p")).select("o_orderkey", "p.*")


@query("SELECT DISTINCT feed, feed || '-events' AS events, feed || '-events-json' AS documents, feed || '-events-json-coordinates' AS geometries FROM rec")
def k6_dataset_name(spark, sf):
    return fx.raw_records(spark, sf).select("feed", *[keys.dataset_name(F.col("feed"), k).alias(k) for k in keys.KINDS]).distinct()


@query(f"SELECT o_orderkey, o_custkey || '/' || {_KEY} AS event_path, o_custkey || '/' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS document_path, strftime(o_orderdate, '%Y/%m/%d/%H%M%S') AS blob, strftime(o_orderdate, '%Y%m%d-%H%M%S') AS file FROM orders", base=False)
def k7_object_path(spark, sf):
    d, s = F.col("o_orderdate").cast("timestamp"), F.col("o_custkey").cast("string")
    return _orders(spark, sf).select("o_orderkey", keys.event_path(s, keys.row_key(F.col("t"))).alias("event_path"), keys.document_path(s, d).alias("document_path"), keys.snapshot_path(d).alias("blob"), keys.snapshot_path(d, "file").alias("file"))


@query("SELECT o_orderkey FROM orders WHERE CAST(o_orderdate + to_microseconds(o_orderkey * 1001) AS DATE) = DATE '1998-10-03'", base=False)
def k8_is_of_date(spark, sf):
    return _orders(spark, sf).filter(keys.is_of_date(keys.row_key(F.col("t")), "1998-10-03")).select("o_orderkey")


# Selection


@query("SELECT source_id, snapshot_name FROM ev WHERE feed = 'click'")
def q1_events_for_feed(spark, sf):
    return select.events_for_feed(fx.events(spark, sf), "Click").select("source_id", "snapshot_name")


_RANGE = "t > TIMESTAMP '2024-01-05 00:00:00' AND t <= TIMESTAMP '2024-01-10 00:00:00'"


@query(f"SELECT feed, source_id, snapshot_name FROM ev WHERE {_RANGE}")
def q2_events_in_range(spark, sf):
    return select.events_in_range(fx.events(spark, sf), "2024-01-05", "2024-01-09").select("feed", "source_id", "snapshot_name")


@query(f"SELECT feed, source_id, snapshot_name FROM ev WHERE {_RANGE} AND feed = 'view' AND CAST(source_id AS INTEGER) < 10")
def q3_scan_sources(spark, sf):
    e = fx.events(spark, sf)
    ids = changes.source_ids(e).filter("cast(source_id as int) < 10")
    return select.scan_sources(ids, e, "view", "2024-01-05", "2024-01-09").select("feed", "source_id", "snapshot_name")


@query("SELECT feed, source_id, row_key FROM ev QUALIFY (row_number() OVER (PARTITION BY feed, source_id ORDER BY row_key) - 1) % 10 = 0")
def q4_every_nth(spark, sf):
    return select.every_nth(fx.events(spark, sf), 10).select("feed", "source_id", "row_key")


@query("SELECT feed, source_id, row_key FROM ev WHERE feed = 'view' ORDER BY source_id, row_key LIMIT 100")
def q5_first_n(spark, sf):
    return select.first_n(fx.events(spark, sf).filter("feed = 'view'"), 100).select("feed", "source_id", "row_key")


@query("SELECT feed, source_id, row_key, xml FROM ev QUALIFY row_number() OVER (PARTITION BY feed, source_id ORDER BY row_key) = 1")
def q6_latest_per_source(spark, sf):
    return select.latest_per_source(fx.events(spark, sf)).select("feed", "source_id", "row_key", "xml")


@query("SELECT feed, source_id, row_key, xml FROM ev QUALIFY row_number() OVER (PARTITION BY feed, source_id ORDER BY row_key) <= 3")
def q6_latest_three(spark, sf):
    return select.latest_per_source(fx.events(spark, sf), 3).select("feed", "source_id", "row_key", "xml")


@query("SELECT feed, source_id, row_key, xml FROM ev")
def q7_all_events(spark, sf):
    root = fx.scratch(spark)
    sinks.write_events(fx.events(spark, sf), root)
    return select.all_events(spark, root).select("feed", "source_id", "row_key", "xml")


# Conversion


@query("""SELECT 'S' || l_orderkey AS source_id, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity) - 1 AS INTEGER) AS index,
  '{"@id":"r' || l_linenumber || '","situation":{"@version":"1","@id":"S' || l_orderkey || '","overallSeverity":"low"},"quantity":"' || CAST(l_quantity AS BIGINT) || '"}' AS json FROM lineitem""", base=False)
def j1_j2_split_situations(spark, sf):
    return convert.split_situations(fx.situations(spark, sf)).select("source_id", "index", "json")


@query("""SELECT feed, source_id, snapshot_name, '{"measurementSiteReference":{"@id":"' || source_id || '","@version":"1"},"v":"' || xml || '"}' AS json FROM one""")
def j3_xml_to_json(spark, sf):
    got = rec.dedupe_records(rec.explode_records(fx.snapshots(spark, sf)))
    return got.select("feed", "source_id", "snapshot_name", convert.xml_to_json(F.col("xml")).alias("json"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS DOUBLE) END AS x, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey AS DOUBLE) END AS y, CASE o_orderkey % 3 WHEN 0 THEN 2 WHEN 1 THEN 0 END AS n FROM orders", base=False)
def j4_parse_coordinates(spark, sf):
    k = F.col("o_orderkey")
    text = F.when(k % 3 == 0, F.concat(F.col("o_custkey").cast("string"), F.lit(" "), k.cast("string"), F.lit(",1.5;-2\n7"))).when(k % 3 == 1, F.lit("5")).otherwise(F.lit("1 1d"))
    p = values.parse_coordinates(text)
    first = F.get(p, 0)
    return fx.table(spark, sf, "orders").select("o_orderkey", F.get(first, 0).alias("x"), F.get(first, 1).alias("y"), F.when(p.isNotNull(), F.size(p)).alias("n"))


def _tree(f):
    return lambda spark, sf: fx.trees(spark, sf).select("doc_id", f(F.col("json")).alias("json"))


def _tree_oracle(body: str) -> str:
    return f"SELECT CAST(c_custkey AS VARCHAR) AS doc_id, {body} AS json FROM customer"


@query(_tree_oracle("""'{"@xmlns":"u","latitude":"' || c_custkey || '.5","n":{"longitude":"00' || c_custkey || '","@xmlns":"v","ok":" True "},"a":["7",{"latitude":"x' || c_custkey || '"}],"coordinates":[[' || c_custkey || '.0,2.0],[3.0,4.0]]}'"""), base=False)
def j5_convert_coordinates(spark, sf):
    return _tree(convert.convert_coordinates_json)(spark, sf)


@query(_tree_oracle("""'{"@xmlns":"u","lat":"' || c_custkey || '.5","n":{"lon":"00' || c_custkey || '","@xmlns":"v","ok":" True "},"a":["7",{"lat":"x' || c_custkey || '"}],"coordinates":"' || c_custkey || ' 2,3;4 5"}'"""), base=False)
def j6_rename_keys(spark, sf):
    return _tree(convert.rename_keys)(spark, sf)


@query(_tree_oracle("""'{"latitude":"' || c_custkey || '.5","n":{"longitude":"00' || c_custkey || '","ok":" True "},"a":["7",{"latitude":"x' || c_custkey || '"}],"coordinates":"' || c_custkey || ' 2,3;4 5"}'"""), base=False)
def j7_drop_keys(spark, sf):
    return _tree(convert.drop_keys)(spark, sf)


@query(_tree_oracle("""'{"@xmlns":"u","latitude":' || c_custkey || '.5,"n":{"longitude":' || c_custkey || ',"@xmlns":"v","ok":true},"a":["7",{"latitude":"x' || c_custkey || '"}],"coordinates":"' || c_custkey || ' 2,3;4 5"}'"""), base=False)
def j8_infer_document(spark, sf):
    return _tree(convert.infer_scalars)(spark, sf)


@query("""SELECT o_orderkey, ['bool', 'int', 'double', 'double', 'int', 'string', 'string', 'string', 'int'][CAST(o_orderkey % 9 + 1 AS INTEGER)] AS kind,
  CASE o_orderkey % 9 WHEN 1 THEN 7 WHEN 4 THEN 9223372036854775807 WHEN 8 THEN o_orderkey END AS l, CASE o_orderkey % 9 WHEN 2 THEN 1e3 WHEN 3 THEN 1234e0 END AS d FROM orders""", base=False)
def j8_infer_scalar(spark, sf):
    k = F.col("o_orderkey")
    text = F.element_at(F.array(*[F.lit(x) for x in (" True ", "007", "1e3", "1,234", "9223372036854775807", "NaN", "1d", "2015-01-01", "")]), (k % 9 + 1).cast("int"))
    v = values.infer_scalar(F.when(k % 9 == 8, k.cast("string")).otherwise(text))
    return fx.table(spark, sf, "orders").select("o_orderkey", v["kind"].alias("kind"), v["l"].alias("l"), v["d"].alias("d"))


_DOCS = """SELECT feed, source_id || '_' || strftime(t, '%Y-%m-%dT%H:%M:%S') AS doc_id, '{"id":"' || source_id || '_' || strftime(t, '%Y-%m-%dT%H:%M:%S') || '","publicationTime":"' || strftime(t, '%Y-%m-%dT%H:%M:%S') || '.000Z","measurementSiteReference":{"@id":' || source_id || ',"@version":1},"v":' || xml || '}' AS json FROM ev"""


def _documents(spark, sf):
    return convert.parts(convert.converted(snapshots_to_events(fx.snapshots(spark, sf))[0]))[0]


@query(_DOCS)
def j9_j13_convert_events(spark, sf):
    return _documents(spark, sf).select("feed", "doc_id", "json")


_PLACE = "'L' || c_custkey || '_' || strftime(TIMESTAMP '2015-01-01 00:59:59' + to_seconds(c_custkey), '%Y-%m-%dT%H:%M:%S')"
_SHAPE = """'{"coordinates":[[' || CAST(c_custkey % 360 - 180 AS DOUBLE) || ',' || CAST(c_custkey % 180 - 90 AS DOUBLE) || '],[' || CAST(c_custkey % 180 - 90 AS DOUBLE) || ',' || CAST(c_custkey % 360 - 180 AS DOUBLE) || ']]}'"""


@query(f"SELECT {_PLACE} AS doc_id, {_SHAPE} AS geometry FROM customer WHERE c_custkey % 10 <> 9", base=False)
def j10_extract_geometry(spark, sf):
    return convert.convert_events(fx.places(spark, sf))[1].select("doc_id", "geometry")


@query("SELECT 'L' || c_custkey AS source_id FROM customer WHERE c_custkey % 10 = 9", base=False)
def j10_rejects(spark, sf):
    return convert.convert_events(fx.places(spark, sf))[2].select("source_id")


@query("""SELECT CAST(c_custkey AS VARCHAR) AS doc_id, p.position, p.path, p.kind FROM customer, (VALUES (0, '@xmlns', 'string'), (1, 'latitude', 'string'), (2, 'n', 'object'), (3, 'n.longitude', 'string'), (4, 'n.@xmlns', 'string'), (5, 'n.ok', 'string'), (6, 'a', 'array'), (7, 'coordinates', 'string')) p(position, path, kind)""", base=False)
def j11_flatten_properties(spark, sf):
    return convert.flatten_properties(fx.trees(spark, sf)).select("doc_id", "position", "path", "kind")


@query(_tree_oracle("""'{"@XMLNS":"u!","LATITUDE":"' || c_custkey || '.5!","A":["7",{"LATITUDE":"x' || c_custkey || '!"}],"COORDINATES":"' || c_custkey || ' 2,3;4 5!"}'"""), base=False)
def j12_map_document(spark, sf):
    return _tree(lambda c: convert.map_document(c, str.upper, lambda k: k == "n", lambda v: v + "!" if isinstance(v, str) else v))(spark, sf)


@query(f"SELECT {_PLACE} AS doc_id, CASE WHEN c_custkey % 2 = 0 THEN {_SHAPE} END AS geometry FROM customer WHERE c_custkey % 10 <> 9", base=False)
def j14_attach_geometry(spark, sf):
    docs, shapes, _ = convert.convert_events(fx.places(spark, sf))
    even = shapes.filter("cast(substring(source_id, 2) as bigint) % 2 = 0")
    return convert.attach_geometry(docs, even).select("doc_id", "geometry")


# Sinks


@query("SELECT feed, source_id, row_key, strftime(t, '%Y-%m-%d') AS event_date FROM ev")
def w1_write_events(spark, sf):
    root = fx.scratch(spark)
    sinks.write_events(fx.events(spark, sf), root)
    return spark.read.parquet(root).select("feed", "source_id", "row_key", F.col("event_date").cast("string").alias("event_date"))


@query(f"SELECT feed, source_id, snapshot_name, row_key FROM ev WHERE feed = 'view' AND CAST(source_id AS INTEGER) % 97 = 3 AND {_RANGE}")
def w1_scan_by_source(spark, sf):
    """Some sources of a feed in a range of days, from a store by source that was written and then compacted with later events."""
    e = fx.events(spark, sf).withColumn("feed", fx.feed_of(F.col("feed")))
    early = F.dayofmonth("publication_time") <= 8
    store = layout.write_by_source(e.filter(early), layout.fresh_name(), fx.scratch(spark), 16)
    store = layout.compact_by_source(store, e.filter(~early), layout.fresh_name(), fx.scratch(spark), 16)
    ids = changes.source_ids(e).filter("cast(source_id as int) % 97 = 3")
    found = layout.scan_by_source(store, ids, fx.TYPES["view"], "2024-01-05", "2024-01-09")
    return found.select(F.lit("view").alias("feed"), "source_id", "snapshot_name", "row_key")


@query("SELECT e.feed, e.source_id, e.row_key, n.first FROM ev e JOIN (SELECT feed, source_id, min(snapshot_name) AS first FROM ev GROUP BY ALL) n USING (feed, source_id)")
def w1_join_by_source(spark, sf):
    """Each event with its source's first snapshot: two stores by source, joined without a shuffle."""
    e = fx.events(spark, sf)
    first = e.groupBy("feed", "source_id").agg(F.min("snapshot_name").alias("first"))
    a, b = (layout.write_by_source(df, layout.fresh_name(), fx.scratch(spark), 16) for df in (e, first))
    return layout.join_by_source(a, b).select("feed", "source_id", "row_key", "first")


@query(_DOCS)
def w2_write_documents(spark, sf):
    root = fx.scratch(spark)
    sinks.write_documents(_documents(spark, sf), root)
    return spark.read.parquet(root).select("feed", "doc_id", "json")


@query(f"SELECT {_PLACE} AS doc_id, {_SHAPE} AS geometry FROM customer WHERE c_custkey % 10 <> 9", base=False)
def w3_write_geometries(spark, sf):
    root = fx.scratch(spark)
    sinks.write_geometries(convert.convert_events(fx.places(spark, sf))[1], root)
    return spark.read.parquet(root).select("doc_id", "geometry")


def _versions(spark, sf):
    o = fx.table(spark, sf, "orders")
    return o.select(F.lit("f").alias("feed"), F.col("o_custkey").cast("string").alias("doc_id"), F.col("o_custkey").cast("string").alias("source_id"), F.col("o_orderdate").cast("timestamp").alias("event_time"), F.lpad((F.lit(10**9) - F.col("o_orderkey")).cast("string"), 10, "0").alias("row_key"), F.col("o_orderkey").cast("string").alias("json"))


@query("SELECT CAST(o_custkey AS VARCHAR) AS doc_id, CAST(coalesce(max(o_orderkey) FILTER (o_orderkey % 3 = 0), max(o_orderkey)) AS VARCHAR) AS json FROM orders GROUP BY o_custkey", base=False)
def w4_upsert_documents(spark, sf):
    v = _versions(spark, sf)
    third = F.col("json").cast("bigint") % 3 == 0
    return sinks.upsert_documents(sinks.keep_last(v.filter(~third)), v.filter(third)).select("doc_id", "json")


@query("""WITH v AS (SELECT o_custkey, o_orderkey, o_orderkey % 3 = 0 AS third FROM orders),
  r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS n FROM v WHERE third)
  SELECT CAST(o_custkey AS VARCHAR) AS doc_id, CAST(o_orderkey AS VARCHAR) AS json, n = 1 AND o_custkey NOT IN (SELECT o_custkey FROM v WHERE NOT third) AS inserted FROM r""", base=False)
def w5_insert_new_documents(spark, sf):
    v = _versions(spark, sf)
    third = F.col("json").cast("bigint") % 3 == 0
    new, conflicts = sinks.insert_new_documents(v.filter(~third), v.filter(third))
    return new.select("doc_id", "json", F.lit(True).alias("inserted")).unionByName(conflicts.select("doc_id", "json", F.lit(False).alias("inserted")))


_BITS = "CASE WHEN (5 * c + j) % 2 = 0 THEN (x >> CAST(27 - (5 * c + j) // 2 AS INTEGER)) & 1 ELSE (y >> CAST(26 - (5 * c + j) // 2 AS INTEGER)) & 1 END"


@query(f"""WITH p AS (
    SELECT c_custkey, 'getmeasurementweathersitetable' AS feed, c_custkey % 170 - 85 AS a, c_custkey % 350 - 175 AS b, 1 AS n FROM customer WHERE c_custkey % 3 = 0
    UNION ALL SELECT c_custkey, 'getsituation', c_custkey % 160 - 80, c_custkey % 340 - 170, c_custkey % 3 FROM customer WHERE c_custkey % 3 > 0),
  q AS (SELECT c_custkey, feed, CAST(CAST(a AS VARCHAR) || '.5' AS DOUBLE) AS lat, CAST(CAST(b AS VARCHAR) || '.25' AS DOUBLE) AS lon, unnest(range(n)) AS copy FROM p),
  g AS (SELECT *, CAST(floor((lon + 180) / 360 * 268435456) AS BIGINT) AS x, CAST(floor((lat + 90) / 180 * 134217728) AS BIGINT) AS y FROM q)
  SELECT feed, 'D' || c_custkey AS doc_id, lat, lon, array_to_string(list_transform(range(11), lambda c: substr('0123456789bcdefghjkmnpqrstuvwxyz', CAST(1 + list_sum(list_transform(range(5), lambda j: (16 >> CAST(j AS INTEGER)) * ({_BITS}))) AS INTEGER), 1)), '') AS geohash FROM g""", base=False)
def w6_geo_index(spark, sf):
    return geo.geo_index(fx.site_documents(spark, sf)).select("feed", "doc_id", "lat", "lon", "geohash")


_SPOTS = """p AS (SELECT c_custkey, c_custkey % 170 - 85 AS a, c_custkey % 350 - 175 AS b, 1 AS n FROM customer WHERE c_custkey % 3 = 0
    UNION ALL SELECT c_custkey, c_custkey % 160 - 80, c_custkey % 340 - 170, c_custkey % 3 FROM customer WHERE c_custkey % 3 > 0),
  q AS (SELECT 'D' || c_custkey AS doc_id, CAST(CAST(a AS VARCHAR) || '.5' AS DOUBLE) AS lat, CAST(CAST(b AS VARCHAR) || '.25' AS DOUBLE) AS lon, unnest(range(n)) AS copy FROM p)"""
_PLACES = [("north", 84.0, 20.0), ("line", -10.0, 179.5), ("oslo", 59.91, 10.75)]
_FAR = "2 * 6371008.8 * asin(least(sqrt(pow(sin(radians(lat - x.y) / 2), 2) + cos(radians(x.y)) * cos(radians(lat)) * pow(sin(radians(lon - x.x) / 2), 2)), 1.0))"


@query(f"""WITH {_SPOTS} SELECT place, doc_id, CAST(round({_FAR}) AS BIGINT) AS metres FROM q, (VALUES {', '.join(map(str, _PLACES))}) x(place, y, x) WHERE {_FAR} <= 1500000""", base=False)
def w6_search_radius(spark, sf):
    """Points near one place after another: by the pole, over 180 degrees, and inland."""
    points = geo.geo_index(fx.site_documents(spark, sf))
    found = [geo.within_radius(points, lat, lon, 1.5e6).select(F.lit(name).alias("place"), "doc_id", F.round("distance").cast("bigint").alias("metres")) for name, lat, lon in _PLACES]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query(f"""WITH {_SPOTS} SELECT 'S' || s_suppkey AS place_id, doc_id, copy FROM q, (SELECT s_suppkey, (s_suppkey * 7) % 179 - 89 AS y, (s_suppkey * 13) % 359 - 179 AS x FROM supplier) x WHERE {_FAR} <= 300000""", base=False)
def w6_near_places(spark, sf):
    """Points near each of many places, by one join."""
    copy = F.row_number().over(Window.partitionBy("feed", "doc_id").orderBy("path")) - 1
    points = geo.geo_index(fx.site_documents(spark, sf)).withColumn("copy", copy.cast("bigint"))
    k = F.col("s_suppkey")
    places = fx.table(spark, sf, "supplier").select(F.concat(F.lit("S"), k.cast("string")).alias("place_id"), ((k * 7) % 179 - 89).alias("lat"), ((k * 13) % 359 - 179).alias("lon"))
    return geo.near_places(points, places, 300e3).select("place_id", "doc_id", "copy")


@query(f"""WITH {_SPOTS} SELECT doc_id, lat, lon FROM q WHERE lat BETWEEN -30 AND 40 AND (lon >= 150 OR lon <= -160)""", base=False)
def w6_search_box(spark, sf):
    return geo.within_box(geo.geo_index(fx.site_documents(spark, sf)), -30, 150, 40, -160).select("doc_id", "lat", "lon")


@query(_DOCS.replace("FROM ev", "FROM ev WHERE feed = 'view'"))
def w7_index_documents(spark, sf):
    root = fx.scratch(spark)
    events = snapshots_to_events(fx.snapshots(spark, sf))[0]
    sinks.index_documents(events, lambda e: select.events_for_feed(e, "view"), lambda d: d.write.parquet(root))
    return spark.read.parquet(root).select("feed", "doc_id", "json")


@query("SELECT 'lat' AS field, avg(c_custkey % 180 - 90) AS mean, count(*) AS n FROM customer", base=False)
def w8_create_index_table(spark, sf):
    """Points written with a feed's typed schema and read back."""
    root = fx.scratch(spark)
    registry.create_index_table(spark, "getmeasurementweathersitetable", root)
    schema = registry.feed_schema("getmeasurementweathersitetable")
    k = F.col("c_custkey")
    point = F.struct(F.struct(F.struct((k % 180 - 90).cast("double").alias("lat"), F.lit(0.0).alias("lon")).alias("pointCoordinates")).alias("pointByCoordinates"))
    rows = fx.table(spark, sf, "customer").select(F.lit("getmeasurementweathersitetable").alias("feed"), k.cast("string").alias("doc_id"), k.cast("string").alias("source_id"), F.lit(0).alias("record_index"), F.lit(None).cast("timestamp").alias("event_time"), F.lit(None).cast("timestamp").alias("publication_time"), point.cast(schema["measurementSiteLocation"].dataType).alias("measurementSiteLocation"))
    rows.write.mode("append").parquet(root)
    got = spark.read.schema(schema).parquet(root)
    return got.agg(F.lit("lat").alias("field"), F.avg("measurementSiteLocation.pointByCoordinates.pointCoordinates.lat").alias("mean"), F.count("*").alias("n")).select("field", "mean", "n")


@query("""SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 3 = 0 THEN 1.0 * o_custkey WHEN o_orderkey % 3 = 1 THEN o_custkey + 0.5 END AS DOUBLE) AS number,
  CASE o_orderkey % 4 WHEN 0 THEN 'true' WHEN 1 THEN CAST(o_custkey AS VARCHAR) WHEN 2 THEN 'word' ELSE '{"a":1}' END AS mixed, CASE WHEN o_orderkey % 5 = 0 THEN o_custkey END AS rare, 1 AS version FROM orders""", base=False)
def w8_typed_view(spark, sf):
    """Documents whose fields differ in type from one to the next, through the recorded type of their feed."""
    o, k, c = fx.table(spark, sf, "orders"), F.col("o_orderkey"), F.col("o_custkey").cast("string")
    number = F.when(k % 3 == 0, F.concat(F.lit('"number":'), c, F.lit(","))).when(k % 3 == 1, F.concat(F.lit('"number":'), c, F.lit(".5,"))).otherwise("")
    mixed = F.when(k % 4 == 0, F.lit("true")).when(k % 4 == 1, c).when(k % 4 == 2, F.lit('"word"')).otherwise(F.lit('{"a":1}'))
    rare = F.when(k % 5 == 0, F.concat(F.lit(',"deep":{"rare":'), c, F.lit("}"))).otherwise("")
    docs = o.select(F.lit("gettraveltimedata").alias("feed"), k.cast("string").alias("doc_id"), F.concat(F.lit("{"), number, F.lit('"mixed":'), mixed, rare, F.lit("}")).alias("json"))
    root = fx.scratch(spark)
    for _ in range(2):  # the second time nothing is new
        typed.record_types(spark, root, docs)
    view = typed.typed_view(docs, "gettraveltimedata", typed.known_types(spark, root)["gettraveltimedata"])
    return view.select(F.col("doc_id").cast("bigint").alias("o_orderkey"), "doc.number", "doc.mixed", F.col("doc.deep.rare").alias("rare"), F.lit(1).alias("version"))


@query("SELECT CAST(row_number() OVER (ORDER BY row_key DESC) AS INTEGER) AS n, xml FROM ev WHERE feed = 'view' AND source_id = '7'")
def w9_export_source(spark, sf):
    root = fx.scratch(spark)
    sinks.export_source(fx.events(spark, sf), "view", "7", root)
    return spark.read.text(root).select(F.col("n").cast("int").alias("n"), F.col("value").alias("xml"))


@query(_DOCS.replace("FROM ev", "FROM ev WHERE feed = 'click'"))
def w10_get_documents(spark, sf):
    root = fx.scratch(spark)
    sinks.write_documents(_documents(spark, sf), root)
    return sinks.get_documents(spark, root, "Click").select("feed", "doc_id", "json")


# Profiling


@query("SELECT feed, strftime(t, '%Y-%m-%d') AS day, count(*) AS snapshots, CAST(sum(strlen(content)) AS BIGINT) AS bytes, CAST(sum(strlen(content)) // 1024 AS BIGINT) AS kb, CAST(sum(strlen(content)) // 1048576 AS BIGINT) AS mb FROM snaps GROUP BY ALL")
def a1_snapshot_volume(spark, sf):
    return profile.snapshot_volume(fx.snapshots(spark, sf)).select("feed", F.col("day").cast("string").alias("day"), "snapshots", "bytes", "kb", "mb")


@query("SELECT feed, source_id, count(*) AS events, CAST(sum(length) AS BIGINT) AS bytes, CAST(count(DISTINCT source_id) AS BIGINT) AS sources FROM ev GROUP BY GROUPING SETS ((feed, source_id), (feed))")
def a2_event_volume(spark, sf):
    return profile.event_volume(fx.events(spark, sf)).select("feed", "source_id", "events", "bytes", "sources")


_FIRST = "SELECT feed, source_id, count(*) AS n, arg_min(length, row_key) AS f FROM ev"


@query(f"""SELECT *, CASE WHEN est_events > 0 THEN est_bytes // est_events END AS mean_bytes FROM (
  SELECT feed, count(*) AS sources, CAST(coalesce(sum(n) FILTER (r > 50 AND r <= 100), 0) // 50 * count(*) AS BIGINT) AS est_events, CAST(coalesce(sum(n * f) FILTER (r > 50 AND r <= 100), 0) * (count(*) // 50) AS BIGINT) AS est_bytes
  FROM (SELECT *, row_number() OVER (PARTITION BY feed ORDER BY source_id) AS r FROM ({_FIRST} GROUP BY feed, source_id)) GROUP BY feed)""")
def a3_estimate_volume(spark, sf):
    return profile.estimate_volume(fx.events(spark, sf))


@query(f"""SELECT feed, count(*) AS sources, CAST(sum(n) AS BIGINT) AS events, CAST(sum(n * f) AS BIGINT) AS bytes, CAST(sum(n * f) // sum(n) // 1024 AS BIGINT) AS mean_kb
  FROM ({_FIRST} WHERE day(t) = 8 GROUP BY feed, source_id) GROUP BY feed""")
def a4_day_volume(spark, sf):
    return profile.day_volume(fx.events(spark, sf), "2024-01-08")


@query(f"""SELECT f.feed, count(e.source_id) AS sources, CAST(coalesce(sum(e.n), 0) AS BIGINT) AS events, CAST(coalesce(sum(e.n * e.f), 0) AS BIGINT) AS bytes, CAST(sum(e.n * e.f) // sum(e.n) // 1024 AS BIGINT) AS mean_kb
  FROM (SELECT DISTINCT feed FROM rec) f LEFT JOIN ({_FIRST} WHERE day(t) = 8 AND feed <> 'click' GROUP BY feed, source_id) e USING (feed) GROUP BY f.feed""")
def a4_quiet_feeds(spark, sf):
    """A feed without events on the day has a row of zeros."""
    raw = fx.raw_records(spark, sf)
    events = fx.events(spark, sf).filter("feed <> 'click' or event_date <> date'2024-01-08'")
    return profile.day_volume(events, "2024-01-08", raw.select("feed"))


@query("SELECT source_id, count(*) AS events, count(DISTINCT feed) AS feeds FROM ev GROUP BY source_id")
def a5_group_sources(spark, sf):
    return profile.group_sources(fx.events(spark, sf))


# Collection operators


@query("SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1", base=False)
def x1_distinct_by(spark, sf):
    return select.distinct_by(fx.table(spark, sf, "orders"), ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")]).select("o_custkey", "o_orderkey")


@query("SELECT o_orderpriority, count(*) AS count FROM orders GROUP BY 1", base=False)
def x2_count_by(spark, sf):
    return select.count_by(fx.table(spark, sf, "orders"), ["o_orderpriority"])


@query("SELECT o.k AS o_orderkey, c.k AS c_custkey, o.p AS position FROM (SELECT o_orderkey AS k, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS p FROM orders) o JOIN (SELECT c_custkey AS k, row_number() OVER (ORDER BY c_custkey DESC) - 1 AS p FROM customer) c USING (p)", base=False)
def x3_zip_by_position(spark, sf):
    o, c = fx.table(spark, sf, "orders").select("o_totalprice", "o_orderkey"), fx.table(spark, sf, "customer").select("c_custkey", (-F.col("c_custkey")).alias("back"))
    return select.zip_by_position(o, ["o_totalprice", "o_orderkey"], c, ["back"]).select("o_orderkey", "c_custkey", "position")


_STOP = "(SELECT min(o_orderkey) FROM orders WHERE NOT o_totalprice < 499000)"


@query(f"SELECT o_orderkey FROM orders WHERE o_orderkey < {_STOP}", base=False)
def x4_take_while(spark, sf):
    return select.take_while(fx.table(spark, sf, "orders"), "o_orderkey", F.col("o_totalprice") < 499000).select("o_orderkey")


@query(f"SELECT o_orderkey FROM orders WHERE o_orderkey >= {_STOP}", base=False)
def x4_skip_while(spark, sf):
    return select.skip_while(fx.table(spark, sf, "orders"), "o_orderkey", F.col("o_totalprice") < 499000).select("o_orderkey")


@query("SELECT o_custkey, CAST(sum(o_orderkey) AS BIGINT) AS sum, avg(o_orderkey) AS average, min(o_orderkey) AS min, max(o_orderkey) AS max FROM orders GROUP BY 1", base=False)
def x5_summarize_by(spark, sf):
    return select.summarize_by(fx.table(spark, sf, "orders"), ["o_custkey"], F.col("o_orderkey"))


# Streams: each drains what is there, so the batch answer must come out.


@query("SELECT feed, snapshot_name, CAST(strlen(content) AS BIGINT) AS length FROM snaps")
def t1_stream_snapshots(spark, sf):
    root, out = fx.landed(spark, sf, "blob"), fx.scratch(spark)
    stream = feeds.stream_snapshots(spark, root).select("feed", "snapshot_name", "length")
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-log").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out)


def _stream_changes(spark, sf):
    """Days in order of time, some at a time, through the stream; then a late copy of the first day."""
    root, out = fx.scratch(spark), fx.scratch(spark)
    snaps = fx.snapshots(spark, sf)
    schema = snaps.schema
    for part in ("day(snapshot_ts) <= 9", "day(snapshot_ts) between 10 and 20", "day(snapshot_ts) > 20", "day(snapshot_ts) = 1"):
        snaps.filter(part).write.mode("append").parquet(root)
        source = spark.readStream.schema(schema).parquet(root)
        feeds.stream_changes(source, out, f"{out}-log").awaitTermination()
    return out


@query(f"SELECT feed, source_id, snapshot_name, {_XML} AS xml FROM ev")
def t2_stream_changes(spark, sf):
    return spark.read.parquet(f"{_stream_changes(spark, sf)}/events").select(*_EV)


@query("SELECT feed, snapshot_name FROM names WHERE seq = 1")
def t3_late_snapshots(spark, sf):
    return spark.read.parquet(f"{_stream_changes(spark, sf)}/late").select("feed", "snapshot_name")


@query("SELECT event_type AS feed, strftime(date_trunc('hour', ts), '%Y/%m/%d/%H%M%S') AS snapshot_name, CAST(coalesce(min(event_id) FILTER (event_id % 2 = 0), min(event_id)) AS VARCHAR) AS content FROM events GROUP BY ALL", base=False)
def t4_stream_land(spark, sf):
    root, out = fx.scratch(spark), fx.scratch(spark)
    e = fx.table(spark, sf, "events")
    rows = e.select(F.col("event_type").alias("feed"), F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("last_modified"), F.col("event_id").cast("string").cast("binary").alias("content"), F.col("event_id").alias("arrival"))
    # Even ids come first, then all of them, half of which have landed.
    for part in (rows.filter("arrival % 2 = 0"), rows):
        part.write.mode("append").parquet(root)
        feeds.stream_land(spark.readStream.schema(rows.schema).parquet(root), out, f"{out}-log").awaitTermination()
    return spark.read.parquet(f"{out}/snapshots").select("feed", "snapshot_name", F.col("content").cast("string").alias("content"))


@query(_DOCS)
def t5_stream_documents(spark, sf):
    root, out = fx.scratch(spark), fx.scratch(spark)
    events = snapshots_to_events(fx.snapshots(spark, sf))[0]
    events.write.parquet(root)
    feeds.stream_documents(spark.readStream.schema(events.schema).parquet(root), out, f"{out}-log").awaitTermination()
    return feeds.read_documents(spark, out).select("feed", "doc_id", "json")


_SECOND = "TIMESTAMP '2015-01-01 00:00:00' + to_seconds(o_custkey * 1000)"


@query(f"""SELECT 'C' || o_custkey || '_' || strftime({_SECOND}, '%Y-%m-%dT%H:%M:%S') AS doc_id, max(o_orderkey % 1000000) AS version, count(*) AS versions FROM orders GROUP BY o_custkey""", base=False)
def t5_late_versions(spark, sf):
    """Versions of one second come in three batches, newest first; the store is compacted in between, and a batch comes twice."""
    root, o = fx.scratch(spark), fx.table(spark, sf, "orders")
    k, c = F.col("o_orderkey") % 1000000, F.col("o_custkey")
    time = F.timestamp_micros((F.lit(1420070400) + c * 1000) * 1000000 + k)
    # The newest version of each document is in the first batch.
    newest = F.max(k).over(Window.partitionBy("o_custkey")) == k
    part = F.when(newest, 0).otherwise(1 + F.col("o_orderkey") % 2)
    xml = F.concat(F.lit("<r><version>"), k.cast("string"), F.lit("</version></r>"))
    events = o.select(F.lit("getmeasuredweatherdata").alias("feed"), F.concat(F.lit("C"), c.cast("string")).alias("source_id"), time.alias("publication_time"), keys.row_key(time).alias("row_key"), xml.alias("xml"), part.alias("part"))
    run = feeds.index_batch(root, "orders", compact_after=2)
    for number in (0, 1, 1, 2):
        run(events.filter(F.col("part") == number).drop("part"), number)
    sizes = o.groupBy(F.concat(F.lit("C"), c.cast("string")).alias("source_id")).agg(F.count("*").alias("versions"))
    docs = feeds.read_documents(spark, root).select("doc_id", "source_id", F.get_json_object("json", "$.version").cast("bigint").alias("version"))
    return docs.join(sizes, "source_id").select("doc_id", "version", "versions")
