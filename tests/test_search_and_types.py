"""Search by place and typed views, against brute force."""

import json
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, NullType, StringType, StructType

from waymark.functions.values import geohash
from waymark.operators import geo, typed

# Places


def far(a, b, c, d):
    a, b, c, d = map(math.radians, (a, b, c, d))
    h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
    return 2 * geo.EARTH * math.asin(min(1, math.sqrt(h)))


@pytest.fixture(scope="module")
def spots():
    rng = np.random.default_rng(8)
    z = rng.uniform(-1, 1, 1500)
    out = list(zip(np.degrees(np.arcsin(z)).tolist(), rng.uniform(-180, 180, 1500).tolist()))
    out += [(90.0, 0.0), (-90.0, 77.0), (0.0, 180.0), (0.0, -180.0), (59.91, 10.75), (59.91, 10.75), (60.0, -180.0), (89.9999, 12.0)]
    return out + [(59.9 + x, 10.7 + y) for x, y in rng.normal(0, 0.2, (300, 2)).tolist()]


@pytest.fixture(scope="module")
def points(spark, spots):
    df = spark.createDataFrame([(k, *p) for k, p in enumerate(spots)], "k int, lat double, lon double")
    return df.withColumn("geohash", geohash(F.col("lat"), F.col("lon")))


CENTRES = [(59.91, 10.75, 5000.0), (59.91, 10.75, 0.0), (0.0, 179.9, 900e3), (-17.0, -179.5, 2e6), (89.0, 30.0, 500e3), (-90.0, 0.0, 3e6), (10.0, 20.0, 2.1e7), (45.0, 0.0, 1e6), (60.0, 180.0, 10.0), (0.0, -180.0, 1.0)]


@pytest.mark.parametrize("lat,lon,metres", CENTRES)
def test_radius_against_all_distances(points, spots, lat, lon, metres):
    got = {r.k: r.distance for r in geo.within_radius(points, lat, lon, metres).collect()}
    expect = {k: far(lat, lon, *p) for k, p in enumerate(spots) if far(lat, lon, *p) <= metres}
    assert set(got) == set(expect) and all(got[k] == pytest.approx(expect[k], abs=1e-6) for k in got)


@pytest.mark.parametrize("s,w,n,e", [(59, 10, 61, 12), (-20, 170, 20, -170), (-90, -180, 90, 180), (0, 180, 0, 180), (50, -180, 70, -170), (-5, 100, 5, 180), (10, 20, 10, 20)])
def test_box_against_all_points(points, spots, s, w, n, e):
    inside = lambda lon: w <= lon <= e or (w > e and (lon >= w or lon <= e)) or (180 in (w, e, -w, -e) and abs(lon) == 180 and (w <= 180 <= e or w <= -180 <= e or w == 180 or e == -180))
    assert {r.k for r in geo.within_box(points, s, w, n, e).collect()} == {k for k, (lat, lon) in enumerate(spots) if s <= lat <= n and inside(lon)}


def test_places_join_against_all_pairs(spark, points, spots):
    places = [("a", 59.91, 10.75), ("b", 0.0, 180.0), ("c", 90.0, 0.0), ("d", 45.0, 0.0), ("e", None, 0.0), ("f", 91.0, 0.0)]
    for metres in (20e3, 1e6):
        got = {(r.place_id, r.k) for r in geo.near_places(points, spark.createDataFrame(places, "place_id string, lat double, lon double"), metres).collect()}
        assert got == {(i, k) for i, lat, lon in places[:4] for k, p in enumerate(spots) if far(lat, lon, *p) <= metres}


@settings(max_examples=300, deadline=None)
@given(st.floats(-90, 90), st.floats(-180, 180), st.floats(1, 2e7), st.floats(-90, 90), st.floats(-180, 180))
def test_boxes_hold_their_circles(lat, lon, metres, a, b):
    if far(lat, lon, a, b) <= metres:
        assert any(s <= a <= n and w <= b <= e for s, w, n, e in geo.boxes(lat, lon, metres))


def test_searches_skip_by_key_ranges(spark, points, tmp_path):
    folder = str(tmp_path / "points")
    points.repartitionByRange(16, "geohash").sortWithinPartitions("geohash").write.parquet(folder)
    found = geo.within_radius(spark.read.parquet(folder), 59.91, 10.75, 3000)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(geohash" in plan.split("PushedFilters")[1].split("\n")[0] and found.count() > 0
    assert len(geo.ranges(geo.cover(geo.boxes(59.91, 10.75, 3000)))) < 30


def test_cover_ranges_join_neighbours():
    assert geo.ranges(["u4p", "u4q", "u4r", "u4z"]) == [("u4p", "u4r~"), ("u4z", "u4z~")]
    assert geo.cover([(-90.0, -180.0, 90.0, 180.0)]) == sorted(geo.ALPHABET)


# Types

VALUES = st.recursive(st.one_of(st.none(), st.booleans(), st.integers(-(1 << 70), 1 << 70), st.floats(allow_nan=False, allow_infinity=False), st.text("ab", max_size=2)), lambda inner: st.one_of(st.lists(inner, max_size=3), st.dictionaries(st.sampled_from("abc"), inner, max_size=3)), max_leaves=6)


@settings(max_examples=300, deadline=None)
@given(VALUES, VALUES, VALUES)
def test_widening_is_a_join(a, b, c):
    x, y, z = map(typed.type_of, (a, b, c))
    w = typed.widened
    assert w(x, y) == w(y, x) and w(x, x) == x and w(w(x, y), z) == w(x, w(y, z)) and w(x, NullType()) == x
    assert w(w(x, y), x) == w(x, y)


def brute_type(values):
    """The widened type of some values, from what is in them all at once."""
    values = [v for v in values if v is not None]
    kinds = {type(v) for v in values}
    if not kinds:
        return "null"
    if kinds == {dict}:
        return {k: brute_type([v.get(k) for v in values]) for k in sorted({k for v in values for k in v})}
    if kinds == {list}:
        return [brute_type([x for v in values for x in v])]
    if kinds == {bool}:
        return "bool"
    if kinds <= {int, float}:
        return "int" if kinds == {int} and all(-(1 << 63) <= v < 1 << 63 for v in values) else "double"
    return "string"


def plain(kind):
    name = kind.typeName()
    if name == "struct":
        return {f.name: plain(f.dataType) for f in kind}
    if name == "array":
        return [plain(kind.elementType)]
    return {"void": "null", "boolean": "bool", "long": "int"}.get(name, name)


def test_types_of_documents_against_brute_force(spark):
    rng = np.random.default_rng(3)

    def value(depth):
        pick = rng.integers(0, 8 if depth < 3 else 6)
        return [None, True, int(rng.integers(-5, 5)), float(rng.random()), 1 << 65, "x", [value(depth + 1) for _ in range(rng.integers(0, 3))] if pick == 6 else None, {k: value(depth + 1) for k in "abc" if rng.random() < 0.6} if pick == 7 else None][pick]

    for _ in range(4):
        docs = [(f"f{k % 3}", {k: value(0) for k in "abcde" if rng.random() < 0.5}) for k in range(60)]
        rows = [(f, json.dumps(d)) for f, d in docs] + [("f0", None), ("f0", "{bad"), ("f1", "[1]"), ("f2", "7")]
        df = spark.createDataFrame(rows, "feed string, json string").repartition(7)
        got = {r.feed: plain(typed._read(r.type)) for r in typed.document_types(df).collect()}
        assert got == {f: brute_type([d for g, d in docs if g == f]) for f in ("f0", "f1", "f2")}


FEED = "getmeasuredweatherdata"


def docs_of(spark, *texts, feed=FEED):
    return spark.createDataFrame([(feed, f"d{k}", t) for k, t in enumerate(texts)], "feed string, doc_id string, json string")


def test_typed_view_values(spark):
    df = docs_of(spark, '{"a":1,"b":"x","c":[1,2],"d":{"e":true},"n":null}', '{"a":2.5,"b":7,"c":[1.5],"d":{"e":false,"f":"y"}}', '{"b":{"z":1},"c":null}', None, "{bad")
    view = typed.typed_view(df, "GetMeasuredWeatherData")
    kinds = {f.name: f.dataType.simpleString() for f in view.schema["doc"].dataType}
    assert kinds == {"a": "double", "b": "string", "c": "array<double>", "d": "struct<e:boolean,f:string>", "n": "string"}
    got = {r.doc_id: r for r in view.select("doc_id", "doc.a", "doc.b", "doc.c", "doc.d.e", "doc.d.f").collect()}
    assert tuple(got["d0"])[1:] == (1.0, "x", [1.0, 2.0], True, None) and tuple(got["d1"])[1:] == (2.5, "7", [1.5], False, "y")
    assert got["d2"].b == '{"z":1}' and got["d2"].c is None and got["d3"].a is None and got["d4"].a is None
    assert typed.typed_view(df.filter("false"), FEED).isEmpty()


def test_types_are_versioned(spark, tmp_path):
    """A new field or a wider one gives a new version; older files read with it, and newer ones with an older version."""
    root = str(tmp_path / "types")
    old, new = docs_of(spark, '{"a":1}', '{"a":2}'), docs_of(spark, '{"a":"x","b":2.5}')
    assert typed.known_types(spark, root) == {}
    for df in (old, old, new, old):
        typed.record_types(spark, root, df)
    first, last = typed.known_types(spark, root, 1)[FEED], typed.known_types(spark, root)[FEED]
    assert plain(first) == {"a": "int"} and plain(last) == {"a": "string", "b": "double"} and typed.known_types(spark, root, 2)[FEED] == last
    both = old.unionByName(new)
    assert [tuple(r) for r in typed.typed_view(both, FEED, last).select("doc.a", "doc.b").collect()] == [("1", None), ("2", None), ("x", 2.5)]
    assert [tuple(r) for r in typed.typed_view(old, FEED, first).select("doc.a").collect()] == [(1,), (2,)]
    typed.record_types(spark, root, docs_of(spark, '{"s":1}', feed="getsituation"))
    assert set(typed.known_types(spark, root)) == {FEED, "getsituation"}


def test_types_of_edges():
    assert isinstance(typed.type_of(1 << 63), DoubleType) and isinstance(typed.type_of(-(1 << 63)), LongType)
    assert typed.usable(typed.type_of({"a": {}, "b": [None], "c": []})) == StructType.fromDDL("a string, b array<string>, c array<string>") and isinstance(typed.widened(typed.type_of([1]), typed.type_of(1)), StringType)


def test_equal_positions_are_compared_once(spark):
    """Distances are reckoned for pairs of positions, before places and points that share them are joined with these."""
    points = spark.range(600).selectExpr("id as k", "cast(id % 2 as double) as lat", "0.5d as lon").withColumn("geohash", geohash(F.col("lat"), F.col("lon"), 11))
    places = spark.range(500).selectExpr("cast(id as string) as place_id", "cast(id % 5 as double) as lat", "0.5d as lon")
    near = geo.near_places(points, places, 1000.0)
    assert near.count() == 600 * 200 // 2
    assert {(r.lat, r.place_lat) for r in near.select("lat", "place_lat").distinct().collect()} == {(0.0, 0.0), (1.0, 1.0)}
    lines = near._jdf.queryExecution().optimizedPlan().toString().lower().split("\n")
    assert min(k for k, x in enumerate(lines) if "asin" in x) > min(k for k, x in enumerate(lines) if "join inner" in x and "geohash" in x)
