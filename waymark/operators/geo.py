"""Points of documents for geographic search."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.functions.values import ALPHABET, geohash

_SITE = "measurementSiteLocation.pointByCoordinates.pointCoordinates"
_SITUATION = "groupOfLocations.locationForDisplay"


def geo_index(docs: DataFrame, length: int = 11) -> DataFrame:
    """feed, doc_id, path, lat, lon, geohash of each point at the two indexed paths; groupOfLocations may be one or many."""
    point = lambda v: F.from_json(v, "lat double, lon double")
    site = F.get_json_object("json", f"$.{_SITE}")
    groups = F.get_json_object("json", "$.groupOfLocations")
    many = F.when(F.substring(groups, 1, 1) == "[", F.from_json(groups, "array<struct<locationForDisplay: string>>")).otherwise(F.array(F.from_json(groups, "locationForDisplay string")))
    found: Column = F.concat(
        F.when(site.isNotNull(), F.array(F.struct(F.lit(_SITE).alias("path"), site.alias("p")))).otherwise(F.array().cast("array<struct<path: string, p: string>>")),
        F.when(groups.isNotNull(), F.transform(many, lambda g: F.struct(F.lit(_SITUATION).alias("path"), g["locationForDisplay"].alias("p")))).otherwise(F.array().cast("array<struct<path: string, p: string>>")),
    )
    rows = docs.select("feed", "doc_id", F.explode(found).alias("f")).select("feed", "doc_id", "f.path", point(F.col("f.p")).alias("p")).select("feed", "doc_id", "path", "p.lat", "p.lon")
    return rows.filter("lat is not null and lon is not null").withColumn("geohash", geohash(F.col("lat"), F.col("lon"), length))


EARTH = 6371008.8  # mean radius in metres
_CELLS = 64
_FINEST = 8


def distance(lat: Column, lon: Column, lat2: Column, lon2: Column) -> Column:
    """Metres along the sphere between two points in degrees."""
    a = F.sin(F.radians(lat2 - lat) / 2) ** 2 + F.cos(F.radians(lat)) * F.cos(F.radians(lat2)) * F.sin(F.radians(lon2 - lon) / 2) ** 2
    return 2 * EARTH * F.asin(F.least(F.sqrt(a), F.lit(1.0)))


def boxes(lat: float, lon: float, metres: float) -> list[tuple[float, float, float, float]]:
    """(south, west, north, east) of one or two boxes that hold all points so near to one; none of them crosses 180 degrees.

    A circle that holds a pole goes all around.
    """
    turn = metres / EARTH * (1 + 1e-9)
    south, north = lat - math.degrees(turn) - 1e-9, lat + math.degrees(turn) + 1e-9
    if south <= -90 or north >= 90:
        return [(max(south, -90.0), -180.0, min(north, 90.0), 180.0)]
    half = math.degrees(math.asin(min(1.0, math.sin(turn) / math.cos(math.radians(lat))))) + 1e-9
    return split_box(south, lon - half, north, lon + half)


def split_box(south: float, west: float, north: float, east: float) -> list[tuple[float, float, float, float]]:
    """The box in parts within -180 .. 180. Where west is beyond east it crosses 180 degrees."""
    if east < west:
        east += 360
    if east - west >= 360:
        return [(south, -180.0, north, 180.0)]
    west, east = (x - 360 * math.floor((west + 180) / 360) for x in (west, east))
    if east <= 180:
        # 180 and -180 degrees are one line, and a point on it may be written either way.
        return [(south, west, north, east)] + ([(south, -180.0, north, -180.0)] if east == 180 else []) + ([(south, 180.0, north, 180.0)] if west == -180 else [])
    return [(south, west, north, 180.0), (south, -180.0, north, east - 360)]


def _code(x: int, y: int, length: int) -> str:
    bits = 5 * length
    n_lon, n_lat = (bits + 1) // 2, bits // 2
    value = 0
    for k in range(bits):
        bit = x >> (n_lon - 1 - k // 2) if k % 2 == 0 else y >> (n_lat - 1 - k // 2)
        value = value << 1 | bit & 1
    return "".join(ALPHABET[value >> 5 * (length - 1 - c) & 31] for c in range(length))


def cover(parts: list[tuple[float, float, float, float]], most: int = _CELLS) -> list[str]:
    """Cells of one length, the finest with at most so many, that together hold the boxes; in order."""
    for length in range(_FINEST, 0, -1):
        n_lon, n_lat = (5 * length + 1) // 2, 5 * length // 2
        at = lambda v, low, span, n: min(max(math.floor((v - low) / span * (1 << n)), 0), (1 << n) - 1)
        spans = [(at(w, -180, 360, n_lon), at(e, -180, 360, n_lon), at(s, -90, 180, n_lat), at(n, -90, 180, n_lat)) for s, w, n, e in parts]
        if sum((x1 - x0 + 1) * (y1 - y0 + 1) for x0, x1, y0, y1 in spans) <= most or length == 1:
            return sorted({_code(x, y, length) for x0, x1, y0, y1 in spans for x in range(x0, x1 + 1) for y in range(y0, y1 + 1)})
    return []


def ranges(cells: list[str]) -> list[tuple[str, str]]:
    """[from, to) of geohashes in these cells, neighbours in order joined."""
    number = lambda c: functools.reduce(lambda n, a: n * 32 + ALPHABET.index(a), c, 0)
    out: list[list] = []
    for c in cells:
        if out and out[-1][2] + 1 == number(c):
            out[-1][1:] = [c + "~", number(c)]
        else:
            out.append([c, c + "~", number(c)])
    return [(a, b) for a, b, _ in out]


def _in_cells(parts: list[tuple[float, float, float, float]]) -> Column:
    """Key ranges of the cover, which a store sorted by geohash can skip by."""
    found = [(F.col("geohash") >= a) & (F.col("geohash") < b) for a, b in ranges(cover(parts))]
    return functools.reduce(lambda a, b: a | b, found)


def within_box(points: DataFrame, south: float, west: float, north: float, east: float) -> DataFrame:
    """Points (lat, lon, geohash) in a box, its edges included. Where west is beyond east it crosses 180 degrees."""
    parts = split_box(south, west, north, east)
    exact = [F.col("lat").between(s, n) & F.col("lon").between(w, e) for s, w, n, e in parts]
    return points.filter(_in_cells(parts) & functools.reduce(lambda a, b: a | b, exact))


def within_radius(points: DataFrame, lat: float, lon: float, metres: float) -> DataFrame:
    """Points (lat, lon, geohash) at most so far from one, with their distance; over 180 degrees and the poles as well."""
    far = distance(F.lit(lat), F.lit(lon), F.col("lat"), F.col("lon"))
    return points.filter(_in_cells(boxes(lat, lon, metres))).withColumn("distance", far).filter(F.col("distance") <= metres)


def near_places(points: DataFrame, places: DataFrame, metres: float, most: int = 16) -> DataFrame:
    """place_id, place_lat, place_lon, distance and the columns of points of all that are at most so far from a place.

    places: place_id, lat, lon. Each place gives the cells of its cover, each point its cell at the lengths in use (eight at
    most): an equi-join on cells, then exact distances. Null places and places outside the globe have none. Positions are
    compared once, however many places or points share them, and the pairs found are then joined with these.
    """

    def covers(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [(lat, lon, len(c), c) for lat, lon in f.itertuples(index=False) for c in cover(boxes(lat, lon, metres), most)]
            yield pd.DataFrame(rows, columns=["place_lat", "place_lon", "size", "cell"])

    sound = places.filter(F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180)).select(F.col("place_id").cast("string"), F.col("lat").cast("double").alias("place_lat"), F.col("lon").cast("double").alias("place_lon"))
    cells = sound.select("place_lat", "place_lon").distinct().mapInPandas(covers, "place_lat double, place_lon double, size int, cell string")
    spots = points.select("lat", "lon", "geohash").distinct()
    sized = spots.withColumn("size", F.explode(F.sequence(F.lit(1), F.lit(_FINEST)))).withColumn("cell", F.expr("substring(geohash, 1, size)"))
    used = cells.select("size").distinct()  # eight rows at most
    met = sized.join(F.broadcast(used), "size", "left_semi").join(cells, ["size", "cell"]).drop("size", "cell")
    far = distance(F.col("place_lat"), F.col("place_lon"), F.col("lat"), F.col("lon"))
    near = met.withColumn("distance", far).filter(F.col("distance") <= metres)
    # Places first: rows of the result are made by the last join and not shuffled any more.
    return points.join(near.join(sound, ["place_lat", "place_lon"]), ["lat", "lon", "geohash"]).select("place_id", "place_lat", "place_lon", *points.columns, "distance")
