"""Coordinates, scalars and geohashes, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space and digits are ASCII, here and in the document form.
_WHITE = r"[ \t\n\x0B\f\r]*"
_NUMBER = rf"\A{_WHITE}[+-]?([0-9][0-9,]*\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?{_WHITE}\z"
_INTEGER = rf"\A{_WHITE}[+-]?[0-9]+{_WHITE}\z"


def _stripped(text: Column) -> Column:
    return F.regexp_replace(text, rf"\A{_WHITE}|{_WHITE}\z", "")


#: Fixed value: the letters of geohashes, in order.
ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"


def parse_coordinates(text: Column) -> Column:
    """Pairs of numbers of a text split at space, comma, semicolon and line ends; null where a token is no number or beyond a double."""
    tokens = F.filter(F.split(text, "[ ,;\\r\\n]"), lambda t: F.trim(t) != "")
    numbers = F.transform(tokens, lambda t: F.when(t.rlike(_NUMBER), t.try_cast("double")))
    numbers = F.transform(numbers, lambda x: F.when(F.abs(x) < F.lit(float("inf")), x))
    pairs = F.floor(F.size(numbers) / 2).cast("int")
    made = F.transform(F.sequence(F.lit(1), F.greatest(pairs, F.lit(1))), lambda i: F.array(F.get(numbers, 2 * i - 2), F.get(numbers, 2 * i - 1)))
    good = ~F.exists(numbers, lambda x: x.isNull())
    return F.when(text.isNotNull() & good, F.when(pairs >= 1, made).otherwise(F.array().cast("array<array<double>>")))


def infer_scalar(text: Column) -> Column:
    """struct(kind, b, l, d, s): truth value, 64-bit integer, double, or else the text."""
    bare = _stripped(text)
    low = F.translate(bare, "TRUEFALS", "truefals")
    whole = F.when(text.rlike(_INTEGER), bare.try_cast("bigint"))
    number = F.when(text.rlike(_NUMBER), F.regexp_replace(bare, ",", "").try_cast("double"))
    number = F.when(F.abs(number) < F.lit(float("inf")), number)
    kind = F.when(text.isNull(), "null").when(low.isin("true", "false"), "bool").when(whole.isNotNull(), "int").when(number.isNotNull(), "double").otherwise("string")
    only = lambda name, value: F.when(kind == name, value)
    return F.struct(kind.alias("kind"), only("bool", low == "true").alias("b"), only("int", whole).alias("l"), only("double", number).alias("d"), only("string", text).alias("s"))


def geohash(lat: Column, lon: Column, length: int = 11) -> Column:
    """Base-32 cell of a point, by interleaving the bits of longitude and latitude; null outside the globe."""
    bits = 5 * length
    n_lon, n_lat = (bits + 1) // 2, bits // 2
    cell = lambda v, low, span, n: F.least(F.floor((v - low) / span * F.lit(float(1 << n))), F.lit((1 << n) - 1)).cast("bigint")
    x, y = cell(lon, -180.0, 360.0, n_lon), cell(lat, -90.0, 180.0, n_lat)

    def bit(k: int) -> Column:
        value, n = (x, n_lon) if k % 2 == 0 else (y, n_lat)
        return F.shiftright(value, n - 1 - k // 2).bitwiseAND(F.lit(1))

    letters = [F.substring(F.lit(ALPHABET), sum((bit(5 * c + j) * (16 >> j) for j in range(5)), F.lit(1)).cast("int"), F.lit(1)) for c in range(length)]
    return F.when(lat.between(-90, 90) & lon.between(-180, 180), F.concat(*letters))
