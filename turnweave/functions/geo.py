"""Column builders: bindings, great-circle and planar measures, HEALPix pixels, line geometry.

Points are structs with ``lat`` and ``lon`` in degrees. Sums of floating-point numbers are folds over ordered
arrays, so that a result never depends on how rows were dealt out.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Radius of the sphere in km, HEALPix resolution.
EARTH_RADIUS_KM = 6370.986884258304
N_SIDE = 50
#: Fixed value, as in the SQL twins: a running planar length (degrees) has reached the half if it lacks no more than this.
HALF_TOLERANCE = 1e-13


def let(value: Column, body) -> Column:
    """Bind ``value`` once and use it in ``body``; an outer expression inside a lambda would be evaluated each time."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def deg_to_rad(deg: Column) -> Column:
    return deg * F.lit(math.pi / 180)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a, b = deg_to_rad(lat1), deg_to_rad(lat2)
    square = lambda x: F.pow(F.sin(x / 2), F.lit(2.0))
    h = square(b - a) + F.cos(a) * F.cos(b) * square(deg_to_rad(lon2) - deg_to_rad(lon1))
    return let(h, lambda h: F.atan2(F.sqrt(h), F.sqrt(1 - h)) * 2 * F.lit(EARTH_RADIUS_KM))


def healpix_ring(lat: Column, lon: Column, n_side: int = N_SIDE) -> Column:
    """RING pixel of a point (Gorski et al. 2005)."""
    n = n_side
    z = F.cos((F.lit(90.0) - lat) * F.lit(math.pi / 180))
    phi = deg_to_rad(lon)
    turn = F.lit(2 * math.pi)
    tt = (phi - turn * F.floor(phi / turn)) / F.lit(math.pi / 2)
    whole = lambda x: F.floor(x).cast("long")

    def belt(z: Column, tt: Column) -> Column:
        jp, jm = whole((tt + 0.5) * n - z * 0.75 * n), whole((tt + 0.5) * n + z * 0.75 * n)

        def pixel(s: Column) -> Column:
            ir = F.lit(n + 1) + s["jp"] - s["jm"]
            k = 1 - ir.bitwiseAND(F.lit(1).cast("long"))
            ip = F.pmod(F.shiftright(s["jp"] + s["jm"] - n + k + 1, 1), F.lit(4 * n).cast("long"))
            return F.lit(2 * n * (n - 1)) + (ir - 1) * (4 * n) + ip

        return let(F.struct(jp.alias("jp"), jm.alias("jm")), pixel)

    def cap(z: Column, tt: Column) -> Column:
        part = tt - F.floor(tt)
        tmp = F.sqrt((F.lit(1.0) - F.abs(z)) * 3) * n

        def pixel(ir: Column) -> Column:
            ip = F.pmod(whole(tt * ir), ir * 4)
            return F.when(z > 0, ir * (ir - 1) * 2 + ip).otherwise(F.lit(12 * n * n) - ir * (ir + 1) * 2 + ip)

        return let(whole(part * tmp) + whole((F.lit(1.0) - part) * tmp) + 1, pixel)

    return let(F.struct(z.alias("z"), tt.alias("tt")), lambda s: F.when(F.abs(s["z"]) <= 2.0 / 3.0, belt(s["z"], s["tt"])).otherwise(cap(s["z"], s["tt"])))


def _steps(line: Column, measure) -> Column:
    """``measure`` of each two neighbours of a line."""
    return F.when(F.size(line) > 1, F.zip_with(F.slice(line, F.lit(1), F.size(line) - 1), F.slice(line, F.lit(2), F.size(line) - 1), measure)).otherwise(F.array().cast("array<double>"))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def line_length_km(line: Column) -> Column:
    return _sum(_steps(line, lambda p, q: haversine_km(p["lat"], p["lon"], q["lat"], q["lon"])))


def planar_distance(p: Column, q: Column) -> Column:
    dx, dy = p["lon"] - q["lon"], p["lat"] - q["lat"]
    return F.sqrt(dx * dx + dy * dy)


def planar_length(line: Column) -> Column:
    return _sum(_steps(line, planar_distance))


def point_between(p: Column, q: Column, fraction: Column) -> Column:
    mix = lambda a, b: (F.lit(1.0) - fraction) * a + fraction * b
    return F.struct(mix(p["lat"], q["lat"]).alias("lat"), mix(p["lon"], q["lon"]).alias("lon"))


def _running(values: Column) -> Column:
    """Running sums, first to last."""
    return F.aggregate(values, F.array().cast("array<double>"), lambda a, x: F.concat(a, F.array(x + F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0.0)))))


def midpoint(line: Column) -> Column:
    """Struct ``idx, lat, lon``: the point at half the planar length and the index of the segment it lies on.

    That is the first segment at whose end the running length reaches the half. Where the half falls on a point of the
    line, the last bits of the sums don't decide: the segment that ends there is taken. A line without length has its
    first point, with index 0.
    """
    spot = lambda i, p: F.struct(i.cast("int").alias("idx"), p["lat"].alias("lat"), p["lon"].alias("lon"))
    first = F.get(line, F.lit(0))

    def halved(s: Column) -> Column:
        reached, half = s["reached"], F.element_at(s["reached"], -1) / 2

        def at(k: Column) -> Column:
            before = F.coalesce(F.get(reached, k - 1), F.lit(0.0))
            share = (half - before) / F.get(s["steps"], k)
            return let(point_between(F.get(line, k), F.get(line, k + 1), share), lambda p: spot(k, p))

        number = F.array_position(F.transform(reached, lambda x: x + HALF_TOLERANCE >= half), True).cast("int") - 1
        return F.when(F.coalesce(half, F.lit(0.0)) > HALF_TOLERANCE, let(number, at)).otherwise(spot(F.lit(0), first))

    return let(_steps(line, planar_distance), lambda d: let(F.struct(d.alias("steps"), _running(d).alias("reached")), halved))


def second_half(line: Column, middle: Column) -> Column:
    """From the midpoint to the end."""
    return F.concat(F.array(F.struct(middle["lat"].alias("lat"), middle["lon"].alias("lon"))), F.slice(line, middle["idx"] + 2, F.size(line)))


def first_half(line: Column, middle: Column) -> Column:
    """From the start to the midpoint."""
    return F.concat(F.slice(line, F.lit(1), middle["idx"] + 1), F.array(F.struct(middle["lat"].alias("lat"), middle["lon"].alias("lon"))))


@F.pandas_udf(StringType())
def fixed6(values: pd.Series) -> pd.Series:
    """Six decimals, rounded from the exact binary value (Spark's own formats round its decimal digits)."""
    return values.map(lambda v: None if v is None or v != v else "%.6f" % v)


@F.pandas_udf(StringType())
def point_texts(lons: pd.Series, lats: pd.Series) -> pd.Series:
    """``lon lat;lon lat`` with six decimals, from two arrays."""
    return pd.Series([";".join("%.6f %.6f" % p for p in zip(x, y, strict=True)) for x, y in zip(lons, lats, strict=True)], dtype=object)
