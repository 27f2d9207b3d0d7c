"""Coordinates: canonical grid values, their keys, and the national grid to longitude and latitude in closed form."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.functions.keys import stable_sha256

#: Ellipsoids, the grid's projection, and the seven parameters of the datum shift.
AIRY = (6377563.396, 6356256.909)
WGS84 = (6378137.0, 6356752.314245)
SCALE, LAT0, LON0, EAST0, NORTH0 = 0.9996012717, math.radians(49), math.radians(-2), 400000.0, -100000.0
SHIFT, TURN, PPM = (446.448, -125.157, 542.060), (0.1502, 0.2470, 0.8421), -20.4894
#: Bounds of results taken as within the country.
LON_BOUNDS, LAT_BOUNDS = (-9.5, 2.5), (49.0, 61.5)


def canonical(value: Column) -> Column:
    """A grid value at the scale that keys use."""
    return F.round(value, 3).cast("decimal(12,3)")


def coordinate_key(namespace: str, version: str, easting: Column, northing: Column, *contract: str) -> Column:
    return stable_sha256(namespace, version, *(F.lit(x) for x in contract), canonical(easting), canonical(northing))


def with_lonlat(df: DataFrame, easting: Column, northing: Column, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """df with longitude and latitude (WGS84 degrees) of a grid point, in Column arithmetic.

    Each step is a projection of its own, as one expression would repeat its parts without end.
    """
    c, kept = F.col, df.columns
    a, b = AIRY
    e2 = 1 - (b * b) / (a * a)
    per_radian = 1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256
    arc = LAT0 - ((3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * math.sin(2 * LAT0) - (15 * e2**2 / 256 + 45 * e2**3 / 1024) * math.sin(4 * LAT0) + 35 * e2**3 / 3072 * math.sin(6 * LAT0)) / per_radian
    k = (1 - math.sqrt(1 - e2)) / (1 + math.sqrt(1 - e2))
    df = df.withColumns({"__d": easting - EAST0, "__mu": (northing - NORTH0) / (a * SCALE * per_radian) + arc})
    mu = c("__mu")
    df = df.withColumn("__f", mu + (1.5 * k - 27 / 32 * k**3) * F.sin(2 * mu) + (21 / 16 * k**2 - 55 / 32 * k**4) * F.sin(4 * mu) + 151 / 96 * k**3 * F.sin(6 * mu) + 1097 / 512 * k**4 * F.sin(8 * mu))
    df = df.withColumns({"__w": 1 - e2 * F.pow(F.sin("__f"), 2), "__t": F.tan("__f"), "__sec": 1 / F.cos("__f")})
    df = df.withColumns({"__nu": a * SCALE / F.sqrt("__w"), "__q": c("__w") / (1 - e2), "__t2": c("__t") * c("__t")})
    df = df.withColumn("__x", c("__d") / c("__nu"))  # q is nu / rho
    x2, t, t2, q = F.pow("__x", 2), c("__t"), c("__t2"), c("__q")
    phi = c("__f") - t * q * x2 / 2 * (1 - x2 / 12 * (5 + 3 * t2 + (q - 1) * (1 - 9 * t2)) + x2 * x2 / 360 * (61 + 90 * t2 + 45 * t2 * t2))
    lam = LON0 + c("__sec") * c("__x") * (1 - x2 / 6 * (q + 2 * t2) + x2 * x2 / 120 * (5 + 28 * t2 + 24 * t2 * t2) - x2 * x2 * x2 / 5040 * (61 + 662 * t2 + 1320 * t2 * t2 + 720 * t2 * t2 * t2))
    df = df.withColumns({"__phi": phi, "__lam": lam})
    df = df.withColumn("__r", a / F.sqrt(1 - e2 * F.pow(F.sin("__phi"), 2)))
    df = df.withColumns({"__u": c("__r") * F.cos("__phi") * F.cos("__lam"), "__v": c("__r") * F.cos("__phi") * F.sin("__lam"), "__z": c("__r") * (1 - e2) * F.sin("__phi")})
    rx, ry, rz = (math.radians(v / 3600) for v in TURN)
    m, u, v, z = 1 + PPM * 1e-6, c("__u"), c("__v"), c("__z")
    df = df.withColumns({"__u2": SHIFT[0] + m * u - rz * v + ry * z, "__v2": SHIFT[1] + rz * u + m * v - rx * z, "__z2": SHIFT[2] - ry * u + rx * v + m * z})
    a, b = WGS84
    e2 = 1 - (b * b) / (a * a)
    df = df.withColumn("__p", F.sqrt(c("__u2") * c("__u2") + c("__v2") * c("__v2"))).withColumn("__h", F.atan2(c("__z2") * a, c("__p") * b))
    up = F.atan2(c("__z2") + e2 / (1 - e2) * b * F.pow(F.sin("__h"), 3), c("__p") - e2 * a * F.pow(F.cos("__h"), 3))
    return df.select(*(F.col(f"`{n}`") for n in kept), F.degrees(F.atan2(c("__v2"), c("__u2"))).alias(lon), F.degrees(up).alias(lat))


def bounds_status(lon: Column, lat: Column) -> Column:
    return F.when(lon.isNull() | lat.isNull(), "MISSING").when(lon.between(*LON_BOUNDS) & lat.between(*LAT_BOUNDS), "WITHIN").otherwise("OUT_OF_BOUNDS")
