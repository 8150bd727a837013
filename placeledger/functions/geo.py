"""Longitude arithmetic, distances and a local metric projection as Columns."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from placeledger.fixed_values import (
    EARTH_RADIUS_METERS,
    GRID_SIZE_METERS,
    WGS84_ECC2,
    WGS84_SEMI_MAJOR,
)
from placeledger.functions.text import col, let


def _fixed5(x: Column) -> Column:
    """`x` with five decimals, rounded from its exact binary value.

    x * 1e5 is rounded itself, which only matters when the product lands on a half;
    there the product's exact rounding error (x split into two short halves, each
    multiplied without error) decides, and a true tie goes to the even digit.
    """
    def product(a: Column) -> Column:
        wide = a * F.lit(134217729.0)
        high = wide - (wide - a)
        return F.struct((a * F.lit(1e5)).alias("p"), high.alias("high"), (a - high).alias("low"))

    def units(s: Column) -> Column:
        error = (s["high"] * F.lit(1e5) - s["p"]) + s["low"] * F.lit(1e5)
        floor = F.floor(s["p"])
        half = s["p"] - floor == 0.5
        return (
            F.when(half & (error > 0), floor + 1)
            .when(half & (error < 0), floor)
            .otherwise(F.rint(s["p"]).cast("long"))
        )

    # Zero has a sign too, which no comparison sees.
    below_zero = (x == 0) & x.cast("string").startswith("-")

    def written(n: Column) -> Column:
        return F.concat(
            F.when((x < 0) | below_zero, "-").otherwise(""),
            F.floor(n / 100000).cast("string"),
            F.lit("."),
            F.lpad(F.pmod(n, F.lit(100000)).cast("string"), 5, "0"),
        )

    return let(let(let(F.abs(x), product), units), written)


def coordinate_key(lat: Column | str, lon: Column | str) -> Column:
    """`lat,lon` with five decimals; NULL when either is missing."""
    return F.concat(_fixed5(col(lat)), F.lit(","), _fixed5(col(lon)))


def normalize_longitude(lon: Column | str) -> Column:
    """Into [-180, 180]; an eastern input keeps +180."""
    lon = col(lon)
    wrapped = F.pmod(lon + 180, F.lit(360.0)) - 180
    return F.when((wrapped == -180) & (lon > 0), F.lit(180.0)).otherwise(wrapped)


def unwrap_longitude(lon: Column | str, reference: Column | str) -> Column:
    """Shift by whole turns to within 180 degrees of `reference`."""
    lon, reference = col(lon), col(reference)
    gap = lon - reference
    return (
        F.when(gap > 180, lon - F.lit(360.0) * F.ceil((gap - 180) / 360))
        .when(gap < -180, lon + F.lit(360.0) * F.ceil((-gap - 180) / 360))
        .otherwise(lon)
    )


def circular_mean(sin_sum: Column, cos_sum: Column) -> Column:
    """Mean direction in degrees from summed sines and cosines; 0 when they cancel."""
    cancelled = (F.abs(sin_sum) < 1e-12) & (F.abs(cos_sum) < 1e-12)
    return F.when(cancelled, F.lit(0.0)).otherwise(F.degrees(F.atan2(sin_sum, cos_sum)))


def distance_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Equirectangular distance in metres, scaled at the mean latitude."""
    north = F.radians(lat2 - lat1) * EARTH_RADIUS_METERS
    east = F.radians(lon2 - lon1) * EARTH_RADIUS_METERS * F.cos(F.radians((lat1 + lat2) / 2))
    return F.sqrt(north * north + east * east)


def cell_radius_m(cell_size: float = GRID_SIZE_METERS) -> int:
    """Radius of the circle around a square cell, rounded up to a metre."""
    return math.ceil(cell_size * math.sqrt(2) / 2)


def _centre(lon0: Column, lat0: Column) -> Column:
    """Projection centre: its sines and the ellipsoid's radii of curvature there, along
    the parallel and the meridian."""
    phi = F.radians(lat0)
    root = F.sqrt(1 - F.lit(WGS84_ECC2) * F.pow(F.sin(phi), F.lit(2.0)))
    return F.struct(
        lon0.alias("lon"), F.sin(phi).alias("sin"), F.cos(phi).alias("cos"),
        (F.lit(WGS84_SEMI_MAJOR) / root).alias("prime"),
        (F.lit(WGS84_SEMI_MAJOR * (1 - WGS84_ECC2)) / F.pow(root, F.lit(3.0))).alias("meridian"),
    )


def project_local(lon: Column, lat: Column, lon0: Column, lat0: Column) -> Column:
    """struct(x, y): azimuthal-equidistant metres around (lon0, lat0).

    Spherical formulas, with each axis scaled by the ellipsoid's radius of curvature
    at the centre. Against an ellipsoidal projection the distances near the centre
    agree, and drift by well under 0.5 % over a region of a few hundred kilometres.
    """
    def angles(o: Column) -> Column:
        phi, turn = F.radians(lat), F.radians(lon - o["lon"])
        return F.struct(
            o.alias("o"), F.sin(phi).alias("sin"), F.cos(phi).alias("cos"),
            F.sin(turn).alias("sin_turn"), F.cos(turn).alias("cos_turn"),
        )

    def arc(p: Column) -> Column:
        cosine = p["o"]["sin"] * p["sin"] + p["o"]["cos"] * p["cos"] * p["cos_turn"]
        return F.struct(p.alias("p"), F.acos(F.least(F.greatest(cosine, F.lit(-1.0)), F.lit(1.0))).alias("c"))

    def metres(q: Column) -> Column:
        p, o, c = q["p"], q["p"]["o"], q["c"]
        k = F.when(F.sin(c) < 1e-12, F.lit(1.0)).otherwise(c / F.sin(c))
        north = o["cos"] * p["sin"] - o["sin"] * p["cos"] * p["cos_turn"]
        return F.struct(
            (o["prime"] * k * p["cos"] * p["sin_turn"]).alias("x"), (o["meridian"] * k * north).alias("y")
        )

    return let(let(let(_centre(lon0, lat0), angles), arc), metres)


def unproject_local(x: Column, y: Column, lon0: Column, lat0: Column) -> Column:
    """Inverse of `project_local`: struct(lon, lat), longitude not yet normalised."""
    def scaled(o: Column) -> Column:
        return F.struct(o.alias("o"), (x / o["prime"]).alias("u"), (y / o["meridian"]).alias("v"))

    def arc(p: Column) -> Column:
        return F.struct(p.alias("p"), F.sqrt(p["u"] * p["u"] + p["v"] * p["v"]).alias("c"))

    def degrees(q: Column) -> Column:
        p, o, c = q["p"], q["p"]["o"], q["c"]
        k = F.when(c < 1e-15, F.lit(1.0)).otherwise(F.sin(c) / c)
        lat = F.asin(F.cos(c) * o["sin"] + p["v"] * k * o["cos"])
        turn = F.atan2(p["u"] * k, o["cos"] * F.cos(c) - p["v"] * k * o["sin"])
        return F.struct((o["lon"] + F.degrees(turn)).alias("lon"), F.degrees(lat).alias("lat"))

    return let(let(let(_centre(lon0, lat0), scaled), arc), degrees)
