"""Longitude / latitude to the British national grid in metres.

A stage maps named values to named values, so that intermediate results are computed
once: as columns of successive projections for points (compiled code), or as structs in
an array for the nodes of a way.
"""

import math

from pyspark.sql import Column, DataFrame, functions as F

from areastats import constants as C

_ARC = math.radians(1 / 3600)


def _stage(points: Column, step) -> Column:
    return F.transform(points, lambda p: F.struct(*[v.alias(k) for k, v in step(p).items()]))


def _cartesian(p):
    e2 = 1 - (C.WGS84_B / C.WGS84_A) ** 2
    lat, lon = F.radians(p["lat"]), F.radians(p["lon"])
    nu = F.lit(C.WGS84_A) / F.sqrt(1 - F.lit(e2) * F.pow(F.sin(lat), 2))
    return {
        "x": nu * F.cos(lat) * F.cos(lon),
        "y": nu * F.cos(lat) * F.sin(lon),
        "z": nu * (1 - e2) * F.sin(lat),
    }


def _shift(p):
    s = 1 + C.SHIFT_SCALE_PPM * 1e-6
    rx, ry, rz = C.SHIFT_RX_SEC * _ARC, C.SHIFT_RY_SEC * _ARC, C.SHIFT_RZ_SEC * _ARC
    x, y, z = p["x"], p["y"], p["z"]
    return {
        "x": F.lit(C.SHIFT_TX) + x * s - y * rz + z * ry,
        "y": F.lit(C.SHIFT_TY) + x * rz + y * s - z * rx,
        "z": F.lit(C.SHIFT_TZ) - x * ry + y * rx + z * s,
    }


def _geodetic_angle(p):
    flat = F.sqrt(p["x"] * p["x"] + p["y"] * p["y"])
    return {
        "flat": flat,
        "z": p["z"],
        "lon": F.atan2(p["y"], p["x"]),
        "theta": F.atan2(p["z"] * C.AIRY_A, flat * C.AIRY_B),
    }


def _geodetic(p):
    """Closed-form latitude on the Airy ellipsoid (Bowring)."""
    e2 = 1 - (C.AIRY_B / C.AIRY_A) ** 2
    second = (C.AIRY_A / C.AIRY_B) ** 2 - 1
    up = p["z"] + F.pow(F.sin(p["theta"]), 3) * (second * C.AIRY_B)
    out = p["flat"] - F.pow(F.cos(p["theta"]), 3) * (e2 * C.AIRY_A)
    return {"lat": F.atan2(up, out), "lon": p["lon"]}


def _series_terms(p):
    e2 = 1 - (C.AIRY_B / C.AIRY_A) ** 2
    lat0 = math.radians(C.GRID_LAT0_DEG)
    n = (C.AIRY_A - C.AIRY_B) / (C.AIRY_A + C.AIRY_B)
    lat = p["lat"]
    sin2 = F.pow(F.sin(lat), 2)
    nu = F.lit(C.AIRY_A * C.GRID_F0) / F.sqrt(1 - F.lit(e2) * sin2)
    rho = F.lit(C.AIRY_A * C.GRID_F0 * (1 - e2)) / F.pow(1 - F.lit(e2) * sin2, 1.5)
    d, s = lat - lat0, lat + lat0
    arc = (
        d * (1 + n + 1.25 * n**2 + 1.25 * n**3)
        - F.sin(d) * F.cos(s) * (3 * n + 3 * n**2 + 2.625 * n**3)
        + F.sin(d * 2) * F.cos(s * 2) * (1.875 * n**2 + 1.875 * n**3)
        - F.sin(d * 3) * F.cos(s * 3) * (35 / 24 * n**3)
    ) * (C.AIRY_B * C.GRID_F0)
    return {
        "c": F.cos(lat),
        "sc": F.sin(lat) * F.cos(lat),
        "t2": F.pow(F.tan(lat), 2),
        "nu": nu,
        "ratio": nu / rho,
        "arc": arc,
        "dl": p["lon"] - math.radians(C.GRID_LON0_DEG),
    }


def _grid(p):
    """Transverse Mercator series in powers of dl * cos(lat)."""
    w2 = p["dl"] * p["dl"] * p["c"] * p["c"]
    t2, ratio, eta2 = p["t2"], p["ratio"], p["ratio"] - 1
    north = (
        F.lit(0.5)
        + w2 / 24 * (5 - t2 + eta2 * 9)
        + w2 * w2 / 720 * (61 - t2 * 58 + t2 * t2)
    )
    east = (
        F.lit(1.0)
        + w2 / 6 * (ratio - t2)
        + w2 * w2 / 120 * (5 - t2 * 18 + t2 * t2 + eta2 * 14 - t2 * eta2 * 58)
    )
    return {
        "x": F.lit(C.GRID_E0) + p["nu"] * p["c"] * p["dl"] * east,
        "y": F.lit(C.GRID_N0) + p["arc"] + p["nu"] * p["sc"] * p["dl"] * p["dl"] * north,
    }


def airy_to_grid_array(points: Column) -> Column:
    """array<struct<lon,lat>> in radians on the Airy ellipsoid -> array<struct<x,y>>."""
    return _stage(_stage(points, _series_terms), _grid)


_STEPS = (_cartesian, _shift, _geodetic_angle, _geodetic, _series_terms, _grid)


def lonlat_to_grid_array(points: Column) -> Column:
    """array<struct<lon,lat>> in WGS84 degrees -> array<struct<x,y>> in metres."""
    for step in _STEPS:
        points = _stage(points, step)
    return points


def add_grid(df: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Adds x and y in metres for columns in WGS84 degrees."""
    kept = df.columns
    values = {"lon": F.col(lon), "lat": F.col(lat)}
    for step in _STEPS:
        staged = step(values)
        df = df.select(*kept, *[v.alias(f"_{k}") for k, v in staged.items()])
        values = {k: F.col(f"_{k}") for k in staged}
    return df.select(*kept, *[v.alias(k) for k, v in values.items()])
