"""Position and depth transforms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def depth_log(depth: Column) -> Column:
    """ln(1 + depth): flattens the long tail of deep events."""
    return F.log1p(depth)


def unit_sphere(latitude: Column, longitude: Column, radius: float = 1.0) -> dict[str, Column]:
    """Cartesian x, y, z of a position; no seam at longitude 180."""
    phi, lam = F.radians(latitude), F.radians(longitude)
    axes = {
        "x": F.cos(phi) * F.cos(lam),
        "y": F.cos(phi) * F.sin(lam),
        "z": F.sin(phi),
    }
    return axes if radius == 1.0 else {name: axis * radius for name, axis in axes.items()}


def marker_radius(mag: Column) -> Column:
    """Size of a map marker, growing with magnitude from a visible minimum."""
    return F.greatest(F.lit(2.5), mag * 0.7)
