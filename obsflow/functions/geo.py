"""Spherical Mercator on the map plane (y grows downwards)."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c) if isinstance(c, str) else F.lit(float(c))


def mercator_x(lon, scale=1.0, tx=0.0) -> Column:
    return _col(scale) * F.radians(_col(lon)) + _col(tx)


def mercator_y(lat, scale=1.0, ty=0.0) -> Column:
    return _col(ty) - _col(scale) * F.ln(F.tan(F.lit(math.pi / 4) + F.radians(_col(lat)) / 2))


def fit_scale(min_x, min_y, max_x, max_y, width, height, pad) -> Column:
    """Largest scale at which the bounds fill at most ``pad`` of the width and of the height.

    A side of no extent leaves the scale to the other; a single point gets scale 1.
    """
    across = F.try_divide(F.lit(float(pad)), (_col(max_x) - _col(min_x)) / F.lit(float(width)))
    down = F.try_divide(F.lit(float(pad)), (_col(max_y) - _col(min_y)) / F.lit(float(height)))
    known = _col(min_x).isNotNull()
    return F.coalesce(F.least(across, down), F.when(known, F.lit(1.0)))


def centre_offset(low, high, scale, size) -> Column:
    return (F.lit(float(size)) - _col(scale) * (_col(low) + _col(high))) / 2
