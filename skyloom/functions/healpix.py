"""The nested HEALPix index of a position (Gorski et al. 2005) as a Catalyst expression."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _spread(c: Column, order: int) -> Column:
    """The bits of ``c`` moved to the even places."""
    out = F.lit(0).cast("long")
    for k in range(order):
        bit = F.shiftright(c, k).bitwiseAND(F.lit(1).cast("long"))
        out = out.bitwiseOR(F.shiftleft(bit, 2 * k))
    return out


def pixel(ra: Column, dec: Column, order: int) -> Column:
    """The pixel of order 0 to 29 that holds a position in degrees; null for missing positions."""
    side = 1 << order
    z, phi = F.sin(F.radians(dec)), F.pmod(ra, F.lit(360.0)) / 90.0
    mask = F.lit(side - 1).cast("long")
    # The belt about the equator.
    up, down = F.floor(side * (phi + 0.5) - side * 0.75 * z), F.floor(side * (phi + 0.5) + side * 0.75 * z)
    fu, fd = F.shiftright(up, order), F.shiftright(down, order)
    belt = F.when(fu == fd, F.pmod(fu, F.lit(4)) + 4).when(fu < fd, fu).otherwise(fd + 8)
    bx, by = down.bitwiseAND(mask), F.lit(side - 1) - up.bitwiseAND(mask)
    # The caps about the poles.
    quarter = F.least(F.floor(phi), F.lit(3))
    part = phi - quarter
    width = side * F.sqrt(3 * (1 - F.abs(z)))
    inner, outer = F.least(F.floor(part * width), mask), F.least(F.floor((1 - part) * width), mask)
    north = z > 0
    cap = F.when(north, quarter).otherwise(quarter + 8)
    cx, cy = F.when(north, side - 1 - outer).otherwise(inner), F.when(north, side - 1 - inner).otherwise(outer)
    belted = F.abs(z) <= 2.0 / 3.0
    face = F.when(belted, belt).otherwise(cap).cast("long")
    x, y = F.when(belted, bx).otherwise(cx).cast("long"), F.when(belted, by).otherwise(cy).cast("long")
    return F.shiftleft(face, 2 * order) + _spread(x, order) + F.shiftleft(_spread(y, order), 1)


def order_for(rows: int, most: int) -> int:
    """The lowest order at which pixels hold ``most`` rows on average, 12 at most."""
    return min(12, max(0, math.ceil(math.log(max(1.0, rows / (12 * most)), 4))))
