"""Positions in the order of a space-filling curve, so that a radius reads few row groups.

A cell is the position's place on the Z-order curve over the globe: bits of latitude and
longitude in turn. Rows near each other are mostly near on the curve; files sorted by it have
row groups of small areas. A circle becomes a few ranges of cells, a filter that Parquet's
statistics can refuse row groups by; the distance decides in the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citysignal import config as C
from citysignal.functions import geo
from citysignal.operators import search

# Bits of either coordinate: cells of some 600 by 300 metres at the equator.
BITS = 16
# A circle is covered by at most about this many ranges.
RANGES = 24
CELL = "cell"
# Fixed steps that spread sixteen bits over thirty-two: shift, then keep.
_SPREAD = ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555))


def _step(value: Column, low: float, high: float) -> Column:
    """The coordinate as a whole number of cell widths."""
    share = (value - F.lit(low)) / F.lit(high - low)
    whole = F.floor(share * (1 << BITS))
    return F.least(F.greatest(whole, F.lit(0)), F.lit((1 << BITS) - 1)).cast("bigint")


def _spread(bits: Column) -> Column:
    for shift, mask in _SPREAD:
        bits = bits.bitwiseOR(F.shiftleft(bits, shift)).bitwiseAND(F.lit(mask))
    return bits


def cell(lat: Column, lon: Column) -> Column:
    """Place on the curve, null for a missing coordinate."""
    south, west = _spread(_step(lat, -90.0, 90.0)), _spread(_step(lon, -180.0, 180.0))
    return F.shiftleft(south, 1).bitwiseOR(west)


def ranges_of(box: tuple[float, float, float, float], limit: int = RANGES) -> list[tuple[int, int]]:
    """Ranges of cells that cover ``(south, north, west, east)``.

    Quarters of the globe are divided while they stick out of the box, the largest first, as long as the number
    of ranges allows; what is left over the edge is for the distance to refuse.
    """
    south, north, west, east = box

    def bounds(level: int, row: int, column: int) -> tuple[float, float, float, float]:
        high, wide = 180.0 / (1 << level), 360.0 / (1 << level)
        return -90 + row * high, -90 + (row + 1) * high, -180 + column * wide, -180 + (column + 1) * wide

    def code(level: int, row: int, column: int) -> int:
        place = 0
        for bit in range(level):
            place |= ((row >> bit & 1) << (2 * bit + 1)) | ((column >> bit & 1) << (2 * bit))
        return place << 2 * (BITS - level)

    inside, edge = [], [(0, 0, 0)]
    while edge and len(inside) + len(edge) + 3 <= limit * 2:
        level, row, column = min(edge)
        if level == BITS:
            break
        edge.remove((level, row, column))
        for down in (0, 1):
            for right in (0, 1):
                part = (level + 1, 2 * row + down, 2 * column + right)
                s, n, w, e = bounds(*part)
                if n < south or s > north or e < west or w > east:
                    continue
                whole = s >= south and n <= north and w >= west and e <= east
                (inside if whole else edge).append(part)
    spans = sorted((code(*part), code(*part) + (1 << 2 * (BITS - part[0])) - 1) for part in inside + edge)
    merged: list[tuple[int, int]] = []
    for first, last in spans:
        if merged and first <= merged[-1][1] + 1:
            merged[-1] = (merged[-1][0], max(last, merged[-1][1]))
        else:
            merged.append((first, last))
    return merged


def ordered(rows: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Rows with their cell, in files of neighbouring cells; a crowded cell spans several."""
    placed = rows.withColumn(CELL, cell(F.col(lat), F.col(lon)))
    salt = F.xxhash64(*rows.columns)
    return placed.repartitionByRange(CELL, salt).sortWithinPartitions(CELL)


def write(rows: DataFrame, path: str, *, row_group_bytes: int | None = None, **columns) -> None:
    writer = ordered(rows, **columns).write.mode("errorifexists")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)


def in_cells(
    rows: DataFrame,
    centre: tuple[float, float] = C.SEARCH_CENTRE,
    radius_km: float = C.SEARCH_RADIUS_KM,
) -> Column:
    """Test on the stored cell that every row within the radius passes."""
    test = F.lit(False)
    for first, last in ranges_of(geo.bounding_box(*centre, radius_km)):
        test = test | F.col(CELL).between(first, last)
    return test


def within_radius(
    rows: DataFrame,
    centre: tuple[float, float] = C.SEARCH_CENTRE,
    radius_km: float = C.SEARCH_RADIUS_KM,
    **columns,
) -> DataFrame:
    """``search.within_radius`` over rows that have their cell."""
    return search.within_radius(rows.filter(in_cells(rows, centre, radius_km)), centre, radius_km, **columns)
