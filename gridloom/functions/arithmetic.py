"""Integer and coordinate arithmetic as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AXES = ("z", "y", "x")


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_div(c: str | Column, n: int) -> Column:
    """Quotient rounded down, exact for all 64-bit integers (`div` alone rounds towards zero)."""
    c = col(c).cast("long")
    return F.call_function("div", c - F.pmod(c, F.lit(n)), F.lit(n).cast("long"))


def block_id(z: str | Column, y: str | Column, x: str | Column, width: int = 64) -> Column:
    """One 64-bit number for the block of a coordinate: 21 bits for each axis, z in the highest."""
    parts = [floor_div(c, width).bitwiseAND((1 << 21) - 1) for c in (z, y, x)]
    return F.shiftleft(parts[0], 42).bitwiseOR(F.shiftleft(parts[1], 21)).bitwiseOR(parts[2])


def block_of_id(block: str | Column) -> list[Column]:
    """The block coordinates of a `block_id`, signs restored."""

    def signed(c: Column) -> Column:
        c = c.bitwiseAND((1 << 21) - 1)
        return F.when(c >= 1 << 20, c - (1 << 21)).otherwise(c)

    return [signed(F.shiftright(col(block), s)).alias(a) for s, a in zip((42, 21, 0), AXES, strict=True)]


def default_entries(values: list[int], defaults: list[int], marker: int = -1) -> list[int]:
    """Entries equal to the marker give way to the default at their place."""
    return [d if v == marker else v for v, d in zip(values, defaults, strict=True)]
