"""Hilbert index of a position inside a box, as a fully code-generated expression.

The order-16 curve is walked four bits at a time through a lookup table, so the whole index is four nested array
lookups on integers: no UDF and no interpreted higher-order function.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

ORDER = 16
_STEP = 4  # bits of x and of y consumed per lookup


def _quadrant(state: tuple[bool, bool], bx: int, by: int) -> tuple[int, tuple[bool, bool]]:
    """One level of the curve: digit of the quadrant and the orientation inside it.

    The orientation is (swap axes, mirror both axes), applied to the coordinate bits of the level.
    """
    swap, mirror = state
    x, y = (bx ^ mirror, by ^ mirror)
    if swap:
        x, y = y, x
    digit = (3 * x) ^ y
    if y == 0:
        # The quadrants at both ends of the curve run along the other axis, the last one also reversed.
        return digit, (not swap, mirror ^ (x == 1))
    return digit, state


@cache
def _table() -> tuple[int, ...]:
    """entry[state * 256 + xbits * 16 + ybits] = digits * 4 + next state, generated from the one-level rule."""
    states = [(False, False), (False, True), (True, False), (True, True)]
    out = []
    for start in states:
        for xb in range(1 << _STEP):
            for yb in range(1 << _STEP):
                state, digits = start, 0
                for bit in range(_STEP - 1, -1, -1):
                    digit, state = _quadrant(state, (xb >> bit) & 1, (yb >> bit) & 1)
                    digits = digits * 4 + digit
                out.append(digits * 4 + states.index(state))
    return tuple(out)


def grid_position(value: Column, low: Column, high: Column) -> Column:
    """Cell 0..65535 of a coordinate inside [low, high]; outside values go to the border cells."""
    top = float((1 << ORDER) - 1)
    span = F.when(high > low, high - low).otherwise(F.lit(1.0))
    scaled = F.floor((value - low) / span * F.lit(top))
    return F.least(F.greatest(scaled, F.lit(0)), F.lit(int(top))).cast("int")


def hilbert_of_cell(gx: Column, gy: Column) -> Column:
    """Index along the order-16 curve of integer cells (bigint in 0 .. 2^32-1)."""
    table = F.array(*[F.lit(v) for v in _table()])
    state: Column = F.lit(0)
    index: Column = F.lit(0).cast("bigint")
    for shift in range(ORDER - _STEP, -1, -_STEP):
        xb = F.shiftright(gx, shift).bitwiseAND(15)
        yb = F.shiftright(gy, shift).bitwiseAND(15)
        entry = F.get(table, state * 256 + xb * 16 + yb)
        index = F.shiftleft(index, 2 * _STEP).bitwiseOR(F.shiftright(entry, 2).cast("bigint"))
        state = entry.bitwiseAND(3)
    return index


def hilbert_index(x: Column, y: Column, bounds: Column) -> Column:
    """Hilbert index of a point inside a box struct."""
    return hilbert_of_cell(
        grid_position(x, bounds["xmin"], bounds["xmax"]), grid_position(y, bounds["ymin"], bounds["ymax"])
    )


def hilbert_of_box(b: Column, bounds: Column) -> Column:
    """Hilbert index of the centre of a feature's box."""
    return hilbert_index((b["xmin"] + b["xmax"]) / 2, (b["ymin"] + b["ymax"]) / 2, bounds)
