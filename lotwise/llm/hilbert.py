"""Index on a Hilbert curve, after J. Skilling, "Programming the Hilbert curve" (2004)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from lotwise.llm.common import by_value


def indices(cells: np.ndarray, bits: int) -> np.ndarray:
    """Curve index of each row of ``cells`` (integers below 2**bits, bits * columns < 64)."""
    x = cells.astype(np.int64).T.copy()
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for axis in x:
            inverted = (axis & bit) != 0
            swap = np.where(inverted, 0, (x[0] ^ axis) & low)
            first = np.where(inverted, x[0] ^ low, x[0] ^ swap)
            axis ^= swap
            x[0] = first
    x = np.bitwise_xor.accumulate(x, axis=0)
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & (1 << level), (1 << level) - 1, 0)
    index = np.zeros_like(turn)
    for level in range(bits - 1, -1, -1):
        for axis in x ^ turn:
            index = index << 1 | axis >> level & 1
    return index


def index_column(cells: list[str], bits: int) -> Column:
    """The same as one SQL expression over integer columns, without Python on executors."""
    n = len(cells)
    steps = f"sequence(0, {(bits - 1) * n - 1})" if bits > 1 else "array()"
    x = f"transform(array({', '.join(cells)}), v -> cast(v AS bigint))"
    if bits > 1:
        # Step s looks at level bits - 1 - s div n of axis s mod n.
        bit = f"shiftleft(1L, {bits - 1} - cast(s div {n} AS int))"
        axis = f"cast(s % {n} AS int)"
        swap = f"((a[0] ^ a[{axis}]) & ({bit} - 1))"
        x = (
            f"aggregate({steps}, {x}, (a, s) -> CASE WHEN (a[{axis}] & {bit}) <> 0"
            f" THEN transform(a, (v, j) -> CASE WHEN j = 0 THEN v ^ ({bit} - 1) ELSE v END)"
            f" ELSE transform(a, (v, j) -> CASE WHEN {axis} > 0 AND (j = 0 OR j = {axis}) THEN v ^ {swap} ELSE v END) END)"
        )
    gray = (
        f"aggregate({x}, cast(array() AS array<bigint>), (a, v) ->"
        f" CASE WHEN size(a) = 0 THEN array(v) ELSE array_append(a, a[size(a) - 1] ^ v) END)"
    )
    levels = f"sequence({bits - 1}, 0)"
    turn = (
        f"aggregate({levels}, 0L, (t, l) -> CASE WHEN l > 0 AND (g[{n - 1}] & shiftleft(1L, l)) <> 0"
        f" THEN t ^ (shiftleft(1L, l) - 1) ELSE t END)"
    )
    joined = (
        f"aggregate({levels}, 0L, (h, l) -> aggregate(transform(g, v -> v ^ {turn}), h,"
        f" (i, v) -> shiftleft(i, 1) | (shiftright(v, l) & 1L)))"
    )
    return F.expr(f"element_at(transform(array({gray}), g -> {joined}), 1)")


by_value(__name__)
