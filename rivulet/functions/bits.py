"""Bit grids: an array of row masks (bit c of element r is cell (c, r)), planes one after another."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType


def dilate(grid: Column, n: int) -> Column:
    """3x3 dilation that wraps round the edges of every n x n plane."""
    full = (1 << n) - 1
    wide = F.transform(
        grid, lambda r: r.bitwiseOR(F.shiftleft(r, 1).bitwiseAND(full)).bitwiseOR(F.shiftright(r, n - 1)).bitwiseOR(F.shiftright(r, 1)).bitwiseOR(F.shiftleft(r.bitwiseAND(1), n - 1))
    )

    def tall(rows: Column) -> Column:
        at = lambda i, d: F.element_at(rows, (i - F.pmod(i, F.lit(n)) + F.pmod(i + d, F.lit(n)) + 1).cast("int"))
        return F.transform(rows, lambda r, i: r.bitwiseOR(at(i, -1)).bitwiseOR(at(i, 1)))

    return F.element_at(F.transform(F.array(wide), tall), 1)


def count(grid: Column) -> Column:
    return F.aggregate(grid, F.lit(0), lambda s, r: s + F.bit_count(r))


def common(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseAND(y))), F.lit(0), lambda s, x: s + x)


def words(grid: Column, n: int, rows: int) -> list[Column]:
    """The grid packed into 32-bit words, as separate columns: pairs are then compared without lambdas."""
    per = max(1, 32 // n)
    out = []
    for at in range(0, rows, per):
        w = F.lit(0).cast("long")
        for k in range(min(per, rows - at)):
            w = w.bitwiseOR(F.shiftleft(F.get(grid, at + k), n * k))
        out.append(w)
    return out


def coverage(a: list[Column], a_wide: list[Column], b: list[Column], b_wide: list[Column]) -> Column:
    """The lesser share of one grid that the other's dilation covers; denominators of at least 1."""
    total = lambda xs: sum((F.bit_count(x) for x in xs[1:]), F.bit_count(xs[0]))
    both = lambda xs, ys: total([x.bitwiseAND(y) for x, y in zip(xs, ys)])
    return F.least(both(a, b_wide) / F.greatest(F.lit(1), total(a)), both(b, a_wide) / F.greatest(F.lit(1), total(b)))


@F.pandas_udf(StringType())
def pack(grids: pd.Series) -> pd.Series:
    """Base64 of the packed bits of 40 x 40 planes, row by row, first cell in the highest bit."""
    import base64

    def one(g):
        bits = np.array([[int(r) >> c & 1 for c in range(40)] for r in g], np.uint8)
        return base64.b64encode(np.packbits(bits.ravel()).tobytes()).decode()

    return grids.map(lambda g: None if g is None else one(g))


@F.pandas_udf(ArrayType(LongType()))
def unpack(texts: pd.Series) -> pd.Series:
    """The inverse of ``pack``."""
    import base64

    def one(t):
        bits = np.unpackbits(np.frombuffer(base64.b64decode(t), np.uint8))
        rows = bits[: len(bits) // 40 * 40].reshape(-1, 40)
        return [int(sum(int(b) << c for c, b in enumerate(r))) for r in rows]

    return texts.map(lambda t: None if t is None else one(t))
