"""Order-free comparison of a Spark result with a DuckDB result."""

import math

import numpy as np
import pandas as pd


def rows(df: pd.DataFrame) -> list[tuple]:
    def value(v):
        if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
            return "NULL"
        if isinstance(v, (float, int, np.integer, np.floating)) and not isinstance(v, bool):
            return f"{float(v):.9g}"
        return str(v)

    return sorted(tuple(map(value, r)) for r in df[sorted(df.columns)].itertuples(index=False))


def same(a: pd.DataFrame, b: pd.DataFrame) -> None:
    assert sorted(a.columns) == sorted(b.columns)
    assert rows(a) == rows(b)
