"""Frame detection on long rules, and the rule grid inside a frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.operators.intervals import collinear


def extents(segments: DataFrame, keys: list[str]) -> DataFrame:
    """``keys..., ex0, ex1, ey0, ey1`` of axis-parallel segments; ends count, so hairlines do."""
    h = F.col("orient") == "H"
    return segments.groupBy(*keys).agg(
        F.min(F.when(h, F.col("lo")).otherwise(F.col("coord"))).alias("ex0"), F.max(F.when(h, F.col("hi")).otherwise(F.col("coord"))).alias("ex1"),
        F.min(F.when(h, F.col("coord")).otherwise(F.col("lo"))).alias("ey0"), F.max(F.when(h, F.col("coord")).otherwise(F.col("hi"))).alias("ey1"),
    )


def detect(segments: DataFrame, keys: list[str], share: float = 0.6, band: float = 0.12) -> DataFrame:
    """``keys..., x0, y0, x1, y1, found``: on each side the innermost rule of ``share`` of the extent within the band.

    A side without one falls back to the extent; ``found`` counts the sides with one.
    """
    ext = extents(segments, keys)
    rules = collinear(segments, [*keys, "orient"], 0.0).join(ext, keys)
    w, t = F.col("ex1") - F.col("ex0"), F.col("ey1") - F.col("ey0")
    h = F.col("orient") == "H"
    long = rules.filter(F.col("covered") >= share * F.when(h, w).otherwise(t))
    side = lambda o, cond, f: f(F.when((F.col("orient") == o) & cond, F.col("coord")))
    c = F.col("coord")
    found = long.groupBy(*keys).agg(
        side("V", c <= F.col("ex0") + band * w, F.max).alias("l"), side("V", c >= F.col("ex1") - band * w, F.min).alias("r"),
        side("H", c <= F.col("ey0") + band * t, F.max).alias("t"), side("H", c >= F.col("ey1") - band * t, F.min).alias("b"),
    )
    n = sum((F.col(x).isNotNull().cast("int") for x in "rtb"), F.col("l").isNotNull().cast("int"))
    return ext.join(found, keys, "left").select(
        *keys, F.coalesce("l", "ex0").alias("x0"), F.coalesce("t", "ey0").alias("y0"), F.coalesce("r", "ex1").alias("x1"), F.coalesce("b", "ey1").alias("y1"), n.alias("found")
    )


def grid_cells(segments: DataFrame, frames: DataFrame, keys: list[str], n: int = 40, share: float = 0.10, slack: float = 0.02) -> DataFrame:
    """``keys..., plane, ix, iy``: cells of an n x n grid over the frame that long rules pass (plane 0: H, 1: V)."""
    f = frames.select(*keys, *[F.col(c).alias(f"f_{c}") for c in ("x0", "y0", "x1", "y1")])
    rules = collinear(segments, [*keys, "orient"], 0.0).join(f, keys)
    h = F.col("orient") == "H"
    pick = lambda a, b: F.when(h, F.col(a)).otherwise(F.col(b))
    along0, along1, across0, across1 = pick("f_x0", "f_y0"), pick("f_x1", "f_y1"), pick("f_y0", "f_x0"), pick("f_y1", "f_x1")
    rules = rules.withColumns({"a0": along0, "a1": along1, "c0": across0, "c1": across1})
    size = F.col("a1") - F.col("a0")
    deep = F.col("c1") - F.col("c0")
    ok = (size > 0) & (deep > 0) & (F.col("covered") >= share * size) & F.col("coord").between(F.col("c0") - slack * deep, F.col("c1") + slack * deep)
    cell = lambda x, lo, s: ((x - lo) / s * n).cast("int")
    bound = lambda x: F.least(F.lit(n - 1), F.greatest(F.lit(0), x))
    at = bound(cell(F.col("coord"), F.col("c0"), deep))
    first = F.greatest(F.lit(0), cell(F.greatest("lo", "a0"), F.col("a0"), size))
    last = F.least(F.lit(n - 1), cell(F.least("hi", "a1"), F.col("a0"), size))
    rows = rules.filter(ok).withColumns({"at": at, "first": first, "last": last}).filter("first <= last").withColumn("i", F.explode(F.sequence("first", "last")))
    return rows.select(*keys, F.when(h, 0).otherwise(1).alias("plane"), F.when(h, F.col("i")).otherwise(F.col("at")).alias("ix"), F.when(h, F.col("at")).otherwise(F.col("i")).alias("iy")).distinct()


def dilate_cells(cells: DataFrame, keys: list[str], n: int = 40, wrap: bool = True) -> DataFrame:
    """3 x 3 dilation of cell rows; round the edges, or cut at them."""
    steps = F.array(*[F.lit(d) for d in (-1, 0, 1)])
    out = cells.withColumn("dx", F.explode(steps)).withColumn("dy", F.explode(steps))
    x, y = F.col("ix") + F.col("dx"), F.col("iy") + F.col("dy")
    if wrap:
        x, y = F.pmod(x, F.lit(n)), F.pmod(y, F.lit(n))
    out = out.select(*keys, x.alias("ix"), y.alias("iy"))
    return (out if wrap else out.filter(F.col("ix").between(0, n - 1) & F.col("iy").between(0, n - 1))).distinct()


def rotation(texts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys..., rot``: the first rotation whose direction with most characters reads left to right on a landscape page.

    ``texts``: ``keys, rot, direction, text, width, height``; pages without one are left out.
    """
    n = texts.groupBy(*keys, "rot", "direction").agg(F.sum(F.length(F.trim("text"))).alias("n"), F.max("width").alias("w"), F.max("height").alias("h"))
    best = n.groupBy(*keys, "rot").agg(F.max(F.struct("n", F.col("direction").alias("d"))).alias("m"), F.max("w").alias("w"), F.max("h").alias("h"))
    return best.filter((F.col("m.d") == "right") & (F.col("w") > F.col("h"))).groupBy(*keys).agg(F.min("rot").alias("rot"))


def without_outliers(items: DataFrame, keys: list[str], x: str, size: str, factor: float = 20.0) -> DataFrame:
    """Items within the median position plus or minus ``factor`` times the 98th percentile size, finite ones only."""
    finite = items.filter(F.col(x).isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    s = finite.groupBy(*keys).agg(F.percentile(x, F.lit(0.5)).alias("__m"), F.percentile(size, F.lit(0.98)).alias("__s"))
    return finite.join(s, keys).filter(F.abs(F.col(x) - F.col("__m")) <= factor * F.col("__s")).drop("__m", "__s")
