"""Rectangle and segment expressions: structs of ``x0, y0, x1, y1``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SIDES = ("x0", "y0", "x1", "y1")
#: Strips thinner than this are dropped by a subtraction.
SLIVER = 0.01


def rect(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.struct(*[c.cast("double").alias(n) for c, n in zip((x0, y0, x1, y1), SIDES)])


def of(prefix: str = "", suffix: str = "") -> Column:
    """The rectangle in four columns."""
    return rect(*[F.col(f"{prefix}{n}{suffix}") for n in SIDES])


def pad(r: Column, d: float | Column) -> Column:
    return rect(r["x0"] - d, r["y0"] - d, r["x1"] + d, r["y1"] + d)


def meet(a: Column, b: Column) -> Column:
    """The intersection; empty where a far side lies before a near one."""
    return rect(F.greatest(a["x0"], b["x0"]), F.greatest(a["y0"], b["y0"]), F.least(a["x1"], b["x1"]), F.least(a["y1"], b["y1"]))


def hull(a: Column, b: Column) -> Column:
    return rect(F.least(a["x0"], b["x0"]), F.least(a["y0"], b["y0"]), F.greatest(a["x1"], b["x1"]), F.greatest(a["y1"], b["y1"]))


def width(r: Column) -> Column:
    return r["x1"] - r["x0"]


def height(r: Column) -> Column:
    return r["y1"] - r["y0"]


def area(r: Column) -> Column:
    """0 for an empty rectangle."""
    return F.greatest(width(r), F.lit(0.0)) * F.greatest(height(r), F.lit(0.0))


def contains(a: Column, b: Column, slack: float = 0.0) -> Column:
    return (b["x0"] >= a["x0"] - slack) & (b["y0"] >= a["y0"] - slack) & (b["x1"] <= a["x1"] + slack) & (b["y1"] <= a["y1"] + slack)


def holds_point(a: Column, x: Column, y: Column, slack: float = 0.0) -> Column:
    return (x >= a["x0"] - slack) & (x <= a["x1"] + slack) & (y >= a["y0"] - slack) & (y <= a["y1"] + slack)


def center_in(a: Column, b: Column, slack: float = 0.0) -> Column:
    """Whether b's centre lies in a."""
    return holds_point(a, (b["x0"] + b["x1"]) / 2, (b["y0"] + b["y1"]) / 2, slack)


def near(a: Column, b: Column, gap: float) -> Column:
    return (a["x1"] + gap >= b["x0"]) & (b["x1"] + gap >= a["x0"]) & (a["y1"] + gap >= b["y0"]) & (b["y1"] + gap >= a["y0"])


def gaps(a: Column, b: Column) -> tuple[Column, Column]:
    zero = F.lit(0.0)
    return (
        F.greatest(zero, F.greatest(a["x0"], b["x0"]) - F.least(a["x1"], b["x1"])),
        F.greatest(zero, F.greatest(a["y0"], b["y0"]) - F.least(a["y1"], b["y1"])),
    )


def distance(a: Column, b: Column) -> Column:
    """Edge to edge."""
    dx, dy = gaps(a, b)
    return F.sqrt(dx * dx + dy * dy)


def manhattan(a: Column, b: Column) -> Column:
    dx, dy = gaps(a, b)
    return dx + dy


def subtract(a: Column, b: Column) -> Column:
    """``a`` without ``b`` as at most four disjoint strips: above, below, left, right."""
    i = meet(a, b)
    cut = (width(i) > 0) & (height(i) > 0)
    strips = F.array(
        F.when(i["y0"] > a["y0"], rect(a["x0"], a["y0"], a["x1"], i["y0"])),
        F.when(i["y1"] < a["y1"], rect(a["x0"], i["y1"], a["x1"], a["y1"])),
        F.when(i["x0"] > a["x0"], rect(a["x0"], i["y0"], i["x0"], i["y1"])),
        F.when(i["x1"] < a["x1"], rect(i["x1"], i["y0"], a["x1"], i["y1"])),
    )
    solid = F.filter(strips, lambda r: r.isNotNull() & (width(r) > SLIVER) & (height(r) > SLIVER))
    return F.when(cut, solid).otherwise(F.array(a))


def subtract_all(regions: Column, cutters: Column) -> Column:
    """Array of rectangles without any of the cutters, one after another."""
    return F.aggregate(cutters, regions, lambda left, c: F.flatten(F.transform(left, lambda r: subtract(r, c))))


def snap(x: Column) -> Column:
    """To 1/64, half to even: exact in single precision."""
    return F.rint(x * 64) / 64


def place(x: Column, origin: Column, target: Column, scale: Column) -> Column:
    return target + (x - origin) * scale


def fraction(x: Column, lo: Column, hi: Column) -> Column:
    """Position between ``lo`` and ``hi``, three decimals, within 0 and 1."""
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.bround((x - lo) / (hi - lo), 3)))


def slant_bucket(dx: Column, dy: Column) -> Column:
    """Direction without sign, in tens of degrees (0 to 17)."""
    return F.floor(F.pmod(F.degrees(F.atan2(dy, dx)), F.lit(180.0)) / 10).cast("int")


def valid_rect(r: Column) -> Column:
    """Four finite numbers and positive width and height."""
    finite = [r[n].isNotNull() & ~F.isnan(r[n]) & (F.abs(r[n]) < F.lit(float("inf"))) for n in SIDES]
    return finite[0] & finite[1] & finite[2] & finite[3] & (width(r) > 0) & (height(r) > 0)


def fit_inside(source: Column, box: Column, margin: float = 6.0) -> Column:
    """``source`` scaled as a whole to fit ``box`` less a margin, centred."""
    scale = F.least((width(box) - 2 * margin) / width(source), (height(box) - 2 * margin) / height(source))
    cx, cy = (box["x0"] + box["x1"]) / 2, (box["y0"] + box["y1"]) / 2
    w, h = width(source) * scale / 2, height(source) * scale / 2
    return rect(cx - w, cy - h, cx + w, cy + h)
