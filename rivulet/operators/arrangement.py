"""Where the views of a page go on another sheet: the first arrangement that fits, tried in a fixed order.

Views keep their size. For each gap between views, from the widest, and for each size of the rail's blocks, from full
size down to what their type allows, three ways are tried: *rigid*, the source arrangement with its empty bands squeezed;
*flow*, views one after another in reading order, each nearest to its place and on its side of those placed before; *free*,
the largest first, nearest to its place. The first gap and size at which some way places all views is taken, and of
these ways the one that turns round the fewest pairs of neighbours.

A view is a set of rectangles. Where it may stand is the plane less one forbidden rectangle for each pair of its own
rectangles and an occupied one, so the nearest free place has each coordinate at the wished place or at a border of a
forbidden rectangle: these candidates are exact, no raster is searched.

Plan. Every page is one row, with the few views of one page, and stops at its first arrangement; pages are many, and their
rows are so small that Spark would join them to a few tasks: they are dealt to tasks by their count.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Squeezes of the empty bands, shifts, the step of sizes, slack of order, share of a common row.
SQUEEZES, SHIFTS_X, SHIFTS_Y = (1.0, 0.8, 0.6, 0.45, 0.3, 0.15, 0.0), (0, 12, 30), (0, 10)
STEP, SLACK, ROW, NEAR_SIDE, BAND = 0.025, 12.0, 0.3, 5.0, 6.0
MODES = ("rigid", "flow", "free")
PAGES = 300  # pages of a task's share
# Ways of the rigid arrangement in the order they are tried: places of (squeeze, shift) along each axis.
AXIS_X, AXIS_Y = [(k, t) for k in SQUEEZES for t in SHIFTS_X], [(k, t) for k in SQUEEZES for t in SHIFTS_Y]
WAYS = sorted(((kx, ky, tx, ty) for kx in SQUEEZES for ky in SQUEEZES for tx in SHIFTS_X for ty in SHIFTS_Y), key=lambda w: (-(w[0] + w[1]), w[2] + w[3]))
WAY_X, WAY_Y = np.array([(AXIS_X.index((kx, tx)), AXIS_Y.index((ky, ty))) for kx, ky, tx, ty in WAYS]).T
OUTWARD, ACROSS = np.array([-1.0, -1.0, 1.0, 1.0]), np.array([2, 3, 0, 1])  # signs of a rectangle's sides; each side's opposite
COLUMNS = "gap int, mode string, shrink double, turned int, wrapped int, relaxed int, view_id long, x double, y double, scale double"


def squeezed(spans: list[tuple[float, float]], low: float, factor: float):
    """A map of one axis that narrows the bands no span covers; what spans cover keeps its length."""
    runs: list[list[float]] = []
    for a, b in sorted(spans):
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b)
        else:
            runs.append([a, b])
    starts, at, before = [], low, low
    for i, (a, b) in enumerate(runs):
        empty = a - before
        at += empty * factor if i == 0 else max(min(empty, BAND), empty * factor)
        starts.append(at)
        at, before = at + b - a, b
    return lambda x: next((s + x - a for (a, b), s in zip(runs, starts) if a <= x <= b), x)


def forbidden(own: np.ndarray, taken: np.ndarray, gap: float) -> np.ndarray:
    """Open rectangles that the view's corner must stay out of."""
    return (taken + gap * OUTWARD - own.take(ACROSS, axis=1)[:, None, :]).reshape(-1, 4)


def nearest_free(px: float, py: float, room: tuple[float, float, float, float], no: np.ndarray) -> tuple[float, float] | None:
    """The place in ``room`` nearest to (px, py) outside all of ``no``; ties go to the upper, then to the left one."""
    if room[0] > room[2] or room[1] > room[3]:
        return None
    x, y = min(max(px, room[0]), room[2]), min(max(py, room[1]), room[3])
    x0, y0, x1, y1 = no.T
    if not ((x > x0) & (x < x1) & (y > y0) & (y < y1)).any():
        return float(x), float(y)
    axis = lambda at, lo, hi, edges: np.sort(np.append(edges[(edges >= lo) & (edges <= hi)], at))[:, None]
    xs, ys = axis(x, room[0], room[2], no[:, 0::2]), axis(y, room[1], room[3], no[:, 1::2])
    far = (ys - py) ** 2 + (xs.T - px) ** 2
    inside_x, inside_y = (xs > x0) & (xs < x1), (ys > y0) & (ys < y1)
    far[inside_y.astype(np.float32) @ inside_x.astype(np.float32).T > 0] = np.inf
    i, j = divmod(int(far.argmin()), len(xs))  # the first of equals: rows from above, columns from the left
    return None if far[i, j] == np.inf else (float(xs[j, 0]), float(ys[i, 0]))


def same_row(a, b) -> bool:
    return min(a[3], b[3]) - max(a[1], b[1]) > ROW * min(a[3] - a[1], b[3] - b[1])


def area(v: dict) -> float:
    return (v["box"][2] - v["box"][0]) * (v["box"][3] - v["box"][1])


class Sheet:
    """One page's views and the target's frame, with all that no gap and no taken place changes."""

    def __init__(self, views: list[dict], source, frame):
        self.views, self.source, self.frame = views, source, frame
        self.by_area = sorted(views, key=lambda v: -area(v))
        self.largest = sorted(views, key=lambda v: (-area(v), v["id"]))
        self.rooms = {v["id"]: (frame[0], frame[1], frame[2] - (v["box"][2] - v["box"][0]), frame[3] - (v["box"][3] - v["box"][1])) for v in views}
        across, down = ({k: squeezed([(v["box"][i], v["box"][i + 2]) for v in views], source[i], k) for k in SQUEEZES} for i in (0, 1))
        kx, ky = (min(1.0, (frame[i + 2] - frame[i] - 6) / max(source[i + 2] - source[i], 1)) for i in (0, 1))
        place = lambda x, y: (round(frame[0] + 3 + x - source[0]), round(frame[1] + 3 + y - source[1]))
        self.wishes = {v["id"]: place(across[0.3](v["box"][0]), down[0.0](v["box"][1])) for v in views}
        self.free_wishes = {v["id"]: (round(frame[0] + 3 + (v["box"][0] - source[0]) * kx), round(frame[1] + 3 + (v["box"][1] - source[1]) * ky)) for v in views}
        self.pairs = []
        for i, a in enumerate(views):
            for b in views[i + 1 :]:
                p, q = a["box"], b["box"]
                if same_row(p, q):
                    self.pairs.append((a["id"], b["id"], 0, p[0] < q[0]))
                elif min(p[2], q[2]) > max(p[0], q[0]):
                    self.pairs.append((a["id"], b["id"], 1, p[1] < q[1]))
        grid = lambda axis, maps, i: np.rint(np.array([[t + maps[k](v["box"][i]) for v in self.by_area] for k, t in axis], float).reshape(len(axis), -1) + frame[i] + 3 - source[i])
        self.x, self.y = grid(AXIS_X, across, 0), grid(AXIS_Y, down, 1)

    def turned(self, at: dict) -> int:
        """Pairs in one row or column whose order is not that of the source."""
        return sum(before != (at[a][axis] < at[b][axis]) for a, b, axis, before in self.pairs)

    def put(self, taken, v, x, y):
        return np.concatenate([taken, v["rects"] + (x, y, x, y)])

    def left_over(self, taken, gap) -> np.ndarray:
        """Which views, from the largest, find no place in each way of the two axes: ``[way along x, way along y, view]``.

        Whether two views collide depends on the difference of their places, so all ways are tried at once, view by view.
        """
        x, y = self.x, self.y
        over = np.zeros((len(x), len(y), len(self.by_area)), bool)
        for i, v in enumerate(self.by_area):
            r = self.rooms[v["id"]]
            before = [o["rects"] for o in self.by_area[:i]]
            no = forbidden(v["rects"], np.concatenate([taken, *before]), gap).reshape(len(v["rects"]), -1, 4).swapaxes(0, 1).reshape(-1, 4)
            owner = np.repeat(np.arange(-1, i), [n * len(v["rects"]) for n in (len(taken), *map(len, before))])  # -1: taken by none of the views
            dx, dy = (c[:, i, None] - np.where(owner < 0, 0, c[:, owner]) for c in (x, y))
            met = ((dx > no[:, 0]) & (dx < no[:, 2]))[:, None, :] & ((dy > no[:, 1]) & (dy < no[:, 3]))[None, :, :]
            over[:, :, i] = ((x[:, i] < r[0]) | (x[:, i] > r[2]))[:, None] | ((y[:, i] < r[1]) | (y[:, i] > r[3]))[None, :]
            over[:, :, i] |= (met & ((owner < 0) | ~over[:, :, owner])).any(-1)
        return over

    def rigid(self, taken, gap):
        """The first squeeze and shift that leaves no view over, else the first that leaves one which fits elsewhere."""
        over = self.left_over(taken, gap)[WAY_X, WAY_Y]
        count = over.sum(axis=1)
        for most in (0, 1):
            for w in np.flatnonzero(count == most):
                x, y = self.x[WAY_X[w]], self.y[WAY_Y[w]]
                at = {v["id"]: (float(x[i]), float(y[i])) for i, v in enumerate(self.by_area) if not over[w, i]}
                rest = [v for v in self.by_area if v["id"] not in at]
                all_taken = np.concatenate([taken, *(v["rects"] + at[v["id"]] * 2 for v in self.by_area if v["id"] in at)])
                if not rest or nearest_free(*self.wishes[rest[0]["id"]], self.rooms[rest[0]["id"]], forbidden(rest[0]["rects"], all_taken, gap)):
                    return at, rest, all_taken
        return {}, list(self.views), taken

    def arrange(self, mode: str, taken, gap, at: dict, todo: list[dict]):
        """(place of each view, wrapped, relaxed), or None if a view of ``todo`` finds no place besides those of ``at``."""
        if mode == "free":
            todo = self.largest
        else:
            rows: list[list[dict]] = []
            for v in sorted(todo, key=lambda v: (v["box"][1], v["id"])):
                row = next((r for r in rows if any(same_row(v["box"], o["box"]) for o in r)), None)
                rows.append([v]) if row is None else row.append(v)
            todo = [v for r in rows for v in sorted(r, key=lambda v: v["box"][0])]
        wrapped = relaxed = 0
        for v in todo:
            no, place = forbidden(v["rects"], taken, gap), None
            wish = (self.free_wishes if mode == "free" else self.wishes)[v["id"]]
            if mode != "free":
                place = nearest_free(*wish, self.ordered(v, at, False), no)
                if place is None:
                    place = nearest_free(*wish, self.ordered(v, at, True), no)
                    wrapped += place is not None
            if place is None:
                place = nearest_free(*wish, self.rooms[v["id"]], no)
                relaxed += place is not None and mode != "free"
            if place is None:
                return None
            at[v["id"]], taken = place, self.put(taken, v, *place)
        return at, wrapped, relaxed

    def ordered(self, v, at, wrap: bool):
        """The room in which the view keeps its side of the views placed; wrapped, it goes below its row instead."""
        x0, y0, x1, y1 = self.rooms[v["id"]]
        b = v["box"]
        w, h = b[2] - b[0], b[3] - b[1]
        for o in self.views:
            if o["id"] not in at:
                continue
            c, (x, y) = o["box"], at[o["id"]]
            right, below, beside = x + c[2] - c[0], y + c[3] - c[1], min(b[2], c[2]) > max(b[0], c[0])
            if same_row(b, c):
                if wrap:
                    y0 = max(y0, below - SLACK)
                elif b[2] <= c[0] + NEAR_SIDE:
                    x1 = min(x1, x + SLACK - w)
                elif b[0] >= c[2] - NEAR_SIDE:
                    x0 = max(x0, right - SLACK)
            elif beside and b[1] >= c[3] - NEAR_SIDE:
                y0 = max(y0, below - SLACK)
            elif beside and b[3] <= c[1] + NEAR_SIDE:
                y1 = min(y1, y + SLACK - h)
        return x0, y0, x1, y1


def searched(page: dict, gaps: tuple[int, ...]) -> list[tuple]:
    """The first gap and size of the rail's blocks at which all views of a page find a place, with the best way."""
    number = lambda v: np.nan if v is None else v
    frame, source = (tuple(page[f"{p}_{s}"] for s in ("x0", "y0", "x1", "y1")) for p in ("f", "s"))
    views, rail = [], []
    for vid, group in groupby(page["pieces"], key=lambda r: r["view_id"]):
        part = list(group)
        sides = [[r[s] for r in part] for s in ("x0", "y0", "x1", "y1")]
        box = (min(sides[0]), min(sides[1]), max(sides[2]), max(sides[3]))
        item = {"id": vid, "box": box, "rects": np.array(sides, float).T - np.array([box[0], box[1]] * 2), "font": number(part[0]["font"])}
        (rail if part[0]["rail"] else views).append(item)
    rail.sort(key=lambda v: (v["box"][1], v["id"]))
    fixed = np.array([[r[s] for s in ("x0", "y0", "x1", "y1")] for r in page["reserved"]], float).reshape(-1, 4)
    sheet, rail_width, least_font = Sheet(views, source, frame), number(page["rail_width"]), number(page["least_font"])
    for gap in gaps:
        step = 0
        while (shrink := 1.0 - STEP * step) > 0.1:
            y, placed, taken = frame[1], [], fixed
            for v in rail:
                w, h = v["box"][2] - v["box"][0], v["box"][3] - v["box"][1]
                scale = min(1.0, rail_width / w if w else np.inf) * shrink
                placed.append((v["id"], frame[2] - w * scale, y, scale, v["font"] * scale, y + h * scale))
                taken = np.concatenate([taken, [[np.floor(frame[2] - w * scale), np.floor(y), frame[2], np.ceil(y + h * scale)]]])
                y += h * scale + gap
            if step and any(p[4] < least_font for p in placed):
                break
            found = []
            whole = False
            for k, mode in enumerate(MODES if all(p[5] <= frame[3] for p in placed) else ()):
                if mode == "flow" and whole:
                    continue  # the rigid way has kept nothing, so it was this one
                at, todo, full = sheet.rigid(taken, gap) if mode == "rigid" else ({}, sheet.views, taken)
                whole = not at
                way = sheet.arrange(mode, full, gap, at, todo)
                if way is not None:
                    found.append((sheet.turned(way[0]), k, mode, way))
                    if not found[-1][0]:
                        break
            if found:
                n, _, mode, (at, wrapped, relaxed) = min(found, key=lambda x: x[:2])
                about = (gap, mode, shrink, n, wrapped, relaxed)
                return [(*about, v["id"], *at[v["id"]], 1.0) for v in views] + [(*about, *p[:4]) for p in placed]
            if not rail:
                break
            step += 1
    return []


def arranged(views: DataFrame, sheets: DataFrame, keys: list[str], gaps: tuple[int, ...] = (5, 3, 2)) -> DataFrame:
    """``keys..., gap, mode, shrink, turned, wrapped, relaxed, view_id, x, y, scale``; pages without an arrangement are absent.

    ``views``: ``keys, view_id, rail, font, x0, y0, x1, y1``, one row a rectangle of a view (``rail``: a block of the right
    rail, which may shrink). ``sheets``: ``keys``, one row each, the source rectangle ``s_*``, the target frame ``f_*``,
    ``reserved`` (array of rectangles taken), ``rail_width`` and ``least_font``. Coordinates are whole numbers. ``x, y`` is the
    corner of the view's box. ``turned``: pairs out of order; ``wrapped, relaxed``: views that left their row, or all order.
    """
    kinds = {f.name: f.dataType.simpleString() for f in views.schema}
    names = [*keys, *(c.split()[0] for c in COLUMNS.split(", "))]
    types = [{"int": pa.int32(), "string": pa.string(), "double": pa.float64(), "long": pa.int64()}[c.split()[1]] for c in COLUMNS.split(", ")]

    def run(batches):
        for batch in batches:
            rows = [(*(page[k] for k in keys), *r) for page in batch.to_pylist() for r in searched(page, gaps)]
            columns = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [*(batch.schema.field(k).type for k in keys), *types])], names)

    sides = [F.col(c).cast("double").alias(c) for c in ("y0", "x0", "y1", "x1")]
    dealt = views.filter("view_id IS NOT NULL").repartition(max(1, -(-sheets.count() // PAGES)), *keys)
    pages = dealt.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col("view_id").cast("long").alias("view_id"), *sides, "rail", "font"))).alias("pieces"))
    return pages.join(sheets, keys).mapInArrow(run, ", ".join(f"{k} {kinds[k]}" for k in keys) + ", " + COLUMNS)
