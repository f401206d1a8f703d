"""Part lists of one page by plain loops, to hold the Spark form against."""

import re

from rivulet.operators.partlists import HEADS, PARTS, REVISIONS

TOL = 1.5


def merged(pieces, gap):
    out = []
    for lo, hi in sorted(pieces):
        if out and lo <= out[-1][1] + gap:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


class Page:
    def __init__(self, rules, words, marks, frame):
        flat = [(c, lo, hi) for o, c, lo, hi in rules if o == "H" and hi - lo > TOL]
        self.heights = []
        for y in sorted({c for c, _, _ in flat}):
            if not self.heights or y - self.heights[-1] > TOL:
                self.heights.append(y)
        self.spans = {y: merged([(lo, hi) for c, lo, hi in flat if abs(c - y) <= TOL], TOL) for y in self.heights}
        places = {}
        for o, c, lo, hi in rules:
            if o == "V":
                places.setdefault(round(c / 0.6), []).append((c, lo, hi))
        self.columns = [(sum(x[0] for x in v) / len(v), lo, hi) for v in places.values() for lo, hi in merged([x[1:] for x in v], TOL)]
        self.words = [((a + c) / 2, (b + d) / 2, t) for _, a, b, c, d, t in sorted(words)]
        self.marks, self.frame = marks, frame

    def text(self, x0, y0, x1, y1):
        return "".join(t for x, y, t in self.words if x0 <= x <= x1 and y0 <= y <= y1).upper().replace(" ", "")

    def through(self, a, b, region):
        inside = [c for c in self.columns if region[0] - TOL <= c[0] <= region[2] + TOL]
        return sorted({x for x, lo, hi in inside if max(lo - a, 0) + max(b - hi, 0) <= TOL})


def near(a, b, g):
    return abs(b - a - g) <= max(0.8, 0.12 * g)


def named(text, words):
    return any(w in text for w in words)


def persists(page, region, a, b, cols, outer=True):
    here = page.through(a, b, region)
    met = lambda x: any(abs(h - x) < TOL for h in here)
    return sum(map(met, cols[1:-1])) >= min(2, len(cols) - 2) and (not outer or (met(cols[0]) and met(cols[-1])))


def numbered(page, rows, cols):
    return sum(bool(re.match(r"^(\d{1,3}|[A-Z])$", page.text(cols[0], a, cols[1], b))) for a, b in zip(rows, rows[1:])) >= 2


def grow(page, region, rows, cols, g):
    own = [y for y in page.heights if page.frame[1] - TOL <= y <= region[3] + TOL and any(lo <= cols[0] + TOL and hi >= cols[-1] - TOL for lo, hi in page.spans[y])]
    out, low = list(rows), [y for y in own if y > rows[-1] + TOL]
    for k, y in enumerate(low):
        h = y - out[-1]
        same = persists(page, region, out[-1], y, cols)
        if near(out[-1], y, g) and same:
            out.append(y)
            continue
        if h < g - max(0.8, 0.12 * g) and k + 1 < len(low) and near(out[-1], low[k + 1], g):
            continue
        text = page.text(cols[0], out[-1], cols[-1], y)
        if h < 3 * g and same and (named(text, HEADS) or (not text and (h <= 1.5 * g or y >= region[3] - TOL))):
            out.append(y)
        break
    for y in reversed([y for y in own if y < rows[0] - TOL]):
        same, h = persists(page, region, y, out[0], cols), out[0] - y
        if not (same and (near(y, out[0], g) or h < 3 * g)):
            break
        regular = near(y, out[0], g)
        out.insert(0, y)
        if not regular:
            break
    return out


def verdict(page, region, rows, cols, band, side, up):
    heads = [named(page.text(cols[0], a, cols[-1], b), HEADS) for a, b in zip(rows, rows[1:])]
    head = heads.index(True) + 1 if True in heads else 0
    if head > 1 or (head == 1 and up):
        rows = rows[: head + 1]
    x0, x1, y0, y1 = cols[0], cols[-1], rows[0], rows[-1]
    text = page.text(x0, y0, x1, y1)
    full = 0
    for a, b in zip(rows, rows[1:]):
        inner = lambda x, y: x0 + 0.5 <= x <= x1 - 0.5 and a + 0.5 <= y <= b - 0.5  # noqa: E731, B023
        full += any(inner(x, y) for x, y, _ in page.words) or any(inner(m[0], m[1]) and inner(m[2], m[3]) for m in page.marks)
    sure, low = y0 < region[1] - TOL, y1 >= region[3] - TOL
    mark = head > 0 or numbered(page, rows, cols)
    if side:
        sure = sure or mark or (not text and low and sum(y > band[-1] + TOL for y in rows) >= 2)
        if low and not mark and (text or len(rows) - 1 < 6):
            return None
    if not (y0 <= region[1] + TOL < y1) or (low and not side) or full < 2 or (named(text, REVISIONS) and not named(text, PARTS)):
        return None
    if not (sure or (not side and (head > 0 or not text))):
        return None
    return x0, y0, x1, y1, len(rows) - 1, sure, side, tuple(rows)


def part_lists(page, region):
    half = 0.5 * (region[2] - region[0])
    ys = [
        y for y in page.heights
        if sum(hi - lo for lo, hi in page.spans[y]) >= half and min(page.spans[y][-1][1], region[2]) - max(page.spans[y][0][0], region[0]) >= half and page.frame[1] - TOL <= y <= region[3] + TOL
    ]
    out, end = [], -1
    for i in range(len(ys) - 2):
        g, run, stray = ys[i + 1] - ys[i], ys[i : i + 2], None
        for y in ys[i + 2 :]:
            if near(run[-1], y, g):
                run, stray = [*run, y], None
            elif stray is None:
                stray = y
            else:
                break
        while len(run) >= 3 and len(page.through(run[0], run[-1], region)) < 4:
            run = run[:-1]
        if len(run) < 3 or g <= 2 * TOL or i < end:
            continue
        end = ys.index(run[-1])
        cols = page.through(run[0], run[-1], region)
        common = [(-1e9, 1e9)]
        for y in run:
            common = [(max(a, c), min(b, d)) for a, b in common for c, d in page.spans[y] if min(b, d) > max(a, c)]
        groups = [c for c in ([x for x in cols if lo - TOL <= x <= hi + TOL] for lo, hi in sorted(common)) if len(c) >= 4 and c != cols]
        found = None
        if groups:
            tall = [(grow(page, region, run, c, g), c) for c in groups]
            told = lambda r, c: any(named(page.text(c[0], a, c[-1], b), HEADS) for a, b in zip(r, r[1:])) or numbered(page, r, c)
            ranked = sorted(((-len(r), not told(r, c), c[0] - c[-1], c, r) for r, c in tall))
            best = ranked[0]
            if (len(ranked) == 1 or best[:2] != ranked[1][:2]) and (best[3][0] > region[0] + TOL or best[3][-1] < region[2] - TOL):
                found = verdict(page, region, best[4], best[3], run, True, best[4][0] < run[0] - TOL)
        if not found:
            up = i > 0 and persists(page, region, ys[i - 1], ys[i], cols, False)
            rows = ([ys[i - 1]] if up and ys[i] - ys[i - 1] < 3 * g else []) + run
            if end + 1 < len(ys) and ys[end + 1] - ys[end] < 3 * g and persists(page, region, ys[end], ys[end + 1], cols, False):
                text = page.text(cols[0], ys[end], cols[-1], ys[end + 1])
                if named(text, HEADS) or (not text and ys[end + 1] - ys[end] <= 1.5 * g):
                    rows = [*rows, ys[end + 1]]
            found = verdict(page, region, rows, cols, run, False, up)
        if found:
            out.append(found)
    return out
