"""Merging and clipping of one page's blocks by plain loops, one merge at a time."""

from rivulet.operators.clips import AROUND, EDGE, FRAME, MANY, MARGIN, THIN, TOUCH


def pad(r, d):
    return (r[0] - d, r[1] - d, r[2] + d, r[3] + d)


def meet(a, b):
    return (max(a[0], b[0]), max(a[1], b[1]), min(a[2], b[2]), min(a[3], b[3]))


def hull(a, b):
    return (min(a[0], b[0]), min(a[1], b[1]), max(a[2], b[2]), max(a[3], b[3]))


def area(r):
    return max(0.0, r[2] - r[0]) * max(0.0, r[3] - r[1])


def over(a, b):
    i = meet(a, b)
    return i[2] > i[0] and i[3] > i[1]


def inside(a, b):
    return b[0] >= a[0] and b[1] >= a[1] and b[2] <= a[2] and b[3] <= a[3]


def merged(blocks):
    """blocks: id -> [(prim, rect, rule)]; the number of merges comes second."""
    n = 0
    while True:
        pair = next(
            ((min(a, b), max(a, b)) for a in sorted(blocks) for b in sorted(blocks) if a != b and any(over(pad(m[1], TOUCH), p[1]) for m in blocks[a] for p in blocks[b] if not p[2])), None
        )
        if pair is None:
            return blocks, n
        blocks[pair[0]] = blocks[pair[0]] + blocks.pop(pair[1])
        n += 1


def without(r, c):
    if not over(r, c):
        return [r]
    i = meet(r, c)
    parts = [(r[0], r[1], r[2], i[1]), (r[0], i[3], r[2], r[3]), (r[0], i[1], i[0], i[3]), (i[2], i[1], r[2], i[3])]
    return [p for p in parts if p[2] - p[0] > 0.01 and p[3] - p[1] > 0.01]


def clips(blocks, furniture, page, inner):
    out = {}
    for name, own in blocks.items():
        box = own[0][1]
        for m in own:
            box = hull(box, m[1])
        c = meet(pad(box, MARGIN), page)
        flags, cuts = set(), []
        others = sorted((False, *p) for b, ms in blocks.items() if b != name for p in ms) + sorted((True, *p) for p in furniture)
        for furn, _, r, rule in others:
            if not over(c, r):
                continue
            if not any(over(pad(m[1], TOUCH), r) for m in own):
                cuts.append(pad(r, AROUND))
            elif furn:
                flags.add("SHARES_RULE_WITH_FURNITURE" if rule else "INTERLEAVES_FURNITURE")
        pieces = [c]
        for x in cuts:
            pieces = [q for p in pieces for q in without(p, x)]
        pieces = [p for p in pieces if any(over(p, m[1]) for m in own)] or [c]
        ink = lambda k: any(over(pad(k, -EDGE), m[1]) for m in own)  # noqa: E731, B023
        again = len(pieces) > 1
        while again:
            again = False
            for i, k in enumerate(pieces):
                for j, q in enumerate(pieces):
                    g, rest = hull(q, k), [o for n, o in enumerate(pieces) if n not in (i, j)]
                    if i != j and not ink(k) and not any(area(meet(g, x)) > 1e-6 for x in [*cuts, *rest]):
                        pieces, again = [*rest, g], True
                        break
                if again:
                    break
        if len(pieces) > MANY:
            flags.add("FRAGMENTED_CLIP")
        lim = pad(inner, FRAME)
        if any(not inside(lim, k) for k in pieces):
            small = lambda k: k[2] - k[0] <= THIN or k[3] - k[1] <= THIN or not ink(k)
            kept = [meet(k, lim) for k in pieces if not small(meet(k, lim))]
            lost = any(not m[2] and not inside(lim, m[1]) and any(over(k, m[1]) for k in pieces) for m in own)
            lost = lost or any(small(meet(k, lim)) and any(over(meet(k, inner), m[1]) for m in own) for k in pieces)
            if kept and not lost:
                pieces = kept
            else:
                flags.add("BLOCK_ENTERS_FRAME_BAND")
        out[name] = (pieces, flags)
    return out
