"""Footer ledgers, part lists, reading order, clips and layouts against small cases and brute force."""

import json

import pytest
from pyspark.sql import functions as F

from rivulet.operators import footer

LEDGER = {"linear_tolerances": [{"tier": "X", "value": "±1"}], "angular_tolerances": [], "additional_tolerance_conditions": ["a note", {"text": "another"}]}


def _faults(spark, *ledgers):
    rows = [(i, x if x is None or isinstance(x, str) else json.dumps(x)) for i, x in enumerate(ledgers)]
    out = footer.parsed(spark.createDataFrame(rows, "id int, ledger string"), "ledger")
    return [tuple(r["faults"]) for r in out.orderBy("id").collect()]


def test_ledger_faults(spark):
    less = {k: v for k, v in LEDGER.items() if k != "angular_tolerances"}
    got = _faults(
        spark, LEDGER, None, "[1]", "{oops", LEDGER | {"odd": []}, less, LEDGER | {"linear_tolerances": {"tier": "X"}}, LEDGER | {"linear_tolerances": [{"tier": "X"}]},
        LEDGER | {"linear_tolerances": [{"tier": "X", "value": 1}]}, LEDGER | {"linear_tolerances": [{"tier": " X", "value": "1"}]}, LEDGER | {"additional_tolerance_conditions": [""]},
        {k: [] for k in LEDGER}, LEDGER | {"additional_tolerance_conditions": [{"text": "a", "more": "b"}]}, LEDGER | {"linear_tolerances": [{"tier": "X", "value": "a\tb"}]},
    )
    assert got == [
        (), ("not an object",), ("not an object",), ("not an object",), ("unknown odd",), ("missing angular_tolerances",), ("missing linear_tolerances",), ("entry linear_tolerances",),
        ("entry linear_tolerances",), ("text linear_tolerances",), ("text additional_tolerance_conditions",), ("empty",), ("entry additional_tolerance_conditions",), ("text linear_tolerances",),
    ]


def _plan(spark, linear, angular, conditions, box=(0.0, 0.0, 88.0, 71.0)):
    pair = lambda rows: [{"tier": a, "value": b} for a, b in rows]
    text = json.dumps({"linear_tolerances": pair(linear), "angular_tolerances": pair(angular), "additional_tolerance_conditions": conditions})
    df = footer.parsed(spark.createDataFrame([(text, *box)], "ledger string, x0 double, y0 double, x1 double, y1 double"), "ledger")
    return footer.arranged(df).first()


def test_footer_keeps_order_and_repeats(spark):
    four = [("X.", "±0.3"), ("X.", "±0.3"), ("X.X", "±0.2"), ("X.", "±0.1")]
    p = _plan(spark, four, four, [])
    assert p["fault"] is None and p["mode"] == "category_columns" and p["size"] >= 4.75
    assert [i["text"] for i in p["items"]] == [f"{a} {b}" for a, b in four] * 2
    assert len({(i["x"], i["y"]) for i in p["items"]}) == 8
    p = _plan(spark, [("X.", "1")] * 5, [], ["same", "same"], (0.0, 0.0, 88.0, 90.0))
    assert p["mode"] == "single_column" and [i["kind"] for i in p["items"]] == ["linear"] * 5 + ["condition"] * 2
    p = _plan(spark, [("X.", "1")] * 8, [], [])
    assert p["mode"] == "flow_columns" and p["items"][3]["x"] < p["items"][4]["x"] and p["items"][0]["y"] == p["items"][4]["y"]


@pytest.mark.parametrize("box,linear,fault", [((0.0, 0.0, 0.0, 71.0), 1, "box"), ((0.0, 0.0, 88.0, float("inf")), 1, "box"), ((0.0, 0.0, 88.0, 37.0), 1, "heading"), ((0.0, 0.0, 60.0, 71.0), 1, "heading"), ((0.0, 0.0, 88.0, 71.0), 20, "overflow")])
def test_footer_faults(spark, box, linear, fault):
    p = _plan(spark, [("X", "1")] * linear, [], [], box)
    assert p["fault"] == fault and p["items"] is None and p["mode"] is None


def test_footer_glyph(spark):
    assert _plan(spark, [("X", "公差")], [], [])["fault"] == "glyph"


def test_footer_audit(spark):
    rows = [(0, ["a", "b", "b"], ["b", "a", "b"]), (1, ["a", "b", "b"], ["a", "b"]), (2, ["a"], ["a", "x"]), (3, None, None), (4, ["a"], None)]
    got = footer.audited(spark.createDataFrame(rows, "id int, e array<string>, a array<string>"), "e", "a").orderBy("id").collect()
    assert [(r["missing"], r["unexpected"], r["passed"]) for r in got] == [([], [], True), (["b"], [], False), ([], ["x"], False), ([], [], True), (["a"], [], False)]


# -- part lists ------------------------------------------------------------------------------------------------------

BOX = "x0 double, y0 double, x1 double, y1 double"


def _rule(page, x0, y0, x1, y1):
    return (page, "H", float(y0), float(x0), float(x1)) if y0 == y1 else (page, "V", float(x0), float(y0), float(y1))


def _frame(page):
    return [_rule(page, 20, 20, 820, 20), _rule(page, 20, 575, 820, 575), _rule(page, 20, 20, 20, 575), _rule(page, 820, 20, 820, 575)]


class _Sheet:
    """A page's rules, words and marks."""

    def __init__(self, page):
        self.page, self.rules, self.words, self.marks = page, _frame(page), [], []

    def line(self, *xy):
        self.rules.append(_rule(self.page, *xy))

    def write(self, x, y, text):
        for t in text.split():
            self.words.append((self.page, len(self.words), float(x), y - 8.0, x + 5.0 * len(t), y + 1.0, t))
            x += 5 * len(t) + 3


def _list_above(page, n, head="NO. NAME MATERIAL QTY", row="{n} PART{k}"):
    """A list of n rows on top of a title block at the lower right."""
    s, top = _Sheet(page), 460 - 15 * n
    for y in (460, 490, 520, 545):
        s.line(500, y, 820, y)
    s.line(500, 460, 500, 575)
    s.line(640, 490, 640, 575)
    for k in range(n + 1):
        s.line(500, top + 15 * k, 820, top + 15 * k)
    for x in (500, 540, 680, 740, 820) if n else ():
        s.line(x, top, x, 460)
    for k in range(n - 1):
        s.write(505, top + 15 * k + 11, row.format(n=n - 1 - k, k=k))
    s.write(505, 456, head)
    s.write(505, 480, "DRAWN CHECKED")
    return s


def _list_beside(page, words=True):
    """A list of ten rows at the left of a title block that shares its upper rules."""
    s = _Sheet(page)
    for k in range(11):
        s.line(20, 425 + 15 * k, 320, 425 + 15 * k)
    for x, y in ((320, 425), (450, 440), (320, 455), (320, 470), (320, 490), (320, 530)):
        s.line(x, y, 820, y)
    for x in (45, 200, 260, 320):
        s.line(x, 425, x, 575)
    for x in (450, 600, 700):
        s.line(x, 425, x, 490)
    s.line(560, 490, 560, 575)
    for k in range(10):
        if not words:
            s.marks.append((page, 28.0, 430.0 + 15 * k, 34.0, 434.0 + 15 * k))
        elif k < 9:
            s.write(25, 436 + 15 * k, f"{9 - k}")
            s.write(50, 436 + 15 * k, f"PART{k}")
        else:
            s.write(25, 571, "NO. NAME MATERIAL QTY")
    s.write(330, 450, "REV DATE")
    s.write(330, 510, "DRAWN CHECKED")
    return s


def _tables(spark, sheets, regions):
    make = lambda rows, schema: spark.createDataFrame(rows, schema)
    return {
        "rules": make([x for s in sheets for x in s.rules], "page_id int, orient string, coord double, lo double, hi double"),
        "words": make([x for s in sheets for x in s.words], f"page_id int, pos long, {BOX}, text string"),
        "marks": make([x for s in sheets for x in s.marks], f"page_id int, {BOX}"),
        "regions": make([(s.page, 0, *map(float, r)) for s, r in zip(sheets, regions)], f"page_id int, region_id int, {BOX}"),
        "frames": make([(s.page, 20.0, 20.0, 820.0, 575.0) for s in sheets], f"page_id int, {BOX}"),
    }


def _brute(t):
    from brute_lists import Page
    from brute_lists import part_lists as lists

    rows = {k: [tuple(r) for r in v.collect()] for k, v in t.items()}
    of = lambda k, p: [r[1:] for r in rows[k] if r[0] == p]
    frames = {r[0]: r[1:] for r in rows["frames"]}
    by_page = {p: Page(of("rules", p), of("words", p), of("marks", p), frames[p]) for p in frames}
    return sorted((p, i, *x) for p, i, *box in rows["regions"] for x in lists(by_page[p], box))


def _found(lists):
    return sorted((r["page_id"], r["region_id"], r["x0"], r["y0"], r["x1"], r["y1"], r["n_rows"], r["sure"], r["side"], tuple(r["rows"])) for r in lists.collect())


def test_part_lists(spark):
    from rivulet.operators import graph, partlists

    sheets = [_list_above(1, 6), _list_beside(2), _list_beside(3, False), _list_beside(4), _list_above(5, 0), _list_above(6, 3), _list_above(7, 4, "REV DESCRIPTION DATE", "A{k} 2021-09-17")]
    t = _tables(spark, sheets, [(500, 430, 820, 575), (20, 425, 820, 575), (20, 425, 820, 575), (20, 470, 820, 575), (500, 460, 820, 575), (500, 415, 820, 575), (500, 430, 820, 575)])
    lists = graph.written(partlists.part_lists(**t, keys=["page_id"]))
    got = _found(lists)
    assert got == _brute(t)
    assert [(g[0], g[4], g[5], *g[6:9]) for g in got] == [(1, 820, 460, 6, True, False), (2, 320, 575, 10, True, True), (3, 320, 575, 10, True, True), (4, 320, 575, 10, True, True), (6, 820, 460, 3, False, False)]
    cut = lambda some: {r["page_id"]: (r["piece"], r["x0"], r["y0"], r["x1"], r["y1"]) for r in partlists.cleared(t["regions"], some, t["rules"], t["frames"], ["page_id"]).collect()}
    sure = cut(lists.filter("sure"))
    assert sure == {
        1: (0, 500, 460, 820, 575), 2: (0, 320, 425, 820, 575), 3: (0, 320, 425, 820, 575), 4: (0, 320, 455, 820, 575),
        5: (0, 500, 460, 820, 575), 6: (0, 500, 415, 820, 575), 7: (0, 500, 430, 820, 575),
    }
    assert cut(lists)[6] == (0, 500, 460, 820, 575)


def test_part_lists_of_the_query_equal_brute_force(spark, sf_dir):
    from rivulet.plans import boards
    from rivulet.sources import views

    got = _found(boards.part_lists(spark, sf_dir))
    want = _brute(views.list_sheets(spark, sf_dir))
    assert got == want
    assert len({g[7:9] for g in got}) > 1 and any(g[8] and g[2] > 20 for g in got)  # also lists beside another, at the right


def test_no_rules_no_lists(spark):
    from rivulet.operators import partlists

    s = _Sheet(1)
    s.rules = []
    t = _tables(spark, [s], [(500, 430, 820, 575)])
    lists = partlists.part_lists(**t, keys=["page_id"])
    assert lists.count() == 0
    assert partlists.cleared(t["regions"], lists, t["rules"], t["frames"], ["page_id"]).count() == 1


# -- reading ---------------------------------------------------------------------------------------------------------


def test_reading_order_rows_grow_with_their_members(spark):
    from rivulet.operators import reading

    # b overlaps a by little, c by much: b joins the row only through c, which must be there before it
    boxes = [("p", 1, 50.0, 0.0, 60.0, 10.0), ("p", 2, 0.0, 6.0, 10.0, 16.0), ("p", 3, 20.0, 9.0, 30.0, 19.0), ("p", 4, 0.0, 30.0, 9.0, 30.0), ("p", 5, 5.0, 100.0, 9.0, 110.0), ("q", 6, 5.0, None, 9.0, 110.0)]
    got = reading.reading_order(spark.createDataFrame(boxes, f"k string, id int, {BOX}"), ["k"], "id").orderBy("place").collect()
    assert [(r["id"], r["row"]) for r in got] == [(2, 1), (3, 1), (1, 1), (4, 2), (5, 3)]


def test_line_neighbours_of_very_different_sizes(spark):
    import random

    from rivulet.operators import reading

    rng = random.Random(5)
    spans = []
    for i in range(400):
        size, x, y = rng.choice([0.2, 0.6, 1.0, 4.0, 7.9, 8.1, 16.0, 64.0]) + rng.choice([0, 0.3]), rng.uniform(-50, 300), rng.uniform(0, 60)
        spans.append((1, i, x, y, x + rng.uniform(0, 3 * size), y + size, size))
    got = {(r["a_id"], r["b_id"]) for r in reading.line_neighbours(spark.createDataFrame(spans, f"k int, id int, {BOX}, size double"), ["k"], "id").collect()}
    want = set()
    for a in spans:
        for b in spans:
            ca, cb = (a[3] + a[5]) / 2, (b[3] + b[5]) / 2
            before = (round(ca), a[2], a[1]) < (round(cb), b[2], b[1])
            if before and abs(ca - cb) < 0.3 * a[6] and abs(a[6] - b[6]) < 0.5 and -1 < b[2] - a[4] < 3 * a[6]:
                want.add((a[1], b[1]))
    assert got == want and len(want) > 20


# -- clips -----------------------------------------------------------------------------------------------------------


def _brute_clips(t):
    from brute_clips import clips, merged

    rows = {k: [r.asDict() for r in v.collect()] for k, v in t.items()}
    box = lambda r, p="": tuple(r[f"{p}{s}"] for s in ("x0", "y0", "x1", "y1"))
    merges, out = {}, {}
    for page in rows["pages"]:
        p, blocks = page["page_id"], {}
        for r in rows["members"]:
            if r["page_id"] == p:
                blocks.setdefault(r["block"], []).append((r["prim_id"], box(r), r["rule"]))
        if blocks:
            blocks, merges[p] = merged(blocks)
        furniture = [(r["prim_id"], box(r), r["rule"]) for r in rows["furniture"] if r["page_id"] == p]
        for b, (pieces, flags) in clips(blocks, furniture, box(page), box(page, "i_")).items():
            out[p, b] = (sorted(pieces), sorted(flags))
    return merges, out


def test_clips_equal_brute_force(spark):
    import random

    from rivulet.operators import clips

    rng, members, furniture = random.Random(3), [], []
    for page in range(12):
        for i in range(45):
            b = rng.randrange(5)
            x, y, rule = b % 3 * 90 + rng.uniform(0, 70), b // 3 * 80 + rng.uniform(0, 55), rng.random() < 0.2
            w, h = (rng.uniform(20, 60), 0.6) if rule else (rng.uniform(0.3, 9), rng.uniform(0.3, 7))
            if rng.random() < 0.06:
                b = (b + 1) % 5
            row = (i, rule, x, y, x + w, y + h)
            if rng.random() < 0.15:
                furniture.append((page, *row))
            else:
                members.append((page, b, *row))
    pages = [(p, 0.0, 0.0, 300.0, 160.0, 3.0, 3.0, 260.0 if p % 2 else 240.0, 150.0) for p in range(12)]
    t = {
        "members": spark.createDataFrame(members, f"page_id int, block int, prim_id int, rule boolean, {BOX}"),
        "furniture": spark.createDataFrame(furniture, f"page_id int, prim_id int, rule boolean, {BOX}"),
        "pages": spark.createDataFrame(pages, f"page_id int, {BOX}, i_x0 double, i_y0 double, i_x1 double, i_y1 double"),
    }
    whole, report = clips.merge_interleaved(t["members"], ["page_id"], bound=2)
    merges, want = _brute_clips(t)
    assert {r["page_id"]: (r["merges"], r["beyond"]) for r in report.collect()} == {p: (n, n >= 2) for p, n in merges.items()}
    got = {(r["page_id"], r["block"]): (sorted(tuple(c) for c in r["clips"]), sorted(r["flags"])) for r in clips.block_clips(whole, t["furniture"], t["pages"], ["page_id"]).collect()}
    assert got == want
    assert max(merges.values()) > 0 and max(len(v[0]) for v in want.values()) > 2 and len({f for v in want.values() for f in v[1]}) >= 3


def test_clips_of_the_query_equal_brute_force(spark, sf_dir):
    from rivulet.plans import boards
    from rivulet.sources import views

    merges, want = _brute_clips(views.block_pieces(spark, sf_dir))
    assert {r["page_id"]: r["merges"] for r in boards.interleaved_blocks(spark, sf_dir).collect()} == merges
    got = {}
    for r in boards.block_clips(spark, sf_dir).collect():
        got.setdefault((r["page_id"], r["block"]), []).append((r["x0"], r["y0"], r["x1"], r["y1"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: v[0] for k, v in want.items()}


# -- layout ----------------------------------------------------------------------------------------------------------


def test_layout_search_equals_exhaustive_search(spark):
    import random

    from brute_layout import layout

    from rivulet.operators import arrangement

    rng, rows, sheets, pages = random.Random(11), [], [], {}
    for p in range(40):
        frame = (4.0, 3.0, 4.0 + rng.choice([44, 60, 80]), 3.0 + rng.choice([34, 48, 60]))
        reserved = [(frame[2] - 16, frame[3] - 10, frame[2], frame[3])]
        views = {}
        for i in range(rng.randint(1, 6)):
            x, y, w, h = rng.randint(0, 70), rng.randint(0, 50), rng.randint(4, 24), rng.randint(4, 20)
            rects = [(x, y, x + w, y + h)] if rng.random() < 0.6 else [(x, y, x + w, y + 3), (x, y + 2, x + 3, y + h)]
            views[i] = ([tuple(map(float, r)) for r in rects], False, 7.0)
        if p % 3 == 0:
            views[9] = ([(90.0, 5.0, 90.0 + 20, 5.0 + 20)], True, 7.0)
        pages[p] = {"frame": frame, "source": (0.0, 0.0, 100.0, 72.0), "reserved": reserved, "rail_width": 10.0, "least_font": 1.5, "views": views}
        rows += [(p, i, rail, font, *r) for i, (rects, rail, font) in views.items() for r in rects]
        sheets.append((p, 0.0, 0.0, 100.0, 72.0, *frame, [tuple(map(float, r)) for r in reserved], 10.0, 1.5))
    sides = lambda c: ", ".join(f"{c}_{s} double" for s in ("x0", "y0", "x1", "y1"))
    out = arrangement.arranged(
        spark.createDataFrame(rows, f"page_id int, view_id long, rail boolean, font double, {BOX}"),
        spark.createDataFrame(sheets, f"page_id int, {sides('s')}, {sides('f')}, reserved array<struct<x0:double,y0:double,x1:double,y1:double>>, rail_width double, least_font double"),
        ["page_id"],
    )
    got = sorted(tuple(r) for r in out.collect())
    want = sorted((p, *r) for p, page in pages.items() for r in layout({**page, "reserved": [tuple(map(float, r)) for r in page["reserved"]]}))
    by_page = lambda rows: {p: [r for r in rows if r[0] == p] for p in pages}
    a, b = by_page(got), by_page(want)
    assert {p: (a[p], b[p]) for p in pages if a[p] != b[p]} == {}
    modes = {r[2] for r in want}
    assert len(modes) > 1 and len({r[0] for r in want}) < len(pages)  # some pages have no arrangement


# -- queries that follow from rounds ---------------------------------------------------------------------------------


def test_overlap_merge_query(spark, sf_dir):
    from rivulet.plans import geometry
    from rivulet.sources import views

    pages = {}
    for r in views.boxes(spark, sf_dir).filter("x1 > x0 AND y1 > y0").collect():
        pages.setdefault(r["page_id"], []).append([r["box_id"], (r["x0"], r["y0"], r["x1"], r["y1"]), 1])
    area = lambda b: max(0, b[2] - b[0]) * max(0, b[3] - b[1])
    want = set()
    for page, blocks in pages.items():
        found = True
        while found:
            found = None
            for i, (a, p, _) in enumerate(blocks):
                for j, (b, q, _) in enumerate(blocks[i + 1 :], i + 1):
                    if area((max(p[0], q[0]), max(p[1], q[1]), min(p[2], q[2]), min(p[3], q[3]))) > 0.2 * min(area(p), area(q)):
                        found = i, j
                        break
                if found:
                    break
            if found:
                (a, p, n), (b, q, m) = blocks[found[0]], blocks.pop(found[1])
                blocks[found[0]] = [min(a, b), (min(p[0], q[0]), min(p[1], q[1]), max(p[2], q[2]), max(p[3], q[3])), n + m]
        want |= {(page, a, *p, n) for a, p, n in blocks}
    got = {(r["page_id"], r["block"], r["x0"], r["y0"], r["x1"], r["y1"], r["n"]) for r in geometry.overlap_merge(spark, sf_dir).collect()}
    assert got == want


@pytest.mark.parametrize("name,width,height,corner", [("largest_scale", 400, 300, None), ("house_scale", 300, 220, (180, 120))])
def test_largest_scale_queries(spark, sf_dir, name, width, height, corner):
    from rivulet.plans import sheets
    from rivulet.sources import views

    pages = {}
    for r in views.boxes(spark, sf_dir).filter("x1 > x0 AND y1 > y0").orderBy("box_id").collect():
        pages.setdefault(r["box_id"] // 20, []).append((r["x1"] - r["x0"], r["y1"] - r["y0"]))

    def fits(sizes, s):
        x, y, tall = 0.0, 0.0, 0.0
        for w, h in ((w * s, h * s) for w, h in sizes):
            end = lambda y, h: corner[0] if corner and y + h > corner[1] else width
            if x and x + w > end(y, max(tall, h)):
                x, y, tall = 0.0, y + tall + 12, 0.0
            if x + w > end(y, h) or y + h > height:
                return False
            x, tall = x + w + 12, max(tall, h)
        return True

    got = {r["page_id"]: r["scale"] for r in getattr(sheets, name)(spark, sf_dir).collect()}
    assert got.keys() == pages.keys()
    for p, sizes in pages.items():
        low, high = (0.2 if corner else 0.0), 30.0
        for _ in range(40):
            mid = (low + high) / 2
            low, high = (mid, high) if fits(sizes, mid) else (low, mid)
        assert got[p] == pytest.approx(low, rel=1e-12)
    assert len(set(got.values())) > 1


def test_star_cluster_query(spark, sf_dir):
    from test_operators import greedy_stars

    from rivulet.operators import matching
    from rivulet.plans import geometry
    from rivulet.sources import views

    items = views.fingerprints(spark, sf_dir)
    ids = sorted(r["id"] for r in items.select("id").collect())
    place = {v: i for i, v in enumerate(ids)}
    sims = {(place[r["a"]], place[r["b"]]): r["sim"] for r in matching.pair_similarity(items, 0.0).collect()}
    want = greedy_stars(len(ids), sims, [0.0] * len(ids), 0.8)
    groups = {}
    for r in geometry.star_cluster(spark, sf_dir).collect():
        groups.setdefault((r["group_no"], place[r["representative"]]), []).append(place[r["id"]])
    assert [(k[1], sorted(groups[k])) for k in sorted(groups)] == want


# -- house sheet -----------------------------------------------------------------------------------------------------


def test_stacked_column_query(spark, sf_dir):
    from rivulet.operators import house as rules
    from rivulet.plans import house, proofs

    members, rail, content = (proofs.frame(spark, sf_dir, n) for n in ("h_members", "h_rail", "h_content"))
    inside = {(r["page_id"], r["block"]) for r in rail.filter("in_rail").collect()}
    pages = {}
    for r in rules.block_facts(members, content, ["page_id"]).collect():
        if (r["page_id"], r["block"]) in inside:
            pages.setdefault(r["page_id"], []).append([r["block"], (r["x0"], r["y0"], r["x1"], r["y1"]), r["table"], r["block"] == 8])
    want = {}
    for page, units in pages.items():
        again = True
        while again:
            again = False
            for i, a in enumerate(units):
                for b in units[i + 1 :]:
                    p, q = a[1], b[1]
                    if min(p[2], q[2]) > max(p[0], q[0]) and min(p[3], q[3]) > max(p[1], q[1]):
                        a[:] = [min(a[0], b[0]), (min(p[0], q[0]), min(p[1], q[1]), max(p[2], q[2]), max(p[3], q[3])), a[2] or b[2], a[3] or b[3]]
                        units.remove(b)
                        again = True
                        break
                if again:
                    break
        units.sort(key=lambda u: (not u[3], not u[2], u[1][1], u[0]))
        w, h = max(u[1][2] - u[1][0] for u in units), sum(u[1][3] - u[1][1] for u in units) + 0.0
        scale = min(280 / w, 380 / (h + 8 * (len(units) - 1)), 1.2 if page % 2 == 0 else 1e9)
        y = 20.0
        for n, u in enumerate(units, 1):
            want[page, u[0]] = (n, scale, 800 - (u[1][2] - u[1][0]) * scale, y)
            y += (u[1][3] - u[1][1]) * scale + 8
    got = {(r["page_id"], r["unit"]): (r["place"], r["scale"], r["x"], r["y"]) for r in house.stacked_column(spark, sf_dir).collect()}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)
    assert max(v[0] for v in want.values()) > 1


def test_blocks_of_the_column(spark):
    from rivulet.operators import house

    text = lambda b, x, y: [(1, b, b * 100 + i, x + 4.0 * i, y, x + 4.0 * i + 3, y + 4, False) for i in range(6)]
    tall = lambda b, x, y: [(1, b, b * 100, x, y, x + 40, y + 60, False)]
    rules = lambda b, x, y: [(1, b, b * 100 + i, x, y + 9.0 * i, x + 60, y + 9.0 * i, True) for i in range(5)] + [(1, b, b * 100 + 9, x, y, x + 1, y + 36, False)]
    rows = [*tall(0, 100.0, 10.0), *text(1, 400.0, 10.0), *tall(2, 400.0, 100.0), *text(3, 441.0, 120.0), *text(4, 405.0, 165.0), *rules(5, 400.0, 250.0), *text(6, 300.0, 200.0)]
    members = spark.createDataFrame(rows, f"page_id int, block int, prim_id int, {BOX}, rule boolean")
    rail = spark.createDataFrame([(1, b, b > 0) for b in range(7)], "page_id int, block int, in_rail boolean")
    content = spark.createDataFrame([(1, 0.0, 0.0, 500.0, 300.0)], f"page_id int, {BOX}")
    got = {r["block"]: r["stays"] for r in house.column_blocks(members, rail, content, ["page_id"]).collect()}
    assert got == {1: True, 2: False, 3: False, 4: False, 5: True, 6: True}  # 3 touches the drawing, 4 is its caption
    alone = {r["block"]: r["stays"] for r in house.column_blocks(members.filter("block IN (0, 2)"), rail.filter("block IN (0, 2)"), content, ["page_id"]).collect()}
    assert alone == {2: True}  # else the column would be empty


# -- proofs, caches, ledgers: small cases ----------------------------------------------------------------------------


def test_cache_entries_that_do_not_hold_are_made_anew(spark, tmp_path):
    from rivulet.operators import cache

    made = []

    def make(df):
        made.append(sorted(r["a"] or 0 for r in df.collect()))
        return df.withColumn("v", F.concat(F.lit("v"), F.coalesce(F.col("a").cast("string"), F.lit("none"))))

    df = spark.createDataFrame([(1, "x"), (2, "y"), (2, "z"), (None, "w")], "a int, b string")
    path = str(tmp_path / "c")
    got = lambda out: sorted((r["b"], r["v"], r["hit"]) for r in out.collect())
    assert got(cache.cached(df, path, ["a"], make, "v", "1")) == [("w", "vnone", False), ("x", "v1", False), ("y", "v2", False), ("z", "v2", False)]
    assert made[0] == [0, 1, 2]  # equal inputs once
    assert got(cache.cached(df, path, ["a"], make, "v", "1")) == [("w", "vnone", True), ("x", "v1", True), ("y", "v2", True), ("z", "v2", True)]
    rows = spark.read.parquet(path)
    broken = rows.withColumn("value", F.when(F.col("value") == "v2", F.lit("v9")).otherwise(F.col("value")))
    broken.write.parquet(str(tmp_path / "d"))
    assert got(cache.cached(df, str(tmp_path / "d"), ["a"], make, "v", "1")) == [("w", "vnone", True), ("x", "v1", True), ("y", "v2", False), ("z", "v2", False)]
    assert made[2] == [2]
    assert not any(h for _, _, h in got(cache.cached(df, path, ["a"], make, "v", "2")))  # another version
    assert cache.cached(df.limit(0), path, ["a"], make, "v", "1").count() == 0


def test_removal_proof_small_cases(spark):
    from rivulet.operators import proofs

    ops = [(d, i, f"op{i}") for d in "abcdef" for i in range(10)]
    removed = [("a", 3), ("b", 3), ("c", 3), ("c", 3), ("d", 99), ("e", 3), ("f", 9)]
    kept = lambda d, gone: [(d, n, f"op{i}") for n, i in enumerate(i for i in range(10) if i not in gone)]
    out = kept("a", {3}) + kept("b", {3, 7}) + kept("c", {3}) + kept("d", {99}) + [(d, i, "changed" if i == 0 else op) for d, i, op in kept("e", {3})] + kept("f", set()) + [("g", 0, "new")]
    make = lambda rows, s: spark.createDataFrame(rows, s)
    got = proofs.removal_proof(make(ops, "k string, idx long, op string"), make(removed, "k string, idx long"), make(out, "k string, idx long, op string"), "k", 4)
    want = {"a": (True, None), "b": (False, 6), "c": (False, None), "d": (False, None), "e": (False, 0), "f": (False, 9), "g": (False, 0)}
    assert {r["k"]: (r["equal"], r["first_difference"]) for r in got.collect()} == want


def test_targets_of_a_removal(spark):
    from rivulet.operators import proofs

    names = ["q", "BT", "Tf", "Tj", "Tj", "ET", "BT", "TJ", "ET", "Q"]
    source = spark.createDataFrame([("a", i, n) for i, n in enumerate(names)], "k string, idx long, name string")
    found = lambda targets, removed: sorted(
        (r["start"], r["finding"]) for r in proofs.target_findings(source, spark.createDataFrame(targets, "k string, start long, last long, shows array<bigint>"), spark.createDataFrame(removed, "k string, idx long"), "k").collect()
    )
    assert found([("a", 1, 5, [3, 4])], [("a", 3), ("a", 4)]) == []
    assert found([("a", 1, 5, [3])], [("a", 3)]) == [(1, "shows")]
    assert found([("a", 6, 8, [7])], [("a", 7)]) == [(6, "operator")]
    assert found([("a", 2, 5, [3, 4])], [("a", 3), ("a", 4)]) == [(2, "range")]
    assert [r["finding"] for r in proofs.target_findings(source, spark.createDataFrame([("a", 1, 5, [3, 4])], "k string, start long, last long, shows array<bigint>"), spark.createDataFrame([("a", 3)], "k string, idx long"), "k").collect()] == ["removed"]


def test_placements_in_two_groups(spark):
    from rivulet.operators import proofs

    groups = spark.createDataFrame([(1, 1, 0.0, 0.0, 10.0, 10.0, 5.0, 5.0, 1.0), (1, 2, 0.0, 0.0, 20.0, 10.0, 5.0, 5.0, 1.0)], f"p int, group_id int, {BOX}, dst_x double, dst_y double, scale double")
    places = spark.createDataFrame([(1, 7, 0.0, 0.0, 10.0, 10.0, 5.0, 5.0, 15.0, 15.0, 1.0), (2, 8, 0.0, 0.0, 1.0, 1.0, 0.0, 0.0, 1.0, 1.0, 1.0)], f"p int, place_id int, {BOX}, t_x0 double, t_y0 double, t_x1 double, t_y1 double, scale double")
    got = sorted((r["p"], r["group_id"] or 0, r["finding"]) for r in proofs.approved_placements(groups, places, ["p"]).collect())
    assert got == [(1, 1, "double"), (1, 2, "double"), (1, 2, "source"), (2, 0, "foreign")]


def test_frame_policies_small(spark):
    from rivulet.operators import paths

    def page(p, *lines):
        rows = [(p, i, i, "l", [{"x": float(a), "y": float(b)}, {"x": float(c), "y": float(d)}], True, 1.0) for i, (a, b, c, d) in enumerate(lines)]
        return rows

    frame = [(10, 10, 790, 10), (10, 590, 790, 590), (10, 10, 10, 590), (790, 10, 790, 590)]
    ring = [(5, 5, 795, 5), (5, 595, 795, 595), (5, 5, 5, 595), (795, 5, 795, 595)]
    rows = page(1, *frame, *ring, (10, 560, 790, 560)) + page(2, *frame, *ring, (5000, 5000, 5100, 5000)) + page(3, (0, 0, 10, 0)) + page(4, *frame, (10, 589.5, 790, 589.5))
    items = spark.createDataFrame(rows, "page int, path_id int, item_id int, op string, pts array<struct<x:double,y:double>>, stroked boolean, width double")
    pages = spark.createDataFrame([(p, 0.0, 0.0, 800.0, 600.0) for p in range(1, 5)], f"page int, {BOX}")
    got = {p: {r["page"]: (r["y1"], r["status"]) for r in paths.page_frame(items, pages, ["page"], policy=p).collect()} for p in paths.POLICIES}
    assert got["innermost"] == {1: (560.0, "OK"), 2: (590.0, "OK"), 3: (None, "FRAME_NOT_FOUND"), 4: (589.5, "OK")}
    assert got["title_top"][1] == (560.0, "OK") and got["title_top"][2] == (590.0, "OK")
    assert got["inner_ring"][1] == (590.0, "OK") and got["inner_ring"][4] == (589.5, "OK")
