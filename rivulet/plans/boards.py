"""Queries on footer ledgers, part lists, reading order, clips, and layout searches."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivulet.operators import arrangement, clips, footer, graph, partlists, reading
from rivulet.sources import views as V
from rivulet.sources.views import with_views


def _ledgers(spark, d):
    """Ledgers of an order's lines, with repeated tiers and equal entries, and a cell each."""
    e = F.struct(F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p"), F.concat(F.lit("T"), (F.col("l_linenumber") % 2).cast("string")).alias("tier"), F.concat(F.lit("±0."), (F.col("l_quantity") % 3).cast("int").cast("string")).alias("value"))
    of = lambda flag: F.array_sort(F.collect_list(F.when(F.col("l_returnflag") == flag, e)))
    g = V.table(spark, d, "lineitem").groupBy("l_orderkey").agg(of("N").alias("l"), of("R").alias("a"), of("A").alias("c"))
    pair = lambda c: F.transform(c, lambda x: F.struct(x["tier"].alias("tier"), x["value"].alias("value")))
    return g.select(
        "l_orderkey",
        pair("l").alias("linear"),
        pair("a").alias("angular"),
        F.transform("c", lambda x: F.concat(F.lit("NOTE "), (x["p"] % 10).cast("string"))).alias("conditions"),
        *[F.expr(f"CAST({v} AS DOUBLE)").alias(k) for k, v in _CELL.items()],
    )


_CELL = {"x0": "(l_orderkey % 7) * 10", "y0": "l_orderkey % 5", "x1": "(l_orderkey % 7) * 10 + 80 + l_orderkey % 40", "y1": "l_orderkey % 5 + 36 + l_orderkey % 70"}


def footer_plan(spark, d):
    p = footer.arranged(_ledgers(spark, d))
    return p.select("l_orderkey", "fault", "mode", "size", F.col("step"), F.posexplode_outer("items").alias("pos", "i")).select(
        "l_orderkey", "fault", "mode", "size", "step", "pos", F.col("i.kind").alias("kind"), F.col("i.text").alias("text"), F.col("i.x").alias("x"), F.col("i.y").alias("y")
    )


_WIDTHS = "MAP {" + ", ".join(f"'{c.replace(chr(39), chr(39) * 2)}': {w / 1000}" for w, cs in sorted(footer.ADVANCES.items()) for c in cs) + "}"
_WIDE = "coalesce(list_max(list_transform({}, lambda t: list_sum(list_transform(regexp_extract_all(t, '(?s).'), lambda c: m[c])))), 0)"
FOOTER_SQL = f"""WITH e AS (SELECT l_orderkey, l_returnflag AS f, l_linenumber AS n, l_partkey AS p, 'T' || (l_linenumber % 2) || ' ±0.' || CAST(l_quantity % 3 AS INT) AS t, 'NOTE ' || (l_partkey % 10) AS c,
  'T' || (l_linenumber % 2) AS tier, '±0.' || CAST(l_quantity % 3 AS INT) AS v FROM lineitem),
g AS (SELECT l_orderkey, {", ".join(f"CAST({v} AS DOUBLE) AS {k}" for k, v in _CELL.items())}, coalesce(list(t ORDER BY n, p, tier, v) FILTER (WHERE f = 'N'), []) AS l, coalesce(list(t ORDER BY n, p, tier, v) FILTER (WHERE f = 'R'), []) AS a,
  coalesce(list(c ORDER BY n, p, tier, v) FILTER (WHERE f = 'A'), []) AS c, {_WIDTHS} AS m FROM e GROUP BY l_orderkey),
h AS (SELECT *, x1 - x0 - 8 AS usable, {_WIDE.format("l || a")} AS wide, {_WIDE.format("c")} AS wide_c, len(l) + len(a) AS n FROM g),
k AS (SELECT *, unnest(CASE WHEN len(l) > 0 AND len(a) > 0 THEN [{{'o': 1, 'mode': 'category_columns', 'lt': len(l), 'rt': len(a)}}]
  WHEN n > 1 THEN [{{'o': 1, 'mode': 'single_column', 'lt': n, 'rt': 0}}, {{'o': 2, 'mode': 'flow_columns', 'lt': CAST(ceil(n / 2) AS BIGINT), 'rt': n - CAST(ceil(n / 2) AS BIGINT)}}] ELSE [{{'o': 1, 'mode': 'single_column', 'lt': n, 'rt': 0}}] END) AS md FROM h),
s AS (SELECT *, md.lt AS lt, md.rt AS rt, greatest(lt, rt) AS r, CASE WHEN rt > 0 THEN (usable - 4) / 2 ELSE usable END AS col, z AS size, greatest(z * 1.4, z + 1.5) AS step FROM k, unnest([{", ".join(map(str, footer.SIZES))}]::DOUBLE[]) AS u(z)),
ok AS (SELECT * FROM s WHERE col > 0 AND y0 + 23 + size + (r + len(c) - 1) * step <= y1 - 4 AND wide * size <= col AND wide_c * size <= usable
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY md.o, size DESC) = 1),
q AS (SELECT h.*, ok.md.mode AS mode, ok.size, ok.step, ok.lt, ok.r, ok.col, CASE WHEN h.y1 - h.y0 < 38 OR h.usable < {max(sum(next(w for w, cs in footer.ADVANCES.items() if ch in cs) for ch in t) * z / 1000 for t, z in footer.HEADING)} THEN 'heading' WHEN ok.size IS NULL THEN 'overflow' END AS fault FROM h LEFT JOIN ok USING (l_orderkey)),
i AS (SELECT *, CASE WHEN fault IS NULL THEN range(n + len(c)) ELSE [NULL] END AS places FROM q)
SELECT l_orderkey, fault, CASE WHEN fault IS NULL THEN mode END AS mode, CASE WHEN fault IS NULL THEN size END AS size, CASE WHEN fault IS NULL THEN step END AS step, pos,
  CASE WHEN pos < len(l) THEN 'linear' WHEN pos < n THEN 'angular' WHEN pos IS NOT NULL THEN 'condition' END AS kind, (l || a || c)[pos + 1] AS text,
  CASE WHEN pos < n THEN x0 + 4 + CASE WHEN pos < lt THEN 0 ELSE col + 4 END WHEN pos IS NOT NULL THEN x0 + 4 END AS x,
  CASE WHEN pos < n THEN y0 + 23 + size + CASE WHEN pos < lt THEN pos ELSE pos - lt END * step WHEN pos IS NOT NULL THEN y0 + 23 + size + (r + pos - n) * step END AS y
FROM (SELECT *, unnest(places) AS pos FROM i)"""

def _lists(spark, d):
    t = V.list_sheets(spark, d)
    return t, partlists.part_lists(t["rules"], t["words"], t["marks"], t["regions"], t["frames"], ["page_id"])


def part_lists(spark, d):
    return _lists(spark, d)[1]


def cleared_regions(spark, d):
    t, lists = _lists(spark, d)
    return partlists.cleared(t["regions"], graph.written(lists).filter("sure"), t["rules"], t["frames"], ["page_id"])


def reading_order(spark, d):
    return reading.reading_order(V.tiles(spark, d), ["page_id"], "tile_id")


READING_SQL = with_views(
    "tile",
    """, b AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY y0, tile_id) AS k FROM tile),
r(page_id, k, rws, rw) AS (SELECT page_id, k, [[{'a': y0, 'b': y1}]], 1::BIGINT FROM b WHERE k = 1
  UNION ALL SELECT page_id, k, CASE WHEN rw > 0 THEN list_transform(rws, lambda x, i: CASE WHEN i = rw THEN list_append(x, me) ELSE x END) ELSE list_append(rws, [me]) END,
    CASE WHEN rw > 0 THEN rw ELSE len(rws) + 1 END
  FROM (SELECT r.page_id, b.k, r.rws, {'a': b.y0, 'b': b.y1} AS me, coalesce(list_position(list_transform(r.rws, lambda x: len(list_filter(x, lambda o: least(o.b, b.y1) - greatest(o.a, b.y0) > 0.3 * least(o.b - o.a, b.y1 - b.y0))) > 0), true), 0) AS rw
    FROM r JOIN b ON b.page_id = r.page_id AND b.k = r.k + 1))
SELECT page_id, tile_id, rw AS row, row_number() OVER (PARTITION BY page_id ORDER BY rw, x0, y0, tile_id) AS place FROM r JOIN b USING (page_id, k)""",
)


def line_neighbours(spark, d):
    return reading.line_neighbours(V.text_spans(spark, d), ["page_id"], "span_id")


_LINE = """, s AS (SELECT *, (y0 + y1) / 2 AS cy, round_even((y0 + y1) / 2, 0) AS line FROM span),
p AS (SELECT a.page_id, a.span_id AS a_span_id, b.span_id AS b_span_id, b.x0 - a.x1 AS gap, a.grp AS a_grp, b.grp AS b_grp FROM s a JOIN s b ON a.page_id = b.page_id
  AND abs(a.cy - b.cy) < 0.3 * a.size AND abs(a.size - b.size) < 0.5 AND b.x0 - a.x1 > -1 AND b.x0 - a.x1 < 3 * a.size AND (a.line, a.x0, a.span_id) < (b.line, b.x0, b.span_id))
"""
LINE_SQL = with_views("span", _LINE + "SELECT page_id, a_span_id, b_span_id, gap FROM p")


def torn_lines(spark, d):
    return reading.split_lines(V.text_spans(spark, d), ["page_id"], "span_id", "grp")


TORN_SQL = with_views("span", _LINE + "SELECT page_id, a_span_id, b_span_id, a_grp, b_grp FROM p WHERE a_grp <> b_grp")

def interleaved_blocks(spark, d):
    return clips.merge_interleaved(V.block_pieces(spark, d)["members"], ["page_id"])[1]


def block_clips(spark, d):
    t = V.block_pieces(spark, d)
    members, _ = clips.merge_interleaved(t["members"], ["page_id"])
    out = clips.block_clips(members, t["furniture"], t["pages"], ["page_id"])
    return out.select("page_id", "block", F.array_join("flags", ",").alias("flags"), F.posexplode("clips").alias("piece", "c")).select("page_id", "block", "flags", "piece", "c.*")


def layout_search(spark, d):
    t = V.view_sheets(spark, d)
    return arrangement.arranged(t["views"], t["sheets"], ["page_id"])


QUERIES = {
    "footer_plan": (footer_plan, FOOTER_SQL), "part_lists": (part_lists, None), "cleared_regions": (cleared_regions, None), "reading_order": (reading_order, READING_SQL),
    "line_neighbours": (line_neighbours, LINE_SQL), "torn_lines": (torn_lines, TORN_SQL), "interleaved_blocks": (interleaved_blocks, None), "block_clips": (block_clips, None), "layout_search": (layout_search, None),
}
