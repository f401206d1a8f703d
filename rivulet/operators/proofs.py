"""Proofs that an output holds what it should: rules painted once, scaled groups as approved, reviewed fields, operators removed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rivulet.functions import geometry as G
from rivulet.operators import joins

# Tolerance of coordinates and attributes, of a clip's edge, the lead of a late rule, of a scale.
CLOSE, CLEAR, LEAD, SCALE = 0.03, 0.005, 10, 1e-6
#: Operators of a stream that are hashed together.
CHUNK = 1024


def painted_pairs(rules: DataFrame, lines: DataFrame, keys: list[str], tol: float = CLOSE) -> DataFrame:
    """Rules with the painted lines that have their ends, in either direction: ``keys, rule_id, seqno, alike``.

    ``rules``: ``keys, rule_id, px, py, qx, qy, width, r, g, b, cap``; ``lines``: ``keys, seqno, ax, ay, bx, by, width, r, g,
    b, caps`` (array). Each end lies within ``tol`` on both axes; ``alike`` tells whether width, colour and cap agree too.

    Four coordinates in two orders would need many cells; the midpoint does not depend on the order and moves by less
    than ``tol``, so pairs meet in an equi-join on its cell, and the ends are compared after.
    """
    cell = 2 * tol
    mid = lambda a, b: (F.col(a) + F.col(b)) / 2
    at = lambda v: F.floor(v / cell)
    r = rules.select(*keys, "rule_id", *[F.col(c).alias(f"r_{c}") for c in ("px", "py", "qx", "qy", "width", "r", "g", "b", "cap")], mid("px", "qx").alias("mx"), mid("py", "qy").alias("my"))
    r = r.withColumn("cx", F.explode(F.array_distinct(F.array(at(F.col("mx") - tol), at(F.col("mx") + tol))))).withColumn("cy", F.explode(F.array_distinct(F.array(at(F.col("my") - tol), at(F.col("my") + tol)))))
    p = lines.select(*keys, "seqno", *[F.col(c).alias(f"l_{c}") for c in ("ax", "ay", "bx", "by", "width", "r", "g", "b", "caps")], at(mid("ax", "bx")).alias("cx"), at(mid("ay", "by")).alias("cy"))
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) < tol
    same = near("l_ax", "r_px") & near("l_ay", "r_py") & near("l_bx", "r_qx") & near("l_by", "r_qy")
    back = near("l_bx", "r_px") & near("l_by", "r_py") & near("l_ax", "r_qx") & near("l_ay", "r_qy")
    alike = near("l_width", "r_width") & near("l_r", "r_r") & near("l_g", "r_g") & near("l_b", "r_b") & F.array_contains("l_caps", F.col("r_cap"))
    return r.join(p, [*keys, "cx", "cy"]).filter(same | back).select(*keys, "rule_id", "seqno", F.coalesce(alike, F.lit(False)).alias("alike"))


def rule_visibility(rules: DataFrame, lines: DataFrame, keys: list[str], tol: float = CLOSE) -> DataFrame:
    """``keys, rule_id, paths, masked, visible, alike, shared, passed`` for every rule.

    A rule passes if exactly one visible line paints it, all its lines have its attributes, and none of them is another
    rule's as well (``shared``). A rule of a table whose clip ends before the stroke (``clip_end``, with the original's place
    ``original`` and ``original_width``; null for other rules) may have one early copy that its clip hides.
    """
    rk = [*keys, "rule_id"]
    pairs = painted_pairs(rules, lines, keys, tol)
    shared = pairs.groupBy(*keys, "seqno").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*keys, "seqno", F.lit(1).alias("more"))
    per = pairs.join(shared, [*keys, "seqno"], "left").groupBy(*rk).agg(
        F.count(F.lit(1)).alias("paths"), F.count_if("alike").alias("alike"), F.count("more").alias("shared"), F.min("seqno").alias("first"), F.max("seqno").alias("last")
    )
    hidden = F.coalesce(F.col("clip_end") < F.col("original") - F.col("original_width") / 2 - CLEAR, F.lit(False)) & (F.col("last") - F.col("first") > LEAD)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    out = rules.select(*rk, "clip_end", "original", "original_width").join(per, rk, "left").withColumn("masked", F.coalesce(hidden.cast("int"), F.lit(0)))
    out = out.select(*rk, zero("paths").alias("paths"), "masked", (zero("paths") - F.col("masked")).alias("visible"), zero("alike").alias("alike"), zero("shared").alias("shared"))
    return out.withColumn("passed", (F.col("visible") == 1) & (F.col("alike") == F.col("paths")) & (F.col("shared") == 0))


def approved_placements(groups: DataFrame, placements: DataFrame, keys: list[str], tol: float = CLOSE) -> DataFrame:
    """Findings on scaled groups: ``keys, group_id, finding``; a group without any is as approved.

    ``groups``: ``keys, group_id, x0, y0, x1, y1`` (union of its clips), ``dst_x, dst_y, scale``; ``placements``: ``keys,
    place_id, x0, y0, x1, y1`` (source), ``t_x0, t_y0, t_x1, t_y1, scale``. The placements inside a group must have its scale,
    make up its source box and begin at its place. Findings: ``missing``, ``scale``, ``source``, ``target``; and ``double`` for a
    group whose placements lie in another group as well, ``foreign`` (null group) for a key's placements in no group.
    """
    gk = [*keys, "group_id"]
    pair = joins.inside(placements, groups, keys, 0.0).select(*keys, F.col("b_group_id").alias("group_id"), F.col("a_place_id").alias("place_id"), *[F.col(f"a_{c}").alias(f"p_{c}") for c in (*G.SIDES, "t_x0", "t_y0", "scale")])
    several = pair.groupBy(*keys, "place_id").agg(F.count(F.lit(1)).alias("owners"))
    side = lambda c: (F.min if c.endswith("0") else F.max)(f"p_{c}").alias(f"u_{c}")
    per = pair.join(several, [*keys, "place_id"]).groupBy(*gk).agg(
        *[side(c) for c in G.SIDES], F.min("p_t_x0").alias("u_tx"), F.min("p_t_y0").alias("u_ty"), F.min("p_scale").alias("low"), F.max("p_scale").alias("high"), F.max("owners").alias("owners")
    )
    g = groups.join(per, gk, "left")
    off = lambda a, b, t: F.abs(F.col(a) - F.col(b)) >= t
    there = F.col("low").isNotNull()
    found = F.array_compact(
        F.array(
            F.when(~there, F.lit("missing")),
            F.when(there & (off("low", "scale", SCALE) | off("high", "scale", SCALE)), F.lit("scale")),
            F.when(there & (off("u_x0", "x0", tol) | off("u_y0", "y0", tol) | off("u_x1", "x1", tol) | off("u_y1", "y1", tol)), F.lit("source")),
            F.when(there & (off("u_tx", "dst_x", tol) | off("u_ty", "dst_y", tol)), F.lit("target")),
            F.when(F.col("owners") > 1, F.lit("double")),
        )
    )
    alone = placements.join(several.select(*keys, "place_id"), [*keys, "place_id"], "left_anti").select(*keys).distinct()
    none = F.lit(None).cast(dict(groups.dtypes)["group_id"])
    return g.select(*gk, F.explode(found).alias("finding")).unionByName(alone.select(*keys, none.alias("group_id"), F.lit("foreign").alias("finding")))


#: Regions every ledger has, fields compared with the review and the job, fields that may replace a cell.
REGIONS, FIELDS, REPLACED = ("tolerance", "identity"), ("model", "title", "unit"), ("model", "title", "unit", "sheet", "scale_text", "size")
REVIEWED = "PASS_VISUAL_FIELD_COMPARISON"


def field_findings(ledgers: DataFrame, reviews: DataFrame, regions: DataFrame, clips: DataFrame, schema: str) -> DataFrame:
    """What blocks a ledger of reviewed source fields: ``ledger_id, finding``; a ledger without findings holds.

    ``ledgers``: ``ledger_id, schema, source_sha, job_source_sha, rotation, job_rotation, entries`` (the tolerance arrays as
    canonical text) and for each field ``f``: ``f`` and ``job_f``. ``reviews``: ``source_sha, reviewer, status, entries`` and the
    fields. ``regions``: ``ledger_id, name, field`` (whether it replaces a cell), ``reviewed`` (the review names the same
    place), ``x0, y0, x1, y1, sha, page_sha`` (digest recorded and found). ``clips``: ``ledger_id, kind`` (``tolerance`` group
    extents, ``carried`` clips, ``excluded`` areas), ``x0, y0, x1, y1``.

    A source has exactly one review: reviews are counted before they are joined, so a source with many stays one row.
    Findings: ``schema, source, rotation, review missing, review double, reviewer, status, entries, FIELD differs, region
    missing NAME, region unknown NAME, region double NAME, fingerprint NAME, unreviewed NAME, tolerance groups, not covered,
    excluded NAME, carried NAME``.
    """
    fields = [f for f in REPLACED if f in ledgers.columns]
    one = reviews.groupBy("source_sha").agg(
        F.count(F.lit(1)).alias("n_reviews"), *[F.min(c).alias(f"v_{c}") for c in ("reviewer", "status", "entries", *[f for f in fields if f in reviews.columns])]
    )
    led = ledgers.join(one, "source_sha", "left").withColumn("n_reviews", F.coalesce("n_reviews", F.lit(0)))
    differ = lambda a, b: ~F.col(a).eqNullSafe(F.col(b))
    single = F.col("n_reviews") == 1
    told = [
        F.when(~F.col("schema").eqNullSafe(F.lit(schema)), F.lit("schema")),
        F.when(differ("source_sha", "job_source_sha") | F.col("source_sha").isNull(), F.lit("source")),
        F.when(differ("rotation", "job_rotation"), F.lit("rotation")),
        F.when(F.col("n_reviews") == 0, F.lit("review missing")).when(F.col("n_reviews") > 1, F.lit("review double")),
        F.when(single & (F.coalesce(F.trim("v_reviewer"), F.lit("")) == ""), F.lit("reviewer")),
        F.when(single & ~F.col("v_status").eqNullSafe(F.lit(REVIEWED)), F.lit("status")),
        F.when(single & (differ("entries", "v_entries") | F.col("entries").isNull()), F.lit("entries")),
        *[F.when((single & differ(f, f"v_{f}")) | differ(f, f"job_{f}"), F.lit(f"{f} differs")) for f in fields if f in FIELDS],
    ]
    rows = led.select("ledger_id", F.explode(F.array_compact(F.array(*told))).alias("finding"))
    known = regions.join(ledgers.select("ledger_id"), "ledger_id", "left_semi")
    plain = known.filter(~F.col("field")).groupBy("ledger_id").pivot("name", list(REGIONS)).agg(F.count(F.lit(1)))
    plain = ledgers.select("ledger_id").join(plain, "ledger_id", "left")
    gone = [F.when(F.col(n).isNull(), F.lit(f"region missing {n}")).when(F.col(n) > 1, F.lit(f"region double {n}")) for n in REGIONS]
    rows = rows.unionByName(plain.select("ledger_id", F.explode(F.array_compact(F.array(*gone))).alias("finding")))
    allowed = F.when(F.col("field"), F.col("name").isin(*REPLACED)).otherwise(F.col("name").isin(*REGIONS))
    about = lambda c, text: F.when(c, F.concat(F.lit(text), "name"))
    own = F.array_compact(F.array(about(~allowed, "region unknown "), about(differ("sha", "page_sha") | F.col("sha").isNull(), "fingerprint "), about(F.col("field") & ~F.coalesce("reviewed", F.lit(False)), "unreviewed ")))
    rows = rows.unionByName(known.select("ledger_id", F.explode(own).alias("finding")))
    tol = clips.filter("kind = 'tolerance'").groupBy("ledger_id").agg(F.count(F.lit(1)).alias("groups"), *[(F.min if s.endswith("0") else F.max)(s).alias(f"g_{s}") for s in G.SIDES])
    crop = known.filter("name = 'tolerance' AND NOT field").groupBy("ledger_id").agg(*[F.first(s).alias(s) for s in G.SIDES])
    cover = ledgers.select("ledger_id").join(tol, "ledger_id", "left").join(crop, "ledger_id", "left")
    holds = F.coalesce(G.contains(G.of(), G.of("g_")), F.lit(True))
    whole = F.array_compact(F.array(F.when(F.coalesce("groups", F.lit(0)) != 1, F.lit("tolerance groups")), F.when((F.col("groups") == 1) & ~holds, F.lit("not covered"))))
    rows = rows.unionByName(cover.select("ledger_id", F.explode(whole).alias("finding")))
    meets = joins.box_join(known.filter("field"), clips.filter("kind IN ('excluded', 'carried')"), ["ledger_id"])
    meets = meets.filter(G.area(G.meet(G.of("a_"), G.of("b_"))) > 0).select("ledger_id", F.concat("b_kind", F.lit(" "), "a_name").alias("finding"))
    return rows.unionByName(meets).distinct()


def removal_proof(source: DataFrame, removed: DataFrame, output: DataFrame, key: str, chunk: int = CHUNK) -> DataFrame:
    """Whether each output stream is its source without the removed operators, in order and unchanged.

    ``source, output``: ``key, idx, op``; ``removed``: ``key, idx``. Result: ``key, n_source, n_removed, n_output, equal,
    first_difference`` (place in the retained stream, from 0; null if equal) ``, retained_sha256``, the end of a chain of
    hashes over the retained stream's chunks. Removed places that the source lacks, or that come twice, make it unequal.

    A stream may be long, so none is numbered in one window: places come from counts per chunk, summed over chunks, and
    counts inside. All three lists pass as rows of one, and all steps group by the key and more and join nothing: where
    the lists come dealt by the key, no row goes to another task. Pieces of both streams lie in one row, which tells the
    first place that differs.
    """
    kinds = [(source, "op", 0), (removed, None, 1), (output, "op", 2)]
    rows = [df.select(key, F.col("idx").cast("long").alias("idx"), (F.col(op) if op else F.lit(None).cast("string")).alias("op"), F.lit(k).alias("kind"), F.lit(None).cast("long").alias("before")) for df, op, k in kinds]
    every = rows[0].unionByName(rows[1]).unionByName(rows[2]).withColumns({"out": F.col("kind") == 2, "part": F.floor(F.col("idx") / chunk)})
    chunks = Window.partitionBy(key, "out", "part")
    here = chunks.orderBy("idx").rangeBetween(Window.currentRow, Window.currentRow)

    def flagged(df: DataFrame) -> DataFrame:
        there = F.col("idx").isNotNull()  # rows of sums have no place either
        gone = there & (F.sum((F.col("kind") == 1).cast("int")).over(here) > 0)
        return df.withColumn("gone", gone).withColumn("kept", there & (F.col("out") | ((F.col("kind") == 0) & ~F.col("gone"))))

    sums = flagged(every).groupBy(key, "out", "part").agg(F.sum(F.col("kept").cast("long")).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(key, "out").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    sums = sums.select(key, F.lit(None).cast("long").alias("idx"), F.lit(None).cast("string").alias("op"), F.lit(3).alias("kind"), before.alias("before"), "out", "part")
    inside = F.sum(F.col("kept").cast("long")).over(chunks.orderBy("idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - 1
    placed = flagged(every.unionByName(sums)).withColumns({"inside": inside, "start": F.max("before").over(chunks)}).withColumn("place", F.when(F.col("kept"), F.col("start") + F.col("inside")))
    placed = placed.select(key, "kind", "gone", "place", F.floor(F.col("place") / chunk).alias("piece"), F.when(F.col("kept"), F.unhex(F.sha2("op", 256))).alias("h"))
    stream = lambda kind: F.transform(F.array_sort(F.collect_list(F.when(F.col("place").isNotNull() & (F.col("kind") == kind), F.struct("place", "h")))), lambda x: x["h"])
    number = lambda c: F.sum(c.cast("long"))
    pieces = placed.groupBy(key, "piece").agg(
        stream(0).alias("want"), stream(2).alias("have"), number(F.col("kind") == 0).alias("n_source"), number((F.col("kind") == 0) & F.col("gone")).alias("n_removed"),
        number(F.col("kind") == 1).alias("asked"), number(F.col("kind") == 2).alias("n_output"),
    )
    unlike = F.filter(F.sequence(F.lit(0), F.greatest(F.size("want"), F.size("have")) - 1), lambda i: ~F.get("want", i).eqNullSafe(F.get("have", i)))
    first = F.when(F.col("piece").isNotNull() & ~F.col("want").eqNullSafe(F.col("have")), F.col("piece") * chunk + F.get(unlike, 0))
    joined = F.sha2(F.array_join(F.transform("want", lambda h: F.lower(F.hex(h))), ""), 256)
    pieces = pieces.select(key, first.alias("first"), F.when(F.size("want") > 0, F.struct("piece", joined.alias("want"))).alias("want"), "n_source", "n_removed", "asked", "n_output")
    ordered = F.transform(F.array_sort("wants"), lambda x: x["want"])
    chain = F.when(F.size("wants") > 0, F.aggregate(ordered, F.lit(""), lambda s, h: F.sha2(F.concat(s, h), 256)))
    out = pieces.groupBy(key).agg(F.min("first").alias("first_difference"), F.collect_list("want").alias("wants"), *[F.sum(c).alias(c) for c in ("n_source", "n_removed", "asked", "n_output")])
    return out.filter("n_source > 0 OR n_output > 0").select(
        key, "n_source", "n_removed", "n_output", (F.col("first_difference").isNull() & (F.col("asked") == F.col("n_removed"))).alias("equal"), "first_difference", chain.alias("retained_sha256")
    )


def target_findings(source: DataFrame, targets: DataFrame, removed: DataFrame, key: str) -> DataFrame:
    """Findings on the blocks whose operators are removed: ``key, start, finding``.

    ``source``: ``key, idx, name``; ``targets``: ``key, start, last, shows`` (array of places). A block begins with BT and ends
    with ET, lists all its show operators, all of them Tj; the removed places are the shows of all blocks, each once
    (``removed``, with null ``start``). Other findings: ``range``, ``shows``, ``operator``.
    """
    inside = targets.join(source.filter(F.col("name").isin("Tj", "TJ", "'", '"', "BT", "ET")), key).filter("idx >= start AND idx <= last")
    show = F.col("name").isin("Tj", "TJ", "'", '"')
    per = inside.groupBy(key, "start", "last").agg(
        F.array_sort(F.collect_list(F.when(show, F.col("idx")))).alias("there"), F.max(F.when(show & (F.col("name") != "Tj"), 1).otherwise(0)).alias("odd"),
        F.max(F.when((F.col("idx") == F.col("start")) & (F.col("name") == "BT"), 1).otherwise(0)).alias("opens"), F.max(F.when((F.col("idx") == F.col("last")) & (F.col("name") == "ET"), 1).otherwise(0)).alias("closes"),
    )
    t = targets.join(per, [key, "start", "last"], "left")
    found = F.array_compact(
        F.array(
            F.when((F.coalesce("opens", F.lit(0)) == 0) | (F.coalesce("closes", F.lit(0)) == 0) | (F.col("start") >= F.col("last")), F.lit("range")),
            F.when((F.size("shows") <= 0) | ~F.array_sort("shows").eqNullSafe(F.col("there")), F.lit("shows")),
            F.when(F.col("odd") == 1, F.lit("operator")),
        )
    )
    rows = t.select(key, F.col("start").cast("long").alias("start"), F.explode(found).alias("finding"))
    listed = targets.select(key, F.explode("shows").alias("idx")).groupBy(key, "idx").agg(F.count(F.lit(1)).alias("n"))
    gone = removed.groupBy(key, "idx").agg(F.count(F.lit(1)).alias("m"))
    odd = listed.join(gone, [key, "idx"], "full").filter("coalesce(n, 0) <> 1 OR coalesce(m, 0) <> 1").select(key).distinct()
    return rows.unionByName(odd.select(key, F.lit(None).cast("long").alias("start"), F.lit("removed").alias("finding")))


def watermark_words(words: DataFrame, keys: list[str], patterns: list[str], singles: list[str], gap: float = 25.0) -> DataFrame:
    """``keys, pos, step`` of a page's watermark words: those that hold a pattern (step 0) and the single characters reached.

    ``words``: ``keys, pos, x0, y0, x1, y1, text``, ``pos`` the order on the page. A single character belongs if it lies within
    ``gap`` of a pattern word, or of a single character that comes before it and belongs already. So chains run forward
    only. Rounds over the pairs of near words; a round's front is what the last one reached.
    """
    from rivulet.operators import graph

    held = F.exists(F.array(*map(F.lit, patterns)), lambda p: F.contains(F.col("text"), p))
    w = words.select(*keys, "pos", *G.SIDES, held.alias("seed"), F.col("text").isin(*singles).alias("single")).filter("seed OR single")
    pairs = joins.box_join(w, w.filter("single AND NOT seed"), keys, gap).filter(F.col("a_seed") | (F.col("a_pos") < F.col("b_pos")))
    pairs = graph.written(pairs.select(*keys, F.col("a_pos").alias("a"), F.col("b_pos").alias("b"), F.col("a_seed").alias("seed")))
    found = graph.written(w.filter("seed").select(*keys, "pos", F.lit(0).alias("step")))
    front, step = found, 0
    while True:
        step += 1
        met = pairs.join(front.select(*keys, F.col("pos").alias("a")), [*keys, "a"]).select(*keys, F.col("b").alias("pos")).distinct()
        front = graph.written(met.join(found, [*keys, "pos"], "left_anti").withColumn("step", F.lit(step)))
        if not front.limit(1).count():
            return found
        found = graph.written(found.unionByName(front))
