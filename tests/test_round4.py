"""Small cases of the fourth round's findings: missing ranks, open ties, streams and stars without tables of pairs."""

import pytest

from rivulet.plans import REGISTRY


def test_first_feasible_with_missing_numbers_equals_its_sql(spark, sf_dir, tmp_path):
    import duckdb
    from compare import same

    con = duckdb.connect()
    con.execute(
        f"""create table lineitem as select * replace (CASE WHEN l_partkey % 5 = 2 THEN NULL ELSE l_linenumber END AS l_linenumber) from '{sf_dir}/lineitem.parquet'
        qualify row_number() over (partition by l_orderkey, CASE WHEN l_partkey % 5 = 2 THEN NULL ELSE l_linenumber END order by l_partkey) = 1"""
    )
    con.execute(f"copy lineitem to '{tmp_path}/lineitem.parquet' (format parquet)")
    build, sql = REGISTRY["first_feasible"]
    out = build(spark, str(tmp_path)).toPandas()
    same(out, con.execute(sql).df())
    assert out["l_linenumber"].isna().any()


@pytest.mark.parametrize("threshold", [0.6, 0.0])
def test_stars_of_fingerprints_write_no_pairs(spark, monkeypatch, threshold):
    import random

    from pyspark.sql import functions as F

    from rivulet.operators import matching

    r = random.Random(5)
    grids = [[r.getrandbits(8) & r.getrandbits(8) for _ in range(8)] for _ in range(25)] + [[0] * 8, [1] + [0] * 7, None]
    rows = [(i, r.choice([12, 12, 30, 30, 30, None]), r.choice(grids)) for i in range(150)]
    items = spark.createDataFrame(rows, "id long, search int, grid array<long>")
    plain = items.select("id", F.lit(0.0).alias("weight"))
    want = matching.star_clusters(plain, matching.pair_similarity(items, 0.0), threshold)
    want = sorted(map(tuple, want.collect()))
    counts, write = [], matching.written
    monkeypatch.setattr(matching, "written", lambda df: (lambda t: (counts.append(t.count()), t)[1])(write(df)))
    monkeypatch.setattr(matching, "STARS", 11, raising=False)  # many blocks of a band and of a group
    got = sorted(map(tuple, matching.star_cluster_table(items, threshold).collect()))
    assert got == want and len(got) == len(rows)
    assert counts and max(counts) <= len(rows)  # what is written grows with the items, not with their pairs


def test_removal_proof_deals_line_items_once(spark, sf_dir):
    plan = REGISTRY["removal_proof"][0](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    exchanges = [x for x in plan.splitlines() if "Exchange" in x]
    assert exchanges and all("REPARTITION_BY_NUM" in x for x in exchanges) and "Join" not in plan
    # one shuffle with all columns serves every list; the documents that get one row more are told by their number alone
    assert {x.split("Exchange ")[1].split("#")[0] for x in exchanges} == {"hashpartitioning(l_suppkey"}


def test_removal_proof_of_lists_that_lie_anyhow_equals_loops(spark):
    import hashlib
    import random

    from rivulet.operators import proofs

    r, chunk = random.Random(7), 4
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    ops = {k: [f"op{r.randrange(5)}" for _ in range(r.choice([0, 1, 4, 9, 30]))] for k in range(40)}
    removed = [(k, i) for k, v in ops.items() for i in range(len(v) + 1) if r.random() < 0.2 and (i < len(v) or k % 7 == 0)]
    removed += [x for x in removed if x[0] % 11 == 3][:2] + [(99, 1)]
    retained = {k: [o for i, o in enumerate(v) if (k, i) not in set(removed)] for k, v in ops.items()}
    out = {k: list(v) for k, v in retained.items()}
    for k in range(0, 40, 3):
        if out[k]:
            at = r.randrange(len(out[k]))
            out[k] = out[k][:at] + r.choice([[], ["changed"], ["more", out[k][at]]]) + out[k][at + 1 :]
    out[77] = ["new"]
    want = {}
    for k in {**{k: 0 for k, v in ops.items() if v}, **{k: 0 for k, v in out.items() if v}}:
        a, b, gone = retained.get(k, []), out.get(k, []), [i for j, i in removed if j == k]
        first = next((i for i in range(max(len(a), len(b))) if a[i : i + 1] != b[i : i + 1]), None)
        acc = ""
        for i in range(0, len(a), chunk):
            acc = sha(acc + sha("".join(map(sha, a[i : i + chunk]))))
        there = len({i for i in gone if i < len(ops.get(k, []))})
        want[k] = (len(ops.get(k, [])), there, len(b), first is None and len(gone) == there, first, acc or None)
    rows = lambda t: [(k, 10 * i if t is out else i, o) for k, v in t.items() for i, o in enumerate(v)]
    make = lambda v, s: spark.createDataFrame(r.sample(v, len(v)), s).repartition(3)
    got = proofs.removal_proof(make(rows(ops), "k int, idx int, op string"), make(removed, "k int, idx long"), make(rows(out), "k int, idx long, op string"), "k", chunk)
    assert {x[0]: tuple(x)[1:] for x in got.collect()} == want
