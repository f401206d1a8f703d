"""Every query with an SQL form gives the rows DuckDB gives; the others are held against plain loops elsewhere."""

import pytest
from compare import same

from rivulet.plans import REGISTRY as ALL


#: Queries that no single statement says, and the test that compares them.
BY_LOOPS = {
    "star_cluster": "test_star_cluster_query", "overlap_merge": "test_overlap_merge_query", "largest_scale": "test_largest_scale_queries", "house_scale": "test_largest_scale_queries", "part_lists": "test_part_lists_of_the_query_equal_brute_force",
    "cleared_regions": "test_part_lists", "interleaved_blocks": "test_clips_of_the_query_equal_brute_force", "block_clips": "test_clips_of_the_query_equal_brute_force", "layout_search": "test_layout_search_equals_exhaustive_search", "stacked_column": "test_stacked_column_query",
}


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in ALL.items() if sql))
def test_query(name, spark, duck, sf_dir):
    build, sql = ALL[name]
    out = build(spark, sf_dir).toPandas()
    same(out, duck.execute(sql).df())


def test_the_others_have_a_test_of_their_own():
    import test_boards

    assert {n for n, (_, sql) in ALL.items() if not sql} == set(BY_LOOPS)
    assert all(hasattr(test_boards, t) for t in BY_LOOPS.values())


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
