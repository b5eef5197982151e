"""The Bloom filter before the base join: rows unchanged, few left to shuffle."""

import pytest

from cohortkit.operators import reduction
from cohortkit.operators.base import base_join_members
from cohortkit.operators.reduction import base_join_reduced, name_filter, reduce_by_filter
from cohortkit.schemas import ENTITY


@pytest.fixture(scope="module")
def inputs(spark):
    entity = spark.createDataFrame(
        [(i, None if i % 50 == 7 else f"e{i}", [("a", i)], [(f"t{i % 5}", i % 2 == 0)], ["k"]) for i in range(4000)], ENTITY)
    cohort = spark.createDataFrame([(i % 7, f"e{i * 40}") for i in range(100)] * 2 + [(1, None), (2, "gone")], "cohort_id long, member string")
    chain = spark.createDataFrame([(i % 11, f"e{i}") for i in range(4000)] + [(3, None)], "chain_id long, member string")
    return entity, cohort, chain


def rows_of(df):
    return sorted((r.id, r.name, r.cohort_id, r.chain_id) for r in df.collect())


def test_same_rows_as_the_join(inputs):
    want = rows_of(base_join_members(*inputs))
    assert want and rows_of(base_join_reduced(*inputs)) == want
    # a filter so full that it is of no use is left out
    assert rows_of(base_join_reduced(*inputs, max_bytes=1)) == want


def test_few_rows_pass_and_every_member_does(inputs):
    entity, cohort, _ = inputs
    left = reduce_by_filter(entity, "name", name_filter(cohort, "member"))
    assert left.columns == entity.columns
    names = [r.name for r in left.select("name").collect()]
    members = {r.member for r in cohort.collect()}
    there = {r.name for r in entity.select("name").collect()} & members - {None}
    assert there <= set(names) and len(names) <= len(there) + 0.03 * 4000


def test_share_that_passes_wrongly_over_many_blocks(spark):
    names = spark.range(30_000).selectExpr("concat('n', id) AS name")
    table, n_blocks = name_filter(names, "name")
    assert n_blocks > 10 and table.count() == n_blocks
    assert reduce_by_filter(names, "name", (table, n_blocks)).count() == 30_000
    other = spark.range(50_000).selectExpr("concat('other', id) AS name")
    assert reduce_by_filter(other, "name", (table, n_blocks)).count() < 0.015 * 50_000


def test_size_is_bounded(spark):
    names = spark.range(20_000).selectExpr("concat('n', id) AS name")
    assert name_filter(names, "name", max_bytes=4096) is None
    _, n_blocks = name_filter(names, "name", max_bytes=16_384)
    assert n_blocks <= 16_384 * 8 >> reduction.BLOCK_BITS


def test_no_names_and_no_rows(inputs):
    entity, cohort, chain = inputs
    built = name_filter(cohort.limit(0), "member")
    assert reduce_by_filter(entity, "name", built).count() == 0
    assert base_join_reduced(entity.limit(0), cohort, chain).count() == 0


def test_extra_columns_of_the_same_names_stay(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "name string, block int, words string")
    built = name_filter(spark.createDataFrame([("a",)], "member string"), "member")
    assert [tuple(r) for r in reduce_by_filter(rows, "name", built).collect()] == [("a", 1, "x")]


def test_filter_stands_before_the_first_shuffle(inputs):
    plan = base_join_reduced(*inputs)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    # below every exchange that carries the nested columns stands the probe of the filter
    carrying = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line and "measures" in line]
    probes = [i for i, line in enumerate(lines) if "BroadcastHashJoin" in line and "__block" in line]
    assert probes and all(any(p > c for p in probes) for c in carrying)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
