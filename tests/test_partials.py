"""States per batch against one run over all; bucketed tables."""

import random

import pytest
from pyspark.sql import functions as F

from cohortkit.operators.base import base_join_members
from cohortkit.operators.coverage import group_coverage
from cohortkit.operators.measures import entity_extremes, group_measure_avg
from cohortkit.operators.partials import BatchStates, state_averages, state_coverage, state_extremes
from cohortkit.session import scratch_path
from cohortkit.sources.files import publish_bucketed, read_bucketed
from tests.conftest import SMALL

COLS = ["a", "b"]
SCHEMA = "id long, name string, cohort_id long, a long, b long, kinds array<string>, tags array<string>, coverage double"


def rows_of(rng, ids):
    out = []
    for i in ids:
        kinds, tags = ["k"] * rng.randrange(3), ["t"] * rng.randrange(4)
        for c in rng.sample(range(4), rng.randrange(0, 3)):
            out.append((i, f"e{i}", c, rng.choice([None, rng.randrange(50)]), rng.randrange(50), kinds, tags,
                        len(kinds) / len(tags) if tags else None))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_one_by_one_equal_one_run(spark, seed):
    rng = random.Random(seed)
    batches = {1: range(0, 60), 2: range(40, 80), 3: [5, 45, *range(80, 95)], 4: range(200, 203)}
    landed, newest = {}, {}
    states = BatchStates(spark, scratch_path(spark, "test_states"), ["cohort_id"], COLS)
    for n, ids in batches.items():
        landed[n] = rows_of(rng, ids)  # some ids give no rows: they take back what they gave before
        newest |= dict.fromkeys(ids, n)
        rows = spark.createDataFrame(landed[n], SCHEMA)
        keys = spark.createDataFrame([(i,) for i in ids], "id long")
        made = states.add(n, rows, keys)
        assert made == {1: [1], 2: [1, 2], 3: [1, 2, 3], 4: [4]}[n]
        if n == 2:
            assert states.add(n, rows, keys) == made  # a repeated run changes nothing
        live = spark.createDataFrame([r for m, own in landed.items() for r in own if newest[r[0]] == m], SCHEMA)
        key = lambda r: str(tuple(r))
        near = lambda df: sorted((r for r in df.select([F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]).collect()), key=key)
        assert near(state_averages(states.states(), ["cohort_id"], COLS)) == near(group_measure_avg(live, ["cohort_id"], COLS))
        assert near(state_coverage(states.states(), ["cohort_id"])) == near(group_coverage(live, "cohort_id"))
        assert near(state_extremes(states.states(), COLS)) == near(entity_extremes(live, COLS))


def test_a_new_batch_reads_no_rows_of_others(spark, monkeypatch):
    states = BatchStates(spark, scratch_path(spark, "test_states"), ["cohort_id"], COLS)
    rng = random.Random(3)
    plans = []
    write = BatchStates._write
    monkeypatch.setattr(BatchStates, "_write", lambda self, df, name: plans.append((name, df)) or write(self, df, name))
    for n in (1, 2):
        states.add(n, spark.createDataFrame(rows_of(rng, range(100 * n, 100 * n + 40)), SCHEMA))
    plan = plans[-1][1]._jdf.queryExecution().executedPlan().toString()
    assert plans[-1][0] == "state" and "PartitionFilters" in plan and "batch" in plan.split("PartitionFilters", 1)[1][:200]
    assert states.states().select("batch").distinct().count() == 2


def test_bucketed_tables_join_without_exchange(spark):
    root = scratch_path(spark, "test_bucketed")
    entity = spark.createDataFrame([(i, f"e{i}", ["x"] * (i % 3)) for i in range(200)] + [(5, "e5", ["x"] * 2), (7, None, [])], "id long, name string, tags array<string>")
    cohort = spark.createDataFrame([(i % 4, f"e{i % 150}") for i in range(300)] + [(1, None), (None, "e1")], "cohort_id long, member string")
    chain = spark.createDataFrame([(i % 9, f"e{i}") for i in range(0, 200, 2)], "chain_id long, member string")
    for name, df, key in (("entity", entity, "name"), ("cohort", cohort, "member"), ("chain", chain, "member")):
        publish_bucketed(df, root, name, key, 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = base_join_members(*[read_bucketed(spark, root, n) for n in ("entity", "cohort", "chain")])
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
        want = base_join_members(entity, cohort, chain)
        assert "Exchange" in want._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    publish_bucketed(entity.limit(3), root, "entity", "name", 2)  # published anew
    assert read_bucketed(spark, root, "entity").count() == 3


def test_batch_rows_come_from_the_base_without_its_lists(spark, monkeypatch):
    """The whole base table is not written on the way to the batches' rows."""
    from cohortkit.plans import queries

    written = []
    keep = queries.materialize
    monkeypatch.setattr(queries, "materialize", lambda df, path: written.append(df.columns) or keep(df, path))
    queries._batch_states(spark, SMALL)
    assert len(written) == 1 and not {"measures", "tags", "kinds"} & set(written[0])
