"""Plan-shape checks for scale-relevant properties of the operators."""

import pytest

from cohortkit.operators.base import base_join
from cohortkit.operators.coverage import best_coverage
from cohortkit.operators.measures import entity_extremes, measure_pivot
from cohortkit.operators.similarity import similar_pairs
from cohortkit.operators.tags import explode_tags, tag_split
from cohortkit.schemas import ENTITY
from cohortkit.session import scratch_path
from cohortkit.sources.files import latest_version, materialize
from cohortkit.plans.fixtures import Fixture
from cohortkit.plans.queries import _file_objects
from tests.conftest import SMALL

ROWS = [(i, f"e{i}", [("a", i), ("b", 2 * i)], [(f"t{i % 5}", i % 2 == 0), ("u", False)], ["k"])
        for i in range(30)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def base(spark):
    ent = spark.createDataFrame(ROWS, ENTITY)
    cohort = spark.createDataFrame([(i % 3, [f"e{i}"]) for i in range(30)], "cohort_id long, members array<string>")
    chain = spark.createDataFrame([(i % 7, [f"e{i}"]) for i in range(30)], "chain_id long, members array<string>")
    return base_join(ent, cohort, chain)


def test_no_product_joins(base):
    for df in (base, similar_pairs(base, 0.5)):
        plan = plan_of(df)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_no_window_where_a_group_could_be_hot(base):
    # groups (tags, cohorts) are combined with aggregates, never one window task
    for df in (tag_split(explode_tags(base)), best_coverage(base, "cohort_id")):
        assert "Window" not in plan_of(df)


def test_extremes_are_one_aggregate(base):
    wide = materialize(measure_pivot(base, ["a", "b"], keep=("id", "name")), scratch_path(base.sparkSession, "test"))
    plan = plan_of(entity_extremes(wide, ["a", "b"]))
    assert "Join" not in plan and plan.count("Exchange SinglePartition") == 1 and plan.count("FileScan") == 1


def test_null_cut_makes_the_joins_inner(base):
    assert "LeftOuter" not in plan_of(base)


def test_latest_version_reads_keys_only_for_the_newest(spark):
    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "id long, ingest long, payload string")
    plan = plan_of(latest_version(materialize(rows, scratch_path(spark, "test")), ["id"], "ingest"))
    assert plan.count("FileScan") == 2 and plan.count("payload:string") == 1


def test_similarity_join_keys_are_salted(base):
    plan = plan_of(similar_pairs(base, 0.5))
    assert "a_lo" in plan and "a_hi" in plan and "b_lo" in plan
    join = next(line for line in plan.splitlines() if "a_lo" in line and "Join" in line)
    assert "vu" not in join  # vectors come after the salted join
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_base_join_deals_orders_once_by_name_over_tasks_that_grow(spark, tmp_path, monkeypatch):
    """However many lines there are, a task has a bounded number of them; the
    aggregation per order, the null cut and both joins stay in place."""
    import datetime

    from cohortkit.plans import fixtures

    monkeypatch.setattr(fixtures, "LINES_PER_TASK", 10)
    lines = [(i // 3, i % 7, 1.0, 2.0, 0.1, 0.1, "R", datetime.date(1995, 1, 1)) for i in range(60)] + [(None, 1, 1.0, 2.0, 0.1, 0.1, "N", None)]
    tables = {"lineitem": (lines, "l_orderkey long, l_partkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                                  "l_returnflag string, l_shipdate date"),
              "orders": ([(i, i % 4, 9.0) for i in range(25)] + [(None, 1, 9.0)], "o_orderkey long, o_custkey long, o_totalprice double"),
              "part": ([(i, f"t{i % 2}") for i in range(7)], "p_partkey long, p_type string"),
              "customer": ([(i, i) for i in range(4)], "c_custkey long, c_nationkey int")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    fx = fixtures.Fixture(spark, str(tmp_path))
    assert fx.tasks == 7 and fx.entity.count() == 26
    out = base_join(fx.entity, fx.cohort, fx.chain, tasks=fx.tasks)
    assert sorted((r.id, r.cohort_id, r.chain_id, len(r.tags), len(r.kinds)) for r in out.collect()) == [(i, 1995, i % 4, 3, 2) for i in range(20)]
    plan = plan_of(base_join(fx.entity, fx.cohort, fx.chain, tasks=fx.tasks))
    names = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line and ("name#" in line or "member#" in line) and ", 7)" in line]
    assert len(names) >= 4 and fx.entity.rdd.getNumPartitions() == 7


def test_scanned_files_hold_some_thousand_objects(spark):
    """One file per 5,000 keys, of the objects that the documents hold."""
    fx = Fixture(spark, SMALL)
    objects = _file_objects(fx)
    keys, top = objects.select("file_key").distinct().count(), fx.table("orders").agg({"o_orderkey": "max"}).first()[0]
    assert keys <= top // 5000 + 1
    assert objects.selectExpr("to_json(obj) AS raw").exceptAll(fx.entity_docs.select("raw")).isEmpty()


def test_measures_and_extremes_need_no_lambda_and_one_struct_a_side(base):
    """Lookups by name stay in generated code; an extreme makes no second struct."""
    df = entity_extremes(measure_pivot(base, ["a", "b"], keep=("id", "name")), ["a", "b"])
    plan = plan_of(df)
    assert "lambda" not in plan and "min_by" not in plan and "max_by" not in plan
    assert [tuple(r) for r in df.collect()] == [("all", 29, "e29", 43.5, 0, "e0", 0.0), ("a", 29, "e29", 29.0, 0, "e0", 0.0), ("b", 29, "e29", 58.0, 0, "e0", 0.0)]


def test_lookup_takes_the_first_of_a_name(spark):
    rows = [([("a", 1), None, ("a", 2)],), ([None, ("b", None), ("b", 3)],), ([(None, 9), ("b", 4)],), (None,), ([],)]
    df = spark.createDataFrame(rows, "measures array<struct<name:string,value:long>>")
    got = measure_pivot(df, ["a", "b"], keep=()).collect()
    assert [tuple(r) for r in got] == [(1, None), (None, None), (None, 4), (None, None), (None, None)]


def test_customer_documents_are_dealt_over_the_tasks(spark):
    """One scan task may hold all customers: they are dealt before their documents are made."""
    fx = Fixture(spark, SMALL)
    docs = fx.customer_tree_docs
    assert docs.rdd.getNumPartitions() == fx.tasks > fx.table("customer").rdd.getNumPartitions()
    assert docs.count() == fx.table("customer").count()


def test_latest_version_leaves_rows_of_one_version_in_place(spark):
    """Only keys with several versions are joined: other rows are not shuffled."""
    rows = [(1, "x", 1, "old"), (1, "x", 2, "new"), (1, "x", 2, "chunk"), (1, "y", 1, "one"), (2, "x", 3, "only"), (1, "x", None, "no version"),
            (3, "x", None, "none at all"), (None, "x", 1, "no key"), (4, None, 1, "half a key")]
    table = materialize(spark.createDataFrame(rows, "id long, part string, ingest long, payload string"), scratch_path(spark, "test"))
    newest = latest_version(table, ["id", "part"], "ingest")
    assert newest.columns == table.columns
    assert sorted(r.payload for r in newest.collect()) == ["chunk", "new", "one", "only"]
    assert "hashpartitioning" not in plan_of(newest)


def test_job_deals_its_sources_once_for_the_base(spark, monkeypatch):
    """One exchange a side: the distincts and both joins by name stay in place."""
    import json

    from cohortkit.plans import jobs
    from cohortkit.sources.files import land

    ent = [{"id": i, "name": f"e{i}", "stats": [{"base_stat": i, "stat": {"name": "a"}}], "types": [{"type": {"name": "k"}}],
            "abilities": [{"is_hidden": i % 2 == 0, "ability": {"name": f"t{i % 3}"}}]} for i in range(12)]
    group = {"id": 1, "name": "c", "pokemon_species": [{"name": f"e{i}"} for i in range(10)], "abilities": [{"name": "R"}]}
    chain = {"id": 7, "chain": {"species": {"name": "e0"}, "evolves_to": [{"species": {"name": f"e{i}"}, "evolves_to": []} for i in range(1, 9)]}}
    rows = [("entity", json.dumps(e)) for e in ent] + [("cohort", json.dumps(group)), ("chain", json.dumps(chain))]
    landing, plans = scratch_path(spark, "landing"), {}
    land(spark.createDataFrame(rows, "type string, raw string"), landing, ingest=1)
    publish = jobs.publish

    def seen(datasets, root, *more):
        plans.update({k: plan_of(v) for k, v in datasets.items()})
        return publish(datasets, root, *more)

    monkeypatch.setattr(jobs, "publish", seen)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = jobs.run_job(spark, {"landing_path": landing, "output_path": scratch_path(spark, "out"), "measure_names": ["a"], "chain_mode": "all"})
        assert {r.dataset: r.n_rows for r in out.collect()}["base"] == 9
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plans["base"].count("Exchange hashpartitioning(") == 3


def test_rows_of_a_name_are_counted_before_its_tags_are_spread(spark):
    """A row with a list counts once, not once a tag; no lambda per element."""
    from cohortkit.operators.similarity import _counts_with_rows

    tag = lambda *names: [(n, True) for n in names]
    rows = [("a", tag("x", "y", "x")), ("a", tag("x", "y", "x")), ("a", tag("z", None)), ("a", None), ("a", []), ("b", tag("x")), ("c", []), (None, tag("x"))]
    df = _counts_with_rows(spark.createDataFrame(rows, "name string, tags array<struct<tag:string,hidden:boolean>>"), "tags", "tag", "name")
    assert sorted(tuple(r) for r in df.collect()) == [("a", "x", 4, 5), ("a", "y", 2, 5), ("a", "z", 1, 5), ("b", "x", 1, 1)]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and plan.index("Generate") < plan.index("Window")


def test_job_query_makes_its_chain_documents_once(spark, monkeypatch):
    """They are landed twice, as two versions, from one written copy."""
    from cohortkit.plans import queries

    landed = []
    monkeypatch.setattr(queries, "land", lambda docs, path, ingest: landed.append((ingest, plan_of(docs), docs.where("type = 'chain'").count())))
    monkeypatch.setattr(queries, "run_job", lambda spark, cfg: None)
    queries._job(spark, SMALL, "all")
    assert [i for i, _, _ in landed] == [1, 2] and landed[0][2] == landed[1][2] > 0
    assert all("c_custkey" not in plan for _, plan, _ in landed)
