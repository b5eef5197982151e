"""Edge cases of the analytic operators on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from cohortkit.functions.columns import pretty_label, url_key
from cohortkit.operators.base import base_join, collect_chunked, drop_incomplete, explode_members
from cohortkit.operators.coverage import best_coverage, entity_sort_key, group_coverage, with_coverage, with_rank
from cohortkit.operators.measures import extremes, group_extremes, measure_pivot
from cohortkit.operators.tags import explode_tags, filter_flag, tag_members, tag_split
from cohortkit.plans.contract import SchemaMismatch, assert_schema, contract_report
from cohortkit.plans.jobs import JobConfig
from cohortkit.schemas import COHORT_MEMBERS_KEY as MEMBERS
from cohortkit.schemas import ENTITY

ROWS = [
    (1, "a", [("hp", 10), ("atk", 20)], [("t1", False), ("t2", True)], ["k1"]),
    (2, "b", [("atk", 5), ("hp", 7)], [("t1", True)], ["k1", "k2"]),
    (3, "c", [("hp", 1)], [], ["k1"]),
    (4, "d", None, None, None),
]


@pytest.fixture()
def entity(spark):
    return spark.createDataFrame(ROWS, ENTITY)


def test_explode_is_inner(spark):
    g = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "g long, members array<string>")
    assert sorted((r.g, r.member) for r in explode_members(g, "g").collect()) == [(1, "a"), (1, "b")]


def test_base_join_null_cut_and_chunking(spark, entity):
    cohort = spark.createDataFrame([(10, ["a", "b", "c", "d", "zz"])], "cohort_id long, members array<string>")
    chain = spark.createDataFrame([(100, ["a", "b"]), (101, ["c"])], "chain_id long, members array<string>")
    base = base_join(entity, cohort, chain)
    # d has NULL arrays and no chain; c has an empty tag list, which is not NULL
    assert sorted((r.id, r.chain_id) for r in base.collect()) == [(1, 100), (2, 100), (3, 101)]
    flat = explode_members(cohort, "cohort_id")
    chunked = collect_chunked(flat, ["cohort_id"], "member", "members", max_items=2)
    assert chunked.count() >= 3
    assert sorted(r.id for r in base_join(entity, chunked, chain).collect()) == [1, 2, 3]


def test_dropna_keeps_arrays_containing_null(spark):
    df = spark.createDataFrame([(1, [None, "x"]), (2, None)], "id long, a array<string>")
    assert [r.id for r in drop_incomplete(df).collect()] == [1]


def test_measure_pivot_by_name(spark, entity):
    wide = measure_pivot(entity, ["hp", "atk", "missing-one"], keep=("id",))
    got = {r.id: (r.hp, r.atk, r.missing_one) for r in wide.collect()}
    assert got == {1: (10, 20, None), 2: (7, 5, None), 3: (1, None, None), 4: (None, None, None)}


def test_coverage_zero_divisor_is_null(spark, entity):
    cov = {r.id: r.coverage for r in with_coverage(entity).collect()}
    assert cov == {1: 0.5, 2: 2.0, 3: None, 4: None}
    g = entity.withColumn("cohort_id", F.lit(1))
    assert group_coverage(g, "cohort_id").collect()[0].avg_coverage == pytest.approx(1.25)


def test_best_coverage_tie_goes_to_lowest_id(spark):
    rows = [(5, "e", [("t", False)], ["k"], 1), (2, "b", [("t", False)], ["k"], 1),
            (9, "z", [("t", False), ("u", True)], ["k"], 1)]
    df = spark.createDataFrame(rows, "id long, name string, tags array<struct<tag:string,hidden:boolean>>, "
                                     "kinds array<string>, cohort_id long")
    best = best_coverage(df, "cohort_id").collect()[0]
    assert (best.id, best.name, best.coverage) == (2, "b", 1.0)


def test_extremes_ties_and_truncation(spark):
    df = spark.createDataFrame([(3, 7.9, -1.5), (1, 7.9, -2.7), (2, 1.0, 4.0)], "g long, x double, y double")
    ext = {r.measure: r for r in group_extremes(df, "g", ["x", "y"]).collect()}
    assert (ext["x"].max_g, ext["x"].max_value, ext["x"].min_g, ext["x"].min_value) == (1, 7, 2, 1)
    assert (ext["y"].max_g, ext["y"].max_value, ext["y"].min_g, ext["y"].min_value) == (2, 4, 1, -2)
    nulls = spark.createDataFrame([(1, None, 2.0), (2, None, None)], "g long, x double, y double")
    assert [(r.measure, r.max_g, r.min_g) for r in extremes(nulls, ["g"], ["x", "y"]).collect()] == [("y", 1, 1)]


def test_rank_follows_the_order(spark, entity):
    many = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("id")).repartition(7)
    ranked = with_rank(many.orderBy(F.desc("id"))).collect()
    assert sorted((r["rank"], r.id) for r in ranked) == [(i + 1, 999 - i) for i in range(1000)]
    assert [r.id for r in with_rank(entity_sort_key(entity, by_key=False)).orderBy("rank").collect()] == [1, 2, 3, 4]
    assert [r.id for r in with_rank(entity_sort_key(entity)).orderBy("rank").collect()] == [1, 2, 3, 4]


def test_tag_split_one_sided_and_null_flag(spark):
    rows = [("a", "t1", True), ("b", "t1", False), ("c", "t2", True), ("d", "t3", None),
            ("a", "t1", True)]
    long = spark.createDataFrame(rows, "name string, tag string, hidden boolean")
    rows_of = lambda df: sorted((r.tag, r.hidden, r.name) for r in df.collect())
    assert rows_of(tag_split(long)) == [("t1", False, "b"), ("t1", True, "a")]
    assert rows_of(tag_split(long, full=True)) == [("t1", False, "b"), ("t1", True, "a"), ("t2", True, "c")]
    assert sorted((r.tag, r.name) for r in tag_members(long).collect()) == [("t1", "a"), ("t1", "b"), ("t2", "c"), ("t3", "d")]
    assert filter_flag(long).count() == 3 and filter_flag(long, False).count() == 1


def test_explode_tags(spark, entity):
    assert explode_tags(entity).count() == 3


def test_scalar_functions(spark):
    df = spark.createDataFrame([("http://h.example.com/fr/825?x=1",), ("nourl",), ("a/b/",)], "u string")
    assert [r.k for r in df.select(url_key("u").alias("k")).collect()] == ["fr", None, "b"]
    lab = spark.createDataFrame([("avg(stat_special_attack)",), ("avg_all",)], "c string")
    assert [r.p for r in lab.select(pretty_label("c").alias("p")).collect()] == ["Stat special attack", " all"]


def test_contract(spark, entity):
    from pyspark.sql import types as T
    req = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("nope", T.StringType()),
                        T.StructField("measures", T.StringType()),
                        T.StructField("kinds", T.ArrayType(T.StringType()), False)])
    with pytest.raises(SchemaMismatch) as e:
        assert_schema(entity, req)
    assert "nope: missing" in str(e.value) and "measures: wrong type" in str(e.value)
    rep = {r.column_name: r for r in contract_report(entity, req).collect()}
    assert rep["id"].ok and rep["id"].null_count == 0
    assert not rep["nope"].present and rep["nope"].null_count is None
    assert rep["kinds"].null_count == 1 and not rep["kinds"].ok
    assert rep["id"].cast_failures == 0 and rep["measures"].cast_failures is None
    text = spark.createDataFrame([("1",), ("x",), (None,)], "v string")
    number = T.StructType([T.StructField("v", T.LongType())])
    assert [(r.null_count, r.cast_failures, r.ok) for r in contract_report(text, number).collect()] == [(1, 1, False)]


def test_assert_contract_raises_on_nulls(spark, entity):
    from pyspark.sql import types as T

    from cohortkit.plans.contract import assert_contract
    ok = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("kinds", T.ArrayType(T.StringType()))])
    assert assert_contract(entity, ok) is entity
    strict = T.StructType([T.StructField("kinds", T.ArrayType(T.StringType()), False)])
    with pytest.raises(SchemaMismatch) as e:
        assert_contract(entity, strict)
    assert "kinds" in str(e.value) and "nulls=1" in str(e.value)


def test_job_config_lists_all_missing_keys():
    with pytest.raises(KeyError) as e:
        JobConfig.from_mapping({"threshold": 0.5})
    msg = str(e.value)
    assert "'landing_path'" in msg and "'output_path'" in msg and "'measure_names'" in msg
    cfg = JobConfig.from_mapping({"landing_path": "a", "output_path": "b", "measure_names": ["x"], "zz": 1})
    assert cfg.threshold == 0.75 and cfg.measure_names == ("x",)


def test_job_first_branch_chain_mode(spark):
    import json

    from cohortkit.plans.jobs import run_job
    from cohortkit.session import scratch_path
    from cohortkit.sources.files import land

    ents = [dict(id=i, name=n, stats=[{"base_stat": 10 * i, "stat": {"name": "hp"}}],
                 abilities=[{"is_hidden": i % 2 == 0, "ability": {"name": t}} for t in tags],
                 types=[{"type": {"name": "k"}}])
            for i, n, tags in [(1, "a", ["x", "y"]), (2, "b", ["x", "y"]), (3, "c", ["x", "y"]),
                               (4, "d", ["z"])]]
    cohorts = [{"id": 1, "name": "g1", MEMBERS: [{"name": "a"}, {"name": "d"}]},
               {"id": 2, "name": "g2", MEMBERS: [{"name": "b"}, {"name": "c"}]}]
    # chain 10: a -> b (first branch) with sibling c; chain 11: d alone
    chains = [{"id": 10, "chain": {"species": {"name": "a"}, "evolves_to": [
        {"species": {"name": "b"}, "evolves_to": []}, {"species": {"name": "c"}, "evolves_to": []}]}},
        {"id": 11, "chain": {"species": {"name": "d"}, "evolves_to": []}}]
    rows = ([("entity", e["id"], json.dumps(e)) for e in ents]
            + [("cohort", c["id"], json.dumps(c)) for c in cohorts]
            + [("chain", c["id"], json.dumps(c)) for c in chains])
    landing = scratch_path(spark, "test_job_landing")
    land(spark.createDataFrame(rows, "type string, id long, raw string"), landing, ingest=1)
    cfg = {"landing_path": landing, "output_path": scratch_path(spark, "test_job_out"),
           "measure_names": ["hp"], "threshold": 0.5}
    inv = {r.dataset: r.n_rows for r in run_job(spark, cfg).collect()}
    # first branch drops sibling c (no chain id -> cut); all mode keeps it
    assert inv["base"] == 3 and inv["cohort_measure_avg"] == 2
    assert inv["entity"] == 4 and inv["cohort_members"] == 4 and inv["chain_members"] == 3
    inv_all = {r.dataset: r.n_rows for r in run_job(spark, dict(cfg, chain_mode="all", block_size=1,
                                                              output_path=scratch_path(spark, "o2"))).collect()}
    # tags x, y are held both ways by a, b, c
    # no pair: same chain or cohort, or only zero-weight shared tags
    assert inv_all["base"] == 4 and inv_all["tag_split"] == 6 and inv_all["similar_pairs"] == 0
    assert inv_all["cohort"] == 2 and inv_all["rejects"] == 0


def test_job_publishes_rejects_and_checks_the_load(spark, monkeypatch):
    import json

    from cohortkit.plans import jobs
    from cohortkit.session import scratch_path
    from cohortkit.sources.files import land, read_published

    ent = dict(id=1, name="a", stats=[], abilities=[], types=[])
    rows = [("entity", 1, json.dumps(ent)), ("entity", 2, '{"id": 2, "name": "b"'), ("entity", 3, '{"name": "c"}'),
            ("entity", 4, '{"id": "four"}'), ("chain", 5, "<html>"), ("chain", 6, '{"id": 6, "chain": [1]}'), ("weird", 7, "{}"),
            ("cohort", 8, json.dumps({"id": 8, "name": "g", MEMBERS: [{"name": "a"}], "abilities": [{"name": "t"}]})),
            ("chain", 9, json.dumps({"id": 9, "chain": {"species": {"name": "a"}, "evolves_to": []}}))]
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "out")
    land(spark.createDataFrame(rows, "type string, id long, raw string"), landing, ingest=3)
    cfg = {"landing_path": landing, "output_path": out, "measure_names": ["hp"]}
    inv = {r.dataset: r.n_rows for r in jobs.run_job(spark, cfg).collect()}
    rejects = sorted((r.type, r.reason, r.raw, r.ingest) for r in read_published(spark, out, "rejects").collect())
    assert inv["rejects"] == 6 and inv["entity"] == inv["base"] == 1
    assert rejects == sorted([("entity", "does not parse", rows[1][2], 3), ("entity", "no id", rows[2][2], 3),
                              ("entity", "does not parse", rows[3][2], 3), ("chain", "does not parse", "<html>", 3),
                              ("chain", "does not parse", rows[5][2], 3), ("weird", "unknown type", "{}", 3)])
    assert [(r.cohort_id, r.name, r.tags) for r in read_published(spark, out, "cohort").collect()] == [(8, "g", ["t"])]
    whole = jobs.read_published
    monkeypatch.setattr(jobs, "read_published", lambda s, root, name: whole(s, root, name).limit(0) if name == "cohort" else whole(s, root, name))
    with pytest.raises(jobs.LoadMismatch):
        jobs.run_job(spark, dict(cfg, output_path=scratch_path(spark, "out"), data_checks=False))


def test_shared_folder_with_an_empty_configuration(tmp_path):
    """A stock Spark: the folder comes from the settings, or is refused."""
    import subprocess
    import sys
    code = """
import sys
from pyspark.sql import SparkSession
from cohortkit.session import local_session, shared_dir
s = local_session(cores=1, checkpoint_dir=sys.argv[1] + "/shared")
assert shared_dir(s) == sys.argv[1] + "/shared"
s.stop()
s = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
class Cluster:
    conf = s.conf
    class sparkContext:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
class NoFolder:
    get = staticmethod(lambda key, default=None: default)
Cluster.conf = NoFolder
try:
    shared_dir(Cluster)
except RuntimeError as e:
    assert "spark.checkpoint.dir" in str(e)
else:
    raise AssertionError("a cluster without a shared folder was accepted")
"""
    import os
    env = dict(os.environ, SPARK_CONF_DIR=str(tmp_path), PYTHONPATH=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    done = subprocess.run([sys.executable, "-c", code, str(tmp_path)], env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
