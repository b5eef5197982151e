"""Hand-made JSON documents: parse, reject, route, chains, landing."""

import json
import random
import zlib

import pytest

from cohortkit.operators import chains
from cohortkit.operators.chains import NotATree, all_members, first_branch, top_ancestors, walk_edges
from cohortkit.schemas import COHORT_MEMBERS_KEY as MEMBERS
from cohortkit.schemas import ENTITY, ENTITY_DOC
from cohortkit.plans.fixtures import Fixture
from cohortkit.session import scratch_path
from cohortkit.sources.documents import (
    COHORTS,
    ENTITIES,
    KINDS,
    entities_from_docs,
    mark_chains,
    mark_entities,
    marked_by_type,
    parse_chains,
    parse_cohorts,
    parse_entities,
    parse_legacy_entities,
    parse_listing,
    route_documents,
    split_marked,
)
from cohortkit.sources import files
from cohortkit.sources.files import (
    land,
    latest_version,
    materialize,
    publish,
    read_json_arrays,
    read_json_elements,
    read_landing,
    read_published,
    scan_local,
)

ENT = {
    "id": 1, "name": "a",
    "stats": [{"base_stat": 45, "effort": 0, "stat": {"name": "hp", "url": "x"}},
              {"base_stat": 49, "stat": {"name": "attack"}}],
    "abilities": [{"is_hidden": False, "slot": 1, "ability": {"name": "t1"}},
                  {"is_hidden": True, "ability": {"name": "t2"}}],
    "types": [{"slot": 1, "type": {"name": "k1"}}, {"type": {"name": "k2"}}],
    "extra": {"ignored": True},
}
from tests.conftest import SMALL


def docs(spark, *raws, type_="entity"):
    return spark.createDataFrame([(type_, i, r) for i, r in enumerate(raws)], "type string, id long, raw string")


def test_parse_entity_fields(spark):
    good, bad = parse_entities(docs(spark, json.dumps(ENT)))
    row = good.collect()[0]
    assert row.id == 1 and row.name == "a"
    assert [(m.name, m.value) for m in row.measures] == [("hp", 45), ("attack", 49)]
    assert [(t.tag, t.hidden) for t in row.tags] == [("t1", False), ("t2", True)]
    assert row.kinds == ["k1", "k2"]
    assert bad.count() == 0


def test_bad_documents_are_rejected_not_dropped(spark):
    raws = [json.dumps(ENT), "{}", "not json", "[1,2]", "", json.dumps({"name": "no id"}),
            json.dumps({"id": 7, "name": "bare"}), json.dumps(dict(ENT, id=8, stats=[{"base_stat": "oops"}]))]
    good, bad = parse_entities(docs(spark, *raws))
    assert sorted(r.id for r in good.collect()) == [1, 7]
    assert {r.id: r.reason for r in bad.collect()} == {1: "no id", 2: "does not parse", 3: "does not parse", 4: "does not parse",
                                                       5: "no id", 7: "does not parse"}
    bare = good.where("id = 7").collect()[0]
    # missing arrays stay NULL (dropped later by the base null cut)
    assert bare.measures is None and bare.tags is None and bare.kinds is None


def test_empty_arrays_are_kept(spark):
    e = dict(ENT, stats=[], abilities=[], types=[])
    good, _ = parse_entities(docs(spark, json.dumps(e)))
    row = good.collect()[0]
    assert row.measures == [] and row.tags == [] and row.kinds == []


def test_parse_cohort(spark):
    c = {"id": 3, "name": "g3", MEMBERS: [{"name": "a", "url": "u"}, {"name": "b"}],
         "abilities": [{"name": "t1"}]}
    good, _ = parse_cohorts(docs(spark, json.dumps(c), type_="cohort"))
    row = good.collect()[0]
    assert (row.cohort_id, row.name, row.members, row.tags) == (3, "g3", ["a", "b"], ["t1"])


def test_legacy_form_casts(spark):
    legacy = {"id": 2, "name": "b", "stats": [["hp", 45], ["attack", "x"]],
              "abilities": [["t1", "false"], ["t2", True]], "types": ["k"]}
    good, _ = parse_legacy_entities(docs(spark, json.dumps(legacy)))
    row = good.collect()[0]
    assert [(m.name, m.value) for m in row.measures] == [("hp", 45), ("attack", None)]
    assert [(t.tag, t.hidden) for t in row.tags] == [("t1", False), ("t2", True)]


def _tree(name, *kids, has_key=True):
    node = {"species": {"name": name}}
    if has_key:
        node["evolves_to"] = list(kids)
    return node


def test_chain_first_branch_and_all(spark):
    tree = _tree("a", _tree("b", _tree("c")), _tree("b2", _tree("c2")))
    d = docs(spark, json.dumps({"id": 9, "chain": tree}), json.dumps({"id": 10, "chain": None}), json.dumps({"id": 11}), type_="chain")
    good, bad = parse_chains(d)
    assert bad.count() == 0
    assert {r.chain_id: r.members for r in first_branch(good).collect()} == {9: ["a", "b", "c"], 10: [], 11: []}
    got = sorted((r.member, r.depth) for r in all_members(good.where("chain_id = 9")).collect())
    assert got == [("a", 0), ("b", 1), ("b2", 1), ("c", 2), ("c2", 2)]


def test_chain_node_without_key_stops_walk(spark):
    tree = _tree("a", _tree("b", has_key=False))
    good, _ = parse_chains(docs(spark, json.dumps({"id": 1, "chain": tree}), type_="chain"))
    assert first_branch(good).collect()[0].members == ["a"]


@pytest.mark.parametrize("depth", [0, 1, 15, 16, 40])
def test_chain_documents_of_any_depth(spark, depth):
    tree = _tree(f"n{depth}")
    for d in range(depth - 1, -1, -1):
        tree = _tree(f"n{d}", tree)
    good, bad = parse_chains(docs(spark, json.dumps({"id": 1, "chain": tree}), type_="chain"))
    assert bad.count() == 0
    want = [f"n{d}" for d in range(depth + 1)]
    assert first_branch(good).collect()[0].members == want
    assert [r.member for r in all_members(good).orderBy("depth").collect()] == want


def test_chain_documents_take_one_table_for_many_levels(spark, monkeypatch):
    written = []
    monkeypatch.setattr(chains, "materialize", lambda df, path: written.append(path) or materialize(df, path))
    tree = _tree("n", *[_tree(f"a{k}", *[_tree(f"b{k}{j}", _tree("c")) for j in range(3)]) for k in range(4)])
    good, _ = parse_chains(docs(spark, json.dumps({"id": 1, "chain": tree}), type_="chain"))
    assert all_members(good).count() == 1 + 4 + 12 + 12 and len(written) == 1


def test_edge_walk_of_10000_levels(spark, monkeypatch):
    """Beside the deep line, branches off it, a tree without a root and a short one."""
    written = []
    monkeypatch.setattr(chains, "materialize", lambda df, path: written.append(path) or materialize(df, path))
    rng = random.Random(7)
    parent = {f"d{k}": f"d{k - 1}" for k in range(1, 10_001)}
    parent |= {f"b{k}": rng.choice([f"d{rng.randrange(10_001)}", f"b{rng.randrange(k)}" if k else "d0"]) for k in range(2000)}
    parent |= {"x1": "x0", "x2": "x1", "s1": "s0", "s2": "s0"}
    roots = spark.createDataFrame([(1, "d0", "D"), (2, "s0", "S"), (3, "alone", "A"), (4, "s0", "S again")], "chain_id long, node string, name string")
    edges = spark.createDataFrame([(p, c, c.upper()) for c, p in parent.items()], "parent string, child string, child_name string")
    got = sorted(tuple(r) for r in walk_edges(roots, edges).collect())
    depth = {"d0": 0, "s0": 0, "x0": 0}
    top = {"d0": "d0", "s0": "s0", "x0": "x0"}
    for c in parent:
        line = []
        while c not in depth:
            line.append(c)
            c = parent[c]
        for k, n in enumerate(reversed(line)):
            depth[n], top[n] = depth[c] + k + 1, top[c]
    want = [(i, c.upper(), depth[c]) for i, r in ((1, "d0"), (2, "s0"), (4, "s0")) for c in parent if top[c] == r]
    assert got == sorted(want + [(1, "D", 0), (2, "S", 0), (3, "A", 0), (4, "S again", 0)])
    assert len(written) <= 16  # one job each, beside the check of the edges and their count


def test_edge_walk_to_a_hot_ancestor(spark):
    edges = materialize(spark.range(100).selectExpr("'r' parent", "cast(id as string) child"), scratch_path(spark, "test"))
    tops = top_ancestors(edges)
    assert tops.select("top").distinct().collect()[0].top == "r" and tops.count() == 100


def test_edge_walk_of_many_rows(spark):
    roots = spark.createDataFrame([(1, "r", "root")], "chain_id long, node string, name string")
    edges = spark.range(1_200_000).selectExpr("'r' parent", "concat('c', id) child", "concat('n', id) child_name")
    assert walk_edges(roots, edges).count() == 1_200_001


def test_edge_walk_refuses_cycles(spark):
    roots = spark.createDataFrame([(1, "a", "a")], "chain_id long, node string, name string")
    for rows in ([("a", "b", "b"), ("b", "a", "a")], [("a", "b", "b"), ("b", "c", "c"), ("c", "b", "b")],
                 [("a", "b", "b"), ("x", "y", "y"), ("y", "z", "z"), ("z", "x", "x"), ("z", "t", "t")], [("q", "q", "q")]):
        with pytest.raises(NotATree):
            walk_edges(roots, spark.createDataFrame(rows, "parent string, child string, child_name string"))


def test_listing(spark):
    d = docs(spark, json.dumps({"results": [{"url": "https://h.example.com/api/7/"}, {"url": "https://h.example.com/api/8/", "name": "x"}]}),
             json.dumps({"results": []}), "oops", type_="listing")
    assert sorted((r.id, r.key) for r in parse_listing(d, keep=("id",)).collect()) == [(0, "7"), (0, "8")]


def test_chain_documents_are_dealt_over_tasks_and_read_once(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(chains, "materialize", lambda df, path: plans.append(df._jdf.queryExecution().executedPlan().toString()) or materialize(df, path))
    rows = [json.dumps({"id": i, "chain": _tree(f"r{i}", _tree(f"k{i}")) if i % 3 else None}) for i in range(12)]
    good, _ = parse_chains(docs(spark, *rows, type_="chain").coalesce(1))
    found = first_branch(good)
    assert {r.chain_id: r.members for r in found.collect()} == {i: [f"r{i}", f"k{i}"] if i % 3 else [] for i in range(12)}
    assert len(plans) == 1 and "RoundRobinPartitioning" in plans[0]
    assert plans[0].count("parseJson(") == 1 and "parseJson(" not in found._jdf.queryExecution().executedPlan().toString()


def test_documents_are_parsed_once_under_a_filter(spark):
    d = docs(spark, json.dumps(ENT), "oops")
    good, bad = parse_entities(d)
    for df in (good, bad):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
    with_copy = parse_entities(d, keep=("raw",), workdir=scratch_path(spark, "test_marked"))
    assert [r.raw for r in with_copy[0].collect()] == [json.dumps(ENT)]
    written = parse_entities(d, workdir=scratch_path(spark, "test_marked"))
    assert written[0].collect() == good.collect() and written[1].collect() == bad.collect()
    for df in written:
        assert "from_json(" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_route_unknown_type(spark):
    rows = [("entity", 1, json.dumps(ENT)), ("cohort", 2, json.dumps({"id": 2, "name": "g"})),
            ("weird", 3, "{}"), (None, 4, "{}"), ("entity", 5, "oops")]
    d = spark.createDataFrame(rows, "type string, id long, raw string")
    routed, rejected = route_documents(d, {"entity": ENTITIES, "cohort": COHORTS})
    assert routed["entity"].count() == 1 and routed["cohort"].count() == 1
    assert sorted(r.id for r in rejected.collect()) == [3, 4, 5]


def test_routing_scans_and_parses_once(spark):
    """The write has one scan, one parse per type behind a test of the type;
    every result reads its own partitions of it."""
    path = scratch_path(spark, "test_route_scan")
    rows = [("entity", json.dumps(ENT)), ("cohort", json.dumps({"id": 2, "name": "g"})), ("chain", json.dumps({"id": 3, "chain": _tree("a")})), ("x", "{}")]
    spark.createDataFrame(rows, "type string, raw string").write.parquet(path)
    docs = spark.read.parquet(path)
    plan = marked_by_type(docs, KINDS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("from_json(") == 2 and plan.count("try_parse_json(") + plan.count("parse_json(") <= 2
    routed, rejected = route_documents(docs, KINDS)
    for df in (*routed.values(), rejected):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "PartitionFilters: [isnotnull(__" in plan and "from_json" not in plan and "DataFilters: []" in plan
    assert [df.count() for df in routed.values()] == [1, 1, 1] and [tuple(r) for r in rejected.collect()] == [("x", "{}", "unknown type")]


def test_landing_append_and_dedup(spark):
    path = scratch_path(spark, "test_landing")
    v1 = dict(ENT, name="old")
    v2 = dict(ENT, name="new")
    broken = "{broken\r\n  over \n\n lines\n"
    land(docs(spark, json.dumps(v1), broken), path, ingest=1)
    land(docs(spark, json.dumps(v2, indent=2)), path, ingest=2)   # several lines
    landed = read_landing(spark, path, "entity")
    assert landed.count() == 3  # appended, like re-running the original landing
    good, bad = split_marked(mark_entities(landed), keep=("ingest",))
    assert [(r.name, r.ingest) for r in latest_version(good, ["id"], "ingest").collect()] == [("new", 2)]
    assert [(r.raw, r.reason, r.ingest) for r in bad.collect()] == [(broken, "does not parse", 1)]  # as received
    land(docs(spark, "a\x1eb", "", type_="other"), path, ingest=3)
    assert sorted(r.raw for r in read_landing(spark, path, "other").collect()) == ["", "a\\u001eb"]


def test_json_array_files_and_parquet_roundtrip(spark, tmp_path):
    f = tmp_path / "arr.json"
    f.write_text(json.dumps([ENT, dict(ENT, id=2, name="b"), {"name": "no id"}], indent=2))
    df, bad = entities_from_docs(read_json_arrays(spark, str(f), ENTITY_DOC))
    assert sorted(r.id for r in df.collect()) == [1, 2] and [r.reason for r in bad.collect()] == ["no id"]
    root = scratch_path(spark, "test_files")
    publish({"x": df.select("id", "name")}, root)
    assert sorted(r.id for r in read_published(spark, root, "x").collect()) == [1, 2]


def test_json_array_elements_fail_alone(spark, tmp_path):
    bad = dict(ENT, id=2, stats=[{"base_stat": "oops"}])
    (tmp_path / "a.json").write_text(json.dumps([ENT, bad, None, 7, {"name": "no id"}, dict(ENT, id=3, more={"x": [1]})], indent=2))
    (tmp_path / "b.json").write_text('[{"id": 9}, {"id": ')
    (tmp_path / "c.json").write_text(json.dumps(dict(ENT, id=4)))
    (tmp_path / "d.json").write_text("[]")
    elements = read_json_elements(spark, str(tmp_path))
    good, rejects = parse_entities(elements, keep=("file", "pos"))
    assert sorted((r.file[-6:], r.pos, r.id) for r in good.collect()) == [("a.json", 0, 1), ("a.json", 5, 3), ("c.json", 0, 4)]
    assert good.where("id = 1").select("measures").first()[0][0].value == 45
    assert sorted((r.file[-6:], r.pos, r.reason) for r in rejects.collect()) == [
        ("a.json", 1, "does not parse"), ("a.json", 2, "does not parse"), ("a.json", 3, "does not parse"), ("a.json", 4, "no id"),
        ("b.json", 0, "does not parse")]
    assert json.loads(elements.where("pos = 5").first().raw)["more"] == {"x": [1]}  # a field that no schema names
    assert json.loads(rejects.where("pos = 1").first().raw) == bad


def test_scan_local_explicit_schema(spark):
    df = scan_local(spark, [(1, "a", [("hp", 3)], [("t", True)], ["k"])], ENTITY)
    assert df.schema == ENTITY
    assert df.collect()[0].measures[0].value == 3


def test_route_documents_from_landing_folder(spark):
    path = scratch_path(spark, "test_route_landing")
    rows = [("entity", 1, json.dumps(ENT)), ("cohort", 2, json.dumps({"id": 2, "name": "g", MEMBERS: []})),
            ("weird", 3, "{}"), ("entity", 4, "oops")]
    land(spark.createDataFrame(rows, "type string, id long, raw string"), path, ingest=1)
    routed, rejected = route_documents(read_landing(spark, path),
                                       {"entity": ENTITIES, "cohort": COHORTS})
    assert [r.id for r in routed["entity"].collect()] == [1]
    assert [r.cohort_id for r in routed["cohort"].collect()] == [2]
    assert sorted(r.raw for r in rejected.collect()) == ["oops", "{}"]


def test_landed_files_are_compressed_and_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "LANDED_PER_FILE", 10)
    raw = [json.dumps({"id": i, "name": "n" * 50}) for i in range(45)]
    land(docs(spark, *raw).coalesce(1), str(tmp_path), ingest=1)
    names = [p.name for p in tmp_path.rglob("part-*")]
    assert len(names) == 5 and all(n.endswith(".gz") for n in names)
    assert sorted(r.raw for r in read_landing(spark, str(tmp_path)).collect()) == sorted(raw)


def test_entity_documents_are_made_and_read_without_lambdas(spark):
    """Lists with null elements and fields keep them; no lambda per element."""
    odd = dict(ENT, stats=[None, {"base_stat": 3}, {"stat": {"name": "hp"}}], abilities=[None, {"ability": None, "is_hidden": True}], types=None)
    good, _ = parse_entities(docs(spark, json.dumps(odd), json.dumps({"id": 2})))
    one, two = sorted(good.collect(), key=lambda r: r.id)
    assert [tuple(m) for m in one.measures] == [(None, None), (None, 3), ("hp", None)]
    assert [tuple(t) for t in one.tags] == [(None, None), (None, True)] and one.kinds is None
    assert (two.measures, two.tags, two.kinds) == (None, None, None)
    for df in (good, Fixture(spark, SMALL).entity_docs):
        assert "lambda" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_chain_documents_are_marked_without_a_walk_over_their_nodes(spark):
    """The schema of a tree is as long as the tree; what it may not be is seen without."""
    raw = ['{}', '[]', 'null', '1', '"x"', '{', '{"id":1}', '{"id":"7"}', '{"id":"a"}', '{"id":[1]}', '{"id":1,"chain":null}', '{"id":1,"chain":{}}',
           '{"id":1,"chain":[]}', '{"id":1,"chain":[{"species":1}]}', '{"id":1,"chain":"x"}', '{"id":1,"chain":{"species":null}}', '{"id":1,"chain":{"Species":1}}']
    marked = mark_chains(docs(spark, *raw))
    bad, no_id, good = "does not parse", "no id", None
    assert {r.raw: r.reason for r in marked.collect()} == dict(zip(raw, [
        no_id, bad, bad, bad, bad, bad, good, good, bad, bad, good, good, bad, bad, bad, good, good], strict=True))
    plan = marked._jdf.queryExecution().optimizedPlan().toString().lower().replace("_", "")
    assert "schemaofvariant" not in plan


def test_landed_files_take_the_fastest_level(spark, tmp_path):
    raw = [json.dumps({"id": i, "name": f"e{i * 7919 % 1000}", "stats": [{"base_stat": i * i % 977, "stat": {"name": "hp"}}] * 4}) for i in range(4000)]
    land(docs(spark, *raw).coalesce(1), str(tmp_path), ingest=1)
    size = sum(p.stat().st_size for p in tmp_path.rglob("part-*.gz"))
    text = "".join(r + files.RECORD_END for r in raw).encode()
    assert size > (len(zlib.compress(text, 1)) + len(zlib.compress(text, 6))) / 2
