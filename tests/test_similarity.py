"""similar_pairs equals a brute force; plan shape; edge cases."""

import math
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cohortkit.operators import similarity
from cohortkit.operators.similarity import cosine_to_centroid, similar_pairs, tfidf_weights
from cohortkit.sources.files import materialize

SCHEMA = ("id long, name string, cohort_id long, chain_id long, "
          "tags array<struct<tag:string,hidden:boolean>>")


def brute(rows, t, differ=("cohort_id", "chain_id")):
    """All ordered pairs, exact TF-IDF cosine (MLlib IDF formula)."""
    m = len(rows)
    named = {}
    for r in rows:  # tags are counted by name
        named.setdefault(r[1], Counter()).update(x for x, _ in (r[4] or []))
    tfs = [named[r[1]] for r in rows]
    df = Counter(tag for tf in tfs for tag in tf)
    vecs = []
    for tf in tfs:
        w = {k: c * math.log((m + 1) / (df[k] + 1)) for k, c in tf.items()}
        w = {k: v for k, v in w.items() if v > 0}
        n = math.sqrt(sum(v * v for v in w.values()))
        vecs.append({k: v / n for k, v in w.items()} if n > 0 else {})
    idx = {"cohort_id": 2, "chain_id": 3}
    out = {}
    for i, a in enumerate(rows):
        for j, b in enumerate(rows):
            if i == j or any(a[idx[c]] is None or b[idx[c]] is None or a[idx[c]] == b[idx[c]] for c in differ):
                continue
            s = sum(v * vecs[j].get(k, 0.0) for k, v in vecs[i].items())
            if s > t:
                out.setdefault((a[1], b[1]), []).append(s)
    return {k: sorted(v) for k, v in out.items()}


def run(spark, rows, t, **kw):
    base = spark.createDataFrame(rows, SCHEMA)
    out = {}
    for r in similar_pairs(base, t, **kw).collect():
        out.setdefault((r.name_i, r.name_j), []).append(r.score)
    return {k: sorted(v) for k, v in out.items()}


def same(got, want):
    # pairs within 1e-9 of the threshold may go either way by rounding
    assert set(got) == set(want), (set(got) ^ set(want))
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1e-9)


def test_repeated_tags_zero_weight_and_null_keys(spark):
    rows = [
        (1, "a", 1, 1, [("x", False), ("x", False), ("y", True)]),
        (2, "b", 2, 2, [("x", False), ("y", False), ("y", False)]),
        (3, "c", 3, 3, [("x", False), ("y", False)]),
        (4, "d", 4, None, [("x", False), ("y", False)]),   # NULL chain: never paired
        (5, "e", 5, 5, []),                                 # no tags: no vector
        (6, "f", 1, 6, [("z", False)]),
    ]
    got = run(spark, rows, 0.5)
    same(got, brute(rows, 0.5))
    assert not any("d" in k or "e" in k for k in got)


def test_negative_threshold_rejected(spark):
    with pytest.raises(ValueError):
        run(spark, [(1, "a", 1, 1, [("x", False)])], -0.1)


def test_hot_tag_is_split_into_blocks(spark):
    # one tag held by every row but one (a third of all rows would do as well)
    rows = [(i, f"n{i}", i % 5, i, [("hot", False), (f"r{i % 7}", False)]) for i in range(60)]
    rows.append((99, "solo", 9, 99, [("x", False)]))
    want = brute(rows, 0.6)
    same(run(spark, rows, 0.6, block_size=4), want)
    same(run(spark, rows, 0.6, block_size=1000), want)


def test_names_in_two_groups_count_their_tags_twice(spark):
    rows = [(1, "a", 1, 1, [("x", False), ("y", True)]), (1, "a", 2, 1, [("x", False), ("y", True)]),
            (2, "b", 3, 2, [("x", False), ("z", False)]), (3, "a", 4, 3, [("z", False)]), (4, "c", 5, 4, [("q", True)])]
    from cohortkit.operators.similarity import term_frequency
    tf = term_frequency(spark.createDataFrame(rows, SCHEMA), ["id", "cohort_id"]).collect()
    assert sorted((r.id, r.cohort_id, r.tag, r.tf) for r in tf if r.id != 2 and r.id != 4) == sorted(
        (i, c, t, n) for i, c in [(1, 1), (1, 2), (3, 4)] for t, n in [("x", 2), ("y", 2), ("z", 1)])
    same(run(spark, rows, 0.2), brute(rows, 0.2))


tag_lists = st.lists(st.tuples(st.sampled_from("abcdefg"), st.booleans()), min_size=0, max_size=6)
row_st = st.tuples(st.integers(0, 3), st.integers(0, 3), tag_lists)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(row_st, min_size=2, max_size=14),
       t=st.sampled_from([0.0, 0.3, 0.6, 0.75, 0.95]),
       block=st.sampled_from([1, 2, 64]), shared=st.integers(1, 3))
def test_equals_brute_force(spark, data, t, block, shared):
    rows = [(i, f"n{i // shared}", c, h, tags) for i, (c, h, tags) in enumerate(data)]
    want = brute(rows, t)
    got = run(spark, rows, t, block_size=block)
    # exclude scores within rounding distance of the threshold
    edge = {k for x in (want, got) for k, v in x.items() if any(abs(s - t) < 1e-9 for s in v)}
    assert {k: v for k, v in got.items() if k not in edge}.keys() == \
        {k: v for k, v in want.items() if k not in edge}.keys()


def test_plan_has_no_all_pairs_product_and_no_python(spark):
    rows = [(i, f"n{i}", i % 3, i, [("a", False), (f"b{i % 4}", False)]) for i in range(20)]
    base = spark.createDataFrame(rows, SCHEMA)
    plan = similar_pairs(base, 0.5)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan


def test_a_hot_tag_can_be_split_in_the_weights_join(spark):
    """Both sides of the join with the idf are plain shuffles, which is where
    Spark splits skewed partitions; a third of all rows hold one tag."""
    rows = [(i, f"n{i}", i % 5, i, [("hot" if i % 3 == 0 else f"r{i % 17}", False), (f"s{i % 11}", False)]) for i in range(300)]
    base = spark.createDataFrame(rows, SCHEMA)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = tfidf_weights(base, ["id"])._jdf.queryExecution().executedPlan().toString()
        lines = plan.splitlines()
        at = next(k for k, x in enumerate(lines) if "SortMergeJoin" in x and "__own_key" in x)
        depth = lambda x: len(x) - len(x.lstrip(" :+-"))
        sides = [k for k in range(at + 1, len(lines)) if depth(lines[k]) == depth(lines[at]) + 3]
        assert len(sides) == 2 and all("Sort" in lines[k] and "Exchange hashpartitioning" in lines[k + 1] and "__own_key" in lines[k + 1] for k in sides)
        same(run(spark, rows[:120], 0.6), brute(rows[:120], 0.6))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bounds_drop_pairs_before_vectors(spark, monkeypatch):
    """Every pair shares a tag; only planted pairs reach the vectors."""
    rows = [(i, f"n{i}", i % 5, i, [("all" if k == 0 else f"t{i}_{k}", False) for k in range(5)]) for i in range(120)]
    rows += [(200, "p", 7, 200, rows[0][4]), (201, "q", 8, 201, [*rows[1][4][:4], ("other", False)])]
    seen = []
    found = similarity._prefix_candidates
    monkeypatch.setattr(similarity, "_prefix_candidates", lambda *a: seen.append(found(*a)) or seen[-1])
    same(run(spark, rows, 0.6), brute(rows, 0.6))
    assert seen[0].count() <= 3  # equal vectors are one


def test_dense_cosine_builtin_equals_udf(spark):
    rows = [(1, 0, [1.0, 0.0]), (2, 0, [0.0, 1.0]), (3, 1, [1.0, 1.0]), (4, 1, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    a = {r.vec_id: r.cosine for r in cosine_to_centroid(df, "vec_id", "label", "embedding").collect()}
    b = {r.vec_id: r.cosine for r in cosine_to_centroid(df, "vec_id", "label", "embedding", use_udf=True).collect()}
    assert a[1] == pytest.approx(math.sqrt(0.5)) and a[3] == pytest.approx(1.0)
    assert a[4] is None and b[4] is None
    for k in (1, 2, 3):
        assert a[k] == pytest.approx(b[k])


def test_long_vectors(spark):
    rows = [(i, f"n{i}", i % 4, i, [(f"t{(i * 7 + k) % 40}", False) for k in range(18 + i % 5)])
            for i in range(16)]
    want = brute(rows, 0.3)
    assert want
    same(run(spark, rows, 0.3), want)


def test_prefix_entries_are_shuffled_once_for_both_sides(spark, tmp_path, monkeypatch):
    """Only distinct vectors are paired; both sides of the join read one shuffle."""
    rows = [(i, f"n{i}", i % 5, i, [(f"a{i % 12}", False), (f"b{i % 4}", False)]) for i in range(60)]
    for few in (0, 500_000):  # vectors written without those that repeat, or not
        monkeypatch.setattr(similarity, "_FEW_OTHERS", few)
        same(run(spark, rows, 0.6), brute(rows, 0.6))
    vectors = materialize(spark.createDataFrame(
        [((i, i), [f"t{i % 9}", f"u{i % 7}"], [0.9, 0.4], [0.4, 0.0], 2, 0.9, 3, 3, 0, 0) for i in range(60)],
        "vid struct<a:long,b:long>, vt array<string>, vu array<double>, rest array<double>, n_pre int, top double, "
        "sig1 long, sig2 long, hid_sig1 int, hid_sig2 int"), str(tmp_path / "vectors"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = similarity._prefix_candidates(vectors, 1024, 0.1, str(tmp_path))
        assert found.count() == found.distinct().count() > 0
        found.collect()
        assert "ReusedExchange" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    hot = similarity._prefix_candidates(vectors, 2, 0.1, str(tmp_path / "hot"))
    pairs = lambda df: sorted(sorted([r.a_vid.a, r.b_vid.a]) for r in df.collect())
    assert pairs(hot) == pairs(found)
