"""MLlib's hashed TF-IDF against counts per bucket; empty, NULL and new rows."""

import math
from collections import Counter

from pyspark.ml import PipelineModel
from pyspark.ml.feature import HashingTF

from cohortkit.operators import hashed
from cohortkit.operators.hashed import bucket_table, fit_hashed, hashed_counts, hashed_weights, hashing
from cohortkit.session import scratch_path

SCHEMA = "id long, name string, tags array<struct<tag:string,hidden:boolean>>"
ROWS = [(i, f"n{i % 9}", [(f"t{i % 5}", True), ("hot", False), ("", False), (None, True), ("héllo wörld", True)]) for i in range(40)]
ROWS += [(90, "bare", []), (91, "null", None), (92, None, [("hot", True)])]


def brute(rows, seen, stage):
    """Weights of ``rows`` by the document frequencies of ``seen``."""
    def vectors(table):
        named = {}
        for _, name, tags in table:
            if name is not None:
                named.setdefault(name, Counter()).update(stage.indexOf(t) for t, _ in tags or [] if t is not None)
        return [(i, named.get(name, Counter())) for i, name, _ in table]

    df = Counter(b for _, v in vectors(seen) for b in v)
    return {(i, b): (n, n * math.log((len(seen) + 1) / (df[b] + 1))) for i, v in vectors(rows) for b, n in v.items()}


def test_weights_equal_counts_per_bucket(spark):
    base = spark.createDataFrame(ROWS, SCHEMA)
    for n_features in (1 << 18, 4):  # four buckets: most tags collide
        path = scratch_path(spark, "test_model")
        fit_hashed(base, path, n_features)
        model = PipelineModel.load(path)
        assert isinstance(model.stages[0], HashingTF) and model.stages[0].getNumFeatures() == n_features
        want = brute(ROWS, ROWS, model.stages[0])
        got = {(r.id, r.bucket): (r.tf, r.weight) for r in hashed_weights(base, ["id"], model).collect()}
        assert set(got) == set(want)
        assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-9 for k in want)


def test_new_rows_are_weighed_by_the_saved_model(spark):
    model = fit_hashed(spark.createDataFrame(ROWS, SCHEMA), scratch_path(spark, "test_model"))
    new = [(1, "x", [("hot", True), ("hot", False), ("unseen", True)])]
    got = {(r.id, r.bucket): (r.tf, round(r.weight, 9)) for r in hashed_weights(spark.createDataFrame(new, SCHEMA), ["id"], model).collect()}
    assert got == {k: (n, round(w, 9)) for k, (n, w) in brute(new, ROWS, model.stages[0]).items()}


def test_every_row_has_a_vector(spark):
    vectors = hashed_counts(spark.createDataFrame(ROWS, SCHEMA), ["id"], hashing())
    by_id = {r.id: r.tf for r in vectors.collect()}
    assert len(by_id) == len(ROWS) and all(v.size == 1 << 18 for v in by_id.values())
    assert all(by_id[i].numNonzeros() == 0 for i in (90, 91, 92)) and by_id[0].numNonzeros() > 2


def test_collisions_are_reported(spark):
    base = spark.createDataFrame(ROWS, SCHEMA)
    own = {r.tag: (r.bucket, r.n_sharing) for r in bucket_table(base, hashing(4)).collect()}
    stage = hashing(4)
    assert {t: b for t, (b, _) in own.items()} == {t: stage.indexOf(t) for t in own} and len(own) == 8
    shared = Counter(b for b, _ in own.values())
    assert all(n == shared[b] for b, n in own.values()) and max(shared.values()) > 1


def test_no_rows(spark):
    base = spark.createDataFrame(ROWS, SCHEMA)
    model = fit_hashed(base, scratch_path(spark, "test_model"))
    assert hashed_weights(base.limit(0), ["id"], model).count() == 0
    assert bucket_table(base.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    base = spark.createDataFrame(ROWS, SCHEMA)
    plan = hashed_weights(base, ["id"], fit_hashed(base, scratch_path(spark, "test_model")))._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan


def test_one_count_serves_fit_and_weights(spark, monkeypatch):
    base, stage = spark.createDataFrame(ROWS, SCHEMA), hashing()
    calls = []
    monkeypatch.setattr(hashed, "hashed_counts", lambda *a, **k: calls.append(a) or hashed_counts(*a, **k))
    counted = hashed_counts(base, ["id"], stage)
    model = fit_hashed(base, scratch_path(spark, "model"), counted=counted)
    got = {(r.id, r.bucket): (r.tf, r.weight) for r in hashed_weights(base, ["id"], model, counted).collect()}
    want = brute(ROWS, ROWS, stage)
    assert not calls and got.keys() == want.keys()
    assert all(got[k][0] == want[k][0] and math.isclose(got[k][1], want[k][1], abs_tol=1e-9) for k in want)
