"""The holder index against plain sets, and its bounded forms."""

import random

import pytest

from cohortkit.operators.holders import DENSE, WIDTH, expand_holders, holder_counts, holder_index, number_entities
from cohortkit.operators.tags import tag_split
from cohortkit.session import scratch_path
from cohortkit.sources.files import materialize


def test_index_equals_the_split(spark):
    """One tag that all of three buckets hold, one at the border of the two
    forms, rare ones, repeats, null flags and a null tag."""
    rng = random.Random(2)
    n = 2 * WIDTH + 100
    hot = spark.range(n).selectExpr("concat('e', lpad(id, 6, '0')) name", "'hot' tag", "id % 3 = 0 hidden")
    rare = [(f"e{rng.randrange(n):06d}", f"t{rng.randrange(30)}", rng.choice([True, False, None])) for _ in range(400)]
    edge = [(f"e{k:06d}", "edge", k < DENSE) for k in range(2 * DENSE - 1)]
    rows = spark.createDataFrame(rare + rare[:50] + edge + [("e000001", None, True), (None, "hot", True)], "name string, tag string, hidden boolean")
    long = materialize(hot.unionByName(rows), scratch_path(spark, "test_long"))
    numbers = materialize(number_entities(long), scratch_path(spark, "test_numbers"))
    assert numbers.selectExpr("min(number)", "max(number)", "count(*)", "count(distinct number)").first()[:] == (1, n, n, n)
    index = materialize(holder_index(long, numbers), scratch_path(spark, "test_index"))
    assert index.where("(bits is null) = (positions is null)").count() == 0
    assert index.where("tag = 'hot' and bits is not null").count() == 4 and index.where("size(positions) >= %d" % DENSE).count() == 0
    assert sorted(r.n for r in index.where("tag = 'edge'").selectExpr("coalesce(bitmap_count(bits), -size(positions)) n").collect()) == [-(DENSE - 1), DENSE]
    named = long.where("name is not null")
    key = lambda r: tuple(map(str, r))
    got = expand_holders(index, numbers)
    want = tag_split(named, full=True).select("tag", "hidden", "name")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    both = expand_holders(index, numbers, both_ways=True)
    want = tag_split(named).select("tag", "hidden", "name")
    assert both.exceptAll(want).count() == 0 and want.exceptAll(both).count() == 0
    held = {}
    for r in named.where("hidden is not null").collect():
        held.setdefault(r.tag, {True: set(), False: set()})[r.hidden].add(r.name)
    assert sorted(map(key, holder_counts(index).collect())) == sorted(
        key((t, len(s[True]), len(s[False]), bool(s[True] and s[False]))) for t, s in held.items())


@pytest.mark.parametrize("dense", [1, 10**6])
def test_either_form_alone(spark, dense):
    long = spark.createDataFrame([(f"e{k}", f"t{k % 3}", k % 2 == 0) for k in range(40)], "name string, tag string, hidden boolean")
    numbers = number_entities(long)
    index = holder_index(long, numbers, dense=dense)
    assert sorted(map(tuple, expand_holders(index, numbers).collect())) == sorted((r.tag, r.hidden, r.name) for r in long.collect())
    assert holder_index(long.limit(0), numbers, dense=dense).count() == 0
