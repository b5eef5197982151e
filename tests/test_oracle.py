"""Every registered query against its DuckDB oracle on sf0.001."""

import hashlib
import math

import duckdb
import pytest

from __spark_entry__ import entry
from cohortkit.plans.fixtures import TABLES
from cohortkit.plans.oracle import ORACLE
from cohortkit.plans.queries import QUERIES
from tests.conftest import SMALL


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _kind(name):
    """Type family: integers of any width are one, as are floats and texts."""
    name = name.lower()
    if name.startswith("array") or name.endswith("[]") or name == "list":
        return "list"
    for kind, names in {"int": ("bigint", "int", "integer", "long", "smallint", "number", "hugeint"), "float": ("double", "float"),
                        "text": ("string", "varchar"), "bool": ("boolean", "bool")}.items():
        if name in names:
            return kind
    return name


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    keyed = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha1("\n".join(keyed).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["name_i", "name_j", "score"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert {f.name: _kind(f.dataType.simpleString()) for f in df.schema.fields} == {d[0]: _kind(str(d[1])) for d in cur.description}
    assert len(rows) == len(orows)
    assert _digest(rows, cols) == _digest(orows, ocols)
