"""Hard negatives, source divergence and toxicity against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortkit.llm import hard_negatives as hard, source_divergence as div, toxicity as tox
from cohortkit.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def brute_negatives(rows, positives=5, negatives=5):
    ok = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    good = [(k, i, [math.floor(256 * x) for x in v], y) for k, (i, v, y) in enumerate(rows) if y is not None and ok(v)]
    good = [r for r in good if sum(x * x for x in r[2]) < 2**59]
    last = lambda i: (i is None, i or 0)
    out = []
    for k, i, v, y in good:
        if i is None or i % 100:
            continue
        scores = [(sum(a * b for a, b in zip(v, w)), j, z) for n, j, w, z in good if n != k and len(w) == len(v)]
        scores.sort(key=lambda s: (-s[0], last(s[1])))
        for ps, p, _ in [s for s in scores if s[2] == y][:positives]:
            inside = [s for s in scores if s[2] != y and 80 * ps <= 100 * s[0] <= 100 * ps][:negatives]
            out += [(i, p, r + 1, n, ps, s) for r, (s, n, _) in enumerate(inside)]
    return sorted(out, key=repr)


def vectors(seed, n=260, dim=8):
    rng, rows = np.random.default_rng(seed), []
    base = rng.normal(0, 1, (6, dim))
    for i in range(n):
        kind = rng.random()
        if kind < 0.3:
            v = base[0]  # a third of all rows is one vector
        elif kind < 0.8:
            v = base[rng.integers(0, 6)] + rng.normal(0, 0.4, dim)
        else:
            v = rng.normal(0, rng.choice([0.1, 1, 5]), dim)
        rows.append((int(i * 5), [float(x) for x in v], int(rng.integers(0, 3))))
    return rows


ODD = [(None, [1.0] * 8, 1), (700, None, 1), (800, [1.0] * 8, None), (900, [float("nan")] + [1.0] * 7, 1), (1000, [None] + [1.0] * 7, 1),
       (1100, [float("inf")] * 8, 0), (1200, [0.0] * 8, 1), (1300, [0.0] * 8, 2), (1400, [1.0, 2.0], 1), (1500, [1.0, 2.0], 1), (1501, [1.0, 2.0], 2),
       (1600, [], 1), (1601, [], 1), (1602, [], 0), (1700, [1e300] * 8, 1), (1800, [1e5] * 8, 1), (1801, [1e5] * 8, 1), (1802, [99999.0] * 8, 2),
       (0, [1.0] * 8, 1), (0, [1.0] * 8, 1), (0, [2.0] * 8, 1), (3, [1.0] * 8, 0), (3, [1.0] * 8, 0), (-100, [-0.001] * 8, 2)]
SCHEMA = "vec_id long, embedding array<double>, label int, rid long, id string, block int, windows string"


@pytest.mark.parametrize("block", [4096, 16])
def test_negatives_equal_brute_force(spark, block):
    rows = vectors(block) + ODD
    table = spark.createDataFrame([(*r, 1, "x", 2, None) for r in rows], SCHEMA).repartition(3)
    got = hard.hard_negatives(table, block=block).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_negatives(rows)


def test_negatives_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert hard.hard_negatives(empty).count() == 0
    assert hard.hard_negatives(spark.createDataFrame([(100, [1.0], 1, 1, "x", 2, None)], SCHEMA)).count() == 0


def test_bounds_hold_and_leave_out(spark):
    rng = np.random.default_rng(2)
    x = np.floor(256 * (rng.normal(0, 1, (12, 1, 16)) + rng.normal(0, 0.1, (12, 50, 16)))).reshape(-1, 16)
    refs = hard.references([v for v in x], 16)
    angle, norm = hard.angles(x, refs), np.sqrt((x * x).sum(1))
    left_out = 0
    for k in range(len(x)):
        low, high = hard.score_bounds(angle, norm, angle[k], norm[k])
        score = x @ x[k]
        assert (low <= score).all() and (score <= high).all()
        left_out += (high < 0.8 * score.max()).sum()
    assert left_out > 0.2 * len(x) ** 2


def brute_divergence(docs, min_docs=3, top=200):
    terms = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    rows = [(lang or "", source or "", Counter(terms(text))) for text, lang, source in docs]
    out = []
    for lang in sorted({r[0] for r in rows}):
        own = [r for r in rows if r[0] == lang]
        seen, whole, by = Counter(), Counter(), {}
        for _, s, c in own:
            seen.update(c.keys())
        kept = {t for t, n in seen.items() if n >= min_docs}
        for _, s, c in own:
            c = {t: n for t, n in c.items() if t in kept}
            whole.update(c)
            by.setdefault(s, Counter()).update(c)
        share = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}
        q, p = share(whole), {s: share(c) for s, c in by.items()}
        for s in by:
            pairs = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in by if o != s]
            telling = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if by[s][t] > 0 and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", telling, top)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, i, v, k + 1) for k, (v, i) in enumerate(items[:most])]
    return sorted(out)


def some_docs(seed, n=150, sources=7):
    rng = random.Random(seed)
    lexicon = ["the", "Of", "né", "漢字", "abcdefgh", "abcdefghi", "abcdefghijklmnop", "abcdefghijklmnopq", "x" * 40, "y" * 70, "é" * 30, "a", "ABCDEFGH"]
    lexicon += [f"{a}{b}{'z' * rng.randrange(12)}" for a in "abcdef" for b in ("ou", "ère", "straße", "ing")]
    rows = [(" ".join(rng.choice(lexicon) + rng.choice(["", "1", ".", "_"]) for _ in range(rng.choice([0, 1, 5, 40]))),
             rng.choice(["en", "en", "de", None, "zz"]), rng.choice([None, *[f"s{k}" for k in range(sources)], "s0", "s0", "s0"])) for _ in range(n)]
    return rows + [(None, "en", "s1"), ("", "qq", "only"), ("!!! 123", "qq", None), ("long " * 5000 + "w" * 100_000, "en", "s2"), (None, None, None)]


@pytest.mark.parametrize("held,block,sources", [(1 << 19, 256, 7), (20, 3, 12)])
def test_divergence_equals_brute_force(spark, monkeypatch, held, block, sources):
    monkeypatch.setattr(div, "HELD", held)
    monkeypatch.setattr(div, "PAIRS", 50 if block == 3 else 1 << 20)
    rows = some_docs(sources, sources=sources)
    table = spark.createDataFrame([(*r, 1, "x", 5) for r in rows], "text string, lang string, source string, n int, term string, gid int").repartition(3)
    got = div.source_divergence(table, top=20, block=block).collect()
    assert sorted(tuple(r) for r in got) == brute_divergence(rows, top=20)


def test_divergence_of_nothing(spark):
    assert div.source_divergence(spark.createDataFrame([], "text string, lang string, source string")).count() == 0


def test_packing_keeps_terms_and_their_order():
    rng = random.Random(1)
    terms = sorted({"".join(rng.choice("abézß漢") for _ in range(rng.randrange(1, 7))) for _ in range(300)}, key=str.encode)
    terms = [t for t in terms if len(t.encode()) <= 16]
    raw = b"".join(t.encode() for t in terms) + bytes(16)
    end = np.cumsum([len(t.encode()) for t in terms])
    words = div.packed(np.frombuffer(raw, np.uint8), end - [len(t.encode()) for t in terms], end, 2)
    assert div.unpacked(words).to_pylist() == terms
    shuffled = np.array(rng.sample(range(len(terms)), len(terms)))
    assert shuffled[div.radix_order([w[shuffled] for w in words])].tolist() == list(range(len(terms)))


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_source_divergence"])
def test_queries_equal_sql(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.sql(ORACLE[name])
    got = QUERIES[name](spark, SF).collect()
    assert got and sorted(tuple(r[c] for c in want.columns) for r in got) == sorted(want.fetchall())


def test_machine_learns_what_a_sum_cannot():
    rng = np.random.default_rng(0)
    pairs = rng.integers(0, 2, (4000, 2))
    y = (pairs[:, 0] == pairs[:, 1]).astype(float)  # neither feature tells anything alone
    found = [np.array([a, 2 + b], np.int32) for a, b in pairs]
    machine = tox.Machine(found[:3000], y[:3000], 4, epochs=40)
    at = np.arange(0, 2 * 1000 + 1, 2)
    assert ((machine.scores(np.concatenate(found[3000:]), at) > 0.5) == (y[3000:] == 1)).mean() > 0.99
    assert tox.Machine([], np.zeros(0), 4).scores(np.zeros(0, np.int32), np.zeros(4, np.int64)).tolist() == [0.0] * 3
    assert tox.Machine(found[:3], np.ones(3), 4).scores(found[0], np.array([0, 2])).tolist() == [1.0]


def test_features_equal_a_plain_count(spark):
    texts = ["Trash trash trash TRASH x", "", None, "trashy day", "clean words only here and there"]
    rows = spark.createDataFrame([(k % 2, t) for k, t in enumerate(texts)], "label int, text string").repartition(2)
    got = {(r.term, r.level): (r.pos, r.neg) for r in tox.feature_counts(rows).collect()}
    want = {}
    for k, t in enumerate(texts):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
        terms = Counter([("w", w) for w in words] + [(s, w.encode()[:s]) for w in words for s in tox.STEMS if len(w.encode()) >= s])
        for term, n in terms.items():
            for level, least in enumerate(tox.LEVELS):
                if n >= least:
                    pos, neg = want.get((term, level), (0, 0))
                    want[term, level] = (pos + k % 2, neg + 1 - k % 2)
    assert Counter(v for (_, level), v in got.items() if level >= 0) == Counter(want.values())
    reader = tox.Reader(np.array([t for t, _ in got], np.int64), np.array([v for _, v in got], np.int64))
    found, at = reader.read(pa.array(texts, pa.string()))
    assert np.bincount(found, minlength=len(got)).tolist() == [sum(v) for v in got.values()] and at[-1] == len(found)


def test_toxicity_on_held_out_rows(spark):
    import zlib
    sf = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in QUERIES["op13_toxicity"](spark, sf).collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
               for i, r in rows.items())
    seen = [(r.toxic, rows[r.doc_id]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if rows[r.doc_id].held_out]
    bad, good = [r for t, r in seen if t == 1], [r for t, r in seen if t == 0]
    assert np.mean([b.score > g.score for b in bad for g in good]) > 0.9
    assert np.mean([r.predicted for r in bad]) > 0.85 and np.mean([r.predicted for r in good]) < 0.01


def test_toxicity_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(0, 1, 0), (3, 0, 0), (None, 1, 1), (4, None, None), (77, 0, 0), (3, 0, 0), (5, 1, 1), (6, 1, 7)], "doc_id long, quality int, toxic int")
    rows = tox.toxicity_scores(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in tox.toxicity_scores(odd_docs, labels.limit(0)).collect()} == {0.0}
    assert {r.score for r in tox.toxicity_scores(odd_docs, labels.where(F.col("toxic") == 1)).collect()} <= {0.0, 1.0}
    assert tox.toxicity_scores(no_docs, labels).count() == 0
