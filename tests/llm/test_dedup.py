"""Near-duplicate and substring operators against brute force."""

import math
import random
import re

import numpy as np
import pytest

from cohortkit.llm import embedding_dedup as emb, ngram_join as ng, substring_dedup as sub
from cohortkit.llm.components import connected_components
from cohortkit.llm.queries import ORACLE, QUERIES


def brute_words(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def components(ids, linked):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {i: find(i) for i in ids}


def brute_join(docs, threshold=0.8, size=5):
    sets = {}
    for i, t in docs:
        w = brute_words(t)
        sets[i] = {tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
             if sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9]
    n = {i: sum(i in pair for pair in links) for i in ids}
    comp = components(ids, links)
    return {i: (comp[i], n[i]) for i in ids}


def edited(words, rng, share):
    return [f"new{rng.random()}" if rng.random() < share else w for w in words]


def copies_table(spark, n_groups=12, group=9, seed=1):
    rng, rows = random.Random(seed), []
    for _ in range(n_groups):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([3, 12, 60, 300]))]
        rows += [" ".join(edited(base, rng, rng.choice([0, 0.005, 0.02, 0.06]))) for _ in range(group)]
    rows += ["a passage that every document of this kind has in it " * 2 + " ".join(f"u{rng.random()}" for _ in range(20)) for _ in range(40)]
    rng.shuffle(rows)
    return spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")


@pytest.mark.parametrize("small,dense", [(200, 0.5), (4, 0.5), (3, 2.0)])
def test_join_equals_brute_force(spark, small, dense):
    docs = copies_table(spark)
    got = {r.doc_id: (r.class_id, r.n_links) for r in ng.ngram_join(docs, small=small, dense=dense).collect()}
    assert got == brute_join([tuple(r) for r in docs.collect()])


def test_join_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ng, "BLOCK_SETS", 5)
    docs = copies_table(spark, n_groups=3, group=25, seed=2)
    got = {r.doc_id: (r.class_id, r.n_links) for r in ng.ngram_join(docs).collect()}
    assert got == brute_join([tuple(r) for r in docs.collect()])


def test_join_odd_rows(odd_docs, no_docs):
    rows = ng.ngram_join(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert (by_id[9].class_id, by_id[9].n_links, by_id[5].n_links) == (5, 2, 2)  # row 5 stands twice
    assert all(by_id[i].n_links == 0 and by_id[i].class_id == i for i in (0, 1, 2, 3, 4, 6, 7, 8))
    kept = ng.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [0, 1, 2, 3, 4, 5, 6, 7, 8]
    assert kept.where("doc_id is null").count() == 2
    assert ng.ngram_join(no_docs).count() == 0 and ng.keep_one(no_docs).count() == 0


def test_one_of_each_group_stays_without_and_with_repeated_ids(spark):
    """Rows are told apart by id and text: brute force over all pairs of rows."""
    rng = random.Random(4)
    base = [[f"w{rng.randrange(10**6)}" for _ in range(60)] for _ in range(6)]
    rows = [(5, " ".join(base[0])), (None, " ".join(base[0])), (None, " ".join(base[0])), (1, " ".join(base[1])), (2, " ".join(base[2])),
            (2, " ".join([*base[1][:58], "x", "y"])), (None, " ".join(base[3])), (None, " ".join([*base[3], "more"])), (7, ""), (7, ""), (None, None),
            (None, ""), (8, " ".join(base[4])), (8, " ".join(base[4])), (9, " ".join(base[4]).upper()), (9, "few words"), (3, "few words!")]

    def shingles(text):
        w = brute_words(text)
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    distinct = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    sets, group = [shingles(t) for _, t in distinct], list(range(len(distinct)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and len(a & b) >= 0.8 * len(a | b) and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    groups = {}
    for row, s, g in zip(distinct, sets, group, strict=True):
        groups.setdefault(g if s else (row,), []).append(row)
    got = [tuple(r) for r in ng.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert len(got) == len(set(got)) == len(groups)
    for own in groups.values():  # of rows with one id, the one of least digest
        least = min((i is None, i or 0) for i, _ in own)
        assert len([r for r in got if r in own and (r[0] is None, r[0] or 0) == least]) == 1
    assert (5, rows[0][1]) in got and (None, rows[0][1]) not in got and (2, rows[5][1]) not in got


def test_join_without_ids(spark):
    rng = random.Random(4)
    base = [f"w{i}" for i in range(80)]
    rows = [(None, " ".join(edited(base, rng, 0.01))) for _ in range(12)] + [(None, " ".join(base))] * 9 + [(7, " ".join(base))]
    rows += [(8, "x y z a b c"), (8, " ".join(base[::-1])), (9, " ".join(base[::-1]))]
    got = ng.ngram_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    numbered = brute_join([(k, t) for k, (_, t) in enumerate(rows)])
    assert sorted(r.n_links for r in got) == sorted(n for _, n in numbered.values())
    assert {r.class_id for r in got if r.doc_id in (8, 9)} == {8}
    assert {r.class_id for r in got if r.doc_id is None and r.n_links > 9} == {7}


def test_runs_meet_the_recall():
    assert ng.runs_for(0.8, 0.9) < ng.runs_for(0.8, 0.999999) <= 12
    with pytest.raises(ValueError):
        ng.runs_for(0.02, 0.9999)


def test_components_match_union_find(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7), (999, 999)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == components({x for e in edges for x in e}, edges)
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def vectors_table(spark, n=400, seed=3):
    rng, rows = np.random.default_rng(seed), []
    for i in range(n):
        if i and rng.random() < 0.5:
            v = np.array(rows[rng.integers(0, i)][1] or [1.0] * 16, float) + rng.normal(0, rng.choice([0, 0.05, 0.12, 0.3]), 16)
        else:
            v = rng.normal(0, 1, 16)
        rows.append((i, [float(x) for x in v], int(rng.integers(0, 3))))
    return rows


def brute_vectors(rows, threshold=0.93):
    def ok(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
    good = [(k, r) for k, r in enumerate(rows) if ok(r[1]) and r[2] is not None]
    links = [(a, b) for x, (a, r) in enumerate(good) for b, s in good[x + 1:]
             if r[2] == s[2] and len(r[1]) == len(s[1]) and np.dot(r[1], s[1]) / (np.linalg.norm(r[1]) * np.linalg.norm(s[1])) >= threshold]
    comp = components(range(len(rows)), links)
    least = {}
    for k, c in comp.items():
        least[c] = min(least.get(c, rows[k][0]), rows[k][0])
    return sorted((rows[k][0], sum(k in p for p in links), least[comp[k]]) for k in range(len(rows)))


def test_embeddings_equal_brute_force(spark):
    rows = vectors_table(spark)
    rows += [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] + [1.0] * 15, 1), (903, [None] + [1.0] * 15, 1),
             (904, [float("inf")] + [1.0] * 15, 1), (905, [1.0] * 16, None), (906, [1.0] * 8, 1), (907, [1.0] * 8, 1), (908, [], 1),
             (909, [-0.0, 1.0], 2), (910, [0.0, 1.0], 2), rows[5], (5, rows[5][1], rows[5][2])]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, label int, node int, id string")
    for block in (512, 3):
        got = emb.embedding_dedup(table, block=block).collect()
        assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == brute_vectors(rows)
        assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert emb.embedding_dedup(table.limit(0)).count() == 0


def test_embeddings_of_any_magnitude(spark):
    rows = [(1, [1e200, 2e200], 1), (2, [1e-200, 2e-200], 1), (3, [2.0, 4.1], 1), (4, [5e-324, 1e-323], 1), (5, [1.7e308, 1.7e308], 1), (6, [1e300, -2e300], 1)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in emb.embedding_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert got == {1: (4, 1), 2: (4, 1), 3: (4, 1), 4: (4, 1), 5: (4, 1), 6: (0, 6)}


def test_tables_follow_size_and_recall():
    small, large = emb.plan_tables(1000, 0.93, 0.999), emb.plan_tables(10**9, 0.93, 0.999)
    assert small[0] < large[0] and small[1] < large[1]


def brute_sentences(text):
    """Sentences as (words, raw) of one text."""
    raw = text or ""
    units, at, begin = [], 0, 0
    matches = list(re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", raw))
    for k, m in enumerate(matches):
        gap = raw[matches[k - 1].end():m.start()] if k else ""
        if k and re.search(r"\n|[.!?](?=[\t\n\x0b\x0c\r ])", gap):
            cut = matches[k - 1].end() + max(i for i, c in enumerate(gap) if c in "\t\n\x0b\x0c\r ") + 1
            units.append((matches[begin:k], raw[at:cut]))
            at, begin = cut, k
    if matches:
        units.append((matches[begin:], raw[at:]))
    return [([w.lower() if w.isascii() else "".join(c.lower() if c.isascii() else c for c in w) for w in (m[0] for m in ms)], r) for ms, r in units]


def brute_substrings(docs, sentences=3, words=12, alone=40, passage=51, digests=None):
    """``{row: (sentences, sentences gone, text left)}`` of rows ``(id, text)``:
    runs of sentences, then windows of words that do not go with them whole."""
    named = {}
    for k, (i, t) in enumerate(docs):
        if t is not None:
            named.setdefault((i, t), []).append(k)
    order = sorted(named, key=lambda d: (d[0] is None, d[0] or 0, digests[d] if digests else 0))
    units = {d: brute_sentences(d[1]) for d in order}
    flat = {d: [w for ws, _ in units[d] for w in ws] for d in order}
    seen = {}
    for d in order:
        n = [len(w) for w, _ in units[d]]
        at = [sum(n[:k]) for k in range(len(n) + 1)]

        def enough(a, b, n=n):
            total = sum(n[a:b])
            return b - a >= sentences and total >= words or total >= alone
        spans = set()
        for k in range(len(n)):
            spans |= {(k, b) for b in [next((b for b in range(k + 1, len(n) + 1) if enough(k, b)), None)] if b}
            spans |= {(a, k + 1) for a in [next((a for a in range(k, -1, -1) if enough(a, k + 1)), None)] if a is not None}
        for a, b in sorted(spans):
            seen.setdefault(tuple(flat[d][at[a]:at[b]]), []).append((d, at[a], at[b]))
    lost = {d: set() for d in order}
    for found in seen.values():
        for d, a, b in found[1:]:
            lost[d] |= set(range(a, b))
    seen = {}
    for d in order:
        for k in range(len(flat[d]) - passage + 1):
            if not lost[d].issuperset(range(k, k + passage)):
                seen.setdefault(tuple(flat[d][k:k + passage]), []).append((d, k, k + passage))
    for found in seen.values():
        for d, a, b in found[1:]:
            lost[d] |= set(range(a, b))
    out = {k: (0, 0, None) for k, (_, t) in enumerate(docs) if t is None}
    for d in order:
        left, at, gone = "", 0, 0
        for ws, raw in units[d]:
            own = [at + k in lost[d] for k in range(len(ws))]
            at += len(ws)
            gone += all(own)
            if all(own):
                continue
            marks = list(re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", raw))
            keep = [True] * len(raw)
            for k, m in enumerate(marks):
                if own[k]:  # with what stands before the next word
                    keep[m.start():marks[k + 1].start() if k + 1 < len(marks) else m.end()] = [False] * (
                        (marks[k + 1].start() if k + 1 < len(marks) else m.end()) - m.start())
            left += "".join(c for c, yes in zip(raw, keep, strict=True) if yes)
        for k in named[d]:
            out[k] = (len(units[d]), gone, left if units[d] else d[1])
    return out


def passages(seed, n=60):
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "Of", "ab", "né"]) if rng.random() < 0.2 else f"w{rng.randrange(4000)}"
    sentence = lambda: " ".join(word() for _ in range(rng.choice([1, 2, 5, 9, 25, 45]))) + rng.choice([". ", "!\n", "\n", "? ", " .. \"", ".\n\n"])
    shared = ["".join(sentence() for _ in range(rng.choice([1, 2, 4, 8]))) for _ in range(8)]
    rows = []
    for i in range(n):
        parts = [sentence() for _ in range(rng.randrange(0, 9))]
        for _ in range(rng.randrange(0, 3)):
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(shared))
        rows.append((i, "".join(parts)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_substrings_equal_brute_force(spark, seed):
    rows = passages(seed)
    got = sub.substring_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_sentences, r.n_removed, r.text) for r in got} == brute_substrings(rows)  # ids are row numbers
    assert any(r.n_removed for r in got)


def test_substrings_name_rows_by_id_and_text(spark):
    """Null ids take part after all others; texts that share an id are apart."""
    rng = random.Random(8)
    say = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    passage, line = say(60), "One two three. Four five six seven. Eight nine ten eleven twelve. "
    twin = f"{say(3)}. {line}"
    rows = [(1, f"{passage} {say(5)}"), (1, f"{passage} {say(6)}"), (None, f"{say(4)} {passage}"), (None, f"{line}{say(7)}."), (None, f"{line}{say(8)}."),
            (2, twin), (2, twin), (2, f"{line}{say(9)}."), (3, None), (None, None), (4, f"{passage} tail"), (4, f"{passage} tail")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    digests = {(r.doc_id, r.text): r.d for r in table.selectExpr("*", "xxhash64(doc_id, text) d").collect()}
    got = sub.substring_report(table).collect()
    want = brute_substrings(rows, digests=digests)
    key = lambda r: tuple(map(str, r))
    assert sorted(((r.doc_id, r.n_sentences, r.n_removed, r.text) for r in got), key=key) == sorted(((rows[k][0], *v) for k, v in want.items()), key=key)
    assert sum(passage in r.text for r in got if r.text) == 1


def test_long_passage_goes_whole_and_only_it(spark):
    rng = random.Random(9)
    say = lambda n: " ".join(f"q{rng.random()}" for _ in range(n)).replace(".", "")
    passage = ". ".join(say(n) for n in (4, 3, 30, 2, 11, 1, 1, 1)) + ". "
    rows = [(i, f"{say(8)}. {say(5)}.\n{passage}{say(9)}. {say(2)}.") for i in range(5)]
    got = {r.doc_id: r.text for r in sub.substring_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == rows[0][1]
    assert all(got[i] == rows[i][1].replace(passage, "") for i in range(1, 5))


def brute_left(docs, size=51):
    """The words left of each text by the rule of windows alone."""
    seen, lost = {}, set()
    for i, text in docs:
        own = brute_words(text)
        for k in range(len(own) - size + 1):
            if seen.setdefault(tuple(own[k:k + size]), (i, k)) != (i, k):
                lost |= {(i, j) for j in range(k, k + size)}
    return {i: [w for k, w in enumerate(brute_words(t)) if (i, k) not in lost] for i, t in docs}


def test_passages_inside_sentences_go_whole(spark):
    """Passages of 50 to 130 words that no sentence starts or ends with."""
    rng = random.Random(4)
    say = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    passages = [say(51), say(90), f'{say(20)}." {say(33)}', f"{say(25)}. {say(12)} (é{say(30)}.) {say(60)}", " ".join([say(17)] * 6)]
    almost = say(50)
    rows = []
    for i in range(40):
        inside = rng.sample([*passages, almost], rng.randrange(1, 4))
        rows.append((i, f"{say(30)}, " + "".join(f"{p} {say(rng.randrange(1, 45))}; {say(5)} " for p in inside) + "end."))
    got = {r.doc_id: r for r in sub.substring_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: brute_words(r.text) for i, r in got.items()} == brute_left(rows)
    for p in passages[:4]:
        assert sum(p in r.text for r in got.values()) == 1
    assert sum(almost in r.text for r in got.values()) == sum(almost in t for _, t in rows) > 1


def test_substring_odd_rows(odd_docs, no_docs):
    report = {r.doc_id: r for r in sub.substring_report(odd_docs).collect() if r.doc_id is not None}
    assert sub.substring_report(odd_docs).where("doc_id is null").count() == 2
    assert report[5].n_removed == 0 and report[9].n_removed == report[9].n_sentences == 1 or report[9].n_removed == 0
    assert report[0].text is None and report[1].text == "" and report[6].n_removed == 0
    kept = sub.substring_dedup(odd_docs, words=3, words_alone=10)
    assert kept.columns == odd_docs.columns and kept.schema["text"].dataType == odd_docs.schema["text"].dataType
    ids = [r.doc_id for r in kept.collect()]
    assert 9 not in ids and ids.count(5) == 2 and ids.count(None) == 2
    assert sub.substring_dedup(no_docs).count() == 0 and sub.substring_report(no_docs).count() == 0


@pytest.mark.parametrize("name", ["op1_ngram_join", "op6_embedding_dedup"])
def test_queries_equal_sql(spark, name):
    import duckdb
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    got = QUERIES[name](spark, sf)
    want = con.sql(ORACLE[name])
    assert sorted(tuple(r[c] for c in want.columns) for r in got.collect()) == sorted(want.fetchall())
