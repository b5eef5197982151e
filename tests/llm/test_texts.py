"""Decontamination, licenses, chat formatting, quality and the pipeline."""

import hashlib
import json
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

import corpus_pipeline
from cohortkit.llm import chat_format as chat, decontaminate as dec, license_scan as lic, quality
from cohortkit.llm.queries import ORACLE, QUERIES
from cohortkit.llm.text import words_of
from cohortkit.session import scratch_path

SF = "/root/testdata/sf0.001"


def brute_words(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def brute_hits(text, items, n=13):
    words, hit, found = brute_words(text), set(), set()
    for item, own in items:
        own = brute_words(own)
        size = min(n, len(own))
        grams = {tuple(own[k:k + size]) for k in range(len(own) - size + 1)} if own else set()
        for k in range(len(words) - size + 1):
            if tuple(words[k:k + size]) in grams:
                hit |= set(range(k, k + size))
                found |= {str(item)} if item is not None else set()
    return len(words), len(hit), sorted(found)


def benchmark_case(seed, short):
    rng = random.Random(seed)
    say = lambda n: [f"v{rng.randrange(30)}" for _ in range(n)]
    items = [(i, " ".join(say(rng.choice([14, 20, 40])))) for i in range(12)]
    items += [(k + 100, " ".join(say(k))) for k in short] + [(200, ""), (201, None), (None, "a b c"), (3, items[5][1]), (4, items[4][1])]
    docs = []
    for i in range(60):
        parts = [say(rng.randrange(0, 40))]
        for _ in range(rng.randrange(0, 3)):
            own = brute_words(rng.choice(items)[1])
            a = rng.randrange(0, max(1, len(own) - 5))
            parts += [own[a:a + rng.randrange(5, 40)], say(rng.randrange(0, 20))]
        docs.append((i, " ".join(w for p in parts for w in p).replace("v7", "V7,")))
    return docs + [(900, None), (901, ""), (902, "...")], items


@pytest.mark.parametrize("seed,short,n,shard", [(1, [], 13, 10**6), (2, [1, 2, 5], 13, 10**6), (3, [3], 4, 60), (4, [1], 6, 40)])
def test_contamination_equals_brute_force(spark, seed, short, n, shard):
    docs, items = benchmark_case(seed, short)
    table = spark.createDataFrame([(*d, 1, [1]) for d in docs], "doc_id long, text string, n_hit int, items array<int>")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = dec.contamination(table, bench, n=n, shard_words=shard).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in got} == {i: brute_hits(t, items, n) for i, t in docs}
    assert all(r.contaminated == (r.n_hit > 0 and 20 * r.n_hit >= r.n_words) for r in got)
    assert all(sum(s.end - s.start for s in r.hit_spans) == r.n_hit for r in got)
    kept = dec.decontaminate(table, bench, n=n, shard_words=shard)
    assert kept.columns == table.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if not r.contaminated}
    cut = {r.doc_id: r.text for r in dec.decontaminate(table, bench, n=n, shard_words=shard, cut_spans=True).collect()}
    spans = {r.doc_id: r.hit_spans for r in got if r.contaminated}
    for i, t in docs:
        gone = {k for s in spans.get(i, []) for k in range(s.start, s.end)}
        assert brute_words(cut[i]) == [w for k, w in enumerate(brute_words(t)) if k not in gone]
        assert gone or cut[i] == t


def test_contamination_of_empty_tables(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "a b c d e f g h i j k l m n o p")], "item_id long, text string")
    assert dec.contamination(no_docs, items).count() == 0
    rows = dec.contamination(odd_docs, items.limit(0)).collect()
    assert len(rows) == odd_docs.count() and not any(r.n_hit or r.contaminated for r in rows)
    assert {r.doc_id for r in dec.contamination(odd_docs, items).where("contaminated").collect()} == {5, 9}


def plain_patience(text, template):
    """The same alignment, recursively and from the definition."""
    k = 0
    while k < min(len(text), len(template)) and text[k] == template[k]:
        k += 1
    e = 0
    while e < min(len(text), len(template)) - k and text[len(text) - 1 - e] == template[len(template) - 1 - e]:
        e += 1
    n = k + e
    text, template = text[k:len(text) - e], template[k:len(template) - e]
    both = [(text.index(w), template.index(w)) for w in text if text.count(w) == template.count(w) == 1]
    best = [[p] for p in both]
    for i, p in enumerate(both):
        for j in range(i):
            if both[j][1] < p[1] and len(best[j]) + 1 > len(best[i]):
                best[i] = [*best[j], p]
    if not text or not template or not best:
        return n
    chain = max(best, key=len)
    edges = [(-1, -1), *chain, (len(text), len(template))]
    return n + len(chain) + sum(plain_patience(text[a + 1:c], template[b + 1:d]) for (a, b), (c, d) in zip(edges, edges[1:], strict=False))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 8), max_size=14), st.lists(st.integers(0, 8), max_size=14))
def test_patience_aligns_in_order(text, template):
    pairs = lic.patience(text, template)
    assert all(text[a] == template[b] for a, b in pairs)
    assert all(a < c and b < d for (a, b), (c, d) in zip(pairs, pairs[1:], strict=False))
    unique = [w for w in set(text) & set(template) if text.count(w) == template.count(w) == 1]
    if len(unique) == len(set(text) | set(template)):  # nothing repeats: one longest increasing run
        assert len(pairs) == plain_patience(text, template)


def test_longest_increasing():
    for seed in range(20):
        values = random.Random(seed).sample(range(50), 12)
        got = [values[i] for i in lic.longest_increasing(values)]
        best = max((sum(m >> k & 1 for k in range(12)) for m in range(1 << 12)
                    if (own := [values[k] for k in range(12) if m >> k & 1]) == sorted(own)), default=0)
        assert got == sorted(got) and len(got) == best


def test_pruning_loses_no_license():
    """Against scanning every text for every template."""
    rng, scanner = random.Random(3), lic.LicenseScanner(lic.TEMPLATES)
    texts = []
    for _ in range(150):
        words = rng.choice(list(lic.TEMPLATES.values())).split()
        words = [w for w in words if rng.random() > rng.choice([0, 0.05, 0.2])]
        texts.append(" ".join([*rng.choices(["the", "of", "License", "under", "xx"], k=rng.randrange(20)), *words,
                               *rng.choices(["yy", "version", "to"], k=rng.randrange(9))]))
    import pyarrow as pa
    words = words_of(pa.array(texts))
    code = np.searchsorted(scanner.vocab, words.hashes())
    code = np.where(scanner.vocab[np.minimum(code, len(scanner.vocab) - 1)] == words.hashes(), code, -1)
    for i, found in enumerate(scanner.scan(words)):
        lo, hi = int(words.first[i]), int(words.first[i + 1])
        want = [m for t in range(len(scanner.templates))
                for m in scanner.matches(code, np.array([k for k in range(lo, hi) if code[k] >= 0 and scanner.has[code[k], t]], int), lo, hi, t)]
        assert sorted(found) == sorted(want)
    assert sum(map(len, scanner.scan(words))) > 80


def license_words(texts, **kw):
    import pyarrow as pa
    return lic.LicenseScanner(lic.TEMPLATES, **kw).scan(words_of(pa.array(texts)))


def test_deciding_words_name_the_license():
    texts = {
        'Licensed under the <a href="http://www.apache.org/licenses/LICENSE-2.0">Apache License, Version 2.0</a>.': {"Apache-2.0"},
        "Released under the BSD License.": set(), "Licensed under CC BY-SA 4.0.": set(), "Licensed under CC BY-NC-SA 4.0.": set(),
        "This work is licensed under the GNU General Public License, version 2.": set(),
        "This work is licensed under the GNU General Public License, version 3.": {"GPL-3.0"},
        "This work is licensed under the GNU Lesser General Public License, version 3.": set(),
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": {"CC-BY-SA-4.0"},
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.": set(),
        "This work is licensed under a Creative Commons Attribution 4.0 International License.": {"CC-BY-4.0"}}
    for (text, want), found in zip(texts.items(), license_words(list(texts)), strict=True):
        assert {m[0] for m in found} == want, text
    with pytest.raises(ValueError):
        lic.LicenseScanner({"X": "some words"}, deciding={"X": "other"})


def test_planted_notices_come_out_whole():
    """Whole results against what was planted: notices with words put in between and
    words left out, several to a text, among words that stand in no template.  Where
    the plain recursive alignment misses words of a notice that repeat, it may be
    found with fewer of them or not at all; every other must come out exactly."""
    rng = random.Random(11)
    names = ["Apache-2.0", "MIT", "MIT-text", "GPL-3.0", "ISC", "CC-BY-NC-4.0", "MPL-2.0", "BSD-3-Clause"]
    fill = lambda n: [f"x{rng.randrange(50)}" for _ in range(n)]
    texts, want = [], []
    for _ in range(120):
        name, words, planted = rng.choice(names), fill(rng.randrange(40)), []
        import pyarrow as pa
        w = words_of(pa.array([lic.TEMPLATES[name]]))
        template = [bytes(w.buf[a:b]).decode().lower() for a, b in zip(w.start, w.end, strict=True)]
        must = set(lic.DECIDING.get(name, "").split())
        for _ in range(rng.choice([0, 1, 1, 2, 5])):
            once = [i for i, x in enumerate(template) if template.count(x) == 1 and x not in must]
            out = set(rng.sample(once, min(len(once), rng.choice([0, 0, int(0.2 * len(template) + 1e-9), int(0.2 * len(template)) + 2]))))
            kept = [x for i, x in enumerate(template) if i not in out]
            wide = rng.choice([0, 0, 3, lic.GAP])
            start = len(words)
            for i, x in enumerate(kept):
                words += [*(fill(rng.randrange(wide + 1)) if i else []), x]
            if len(kept) >= lic.LEAST_COVERAGE * len(template) - 1e-9:
                planted.append(((name, len(kept) / len(template), start, len(words)), plain_patience(words[start:], template) == len(kept)))
            words += fill(lic.GAP + 1 + rng.randrange(30))
        texts.append(" ".join(words))
        want.append(planted)
    for text, found, planted in zip(texts, license_words(texts), want, strict=True):
        found = [m for m in found if not planted or m[0] == planted[0][0][0]]
        assert {m for m, sure in planted if sure} <= set(found), text
        for _, share, a, b in found:
            (own,) = [m for m, _ in planted if m[2] <= a and b <= m[3]]
            assert share <= own[1]
        assert len(found) <= len(planted)
    assert sum(sure for planted in want for _, sure in planted) > 80


def test_spread_notices_in_one_stretch():
    notice = "Licensed a under b the c d e f Apache g h i License j k Version l 2 m n o p q 0"
    text = " the license of the version ".join([notice] * 30)
    found = license_words([text])[0]
    assert [m[0] for m in found].count("Apache-2.0") == 30
    assert all(a[3] <= b[2] for a, b in zip(found, found[1:], strict=False))
    # wider gaps than allowed: no match, however the words follow each other
    far = (" " + " ".join(["w"] * (lic.GAP + 1)) + " ").join("Released under the MIT License".split())
    near = (" " + " ".join(["w"] * lic.GAP) + " ").join("Released under the MIT License".split())
    assert [[m[0] for m in f] for f in license_words([far, near])] == [[], ["MIT"]]


def test_very_long_text_with_a_notice_at_its_end():
    text = "the license of a software and to any person " * 30_000
    found = license_words([text + "filler " * 40 + lic.TEMPLATES["MIT-text"]])[0]
    assert [m[:2] for m in found] == [("MIT-text", 1.0)]


def test_license_rows(spark, odd_docs, no_docs):
    texts = ["x. Released under the MIT License. More, and: released under the MIT license!", "Licensed under\nthe Apache License, Version 2.0",
             "é Licensed under CC BY-NC 4.0.", "the license of the version", None]
    rows = lic.license_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.licenses for r in rows] == ["MIT", "Apache-2.0", "CC-BY-NC-4.0", "", ""]
    assert [r.n_matches for r in rows] == [2, 1, 1, 0, 0]
    assert [texts[0][m.start:m.end].lower() for m in rows[0].matches] == ["released under the mit license"] * 2
    assert texts[2][rows[2].matches[0].start:rows[2].matches[0].end] == "Licensed under CC BY-NC 4.0"
    assert lic.license_scan(odd_docs).where("n_matches > 0").count() == 0 and lic.license_scan(no_docs).count() == 0


control = st.lists(st.sampled_from(["<", "|", "\\", "<|im_end|>", "<|im_start|>", "a", "\n", "é", "<\\|"]), max_size=12).map("".join)


@given(control, control)
def test_template_round_trip(role, text):
    chunk = f"{chat.START}{chat.escape_role(role)}\n{chat.escape(text)}{chat.END}\n"
    assert chat.parse_turn(chunk) == (role, text)
    assert chunk.count(chat.START) == chunk.count(chat.END) == 1


def test_layouts_and_rejects(spark):
    q, a = "ask <|im_end|>", "tell"
    records = [
        {"messages": [{"role": "user", "content": q}, {"role": "assistant", "content": a}]},
        {"conversations": [{"from": "human", "value": q}, {"from": "gpt", "value": a}], "extra": {"x": [1]}},
        {"prompt": q, "completion": a}, {"prompt": q, "response": a}, {"instruction": q, "input": "", "output": a},
        {"question": q, "answer": a, "role": 3}, {"messages": []}, {"nothing": 1}, [1], None]
    rows = [(i, 0, json.dumps(r) if r is not None else "{broken") for i, r in enumerate(records)]
    rows += [(20, 1, json.dumps({"turn": 1, "role": "assistant", "text": a})), (20, 0, json.dumps({"turn": 0, "role": "user", "text": None})),
             (21, 0, json.dumps({"instruction": "x", "input": "y", "output": a, "system": "be"}))]
    out = chat.format_records(spark.createDataFrame(rows, "conv_id long, turn long, record string"))
    got = {}
    for r in out.where("reason is null").orderBy("conv_id", "turn", "pos").collect():
        got.setdefault(r.conv_id, []).append(chat.parse_turn(r.chunk))
        assert chat.unescape(r.chunk[r.loss_start:r.loss_end]) == (a if r.role == "assistant" else "")
    assert all(got[i] == [("user", q), ("assistant", a)] for i in range(6)) and 6 not in got
    assert got[20] == [("user", ""), ("assistant", a)]
    assert got[21] == [("system", "be"), ("user", "x\n\ny"), ("assistant", a)]
    assert {r.conv_id: r.reason for r in out.where("reason is not null").collect()} == {
        7: "no mapping for its fields", 8: "not a JSON object", 9: "not a JSON object"}
    assert chat.format_records(spark.createDataFrame([], "conv_id long, turn long, record string")).count() == 0


def test_conversations_read_back(spark):
    rows = [(c, t, json.dumps({"turn": t, "role": r, "text": x})) for c, t, r, x in
            [(1, 0, "user", "a"), (1, 1, "assistant", "b<|"), (1, 1, "assistant", "b<|"), (None, 0, None, None), (2, 5, "assistant", ""), (2, None, "user", "z")]]
    path = scratch_path(spark, "t")
    chat.format_records(spark.createDataFrame(rows, "conv_id long, turn long, record string").repartition(3)).write.parquet(path)
    got = {r.conv_id: r for r in chat.read_conversations(spark, path).collect()}
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert (got[1].n_turns, got[1].turns_sha256, got[1].loss_sha256, got[1].loss_chars) == (
        3, digest("user\na\n" + "assistant\nb<|\n" * 2), digest("b<|b<|"), 6)
    assert got[2].turns_sha256 == digest("user\nz\nassistant\n\n") and got[2].loss_chars == 0
    assert got[None].turns_sha256 == digest("\n\n")


def test_network_is_calibrated():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 6))
    y = (rng.random(3000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    net = quality.Network(x[:2000], y[:2000])
    p = net.scores(x[2000:])
    assert abs(p.mean() - y[2000:].mean()) < 0.05 and ((p > 0.5) == (y[2000:] == 1)).mean() > 0.75
    assert quality.Network(x[:0], y[:0]).scores(x[:3]).tolist() == [0.5] * 3
    assert quality.Network(x[:5], np.ones(5)).scores(x[:3]).tolist() == [1.0] * 3


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in QUERIES["op8_quality"](spark, sf).collect()}
    import zlib
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
               for i, r in rows.items())
    seen = [(r.quality, rows[r.doc_id].score) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if rows[r.doc_id].held_out]
    good, bad = [s for q, s in seen if q == 1], [s for q, s in seen if q == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.9


def test_context_sums_equal_brute_force(spark):
    import pyarrow as pa
    texts = ["a b, c a", "b b", None, ""]
    got = {r.bucket: r[1:] for r in quality.context_sums(spark.createDataFrame([(t,) for t in texts], "text string").repartition(2)).collect()}
    want = {}
    for t in texts:
        own = quality.tokens_of(pa.array([t], pa.string()))[0].tolist()
        for i, b in enumerate(own):
            row = want.setdefault(b, np.zeros(1 + quality.DIM))
            row[0] += 1
            for j in range(max(0, i - quality.REACH), min(len(own), i + quality.REACH + 1)):
                if j != i:
                    np.add.at(row, 1 + quality._PLACE[own[j]], quality._SIGN[own[j]])
    assert {b: list(v) for b, v in got.items()} == {b: v.tolist() for b, v in want.items()}


def test_quality_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(0, 1, 0), (3, 0, 0), (None, 1, 1), (4, None, 0), (77, 0, 0), (3, 0, 0), (5, 1, 1)], "doc_id long, quality int, toxic int")
    assert quality.quality_scores(odd_docs, labels).count() == odd_docs.count()
    assert {r.score for r in quality.quality_scores(odd_docs, labels.limit(0)).collect()} == {0.5}
    kept = quality.keep_good(odd_docs, labels, pass_mark=0.0)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    assert quality.quality_scores(no_docs, labels).count() == 0


@pytest.mark.parametrize("name", ["op3_chat_format", "op7_decontaminate"])
def test_queries_equal_sql(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.sql(ORACLE[name])
    got = QUERIES[name](spark, SF).collect()
    assert sorted(tuple(r[c] for c in want.columns) for r in got) == sorted(want.fetchall())


def test_pipeline_equals_its_parts(spark):
    """Each stage against brute force on the rows it was given."""
    from test_dedup import brute_join, brute_substrings
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        columns, docs = docs.columns, stage(spark, docs, SF).cache()
        after = {r.doc_id: r for r in docs.collect()}
        assert after and after.keys() <= before.keys() and docs.count() == len(after)
        if name == "ngram_join":
            assert after.keys() == {i for i, (c, _) in brute_join(before.items()).items() if i == c}
        if name == "substring_dedup":
            want = dict(zip(before, (v for _, v in sorted(brute_substrings(list(before.items())).items())), strict=True))
            assert {i: r.text for i, r in after.items()} == {i: t for i, (n, gone, t) in want.items() if gone < n or not n}
            assert all(r.n_chars == len(r.text) for r in after.values())
        if name == "decontaminate":
            hits = {i: brute_hits(t, items) for i, t in before.items()}
            assert after.keys() == {i for i, (n, hit, _) in hits.items() if not (hit and 20 * hit >= n)}
        if name == "bpe":
            assert all(after[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest() for i, t in before.items())
        else:
            assert docs.columns == columns and (name == "substring_dedup" or all(after[i].text == before[i] for i in after))
