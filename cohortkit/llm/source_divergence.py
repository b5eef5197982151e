"""How far the word use of each source is from its language and its siblings.

A term is a run of letters and non-ASCII bytes, A-Z lower-cased.  The terms of
a language are those in at least ``MIN_DOCS`` of its documents.  Every source
of a language, and the language itself, gives each of its ``V`` terms the share
``1 + floor(10**9 * (count + 1) / (N + V))``; two shares are compared by
``floor((p - q)**2 / q)``, all in whole numbers.

Counting packs terms by length.  Up to 8 bytes are one big-endian uint64 word,
up to 16 two, and equal terms are the runs after a stable radix sort of the
words (16 bits a pass).  Longer terms are gathered into byte matrices, one per
power of two of their length, and sorted as bytes.  A task merges the runs of
its texts and hands on a bounded number of entries at a time, so what is
shuffled is counts, never words.

The sum of a pair over all terms is taken apart: what a source gives when the
other has no occurrence follows from how many of its terms occur how often, a
short histogram joined to the sources of its language; only terms that occur in
both need their own correction.  These meet by term, the sources of a term in
blocks of ``BLOCK``, so that no list grows with the number of sources.

Defined results: null texts, languages and sources are ''; a source without
terms has rows too; a language without terms of its own has value 0 for every
pair and no terms; rows that repeat count again.  Shares are exact below
9 * 10**13 occurrences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.llm.tables import write_table
from cohortkit.llm.text import runs, small_slices, text_bytes

MIN_DOCS = 3
TOP = 200
BLOCK = 256  # sources of a term that meet in one list
HELD = 1 << 19  # entries that a task merges before it hands them on
PAIRS = 1 << 20  # pairs computed at a time
EMIT = 1 << 16

_TERM = np.zeros(256, np.uint8)
_TERM[65:91] = _TERM[97:123] = _TERM[128:] = 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def radix_order(words: list[np.ndarray]) -> np.ndarray:
    """Stable order by uint64 words, the first the most significant: a radix
    pass per 16 bits from the least on, without those where all are equal."""
    order = np.arange(len(words[0]))
    for word in reversed(words):
        for shift in range(0, 64, 16):
            digit = (word >> np.uint64(shift)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def heads(columns: list[np.ndarray]) -> np.ndarray:
    """Where a run of equal rows starts, in sorted columns."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = False
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
    return new


def packed(buf: np.ndarray, start: np.ndarray, end: np.ndarray, words: int) -> list[np.ndarray]:
    """The byte runs as zero-padded big-endian words; ``buf`` has 16 bytes to spare."""
    at_any = np.ndarray((len(buf) - 7,), ">u8", buf, 0, (1,))
    out = []
    for k in range(words):
        bits = 8 * np.clip(end - start - 8 * k, 0, 8).astype(np.uint64)
        word = at_any[np.minimum(start + 8 * k, len(buf) - 8)].astype(np.uint64)
        drop = np.uint64(64) - bits
        out.append(np.where(bits > 0, (word >> (drop % np.uint64(64))) << (drop % np.uint64(64)), np.uint64(0)))
    return out


def unpacked(words: list[np.ndarray]) -> pa.Array:
    """The terms of packed words (no term holds a zero byte)."""
    raw = np.stack(words, axis=1).astype(">u8").view(np.uint8).reshape(len(words[0]), -1)
    at = np.concatenate([[0], np.cumsum((raw != 0).sum(1))]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(raw), pa.py_buffer(at), pa.py_buffer(raw[raw != 0])).cast(pa.string())


def long_terms(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and fixed-width byte strings of the runs, one bucket per power
    of two of their length."""
    length = end - start
    size = np.ceil(np.log2(np.maximum(length, 1))).astype(np.int64)
    for s in np.unique(size).tolist():
        own = np.flatnonzero(size == s)
        width = int(length[own].max())
        step = max(1, (1 << 24) // width)  # the matrix of a step stays small
        terms = np.empty(len(own), f"S{width}")
        for lo in range(0, len(own), step):
            part = own[lo:lo + step]
            at = start[part, None] + np.arange(width)
            raw = np.where(at < end[part, None], buf[np.minimum(at, len(buf) - 1)], 0).astype(np.uint8)
            terms[lo:lo + step] = np.ascontiguousarray(raw).view(f"S{width}").ravel()
        yield own, terms


class Counter:
    """Occurrences and documents per (group, term) of one task."""

    def __init__(self):
        self.codes: dict[tuple[str, str], int] = {}
        self.held: dict[int, list[list[np.ndarray]]] = {1: [], 2: []}
        self.n_held = {1: 0, 2: 0}

    def group_codes(self, langs: pa.Array, sources: pa.Array) -> np.ndarray:
        pairs = zip(langs.to_pylist(), sources.to_pylist(), strict=True)
        return np.array([self.codes.setdefault(p, len(self.codes)) for p in pairs], np.uint64)

    def rows(self, group: np.ndarray, terms: pa.Array, n: np.ndarray, docs: np.ndarray) -> Iterator[pa.RecordBatch]:
        langs, sources = (pa.array([g[k] for g in self.codes], pa.string()) for k in (0, 1))
        for lo in range(0, len(n), EMIT):
            at = pa.array(group[lo:lo + EMIT].astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [langs.take(at), sources.take(at), terms.slice(lo, EMIT), pa.array(n[lo:lo + EMIT]), pa.array(docs[lo:lo + EMIT])],
                ["lang", "source", "term", "n", "docs"])

    def add(self, column: pa.Array, group: np.ndarray) -> Iterator[pa.RecordBatch]:
        raw, at = text_bytes(column)
        start, end = runs(_TERM[raw], at)
        buf = np.concatenate([_LOWER[raw], np.zeros(16, np.uint8)])
        doc = np.searchsorted(at, start, side="right") - 1
        length = end - start
        for words in (1, 2):
            own = np.flatnonzero((length <= 8) if words == 1 else (length > 8) & (length <= 16))
            if len(own):
                key = packed(buf, start[own], end[own], words)
                yield from self.hold(words, self.counted(group[doc[own]], key, doc[own]))
        own = np.flatnonzero(length > 16)
        for part, terms in long_terms(buf, start[own], end[own]):
            docs = doc[own[part]]
            of = group[docs]
            order = np.argsort(terms, kind="stable")
            order = order[np.argsort(of[order], kind="stable")]
            of, terms, docs = of[order], terms[order], docs[order]
            new = heads([of, terms])
            edge = np.flatnonzero(new)
            n = np.diff(np.append(edge, len(terms)))
            n_docs = np.add.reduceat((new | heads([docs])).astype(np.int64), edge)
            yield from self.rows(of[edge], pa.array(terms[edge].tolist(), pa.binary()).cast(pa.string()), n, n_docs)

    @staticmethod
    def counted(group: np.ndarray, key: list[np.ndarray], doc: np.ndarray) -> list[np.ndarray]:
        order = radix_order([group, *key])  # stable: documents stay in order
        group, key, doc = group[order], [k[order] for k in key], doc[order]
        new = heads([group, *key])
        edge = np.flatnonzero(new)
        docs = np.add.reduceat((new | heads([doc])).astype(np.int64), edge)
        return [group[edge], *[k[edge] for k in key], np.diff(np.append(edge, len(doc))), docs]

    def merged(self, words: int) -> list[np.ndarray]:
        parts = [np.concatenate(c) for c in zip(*self.held[words], strict=True)]
        order = radix_order(parts[:1 + words])
        parts = [c[order] for c in parts]
        edge = np.flatnonzero(heads(parts[:1 + words]))
        return [*[c[edge] for c in parts[:1 + words]], *[np.add.reduceat(c, edge) for c in parts[1 + words:]]]

    def hold(self, words: int, entries: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        self.held[words].append(entries)
        self.n_held[words] += len(entries[0])
        if self.n_held[words] > 2 * HELD:
            entries = self.merged(words)
            self.held[words], self.n_held[words] = [entries], len(entries[0])
            if len(entries[0]) > HELD:
                yield from self.flush(words)

    def flush(self, words: int) -> Iterator[pa.RecordBatch]:
        if self.held[words]:
            group, *key, n, docs = self.merged(words)
            yield from self.rows(group, unpacked(key), n, docs)
        self.held[words], self.n_held[words] = [], 0


def term_counts(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, docs)`` of documents ``(lang, source, text)``."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter()
        for batch in small_slices(batches, "text"):
            group = counter.group_codes(batch.column("lang"), batch.column("source"))
            yield from counter.add(batch.column("text"), group)
        for words in (1, 2):
            yield from counter.flush(words)

    parts = docs.select("lang", "source", "text").mapInArrow(count, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: str, total: str, terms: str) -> Column:
    """``1 + floor(10**9 * (n + 1) / (total + terms))`` in two exact steps."""
    a, b = f"({n} + 1)", f"({total} + {terms})"
    return F.expr(f"1L + (({a} * 100000L) div {b}) * 10000L + ((({a} * 100000L) % {b}) * 10000L) div {b}")


def gap(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q})) div {q}"


def _gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def kept_terms(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """The counts of terms in enough documents of their language, with the
    language's count.  A term has at most one row per source."""
    term = Window.partitionBy("lang", "term")
    rows = (counts.withColumn("df", F.sum("docs").over(term)).withColumn("n_lang", F.sum("n").over(term))
            .withColumn("head", (F.row_number().over(term.orderBy("source")) == 1).cast("long")))
    return rows.where(F.col("df") >= min_docs).select("lang", "source", "term", "n", "n_lang", "head")


def source_groups(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """``(lang, source, gid, n_sources, total, present, total_lang, terms)`` of
    every source that occurs, numbered within its language."""
    per_source = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("present"))
    per_lang = kept.groupBy("lang").agg(F.sum("n").alias("total_lang"), F.sum("head").alias("terms"))
    rows = docs.select("lang", "source").distinct().join(per_source, ["lang", "source"], "left").join(per_lang, "lang", "left")
    rows = rows.fillna(0, ["total", "present", "total_lang", "terms"])
    lang = Window.partitionBy("lang")
    return rows.withColumn("gid", F.row_number().over(lang.orderBy("source")) - 1).withColumn("n_sources", F.count(F.lit(1)).over(lang))


def top_terms(shares: DataFrame, top: int = TOP) -> DataFrame:
    """The terms that a source uses more than its language, most telling first."""
    rows = shares.where("p > p_lang").withColumn("value", F.expr(gap("p", "p_lang")))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term"))
    return rows.withColumn("rank", rank).where(F.col("rank") <= top).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")


def _met(shares: DataFrame, block: int) -> DataFrame:
    """``(lang, a, b, value)``: the corrections of terms that occur in both
    sources, summed as far as a task sees them."""
    def correct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            lists = batch.column("entries")
            code = langs.indices.to_numpy().astype(np.int64)
            mixed = (batch.column("low").to_numpy() != batch.column("high").to_numpy())
            first = np.asarray(lists.offsets)
            flat = lists.values
            gid, p, p0 = (flat.field(c).to_numpy().astype(np.int64) for c in ("gid", "p", "p0"))
            k = np.diff(first).astype(np.int64)
            done = np.concatenate([[0], np.cumsum(k * k)])
            lo = 0
            while lo < len(k):
                hi = max(lo + 1, int(np.searchsorted(done, done[lo] + PAIRS, side="right")) - 1)
                row = np.repeat(np.arange(lo, hi), k[lo:hi] ** 2)
                at = np.arange(len(row)) - (done[row] - done[lo])
                i, j = first[row] + at // k[row], first[row] + at % k[row]
                live = (gid[i] != gid[j]) & (~mixed[row] | (gid[i] // block != gid[j] // block))
                row, i, j = row[live], i[live], j[live]
                value = _gap(p[i], p[j]) - _gap(p[i], p0[j]) - _gap(p0[i], p[j]) + _gap(p0[i], p0[j])
                order = np.lexsort((gid[j], gid[i], code[row]))
                key = [c[order] for c in (code[row], gid[i], gid[j])]
                edge = np.flatnonzero(heads(key)) if len(order) else np.zeros(0, np.int64)
                total = np.add.reduceat(value[order], edge) if len(edge) else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [langs.dictionary.take(pa.array(key[0][edge])), *[pa.array(c[edge]) for c in key[1:]], pa.array(total)], ["lang", "a", "b", "value"])
                lo = hi

    rows = shares.select("lang", "term", F.struct("gid", "p", "p0").alias("e"), F.expr(f"gid div {block}").alias("own"),
                         F.explode(F.expr(f"sequence(0L, (n_sources - 1) div {block})")).alias("other"))
    lists = rows.groupBy("lang", "term", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")).agg(
        F.collect_list("e").alias("entries")).where(F.size("entries") > 1)
    return lists.select("lang", "low", "high", "entries").mapInArrow(correct, "lang string, a long, b long, value long")


def source_pairs(kept: DataFrame, shares: DataFrame, groups: DataFrame, block: int = BLOCK) -> DataFrame:
    """The difference of every source to every other of its language."""
    zero = groups.select("lang", "source", F.lit(0).cast("long").alias("n"), (F.col("terms") - F.col("present")).alias("h"))
    hist = kept.groupBy("lang", "source", "n").agg(F.count(F.lit(1)).alias("h")).unionByName(zero.where("h > 0"))
    own = groups.select("lang", "source", "gid", "terms", "total", F.when(F.col("terms") > 0, share("0", "total", "terms")).alias("p0"))
    x = hist.join(own, ["lang", "source"]).select("lang", F.col("gid").alias("x"), "h", F.col("p0").alias("x0"), share("n", "total", "terms").alias("xp"))
    y = own.select("lang", F.col("gid").alias("y"), F.col("p0").alias("y0"))
    met = x.join(y, "lang").where("x <> y")  # bounded by the pairs that are the result, times the counts that differ
    wide = "decimal(38,0)"
    sides = met.select("lang", F.explode(F.array(
        F.struct(F.col("x").alias("a"), F.col("y").alias("b"), F.expr(f"cast(h as {wide}) * ({gap('xp', 'y0')})").cast(wide).alias("value")),
        F.struct(F.col("y").alias("a"), F.col("x").alias("b"),
                 F.expr(f"cast(h as {wide}) * (({gap('y0', 'xp')}) - ({gap('y0', 'x0')}))").cast(wide).alias("value")))).alias("s")).select("lang", "s.*")
    every = own.select("lang", F.col("gid").alias("a")).join(own.select("lang", F.col("gid").alias("b")), "lang").where("a <> b")
    parts = (every.withColumn("value", F.lit(0).cast(wide)).unionByName(sides)
             .unionByName(_met(shares, block).withColumn("value", F.col("value").cast(wide))))
    sums = parts.groupBy("lang", "a", "b").agg(F.sum("value").cast("long").alias("value"))
    named = sums.join(groups.select("lang", F.col("gid").alias("a"), "source"), ["lang", "a"]).join(
        groups.select("lang", F.col("gid").alias("b"), F.col("source").alias("item")), ["lang", "b"])
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return named.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))


def source_divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                      min_docs: int = MIN_DOCS, top: int = TOP, block: int = BLOCK) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: part ``pair`` holds every
    other source of the language, part ``term`` the ``top`` terms that the
    source uses more than its language."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text"))
    counts, _ = write_table(term_counts(rows), "divergence_counts")
    kept, _ = write_table(kept_terms(counts, min_docs), "divergence_terms")
    groups, _ = write_table(source_groups(rows, kept), "divergence_sources")
    shares = kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "gid", "n_sources", share("n", "total", "terms").alias("p"),
        share("0", "total", "terms").alias("p0"), share("n_lang", "total_lang", "terms").alias("p_lang"))
    return source_pairs(kept, shares, groups, block).unionByName(top_terms(shares, top))
