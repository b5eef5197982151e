"""Benchmark decontamination with a generalised suffix automaton.

The normalised test items (words as in :mod:`.text`) are put into generalised
suffix automata; the words of every document are streamed through them and the
longest matching length is tracked at each word.  A window is ``n``
consecutive item words (an item of fewer words, but not none, is one window);
every document word inside an occurrence of a window is hit.

Items are dealt into shards of about ``shard_words`` words, one automaton per
shard, built by Spark tasks.  A shard is the only thing broadcast, so the bound
of a broadcast is ``shard_words`` and not the size of the benchmark; with more
than one shard the documents pass the shards one after another, with a written
table between them.

Defined results: a null text has no words and no hits; an item without words
is left out; the windows of an item without id hit like others, but there is no
id to list; repeated item ids are one item with all its texts;
an empty items table hits nothing; documents may repeat, each row is judged by
itself; other columns are neither read nor changed.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit.llm.tables import write_table
from cohortkit.llm.text import small_slices, words_of

WINDOW = 13
LEAST_SHARE = 20  # contaminated: hit words are at least one in so many
SHARD_WORDS = 200_000


class ItemAutomaton:
    """Generalised suffix automaton over word hashes of several items."""

    def __init__(self, items: list[tuple[str, np.ndarray]], n: int):
        self.n = n
        self.vocab = np.unique(np.concatenate([h for _, h in items]))
        self.size = len(self.vocab)
        coded = [(item, np.searchsorted(self.vocab, h)) for item, h in items]
        grams = [c[:-1].astype(np.int64) * self.size + c[1:] for _, c in coded if len(c) > 1]
        self.bigrams = np.unique(np.concatenate(grams)) if grams else np.zeros(0, np.int64)
        self.shortest = min(min(n, len(c)) for _, c in coded)
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, codes in coded:
            last = 0
            for code in codes.tolist():
                last = self._extend(last, code)
        self.windows: dict[int, set[str]] = {}
        self.short: dict[int, list[tuple[int, str]]] = {}
        for item, codes in coded:
            self._mark(item, codes.tolist())

    def _new(self, length: int, step: dict[int, int], link: int) -> int:
        self.step.append(step)
        self.length.append(length)
        self.link.append(link)
        return len(self.link) - 1

    def _split(self, above: int, code: int) -> int:
        """The state of exactly ``above + code``; it is cut out of the present
        target when that also holds longer strings."""
        target = self.step[above][code]
        if self.length[target] == self.length[above] + 1:
            return target
        twin = self._new(self.length[above] + 1, dict(self.step[target]), self.link[target])
        self.link[target] = twin
        while above >= 0 and self.step[above].get(code) == target:
            self.step[above][code] = twin
            above = self.link[above]
        return twin

    def _extend(self, last: int, code: int) -> int:
        if code in self.step[last]:
            return self._split(last, code)
        state = self._new(self.length[last] + 1, {}, 0)
        while last >= 0 and code not in self.step[last]:
            self.step[last][code] = state
            last = self.link[last]
        if last >= 0:
            self.link[state] = self._split(last, code)
        return state

    def _holder(self, state: int, size: int) -> int:
        """The state on the suffix links that holds the suffix of ``size`` words."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def _mark(self, item: str, codes: list[int]) -> None:
        state = 0
        for i, code in enumerate(codes):
            state = self.step[state][code]
            if i + 1 >= self.n:
                state_n = self._holder(state, self.n)
                self.windows.setdefault(state_n, set()).add(item)
        if len(codes) < self.n:
            self.short.setdefault(self._holder(state, len(codes)), []).append((len(codes), item))

    def _short_at(self, state: int, matched: int) -> Iterator[tuple[int, str]]:
        while state > 0:
            for size, item in self.short.get(state, ()):
                if size <= matched:
                    yield size, item
            state = self.link[state]

    def candidates(self, word_hash: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word codes, and the stretches of words that can hold a window: all
        of their words are item words and all neighbours follow each other in
        some item."""
        code = np.minimum(np.searchsorted(self.vocab, word_hash), self.size - 1)
        known = self.vocab[code] == word_hash
        if self.shortest == 1:
            joined = known.copy()
        else:
            joined = np.zeros(len(code), bool)  # with the word after it
            both = np.flatnonzero(known[:-1] & known[1:])
            pair = code[both].astype(np.int64) * self.size + code[both + 1]
            if len(self.bigrams) and len(pair):
                at = np.minimum(np.searchsorted(self.bigrams, pair), len(self.bigrams) - 1)
                joined[both] = self.bigrams[at] == pair
            ends = first[1:][np.diff(first) > 0] - 1
            joined[ends] = False
        edge = np.flatnonzero(np.diff(np.concatenate([[0], joined.view(np.int8), [0]])))
        start, end = edge[::2], edge[1::2]
        if self.shortest == 1:  # a stretch must not pass the end of a text
            cut = first[1:-1]
            start = np.concatenate([start, cut[known[np.minimum(cut, len(known) - 1)] & (cut < len(known))]])
            start = np.unique(start)
            end = np.minimum(edge[1::2][np.searchsorted(edge[::2], start, side="right") - 1],
                             first[np.searchsorted(first, start, side="right")])
        else:
            end = end + 1
        keep = end - start >= self.shortest
        return code, start[keep], end[keep]

    def hits(self, word_hash: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, set[str]]]:
        """``(start, end, items)`` in word positions for every window that ends
        at a word."""
        if not len(word_hash):
            return
        code, starts, ends = self.candidates(word_hash, first)
        for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
            state = matched = 0
            for i, c in enumerate(code[s:e].tolist(), s):
                while state > 0 and c not in self.step[state]:
                    state = self.link[state]
                    matched = self.length[state]
                if c in self.step[state]:
                    state = self.step[state][c]
                    matched += 1
                else:
                    matched = 0
                if matched >= self.n:
                    yield i + 1 - self.n, i + 1, self.windows[self._holder(state, self.n)]
                if self.short:
                    for size, item in self._short_at(state, matched):
                        yield i + 1 - size, i + 1, {item}


def build_automata(items: DataFrame, id_col: str, text_col: str, n: int, shard_words: int) -> tuple[DataFrame | None, list[int]]:
    """A written table ``(shard, blob)`` of pickled automata, and its shards.  Long items are cut into pieces that
    overlap by ``n - 1`` words, so no window is lost and no shard is much
    longer than the rest."""
    piece = max(n, shard_words // 8)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches, "text"):
            words = words_of(batch.column("text"))
            h, out = words.hashes(), {"item": [], "words": [], "n": []}
            for i, item in enumerate(batch.column("item").to_pylist()):
                own = h[words.first[i]:words.first[i + 1]]
                for at in range(0, max(1, len(own) - n + 1), max(1, piece - n + 1)):
                    if len(part := own[at:at + piece]):
                        out["item"].append(item)
                        out["words"].append(part.tobytes())
                        out["n"].append(len(part))
            yield pa.RecordBatch.from_pydict(out, pa.schema([("item", pa.string()), ("words", pa.binary()), ("n", pa.int64())]))

    rows = items.select(
        F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    cut, _ = write_table(rows.mapInArrow(pieces, "item string, words binary, n long").distinct(), "bench_items")
    total = cut.agg(F.sum("n")).first()[0] or 0
    if not total:
        return None, []
    shards = -(-total // shard_words)

    def build(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["item", "words"])
        own = [(r.item, np.frombuffer(r.words, np.uint64)) for r in group.itertuples()]
        return pd.DataFrame({"shard": [key[0]], "blob": [pickle.dumps(ItemAutomaton(own, n))]})

    built = (cut.withColumn("shard", F.pmod(F.xxhash64("words"), F.lit(shards)))
             .groupBy("shard").applyInPandas(build, "shard long, blob binary"))
    built, _ = write_table(built, "bench_automata")
    present = sorted(r.shard for r in built.select("shard").collect())
    return built, present


def _pass(docs: DataFrame, text_col: str, pre: str, handle: Broadcast, first_pass: bool) -> DataFrame:
    """One stream of all documents through one shard's automaton; adds or
    extends the word count, the hit word positions and the items."""
    names = [f"{pre}n", f"{pre}hit", f"{pre}items"]
    kinds = [T.LongType(), T.ArrayType(T.LongType()), T.ArrayType(T.StringType())]
    schema = docs.schema if not first_pass else T.StructType(
        [*docs.schema.fields, *[T.StructField(a, k) for a, k in zip(names, kinds, strict=True)]])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = pickle.loads(handle.value) if handle.value else None
        for batch in small_slices(batches, text_col):
            words = words_of(batch.column(text_col))
            spans = [[] for _ in range(batch.num_rows)]
            found = [set() for _ in range(batch.num_rows)]
            if not first_pass:
                spans = [list(zip(x[::2], x[1::2], strict=True)) for x in batch.column(names[1]).to_pylist()]
                found = [set(x) for x in batch.column(names[2]).to_pylist()]
            if automaton:
                for s, e, items in automaton.hits(words.hashes(), words.first):
                    doc = int(np.searchsorted(words.first, s, side="right")) - 1
                    base = int(words.first[doc])
                    spans[doc].append((s - base, e - base))
                    found[doc] |= items - {None}
            flat = [[x for pair in merged(own) for x in pair] for own in spans]
            kept = [batch.column(c) for c in batch.schema.names if c not in names]
            schema_names = [c for c in batch.schema.names if c not in names]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(words.counts(), pa.int64()), pa.array(flat, pa.list_(pa.int64())),
                 pa.array([sorted(x) for x in found], pa.list_(pa.string()))], [*schema_names, *names])

    return docs.mapInArrow(scan, schema)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _scanned(docs: DataFrame, items: DataFrame, text_col: str, item_id: str, item_text: str,
             n: int, shard_words: int) -> tuple[DataFrame, str]:
    pre = "__hit_"
    while any(c.startswith(pre) for c in docs.columns):
        pre += "_"
    built, shards = build_automata(items, item_id, item_text, n, shard_words)
    handle = None
    for k, shard in enumerate(shards or [None]):
        if k:  # one automaton at a time, on the driver and on the executors
            docs, _ = write_table(docs, "bench_pass")
            handle.destroy()
        blob = None if shard is None else built.where(F.col("shard") == shard).first().blob
        handle = docs.sparkSession.sparkContext.broadcast(blob)
        docs = _pass(docs, text_col, pre, handle, k == 0)
    return docs, pre


def _n_hit(pre: str) -> F.Column:
    pos = F.col(f"{pre}hit")
    return F.aggregate(F.transform(pos, lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)),
                       F.lit(0).cast("long"), lambda a, x: a + x)


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", n: int = WINDOW,
                  least_share: int = LEAST_SHARE, shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per document: ``(id, n_words, n_hit, items, hit_spans,
    contaminated)``; ``hit_spans`` are ``[start, end)`` word positions."""
    rows, pre = _scanned(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")),
                         items, "text", item_id, item_text, n, shard_words)
    pos = F.col(f"{pre}hit")
    spans = F.transform(F.sequence(F.lit(0), F.size(pos).cast("int") - 1, F.lit(2)),
                        lambda i: F.struct(pos[i].alias("start"), pos[i + 1].alias("end")))
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    rows = rows.select(F.col("id").alias(id_col), F.col(f"{pre}n").alias("n_words"), _n_hit(pre).alias("n_hit"),
                       F.col(f"{pre}items").alias("items"),
                       F.when(F.size(pos) > 0, spans).otherwise(empty).alias("hit_spans"))
    return rows.withColumn("contaminated", (F.col("n_hit") > 0) & (least_share * F.col("n_hit") >= F.col("n_words")))


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text", n: int = WINDOW, least_share: int = LEAST_SHARE,
                  cut_spans: bool = False, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The documents, same columns.  A document over the coverage limit goes
    whole; with ``cut_spans`` it stays and loses the hit spans instead.  All
    other documents are left as they are."""
    columns = docs.columns
    rows, pre = _scanned(docs, items, text_col, item_id, item_text, n, shard_words)
    n_hit = _n_hit(pre)
    bad = (n_hit > 0) & (least_share * n_hit >= F.col(f"{pre}n"))
    if not cut_spans:
        return rows.where(~bad).select(*columns)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches, text_col):
            words = words_of(batch.column(text_col))
            texts = batch.column(text_col).to_pylist()
            for i, (flat, is_bad) in enumerate(zip(batch.column(f"{pre}hit").to_pylist(),
                                                   batch.column(f"{pre}bad").to_pylist(), strict=True)):
                if is_bad:
                    raw, base, left = texts[i].encode(), int(words.first[i]), 0
                    parts = []
                    for s, e in zip(flat[::2], flat[1::2], strict=True):
                        parts.append(raw[left:words.start[base + s] - words.at[i]])
                        left = words.end[base + e - 1] - words.at[i]
                    texts[i] = b"".join([*parts, raw[left:]]).decode()
            arrays = [pa.array(texts, pa.string()) if c == text_col else batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, columns)

    return rows.withColumn(f"{pre}bad", bad).mapInArrow(cut, docs.schema)
