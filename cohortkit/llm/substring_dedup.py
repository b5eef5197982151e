"""Exact substring deduplication over sliding runs of sentences and of words.

A sentence ends at a line end, or at ``.``, ``!`` or ``?`` before white space;
what holds no word belongs to the sentence before it.  From every sentence the
shortest run forward, and to every sentence the shortest run backward, that is
long enough is hashed over its words: at least ``sentences`` sentences and
``words`` words, or ``words_alone`` words however few the sentences are.  A
passage that is long enough is thus covered to its first and last sentence by
runs inside it.  A passage of ``passage`` words or more counts wherever it
starts and ends: each of its windows of so many words is a run too, unless all
its words go with runs of sentences.  Runs are joined globally by hash; the first occurrence (least id, then text, then
position) stays, and every word covered by another occurrence of a repeated run is
removed.  A sentence without words left goes with its bytes; of any other the words
go with what stands between them and the next word.

Only hashes are counted at first (combined before the shuffle); positions are
gathered for repeated hashes alone.  Windows are counted by their seeds, the
least hash of fewer words in each window: equal windows have equal seeds, one
seed serves many windows, and only windows whose seed is repeated are hashed.
A text is named by a digest of its id and itself, and its places by one number,
so what is subtracted and collected per text are plain numbers.  Joins are on
hashes, which Spark splits where one is hot.

Defined results: texts without words, and null texts, have no sentences and
stay as they are; rows with a null id come after all others and are told apart
by their text; rows that repeat an id with another text are documents of their
own; rows that repeat id and text are one document and lose the same sentences;
all columns but the text are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit.llm.tables import split_join, write_table
from cohortkit.llm.text import Words, mix, sequence_hashes, small_slices, words_of

SENTENCES = 3
WORDS = 12
WORDS_ALONE = 40
PASSAGE = 51

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_STOP = np.zeros(256, bool)
_STOP[[33, 46, 63]] = True
_SEED = np.uint64(0xA0761D6478BD642F)  # keeps the hashes of seeds apart from those of runs


class Sentences:
    """Sentences of several texts: sentence ``k`` has the words
    ``word[k]:word[k + 1]`` and starts at byte ``byte[k]``; text ``i`` has the
    sentences ``first[i]:first[i + 1]``."""

    def __init__(self, words: Words):
        self.words, buf, n = words, words.buf, len(words.start)
        space = _SPACE[buf]
        ends = buf == 10
        ends[:-1] |= _STOP[buf[:-1]] & space[1:]
        seen = np.concatenate([[0], np.cumsum(ends)])
        new = np.ones(n, bool)
        new[1:] = seen[words.start[1:]] > seen[words.end[:-1]]
        heads = words.first[:-1][np.diff(words.first) > 0]
        new[heads] = True
        self.word = np.append(np.flatnonzero(new), n)
        self.first = np.searchsorted(self.word[:-1], words.first)
        after_space = np.maximum.accumulate(np.where(space, np.arange(len(buf)) + 1, 0)) if len(buf) else np.zeros(0, np.int64)
        start = words.start[self.word[:-1]]
        self.byte = np.where(start > 0, after_space[np.maximum(start - 1, 0)], 0) if len(start) else start
        text_of_head = np.flatnonzero(np.diff(self.first) > 0)
        self.byte[self.first[text_of_head]] = words.at[text_of_head]

    def spans(self, sentences: int, words: int, alone: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, first and last-plus-one sentence of every run to hash."""
        n = len(self.word) - 1
        k = np.arange(n)
        text = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        lo, hi = self.first[text], self.first[text + 1]
        reach = lambda x: np.searchsorted(self.word, self.word[:-1] + x)  # noqa: E731  sentence end with x words from k on
        stop = np.minimum(np.maximum(k + sentences, reach(words)), reach(alone))
        ahead = stop <= hi
        back = lambda x: np.searchsorted(self.word, self.word[1:] - x, side="right") - 1
        head = np.maximum(np.minimum(k + 1 - sentences, back(words)), back(alone))
        behind = head >= lo
        a = np.concatenate([k[ahead], head[behind]])
        b = np.concatenate([stop[ahead], k[behind] + 1])
        both = np.unique(a * (n + 1) + b) if n else np.zeros(0, np.int64)
        a, b = both // (n + 1), both % (n + 1)
        return text[a], a, b


def least_of(x: np.ndarray, size: int) -> np.ndarray:
    """The least of every ``size`` values in a row."""
    done = 1
    while done < size:
        step = min(done, size - done)
        x = np.minimum(x[:-step], x[step:])
        done += step
    return x


def windows(words: Words, word_hash: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and seed of every window of ``size`` words."""
    first, gram = words.first, max(1, 2 * size // 5)
    n = len(word_hash)
    if n < size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.arange(n - gram + 1)
    seed = least_of(mix(sequence_hashes(word_hash, at, at + gram) ^ _SEED), size - gram + 1).view(np.int64)
    start = np.arange(n - size + 1)
    start = start[start + size <= first[np.searchsorted(first, start, side="right")]]
    return start, seed[start]


def seeds(start: np.ndarray, seed: np.ndarray, size: int) -> np.ndarray:
    """Which windows to count: one of all neighbours with one seed, and more
    where there are too many for one place of it."""
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1] + 1) | (seed[1:] != seed[:-1])
    head = np.flatnonzero(new)
    since = np.arange(len(start)) - np.repeat(head, np.diff(np.append(head, len(start))))
    return np.flatnonzero(since % (size - max(1, 2 * size // 5) + 1) == 0)


def places(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row number and value of every entry of a list column."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(sizes)), sizes), column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def spans_of(column: pa.Array, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """First and last-plus-one word, by word positions of the batch, of the
    runs listed for each text as ``a << 32 | b``."""
    row, at = places(column)
    return (at >> 32) + words.first[row], (at & 0xFFFFFFFF) + words.first[row]


def sentence_runs(rows: DataFrame, limits: tuple[int, int, int]) -> DataFrame:
    """``(hash, id, doc, at)``: every run, by word numbers within its text."""
    kind = rows.schema["id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches, "text", 1 << 20):
            words = words_of(batch.column("text"))
            found = Sentences(words)
            text, a, b = found.spans(*limits)
            a, b, base = found.word[a], found.word[b], words.first[text]
            own = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [pa.array(sequence_hashes(words.hashes(), a, b).view(np.int64)), batch.column("id").take(own), batch.column("doc").take(own),
                 pa.array((a - base) << 32 | (b - base))], ["hash", "id", "doc", "at"])

    return rows.select("id", "doc", "text").mapInArrow(read, f"hash long, id {kind}, doc long, at long")


def later(spots: DataFrame, out: str) -> DataFrame:
    """``(doc, out)``: the places of each text that are not the first of their
    hash.  Firsts are taken off per text, as plain numbers, so hot hashes meet
    in no second join."""
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "doc", "at")
    first = spots.groupBy("hash").agg(F.min(order).alias("f")).groupBy(F.col("f.doc").alias("doc")).agg(F.collect_set("f.at").alias("firsts"))
    every = spots.groupBy("doc").agg(F.collect_set("at").alias("every"))
    rest = F.when(F.col("firsts").isNull(), F.col("every")).otherwise(F.array_except("every", "firsts"))
    return every.join(first, "doc", "left").select("doc", rest.alias(out)).where(F.size(out) > 0)


def repeated_runs(rows: DataFrame, limits: tuple[int, int, int]) -> DataFrame:
    """``(doc, spans)``: the runs of each text that are not the first of their
    hash."""
    repeated, _ = write_table(sentence_runs(rows, limits).groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
                              .where("n > 1").select("hash"), "span_repeated")
    spots, _ = write_table(sentence_runs(rows, limits).join(repeated, "hash"), "span_spots")
    return later(spots, "spans")


def live_windows(batch: pa.RecordBatch, size: int) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """The words and their hashes, and first word and seed of the windows that
    do not lose all their words to the ``spans`` of their row."""
    words = words_of(batch.column("text"))
    word_hash = words.hashes()
    start, seed = windows(words, word_hash, size)
    lost = np.concatenate([[0], np.cumsum(covered(len(word_hash), *spans_of(batch.column("spans"), words)))])
    live = lost[start + size] - lost[start] < size
    return words, word_hash, start[live], seed[live]


def repeated_windows(rows: DataFrame, size: int) -> DataFrame:
    """``(doc, windows)`` of ``(id, doc, text, spans)``: the windows of each text
    that are not the first of their hash, by their first word.  What goes with
    its sentences counts no more."""
    kind = rows.schema["id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches, "text", 1 << 20):
            words, _, start, seed = live_windows(batch, size)
            one = seeds(start, seed, size)
            text = np.searchsorted(words.first, start[one], side="right") - 1
            yield pa.RecordBatch.from_arrays([pa.array(seed[one]), batch.column("doc").take(pa.array(text))], ["seed", "doc"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches, "text", 1 << 20):
            words, word_hash, start, seed = live_windows(batch, size)
            text = np.searchsorted(words.first, start, side="right") - 1
            row, wanted = places(batch.column("seeds"))
            # pairs of text and seed in one sorted order
            order = np.lexsort((wanted, row))
            row, wanted = row[order], wanted[order]
            edge = np.searchsorted(row, np.arange(len(words.first)))
            keep = np.zeros(len(start), bool)
            cut = np.searchsorted(text, np.arange(len(words.first)))
            for i in range(len(words.first) - 1):
                own = wanted[edge[i]:edge[i + 1]]
                if len(own):
                    here = seed[cut[i]:cut[i + 1]]
                    keep[cut[i]:cut[i + 1]] = own[np.minimum(np.searchsorted(own, here), len(own) - 1)] == here
            start, text = start[keep], text[keep]
            own = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [pa.array(sequence_hashes(word_hash, start, start + size).view(np.int64)), batch.column("id").take(own), batch.column("doc").take(own),
                 pa.array((start - words.first[text]).astype(np.int64))], ["hash", "id", "doc", "at"])

    seen, _ = write_table(rows.select("doc", "text", "spans").mapInArrow(count, "seed long, doc long"), "span_seeds")
    repeated = seen.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("seed")
    found = split_join(seen, repeated, "seed").groupBy("doc").agg(F.collect_set("seed").alias("seeds"))
    spots, _ = write_table(rows.join(found, "doc").select("id", "doc", "text", "spans", "seeds")
                           .mapInArrow(read, f"hash long, id {kind}, doc long, at long"), "span_windows")
    return later(spots, "windows")


def covered(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of ``n`` words the runs ``a:b`` cover."""
    mark = np.zeros(n + 1, np.int64)
    np.add.at(mark, a, 1)
    np.add.at(mark, b, -1)
    return np.cumsum(mark[:-1]) > 0


def _lost_bytes(found: Sentences, lo: int, hi: int, at: int, size: int, lost: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """Which of the ``size`` bytes of one text go, its sentences being
    ``lo:hi`` and ``at`` its first byte."""
    words, out = found.words, np.zeros(size, bool)
    edge = np.append(found.byte[lo:hi] - at, size).tolist()
    any_lost = np.logical_or.reduceat(lost, found.word[lo:hi])
    for k in (lo + np.flatnonzero(any_lost)).tolist():
        if gone[k]:
            out[edge[k - lo]:edge[k - lo + 1]] = True
            continue
        first, last = int(found.word[k]), int(found.word[k + 1])
        turn = first + np.flatnonzero(np.diff(np.concatenate([[0], lost[first:last].view(np.int8), [0]])))
        for s, e in zip(turn[::2].tolist(), turn[1::2].tolist(), strict=True):
            out[words.start[s] - at:(words.start[e] if e < last else words.end[e - 1]) - at] = True
    return out


def _without(rows: DataFrame, text_col: str, passage: int, columns: list[str], out: T.StructType,
             drop_emptied: bool = False) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches, text_col, 1 << 20):
            words = words_of(batch.column(text_col))
            found = Sentences(words)
            texts, count = batch.column(text_col).to_pylist(), np.diff(found.first)
            removed = np.zeros(len(count), np.int64)
            a, b = spans_of(batch.column("__spans"), words)
            row, at = places(batch.column("__windows"))
            a, b = np.concatenate([a, at + words.first[row]]), np.concatenate([b, at + words.first[row] + passage])
            if len(a):
                lost = covered(len(words.start), a, b)
                gone = np.diff(np.concatenate([[0], np.cumsum(lost)])[found.word]) == np.diff(found.word)
                for i in np.unique(np.searchsorted(words.first, a, side="right") - 1).tolist():
                    raw, at = np.frombuffer(texts[i].encode(), np.uint8), int(words.at[i])
                    lo, hi = int(found.first[i]), int(found.first[i + 1])
                    removed[i] = gone[lo:hi].sum()
                    texts[i] = raw[~_lost_bytes(found, lo, hi, at, len(raw), lost, gone)].tobytes().decode()
            made = {text_col: pa.array(texts, pa.string()), "n_sentences": pa.array(count, pa.int64()), "n_removed": pa.array(removed)}
            names = out.fieldNames()
            made = pa.RecordBatch.from_arrays([made[c] if c in made and (c == text_col or c not in columns) else batch.column(c) for c in names], names)
            yield made.filter(pa.array((removed < count) | (count == 0))) if drop_emptied else made

    return rows.mapInArrow(cut, out)


def _marked(docs: DataFrame, id_col: str, text_col: str, limits: tuple[int, int, int, int]) -> DataFrame:
    digest = F.xxhash64(F.col(id_col), F.col(text_col))
    rows = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), digest.alias("doc"), F.col(text_col).alias("text"))
    spans, _ = write_table(repeated_runs(rows, limits[:3]), "span_lists")
    more, _ = write_table(repeated_windows(rows.join(spans, "doc", "left"), limits[3]), "window_lists")
    spans = spans.select(F.col("doc").alias("__doc"), F.col("spans").alias("__spans"))
    more = more.select(F.col("doc").alias("__doc"), F.col("windows").alias("__windows"))
    return docs.withColumn("__doc", digest).join(spans, "__doc", "left").join(more, "__doc", "left").drop("__doc")


def substring_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sentences: int = SENTENCES,
                     words: int = WORDS, words_alone: int = WORDS_ALONE, passage: int = PASSAGE) -> DataFrame:
    """``(id, n_sentences, n_removed, text)`` per document, ``n_removed`` being
    the sentences that went whole and ``text`` what is left."""
    marked = _marked(docs.select(id_col, text_col), id_col, text_col, (sentences, words, words_alone, passage))
    out = T.StructType([docs.schema[id_col], T.StructField("n_sentences", T.LongType()),
                        T.StructField("n_removed", T.LongType()), T.StructField(text_col, T.StringType())])
    return _without(marked, text_col, passage, [id_col], out)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sentences: int = SENTENCES,
                    words: int = WORDS, words_alone: int = WORDS_ALONE, drop_emptied: bool = True,
                    passage: int = PASSAGE) -> DataFrame:
    """The documents, same columns, without the words of repeated runs.  With
    ``drop_emptied`` a document that loses its every sentence goes."""
    marked = _marked(docs, id_col, text_col, (sentences, words, words_alone, passage))
    return _without(marked, text_col, passage, docs.columns, docs.schema, drop_emptied)
