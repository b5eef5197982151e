"""Toxicity by a factorization machine over hashed terms.

The terms of a text are its words and their beginnings of some bytes (a stem
that takes many endings is one term), as 64-bit hashes, each counted: that a
term occurs once, twice, four times are three features.  A class of the text's
length is one more.  Beside a weight per feature the machine has a vector per
feature, and every pair of features of a text adds the product of their
vectors: an insult next to the mention of a group, or a stem that occurs again
in a short text but not in a long one, counts for more than its parts.

It is fitted in numpy on at most ``SAMPLE`` labelled rows, those of least hash
of their id, over the ``FEATURES`` features that tell the labels of these rows
apart best by their log-likelihood ratio, counted by Spark.  Only the text
enters a score, and whole texts are read: a task holds the hashes of the chosen
terms, nothing that grows with the corpus.

Defined results: a null text counts as empty, and an empty text is scored as a
text without terms; labels that are null, neither 0 nor 1, of unknown documents
or with a null id teach nothing; rows with a null id are not held out; without
labels of both kinds every document gets the share of label 1 that was seen, or
0.0 when none was.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.tables import write_table
from cohortkit.llm.text import mix, run_hashes, small_slices, words_of

SAMPLE = 20_000
FEATURES = 4096
TELLING = 10.0  # least log-likelihood ratio of a feature
SEEN = 4  # least documents of a feature
FACTORS = 8
EPOCHS = 15
BATCH = 128
HELD_OUT = 5  # every fifth id by its checksum is never learned from
PASS_MARK = 0.5
LEVELS = (1, 2, 4)
STEMS = (4, 5, 6)  # bytes of a word's beginning

_LENGTH = np.uint64(0xD1B54A32D192ED03)
_KEY = np.random.default_rng(13).integers(1, 2**63, len(STEMS), dtype=np.uint64)


def terms_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number and hash of every term occurrence, and the words by text."""
    words = words_of(column)
    text = np.searchsorted(words.first, np.arange(len(words.start)), side="right") - 1
    texts, hashes = [text], [words.hashes()]
    length = words.end - words.start
    for k, size in enumerate(STEMS):
        own = np.flatnonzero(length >= size)
        texts.append(text[own])
        hashes.append(mix(run_hashes(words.buf, words.start[own], words.start[own] + size) ^ _KEY[k]))
    return np.concatenate(texts), np.concatenate(hashes), words.counts()


def length_class(n: np.ndarray) -> np.ndarray:
    return mix(np.floor(np.log2(n + 1.0)).astype(np.uint64) + _LENGTH)


def counted(text: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ``(text, term)`` and how often each occurs."""
    order = np.lexsort((term, text))
    text, term = text[order], term[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (term[1:] != term[:-1])
    edge = np.flatnonzero(new)
    return text[edge], term[edge], np.diff(np.append(edge, len(text)))


def feature_counts(rows: DataFrame) -> DataFrame:
    """``(term, level, pos, neg)``: documents by label that hold each feature;
    level -1 is a length class.  Rows are ``(label, text)``."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches, "text"):
            label = batch.column("label").to_numpy().astype(np.int64)
            text, term, n_words = terms_of(batch.column("text"))
            text, term, n = counted(text, term)
            cases = [(-1, length_class(n_words), label)] + [(k, term[n >= at], label[text[n >= at]]) for k, at in enumerate(LEVELS)]
            for level, terms, labels in cases:
                own, where = np.unique(terms, return_inverse=True)
                pos = np.bincount(where, labels, len(own)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own.view(np.int64)), pa.array(np.full(len(own), level, np.int32)), pa.array(pos),
                     pa.array(np.bincount(where, minlength=len(own)).astype(np.int64) - pos)], ["term", "level", "pos", "neg"])

    parts = rows.select("label", "text").mapInArrow(count, "term long, level int, pos long, neg long")
    return parts.groupBy("term", "level").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def telling(counts: DataFrame, n_pos: int, n_neg: int, features: int) -> DataFrame:
    """The features of greatest log-likelihood ratio against the label."""
    n = n_pos + n_neg

    def part(seen, row, column):
        seen = seen.cast("double")
        return F.when(seen > 0, seen * F.ln(seen * n / (row * column))).otherwise(0.0)

    pos, neg = F.col("pos"), F.col("neg")
    have, lack = pos + neg, F.greatest(F.lit(n) - pos - neg, F.lit(1))
    ratio = 2 * (part(pos, have, F.lit(float(n_pos))) + part(neg, have, F.lit(float(n_neg)))
                 + part(n_pos - pos, lack, F.lit(float(n_pos))) + part(n_neg - neg, lack, F.lit(float(n_neg))))
    rows = counts.where(pos + neg >= SEEN).withColumn("ratio", ratio).where(F.col("ratio") >= TELLING)
    return rows.orderBy(F.desc("ratio"), "term", "level").limit(features).select("term", "level")


class Reader:
    """Finds the chosen features in texts."""

    def __init__(self, term: np.ndarray, level: np.ndarray):
        term = term.view(np.uint64)
        self.terms = np.unique(term)
        self.feature = np.full((len(self.terms), len(LEVELS) + 1), -1, np.int32)  # the last column: length classes
        self.feature[np.searchsorted(self.terms, term), level] = np.arange(len(term))
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.terms & np.uint64(0xFFFFF)).astype(np.int64)] = True
        self.size = len(term)

    def _known(self, term: np.ndarray) -> np.ndarray:
        """Number of each hash among the terms, or -1."""
        out = np.full(len(term), -1, np.int64)
        some = np.flatnonzero(self.maybe[(term & np.uint64(0xFFFFF)).astype(np.int64)])
        if len(some):
            at = np.minimum(np.searchsorted(self.terms, term[some]), len(self.terms) - 1)
            out[some] = np.where(self.terms[at] == term[some], at, -1)
        return out

    def read(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Features of the texts, in order of the text, and ``n + 1`` offsets."""
        n = len(column)
        if not self.size or not n:
            return np.zeros(0, np.int32), np.zeros(n + 1, np.int64)
        text, term, n_words = terms_of(column)
        known = self._known(term)
        live = known >= 0
        text, known, count = counted(text[live], known[live])
        texts, found = [], []
        for k, at in enumerate(LEVELS):
            own = self.feature[known, k]
            live = (count >= at) & (own >= 0)
            texts.append(text[live])
            found.append(own[live])
        length = self._known(length_class(n_words))
        own = np.where(length >= 0, self.feature[length, -1], -1)
        texts.append(np.flatnonzero(own >= 0))
        found.append(own[own >= 0])
        texts, found = np.concatenate(texts), np.concatenate(found)
        order = np.lexsort((found, texts))
        return found[order], np.searchsorted(texts[order], np.arange(n + 1))


class Machine:
    """A factorization machine for 0/1 features and labels, fitted with Adam.

    The features of a text weigh ``1 / sqrt(1 + how many)`` each in the products
    of pairs, so that these do not grow with the length of a text."""

    def __init__(self, found: list[np.ndarray], y: np.ndarray, size: int, factors: int = FACTORS, epochs: int = EPOCHS, seed: int = 13):
        self.constant = None
        if not len(y) or y.min() == y.max():
            self.constant = float(y.mean()) if len(y) else 0.0
            return
        rng = np.random.default_rng(seed)
        share = float(y.mean())
        p = [np.array([np.log(share / (1 - share))]), np.zeros(size), rng.normal(0, 0.05, (size, factors))]
        m, v, t = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
        for epoch in range(epochs):
            rate = 0.02 * 0.5 * (1 + np.cos(np.pi * epoch / epochs)) + 1e-4
            order = rng.permutation(len(y))
            for at in range(0, len(order), BATCH):
                own = order[at:at + BATCH]
                lists = [found[k] for k in own]
                x = self._dense(lists, size)
                z = x * self._damped(lists)[:, None]
                inner = z @ p[2]
                odds = p[0] + x @ p[1] + 0.5 * ((inner * inner).sum(1) - (z * z) @ (p[2] * p[2]).sum(1))
                d = (1 / (1 + np.exp(-np.clip(odds, -60, 60))) - y[own]) / len(own)
                grads = [d.sum(keepdims=True), x.T @ d + 1e-4 * p[1],
                         z.T @ (d[:, None] * inner) - p[2] * ((z * z).T @ d)[:, None] + 1e-4 * p[2]]
                t += 1
                for k, g in enumerate(grads):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    p[k] = p[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
        self.bias, self.weight, self.factor = float(p[0][0]), p[1], p[2]

    @staticmethod
    def _dense(lists: list[np.ndarray], size: int) -> np.ndarray:
        x = np.zeros((len(lists), size))
        x[np.repeat(np.arange(len(lists)), [len(a) for a in lists]), np.concatenate(lists)] = 1
        return x

    @staticmethod
    def _damped(lists: list[np.ndarray]) -> np.ndarray:
        return 1 / np.sqrt(1.0 + np.array([len(a) for a in lists]))

    def scores(self, found: np.ndarray, at: np.ndarray) -> np.ndarray:
        n = len(at) - 1
        if self.constant is not None:
            return np.full(n, self.constant)
        text = np.repeat(np.arange(n), np.diff(at))
        odds = self.bias + np.bincount(text, self.weight[found], n)
        damped = 1 / (1.0 + np.diff(at))
        for f in range(self.factor.shape[1]):
            own = self.factor[found, f]
            odds = odds + 0.5 * damped * (np.bincount(text, own, n) ** 2 - np.bincount(text, own * own, n))
        return 1 / (1 + np.exp(-np.clip(odds, -60, 60)))


def is_held_out(id_col: str) -> F.Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % HELD_OUT == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        sample: int = SAMPLE, features: int = FEATURES) -> tuple[Reader, Machine]:
    """The chosen features and the machine, from labelled rows not held out."""
    chosen = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~is_held_out(id_col))
              .select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("label"))
              .orderBy(F.xxhash64(F.col("__id").cast("string")), "__id", "label").limit(sample))
    # at most `sample` short rows: bounded, so broadcast
    rows = docs.select(F.col(id_col).alias("__doc"), F.col(text_col).alias("text"))
    rows, _ = write_table(rows.join(F.broadcast(chosen), rows["__doc"] == chosen["__id"]).select("label", "text"), "toxicity_rows")
    n_pos, n = rows.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count(F.lit(1))).first()
    picked = telling(feature_counts(rows), n_pos, n - n_pos, features).collect() if 0 < n_pos < n else []
    reader = Reader(np.array([r.term for r in picked], np.int64), np.array([r.level for r in picked], np.int64))
    handle = docs.sparkSession.sparkContext.broadcast(pickle.dumps(reader))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pickle.loads(handle.value)
        for batch in small_slices(batches, "text"):
            found, at = own.read(batch.column("text"))
            packed = [found[a:b].astype("<i4").tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(packed, pa.binary())], ["label", "found"])

    learned, _ = write_table(rows.mapInArrow(find, "label int, found binary"), "toxicity_features")
    got = sorted((bytes(r.found), r.label) for r in learned.toLocalIterator())
    handle.destroy()
    return reader, Machine([np.frombuffer(b, "<i4") for b, _ in got], np.array([y for _, y in got], np.float64), reader.size)


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                    pass_mark: float = PASS_MARK, sample: int = SAMPLE, features: int = FEATURES) -> DataFrame:
    """``(id, held_out, score, predicted)`` per document."""
    handle = docs.sparkSession.sparkContext.broadcast(pickle.dumps(fit(docs, labels, id_col, text_col, label_col, sample, features)))
    kind = docs.schema[id_col].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, machine = pickle.loads(handle.value)
        for batch in small_slices(batches, "text"):
            scores = machine.scores(*reader.read(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(scores)], ["id", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(score, f"id {kind}, score double")
    return rows.select(F.col("id").alias(id_col), is_held_out("id").alias("held_out"), "score",
                       (F.col("score") >= pass_mark).cast("int").alias("predicted"))
