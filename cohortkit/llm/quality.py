"""A document quality classifier on random-indexing word vectors.

Every token (a run of letters and digits, or of other signs; case counts) has a
sparse random index vector.  A token's context vector is the sum of the index
vectors of its neighbours over the whole corpus; it is gathered by Spark in one
pass and summed per token bucket.  Tokens are hashed to ``BUCKETS`` buckets, so
the table of vectors has a fixed size, and is what gets broadcast.  A document
is the mean and the spread of its weighted token vectors, with the share of
tokens that repeat their neighbour.  A two-layer network
in numpy learns labels from them; one temperature, fitted on rows it has not
learned from, calibrates its probabilities.

The network is fitted on at most ``SAMPLE`` labelled rows, those of least hash
of their id; corpus statistics are over all documents.  Only the text enters a
score.

Defined results: a null text counts as empty, and an empty text is scored as
the document without tokens; labels that are null, of unknown documents or
with a null id teach nothing; without labels of both kinds every document gets
the share of label 1 that was seen, or 0.5.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.tables import write_table
from cohortkit.llm.text import run_hashes, runs, small_slices, text_bytes

BUCKETS = 1 << 13
DIM = 64
NONZERO = 4
FEATURES = 2 * DIM + 1
REACH = 2  # neighbours on either side
SAMPLE = 20_000
POOLED = 128  # texts whose token counts are held together
HIDDEN = 32
PASS_MARK = 0.7

_KIND = np.full(256, 2, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[48:58] = _KIND[65:91] = _KIND[97:123] = _KIND[128:] = 1
_RNG = np.random.default_rng(8)
_PLACE = _RNG.integers(0, DIM, (BUCKETS, NONZERO))
_SIGN = _RNG.choice([-1.0, 1.0], (BUCKETS, NONZERO))


def tokens_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every token of the texts, and the ``n + 1`` token offsets."""
    buf, at = text_bytes(column)
    start, end = runs(_KIND[buf], at)
    bucket = (run_hashes(buf, start, end) % np.uint64(BUCKETS)).astype(np.int64)
    return bucket, np.searchsorted(start, at)


def context_sums(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(bucket, n, c0 ... )``: occurrences and context vector of each token
    bucket over all documents.  A task sums its own documents first."""
    names = ["n", *(f"c{j}" for j in range(DIM))]

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = np.zeros(BUCKETS * DIM), np.zeros(BUCKETS, np.int64)
        for batch in small_slices(batches, "text"):
            bucket, first = tokens_of(batch.column("text"))
            n += np.bincount(bucket, minlength=BUCKETS)
            text = np.repeat(np.arange(len(first) - 1), np.diff(first))
            for step in range(1, REACH + 1):
                near = np.flatnonzero(text[step:] == text[:-step])
                left, right = bucket[near], bucket[near + step]
                for k in range(NONZERO):
                    sums += np.bincount(left * DIM + _PLACE[right, k], _SIGN[right, k], len(sums))
                    sums += np.bincount(right * DIM + _PLACE[left, k], _SIGN[left, k], len(sums))
        seen = np.flatnonzero(n)
        table = sums.reshape(BUCKETS, DIM)[seen].astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(n[seen]), *map(pa.array, table.T.copy())],
                                         ["bucket", *names])

    parts = docs.select(F.col(text_col).alias("text")).mapInArrow(gather, "bucket int, " + ", ".join(f"{c} long" for c in names))
    return parts.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in names])


def word_vectors(sums: DataFrame) -> np.ndarray:
    """Weighted token vectors by bucket: context vectors of unit length around
    the corpus mean, frequent tokens counting less.  ``BUCKETS`` rows at most
    reach the driver."""
    vectors = np.zeros((BUCKETS, DIM))
    n = np.zeros(BUCKETS)
    for r in sums.collect():
        n[r.bucket], vectors[r.bucket] = r.n, r[2:]
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors /= np.where(length > 0, length, 1)
    share = n / max(1.0, n.sum())
    vectors -= share @ vectors
    weight = 1e-3 / (1e-3 + share)
    return (vectors * weight[:, None] * (n > 0)[:, None]).astype(np.float32)


def pooled(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the token vectors of each text, and the share of
    tokens that repeat the one before."""
    bucket, first = tokens_of(column)
    n = np.diff(first)
    out = np.zeros((len(n), FEATURES), np.float32)
    full = np.flatnonzero(n)
    if not len(full):
        return out
    both = np.concatenate([vectors, vectors * vectors], axis=1)
    for lo in range(0, len(n), POOLED):  # counts of some texts by bucket, times the vectors
        hi = min(lo + POOLED, len(n))
        own = np.repeat(np.arange(hi - lo), n[lo:hi])
        counts = np.bincount(own * BUCKETS + bucket[first[lo]:first[hi]], minlength=(hi - lo) * BUCKETS)
        sums = counts.reshape(hi - lo, BUCKETS).astype(np.float32) @ both
        mean, square = np.hsplit(sums / np.maximum(n[lo:hi, None], 1), 2)
        out[lo:hi, :DIM], out[lo:hi, DIM:-1] = mean, np.sqrt(np.maximum(square - mean * mean, 0))
    again = np.append(False, bucket[1:] == bucket[:-1])
    again[first[full]] = False
    out[full, -1] = np.add.reduceat(again.astype(np.float64), first[full]) / n[full]
    return out


class Network:
    """Two layers, fitted with Adam; ``temperature`` divides the log-odds."""

    def __init__(self, x: np.ndarray, y: np.ndarray, hidden: int = HIDDEN, epochs: int = 60, seed: int = 4):
        rng = np.random.default_rng(seed)
        self.temperature, self.constant = 1.0, None
        if not len(y) or y.min() == y.max():
            self.constant = float(y.mean()) if len(y) else 0.5
            return
        self.shift, self.scale = x.mean(0), x.std(0) + 1e-6
        x = ((x - self.shift) / self.scale).astype(np.float64)
        order = rng.permutation(len(y))
        check, learn = order[:len(y) // 5], order[len(y) // 5:]
        w = [rng.standard_normal((x.shape[1], hidden)) / np.sqrt(x.shape[1]), np.zeros(hidden),
             rng.standard_normal(hidden) / np.sqrt(hidden), np.zeros(1)]
        m, v, t = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], 0
        for epoch in range(epochs):
            rate = 3e-3 * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
            learn = rng.permutation(learn)
            for at in range(0, len(learn), 128):
                own = learn[at:at + 128]
                h = np.tanh(x[own] @ w[0] + w[1])
                p = 1 / (1 + np.exp(-(h @ w[2] + w[3])))
                d = (p - y[own]) / len(own)
                back = np.outer(d, w[2]) * (1 - h * h)
                grads = [x[own].T @ back + 1e-3 * w[0], back.sum(0), h.T @ d + 1e-3 * w[2], d.sum(keepdims=True)]
                t += 1
                for k, g in enumerate(grads):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    w[k] = w[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
        self.w = w
        if len(check):
            odds = self._odds(x[check])
            grid = np.exp(np.linspace(np.log(0.25), np.log(8), 141))
            loss = [np.mean(np.logaddexp(0, -odds / g) * y[check] + np.logaddexp(0, odds / g) * (1 - y[check])) for g in grid]
            self.temperature = float(grid[int(np.argmin(loss))])

    def _odds(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ self.w[0] + self.w[1]) @ self.w[2] + self.w[3]

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self._odds((x - self.shift) / self.scale) / self.temperature, -60, 60)))


def is_held_out(id_col: str) -> F.Column:
    """Every fourth id by its checksum: never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        sample: int = SAMPLE) -> tuple[np.ndarray, Network]:
    """Token vectors over all documents and the network on labelled ones."""
    sums, _ = write_table(context_sums(docs, text_col), "quality_context")
    vectors = word_vectors(sums)
    chosen = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~is_held_out(id_col))
              .select(F.col(id_col).alias("__id"), F.col(label_col).cast("double").alias("label"))
              .orderBy(F.xxhash64(F.col("__id").cast("string")), "__id", "label").limit(sample))
    # at most `sample` short rows: bounded, so broadcast
    rows = docs.select(F.col(id_col).alias("__doc"), F.col(text_col).alias("text"))
    rows = rows.join(F.broadcast(chosen), rows["__doc"] == chosen["__id"]).select("label", "text")
    handle = docs.sparkSession.sparkContext.broadcast(vectors)

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches, "text", 1 << 20):
            x = pooled(batch.column("text"), handle.value)
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array([r.tobytes() for r in x], pa.binary())], ["label", "x"])

    learned, _ = write_table(rows.mapInArrow(pool, "label double, x binary"), "quality_rows")
    got = sorted((bytes(r.x), r.label) for r in learned.limit(2 * sample).collect())
    x = np.frombuffer(b"".join(b for b, _ in got), np.float32).reshape(-1, FEATURES).astype(np.float64)
    return vectors, Network(x, np.array([y for _, y in got], np.float64))


def scored(docs: DataFrame, model: tuple[np.ndarray, Network], score_col: str, text_col: str = "text") -> DataFrame:
    """The documents with their calibrated probability of label 1."""
    from pyspark.sql import types as T
    handle = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    columns = docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, network = pickle.loads(handle.value)
        for batch in small_slices(batches, text_col, 1 << 20):
            scores = network.scores(pooled(batch.column(text_col), vectors).astype(np.float64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*columns, score_col])

    return docs.mapInArrow(read, schema)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", pass_mark: float = PASS_MARK, sample: int = SAMPLE) -> DataFrame:
    """``(id, held_out, score, predicted)`` per document."""
    model = fit(docs, labels, id_col, text_col, label_col, sample)
    rows = scored(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), model, "score")
    return rows.select(F.col("id").alias(id_col), is_held_out("id").alias("held_out"), "score",
                       (F.col("score") >= pass_mark).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              label_col: str = "quality", pass_mark: float = PASS_MARK, sample: int = SAMPLE) -> DataFrame:
    """The documents that the classifier predicts as label 1, same columns."""
    score = "__score"
    while score in docs.columns:
        score += "_"
    model = fit(docs, labels, id_col, text_col, label_col, sample)
    return scored(docs, model, score, text_col).where(F.col(score) >= pass_mark).drop(score)
