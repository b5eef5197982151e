"""Hard negatives by angular triangle filtering.

Vectors become whole numbers (``floor(scale * x)``); a score is their exact
inner product.  Every vector stores its norm and its angles to a few reference
directions.  By the triangle inequality for angles, the angle between two
vectors is at least the largest difference of their angles to a reference and
at most the least sum; the cosines of these, times both norms, widened beyond
any rounding, bound the score.  Only pairs whose bounds overlap what is still
asked for, the best so far or a window of scores, get an integer product.

Rows are cut by range of label, nearest reference and angle into blocks of
about ``BLOCK``.  Anchors meet the blocks in a stream: a task holds one block
and reads the anchors dealt to it batch by batch, keeping the best few of the
block for each.  Positives come from the blocks of the anchor's label; their
scores are the windows for the second pass over the other blocks.

Of equal vectors of a label only the least ``POSITIVES + 1`` ids can be among
the first, so no more of them enter the blocks: a third of all rows being
copies costs nothing.  Anchors are all kept.

Defined results: rows with a null label or vector, or null, NaN or infinite
components take no part; neither do vectors whose scores may leave the range of
exact comparison (a squared norm of 2**59 or more after scaling).  Vectors of
different lengths are never compared.  A row that repeats an id is a row of its
own, also for its twin.  A null id is no anchor and comes after all others.  An
anchor without positives or a window without rows gives nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.llm.tables import write_seen, write_table

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
REFERENCES = 16
SAMPLE = 2048  # rows that the reference directions are chosen from
BLOCK = 4096
LOW, HIGH = 4, 5  # a negative scores at least 4 / 5 of the positive
_NO_ID = 2**63 - 1  # stands for a null id
_EPS = 1e-6


def references(sample: list[np.ndarray], count: int = REFERENCES) -> dict[int, np.ndarray]:
    """Unit directions per vector length: the sampled vector farthest from
    those taken before, by angle."""
    out = {}
    for dim in sorted({len(v) for v in sample}):
        x = np.array([v for v in sample if len(v) == dim], np.float64)
        norm = np.sqrt((x * x).sum(1))
        x = x[norm > 0] / norm[norm > 0, None]
        if not len(x):
            continue
        taken, best = [0], x @ x[0]
        while len(taken) < min(count, len(x)):
            taken.append(int(np.argmin(best)))
            best = np.maximum(best, x @ x[taken[-1]])
        out[dim] = x[taken]
    return out


def angles(x: np.ndarray, refs: dict[int, np.ndarray], count: int = REFERENCES) -> np.ndarray:
    """Angles of vectors of one length to its references; a length that was not
    sampled, and what is missing to ``count``, gets fixed random directions."""
    dim = x.shape[1]
    r = refs.get(dim, np.zeros((0, dim)))
    if len(r) < count and dim:
        more = np.random.default_rng(dim).standard_normal((count - len(r), dim))
        r = np.concatenate([r, more / np.sqrt((more * more).sum(1))[:, None]])
    norm = np.sqrt((x * x).sum(1))
    if not dim:
        return np.zeros((len(x), count))
    return np.where(norm[:, None] > 0, np.arccos(np.clip((x @ r.T) / np.where(norm > 0, norm, 1)[:, None], -1, 1)), 0.0)


def score_bounds(angle: np.ndarray, norm: np.ndarray, own_angle: np.ndarray, own_norm: float) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of vectors with a vector, safe from rounding."""
    near = np.maximum(np.abs(angle - own_angle).max(1) - _EPS, 0)
    total = angle + own_angle
    far = np.minimum(np.minimum(total, 2 * np.pi - total).min(1) + _EPS, np.pi)
    size = norm * own_norm
    slack = 1e-9 * size + 1
    return size * np.cos(far) - slack, size * np.cos(near) + slack


def _points(rows: DataFrame, scale: int) -> DataFrame:
    """``(id, label, dim, vector, norm)``: whole numbers as packed int64."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            at, flat = np.asarray(lists.offsets), lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
            with np.errstate(over="ignore", invalid="ignore"):
                flat = np.floor(scale * flat)
                norm2 = np.array([np.dot(flat[a:b], flat[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], np.float64)
            keep = np.flatnonzero(norm2 < 2.0**59)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(keep)), batch.column("label").take(pa.array(keep)), pa.array((at[keep + 1] - at[keep]).astype(np.int32)),
                 pa.array([flat[at[k]:at[k + 1]].astype("<i8").tobytes() for k in keep.tolist()], pa.binary()), pa.array(np.sqrt(norm2[keep]))],
                ["id", "label", "dim", "vector", "norm"])

    return rows.select("id", "label", "vector").mapInArrow(pack, "id long, label long, dim int, vector binary, norm double")


def _angled(points: DataFrame, refs: dict[int, np.ndarray]) -> DataFrame:
    """With the packed angles, the nearest reference and the angle to it."""
    names = points.columns

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            vectors = batch.column("vector").to_pylist()
            out = np.zeros((len(dims), REFERENCES))
            for dim in np.unique(dims).tolist():
                own = np.flatnonzero(dims == dim)
                x = np.frombuffer(b"".join(vectors[k] for k in own.tolist()), "<i8").reshape(len(own), dim).astype(np.float64)
                out[own] = angles(x, refs)
            near = out.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array([a.tobytes() for a in out.astype("<f8")], pa.binary()),
                 pa.array(near.astype(np.int32)), pa.array(out[np.arange(len(out)), near])], [*names, "angles", "near", "angle"])

    schema = points.schema.simpleString()[len("struct<"):-1]
    return points.mapInArrow(measure, f"{schema},angles:binary,near:int,angle:double")


class Block:
    """The rows of one block, by vector length."""

    def __init__(self, batches: list[pa.RecordBatch]):
        table = pa.Table.from_batches(batches)
        dims, vectors, packed = table["dim"].to_numpy(), table["vector"].to_pylist(), table["angles"].to_pylist()
        ids, labels, norms = (table[c].to_numpy() for c in ("id", "label", "norm"))
        self.parts = {}
        for dim in np.unique(dims).tolist():
            own = np.flatnonzero(dims == dim)
            x = np.frombuffer(b"".join(vectors[k] for k in own.tolist()), "<i8").reshape(len(own), dim)
            angle = np.frombuffer(b"".join(packed[k] for k in own.tolist()), "<f8").reshape(len(own), -1)
            self.parts[dim] = (ids[own], labels[own], x, x.astype(np.float64), norms[own], angle)


def _scores(x: np.ndarray, x_float: np.ndarray, at: np.ndarray, own: np.ndarray, size: float) -> np.ndarray:
    """Integer inner products; doubles are exact while no sum can leave 2**53."""
    if size < 2.0**52:
        return (x_float[at] @ own.astype(np.float64)).astype(np.int64)
    return (x[at] * own).sum(1)


def first_of(score: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    """Positions of the first ``count``: higher scores, then lesser ids."""
    if len(score) > 4 * count:
        some = np.flatnonzero(score >= np.partition(score, -count)[-count])
        return some[np.lexsort((ids[some], -score[some]))[:count]]
    return np.lexsort((ids, -score))[:count]


def _positives(block: Block, a: dict, count: int) -> list[tuple]:
    if a["dim"] not in block.parts:
        return []
    ids, labels, x, x_float, norm, angle = block.parts[a["dim"]]
    own = np.flatnonzero(labels == a["label"])
    if not len(own):
        return []
    low, high = score_bounds(angle[own], norm[own], a["angles"], a["norm"])
    if len(own) > count:  # what is surely below the best so many is left out
        own = own[high >= np.partition(low, -count)[-count]]
    score = _scores(x, x_float, own, a["vector"], float(norm[own].max(initial=0)) * a["norm"])
    got = first_of(score, ids[own], count)
    return [(a["rid"], int(ids[k]), int(s), bool(ids[k] == a["id"] and np.array_equal(x[k], a["vector"])))
            for k, s in zip(own[got].tolist(), score[got].tolist(), strict=True)]


def _negatives(block: Block, a: dict, count: int) -> list[tuple]:
    if a["dim"] not in block.parts:
        return []
    ids, labels, x, x_float, norm, angle = block.parts[a["dim"]]
    windows = sorted({s for s in a["windows"] if s >= 0})
    if not windows:
        return []
    low, high = score_bounds(angle, norm, a["angles"], a["norm"])
    wanted = np.zeros(len(ids), bool)
    for s in windows:
        wanted |= (high * HIGH >= LOW * s) & (low <= s)
    own = np.flatnonzero(wanted & (labels != a["label"]))
    if not len(own):
        return []
    score = _scores(x, x_float, own, a["vector"], float(norm[own].max()) * a["norm"])
    out = []
    for s in windows:
        inside = np.flatnonzero((score <= s) & (HIGH * score >= LOW * s))
        got = inside[first_of(score[inside], ids[own[inside]], count)]
        out += [(a["rid"], s, int(i), int(v)) for i, v in zip(ids[own[got]].tolist(), score[got].tolist(), strict=True)]
    return out


def _streamed(find, count: int, names: list[str], types: list[pa.DataType]):
    """Anchors of each block against its rows; rows come before anchors."""
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows, block = None, [], None
        for batch in batches:
            blocks, kinds = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
            cut = np.flatnonzero(np.concatenate([[True], (blocks[1:] != blocks[:-1]) | (kinds[1:] != kinds[:-1])]))
            for lo, hi in zip(cut.tolist(), [*cut[1:].tolist(), len(blocks)], strict=True):
                part = batch.slice(lo, hi - lo)
                if blocks[lo] != at:
                    at, rows, block = blocks[lo], [], None
                if kinds[lo] == 0:
                    rows.append(part)
                    continue
                if block is None:
                    block = Block(rows) if rows else None
                if block is None:
                    continue
                out = []
                for a in part.to_pylist():
                    a["vector"], a["angles"] = np.frombuffer(a["vector"], "<i8"), np.frombuffer(a["angles"], "<f8")
                    out += find(block, a, count)
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    return meet


def _met(points: DataFrame, anchors: DataFrame, n_blocks: int, find, count: int, names: list[str], types: list[pa.DataType], schema: str) -> DataFrame:
    cols = ["block", "kind", "rid", "id", "label", "dim", "vector", "norm", "angles", "windows"]
    rows = points.withColumn("kind", F.lit(0)).withColumn("rid", F.lit(None).cast("long")).withColumn("windows", F.lit(None).cast("array<long>"))
    both = rows.select(cols).unionByName(anchors.withColumn("kind", F.lit(1)).select(cols))
    # a task per block, whatever its bytes: its work is the anchors that it reads
    dealt = both.repartition(n_blocks, "block").sortWithinPartitions("block", "kind", "rid")
    return dealt.mapInArrow(_streamed(find, count, names, types), schema)


def hard_negatives(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   anchors: str = "id % 100 = 0", positives: int = POSITIVES, negatives: int = NEGATIVES,
                   scale: int = SCALE, block: int = BLOCK) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score)``: for every anchor and each of its first ``positives``
    rows of its label, the first ``negatives`` rows of other labels that score
    between 4/5 of the positive's score and that score.  ``anchors`` is a
    condition on ``id``."""
    v = F.col(vector_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    own = rows.where(F.col(label_col).isNotNull() & v.isNotNull() & ~F.coalesce(bad, F.lit(True))).select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("id"), F.col(label_col).cast("long").alias("label"), v.cast("array<double>").alias("vector"))
    points, _ = write_table(_points(own, scale), "negatives_points")
    sample = points.select("vector", "id").orderBy(F.xxhash64("vector"), "id").limit(SAMPLE).select("vector").collect()
    refs = references([np.frombuffer(bytes(r.vector), "<i8") for r in sample])
    # the least ids of equal vectors: Spark limits them before the shuffle too
    copies = Window.partitionBy("label", "vector").orderBy("id")
    few = points.withColumn("k", F.row_number().over(copies)).where(F.col("k") <= max(positives + 1, negatives)).drop("k")
    few, _, seen = write_seen(_angled(few, refs), "negatives_few", n=F.count(F.lit(1)))
    n_blocks = max(1, -(-seen["n"] // block))
    blocks, _ = write_table(few.repartitionByRange(n_blocks, "dim", "label", "near", "angle", "id")
                            .withColumn("block", F.spark_partition_id()), "negatives_blocks")
    asked, _ = write_table(_angled(points.where(F.col("id") != _NO_ID).where(anchors), refs)
                           .withColumn("rid", F.monotonically_increasing_id()), "negatives_anchors")
    held = blocks.select("dim", "label", "block").distinct()
    dealt = asked.join(held, ["dim", "label"]).withColumn("windows", F.lit(None).cast("array<long>"))
    found = _met(blocks, dealt, n_blocks, _positives, positives + 1, ["rid", "pid", "score", "self"],
                 [pa.int64(), pa.int64(), pa.int64(), pa.bool_()], "rid long, pid long, score long, self boolean")
    by_anchor = Window.partitionBy("rid")
    best = F.row_number().over(by_anchor.orderBy(F.desc("score"), "pid", F.desc("self")))
    found = found.withColumn("k", best).where(F.col("k") <= positives + 1)
    # one row is the anchor itself; a twin of it is another row
    me = F.min(F.when(F.col("self"), F.col("k"))).over(by_anchor)
    found = found.withColumn("me", me).where(F.col("me").isNull() | (F.col("k") != F.col("me")))
    found = found.withColumn("k", F.row_number().over(by_anchor.orderBy("k"))).where(F.col("k") <= positives)
    chosen, _ = write_table(found.select("rid", "pid", "score", "k"), "negatives_positives")
    windows = chosen.groupBy("rid").agg(F.collect_set("score").alias("windows"))
    every = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block")
    dealt = asked.join(windows, "rid").select("*", every)
    near = _met(blocks, dealt, n_blocks, _negatives, negatives, ["rid", "score", "nid", "n_score"], [pa.int64()] * 4,
                "rid long, score long, nid long, n_score long")
    rank = F.row_number().over(Window.partitionBy("rid", "score").orderBy(F.desc("n_score"), "nid"))
    near = near.withColumn("rank", rank).where(F.col("rank") <= negatives)
    no_id = lambda c: F.when(F.col(c) != _NO_ID, F.col(c))
    return (chosen.join(near, ["rid", "score"]).join(asked.select("rid", F.col("id").alias("anchor_id")), "rid")
            .select("anchor_id", no_id("pid").alias("positive_id"), F.col("rank").cast("int").alias("rank"), no_id("nid").alias("negative_id"),
                    F.col("score").alias("positive_score"), F.col("n_score").alias("negative_score")))
