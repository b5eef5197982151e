"""Near-duplicate embeddings by random-hyperplane signs.

Each of several tables hashes a vector to the signs of its products with
random hyperplanes; vectors of one label that share a hash in some table are
compared by cosine in double precision.  The number of hyperplanes follows the
number of vectors, so that buckets keep their size as the table grows, and the
number of tables follows from them and the target recall: a pair at angle
``a`` shares a table's hash with chance ``(1 - a / pi) ** bits``.

A bucket above ``BLOCK`` vectors is cut into blocks and every pair of blocks is
a task of its own.  A pair is counted in the first table that brings it
together, so counts need no list of pairs; only counts and spanning links are
written, and distributed connected components label the rows.

Defined results: a null label or vector, a zero vector, and vectors with null,
NaN or infinite components link with nothing; vectors of different lengths are
never compared; equal vectors of a label are one class with a weight; rows
that repeat an id each get a row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.links import label_rows, spanning_links
from cohortkit.llm.tables import split_join, write_table

THRESHOLD = 0.93
TARGET_RECALL = 0.9999
BUCKET = 256  # vectors that share the bits of one table by chance, if there were one label
BLOCK = 512
TASK_ROWS = 10_000


def plan_tables(n: int, threshold: float, target: float) -> tuple[int, int]:
    """Bits and tables for ``n`` vectors."""
    bits = max(4, min(30, math.ceil(math.log2(max(n, 1) / BUCKET)) if n > BUCKET else 4))
    share = (1 - math.acos(min(1.0, threshold)) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - target) / math.log(1 - share))) if share < 1 else 1


def hyperplanes(dim: int, bits: int, tables: int) -> np.ndarray:
    return np.random.default_rng(1000 + dim).standard_normal((dim, bits * tables))


def scaled(v: np.ndarray) -> np.ndarray:
    """The vector over a power of two near its largest component: the same
    direction to the bit, and squares that neither vanish nor overflow."""
    return np.ldexp(v, -int(np.frexp(np.abs(v).max())[1])) if len(v) else v


def _hashed(classes: DataFrame, bits: int, tables: int) -> DataFrame:
    """``(node, label, dim, copies, vector, hashes)``, vectors as doubles."""
    kind = classes.schema["label"].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weight = (1 << np.arange(bits)).astype(np.int64)
        for batch in batches:
            vectors = [scaled(np.asarray(v.values, np.float64)) for v in batch.column("embedding")]
            hashes = []
            for v in vectors:
                if len(v) not in planes:
                    planes[len(v)] = hyperplanes(len(v), bits, tables)
                hashes.append(((v @ planes[len(v)] > 0).reshape(tables, bits) @ weight).astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("label"), pa.array([len(v) for v in vectors], pa.int32()), batch.column("copies"),
                 pa.array([v.astype("<f8").tobytes() for v in vectors], pa.binary()), pa.array(hashes, pa.binary())],
                ["node", "label", "dim", "copies", "vector", "hashes"])

    return classes.select("node", "label", "copies", "embedding").mapInArrow(
        sign, f"node long, label {kind}, dim int, copies long, vector binary, hashes binary")


def _buckets(hashed: DataFrame, tables: int) -> DataFrame:
    """``(bucket, t, node)``: a bucket is a label, a length, a table and a hash."""
    at = F.sequence(F.lit(0), F.lit(tables - 1))
    rows = hashed.select("node", "label", "dim", F.posexplode(F.transform(at, lambda t: F.hex(F.substring(F.col("hashes"), t * 4 + 1, F.lit(4))))).alias("t", "hash"))
    return rows.select("node", "t", F.xxhash64(F.col("label").cast("string"), "dim", "t", "hash").alias("bucket"))


def _dealt(buckets: DataFrame, block: int) -> DataFrame:
    """Rows of buckets with company, each in the tasks where it is compared."""
    counts = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    rows = split_join(buckets, counts, "bucket").withColumn("blocks", F.ceil(F.col("m") / block).cast("int"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select("node", "t", "bucket", "block", "blocks", F.least("block", "other").alias("low"),
                       F.greatest("block", "other").alias("high"))


def _compare(threshold: float):
    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["bucket", "low", "high", "node"])
        key = group[["bucket", "low", "high"]].to_numpy()
        edge = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1, [len(key)]])
        node, copies, block, table = (group[c].to_numpy() for c in ("node", "copies", "block", "t"))
        vectors, hashes, lows, highs = (group[c].to_numpy() for c in ("vector", "hashes", "low", "high"))
        out = [(np.zeros(0, np.int64), np.zeros(0, object), np.zeros(0, np.int64))]
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            x = np.frombuffer(b"".join(vectors[a:b]), "<f8").reshape(b - a, -1)
            own = np.frombuffer(b"".join(hashes[a:b]), "<i4").reshape(b - a, -1)[:, :table[a]]
            norm = np.sqrt((x * x).sum(1))
            near = (x @ x.T) / (norm[:, None] * norm[None, :]) >= threshold
            np.fill_diagonal(near, False)
            if lows[a] != highs[a]:
                near &= block[a:b, None] != block[None, a:b]
            if not near.any():
                continue
            for t in range(own.shape[1]):  # met in an earlier table
                near &= own[:, t, None] != own[None, :, t]
            weight = near @ copies[a:b].astype(np.float64)
            linked = np.flatnonzero(weight)
            i, j = spanning_links(np.zeros(b - a, np.int8), lambda p, q, near=near: near[p, q])
            out.append((node[a + i], node[a + j].astype(object), np.zeros(len(i), np.int64)))
            out.append((node[a + linked], np.full(len(linked), None, object), weight[linked].astype(np.int64)))
        u, v, n = (np.concatenate(c) for c in zip(*out, strict=True))
        return pd.DataFrame({"u": u, "v": pd.array(v, dtype="Int64"), "n": n})

    return compare


def embedding_dedup(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    threshold: float = THRESHOLD, target_recall: float = TARGET_RECALL, block: int = BLOCK) -> DataFrame:
    """``(id, n_links, component_id, kept)`` per row."""
    v = F.col(vector_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.col(label_col).isNotNull() & v.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0)
    own = rows.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"),
                      F.when(usable, v.cast("array<double>")).alias("embedding"))
    # + 0.0 makes the two zeros one value before they are hashed
    own = own.withColumn("node", F.when(F.col("embedding").isNotNull(), F.xxhash64(
        F.col("label").cast("string"), F.transform("embedding", lambda x: x + F.lit(0.0)))))
    classes, _ = write_table(own.where("node is not null").groupBy("node").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"),
        F.first("embedding").alias("embedding")), "embedding_classes")
    bits, tables = plan_tables(classes.count(), threshold, target_recall)
    hashed, _ = write_table(_hashed(classes, bits, tables), "embedding_hashes")
    dealt, _ = write_table(_dealt(_buckets(hashed, tables), block), "embedding_buckets")
    tasks = max(1, dealt.count() // TASK_ROWS)
    dealt = dealt.withColumn("task", F.when(F.col("blocks") > 1, F.xxhash64("bucket", "low", "high"))
                             .otherwise(F.pmod(F.col("bucket"), F.lit(tasks))))
    met = dealt.select("node", "t", "bucket", "block", "low", "high", "task").join(
        hashed.select("node", "copies", "vector", "hashes"), "node")
    found, _ = write_table(met.groupBy("task").applyInPandas(_compare(threshold), "u long, v long, n long"), "embedding_found")
    done = label_rows(own, classes, found)
    return done.select(F.col("id").alias(id_col), "n_links", F.col("class_id").alias("component_id"),
                       (F.col("id") == F.col("class_id")).alias("kept"))
