"""N-gram Jaccard self-join of whole texts by chosen paths.

Texts become sets of hashed runs of five words.  Each set is embedded as
``COORDINATES`` min-hash tokens, of which two sets share a fraction equal to
their Jaccard similarity.  A chosen-path tree splits the sets recursively on
sampled tokens: sets with the same token at a sampled coordinate go down the
same path.  A bucket of at most ``small`` sets is brute-forced; a larger one is
split on further sampled tokens, or, once its average similarity (measured by
how little the split divides it) is high, taken as one group.  Splits branch
often enough that a similar pair survives any depth with a fixed chance, and whole runs
are repeated until the bound on the chance of missing a pair meets the target
recall (:func:`runs_for`).  All runs of a level are one Spark job.

The tree yields candidate groups (spanning links of what shares a bucket and
has similar sketches).  Within a group every pair is compared exactly on the
full sets, in blocks of bounded size, so the links and their numbers are exact
for every pair that the tree brings together.  Equal texts are one set with a
weight; no pair rows are written, only counts and spanning links.

Defined results: a text of fewer than five words, but not none, is one shingle
of all its words; null texts and texts without words link with nothing; rows
that repeat an id each get a row; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.components import connected_components
from cohortkit.llm.links import label_rows, spanning_links
from cohortkit.llm.tables import split_join, write_seen, write_table
from cohortkit.llm.text import mix, shingle_hashes, small_slices, words_of

SHINGLE = 5
THRESHOLD = 0.8
TARGET_RECALL = 0.999999
COORDINATES = 128  # the first half is split on, low bytes of the second half are the sketch
SMALL = 200
DENSE = 0.5  # average similarity from which a large bucket is one group
LEVELS = 40  # deeper buckets are taken as one group as well, which only costs comparisons
BLOCK_SETS = 256
BLOCK_TOKENS = 2_000_000
TASK_ROWS = 2_000
TASK_TOKENS = 250_000

_RNG = np.random.default_rng(97)
_FACTOR = _RNG.integers(0, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_HALF = COORDINATES // 2
_RUN_ORDER = _RNG.permutation(_HALF)


def branches_for(threshold: float) -> int:
    """Tokens sampled per split: enough that a pair at the threshold shares
    1.6 branches on average, so that its tree does not die out."""
    return math.ceil(1.6 / threshold)


def runs_for(threshold: float, target: float) -> int:
    """Runs after which a pair at the threshold has shared a final bucket with
    a chance of ``target``.  A pair follows a branch with chance ``threshold``;
    ``lost`` is the chance that an endless tree loses it (the fixed point of
    the branching process), so every depth loses it less often."""
    lost, branch = 0.0, branches_for(threshold)
    for _ in range(1000):
        lost = (1 - threshold + threshold * lost) ** branch
    runs = math.ceil(math.log(1 - target) / math.log(1 - threshold * (1 - lost)))
    if runs > _HALF:
        raise ValueError(f"threshold {threshold} needs {runs} runs for a recall of {target}; {_HALF} are there")
    return runs


def _signatures(shingles: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """``COORDINATES`` min-hashes (upper 32 bits) of every non-empty set."""
    out = np.empty((len(offsets) - 1, COORDINATES), np.uint32)
    for c in range(COORDINATES):
        out[:, c] = np.minimum.reduceat(shingles * _FACTOR[c], offsets[:-1]) >> np.uint64(32)
    return out


def _shingles(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes, offsets, and the 64-bit class of each text's shingles."""
    words = words_of(batch.column("text"))
    shingles, offsets = shingle_hashes(words.hashes(), words.first, size)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(shingles ^ np.uint64(0xA0761D6478BD642F)))])
    node = mix(total[offsets[1:]] - total[offsets[:-1]] + np.diff(offsets).astype(np.uint64)).view(np.int64)
    return shingles, offsets, node


def profile(rows: DataFrame, size: int) -> DataFrame:
    """``(id, side, digest, node, signature)`` per row; ``node`` names the text's
    shingles and is null where there are none."""
    kind = rows.schema["id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches, "text", 1 << 20):
            shingles, offsets, node = _shingles(batch, size)
            full = np.diff(offsets) > 0
            sig = iter(_signatures(shingles, np.unique(offsets))) if full.any() else iter(())
            raw = [next(sig).tobytes() if f else None for f in full]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("id", "side", "digest")],
                                              pa.array(node, mask=~full), pa.array(raw, pa.binary())],
                                             ["id", "side", "digest", "node", "signature"])

    return rows.mapInArrow(read, f"id {kind}, side long, digest long, node long, signature binary")


def _first_paths(classes: DataFrame, runs: int) -> DataFrame:
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32).reshape(-1, COORDINATES)
            node = batch.column("node").to_numpy(zero_copy_only=False)
            path = [mix(mix(np.full(len(node), r + 1, np.uint64)) ^ sig[:, _RUN_ORDER[r]].astype(np.uint64)) for r in range(runs)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(path).view(np.int64)), pa.array(np.tile(node, runs))],
                                             ["path", "node"])

    return classes.select("node", "signature").mapInArrow(split, "path long, node long")


def _next_paths(bucket: DataFrame, branch: int) -> DataFrame:
    """Children of large buckets: ``branch`` coordinates are drawn by the path."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32).reshape(-1, COORDINATES)
            parent = batch.column("path").to_numpy(zero_copy_only=False)
            rows, out = np.arange(len(parent)), []
            for b in range(branch):
                drawn = mix(parent.view(np.uint64) + np.uint64(b + 1))
                at = (drawn % np.uint64(_HALF)).astype(np.int64)
                out.append(mix(drawn ^ mix(sig[rows, at].astype(np.uint64))).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(parent, branch)), pa.array(np.concatenate(out)),
                 *[pa.array(np.tile(batch.column(c).to_numpy(zero_copy_only=False), branch)) for c in ("node", "m")]],
                ["parent", "path", "node", "m"])

    return bucket.select("path", "node", "m", "signature").mapInArrow(split, "parent long, path long, node long, m long")


def _sized(rows: DataFrame) -> DataFrame:
    """Rows of paths that more than one set follows, with their number."""
    counts = rows.groupBy("path").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return split_join(rows, counts, "path")


def _bucket_links(rows: DataFrame, n_rows: int, least_equal: int) -> DataFrame:
    """Spanning links of sets with similar sketches within small buckets; each
    group of the job holds about ``TASK_ROWS`` rows of many buckets."""
    def link(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["path", "node"])
        path, node = group["path"].to_numpy(), group["node"].to_numpy()
        sketch = np.frombuffer(b"".join(group["sketch"]), np.uint8).reshape(-1, _HALF)
        found = [(np.zeros(0, np.int64),) * 2]
        edge = np.flatnonzero(np.diff(path)) + 1
        starts = np.concatenate([[0], edge])
        for at in range(0, len(starts), 256):  # some buckets at a time: labels stay short
            lo = starts[at]
            hi = starts[at + 256] if at + 256 < len(starts) else len(path)
            part = sketch[lo:hi]
            i, j = spanning_links(path[lo:hi], lambda a, b, part=part: (part[a] == part[b]).sum(1) >= least_equal)
            found.append((node[lo + i], node[lo + j]))
        return pd.DataFrame({"u": np.concatenate([a for a, _ in found]), "v": np.concatenate([b for _, b in found])})

    tasks = max(1, n_rows // TASK_ROWS)
    return (rows.withColumn("task", F.pmod(F.xxhash64("path"), F.lit(tasks)))
            .groupBy("task").applyInPandas(link, "u long, v long"))


def candidate_groups(classes: DataFrame, threshold: float, target: float, small: int = SMALL,
                     dense: float = DENSE) -> DataFrame:
    """``(node, component)``: groups such that every pair at the threshold is
    in one group, up to the target recall."""
    sketches = classes.select("node", F.substring("signature", 4 * _HALF + 1, 4 * _HALF).alias("tail"))

    def low_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tail = np.frombuffer(b"".join(batch.column("tail").to_pylist()), np.uint8).reshape(-1, 4 * _HALF)[:, ::4]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([r.tobytes() for r in tail], pa.binary())],
                                             ["node", "sketch"])

    sketches, _ = write_table(sketches.mapInArrow(low_bytes, "node long, sketch binary"), "ngram_sketch")
    # five deviations of the binomial below the threshold: a sketch alone drops one such pair in some 10^6
    least_equal = math.floor(_HALF * threshold - 5 * math.sqrt(_HALF * threshold * (1 - threshold)))
    links, branch = [], branches_for(threshold)
    rows = _sized(_first_paths(classes, runs_for(threshold, target)))
    for level in range(LEVELS + 1):
        rows, _, seen = write_seen(rows.select("path", "node", F.col("size").alias("m")), "ngram_level",
                                   small=F.count(F.when(F.col("m") <= small, 1)), large=F.count(F.when(F.col("m") > small, 1)))
        n_small, n_large = seen["small"], seen["large"]
        if n_small:
            found = _bucket_links(rows.where(F.col("m") <= small).join(sketches, "node"), n_small, least_equal)
            links.append(write_table(found, "ngram_links")[0])
        if not n_large:
            break
        large = rows.where(F.col("m") > small)
        if level < LEVELS:
            split, _ = write_table(_next_paths(large.join(classes.select("node", "signature"), "node"), branch), "ngram_split")
            counts, _ = write_table(split.groupBy("parent", "path").agg(
                F.count(F.lit(1)).alias("size"), F.max("m").alias("m")), "ngram_counts")
            # pairs that stay together, against all pairs: the average similarity of the bucket
            whole = (counts.groupBy("parent").agg(
                        (F.sum(F.col("size").cast("double") ** 2) / branch / F.max("m").cast("double") ** 2).alias("alike"))
                     .where(F.col("alike") >= dense).select("parent"))
            one = large.join(whole.withColumnRenamed("parent", "path"), "path", "left_semi")
        else:
            one = large
        hubs = one.groupBy("path").agg(F.min("node").alias("v"))
        stars = split_join(one, hubs, "path").where("node > v").select(F.col("node").alias("u"), "v").distinct()
        links.append(write_table(stars, "ngram_links")[0])
        if level == LEVELS:
            break
        live = counts.where("size > 1").join(whole, "parent", "left_anti").select("path", "size")
        rows = split.select("path", "node").join(live, "path")
    edges = classes.select(F.col("node").alias("u"), F.col("node").alias("v")).limit(0)
    for found in links:
        edges = edges.unionByName(found)
    return connected_components(edges)


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of the sizes of all intersections, over some columns at a time."""
    n = len(sets)
    if n == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), both], [both, len(sets[1])]], np.float64)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = times[column] > 1
    order = np.argsort(column[keep], kind="stable")
    row, column = row[keep][order], column[keep][order]
    _, column = np.unique(column, return_inverse=True)
    out, step = np.zeros((n, n)), 1 << 13
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        a, b = np.searchsorted(column, [at, at + step])
        part = np.zeros((n, int(column[b - 1]) - at + 1), np.float32)
        part[row[a:b], column[a:b] - at] = 1
        out += part @ part.T
    return out


def exact_links(classes: DataFrame, groups: DataFrame, rows: DataFrame, size: int, threshold: float) -> DataFrame:
    """``(u, v, n)`` from comparing all pairs of each group on their full sets:
    spanning links (``v`` given) and the weight of a set's partners (``v`` null)."""
    sizes = groups.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    members, _ = write_table(split_join(groups, sizes, "component").where("members > 1")
                             .join(classes.select("node", "id", "side", "copies"), "node"), "ngram_members")
    kind = rows.schema["id"].dataType.simpleString()

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches, "text"):
            shingles, offsets, node = _shingles(batch, size)
            own = [np.unique(shingles[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(node), batch.column("component"), batch.column("copies"), batch.column("members"),
                 pa.array([len(s) for s in own], pa.int64()), pa.array([s.tobytes() for s in own], pa.binary())],
                ["node", "found", "component", "copies", "members", "weight", "tokens"])

    # texts are shuffled at every size: a small list would be broadcast, a plan that does not last as tables grow
    members = members.withColumnsRenamed({"id": "rep", "side": "rep_side"})
    texts = rows.hint("merge").join(members, F.col("id").eqNullSafe(F.col("rep")) & F.col("side").eqNullSafe(F.col("rep_side")))
    full = (texts.select("text", "node", "component", "copies", "members")
            .mapInArrow(sets, "node long, found long, component long, copies long, members long, weight long, tokens binary")
            .where("node = found").drop("found").dropDuplicates(["node"]))  # an id may stand on several rows
    full, _ = write_table(full, "ngram_sets")
    heavy = full.groupBy("component").agg(F.sum("weight").alias("total"), F.max("members").alias("k"))
    blocks = heavy.select("component", F.ceil(F.greatest(F.col("k") / BLOCK_SETS, F.col("total") / BLOCK_TOKENS)).cast("int").alias("blocks"), "total")
    n_tokens = heavy.agg(F.sum("total")).first()[0] or 0
    tasks = max(1, n_tokens // TASK_TOKENS)
    dealt = split_join(full.drop("members"), blocks, "component")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks")).cast("int"))
    # a row of block b meets every block j in the task of (min, max); small groups share tasks
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("node", "component", "copies", "tokens", "block",
                         F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                         F.when(F.col("blocks") > 1, F.xxhash64("component", F.least("block", "other"), F.greatest("block", "other")))
                         .otherwise(F.pmod(F.xxhash64("component"), F.lit(tasks))).alias("task"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        u, v, n = [], [], []
        for (_, low, high), own in group.groupby(["component", "low", "high"], sort=True):
            own = own.sort_values("node")
            tokens = [np.frombuffer(t, np.uint64) for t in own["tokens"]]
            lens = np.array([len(t) for t in tokens], np.float64)
            node, copies, block = (own[c].to_numpy() for c in ("node", "copies", "block"))
            both = shared_counts(tokens) if len(tokens) > 1 else np.zeros((1, 1))
            near = both >= threshold * (lens[:, None] + lens[None, :] - both) - 1e-9
            np.fill_diagonal(near, False)
            if low != high:
                near &= block[:, None] != block[None, :]
            partners = near @ copies.astype(np.float64)
            i, j = spanning_links(np.zeros(len(node), np.int8), lambda a, b, near=near: near[a, b])
            linked = np.flatnonzero(partners)
            u += [node[i], node[linked]]
            v += [node[j].astype(object), np.full(len(linked), None, object)]
            n += [np.zeros(len(i), np.int64), partners[linked].astype(np.int64)]
        return pd.DataFrame({"u": np.concatenate(u), "v": pd.array(np.concatenate(v), dtype="Int64"), "n": np.concatenate(n)})

    return dealt.groupBy("task").applyInPandas(compare, "u long, v long, n long")


def linked_classes(docs: DataFrame, id_col: str, text_col: str, size: int, threshold: float, target_recall: float,
                   small: int, dense: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``own``: the profile of every row; ``classes``: equal shingle sets as one,
    with their first row ``rep`` (by id, rows without id last, then by text);
    ``found``: links and partner counts of classes."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("digest", F.xxhash64("text"))
    # rows without an id are told apart by their text
    rows = rows.withColumn("side", F.when(F.col("id").isNull(), F.col("digest")))
    own, _ = write_table(profile(rows, size), "ngram_profile")
    rep = F.struct(F.col("id").isNull().alias("bare"), "id", "digest")
    classes, _ = write_table(own.where("node is not null").groupBy("node").agg(
        F.min("id").alias("id"), F.when(F.min("id").isNull(), F.min("side")).alias("side"), F.min(rep).alias("rep"),
        F.count(F.lit(1)).alias("copies"), F.first("signature").alias("signature")), "ngram_classes")
    groups, _ = write_table(candidate_groups(classes, threshold, target_recall, small, dense), "ngram_groups")
    found, _ = write_table(exact_links(classes, groups, rows.drop("digest"), size, threshold), "ngram_found")
    return own, classes, found


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
               threshold: float = THRESHOLD, target_recall: float = TARGET_RECALL, small: int = SMALL,
               dense: float = DENSE) -> DataFrame:
    """``(id, class_id, n_links)`` per row: the smallest id that links of
    Jaccard similarity ``threshold`` or more reach, and the number of other
    rows linked directly."""
    done = label_rows(*linked_classes(docs, id_col, text_col, size, threshold, target_recall, small, dense))
    return done.select(F.col("id").alias(id_col), "class_id", "n_links")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
             threshold: float = THRESHOLD, target_recall: float = TARGET_RECALL, small: int = SMALL,
             dense: float = DENSE) -> DataFrame:
    """The documents without all but the first of every linked group, same
    columns: the one of smallest id, rows without id last; rows that share an id,
    or have none, are told apart by a digest of their text.  Rows without words
    link with nothing and stay; of rows repeated in id and text one stays."""
    own, classes, found = linked_classes(docs, id_col, text_col, size, threshold, target_recall, small, dense)
    joined = connected_components(found.where("v is not null").select("u", "v"))
    first = (classes.select("node", "rep").join(joined, "node", "left")
             .groupBy(F.coalesce("component", "node").alias("component")).agg(F.min("rep").alias("rep")))
    wordless = own.where("node is null").select("id", "digest").distinct()
    kept, _ = write_table(first.select("rep.id", "rep.digest").unionByName(wordless)
                          .select(F.col("id").alias("__kept"), F.col("digest").alias("__digest")), "ngram_kept")
    named = docs.join(kept, F.col(id_col).eqNullSafe(F.col("__kept")) & (F.xxhash64(text_col) == F.col("__digest")), "left_semi")
    return named.dropDuplicates([id_col, text_col])
