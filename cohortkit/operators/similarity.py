"""TF-IDF weights and cosine similarity of tag vectors.

``similar_pairs`` replaces the all-pairs product of the original with an
exact, prefix-filtered sparse self-join:

* Weights are ``tf * ln((m + 1) / (df + 1))`` (the MLlib IDF formula, ``m`` =
  number of base rows).  Weights and cosines are >= 0, so a pair above a
  threshold ``t >= 0`` shares at least one tag with a positive weight.
* Prefix filter (Bayardo, Ma, Srikant, WWW 2007): tags are put in one global
  order, rarest first.  A row's *prefix* is its first tags up to the point
  where the norm of the remaining ones drops below ``t``.  If two rows'
  prefixes are disjoint, every shared tag lies in the remainder of one of
  them, so by Cauchy-Schwarz their cosine is below ``t``.  Joining on prefix
  tags therefore finds every pair above ``t``, while common tags (usually
  outside the prefixes) are never expanded into their full pair lists.
* A prefix tag held by many rows is split into blocks by hash of the row
  key; block pairs ``(lo, hi)`` are separate join keys (block ``lo`` on one
  side, block ``hi`` on the other), so one hot tag is spread over many tasks
  instead of one, and no pair is compared twice.
* Only ids, prefixes and a few numbers go through that join, and a pair is
  emitted only at the first prefix tag the two share (no distinct over
  candidates needed).  This is also the first tag they share at all, so their
  cosine is at most the product of its weights plus what the rest of both can
  give: the product of the norms behind it (the suffix bound of L2AP, Anastasiu
  and Karypis, ICDE 2014), or as many shared tags as bit signatures still allow
  times the largest weights.  A pair whose bound is not above ``t`` is dropped
  there; vectors are attached to the rest only.
* A vector belongs to a name, not to a row: it is made once per name, names
  with equal vectors share one in the join, and rows come in behind it by key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.functions.columns import dense_cosine
from cohortkit.session import scratch_path
from cohortkit.sources.files import materialize

# Relative slack on the prefix bound so rounding can only add prefix tags.
_PREFIX_SLACK = 1e-9
# Slack on the bound of a pair, whose numbers are shuffled as floats.
_BOUND_SLACK = 1e-6
# Names whose vector another name has, up to which they are not worth a copy of
# all other vectors.
_FEW_OTHERS = 500_000


def _name_counts(base: DataFrame, tags_col: str, tag_field: str | None, name_col: str) -> DataFrame:
    """``(__name, tag, tf)``: how often each name has each tag."""
    tags = F.col(tags_col)
    if tag_field:
        tags = tags.getField(tag_field)
    return (base.select(F.col(name_col).alias("__name"), F.explode(tags).alias("tag")).where(F.col("tag").isNotNull())
            .groupBy("__name", "tag").agg(F.count(F.lit(1)).alias("tf")))


def _counts_with_rows(base: DataFrame, tags_col: str, tag_field: str | None, name_col: str) -> DataFrame:
    """``(__name, tag, tf, n_rows)``: how often each name has each tag, and the
    base rows of the name.  Equal tag lists of a name are combined before they
    are shuffled; what is left is dealt by name once, for all three counts, and
    the rows are summed over the lists, before these are spread to tags."""
    tags = F.col(tags_col)
    if tag_field:
        tags = tags.getField(tag_field)
    lists = (base.where(F.col(name_col).isNotNull()).groupBy(F.col(name_col).alias("__name"), tags.alias("__tags"))
             .agg(F.count(F.lit(1)).alias("n")).repartition("__name"))
    counted = (lists.withColumn("n_rows", F.sum("n").over(Window.partitionBy("__name"))).select("__name", "n_rows", "n", F.explode("__tags").alias("tag"))
               .where(F.col("tag").isNotNull()).groupBy("__name", "n_rows", "tag").agg(F.sum("n").alias("tf")))
    return counted.select("__name", "tag", "tf", "n_rows")


def join_own_aggregate(rows: DataFrame, aggregate: DataFrame, key: str) -> DataFrame:
    """Rows joined to an aggregate of theirs by the same key, which may be hot.

    Spark splits skewed partitions only where both sides of a join are plain
    shuffles.  The aggregate is dealt by the key already and would be joined
    in place; a second key, a hash of the first, gives it a (small) shuffle of
    its own."""
    mark = "__own_key"
    return (rows.withColumn(mark, F.xxhash64(key))
            .join(aggregate.withColumn(mark, F.xxhash64(key)), [key, mark]).drop(mark))


def term_frequency(base: DataFrame, key_cols: Sequence[str], tags_col: str = "tags",
                   tag_field: str | None = "tag", extra_cols: Sequence[str] = (),
                   name_col: str = "name") -> DataFrame:
    """Exact term frequency per (row, tag).

    Tags are counted by name and the counts attached to every row of that name,
    as the original does: repeats in a tag list count, an entity in two groups
    counts its list twice, and entities of one name share their tags.
    Counting instead of hashing (``HashingTF``) means no bucket collisions.
    """
    carry = list(dict.fromkeys([*key_cols, *extra_cols]))
    by_name = _name_counts(base, tags_col, tag_field, name_col)
    rows = base.select(*carry, F.col(name_col).alias("__name"))
    return rows.join(by_name, "__name").select(*carry, "tag", "tf")


def row_count(base: DataFrame) -> Column:
    """Number of rows as a scalar subquery (no collect, no cross join)."""
    return base.agg(F.count(F.lit(1))).scalar()


def inverse_document_frequency(tf: DataFrame, n_rows: Column | int) -> DataFrame:
    """``df`` and ``idf = ln((m + 1) / (df + 1))`` per tag.

    ``df`` counts rows holding the tag: rows of ``tf`` (one per (row, tag))
    with a positive count.  Reading ``tf`` here keeps this branch's copy of
    the term-count aggregate identical to the one the weights join reads,
    so Spark shuffles the exploded tags once and reuses the exchange.
    """
    m = n_rows if isinstance(n_rows, Column) else F.lit(n_rows)
    dfreq = tf.groupBy("tag").agg(F.count_if(F.col("tf") > 0).alias("df"))
    return dfreq.select(
        "tag", "df",
        F.ln((m + F.lit(1)).cast("double") / (F.col("df") + F.lit(1)).cast("double")).alias("idf"),
    )


def tfidf_weights(base: DataFrame, key_cols: Sequence[str], tags_col: str = "tags",
                  tag_field: str | None = "tag", extra_cols: Sequence[str] = (),
                  name_col: str = "name") -> DataFrame:
    """(row keys, extra, tag, tf, df, idf, weight) (I3).  A tag that a third of
    all rows hold is split by Spark (:func:`join_own_aggregate`)."""
    tf = term_frequency(base, key_cols, tags_col, tag_field, extra_cols, name_col)
    idf = inverse_document_frequency(tf, row_count(base))
    return join_own_aggregate(tf, idf, "tag").withColumn("weight", F.col("tf") * F.col("idf"))


def _sign(seed: int) -> Column:
    """A word with one bit set, chosen by the tag."""
    return F.expr(f"shiftleft(1L, cast(pmod(xxhash64(tag, {seed}), 64) as int))")


def _unit_vectors(weights: DataFrame, threshold: float) -> DataFrame:
    """Per name, from ``(__name, tag, tf, df, weight)``: ``vid`` (a digest of its
    tags and their counts, so names with equal vectors share it), the unit
    vector as parallel arrays ``vt``, ``vu`` in the global (df, tag) order, with
    ``rest``, the norm behind each tag; the number ``n_pre`` of prefix tags; the
    largest weight, and two bit signatures of the tags with the number of tags
    that they may hide.  One shuffle (by name) and one sort serve it all."""
    positive = weights.where(F.col("weight") > 0).withColumn("w2", F.col("weight") * F.col("weight"))
    name = Window.partitionBy("__name")
    running = name.orderBy("df", "tag").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bound = F.lit(threshold * threshold * (1.0 - _PREFIX_SLACK))
    ranked = (
        positive.withColumn("cum", F.sum("w2").over(running))
        .withColumn("norm2", F.sum("w2").over(name))
        # norm^2 of this tag and every later one (global order) >= t^2 * norm^2
        .withColumn("in_prefix", (F.col("norm2") - F.col("cum") + F.col("w2")) >= bound * F.col("norm2"))
        .withColumn("u", F.col("weight") / F.sqrt("norm2"))
        .withColumn("rest", F.sqrt(F.greatest(F.lit(0.0), F.lit(1.0) - F.col("cum") / F.col("norm2"))))
    )
    agg = ranked.groupBy("__name").agg(
        F.array_sort(F.collect_list(F.struct("df", "tag", "u", "rest", "tf"))).alias("v"),
        F.count_if("in_prefix").cast("int").alias("n_pre"), F.max("u").alias("top"),
        F.bit_or(_sign(1)).alias("sig1"), F.bit_or(_sign(2)).alias("sig2"),
    )
    counts = F.transform("v", lambda e: F.struct(e["tag"].alias("tag"), e["tf"].alias("tf")))
    vid = F.struct(F.xxhash64(counts).alias("a"), F.xxhash64(F.lit(1), counts).alias("b"))
    hidden = lambda sig: (F.size("v") - F.bit_count(sig)).alias(f"hid_{sig}")
    own = F.aggregate(F.col("v.u"), F.lit(0.0), lambda acc, u: acc + u * u)  # the vector's product with itself
    return agg.select("__name", vid.alias("vid"), own.alias("own"), F.col("v.tag").alias("vt"), F.col("v.u").alias("vu"), F.col("v.rest").alias("rest"),
                      "n_pre", "top", "sig1", "sig2", hidden("sig1"), hidden("sig2"))


def _dot(a_t: Column, a_u: Column, b_t: Column, b_u: Column) -> Column:
    """Dot product of two sparse unit vectors (tags unique): the shared tags by
    a hash intersection, then their weights by position.  One form for all
    lengths; sorting the concatenated vectors instead took several times as
    long on candidates that share few tags, which most do."""
    zero = F.lit(0.0).cast("double")
    return F.aggregate(F.array_intersect(a_t, b_t), zero, lambda acc, t: acc
                       + F.element_at(a_u, F.array_position(a_t, t).cast("int"))
                       * F.element_at(b_u, F.array_position(b_t, t).cast("int")))


def _may_exceed(threshold: float) -> Column:
    """Whether the cosine of a pair, met at its first shared tag, can be above
    the threshold (numbers of the two index entries only)."""
    def shared(sig: str) -> Column:
        # equal bits, and tags that share a bit with another of their vector
        return F.bit_count(F.col(f"a_{sig}").bitwiseAND(F.col(f"b_{sig}"))) + F.least(f"a_hid_{sig}", f"b_hid_{sig}")

    both = lambda c: F.col(f"a_{c}").cast("double") * F.col(f"b_{c}").cast("double")
    most = F.least(shared("sig1"), shared("sig2")) - 1
    behind = F.least(both("rest"), most * both("top"))
    return both("u") + behind > F.lit(threshold - _BOUND_SLACK)


def _apart(names: DataFrame, workdir: str) -> DataFrame:
    """One name per distinct vector, the least.  Only ids are shuffled to find
    the others; where they are few Spark takes them off at each read of the
    vectors, else the vectors that stay are written."""
    ids = names.select("vid", "__name")
    least = ids.groupBy("vid").agg(F.min("__name").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    least = materialize(least.select("vid", "least"), f"{workdir}/shared")
    others = materialize(ids.join(least, "vid").where(F.col("__name") != F.col("least")).select("__name"), f"{workdir}/others")
    vectors = names.join(others, "__name", "left_anti")
    return materialize(vectors, f"{workdir}/vectors") if others.count() > _FEW_OTHERS else vectors


def _prefix_candidates(vectors: DataFrame, block_size: int, threshold: float, workdir: str) -> DataFrame:
    """``(a_vid, b_vid)`` of distinct vectors that share a prefix tag and whose
    bound is above the threshold, each pair once.  Only ids, the short prefixes
    and numbers are shuffled, once for both sides of the join; a tag held by more
    than ``block_size`` vectors is dealt in blocks, and each pair of blocks is a
    join key.  Such tags are few (one in ``block_size`` entries at most) and are
    written below ``workdir``."""
    numbers = ["top", "sig1", "sig2", "hid_sig1", "hid_sig2"]
    short = lambda c: F.col(c).cast("float")  # noqa: E731  the bound has slack for it
    spread = F.arrays_zip("pre", F.slice("vu", F.lit(1), F.col("n_pre")).alias("u"), F.slice("rest", F.lit(1), F.col("n_pre")).alias("rest"))
    entries = (vectors.withColumn("pre", F.slice("vt", F.lit(1), F.col("n_pre")))
               .select("vid", "pre", *numbers, F.posexplode(spread).alias("pos", "e"))
               .select("vid", F.slice("pre", F.lit(1), F.col("pos")).alias("before"), short("top").alias("top"), *numbers[1:], F.col("e.pre").alias("tag"),
                       short("e.u").alias("u"), short("e.rest").alias("rest")))
    per_tag = entries.groupBy("tag").agg(F.count(F.lit(1)).alias("n_tag"))
    hot = materialize(per_tag.where(F.col("n_tag") > block_size).select("tag", F.ceil(F.col("n_tag") / F.lit(block_size)).alias("nb")),
                      f"{workdir}/hot_tags")
    cols = ["vid", "before", "tag", "u", "rest", *numbers]

    def side(rows: DataFrame, x: str, *more: str) -> DataFrame:
        return rows.select([F.col(c).alias(f"{x}_{c}") for c in [*cols, *more]])

    # a pair counts at its first shared prefix tag only: the prefix tags before
    # it (global order) have none in common.  The bound holds there, and may
    # only be tested behind this: elsewhere it is no bound, but a pair that
    # fails it elsewhere is not counted there anyway
    first = _may_exceed(threshold) & ~F.arrays_overlap("a_before", "b_before")
    once = F.col("a_vid") < F.col("b_vid")
    same_tag = F.col("a_tag") == F.col("b_tag")
    cold = entries.join(hot, "tag", "left_anti")
    cold_pairs = side(cold, "a").join(side(cold, "b"), same_tag & once & first)
    # block pair (lo, hi), lo <= hi: the left side holds block lo, the right side
    # block hi, so each key joins exactly one block with one block
    keyed = entries.join(hot, "tag").withColumn("blk", F.pmod(F.xxhash64("vid"), F.col("nb")))
    left = (keyed.withColumn("lo", F.col("blk"))
            .withColumn("hi", F.explode(F.sequence(F.col("blk"), F.col("nb") - 1))))
    right = (keyed.withColumn("hi", F.col("blk"))
             .withColumn("lo", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blk")))))
    cond = (
        same_tag
        & (F.col("a_lo") == F.col("b_lo"))
        & (F.col("a_hi") == F.col("b_hi"))
        # two different blocks meet once; inside one block, each pair once
        & ((F.col("a_lo") < F.col("a_hi")) | once)
        & first
    )
    hot_pairs = side(left, "a", "lo", "hi").join(side(right, "b", "lo", "hi"), cond)
    return cold_pairs.select("a_vid", "b_vid").unionByName(hot_pairs.select("a_vid", "b_vid"))


def _scored(pairs: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    """Vectors attached to candidate pairs and scored above the threshold.  The
    score passes through a generator, so that the filter on it stays above and
    the score is computed once."""
    def side(x: str) -> DataFrame:
        return vectors.select(F.col("vid").alias(f"{x}_vid"), F.col("vt").alias(f"{x}_vt"), F.col("vu").alias(f"{x}_vu"))

    full = pairs.join(side("a"), "a_vid").join(side("b"), "b_vid")
    score = _dot(F.col("a_vt"), F.col("a_vu"), F.col("b_vt"), F.col("b_vu"))
    return full.select("a_vid", "b_vid", F.explode(F.array(score)).alias("score")).where(F.col("score") > F.lit(threshold))


def similar_pairs(base: DataFrame, threshold: float = 0.75,
                  key_cols: Sequence[str] = ("id", "cohort_id", "chain_id"),
                  name_col: str = "name", tags_col: str = "tags", tag_field: str | None = "tag",
                  differ_on: Sequence[str] = ("cohort_id", "chain_id"),
                  block_size: int = 1024, both_orders: bool = True,
                  workdir: str | None = None) -> DataFrame:
    """Pairs of rows with TF-IDF cosine ``> threshold`` that differ on every
    column of ``differ_on`` (I4, C7).

    Output ``(name_i, name_j, score)``; with ``both_orders`` each pair appears
    as (i, j) and (j, i), as in the original.  ``!=`` on a NULL key drops the
    pair (the original's ``same == False`` rule).  Rows whose weights are all
    zero have no vector and yield no pair.  ``key_cols`` identify a row;
    ``name_col`` and the ``differ_on`` columns must be determined by them.

    Vectors are made per name, and names with equal ones share one in the join:
    distinct vectors are paired and scored, and the pairs that pass are joined
    to their rows by key.  ``base`` is read several times, so pass a written
    table; counts and vectors are written below ``workdir``
    (default: a fresh folder under ``spark.checkpoint.dir``) when this is called.
    """
    if threshold < 0:
        raise ValueError("threshold must be >= 0 (the sparse join relies on it)")
    if block_size < 1:
        raise ValueError("block_size must be >= 1")
    key_cols = list(key_cols)
    workdir = workdir or scratch_path(base.sparkSession, "similar_pairs")
    carry = list(dict.fromkeys([*key_cols, *differ_on, name_col]))
    tf = materialize(_counts_with_rows(base, tags_col, tag_field, name_col), f"{workdir}/counts")
    idf = tf.groupBy("tag").agg(F.sum("n_rows").alias("df"))  # rows that hold the tag
    weight = F.col("tf") * F.ln((row_count(base) + F.lit(1)).cast("double") / (F.col("df") + F.lit(1)).cast("double"))
    # dealt by name before the weights are made of the counts
    counted = join_own_aggregate(tf.select("__name", "tag", "tf"), idf, "tag").select("__name", "tag", "tf", "df").repartition("__name")
    names = materialize(_unit_vectors(counted.withColumn("weight", weight), threshold), f"{workdir}/names")
    rows = materialize(base.select(*carry, F.col(name_col).alias("__name")).join(names.select("__name", "vid", "own"), "__name").drop("__name"),
                       f"{workdir}/rows")
    vectors = _apart(names, workdir)
    scored = _scored(_prefix_candidates(vectors, block_size, threshold, workdir), vectors, threshold)
    # rows of one vector, if there are any that differ on every column
    apart = [F.min(c).alias(f"least_{c}") for c in differ_on] + [F.max(c).alias(f"most_{c}") for c in differ_on] + [F.count(F.lit(1)).alias("n")]
    some = reduce(lambda x, y: x & y, [F.col(f"least_{c}") < F.col(f"most_{c}") for c in differ_on], F.col("n") > 1)
    selves = rows.groupBy("vid").agg(*apart, F.first("own").alias("score")).where(some & (F.col("score") > F.lit(threshold)))
    selves = materialize(selves.select("vid", "score"), f"{workdir}/selves")

    def members(x: str) -> DataFrame:
        return rows.select(F.col("vid").alias(f"{x}_vid"), *[F.col(c).alias(f"{x}_{c}") for c in carry])

    key = lambda x: F.struct(*[F.col(f"{x}_{k}") for k in key_cols])
    cond = F.lit(True)
    for c in differ_on:
        cond = cond & (F.col(f"a_{c}") != F.col(f"b_{c}"))
    named = (F.col(f"a_{name_col}").alias("name_i"), F.col(f"b_{name_col}").alias("name_j"), "score")
    one = selves.select(F.col("vid").alias("a_vid"), "score").join(members("a"), "a_vid")
    found = scored.join(members("a"), "a_vid").join(members("b"), "b_vid").where(cond).select(*named).unionByName(
        one.join(members("b"), F.col("a_vid") == F.col("b_vid")).where(cond & (key("a") < key("b"))).select(*named))
    if not both_orders:
        return found
    return found.select(
        F.explode(F.array(
            F.struct(F.col("name_i"), F.col("name_j"), F.col("score")),
            F.struct(F.col("name_j").alias("name_i"), F.col("name_i").alias("name_j"), F.col("score")),
        )).alias("p")
    ).select("p.name_i", "p.name_j", "p.score")


def label_centroids(df: DataFrame, label_col: str, vec_col: str) -> DataFrame:
    """Mean vector per label: partial-aggregated per (label, position)."""
    pos = df.select(label_col, F.posexplode(vec_col).alias("pos", "x"))
    means = pos.groupBy(label_col, "pos").agg(F.avg(F.col("x").cast("double")).alias("v"))
    return means.groupBy(label_col).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "v"))), lambda s: s["v"]).alias("centroid")
    )


def cosine_to_centroid(df: DataFrame, id_col: str, label_col: str, vec_col: str,
                       use_udf: bool = False, out: str = "cosine") -> DataFrame:
    """Dense cosine of each vector to the mean vector of its label.

    The centroid table has one bounded row per label.
    """
    cents = label_centroids(df, label_col, vec_col)
    joined = df.select(id_col, label_col, vec_col).join(cents, label_col)
    if use_udf:
        from cohortkit.functions.udfs import cosine_udf

        score = cosine_udf(F.col(vec_col), F.col("centroid"))
    else:
        score = dense_cosine(vec_col, "centroid")
    return joined.select(id_col, label_col, score.alias(out))
