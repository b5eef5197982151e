"""Semi-join reduction by a Bloom filter.

The base join shuffles whole entities, nested columns included, to meet the
members of a group.  Where most names have no group, nearly all of that is for
nothing.  A Bloom filter over the member names is small enough to send to
every executor, and entities that it rules out are dropped at their scan,
before anything is shuffled.  It never rules out a member, and the join behind
it removes the few names that pass wrongly, so the rows are those of the join.

The filter is blocked (Putze, Sanders, Singler 2007): a name's hash chooses one
block of 16,384 bits, and all bits of the name lie in it, so a lookup is one
hash-join probe and a few bit tests, all in generated code.  Blocks are built
by ``bit_or`` per word, which Spark combines before its shuffle.

Bound: ``max_bytes`` of bits (a row of the filter is one block of 2 KiB).  The
size comes from the number of names; if fewer than ``LEAST_BITS`` bits a name
fit, too many names would pass wrongly and the entities are returned whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortkit.operators.base import base_join_members
from cohortkit.session import scratch_path
from cohortkit.sources.files import materialize

BLOCK_BITS = 14  # a block has 2 ** 14 bits: 256 words of 64
PROBES = 4  # bits per name, 14 of one 64-bit hash each
BITS_PER_NAME = 12  # about 0.7 % of other names pass
LEAST_BITS = 4  # about 16 % pass; with fewer the filter does not pay
MAX_BYTES = 32 << 20


def _block(name: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(n_blocks))


def _bit(name: Column, probe: int) -> Column:
    """Position in the block of the ``probe``-th bit of a name."""
    return F.shiftrightunsigned(F.xxhash64(name, F.lit("bits")), BLOCK_BITS * probe).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))


def name_filter(names: DataFrame, name_col: str, max_bytes: int = MAX_BYTES) -> tuple[DataFrame, int] | None:
    """``(block, words)`` rows of a filter over a column and their number, or None
    if ``max_bytes`` hold fewer than ``LEAST_BITS`` bits a name.  NULL names are
    left out; repeated names cost nothing.  Without names the filter lets nothing
    pass.  The filter is written below ``spark.checkpoint.dir``."""
    own = names.select(F.col(name_col).alias("name")).where(F.col("name").isNotNull())
    n_names = own.agg(F.approx_count_distinct("name")).first()[0]
    most = max(1, (max_bytes * 8) >> BLOCK_BITS)
    n_blocks = min(most, max(1, -(-n_names * BITS_PER_NAME >> BLOCK_BITS)))
    if n_names * LEAST_BITS > n_blocks << BLOCK_BITS:
        return None
    bits = own.select(_block(F.col("name"), n_blocks).alias("block"),
                      F.explode(F.array(*[_bit(F.col("name"), p) for p in range(PROBES)])).alias("bit"))
    words = (bits.select("block", F.shiftright("bit", 6).alias("word"), F.expr("shiftleft(1L, cast(bit & 63 as int))").alias("mask"))
             .groupBy("block", "word").agg(F.bit_or("mask").alias("mask")))
    # at most 256 words a block
    held = words.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("word", "mask"))).alias("held"))
    n_words = 1 << (BLOCK_BITS - 6)
    table = held.select("block", F.transform(F.sequence(F.lit(0), F.lit(n_words - 1)),
                                             lambda w: F.coalesce(F.col("held")[w.cast("bigint")], F.lit(0).cast("bigint"))).alias("words"))
    return materialize(table, scratch_path(names.sparkSession, "name_filter")), n_blocks


def reduce_by_filter(rows: DataFrame, row_col: str, built: tuple[DataFrame, int] | None) -> DataFrame:
    """``rows`` without most of those whose ``row_col`` is not in the filter of
    :func:`name_filter`: a superset of the semi join, with all columns and
    repeats.  Rows of a NULL name go.  The filter is broadcast, as its size is
    bounded; without one (None) all rows stay."""
    if built is None:
        return rows
    table, n_blocks = built
    name = F.col(row_col)

    def test(probe: int) -> Column:
        bit = _bit(name, probe)
        word = F.element_at("__words", (F.shiftright(bit, 6) + 1).cast("int"))
        return F.getbit(word, bit.bitwiseAND(F.lit(63)).cast("int")) == 1

    marked = rows.where(name.isNotNull()).withColumn("__block", _block(name, n_blocks))
    met = marked.join(F.broadcast(table.select(F.col("block").alias("__block"), F.col("words").alias("__words"))), "__block")
    return met.where(reduce(lambda x, y: x & y, [test(p) for p in range(PROBES)])).select(*[F.col(c) for c in rows.columns])


def base_join_reduced(entity: DataFrame, cohort_members: DataFrame, chain_members: DataFrame,
                      cohort_col: str = "cohort_id", chain_col: str = "chain_id",
                      max_bytes: int = MAX_BYTES) -> DataFrame:
    """:func:`~cohortkit.operators.base.base_join_members` with entities and chain
    members reduced to the names of the cohort members first.  Same rows; for
    inputs where most names have no cohort.  A row of the base table needs both
    memberships, so either one could serve as the filter: pass the smaller as
    ``cohort_members``."""
    built = name_filter(cohort_members, "member", max_bytes)
    return base_join_members(reduce_by_filter(entity, "name", built), cohort_members,
                             reduce_by_filter(chain_members, "member", built), cohort_col, chain_col)
