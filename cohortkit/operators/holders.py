"""A compressed index of the holders of each tag.

Entities are numbered densely, and the numbers are cut into buckets of 32,768,
Spark's bitmap width.  Per tag, flag and bucket the index holds the set of
numbers: as a bitmap (4 KB, ``bitmap_construct_agg``) from ``DENSE`` holders on,
as a list of positions below, which is the smaller form of the two on either
side.  Set sizes and "held both ways" are counts of bits and list lengths; the
holders come back by expanding the index.  A tag that a third of all entities
hold is many rows: no group is larger than a bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.operators.coverage import with_rank

WIDTH = 32_768  # bits of Spark's bitmaps
DENSE = 1024  # positions of 4 bytes that take the room of one bitmap


def number_entities(long: DataFrame, name_col: str = "name") -> DataFrame:
    """``(name, number)``: every distinct name with a number from 1 on, without
    gaps (a distributed rank; no task sees all names)."""
    return with_rank(long.select(F.col(name_col).alias("name")).where("name is not null").distinct().orderBy("name"), "number")


def holder_index(long: DataFrame, numbers: DataFrame, tag_col: str = "tag", name_col: str = "name", flag_col: str = "hidden",
                 dense: int = DENSE) -> DataFrame:
    """``(tag, hidden, bucket, bits, positions)``, one of ``bits`` and
    ``positions`` per row.  Rows without a flag count on neither side."""
    rows = long.where(F.col(flag_col).isNotNull()).select(F.col(tag_col).alias("tag"), F.col(flag_col).alias("hidden"), F.col(name_col).alias("name"))
    held = rows.distinct().join(numbers, "name").select(
        "tag", "hidden", F.expr("bitmap_bucket_number(number)").alias("bucket"), F.expr("cast(bitmap_bit_position(number) as int)").alias("at"))
    keys = ["tag", "hidden", "bucket"]
    many = held.groupBy(*keys).agg((F.count(F.lit(1)) >= dense).alias("many")).select(*[F.col(k).alias(f"__{k}") for k in keys], "many")
    marked = held.join(many, [F.equal_null(F.col(k), F.col(f"__{k}")) for k in keys]).select(*keys, "at", "many")
    bits = marked.where("many").groupBy(*keys).agg(F.expr("bitmap_construct_agg(at)").alias("bits"))
    positions = marked.where("not many").groupBy(*keys).agg(F.array_sort(F.collect_list("at")).alias("positions"))
    return bits.select(*keys, "bits", F.lit(None).cast("array<int>").alias("positions")).unionByName(
        positions.select(*keys, F.lit(None).cast("binary").alias("bits"), "positions"))


def holder_counts(index: DataFrame) -> DataFrame:
    """``(tag, n_set, n_unset, both_ways)`` from bit counts and list lengths."""
    n = F.coalesce(F.expr("bitmap_count(bits)"), F.size("positions").cast("bigint"))
    side = lambda flag: F.coalesce(F.sum(F.when(F.col("hidden") == F.lit(flag), n)), F.lit(0))
    counts = index.groupBy("tag").agg(side(True).alias("n_set"), side(False).alias("n_unset"))
    return counts.withColumn("both_ways", (F.col("n_set") > 0) & (F.col("n_unset") > 0))


def expand_holders(index: DataFrame, numbers: DataFrame, both_ways: bool = False) -> DataFrame:
    """``(tag, hidden, name)``: the holders that the index stands for, of every
    tag or of those held both ways."""
    if both_ways:
        kept = holder_counts(index).where("both_ways").select("tag", F.xxhash64("tag").alias("__key"))
        # a second key lets Spark split a hot tag's rows (see tags.tag_split)
        index = index.withColumn("__key", F.xxhash64("tag")).join(kept, ["tag", "__key"], "left_semi").drop("__key")
    byte = lambda i: F.conv(F.hex(F.substr("bits", i + 1, F.lit(1))), 16, 10).cast("int")
    used = F.filter(F.sequence(F.lit(0), F.lit(WIDTH // 8 - 1)), lambda i: byte(i) > 0)
    octets = index.where("bits is not null").select("tag", "hidden", "bucket", "bits", F.explode(used).alias("octet"))
    octets = octets.select("tag", "hidden", "bucket", "octet", byte(F.col("octet")).alias("value"))
    ones = F.filter(F.sequence(F.lit(0), F.lit(7)), lambda j: F.expr("value").bitwiseAND(F.call_function("shiftleft", F.lit(1), j)) != 0)
    dense = octets.select("tag", "hidden", "bucket", "octet", F.explode(ones).alias("one")).select(
        "tag", "hidden", "bucket", (F.col("octet") * 8 + F.col("one")).alias("at"))
    sparse = index.where("positions is not null").select("tag", "hidden", "bucket", F.explode("positions").alias("at"))
    number = (F.col("bucket") - 1) * WIDTH + F.col("at") + 1
    return dense.unionByName(sparse).select("tag", "hidden", number.alias("number")).join(numbers, "number").select("tag", "hidden", "name")
