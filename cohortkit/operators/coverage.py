"""Coverage (kinds per tag) per entity and per group, best entity, sort key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.functions.columns import array_size, safe_ratio
from cohortkit.session import scratch_path
from cohortkit.sources.files import materialize


def with_coverage(df: DataFrame, num_col: str = "kinds", den_col: str = "tags",
                  out: str = "coverage") -> DataFrame:
    """``size(num) / size(den)`` per row (H2/H3).

    Direction as in the original code (kinds over tags).  A zero or NULL
    divisor gives NULL instead of an error; ``avg`` then skips the row.
    """
    n_num = array_size(num_col)
    n_den = array_size(den_col)
    return (
        df.withColumn(f"n_{num_col}", n_num)
        .withColumn(f"n_{den_col}", n_den)
        .withColumn(out, safe_ratio(n_num, n_den))
    )


def group_coverage(df: DataFrame, group_col: str, num_col: str = "kinds",
                   den_col: str = "tags", out: str = "avg_coverage") -> DataFrame:
    """Mean coverage per group."""
    cov = with_coverage(df, num_col, den_col)
    return cov.groupBy(group_col).agg(F.avg("coverage").alias(out))


def best_coverage(df: DataFrame, group_col: str, key_col: str = "id", name_col: str = "name",
                  num_col: str = "kinds", den_col: str = "tags") -> DataFrame:
    """Entity with the highest coverage per group; ties to the lowest key (L2).

    All rows pass one hash aggregate, the lowest key per ``(group, coverage)``,
    combined on the map side; what it leaves is one row per distinct ratio of a
    group, from which the best is taken.  The name is fetched by key, one row
    per group.
    """
    cov = with_coverage(df, num_col, den_col).where(F.col("coverage").isNotNull())
    per_ratio = cov.groupBy(group_col, "coverage").agg(F.min(key_col).alias(key_col))
    best = per_ratio.groupBy(group_col).agg(F.max_by(key_col, "coverage").alias(key_col), F.max("coverage").alias("coverage"))
    names = df.select(group_col, key_col, name_col).join(best, [group_col, key_col])
    return names.groupBy(group_col, key_col, "coverage").agg(F.min(name_col).alias(name_col)).select(
        group_col, key_col, name_col, "coverage")


def entity_sort_key(df: DataFrame, num_col: str = "measures", den_col: str = "tags",
                    out: str = "sort_key", by_key: bool = True) -> DataFrame:
    """Derived sort key ``size(num)/size(den)``.

    ``by_key=True`` orders by (id, name), which is what the original entity
    ordering does; ``by_key=False`` orders by the derived key, as its
    docstring describes.
    """
    keyed = df.withColumn(out, safe_ratio(array_size(num_col), array_size(den_col)))
    return keyed.orderBy("id", "name") if by_key else keyed.orderBy(F.col(out).asc_nulls_last(), "id")


def with_rank(ordered: DataFrame, out: str = "rank") -> DataFrame:
    """Number the rows of a sorted DataFrame from 1 on, in its order: partition
    by partition, with the sizes of the earlier partitions added (one number
    per partition; no task sees all rows)."""
    marked = ordered.withColumn("__at", F.monotonically_increasing_id())
    marked = marked.withColumn("__part", F.shiftright("__at", 33)).withColumn("__at", F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)))
    marked = materialize(marked, scratch_path(ordered.sparkSession, "ranked"))
    sizes = marked.groupBy("__part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start"))
    return marked.join(F.broadcast(starts), "__part").withColumn(out, F.col("__start") + F.col("__at") + 1).drop(
        "__part", "__at", "__start")
