"""Projections, explode, the entity-to-group joins and the base table.

Group tables (cohort, chain) hold lists of entity names.  A group may be
split over several rows (bounded chunks, see :func:`collect_chunked`); every
operator here explodes first, so chunking does not change any result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project_alias(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Select and rename in one projection (B1)."""
    return df.select([F.col(src).alias(dst) for src, dst in names.items()])


def project_drop(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop columns."""
    return df.drop(*cols)


def explode_members(groups: DataFrame, group_col: str, members_col: str = "members",
                    out_group: str | None = None, out_member: str = "member") -> DataFrame:
    """One row per (group, member).

    Inner ``explode``: NULL and empty member lists produce no row.
    """
    return groups.select(
        F.col(group_col).alias(out_group or group_col),
        F.explode(members_col).alias(out_member),
    )


def join_inner(entities: DataFrame, members: DataFrame, group_col: str,
               name_col: str = "name", member_col: str = "member") -> DataFrame:
    """Entities that are members of a group, with the group key.

    An entity in two groups yields two rows.  Spark picks broadcast or
    sort-merge at run time (AQE); no hint is forced because both sides
    grow with the data.
    """
    m = members.select(F.col(member_col).alias("__member"), F.col(group_col))
    return (
        entities.join(m, entities[name_col] == m["__member"], "inner")
        .drop("__member")
    )


def join_left(entities: DataFrame, members: DataFrame, group_col: str,
              name_col: str = "name", member_col: str = "member") -> DataFrame:
    """As :func:`join_inner` but keeps entities with no group (NULL key)."""
    m = members.select(F.col(member_col).alias("__member"), F.col(group_col))
    return (
        entities.join(m, entities[name_col] == m["__member"], "left")
        .drop("__member")
    )


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a NULL in any (or the given) column.

    Only top-level NULLs count: an array that *contains* NULL stays.
    """
    return df.dropna(how="any", subset=list(subset) if subset else None)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row distinct, array columns included."""
    return df.dropDuplicates()


def base_join(entity: DataFrame, cohort: DataFrame, chain: DataFrame,
              cohort_col: str = "cohort_id", chain_col: str = "chain_id", tasks: int | None = None) -> DataFrame:
    """The joined base table (C3 = C1 + C2 + B11 + D7).

    Entities join their cohort (inner) and chain (left); rows with any NULL
    are removed and the result has no duplicate rows.  Output: the entity
    columns plus ``cohort_col`` and ``chain_col``.
    """
    return base_join_members(entity, explode_members(cohort, cohort_col),
                             explode_members(chain, chain_col), cohort_col, chain_col, tasks)


def base_join_members(entity: DataFrame, cohort_members: DataFrame, chain_members: DataFrame,
                      cohort_col: str = "cohort_id", chain_col: str = "chain_id", tasks: int | None = None) -> DataFrame:
    """:func:`base_join` on group memberships already in long form
    ``(group key, member)``.

    The null cut (B11) comes first: it drops incomplete entities before they
    are shuffled, and, as a row without a chain goes anyway, makes the left
    join an inner one.  The whole-row distinct (D7) is applied to the inputs:
    joining duplicate-free inputs on the member name cannot create duplicates.

    With ``tasks`` the members are dealt over so many tasks by name, once for
    the distinct and the join; entities dealt by name over as many (a caller
    knows how many rows there are) are then joined where they are.
    """
    def distinct_members(members: DataFrame, group_col: str) -> DataFrame:
        rows = drop_incomplete(members.select("member", group_col))
        return distinct_rows(rows.repartition(tasks, "member") if tasks else rows)

    members_a = distinct_members(cohort_members, cohort_col)
    members_b = distinct_members(chain_members, chain_col)
    whole = distinct_rows(drop_incomplete(entity))
    return join_inner(join_inner(whole, members_a, cohort_col), members_b, chain_col)


def reattach(base: DataFrame, agg: DataFrame, on: str) -> DataFrame:
    """Attach a per-key aggregate back to its base rows."""
    return base.join(agg, on, "inner")


def collect_chunked(df: DataFrame, keys: Sequence[str], value: Column | str, out: str,
                    max_items: int = 10_000, tasks: int | None = None) -> DataFrame:
    """Collect ``value`` per key into lists of about ``max_items`` values.

    A key with ``n`` values becomes ``ceil(n / max_items)`` rows, so no single
    list (or task) has to hold a whole hot group.  The chunk count comes from a
    partial-aggregated count; values are spread over the chunks by hash, so
    chunk sizes are ``max_items`` on average (copies of one value share a
    chunk).  With ``tasks`` the chunks are dealt over so many tasks.
    """
    value = F.col(value) if isinstance(value, str) else value
    keys = list(keys)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    chunks = F.greatest(F.lit(1), F.ceil(F.col("__n") / F.lit(max_items)))
    tagged = (
        df.select(*keys, value.alias("__v"))
        .join(counts, keys)
        .withColumn("__chunk", F.pmod(F.xxhash64("__v"), chunks))
    )
    if tasks:
        tagged = tagged.repartition(tasks, *keys, "__chunk")
    return (
        tagged.groupBy(*keys, "__chunk")
        .agg(F.collect_list("__v").alias(out))
        .drop("__chunk")
    )
