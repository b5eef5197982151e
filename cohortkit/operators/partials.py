"""Mergeable partial states of the group results, kept per landing batch.

A state row holds, per group, what averages, coverage and extremes need:
counts, sums and the holder of the highest and lowest value.  States of
batches are merged by adding and comparing, so a new batch is aggregated alone
and the rows of earlier batches are not read again, except where an entity was
landed anew: its old contribution can be subtracted from a sum but not from an
extreme, so the earlier batches that hold it are redone without it.

Layout below ``root``: ``rows/batch=<n>`` (the rows of a batch as they came),
``keys/batch=<n>`` (every id landed with the batch, also one that gave no rows:
it takes back what it gave before), ``state/batch=<n>``.  Folders of one batch
are replaced as a whole, and a state is a function of rows and keys, so a run
that was cut off is simply repeated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.functions.columns import extreme, row_sum
from cohortkit.session import drop_path

ALL = "all"


def _values(cols: Sequence[str]) -> dict[str, Column]:
    return {ALL: row_sum(cols) / F.lit(len(cols)), **{c: F.col(c) for c in cols}}


def partial_state(rows: DataFrame, by: Sequence[str], cols: Sequence[str], keys: Sequence[str] = ("id", "name"),
                  ratio_col: str = "coverage") -> DataFrame:
    """One state row per group of ``by``, from rows with the measure columns,
    the entity's ``keys`` and a ratio.  One aggregate, combined on the map side."""
    total = row_sum(cols)
    aggs = [F.count(total).alias(f"n_{ALL}"), F.sum(total).alias(f"sum_{ALL}")]
    for c in cols:
        aggs += [F.count(c).alias(f"n_{c}"), F.sum(c).alias(f"sum_{c}")]
    aggs += [F.count(ratio_col).alias("n_ratio"), F.sum(ratio_col).alias("sum_ratio")]
    for label, value in _values(cols).items():
        value, named = value.cast("double"), {k: F.col(k) for k in keys}
        aggs += [extreme(value, named, True).alias(f"max_{label}"), extreme(value, named, False).alias(f"min_{label}")]
    return rows.groupBy(*by).agg(*aggs)


def merge_states(states: DataFrame, by: Sequence[str], keys: Sequence[str] = ("id", "name")) -> DataFrame:
    """States of one group added up; ``by`` may name fewer columns than they
    were made for, or none (the state of everything)."""
    aggs = []
    for c in states.columns:
        if c.startswith(("n_", "sum_")):
            aggs.append(F.sum(c).alias(c))
        elif c.startswith(("max_", "min_")):
            held = F.col(c)
            aggs.append(extreme(held["value"], {k: held[k] for k in keys}, c.startswith("max_")).alias(c))
    return states.groupBy(*by).agg(*aggs)


def state_averages(states: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """The averages of :func:`~cohortkit.operators.measures.group_measure_avg`."""
    avg = lambda c: F.try_divide(F.col(f"sum_{c}").cast("double"), F.col(f"n_{c}"))
    merged = merge_states(states, by)
    return merged.select(*by, (avg(ALL) / F.lit(len(cols))).alias("avg_all"), *[avg(c).alias(f"avg_{c}") for c in cols])


def state_coverage(states: DataFrame, by: Sequence[str]) -> DataFrame:
    """The mean ratio of :func:`~cohortkit.operators.coverage.group_coverage`."""
    return merge_states(states, by).select(*by, F.try_divide("sum_ratio", "n_ratio").alias("avg_coverage"))


def state_extremes(states: DataFrame, cols: Sequence[str], keys: Sequence[str] = ("id", "name"), by: Sequence[str] = ()) -> DataFrame:
    """The entity of the highest and lowest value per measure (L4), over all
    groups or per group of ``by``."""
    packed = F.array(*[F.struct(F.lit(c).alias("measure"), F.col(f"max_{c}").alias("max"), F.col(f"min_{c}").alias("min")) for c in (ALL, *cols)])
    stacked = merge_states(states, by, keys).select(*by, F.inline(packed)).where(F.col("max").isNotNull())
    return stacked.select(*by, "measure", *[F.col(f"{side}.{k}").alias(f"{side}_{k}") for side in ("max", "min") for k in (*keys, "value")])


class BatchStates:
    """The states of all landed batches below ``root``."""

    def __init__(self, spark: SparkSession, root: str, by: Sequence[str], cols: Sequence[str], keys: Sequence[str] = ("id", "name"),
                 ratio_col: str = "coverage"):
        self.spark, self.root = spark, root.rstrip("/")
        self.by, self.cols, self.keys, self.ratio_col = list(by), list(cols), list(keys), ratio_col

    def _write(self, df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{self.root}/{name}")

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}").withColumn("batch", F.col("batch").cast("bigint"))

    def add(self, batch: int, rows: DataFrame, landed: DataFrame | None = None) -> list[int]:
        """Take in a batch: ``rows`` are its base rows, ``landed`` the ids that
        came with it (default: those of the rows).  Returns the batches whose
        states were made, the new one and those that held its ids before.
        A batch may be added again; numbers order versions."""
        key, this = self.keys[0], F.lit(batch).cast("bigint")
        wanted = list(dict.fromkeys([*self.by, *self.keys, *self.cols, self.ratio_col]))
        ids = (rows if landed is None else landed).select(key).where(F.col(key).isNotNull()).distinct()
        self._drop(batch)  # a partition that gets no rows now must not keep those of an earlier try
        self._write(rows.select(*wanted, this.alias("batch")), "rows")
        self._write(ids.select(key, this.alias("batch")), "keys")
        keys = self._read("keys")
        own = keys.where(F.col("batch") == this).select(key)
        # one number per batch: bounded by the batches
        older = [r.batch for r in keys.where(F.col("batch") < this).join(own, key, "left_semi").select("batch").distinct().collect()]
        made = sorted([*older, batch])
        for b in older:  # a group that loses its last row must not keep its state
            drop_path(self.spark, f"{self.root}/state/batch={b}")
        self._make(made)
        return made

    def _drop(self, batch: int) -> None:
        for name in ("rows", "keys", "state"):
            drop_path(self.spark, f"{self.root}/{name}/batch={batch}")

    def _make(self, batches: list[int]) -> None:
        """States of the given batches, from their rows that no later batch
        holds anew: only their partitions are read, and the keys of later ones."""
        key = self.keys[0]
        newest = self._read("keys").where(F.col("batch") >= min(batches)).groupBy(key).agg(F.max("batch").alias("batch"))
        rows = self._read("rows").where(F.col("batch").isin(batches)).join(newest, [key, "batch"], "left_semi")
        self._write(partial_state(rows, ["batch", *self.by], self.cols, self.keys, self.ratio_col), "state")

    def states(self) -> DataFrame:
        return self._read("state")
