"""Written tables between the jobs of an operator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cohortkit.session import scratch_path


def write_table(df: DataFrame, name: str, mode: str = "overwrite") -> tuple[DataFrame, str]:
    """Write to a fresh folder of the shared folder and read back: a lost
    executor then costs a re-read, never the jobs before."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode(mode).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def write_seen(df: DataFrame, name: str, **seen: Column) -> tuple[DataFrame, str, dict]:
    """As :func:`write_table`, with aggregates taken while the rows are written."""
    watch = Observation()
    table, path = write_table(df.observe(watch, *[c.alias(k) for k, c in seen.items()]), name)
    return table, path, watch.get


def split_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join rows to an aggregate by the same key, so that Spark can split a hot
    key of ``left``.  It splits joins of two plain shuffles only, and an
    aggregate that is dealt by the join key has none between it and the join;
    a second key, a hash of the first, gives it one.  The aggregate is the
    small side, so this shuffle is too."""
    mark = "__split_key"
    return (left.withColumn(mark, F.xxhash64(key))
            .join(right.withColumn(mark, F.xxhash64(key)), [key, mark], how).drop(mark))
