"""TF-IDF in hashed buckets with MLlib's own stages (I1-I3, hashed mode).

A ``PipelineModel`` of ``HashingTF`` and a fitted ``IDFModel`` on sparse
vectors, saved and loaded again, so that a later run scores new rows with the
weights of an earlier one without its tags.  Counts of tags that share a bucket
add up (:func:`bucket_table` reports them); :mod:`cohortkit.operators.similarity`
holds the exact counts.

``HashingTF`` alone would need every tag list, repeats included, in one row.
Here it names the bucket of each distinct tag, counts are summed by name and
bucket with Spark's aggregates, and a name's vector holds its distinct buckets.
Vectors pass between MLlib and columns through written tables: the Parquet form
of a vector is the struct of its type, so neither way needs Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit.operators.similarity import _name_counts, join_own_aggregate
from cohortkit.session import scratch_path
from cohortkit.sources.files import COMPRESSION, materialize

N_FEATURES = 1 << 18
#: The stored form of a vector; type 0 is sparse.
STORED = T.StructType([T.StructField("type", T.ByteType()), T.StructField("size", T.IntegerType()),
                       T.StructField("indices", T.ArrayType(T.IntegerType())), T.StructField("values", T.ArrayType(T.DoubleType()))])


def _retyped(df: DataFrame, kinds: dict[str, T.DataType], name: str) -> DataFrame:
    """Written and read back with other types for some columns."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(T.StructType([T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in df.schema])).parquet(path)


def hashing(n_features: int = N_FEATURES) -> HashingTF:
    return HashingTF(numFeatures=n_features, inputCol="terms", outputCol="tf")


def _buckets(tags: DataFrame, stage: HashingTF) -> DataFrame:
    """``(tag, bucket)`` of every distinct tag, as the stage hashes it."""
    one = stage.transform(tags.select("tag").distinct().withColumn(stage.getInputCol(), F.array("tag")))
    stored = _retyped(one.select("tag", F.col(stage.getOutputCol()).alias("v")), {"v": STORED}, "buckets")
    return stored.select("tag", F.col("v.indices")[0].alias("bucket"))


def bucket_table(base: DataFrame, stage: HashingTF | None = None, tags_col: str = "tags", tag_field: str | None = "tag") -> DataFrame:
    """``(tag, bucket, n_sharing)``: tags of more than one in a bucket collide."""
    tags = F.col(tags_col).getField(tag_field) if tag_field else F.col(tags_col)
    found = _buckets(base.select(F.explode(tags).alias("tag")).where(F.col("tag").isNotNull()), stage or hashing())
    return join_own_aggregate(found, found.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_sharing")), "bucket")


def hashed_counts(base: DataFrame, key_cols: Sequence[str], stage: HashingTF, tags_col: str = "tags",
                  tag_field: str | None = "tag", name_col: str = "name") -> DataFrame:
    """``(row keys, tf)`` with a sparse vector of bucket counts per base row.  Tags
    are counted by name, as in the exact mode; NULL tags do not count; a row
    without tags, or without a name, has an empty vector."""
    spark, size = base.sparkSession, stage.getNumFeatures()
    counts = materialize(_name_counts(base.where(F.col(name_col).isNotNull()), tags_col, tag_field, name_col), scratch_path(spark, "counts"))
    hashed = (join_own_aggregate(counts, _buckets(counts, stage).groupBy("tag").agg(F.first("bucket").alias("bucket")), "tag")
              .select("__name", "bucket", "tf").repartition("__name")  # once for both aggregates
              .groupBy("__name", "bucket").agg(F.sum("tf").cast("double").alias("tf")))
    # one entry per distinct bucket of a name, in bucket order
    pairs = hashed.groupBy("__name").agg(F.array_sort(F.collect_list(F.struct("bucket", "tf"))).alias("e"))

    def stored(indices, values):
        return F.struct(F.lit(0).cast("byte").alias("type"), F.lit(size).alias("size"), indices.alias("indices"), values.alias("values"))

    vectors = materialize(pairs.select("__name", stored(F.col("e.bucket"), F.col("e.tf")).alias("own")), scratch_path(spark, "vectors"))
    empty = stored(F.array().cast("array<int>"), F.array().cast("array<double>"))
    rows = base.select(*key_cols, F.col(name_col).alias("__name")).join(vectors, "__name", "left")
    return _retyped(rows.select(*key_cols, F.coalesce("own", empty).alias("tf")), {"tf": VectorUDT()}, "rows")


def fit_hashed(base: DataFrame, path: str, n_features: int = N_FEATURES, counted: DataFrame | None = None,
               **columns: str | None) -> PipelineModel:
    """Fit on all base rows, save below ``path`` (a new folder) and load from there.
    The fit adds up one number per bucket and task.  A caller that also weighs
    these rows passes their :func:`hashed_counts` to both as ``counted``."""
    stage = hashing(n_features)
    counted = hashed_counts(base, [], stage, **columns) if counted is None else counted
    idf = IDF(inputCol="tf", outputCol="weight").fit(counted)
    PipelineModel([stage, idf]).write().save(path)
    return PipelineModel.load(path)


def hashed_weights(base: DataFrame, key_cols: Sequence[str], model: PipelineModel, counted: DataFrame | None = None,
                   **columns: str | None) -> DataFrame:
    """``(row keys, bucket, tf, weight)`` of base rows, fitted or new, under a
    model of :func:`fit_hashed`; rows with an empty vector have none."""
    stage, idf = model.stages
    counted = hashed_counts(base, key_cols, stage, **columns) if counted is None else counted
    scored = _retyped(idf.transform(counted), {"tf": STORED, "weight": STORED}, "weights")
    entry = F.arrays_zip(F.col("tf.indices").alias("bucket"), F.col("tf.values").alias("tf"), F.col("weight.values").alias("weight"))
    return scored.select(*key_cols, F.explode(entry).alias("e")).select(
        *key_cols, F.col("e.bucket").cast("long").alias("bucket"), F.col("e.tf").cast("long").alias("tf"), "e.weight")
