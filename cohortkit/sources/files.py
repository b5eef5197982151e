"""File sources and sinks: JSON scan, landing folder, Parquet.

Sinks write under the folder the caller passes; jobs take it from
:func:`cohortkit.session.scratch_path`, i.e. below ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit.session import scratch_path

CORRUPT = "_corrupt_record"
#: Ends a landed document (the record separator of JSON text sequences): it
#: cannot stand in JSON text, so line breaks inside a document stay as they are.
RECORD_END = "\x1e"
#: Documents in one landed file, which a single task reads.
LANDED_PER_FILE = 20_000
#: Of the Parquet files written here: about two thirds of the default's size.
COMPRESSION = "zstd"

def scan_local(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """Rows held by the driver to a DataFrame with an explicit schema.

    For small, driver-side inputs only (tests, lookup lists); table-sized
    data belongs in files and :func:`read_json_arrays` / Parquet scans.
    """
    return spark.createDataFrame(list(rows), schema=schema)


def read_json_arrays(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """Files that each hold one JSON array of objects, one row per element (A10).

    Such files cannot be split, so each is read by one task; for large
    volumes land single documents instead (:func:`land`).
    """
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(full).option("multiLine", True).option("columnNameOfCorruptRecord", CORRUPT).json(
        paths if isinstance(paths, str) else list(paths))


def read_json_elements(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """The elements of files that each hold one JSON array, as ``(file, pos,
    raw)`` (A10): no schema is applied, so an element that does not fit one
    costs nothing but itself, and fields that no schema names are kept.

    A file is read into one VARIANT and spread by position; ``raw`` is the
    element's JSON, for the parsers and their rejects.  A file that holds one
    object gives one element; one that is no JSON gives one without text,
    which every parser rejects, so the file is not lost silently.
    """
    whole = (spark.read.option("singleVariantColumn", "v").option("multiLine", True).json(paths if isinstance(paths, str) else list(paths))
             .select(F.input_file_name().alias("file"), "v"))
    items = F.try_variant_get("v", "$", "array<variant>")
    spread = F.when(items.isNotNull(), items).otherwise(F.array("v"))
    return whole.select("file", F.posexplode(spread).alias("pos", "e")).select("file", "pos", F.to_json("e").alias("raw"))


def write_json_arrays(docs: DataFrame, path: str, key: str, obj_col: str = "obj") -> None:
    """Write one JSON array file per value of ``key`` (the original landing
    layout): the objects of one key are collected into one array."""
    arrays = docs.groupBy(key).agg(F.to_json(F.collect_list(obj_col)).alias("value"))
    arrays.write.mode("overwrite").partitionBy(key).text(path)


def land(docs: DataFrame, path: str, ingest: int, mode: str = "append") -> None:
    """Append documents ``(type, raw)`` to a landing folder.

    Each record is one document as received, line breaks included, ended by
    :data:`RECORD_END` and partitioned by ``type`` and ``ingest`` (the landing
    batch).  The files are compressed (at gzip's fastest level: they are read
    once), and so that many tasks can read them they hold at most
    :data:`LANDED_PER_FILE` documents.  Text that holds that sign itself is no
    JSON; the sign becomes its JSON escape.  Re-landing an object adds a
    newer version instead of rewriting a file in place;
    :func:`latest_version` picks the newest.  The
    document text is not wrapped in another JSON value.
    """
    record = F.replace(F.col("raw").cast("string"), F.lit(RECORD_END), F.lit("\\u001e"))
    (docs.select(record.alias("value"), F.col("type").cast("string"),
                 F.lit(ingest).cast("bigint").alias("ingest"))
     .write.mode(mode).option("lineSep", RECORD_END).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
     .option("maxRecordsPerFile", LANDED_PER_FILE).partitionBy("type", "ingest").text(path))


def read_landing(spark: SparkSession, path: str, doc_type: str | None = None) -> DataFrame:
    """Landed documents as text ``(raw, type, ingest)``; ``doc_type`` prunes
    partitions.  For mixed-type routing (:func:`route_documents`)."""
    df = spark.read.text(path, lineSep=RECORD_END).select(F.col("value").alias("raw"), F.col("type").cast("string"),
                                      F.col("ingest").cast("bigint"))
    return df if doc_type is None else df.where(F.col("type") == F.lit(doc_type))



def latest_version(df: DataFrame, keys: Sequence[str], order_col: str, workdir: str | None = None) -> DataFrame:
    """All rows of the newest ``order_col`` per key (landing semantics, K4: a
    re-landed object replaces every document of its previous version, also
    when one object was landed as several chunk documents).

    ``df`` is read twice, the first time only its keys and ``order_col``, so
    pass a written table.  Keys with several versions are found by a
    partial-aggregated ``min`` and ``max`` and written below ``workdir`` (default:
    a fresh folder under ``spark.checkpoint.dir``) when this is called; their older
    rows are taken off.  Mostly they are few, and rows then stay where they are;
    if not, AQE can split a hot key.  Rows with a null key or ``order_col`` have no
    version and are dropped; split them off first.
    """
    versions = df.groupBy(*keys).agg(F.max(order_col).alias("__newest"), F.min(order_col).alias("__oldest"))
    several = materialize(versions.where(F.col("__oldest") < F.col("__newest")).select(*[F.col(k).alias(f"__{k}") for k in keys], "__newest"),
                          workdir or scratch_path(df.sparkSession, "versions"))
    known = df.where(reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in (*keys, order_col)]))
    older = reduce(lambda x, y: x & y, [F.col(k) == F.col(f"__{k}") for k in keys], F.col(order_col) < F.col("__newest"))
    return known.join(several, older, "left_anti")


def publish(datasets: Mapping[str, DataFrame], root: str, max_parallel: int = 4) -> dict[str, int]:
    """Write every dataset as Parquet under ``root/<name>``, overwrite (A13/K5);
    returns the number of rows that each write was seen to write.

    The writes are independent Spark jobs; up to ``max_parallel`` of them are
    submitted at once (Spark schedules concurrent jobs from several driver
    threads), so one dataset's last tasks do not leave the cluster idle.
    """
    def write(name: str) -> int:
        seen = Observation()
        rows = datasets[name].observe(seen, F.count(F.lit(1)).alias("n"))
        rows.write.mode("overwrite").option("compression", COMPRESSION).parquet(f"{root.rstrip('/')}/{name}")
        return seen.get["n"]

    with ThreadPoolExecutor(max_workers=max(1, max_parallel)) as pool:
        return dict(zip(datasets, pool.map(write, datasets), strict=True))


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Parquet scan of a published dataset."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}")


def publish_bucketed(df: DataFrame, root: str, name: str, key: str, buckets: int) -> None:
    """Publish a dataset bucketed and sorted by ``key`` below ``root/<name>``,
    one file per bucket (A13).  Joins of datasets with equal bucket counts on
    their keys, and aggregates by them, need no shuffle in later runs.  The key
    and count stand in ``root/<name>__buckets``, so a later session needs no
    catalog of this one."""
    spark, path = df.sparkSession, f"{root.rstrip('/')}/{name}"
    table = f"bucketed_{uuid.uuid4().hex}"
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(table))
    spark.sql(f"DROP TABLE {table}")  # the files stay: the table is external
    spec = spark.range(1).select(F.lit(key).alias("key"), F.lit(buckets).alias("buckets"), F.lit(df.schema.json()).alias("schema"))
    spec.coalesce(1).write.mode("overwrite").parquet(f"{path}__buckets")


def read_bucketed(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A dataset of :func:`publish_bucketed` with its bucketing."""
    path = f"{root.rstrip('/')}/{name}"
    spec = spark.read.parquet(f"{path}__buckets").first()
    table = f"bucketed_{uuid.uuid4().hex}"
    schema = T.StructType.fromJson(json.loads(spec.schema))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    quoted = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (`{spec.key}`) SORTED BY (`{spec.key}`) "
              f"INTO {spec.buckets} BUCKETS LOCATION '{quoted}'")
    return spark.table(table)


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, and a lost
    executor then costs a re-read, not a recomputation of the joins."""
    df.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.parquet(path)
