"""Token counts behind a digest cache.

Counts are stored by the digest of the normalised content (the UTF-8 text, a
null counting as empty: the only normalisation that keeps every count exact)
and the digest of the tokenizer version.  Documents are joined to the stored
counts by digest; of what is missing, each distinct text is encoded once and
its count appended to the cache, which then answers for all documents.

The copies of one text meet as one digest before their text is shuffled (a
partial aggregate on the map side), so a text that a third of all rows share
is sent once per task; the joins back are on digests, which Spark splits when
one of them is hot.

Defined results: null and empty texts count 0 tokens and 0 bytes; repeated
rows and ids each get their row; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.tables import split_join
from cohortkit.llm.text import small_slices
from cohortkit.llm.tokenizing import piece_encoder, tokenizer_version
from cohortkit.session import scratch_path

CACHE_SCHEMA = "digest binary, tokenizer string, n_tokens long"


def _counter(path: str):
    """A function from a column of texts to their numbers of tokens."""
    if path.endswith(".model"):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in model.encode(texts.to_pylist(), num_threads=1)]
    return piece_encoder(path).count_column


def read_cache(spark, cache_path: str, version: str) -> DataFrame:
    """Stored counts of one tokenizer version.  Jobs that ran at the same time
    may both have appended a digest; it is answered once."""
    try:
        rows = spark.read.schema(CACHE_SCHEMA).parquet(cache_path)
    except Exception as e:  # a cache that nothing has written to yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        rows = spark.createDataFrame([], CACHE_SCHEMA)
    return rows.where(F.col("tokenizer") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, tokenizer: str, cache_path: str | None = None,
                 id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` per document.  ``tokenizer`` is
    the path of a tokenizer file (``.json`` or ``.model``), ``cache_path`` a
    folder that lasts (a fresh one of the shared folder, if not given)."""
    spark = docs.sparkSession
    cache_path = cache_path or scratch_path(spark, "token_counts")
    version = tokenizer_version(tokenizer)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer)
        for batch in small_slices(batches, "text", 1 << 20):
            n = counter(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array([version] * len(n)), pa.array(n, pa.int64())],
                ["digest", "tokenizer", "n_tokens"])

    missing = (rows.select("digest", "text").dropDuplicates(["digest"])
               .join(read_cache(spark, cache_path, version), "digest", "left_anti"))
    missing.mapInArrow(count, CACHE_SCHEMA).write.mode("append").parquet(cache_path)
    counted = split_join(rows.select("id", "digest", F.octet_length("text").cast("long").alias("n_bytes")),
                         read_cache(spark, cache_path, version), "digest", "left")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens",
                          (F.col("n_tokens") > limit).alias("over_limit"))
