"""Token ids as directly addressable codes, written in ascending id order.

An id is split into chunks of 8 bits.  Level 0 holds the lowest chunk of every
id; a bit beside it says whether a further chunk follows, and level 1 holds
only those, and so on.  The entry of a chunk on the next level is the number of
set bits before it, which a rank directory (set bits before each 64-bit word)
gives at once, so any token is read without decoding a block.

Image of one segment, all numbers little-endian::

    magic "DAC1", uint32 levels
    per level: uint64 entries, the chunks padded to 8 bytes,
               the bitmap as uint64 words, uint32 rank before each word
               padded to 8 bytes

Segments are rows of a Parquet folder, so that any store Spark writes to can
hold them: ``part`` and ``seq`` order them, ``before`` is the number of tokens
of the same part before them, ``ids`` / ``first`` list their documents and where
those begin.  A document is never cut: a segment ends with the document that
brings it to ``segment_tokens``.

Documents are range-partitioned by id (then by text hash, which spreads an id
that many rows repeat), sorted within each partition and encoded as a stream.
Defined results: a null or empty text has only its end id; rows of one id
follow each other in the order of their text hash; null ids come first; an
empty table gives an empty folder.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortkit.llm.text import small_slices
from cohortkit.llm.tokenizing import piece_encoder

MAGIC = b"DAC1"
SEGMENT_TOKENS = 1 << 20


def _padded(raw: bytes) -> bytes:
    return raw + b"\0" * (-len(raw) % 8)


def dac_image(ids: np.ndarray) -> bytes:
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 255
        bits = np.packbits(more, bitorder="little").tobytes()
        words = np.frombuffer(_padded(bits), "<u8")
        rank = np.zeros(len(words), "<u4")
        rank[1:] = np.cumsum(np.bitwise_count(words[:-1]), dtype=np.uint32) if len(words) else 0
        levels.append(b"".join([np.uint64(len(rest)).tobytes(), _padded((rest & 255).astype(np.uint8).tobytes()),
                                words.tobytes(), _padded(rank.tobytes())]))
        if not more.any():
            return MAGIC + np.uint32(len(levels)).tobytes() + b"".join(levels)
        rest = rest[more] >> np.uint32(8)


class DacSegment:
    """Random access to the ids of one image."""

    def __init__(self, image: bytes):
        if image[:4] != MAGIC:
            raise ValueError("not a DAC1 segment")
        self.levels, at = [], 8
        for _ in range(int(np.frombuffer(image, "<u4", 1, 4)[0])):
            n = int(np.frombuffer(image, "<u8", 1, at)[0])
            words = -(-n // 64)
            chunks = np.frombuffer(image, np.uint8, n, at + 8)
            at += 8 + n + -n % 8
            bits = np.frombuffer(image, "<u8", words, at)
            rank = np.frombuffer(image, "<u4", words, at + 8 * words)
            at += 8 * words + 4 * words + -(4 * words) % 8
            self.levels.append((chunks, bits, rank))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def all(self) -> np.ndarray:
        """All ids in order: the set bits of a level are the places of the next."""
        parts = []
        for chunks, bits, _ in self.levels:
            more = np.unpackbits(bits.view(np.uint8), count=len(chunks), bitorder="little").view(bool)
            parts.append((chunks.astype(np.uint32), more))
        out = parts[-1][0]
        for chunks, more in parts[-2::-1]:
            chunks[more] |= out << np.uint32(8)
            out = chunks
        return out

    def take(self, at: np.ndarray) -> np.ndarray:
        """Ids at any positions, in the order asked for."""
        at = np.asarray(at, np.int64)
        out, live = np.zeros(len(at), np.uint32), np.arange(len(at))
        for k, (chunks, bits, rank) in enumerate(self.levels):
            out[live] |= chunks[at].astype(np.uint32) << np.uint32(8 * k)
            word, bit = bits[at >> 6], (at & 63).astype(np.uint64)
            more = (word >> bit & np.uint64(1)).astype(bool)
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            live, at = live[more], (rank[at >> 6] + below)[more].astype(np.int64)
        return out

    def __getitem__(self, i: int) -> int:
        return int(self.take(np.array([i]))[0])


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id",
                      text_col: str = "text", drops_space: bool = True,
                      segment_tokens: int = SEGMENT_TOKENS) -> None:
    """Encode every text, append ``end_id`` and write the segments."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = ["id", F.xxhash64("text")]
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"part int, seq int, before long, n_tokens long, ids array<{kind}>, first array<long>, image binary"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        encoder, end = piece_encoder(tokenizer, drops_space), np.array([end_id], np.uint32)
        ids, first, held, n = [], [], [], 0

        def segment() -> pa.RecordBatch:
            row = {"part": [part], "seq": [seq], "before": [before], "n_tokens": [n],
                   "ids": [pa.array(ids, id_type).to_pylist()], "first": [first],
                   "image": [dac_image(np.concatenate(held))]}
            return pa.RecordBatch.from_pydict(row, pa.schema([
                ("part", pa.int32()), ("seq", pa.int32()), ("before", pa.int64()), ("n_tokens", pa.int64()),
                ("ids", pa.list_(id_type)), ("first", pa.list_(pa.int64())), ("image", pa.binary())]))

        for batch in small_slices(batches, "text", 1 << 20):
            id_type = batch.schema.field("id").type
            flat, cuts = encoder.encode_column(batch.column("text"))
            for doc, a, b in zip(batch.column("id").to_pylist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                ids.append(doc)
                first.append(n)
                held += [flat[a:b], end]
                n += b - a + 1
                if n >= segment_tokens:
                    yield segment()
                    seq, before = seq + 1, before + n
                    ids, first, held, n = [], [], [], 0
        if ids:
            yield segment()

    (rows.repartitionByRange(*order).sortWithinPartitions(*order)
     .mapInArrow(encode, schema).write.mode("overwrite").parquet(path))


def read_token_index(spark: SparkSession, path: str) -> DataFrame:
    """The segments with ``start``, the number of tokens before each in the
    whole folder.  Running sums are taken over one row per part; their number
    is that of the range partitions, which also bounds the broadcast."""
    files = spark.read.parquet(path)
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("part_start"))
    return (files.join(F.broadcast(starts), "part")
            .withColumn("start", F.col("part_start") + F.col("before")).drop("part_start"))


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """``(id, start, n_tokens, ids_crc32[, ids])`` of every document, read
    from the segments; the crc is over the ids as little-endian uint32."""
    index = read_token_index(spark, path)
    kind = index.schema["ids"].dataType.elementType.simpleString()
    schema = "id {}, start long, n_tokens long, ids_crc32 long{}".format(kind, ", ids array<int>" * with_ids)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                image = DacSegment(batch.column("image")[r].as_buffer())
                first = np.array(batch.column("first")[r].as_py(), np.int64)
                stop, start = np.append(first[1:], len(image)), batch.column("start")[r].as_py()
                tokens = image.all().astype("<u4", copy=False)
                crc = [zlib.crc32(tokens[a:b]) for a, b in zip(first, stop, strict=True)]
                columns = [batch.column("ids")[r].values, pa.array(first + start), pa.array(stop - first),
                           pa.array(crc, pa.int64())]
                names = ["id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(first, len(image)), pa.int32()),
                                                            pa.array(tokens.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    found = index.select("ids", "first", "start", "image").mapInArrow(read, schema)
    return found.withColumnRenamed("id", id_col)


def read_tokens_at(spark: SparkSession, path: str, positions: DataFrame, position_col: str = "position") -> DataFrame:
    """``(position, token)`` for any global token positions.  Positions meet
    their segment through the segment's range of starts: they are sorted into
    segments on the driver's list of starts, one number per segment."""
    index = read_token_index(spark, path)
    starts = np.array(sorted(r.start for r in index.select("start").collect()), np.int64)
    handle = spark.sparkContext.broadcast(starts)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("position").to_numpy(zero_copy_only=False)
            own = handle.value[np.searchsorted(handle.value, at, side="right") - 1]
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(own)], ["position", "start"])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, tokens = [], []
            for row in batch.to_pylist():
                asked = np.array(row["asked"], np.int64)
                at.append(asked)
                tokens.append(DacSegment(row["image"]).take(asked - row["start"]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(at)), pa.array(np.concatenate(tokens))],
                                             ["position", "token"])

    asked = (positions.select(F.col(position_col).cast("long").alias("position")).where("position >= 0")
             .mapInArrow(place, "position long, start long").groupBy("start")
             .agg(F.collect_set("position").alias("asked")))
    return index.select("start", "image").join(asked, "start").mapInArrow(fetch, "position long, token int")
