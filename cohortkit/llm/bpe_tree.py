"""BPE encoding by tree concatenation, and decoding.

A long text is halved until its leaves are short.  Leaves are encoded on their
own, then neighbours are joined: the last tokens of the left half and the
first of the right are decoded, that window is encoded anew, and it grows until
its outer tokens on both sides agree exactly with the tokens already there.
A BPE token sequence is the encoding of its text if every neighbouring pair
is, and the tokenizer's text pattern falls into step within a few tokens, so an
agreeing window makes the joined sequence the encoding of the whole text; if
nothing agrees the window ends up being the whole text.

Texts of more than ``piece_chars`` characters are cut on the Spark level: their
pieces are encoded by different tasks and joined by digest of the text.  All
other texts are joined inside their task, level by level, all windows of a
batch in one call of the library.

Defined results: null counts as empty, which has no ids and decodes to empty;
every row gets its own result; extra columns are left out (the result has the
id, ``ids`` and what :func:`decode` adds).
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.tables import write_table
from cohortkit.llm.text import small_slices
from cohortkit.llm.tokenizing import load_tokenizer, piece_encoder

LEAF_CHARS = 2048
PIECE_CHARS = 65_536
WINDOW = 12  # tokens taken from either side at first
AGREE = 4  # outer tokens of a window that must agree on either side


def token_bytes(path: str) -> list[bytes]:
    """The bytes of every id of a byte-level tokenizer file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # byte-level alphabet: these stand for themselves
    rest = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    table = {i: bytes(byte_of[c] for c in t) for t, i in spec["model"]["vocab"].items()
             if all(c in byte_of for c in t)}
    table |= {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
    return [table.get(i, b"") for i in range(max(table) + 1)]


class TreeEncoder:
    def __init__(self, path: str, leaf_chars: int = LEAF_CHARS):
        self.pieces = piece_encoder(path)
        self.bytes = token_bytes(path)
        self.leaf = leaf_chars
        self.special = {t.content: i for i, t in self.pieces.tok.get_added_tokens_decoder().items()}

    def _cut(self, text: str) -> list[str]:
        """Leaves of the halving tree, left to right."""
        if len(text) <= self.leaf:
            return [text]
        half = len(text) // 2
        return self._cut(text[:half]) + self._cut(text[half:])

    def _parts(self, text: str) -> list[str | int]:
        """The text between added special tokens, and the ids of those."""
        parts: list[str | int] = [text]
        for content, i in self.special.items():
            if content in text:
                split = []
                for part in parts:
                    if isinstance(part, int):
                        split.append(part)
                        continue
                    for k, sub in enumerate(part.split(content)):
                        split += [i, sub] if k else [sub]
                parts = split
        return [p for p in parts if p != ""]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        plan = [self._parts(t) for t in texts]
        trees = [self._cut(p) for own in plan for p in own if isinstance(p, str)]
        leaves = iter(self._encode_each([leaf for tree in trees for leaf in tree]))
        joined = iter(self.join([[next(leaves) for _ in tree] for tree in trees]))
        out = []
        for own in plan:
            ids = [np.array([p], np.uint32) if isinstance(p, int) else next(joined) for p in own]
            out.append(ids[0] if len(ids) == 1 else np.concatenate([*ids, np.zeros(0, np.uint32)]).astype(np.uint32))
        return out

    def _encode_each(self, texts: list[str]) -> list[np.ndarray]:
        flat, cuts = self.pieces.encode_column(pa.array(texts, pa.large_string()))
        return [flat[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]

    def join(self, rows: list[list[np.ndarray]]) -> list[np.ndarray]:
        """Each row's neighbouring encodings joined pairwise up to one."""
        rows = [list(r) for r in rows]
        while any(len(r) > 1 for r in rows):
            pairs = [(r, k) for r, own in enumerate(rows) for k in range(0, len(own) - 1, 2)]
            whole = self._join_pairs([(rows[r][k], rows[r][k + 1]) for r, k in pairs])
            for (r, k), ids in zip(pairs, whole, strict=True):
                rows[r][k] = ids
            rows = [own[::2] for own in rows]
        return [r[0] for r in rows]

    def _starts_char(self, token: int) -> bool:
        return self.bytes[token][0] & 0xC0 != 0x80

    def _join_pairs(self, pairs: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(pairs)
        todo, size = list(range(len(pairs))), WINDOW
        while todo:
            spans, texts = [], []
            for i in todo:
                left, right = pairs[i]
                a, b = max(0, len(left) - size), min(len(right), size)
                while 0 < a < len(left) and not self._starts_char(left[a]):
                    a -= 1
                while b < len(right) and not self._starts_char(right[b]):
                    b += 1
                spans.append((a, b))
                window = [*left[a:].tolist(), *right[:b].tolist()]
                texts.append(b"".join(map(self.bytes.__getitem__, window)).decode())
            again = []
            for i, (a, b), ids in zip(todo, spans, self._encode_each(texts), strict=True):
                left, right = pairs[i]
                ok_left = a == 0 or np.array_equal(ids[:AGREE], left[a:a + AGREE])
                ok_right = b == len(right) or np.array_equal(ids[-AGREE:], right[max(0, b - AGREE):b])
                if ok_left and ok_right and (len(ids) >= 2 * AGREE or a == 0 and b == len(right)):
                    out[i] = np.concatenate([left[:a], ids, right[b:]])
                else:
                    again.append(i)
            todo, size = again, size * 2
        return out


def decoded(ids: np.ndarray, table: list[bytes]) -> str:
    return b"".join(map(table.__getitem__, ids.tolist())).decode("utf-8", "replace")


def _list_array(rows: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)])
    flat = np.concatenate([*rows, np.zeros(0, np.uint32)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
           leaf_chars: int = LEAF_CHARS, piece_chars: int = PIECE_CHARS, decoded_col: str | None = None) -> DataFrame:
    """``(id, ids)``: the ids of every whole text, as the library gives them
    without added special tokens, truncation or padding.  With ``decoded_col``
    the ids are decoded again by the same worker process, into a column of
    that name (as :func:`decode` does in one of its own)."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    is_long = F.length("text") > piece_chars

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = TreeEncoder(tokenizer, leaf_chars)
        for batch in small_slices(batches, "text", 1 << 20):
            found = tree.encode(batch.column("text").to_pylist())
            columns, names = [batch.column("id"), _list_array(found)], ["id", "ids"]
            if decoded_col:
                columns.append(pa.array([decoded(ids, tree.bytes) for ids in found], pa.string()))
                names.append(decoded_col)
            yield pa.RecordBatch.from_arrays(columns, names)

    def piece(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = TreeEncoder(tokenizer, leaf_chars)
        for batch in small_slices(batches, "piece", 1 << 20):
            raw = [ids.astype("<u4").tobytes() for ids in tree.encode(batch.column("piece").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("digest"), batch.column("k"), pa.array(raw, pa.binary())],
                                             ["digest", "k", "raw"])

    def joined(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        parts = [np.frombuffer(raw, "<u4") for raw in group.sort_values("k")["raw"]]
        return pd.DataFrame({"digest": [key[0]], "ids": [TreeEncoder(tokenizer, leaf_chars).join([parts])[0].astype(np.int32)]})

    specials = [t.content for t in load_tokenizer(tokenizer).get_added_tokens_decoder().values()]
    # a text is cut by length only; one with special tokens in it is not, as a cut could divide them
    is_cut = is_long
    for content in specials:
        is_cut = is_cut & ~F.contains("text", F.lit(content))
    whole = rows.where(~is_cut).mapInArrow(short, f"id {kind}, ids array<int>" + f", `{decoded_col}` string" * bool(decoded_col))
    long_rows = rows.where(is_cut).withColumn("digest", F.sha2("text", 256))
    n = F.ceil(F.length("text") / piece_chars).cast("int")
    pieces = (long_rows.select("digest", "text").dropDuplicates(["digest"])
              .select("digest", F.posexplode(F.transform(F.sequence(F.lit(0), n - 1),
                      lambda k: F.substring("text", k * piece_chars + 1, F.lit(piece_chars)))).alias("k", "piece"))
              .repartition("digest", "k"))
    encoded = (pieces.mapInArrow(piece, "digest string, k int, raw binary")
               .groupBy("digest").applyInPandas(joined, "digest string, ids array<int>"))
    encoded, _ = write_table(encoded, "bpe_long")
    cut = long_rows.select("id", "digest").join(encoded, "digest").select("id", "ids")
    if decoded_col:
        cut = decode(cut, tokenizer, out_col=decoded_col)
    return whole.unionByName(cut).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, tokenizer: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Adds the text of the ids, special tokens included.  Bytes that are not
    UTF-8 (ids of a cut text) give the replacement character."""
    from pyspark.sql import types as T
    columns = encoded.columns
    schema = T.StructType([*encoded.schema.fields, T.StructField(out_col, T.StringType())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(tokenizer)
        for batch in batches:
            rows = [own.values for own in batch.column(ids_col)]
            texts = [decoded(own.to_numpy(), table) if own is not None else "" for own in rows]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], pa.array(texts, pa.string())],
                                             [*columns, out_col])

    return encoded.mapInArrow(read, schema)
