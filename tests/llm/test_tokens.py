"""Tokenizer operators against whole-text calls of the libraries."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from cohortkit.llm import bpe_tree
from cohortkit.llm.token_counts import read_cache, token_counts
from cohortkit.llm.token_files import DacSegment, dac_image, read_token_files, read_tokens_at, write_token_files
from cohortkit.llm.tokenizing import PieceEncoder, PieceStore, load_tokenizer, tokenizer_path, tokenizer_version
from cohortkit.session import scratch_path

BYTE, WORD, PIECE = (tokenizer_path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
PARTS = [" ", "  ", "\n", "\n\n", "\t", " ", "　", "'", "'s", "'re", "don't", "!'s", "...", ".,", "word", "Word,", "über", "É.",
         "ΣΑΣ", "İ", "漢字かな", "123", "4567", "\U0001f600", "é", "_", "a_b", "x" * 40, "ab" * 30, "<|endoftext|>", "<|startoftext|>", "\x1c", "\x85"]
mixed = st.lists(st.one_of(st.sampled_from(PARTS), st.text(max_size=4)), max_size=40).map("".join)


def whole(tok, text):
    return tok.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def byte_tok():
    return load_tokenizer(BYTE)


@settings(max_examples=300, deadline=None)
@given(mixed)
def test_pieces_equal_whole_text(text):
    for path, drops in ((BYTE, False), (WORD, True)):
        enc = PieceEncoder(path, drops, remembered=200)
        got = [np.frombuffer(x, "<u4").tolist() for x in enc.encode([text, text])]
        assert got == [whole(enc.tok, text)] * 2


@settings(max_examples=300, deadline=None)
@given(st.lists(mixed, max_size=5))
def test_columns_equal_whole_texts(texts):
    for path, drops in ((BYTE, False), (WORD, True)):
        enc = PieceEncoder(path, drops, remembered=40)
        for _ in range(3):  # pieces met again, and after the store was emptied
            flat, cuts = enc.encode_column(pa.array([None, *texts], pa.string()))
            got = [flat[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            assert got == [whole(enc.tok, t) for t in ["", *texts]]


def test_piece_store_finds_what_it_was_given():
    rng, store, want = np.random.default_rng(1), PieceStore(bits=4), {}
    for _ in range(40):
        names = np.unique(np.concatenate([rng.integers(0, 2**64, 30, dtype=np.uint64), np.arange(rng.integers(0, 9), dtype=np.uint64)]))
        names = np.array([n for n in names.tolist() if n not in want], np.uint64)
        parts = [rng.integers(0, 9, rng.integers(0, 4)).tolist() for _ in names]
        store.add(names, parts)
        want |= dict(zip(names.tolist(), parts, strict=True))
    places = store.find(np.array(list(want), np.uint64))
    assert [store.ids[a:b].tolist() for a, b in zip(*store.spans(places), strict=True)] == list(want.values())
    assert (store.find(np.array([12345678901234567], np.uint64)) == -1).all()


@settings(max_examples=300, deadline=None)
@given(mixed, st.integers(1, 40))
def test_tree_equals_whole_text(text, leaf):
    tree = bpe_tree.TreeEncoder(BYTE, leaf_chars=leaf)
    ids = tree.encode([text])[0].tolist()
    assert ids == whole(tree.pieces.tok, text)
    assert b"".join(tree.bytes[i] for i in ids).decode("utf-8", "replace") == tree.pieces.tok.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["a" * 5000, " " * 700, "ab" * 3000, "漢" * 2000, "\n" * 333, "'" * 500, "é" * 999, "1" * 1234,
                                  "".join(chr(97 + i * i % 26) for i in range(6000))])
def test_long_unsplit_text(text, byte_tok):
    for leaf in (7, 64, 2048):
        assert bpe_tree.TreeEncoder(BYTE, leaf).encode([text])[0].tolist() == whole(byte_tok, text)


def test_join_reaches_whole_text_when_nothing_agrees(byte_tok):
    tree = bpe_tree.TreeEncoder(BYTE, 4)
    parts = [np.array(whole(byte_tok, t), np.uint32) for t in ("ab", "ou", "t the", " re")]
    assert tree.join([parts])[0].tolist() == whole(byte_tok, "about the re")


def test_bpe_rows(odd_docs, no_docs, byte_tok):
    rows = bpe_tree.decode(bpe_tree.encode(odd_docs, BYTE, piece_chars=1000, leaf_chars=100), BYTE).collect()
    source = odd_docs.select("doc_id", "text").collect()
    key = lambda i, t: (i is None, i or 0, t)
    assert sorted((key(r.doc_id, r.decoded), list(r.ids)) for r in rows) == sorted(
        (key(r.doc_id, r.text or ""), whole(byte_tok, r.text or "")) for r in source)
    both = bpe_tree.encode(odd_docs, BYTE, piece_chars=1000, leaf_chars=100, decoded_col="decoded").collect()
    assert sorted(map(str, both)) == sorted(map(str, rows))
    assert bpe_tree.encode(no_docs, BYTE).count() == 0


@given(st.lists(st.integers(0, 2**32 - 1), max_size=300))
def test_codes_give_every_token(ids):
    image = DacSegment(dac_image(np.array(ids, np.uint32)))
    assert len(image) == len(ids)
    assert image.take(np.arange(len(ids))).tolist() == image.all().tolist() == ids
    assert [image[i] for i in range(len(ids))] == ids


def test_token_files(spark, odd_docs, no_docs):
    path, tok = scratch_path(spark, "t"), load_tokenizer(WORD)
    write_token_files(odd_docs, path, WORD, 1, segment_tokens=50)
    got = read_token_files(spark, path).orderBy("start").collect()
    assert len(got) == odd_docs.count()
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in got), key=lambda i: (i is not None, i))
    want = sorted((r.doc_id is not None, r.doc_id or 0, [*whole(tok, r.text or ""), 1]) for r in odd_docs.collect())
    assert sorted((r.doc_id is not None, r.doc_id or 0, list(r.ids)) for r in got) == want
    start = 0
    for r in got:
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes()))
        start += r.n_tokens
    flat = [t for r in got for t in r.ids]
    asked = [0, 5, len(flat) - 1, len(flat) // 2]
    at = read_tokens_at(spark, path, spark.createDataFrame([(p,) for p in asked], "position long")).collect()
    assert {r.position: r.token for r in at} == {p: flat[p] for p in asked}
    empty = scratch_path(spark, "t")
    write_token_files(no_docs, empty, WORD, 1)
    assert read_token_files(spark, empty).count() == 0


def test_counts_and_cache(spark, odd_docs, no_docs, byte_tok, monkeypatch):
    cache = scratch_path(spark, "counts")
    rows = token_counts(odd_docs, BYTE, cache, limit=5).collect()
    want = sorted(((r.doc_id is None, r.doc_id or 0), len((r.text or "").encode()), len(whole(byte_tok, r.text or "")))
                  for r in odd_docs.collect())
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.n_bytes, r.n_tokens) for r in rows) == want
    assert all(r.over_limit == (r.n_tokens > 5) for r in rows)
    stored = spark.read.parquet(cache)
    n = odd_docs.selectExpr("coalesce(text, '')").distinct().count()
    assert stored.count() == n and read_cache(spark, cache, tokenizer_version(BYTE)).count() == n
    more = odd_docs.unionByName(spark.createDataFrame([(99, "a new text", "", 0, 0, 0, "", 0, 0.0, [], 0)], odd_docs.schema))
    assert token_counts(more, BYTE, cache).count() == len(rows) + 1
    assert spark.read.parquet(cache).count() == n + 1  # only the miss was encoded
    token_counts(odd_docs, WORD, cache).count()
    assert spark.read.parquet(cache).count() == 2 * n + 1  # another version, other counts
    assert token_counts(no_docs, BYTE).count() == 0


def test_counts_by_sentencepiece(odd_docs):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    rows = token_counts(odd_docs.where("doc_id < 6"), PIECE).collect()
    texts = {r.doc_id: r.text or "" for r in odd_docs.collect()}
    assert all(r.n_tokens == len(model.encode(texts[r.doc_id])) for r in rows)


def test_query_digests(spark):
    from cohortkit.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    tok, docs = load_tokenizer(BYTE), {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["op5_bpe"](spark, sf).collect():
        ids = whole(tok, docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
    counts = {r.doc_id: r for r in QUERIES["op9_token_counts"](spark, sf).collect()}
    assert all(counts[i].n_tokens == len(whole(tok, t)) for i, t in docs.items())
    word, start = load_tokenizer(WORD), 0
    for r in sorted(QUERIES["op4_token_files"](spark, sf).collect()):
        ids = np.array([*whole(word, docs[r.doc_id]), 1], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
