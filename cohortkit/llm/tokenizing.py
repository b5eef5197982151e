"""Exact piecewise use of a public tokenizer file.

Whole-text encoding by these tokenizers never joins characters across white
space (a leading single space belongs to the word after it), so a text is cut
into such pieces and each distinct piece is encoded once by the library and
remembered.  Texts that hold an added special token are given to the library
whole.  ``tests/llm`` holds this against whole-text encoding.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa

from cohortkit.llm.text import run_hashes, text_bytes

#: White space of the Unicode property that the tokenizers' patterns use.
SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
#: Pieces of a byte-level tokenizer: a word with one space before it, or white
#: space up to the last character before a word.
SPACED = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: Pieces of a tokenizer that drops white space.
BETWEEN = re.compile("[^ \n]+")
#: Letters with commas or full stops after them: every pattern cuts there.
TRAILED = re.compile("( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,]+)")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
#: Ids (and characters of pieces of rarer texts) that one generation remembers: some 30 MB.
REMEMBERED = 1_200_000


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer file and of the library that reads it."""
    import sentencepiece
    import tokenizers
    lib = f"sentencepiece {sentencepiece.__version__}" if path.endswith(".model") else f"tokenizers {tokenizers.__version__}"
    with open(path, "rb") as f:
        return hashlib.sha256(lib.encode() + b"\0" + f.read()).hexdigest()


def load_tokenizer(path: str):
    """The library's tokenizer with truncation and padding off."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


class PieceEncoder:
    """Ids of whole texts by remembered pieces.

    ``drops_space``: the tokenizer drops white space and case, so pieces are
    what stands between spaces and line ends; else they are those of
    ``SPACED``.  A piece of letters with commas or full stops after it is the
    letters' ids and theirs.  Two generations of pieces are remembered, each of
    about ``remembered`` ids: what is met again moves to the young one.
    """

    def __init__(self, path: str, drops_space: bool = False,
                 remembered: int = REMEMBERED):
        self.tok = load_tokenizer(path)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.drops_space = drops_space
        self.split = (BETWEEN if drops_space else SPACED).findall
        self.most = remembered
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0
        self.store, self.former = PieceStore(), PieceStore()

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.tok.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _learn(self, pieces: set[str]) -> None:
        """Put pieces into the young generation."""
        known, old = self.known, self.old
        new = []
        for p in pieces:
            if p in old:
                known[p] = old[p]
            elif p not in known:
                new.append(p)
        for at in range(0, len(new), 20_000):
            part = new[at:at + 20_000]
            known.update(zip(part, self._library(part), strict=True))
        self.held += sum(map(len, pieces))

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        texts = list(texts)
        whole = [i for i, t in enumerate(texts) if any(s in t for s in self.special)]
        # up to U+024F Python and the library agree on lower case, and nothing there composes
        pieces = [self.split(t.lower() if self.drops_space and (t.isascii() or max(t) < "\u0250") else t) for t in texts]
        for i in whole:
            pieces[i] = []
        if self.held > self.most:
            self.known, self.old, self.held = {}, self.known, 0
        known = self.known
        new = {p for own in pieces for p in own if p not in known}
        parts = {p: (m[1], m[2]) for p in new if (m := TRAILED.fullmatch(p))}
        self._learn(new - parts.keys() | {x for pair in parts.values() for x in pair})
        known.update((p, known[a] + known[b]) for p, (a, b) in parts.items())
        self.held += sum(map(len, parts))
        get = known.__getitem__
        out = [b"".join(map(get, own)) for own in pieces]
        for i in whole:
            out[i] = self._library([texts[i]])[0]
        return out


    # -- whole Arrow columns ------------------------------------------------
    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the ``n + 1`` offsets by text.

        Texts of characters below U+0240 without special tokens and rarer
        white space are cut into pieces and looked up inside numpy; others take
        :meth:`encode`.
        """
        buf, at = text_bytes(column)
        slow = self._slow(buf, at)
        flat, offsets = self._pieces_of(buf, at, slow)
        if not slow.any():
            return flat, offsets
        rows = [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        which = np.flatnonzero(slow).tolist()
        found = self.encode([buf[at[i]:at[i + 1]].tobytes().decode() for i in which])
        for i, x in zip(which, found, strict=True):
            rows[i] = np.frombuffer(x, "<u4")
        return np.concatenate(rows), np.concatenate([[0], np.cumsum([len(r) for r in rows])])

    def count_column(self, column: pa.Array) -> np.ndarray:
        """Number of ids of each text."""
        return np.diff(self.encode_column(column)[1])

    def _slow(self, buf: np.ndarray, at: np.ndarray) -> np.ndarray:
        odd = buf >= 0xC9
        odd[1:] |= (buf[:-1] == 0xC2) & ((buf[1:] == 0x85) | (buf[1:] == 0xA0))
        seen = np.concatenate([[0], np.cumsum(odd)])
        slow = seen[at[1:]] > seen[at[:-1]]
        raw = buf.tobytes()
        for content in self.special:
            mark = content.encode()
            k = raw.find(mark)
            while k >= 0:
                slow[np.searchsorted(at, k, side="right") - 1] = True
                k = raw.find(mark, k + 1)
        return slow

    def _pieces_of(self, buf: np.ndarray, at: np.ndarray, slow: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(at) - 1
        if self.drops_space:
            buf = _LOWER[buf]
        space = _SPACES[buf] if not self.drops_space else (buf == 32) | (buf == 10)
        if not len(buf):
            return np.zeros(0, np.uint32), np.zeros(n + 1, np.int64)
        cut = np.zeros(len(buf) + 1, bool)
        cut[at] = True
        edge = space[1:] != space[:-1]
        if self.drops_space:
            cut[1:-1] |= edge
        else:
            into = edge & ~space[1:] & ~cut[1:-1]  # a word after white space of its text
            cut[1:-1] |= edge & space[1:]  # white space begins
            cut[:-2] |= into  # its last character goes with the word
            cut[1:-1] |= into & (buf[:-1] != 32)  # unless it is no space
        letter = _LETTER[buf]
        letter[1:] |= (buf[:-1] == 0xC3) & (buf[1:] != 0x97) & (buf[1:] != 0xB7)
        cut[1:-1] |= letter[:-1] & ((buf[1:] == 44) | (buf[1:] == 46))
        start = np.flatnonzero(cut)
        start, end = start[:-1], start[1:]
        text = np.searchsorted(at, start, side="right") - 1
        keep = ~slow[text]
        if self.drops_space:
            keep &= ~space[start]
        start, end, text = start[keep], end[keep], text[keep]
        slots = self._slots(run_hashes(buf, start, end), buf, start, end)
        size, begin = self.store.sizes[slots], self.store.begins[slots]
        upto = np.concatenate([[0], np.cumsum(size)])
        flat = self.store.ids[np.repeat(begin - upto[:-1], size) + np.arange(upto[-1])]
        return flat, upto[np.searchsorted(text, np.arange(n + 1))]

    def _slots(self, names: np.ndarray, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Place of every piece in the young store; new ones are encoded."""
        if self.store.used > self.most:
            self.former, self.store = self.store, PieceStore()
        slots = self.store.find(names)
        lack = np.flatnonzero(slots < 0)
        if len(lack):
            new, first = np.unique(names[lack], return_index=True)
            old = self.former.find(new)
            parts = [self.former.ids[a:b] for a, b in zip(*self.former.spans(old[old >= 0]), strict=True)]
            where = lack[first[old < 0]].tolist()
            for at in range(0, len(where), 20_000):
                own = [buf[start[j]:end[j]].tobytes().decode() for j in where[at:at + 20_000]]
                parts += [e.ids for e in self.tok.encode_batch_fast(own, add_special_tokens=False)]
            self.store.add(np.concatenate([new[old >= 0], new[old < 0]]), parts)
            slots[lack] = self.store.find(names[lack])
        return slots


class PieceStore:
    """Ids of pieces by 64-bit name, in an open-addressing table of numpy
    arrays, so that a whole batch is looked up at once."""

    def __init__(self, bits: int = 16):
        self.begins, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.names, self.used = np.zeros(0, np.uint32), np.zeros(0, np.uint64), 0
        self._empty(bits)

    def _empty(self, bits: int) -> None:
        self.bits = bits
        self.keys, self.places = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)

    def find(self, names: np.ndarray) -> np.ndarray:
        """Place of each name, -1 for an unknown one."""
        out = np.full(len(names), -1, np.int64)
        live, at = np.arange(len(names)), (names >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(live):
            place = self.places[at]
            same = (place >= 0) & (self.keys[at] == names[live])
            out[live[same]] = place[same]
            on = (place >= 0) & ~same
            live, at = live[on], (at[on] + 1) & ((1 << self.bits) - 1)
        return out

    def spans(self, places: np.ndarray) -> tuple[list[int], list[int]]:
        return self.begins[places].tolist(), (self.begins[places] + self.sizes[places]).tolist()

    def add(self, names: np.ndarray, parts: list) -> None:
        """Names not yet known, each with its ids."""
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        more = np.fromiter(chain.from_iterable(parts), np.uint32, int(lengths.sum()))
        self.begins = np.concatenate([self.begins, len(self.ids) + np.cumsum(lengths) - lengths])
        self.sizes, self.ids = np.concatenate([self.sizes, lengths]), np.concatenate([self.ids, more])
        known, self.names = len(self.names), np.concatenate([self.names, names])
        self.used += len(more)
        if len(self.names) > 1 << (self.bits - 1):
            self._empty(max(self.bits + 2, int(2 * len(self.names)).bit_length()))
            known = 0
        self._place(self.names[known:], np.arange(known, len(self.names)))

    def _place(self, names: np.ndarray, places: np.ndarray) -> None:
        at = (names >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(names):
            free = np.flatnonzero(self.places[at] < 0)
            _, one = np.unique(at[free], return_index=True)  # one name for each free slot
            won = free[one]
            self.keys[at[won]], self.places[at[won]] = names[won], places[won]
            left = np.ones(len(names), bool)
            left[won] = False
            names, places, at = names[left], places[left], at[left]
            taken = self.places[at] >= 0
            at = np.where(taken, (at + 1) & ((1 << self.bits) - 1), at)


@lru_cache(maxsize=2)
def piece_encoder(path: str, drops_space: bool = False) -> PieceEncoder:
    """One encoder per worker process: what it remembers lasts over tasks."""
    return PieceEncoder(path, drops_space)
