"""Byte-level BPE by backtracking over longest matches.

``encode`` adds an ``array<int>`` of token ids to documents, ``decode`` turns such an
array back into bytes.  A text is cut by the vocabulary's pattern; each piece is
encoded on its own.  The bytes of a piece, as Latin-1 characters, go through a
pyahocorasick automaton once, which gives the longest token at every position.  The
encoder takes the longest token, accepts it if it is compatible with the token before
it (the two would not have been merged otherwise, memoised per pair), falls back to the
next shorter prefix token, and steps back if none is left.  A position from which no
encoding continues is marked, so each is tried once: the work is linear in the piece
for a vocabulary with bounded token length, and the result is the one exact merging
gives.  The ids of short stretches between spaces are
memoised per Python process in two generations of ``MEMO_STRETCHES`` entries; a stretch
of several pieces (a word and its punctuation) is put together from theirs.

Null text counts as empty and gives an empty array.  Every other column is kept.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lacuna.llm import textwork as tw

MEMO_STRETCHES = 240_000
MEMO_BRIEF = 60_000  # entries where memos end with their task
PAIRS_KNOWN = 500_000
MEMO_CHARS = 48
ROWS = 250  # documents worked on at once
_SPACES = re.compile(r"\s\x20|\x20\s")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and rank of each line of a rank file."""
    with open(path, "rb") as source:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, source)}


class Encoder:
    """One vocabulary: exact byte-pair merging of single pieces, and decoding."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.split: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.compatible: dict[tuple[int, int], bool] = {}
        self.shorter: dict[int, int] = {}
        self.size = [0] * (max(ranks.values(), default=0) + 1)
        self.automaton = ahocorasick.Automaton()
        for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
            halves = self._halves(token, rank)
            if halves is None:  # merging never reaches it; only a whole piece can be it
                continue
            self.split[rank] = halves
            if len(token) > 1:
                self.merged[halves] = rank
            self.size[rank] = len(token)
            self.automaton.add_word(token.decode("latin-1"), (len(token) - 1, rank))
        self.automaton.make_automaton()
        for rank in self.split:
            token = self.bytes_of[rank]
            for n in range(len(token) - 1, 0, -1):
                prefix = ranks.get(token[:n])
                if prefix in self.split:
                    self.shorter[rank] = prefix
                    break

    def _halves(self, token: bytes, rank: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; a single byte is its own."""
        if len(token) == 1:
            return rank, rank
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best, at = rank, -1
            for i in range(len(parts) - 1):
                r = self.ranks.get(parts[i] + parts[i + 1], rank)
                if r < best:
                    best, at = r, i
            if at < 0:
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        left, right = (self.ranks.get(p) for p in parts)
        return None if left not in self.split or right not in self.split else (left, right)

    def _pair(self, left: int, right: int) -> bool:
        """Whether merging would leave these two neighbours apart.

        Undo the later of the merges at the seam step by step; whenever the two
        pieces at the seam make a token that merging would have preferred to what
        was undone, the neighbours cannot stand.
        """
        known = self.compatible.get((left, right))
        if known is not None:
            return known
        a, b, limit, answer = left, right, len(self.bytes_of) + (1 << 31), True
        while True:
            made = self.merged.get((a, b))
            if made is not None and made < limit:
                answer = False
                break
            whole_a, whole_b = self.split[a][1] == a, self.split[b][0] == b
            if whole_a and whole_b:
                break
            if whole_b or (a > b and not whole_a):
                limit, a = a, self.split[a][1]
            else:
                limit, b = b + 1, self.split[b][0]
        if len(self.compatible) >= PAIRS_KNOWN:
            self.compatible.clear()
        self.compatible[left, right] = answer
        return answer

    def piece(self, piece: bytes) -> list[int]:
        """Token ids of one piece."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        longest = [-1] * n
        size = self.size
        # matches come by their ends, so the last one from a start is its longest
        for end, (length, token) in self.automaton.iter(piece.decode("latin-1")):
            longest[end - length] = token
        known = self.compatible
        open_at = bytearray(b"\x01") * (n + 1)
        ids: list[int] = []
        at = 0
        token = longest[0]
        while at < n:
            last = ids[-1] if ids else -1
            while True:
                end = at + size[token]
                fits = open_at[end]
                if fits and last >= 0:
                    fits = known.get((last, token))
                    if fits is None:
                        fits = self._pair(last, token)
                if fits:
                    ids.append(token)
                    at = end
                    token = longest[at] if at < n else -1
                    break
                smaller = self.shorter.get(token, -1)
                if smaller < 0:
                    open_at[at] = 0
                    token = ids.pop()
                    at -= size[token]
                    break
                token = smaller
        return ids


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The task's encoder for a rank file; the path must exist on every machine."""
    return Encoder(read_ranks(path))


@lru_cache(maxsize=2)
def token_bytes(path: str) -> pa.Array:
    """Bytes of each id of a rank file, null for numbers that are no id."""
    bytes_of = {rank: token for token, rank in read_ranks(path).items()}
    return pa.array(map(bytes_of.get, range(max(bytes_of, default=-1) + 1)), pa.large_binary())


class _Memo(dict):
    """Packed ids of stretches met before.

    ``lead`` is put before each key: a stretch is what follows one space.  When it is
    full it becomes the older generation and starts anew; a key still in use comes back
    from there.  ``rest`` is the memo of pieces without that space.
    """

    def __init__(self, own: Encoder, cut, lead: str, most: int, rest: _Memo | None = None):
        super().__init__()
        self.own, self.cut, self.lead, self.most = own, cut, lead, most
        self.rest = self if rest is None else rest
        self.older: dict[str, bytes] = {}

    def __missing__(self, stretch: str) -> bytes:
        packed = self.older.get(stretch)
        if packed is None:
            pieces = self.cut.findall(self.lead + stretch)
            if len(pieces) < 2:
                packed = b"".join([array("i", self.own.piece(p.encode())).tobytes() for p in pieces])
            else:
                own = self.lead and pieces[0].startswith(self.lead)
                begin = self[pieces[0][len(self.lead) :]] if own else self.rest[pieces[0]]
                packed = begin + b"".join([self.rest[p] for p in pieces[1:]])
        if len(stretch) <= MEMO_CHARS:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[stretch] = packed
        return packed


@lru_cache(maxsize=2)
def _memos(path: str, pattern: str, most: int = MEMO_STRETCHES) -> tuple[_Memo, _Memo]:
    """Memos of a Python process: after a space, and at the beginning of a text."""
    cut = regex.compile(pattern)
    first = _Memo(encoder(path), cut, "", most)
    return _Memo(encoder(path), cut, " ", most, first), first


def _encoded(value: str, memo: _Memo, first: _Memo) -> bytes:
    """Packed ids of a text, stretch by stretch between single spaces.

    No match of the pattern runs from another character into a space, so a text may
    be cut before any space whose neighbours are no white space.
    """
    if _SPACES.search(value):
        return b"".join([array("i", memo.own.piece(m[0].encode())).tobytes() for m in memo.cut.finditer(value)])
    stretches = value.split(" ")
    return first[stretches[0]] + b"".join(map(memo.__getitem__, stretches[1:]))


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``ROWS`` at most, so that little of them is held as lists."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", into: str = "tokens", keep: bool = True) -> DataFrame:
    """``docs`` with the token ids of ``text`` in the array column ``into``.

    With ``keep`` a Python process keeps its encoder and memos for its next tasks, which
    saves time; without it they are given up with each task, which saves memory.

    ``pattern`` cuts a text into pieces; a space may only begin a match or stand
    within white space, and a match cut on its own is one match again, as in the public
    byte-level vocabularies.
    """
    tw.prepare(docs.sparkSession)
    kept = [f for f in docs.schema.fields if f.name != into]
    schema = T.StructType([*kept, T.StructField(into, T.ArrayType(T.IntegerType(), False), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, first = _memos(path, pattern, MEMO_STRETCHES if keep else MEMO_BRIEF)
        for batch in _small(batches):
            packed = [_encoded(v, memo, first) if v else b"" for v in batch.column(text).to_pylist()]
            ends = np.cumsum([0, *map(len, packed)]) // 4
            flat = np.frombuffer(b"".join(packed), np.int32)
            tokens = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
            columns = [batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, tokens], [*(f.name for f in kept), into])

    return docs.select(*[F.col(f"`{f.name}`") for f in kept]).mapInArrow(tw.tidy(run, *(() if keep else (_memos, encoder))), schema)


def decode(docs: DataFrame, path: str, tokens: str = "tokens", into: str = "decoded") -> DataFrame:
    """``docs`` with the bytes of ``tokens`` in the binary column ``into``.

    A null array gives empty bytes; an id outside the vocabulary is an error.
    """
    tw.prepare(docs.sparkSession)
    kept = [f for f in docs.schema.fields if f.name != into]
    schema = T.StructType([*kept, T.StructField(into, T.BinaryType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(path)
        for batch in _small(batches):
            ids = batch.column(tokens)
            flat = ids.flatten()
            found = table.take(flat)
            if found.null_count:
                raise KeyError(f"token ids outside the vocabulary: {flat.filter(found.is_null()).unique().to_pylist()[:10]}")
            sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(False)
            ends = np.zeros(len(ids) + 1, np.int64)
            if len(found):
                ends[1:] = np.frombuffer(found.buffers()[1], np.int64)[np.cumsum(sizes)]
            out = pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(ends), found.buffers()[2] or pa.py_buffer(b"")])
            columns = [batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, out.cast(pa.binary())], [*(f.name for f in kept), into])

    return docs.select(*[F.col(f"`{f.name}`") for f in kept]).mapInArrow(tw.tidy(run), schema)
