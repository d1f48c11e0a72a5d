"""BPE encoding and decoding by a table of distinct words.

``encode`` cuts every text into words and stores, in blocks of whole documents, each
block's distinct words once and every document as numbers of its block's words.  The
blocks' words are then brought together by word: equal words stand next to each other and
make one row of the table of distinct words, which is encoded once.  The ids go back by
position: to the numbers of the blocks that hold the word, and in each block to its
documents.  The stored blocks are bucketed by block, so the documents themselves are never
shuffled: only words and their ids travel, a word once per block.

``decode`` joins the distinct ids of every batch of documents with the table of pieces,
which is as long as the vocabulary, and puts the pieces at the ids' positions.

Words are those of the byte-level pre-tokenizer: optional space and letters, digits or
other characters, contractions, white space; strings of added tokens are words of their
own, found before all others.  Merges are exact: always the pair of the lowest rank, the
leftmost among equals.

Defined cases: null and empty text give no ids, a null list of ids decodes to the empty
text.  Bytes that are no UTF-8 decode to U+FFFD.  All other columns are kept, whatever
their names; ``text`` is kept on request.  An empty table gives an empty table, repeated
rows are kept.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lacuna.llm import textwork as tw
from lacuna.session import new_path
from lacuna.sources.tables import write_bucketed

BLOCK_BYTES = 24 << 20
SLICE_CODES = 1 << 18  # bytes of word numbers, or ids, that are put together at a time
LIST_WORDS = 4096  # words of a block in one stored row
PACK_ROWS = 400_000
SHORT = 200  # bytes up to which a word is merged by scanning its pairs
OTHER, LETTER, NUMBER, SPACE = range(4)
_BLOCK_BITS = 24


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of every code point.  Where two libraries' Unicode versions differ (letters
    and digits of the last years), the pre-tokenizer that is to be matched is asked."""
    from tokenizers.pre_tokenizers import ByteLevel  # the driver alone asks; tasks stay small

    every = "".join(chr(c) if not 0xD800 <= c < 0xE000 else "\0" for c in range(0x110000))
    table = np.zeros(0x110000, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, every):
            table[m.start() : m.end()] = kind
    other = np.frombuffer("".join(unicodedata.category(c)[0] for c in every).encode(), np.uint8)
    differ = ((table == LETTER) != (other == ord("L"))) | ((table == NUMBER) != (other == ord("N")))
    asked = ByteLevel(add_prefix_space=False, use_regex=True)
    kinds = {((0, 2), (2, 3)): LETTER, ((0, 1), (1, 3)): NUMBER, ((0, 1), (1, 2), (2, 3)): OTHER}
    for c in np.flatnonzero(differ):
        table[c] = kinds[tuple(place for _, place in asked.pre_tokenize_str(f"a{every[c]}1"))]
    return table


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable
    Latin-1 characters for themselves, all others in order from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Vocabulary:
    """A byte-level BPE model: word boundaries, merges and pieces."""

    def __init__(self, packed: tuple[bytes, bytes]):
        spec = json.loads(zlib.decompress(packed[0]))
        self.kinds = np.frombuffer(zlib.decompress(packed[1]), np.uint8)
        model, kind = spec["model"], (spec.get("pre_tokenizer") or {})
        plain = kind.get("type") == "ByteLevel" and kind.get("use_regex", True) and not kind.get("add_prefix_space")
        odd = [k for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges") if model.get(k)]
        if model["type"] != "BPE" or not plain or odd or spec.get("normalizer"):
            raise ValueError("not a plain byte-level BPE vocabulary")
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec.get("added_tokens", [])):
            raise ValueError("added tokens with conditions on their neighbours are not supported")
        self.vocab = model["vocab"]
        byte_of = byte_alphabet()
        self.byte_ids = [0] * 256
        for char, byte in byte_of.items():
            self.byte_ids[byte] = self.vocab[char]
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
        self.ranks = {(self.vocab[a], self.vocab[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.made = [self.vocab[a + b] for a, b in pairs]
        longest_first = sorted(self.added, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, longest_first))) if longest_first else None

    def pieces(self) -> list[tuple[int, bytes]]:
        """Id and bytes of every piece, added tokens as they are written."""
        byte_of = byte_alphabet()
        own = [(i, bytes(byte_of[c] for c in token)) for token, i in self.vocab.items() if token not in self.added]
        return own + [(i, content.encode()) for content, i in self.added.items()]

    def ids(self, word: str) -> list[int]:
        """Ids of one word."""
        special = self.added.get(word)
        if special is not None:
            return [special]
        ids = [self.byte_ids[b] for b in word.encode()]
        return self._scan(ids) if len(ids) <= SHORT else self._heap(ids)

    def _scan(self, ids: list[int]) -> list[int]:
        rank_of, none = self.ranks.get, len(self.made)
        ranks = [rank_of(pair, none) for pair in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            ids[i] = self.made[best]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank_of((ids[i - 1], ids[i]), none)
            if i < len(ranks):
                ranks[i] = rank_of((ids[i], ids[i + 1]), none)
        return ids

    def _heap(self, ids: list[int]) -> list[int]:
        """The same for long words: pairs in a heap by (rank, place), neighbours linked."""
        ranks, n = self.ranks, len(ids)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(ranks[p], i, *p) for i, p in enumerate(zip(ids, ids[1:])) if p in ranks]
        heapq.heapify(heap)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue  # one of the two is merged meanwhile
            ids[i], ids[j] = self.made[rank], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (ids[a], ids[b]) in ranks:
                    heapq.heappush(heap, (ranks[ids[a], ids[b]], a, ids[a], ids[b]))
        return [i for i in ids if i >= 0]


@lru_cache(maxsize=2)
def vocabulary(packed: tuple[bytes, bytes]) -> Vocabulary:
    """The vocabulary of a task's process."""
    return Vocabulary(packed)


def load(path: str) -> tuple[bytes, bytes]:
    """A vocabulary file and the classes of characters, as shipped to the tasks: both are
    read once, on the driver."""
    with open(path, "rb") as source:
        return zlib.compress(source.read()), zlib.compress(classes().tobytes())


def cut(part: tw.Slice, own: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions at which the words of a slice begin, and at which each document's
    words begin in that list; the words cover all bytes."""
    whole = part.data.tobytes().decode()
    point = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    n = len(point)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(part.rows + 1, np.int64)
    width = 1 + (point >= 0x80).astype(np.int64) + (point >= 0x800) + (point >= 0x10000)
    byte_at = np.concatenate([[0], np.cumsum(width)])
    doc_at = np.searchsorted(byte_at, part.offsets)  # documents begin at characters
    kind = own.kinds[point]
    hard = np.zeros(n + 1, bool)
    hard[doc_at] = True
    hard[n] = True
    inside = np.zeros(n, bool)
    if own.special is not None and own.special.search(whole):
        for a, b in zip(doc_at[:-1], doc_at[1:]):
            for m in own.special.finditer(whole[a:b]):
                hard[[a + m.start(), a + m.end()]] = True
                inside[a + m.start() + 1 : a + m.end()] = True
    begins = hard[:n].copy()
    begins[1:] |= kind[1:] != kind[:-1]
    # the last of several spaces before a word is a word of its own or, U+0020, its beginning
    word = np.flatnonzero((kind[1:] != SPACE) & (kind[:-1] == SPACE) & ~hard[1:n]) + 1
    begins[word - 1] = True
    begins[word[point[word - 1] == 0x20]] = False
    # 's 't 'm 'd 're 've 'll, when the apostrophe begins a word
    quote = np.flatnonzero((point[:-1] == 0x27) & begins[:-1] & ~hard[1:n])
    one = quote[np.isin(point[quote + 1], [ord(c) for c in "stmd"])]
    two = quote[quote + 2 < n]
    two = two[~hard[two + 2]]
    pair = point[two + 1].astype(np.int64) << 32 | point[two + 2]
    two = two[np.isin(pair, [ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")])]
    begins[one + 1] = False
    begins[two + 1] = False
    for ends in (one + 2, two + 3):
        begins[ends[ends < n]] = True
    begins[inside] = False
    starts = np.flatnonzero(begins)
    return byte_at[starts], np.searchsorted(starts, doc_at)


def to_varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers below 2^28 as 7-bit groups, low ones first; and where each begins."""
    width = 1 + (values >= 1 << 7).astype(np.uint8) + (values >= 1 << 14) + (values >= 1 << 21)
    at = np.concatenate([[0], np.cumsum(width, dtype=np.int64)])
    out = np.zeros(at[-1], np.uint8)
    for k in range(4):
        has = width > k
        out[at[:-1][has] + k] = (values[has] >> (7 * k) & 127) | ((width[has] > k + 1) << 7)
    return out, at


def from_varints(data: np.ndarray) -> np.ndarray:
    if len(data) == 0:
        return np.zeros(0, np.int64)
    begins = np.flatnonzero(np.concatenate([[True], data[:-1] < 128]))
    sizes = np.diff(np.concatenate([begins, [len(data)]]))
    place = np.arange(len(data)) - np.repeat(begins, sizes)
    return np.add.reduceat((data & 127).astype(np.int64) << 7 * place, begins)


def _flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary column end to end, and where each value begins."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every range, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


def _cutter(packed: tuple[bytes, bytes], kept: int, schema: T.StructType) -> Callable:
    """Stored blocks: one row per document with its words' numbers, one row per word."""

    def block(number: int, batches: list[pa.RecordBatch], own: Vocabulary) -> Iterator[pa.RecordBatch]:
        parts, per_doc = [], [np.zeros(1, np.int64)]
        for batch in batches:
            for part in tw.slices(batch.column("text")):
                starts, doc_at = cut(part, own)
                ends = np.concatenate([starts, [len(part.data)]]).astype(np.int32)
                words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(part.data))
                parts.append(words.dictionary_encode())  # a slice's words are let go at once
                per_doc.append(per_doc[-1][-1] + doc_at[1:])
        found = pa.chunked_array(parts, pa.dictionary(pa.int32(), pa.string())).unify_dictionaries()
        distinct = found.chunk(0).dictionary if parts else pa.array([], pa.string())
        del parts
        code = np.concatenate([c.indices.to_numpy() for c in found.chunks] or [np.zeros(0, np.int32)])
        del found
        order = np.argsort(-np.bincount(code, minlength=len(distinct)), kind="stable")
        number_of = np.empty(len(order), np.int32)
        number_of[order] = np.arange(len(order))  # frequent words get small numbers
        word_at = np.concatenate(per_doc)
        done = 0
        for batch in batches:
            own_words = word_at[done : done + batch.num_rows + 1]
            data, at = to_varints(number_of[code[own_words[0] : own_words[-1]]])
            edges = at[own_words - own_words[0]].astype(np.int32)
            rows = batch.num_rows
            docs = pa.BinaryArray.from_buffers(pa.binary(), rows, [None, pa.py_buffer(edges), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k + 1) for k in range(kept)), pa.array(np.full(rows, number)), docs,
                 pa.nulls(rows, pa.list_(pa.string())), pa.nulls(rows, pa.int32())],
                schema.names,
            )
            done += rows
        types = [batches[0].column(k + 1).type for k in range(kept)]
        firsts = np.arange(0, len(order), LIST_WORDS, dtype=np.int32)
        rows = len(firsts)
        lists = pa.ListArray.from_arrays(
            pa.array(np.append(firsts, len(order)).astype(np.int32)), distinct.take(pa.array(order))
        )
        yield pa.RecordBatch.from_arrays(
            [*(pa.nulls(rows, t) for t in types), pa.array(np.full(rows, number)), pa.nulls(rows, pa.binary()),
             lists, pa.array(firsts)],
            schema.names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(packed)
        number = TaskContext.get().partitionId() << _BLOCK_BITS
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if held and sum(b.column("text").nbytes for b in [*held, batch]) > BLOCK_BYTES:
                yield from block(number, held, own)
                number, held = number + 1, []
                pa.default_memory_pool().release_unused()
            held.append(batch)
        if held:
            yield from block(number, held, own)

    return run


def _encoder(packed: tuple[bytes, bytes]) -> Callable:
    """Ids of words that come in order, each distinct word encoded once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = vocabulary(packed).ids
        last, of_last = None, None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            words = batch.column("word").dictionary_encode()
            distinct = words.dictionary.to_pylist()
            encoded = [of_last if w == last else ids(w) for w in distinct]
            last, of_last = distinct[-1], encoded[-1]
            every = pa.array(encoded, pa.list_(pa.int32())).take(words.indices)
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("number"), every], ["block", "number", "ids"])

    return lambda batches: _pack(run(batches))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of words by block in few rows: word numbers as gaps, ids per word, ids."""

    def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).sort_by([("block", "ascending"), ("number", "ascending")]).combine_chunks()
        blocks, number = table["block"].to_numpy(), table["number"].to_numpy()
        ids = table["ids"].chunk(0) if table["ids"].num_chunks == 1 else table["ids"].combine_chunks()
        sizes = ids.value_lengths().to_numpy()
        flat = ids.flatten().to_numpy()
        at = np.concatenate([[0], np.cumsum(sizes)])
        edges = np.flatnonzero(np.concatenate([[True], blocks[1:] != blocks[:-1], [True]]))
        out: list[tuple] = []
        for a, b in zip(edges[:-1], edges[1:]):
            gaps = np.diff(number[a:b].astype(np.int64), prepend=0)
            parts = (gaps, sizes[a:b].astype(np.int64), flat[at[a] : at[b]].astype(np.int64))
            out.append((int(blocks[a]), *(to_varints(p)[0].tobytes() for p in parts)))
        columns = list(zip(*out))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), *(pa.array(c, pa.binary()) for c in columns[1:])],
            ["block", "gaps", "sizes", "ids"],
        )

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= PACK_ROWS:
            yield flush(held)
            held = []
            pa.default_memory_pool().release_unused()
    held = [b for b in held if b.num_rows]
    if held:
        yield flush(held)


def _gatherer(kept: int, into_at: int, schema: pa.Schema) -> Callable:
    def gather(docs: pa.Table, ids: pa.Table) -> pa.Table:
        if docs.num_rows == 0:
            return schema.empty_table()
        numbers, sizes, flats = [], [], []
        for row in range(ids.num_rows):
            gaps, size, flat = (
                from_varints(np.frombuffer(ids[c][row].as_py(), np.uint8)) for c in ("gaps", "sizes", "ids")
            )
            numbers.append(np.cumsum(gaps))
            sizes.append(size)
            flats.append(flat)
        number, size, flat = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (numbers, sizes, flats))
        begin, length = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
        begin[number], length[number] = np.cumsum(size) - size, size
        data, bounds = _flat(docs["words"])
        parts, first = [], 0
        while first < docs.num_rows:
            last = int(np.searchsorted(bounds, bounds[first] + SLICE_CODES, "right")) - 1
            last = min(max(last, first + 1), docs.num_rows)
            own = data[bounds[first] : bounds[last]]
            words = from_varints(own)
            # a document's words end where its bytes do
            ends = np.concatenate([[0], np.cumsum(own < 128)])[bounds[first : last + 1] - bounds[first]]
            count = length[words]
            tokens = flat[_ranges(begin[words], count)].astype(np.int32)
            offsets = np.concatenate([[0], np.cumsum(count)])[ends].astype(np.int32)
            parts.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(tokens)))
            first = last
        columns: list = [docs[f"c{k}"] for k in range(kept)]
        columns.insert(into_at, pa.chunked_array(parts))
        pa.default_memory_pool().release_unused()
        return pa.Table.from_arrays(columns, schema=schema)

    return gather


def encode(docs: DataFrame, path: str, text: str = "text", into: str = "tokens", keep_text: bool = False) -> DataFrame:
    """``docs`` with the ids of ``text`` by the vocabulary file ``path`` in the array column
    ``into``; blocks are bucketed into as many parts as the session's shuffles have."""
    spark = docs.sparkSession
    tw.prepare(spark)
    packed = load(path)
    kept = [f for f in docs.schema.fields if f.name != into and (keep_text or f.name != text)]
    own = [T.StructField(f"c{k}", f.dataType) for k, f in enumerate(kept)]
    plain = docs.select(
        F.col(f"`{text}`").cast("string").alias("text"), *[F.col(f"`{f.name}`").alias(f"c{k}") for k, f in enumerate(kept)]
    )
    schema = T.StructType(
        [
            *own,
            T.StructField("block", T.LongType()),
            T.StructField("words", T.BinaryType()),
            T.StructField("list", T.ArrayType(T.StringType())),
            T.StructField("first", T.IntegerType()),
        ]
    )
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = write_bucketed(
        plain.mapInArrow(_cutter(packed, len(kept), schema), schema),
        f"words_{uuid.uuid4().hex}", "block", buckets, path=new_path(spark, "words"),
    )

    listed = stored.where("list is not null").select("block", "first", F.posexplode("list").alias("place", "word"))
    by_word = listed.select("block", (F.col("first") + F.col("place")).alias("number"), "word").repartition(buckets, "word")
    sent = by_word.sortWithinPartitions("word").mapInArrow(
        _encoder(packed), "block long, gaps binary, sizes binary, ids binary"
    )
    rows = stored.where("words is not null").drop("list", "first")
    tokens = T.StructField("tokens", T.ArrayType(T.IntegerType()))
    out = T.StructType([*own, tokens])
    found = rows.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(
        _gatherer(len(kept), len(kept), to_arrow_schema(out)), out
    )
    return found.toDF(*[f.name for f in kept], into)


def _with_dictionary(kept: int, schema: T.StructType) -> Callable:
    """Each batch's distinct ids, a row each, and then its documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in enumerate(batches):
            ids = batch.column("tokens")
            distinct = ids.flatten().unique().drop_null()
            rows, n = batch.num_rows, len(distinct)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, number)), pa.array(np.full(n, n, np.int32)), distinct, pa.nulls(n, ids.type),
                 *(pa.nulls(n, batch.column(k + 1).type) for k in range(kept))],
                schema.names,
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(rows, number)), pa.array(np.full(rows, n, np.int32)), pa.nulls(rows, pa.int32()), ids,
                 *(batch.column(k + 1) for k in range(kept))],
                schema.names,
            )

    return run


def _put_pieces(kept: int, names: list[str]) -> Callable:
    """Texts of the documents from the pieces that came before them."""

    def texts(ids: pa.ListArray, known: np.ndarray, data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> pa.Array:
        flat = ids.flatten().to_numpy(zero_copy_only=False)
        lengths = ids.value_lengths().fill_null(0).to_numpy()
        at = np.searchsorted(known, flat).astype(np.int32)
        to = np.concatenate([[0], np.cumsum(size[at])])
        raw = np.empty(to[-1], np.uint8)
        for a in range(0, len(at), SLICE_CODES):
            part = at[a : a + SLICE_CODES]
            raw[to[a] : to[a + len(part)]] = data[_ranges(begin[part], size[part])]
        ends = to[np.concatenate([[0], np.cumsum(lengths)])]
        try:  # valid as a whole and cut at characters, so valid in every part
            raw.tobytes().decode()
            cut_inside = (raw[ends[ends < len(raw)]] & 0xC0) == 0x80
            if not cut_inside.any():
                return pa.StringArray.from_buffers(
                    len(ids), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(raw)
                )
        except UnicodeDecodeError:
            pass
        return pa.array([raw[a:b].tobytes().decode(errors="replace") for a, b in zip(ends[:-1], ends[1:])], pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, tables = -1, [], None
        for batch in batches:
            of, is_id = batch.column("batch").to_numpy(), batch.column("id").is_valid().to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (is_id[1:] != is_id[:-1]), [True]]))
            for a, b in zip(edges[:-1], edges[1:]):
                part = batch.slice(a, b - a)
                if of[a] != number:
                    number, held, tables = of[a], [], None
                if is_id[a]:
                    held.append(part.select(["id", "piece"]))
                    continue
                if tables is None:
                    tables = _dictionary(held, part.column("distinct")[0].as_py())
                columns = [part.column(f"c{k}") for k in range(kept)]
                yield pa.RecordBatch.from_arrays([*columns, texts(part.column("tokens"), *tables)], names)

    return run


def _dictionary(held: list[pa.RecordBatch], expected: int) -> tuple[np.ndarray, ...]:
    """Ids in order, the bytes of their pieces, and where each begins and how long it is."""
    if sum(b.num_rows for b in held) != expected:
        raise RuntimeError("pieces did not arrive before their documents")
    if expected == 0:
        none = np.zeros(0, np.int64)
        return none, np.zeros(0, np.uint8), none, none
    table = pa.Table.from_batches(held).sort_by("id")
    if table["piece"].null_count:
        raise ValueError("an id outside the vocabulary")
    data, offsets = _flat(table["piece"])
    return table["id"].to_numpy(), data, offsets[:-1], np.diff(offsets)


def decode(docs: DataFrame, path: str, tokens: str = "tokens", into: str = "decoded") -> DataFrame:
    """``docs`` with the text of the ids in ``tokens`` in the column ``into``; an id outside
    the vocabulary is an error.

    The table of pieces has a row per id of the vocabulary file, whatever the documents: it
    is broadcast, so distinct ids meet their pieces in the task that holds their documents.
    """
    spark = docs.sparkSession
    tw.prepare(spark)
    kept = [f for f in docs.schema.fields if f.name != into]
    own = [T.StructField(f"c{k}", f.dataType) for k, f in enumerate(kept)]
    ids_type = T.ArrayType(T.IntegerType())
    plain = docs.select(
        F.col(f"`{tokens}`").cast(ids_type).alias("tokens"), *[F.col(f"`{f.name}`").alias(f"c{k}") for k, f in enumerate(kept)]
    )
    schema = T.StructType(
        [
            T.StructField("batch", T.LongType()),
            T.StructField("distinct", T.IntegerType()),
            T.StructField("id", T.IntegerType()),
            T.StructField("tokens", ids_type),
            *own,
        ]
    )
    pieces = spark.createDataFrame(Vocabulary(load(path)).pieces(), "id int, piece binary")
    joined = plain.mapInArrow(_with_dictionary(len(kept), schema), schema).join(F.broadcast(pieces), "id", "left")
    out = T.StructType([*own, T.StructField("text", T.StringType())])
    return joined.mapInArrow(_put_pieces(len(kept), out.names), out).toDF(*[f.name for f in kept], into)
