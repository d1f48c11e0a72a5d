"""Benchmark passages in training documents: spaced word triples, then local alignment.

1. Seeds of an item are all its triples of words that stand in order within ``REACH``
   words, whatever lies between.  Documents are scanned for the same triples.
2. Hits of one item that follow each other closely form a cluster.  It goes on if it has
   as many hits as every copy of the threshold's score must have (``needed``).
3. Smith-Waterman alignment of words (match 2, mismatch -1, gap -1) between the words
   around the cluster and the item finds the best local copy, edited or not.  The score
   is divided by that of the whole item copied exactly.

No copy of the threshold or more is lost: of m matched words with edits of total cost
E = 2 m - 2 t L at most (L words of the item, threshold t), (m - 2) / 2 - E / 3 or more
of every second triple have edits of cost 2 at most between them, so they span
``REACH`` words at most on both sides.  At t = 0.5 that is L / 6 - 1 triples or more:
one at least for items of 7 words.  Of shorter items, copies that hold no such triple,
and items of fewer than ``SEED`` words at all, are never reported.

The scan looks triples up in a bitmap of fixed size (``textwork.FILTER_BITS``) made from
the items, whatever their number; the join after it is exact, so false hits only cost
time.  Words are runs of letters and digits, case-folded in all scripts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.llm import textwork as tw
from lacuna.session import cut_lineage

SEED, REACH = 3, 5
_SHAPES = [(a, b) for b in range(2, REACH) for a in range(1, b)]
THRESHOLD = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
_CELLS = 100_000  # alignment cells worked on at once: a few arrays of them stay in the cache


def folded(text: pa.Array) -> pa.Array:
    """Texts case-folded; ASCII is left to the hashing of words."""
    plain = pc.fill_null(pc.string_is_ascii(text), True)
    if pc.all(plain).as_py() in (True, None):
        return text
    return pa.array([t if ok else t.casefold() for t, ok in zip(text.to_pylist(), plain.to_pylist())], text.type)


def triples(found: tw.Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprint, document and first word of all spaced triples inside documents."""
    parts = []
    owner = np.repeat(np.arange(len(found.bounds) - 1), np.diff(found.bounds))
    for a, b in _SHAPES:
        n = max(0, len(found.hashes) - b)
        first = np.flatnonzero(owner[:n] == owner[b : b + n])
        gram = np.zeros(len(first), tw.U64)
        for k in (0, a, b):
            gram = gram * tw.U64(tw._STEP) + found.hashes[first + k]
        parts.append((tw.mix(gram + tw.U64(SEED)), owner[first], first))
    return tuple(np.concatenate(x) for x in zip(*parts))


def span(size: np.ndarray, threshold: float) -> np.ndarray:
    """Most words of text that a copy of the threshold's score can take."""
    return np.ceil((3 - 2 * threshold) * size - 1e-9).astype(np.int64)


def needed(size: np.ndarray, threshold: float) -> np.ndarray:
    """Fewest hits, counted by first word, of a copy of the threshold's score."""
    return np.maximum(1, np.ceil((4 * threshold - 1) * size / 6 - 1 - 1e-9)).astype(np.int64)


def _item_words(items: DataFrame, text: str, item_id: str) -> DataFrame:
    """``item_id, words, grams``; the longest text of a repeated id, null text empty."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for part in tw.slices(folded(batch.column(1))):
                found = tw.words(part, tw.NOT_ALNUM)
                grams, doc, _ = triples(found)
                order = np.argsort(doc, kind="stable")
                grams, bounds = grams[order], np.searchsorted(doc[order], np.arange(part.rows + 1))
                columns = [ids.slice(part.first, part.rows)]
                for values, at in ((found.hashes, found.bounds), (grams, bounds)):
                    columns.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(tw.signed(values))))
                yield pa.RecordBatch.from_arrays(columns, ["item_id", "words", "grams"])

    rows = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text"))
    rows = rows.where("item_id is not null").mapInArrow(tw.tidy(work), "item_id long, words array<long>, grams array<long>")
    return rows.groupBy("item_id").agg(F.max_by(F.struct("words", "grams"), F.struct(F.size("words"), "words")).alias("x")).select(
        "item_id", "x.words", "x.grams"
    )


def hits(docs: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """``id, body, gram, word``: triples of documents that may be in the bitmap."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tw.slices(folded(batch.column("text"))):
                found = tw.words(part, tw.NOT_ALNUM)
                grams, doc, first = triples(found)
                hit = np.flatnonzero(tw.in_bitmap(grams, bitmap))
                take = pa.array(doc[hit] + part.first)
                word = (first[hit] - found.bounds[doc[hit]]).astype(np.int32)
                columns = [batch.column(c).take(take) for c in ("id", "body")]
                columns += [pa.array(tw.signed(grams[hit])), pa.array(word)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "body", "gram", "word"])

    return docs.mapInArrow(tw.tidy(work), "id long, body long, gram long, word int")


def clusters(found: DataFrame, threshold: float) -> DataFrame:
    """``id, body, item_id, lo, hi``: where enough hits of an item stand close together.

    ``found``: ``id, body, item_id, size, at``, with the first words of all hits.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("at")
            owner = np.repeat(np.arange(len(at)), at.value_lengths().to_numpy())
            word = at.flatten().to_numpy().astype(np.int64)
            if not len(word):
                continue
            order = np.lexsort((word, owner))
            owner, word = owner[order], word[order]
            size = batch.column("size").to_numpy()
            most = span(size, threshold)[owner]
            new = np.ones(len(word), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (word[1:] - word[:-1] > most[1:])
            begin = np.flatnonzero(new)
            stop = np.append(begin[1:], len(word))
            keep = stop - begin >= needed(size, threshold)[owner[begin]]
            begin, stop = begin[keep], stop[keep]
            lo = np.maximum(word[begin] - most[begin], 0)
            hi = word[stop - 1] + REACH + most[begin]
            columns = [batch.column(c).take(pa.array(owner[begin])) for c in ("id", "body", "item_id")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(lo), pa.array(hi)], ["id", "body", "item_id", "lo", "hi"])

    return found.mapInArrow(tw.tidy(work), "id long, body long, item_id long, lo long, hi long")


def regions(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """``id, body, item_id, first, words``: the words of each cluster and around it."""
    bitmap = tw.bitmap(asked.select("body"))

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(tw.in_bitmap(batch.column("body").to_numpy().view(np.uint64), bitmap)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column("wanted")
            for part in tw.slices(folded(batch.column("text"))):
                found = tw.words(part, tw.NOT_ALNUM)
                rows: list[tuple[int, int, int]] = []
                words = []
                for k in range(part.rows):
                    own = found.hashes[found.bounds[k] : found.bounds[k + 1]]
                    for x in wanted[part.first + k].as_py():
                        rows.append((k + part.first, x["item_id"], x["lo"]))
                        words.append(own[x["lo"] : x["hi"]])
                if not rows:
                    continue
                take, item, lo = map(pa.array, zip(*rows))
                spans = pa.array(np.cumsum([0, *map(len, words)]), pa.int32())
                lists = pa.ListArray.from_arrays(spans, pa.array(tw.signed(np.concatenate(words))))
                columns = [batch.column(c).take(take) for c in ("id", "body")]
                yield pa.RecordBatch.from_arrays([*columns, item, lo, lists], ["id", "body", "item_id", "first", "words"])

    wanted = asked.groupBy("id", "body").agg(F.collect_list(F.struct("item_id", "lo", "hi")).alias("wanted"))
    # stored in between, so that a core has one Python process, not several in a row
    near = cut_lineage(docs.mapInArrow(tw.tidy(likely), "id long, body long, text string")).join(wanted, ["id", "body"])
    return near.select("id", "body", "text", "wanted").mapInArrow(
        tw.tidy(work), "id long, body long, item_id long, first long, words array<long>"
    )


def align(texts: list[np.ndarray], items: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score of each pair, and where in the text it ends (exclusive).

    All pairs advance together, one item word at a time; gaps along the text are a
    running maximum.
    """
    width, depth = max(map(len, texts)), max(map(len, items))
    lengths = np.array([len(x) for x in items])
    sizes = np.array([len(x) for x in texts])
    # words as their numbers among these pairs, and two numbers that match nothing as padding
    known, codes = np.unique(np.concatenate([*texts, *items]), return_inverse=True)
    codes = codes.astype(np.int32)
    text = np.full((len(texts), width), len(known), np.int32)
    text[np.arange(width) < sizes[:, None]] = codes[: sizes.sum()]
    item = np.full((len(items), depth), len(known) + 1, np.int32)
    item[np.arange(depth) < lengths[:, None]] = codes[sizes.sum() :]
    # no value is beyond the matches of a whole item and the gaps along a whole text
    number = np.int16 if MATCH * depth - GAP * width < 1 << 15 else np.int32
    slope = (-GAP * np.arange(width)).astype(number)
    row = np.zeros((len(texts), width + 1), number)
    best, end = np.zeros(len(texts), np.int32), np.zeros(len(texts), np.int64)
    every, miss, step = np.arange(len(texts)), number(MISMATCH), number(MATCH - MISMATCH)
    for i in range(depth):
        now = (text == item[:, i, None]) * step
        now += miss
        now += row[:, :-1]
        np.maximum(now, row[:, 1:] + number(GAP), out=now)
        np.maximum(now, 0, out=now)
        now += slope
        np.maximum.accumulate(now, axis=1, out=now)
        now -= slope
        now[i >= lengths] = 0
        row[:, 1:] = now
        at = now.argmax(axis=1)
        top = now[every, at]
        better = top > best
        best[better], end[better] = top[better], at[better] + 1
    return best, end


def _aligned(pairs: DataFrame, threshold: float) -> DataFrame:
    """``id, body, item_id, score, first_word, last_word`` of the pairs of region and item
    with a score of ``threshold`` or more."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, item = batch.column("words"), batch.column("item_words")
            sizes = (text.value_lengths().to_numpy(), item.value_lengths().to_numpy())
            order = np.lexsort(sizes)
            score, lo, hi = np.zeros(len(order)), np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
            at = 0
            while at < len(order):
                # as many of the next pairs as are within the cells at the width of their longest
                longest = np.maximum.accumulate(sizes[0][order[at : at + _CELLS]]) + 1
                n = max(1, int(np.searchsorted(longest * np.arange(1, len(longest) + 1), _CELLS, "right")))
                own = order[at : at + n]
                texts = [text[int(k)].values.to_numpy() for k in own]
                items = [item[int(k)].values.to_numpy() for k in own]
                best, end = align(texts, items)
                score[own] = best / (MATCH * sizes[1][own])
                # the same from the end backwards finds where the copy begins
                good = np.flatnonzero(score[own] >= threshold)
                if len(good):
                    _, begin = align([texts[k][: end[k]][::-1] if end[k] else texts[k] for k in good], [items[k][::-1] for k in good])
                    hi[own[good]], lo[own[good]] = end[good], end[good] - begin
                at += n
            kept = np.flatnonzero(score >= threshold)
            first, take = batch.column("first").to_numpy()[kept], pa.array(kept)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(take) for c in ("id", "body", "item_id")), *map(pa.array, (score[kept], first + lo[kept], first + hi[kept]))],
                ["id", "body", "item_id", "score", "first_word", "end_word"],
            )

    return pairs.mapInArrow(
        tw.tidy(work), "id long, body long, item_id long, score double, first_word long, end_word long"
    )


def find_copies(
    docs: DataFrame, items: DataFrame, text: str = "text", row_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``doc_id, body, item_id, score, first_word, end_word``: the best copy of an item
    in each document that holds one with a score of ``threshold`` or more.

    Words are counted from 0, the end is exclusive.  ``body`` (xxhash64 of the text)
    tells rows that repeat an id apart; equal rows give one result.  Rows without id
    and null texts take no part.
    """
    tw.prepare(docs.sparkSession)
    rows = docs.select(F.col(row_id).cast("long").alias("id"), F.xxhash64(text).alias("body"), F.col(text).alias("text"))
    rows = rows.where("id is not null and text is not null")
    known = cut_lineage(_item_words(items, item_text, item_id))
    seeds = known.select("item_id", F.size("words").alias("size"), F.explode(F.array_distinct("grams")).alias("gram"))
    found = hits(rows, tw.bitmap(seeds.select("gram"))).join(seeds, "gram")
    found = found.groupBy("id", "body", "item_id", "size").agg(F.collect_set("word").alias("at"))
    near = cut_lineage(clusters(found.select("id", "body", "item_id", "size", "at"), threshold))
    whole = cut_lineage(regions(rows, near)).join(known.select("item_id", F.col("words").alias("item_words")), "item_id")
    best = F.max(F.struct("score", F.struct(-F.col("first_word"), "end_word"))).alias("x")
    return (
        _aligned(whole, threshold).groupBy("id", "body", "item_id").agg(best)
        .select(
            F.col("id").alias("doc_id"), "body", "item_id", "x.score",
            (-F.col("x.col2.col1")).alias("first_word"), F.col("x.col2.end_word").alias("end_word"),
        )
    )
