"""Phrase collocations mined from a weighted de Bruijn graph of words.

``mine`` counts phrases of 2 to ``LONGEST`` words per language and scores each by its
weakest cut.  Nodes are runs of ``LONGEST - 1`` words, an edge joins two nodes that
overlap in all but one word: it is a run of ``LONGEST`` words, and its weight is how often
that run occurs.  Only edges are counted in the texts.  Every shorter count follows from
the graph: a phrase occurs as often as weight flows out of the nodes that begin with it,
plus the places where a piece ends too early for an edge; these ends are counted as one
short run per piece, of which all phrases inside it that begin there are corrections.
Single words are counted first, for the total and for the pruning below.

A word, or a pair of neighbours, below ``least`` occurrences in its language stands in no
phrase that reaches ``least``, so pieces are broken there before edges are counted: this
changes no count of a candidate nor of its parts.  The words and pairs that reach it travel
to the tasks as bitmaps of fixed size; a false hit in one keeps an edge that is dropped
later by its count.

Unary paths, whose inner nodes carry the weight of one edge in and one edge out and
nothing else, are compacted: since every phrase that can be a candidate has weight of at
least ``least``, edges from there on are chained.  A node inside such a path occurs exactly
as often as the edges on both sides of it, so it is no collocation of its own and leaves
before candidates are compared; the edges of a path are read off its word sequence.

Defined cases: null or empty text has no pieces, a null language is ``und``; repeated rows
count each; an empty table gives no rows.  Only the two named columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lacuna.llm import textwork as tw
from lacuna.session import cut_lineage

LONGEST = 4
PAIR_BITS = 20  # marks of pairs that are counted in one array
PAIRS_HELD = 6_000_000
LEAST = 30
SWALLOWED = 80  # per cent of a phrase's occurrences inside one longer candidate
SCALE = 2_000_000
NO_LANGUAGE = "und"

# piece ends: . , ; : ! ? and U+000A..U+000D; words end at U+0020 and U+0009 as well
PIECE_END = np.zeros(256, bool)
PIECE_END[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
WORD_END = PIECE_END.copy()
WORD_END[[0x20, 0x09]] = True


def _cut(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Words of each slice of a batch: distinct words and languages, per word its code, its
    piece, its language code and its fingerprint with the language."""
    lang = pc.fill_null(batch.column("lang"), NO_LANGUAGE).dictionary_encode()
    names = lang.dictionary
    spelled = tw.signed(np.array([hash_name(n) for n in names.to_pylist()], np.uint64))
    of_row = lang.indices.to_numpy()
    for part in tw.slices(batch.column("text")):
        found = tw.pieces(part, WORD_END, True)
        if len(found.start) == 0:
            continue
        doc = np.repeat(np.arange(part.rows), np.diff(found.bounds))
        stops = np.concatenate([[0], np.cumsum(PIECE_END[part.data])])
        piece = stops[found.start] + doc  # both never fall, so equal sums are equal pieces
        words = tw.strings(part, found.start, found.end).dictionary_encode()
        code = of_row[part.first + doc]
        marks = tw.mix(found.hashes ^ spelled.view(np.uint64)[code])
        yield names, words.dictionary, words.indices.to_numpy().astype(np.int64), piece, code.astype(np.int64), marks


def hash_name(name: str) -> int:
    """Fingerprint of a language's name, the same in every process."""
    data = np.frombuffer(name.encode() or b"\0", np.uint8).astype(np.uint64)
    return int(tw.combine(data, len(data))[0])


def count_words(docs: DataFrame) -> DataFrame:
    """Occurrences ``n`` of every (``lang``, ``word``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for names, words, at, _, code, _ in _cut(batch):
                pairs, n = np.unique(code * len(words) + at, return_counts=True)
                lang, word = names.take(pa.array(pairs // len(words))), words.take(pa.array(pairs % len(words)))
                yield pa.RecordBatch.from_arrays([lang, word, pa.array(n)], ["lang", "word", "n"])

    return docs.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def word_marks(words: DataFrame) -> DataFrame:
    """The fingerprint ``mark`` of each row's word in its language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for *_, marks in _cut(batch):
                yield pa.RecordBatch.from_arrays([pa.array(tw.signed(marks))], ["mark"])

    return words.select("lang", F.col("word").alias("text")).mapInArrow(run, "mark long")


def _joined(marks: np.ndarray, piece: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, ...]:
    """Which words are frequent, which of them have a frequent word of their piece next,
    and the fingerprints of these pairs."""
    kept = tw.in_bitmap(marks, frequent)
    first = np.flatnonzero(kept[1:] & kept[:-1] & (piece[1:] == piece[:-1]))
    return kept, first, tw.mix(marks[first] * np.uint64(3) + marks[first + 1])


def count_pairs(docs: DataFrame, frequent: np.ndarray, least: int) -> DataFrame:
    """Low 32 bits ``mark`` of the fingerprints of frequent neighbours that occur ``least``
    times; pairs that share these bits are counted together, so none is lost.

    A task sends its counts packed by range of marks; the ranges are added up one after the
    other in an array of fixed size.
    """

    def packed(held: list[np.ndarray]) -> pa.RecordBatch:
        marks, n = np.unique(np.concatenate(held), return_counts=True)
        edges = np.searchsorted(marks, np.arange((1 << 32 - PAIR_BITS) + 1, dtype=np.uint64) << np.uint64(PAIR_BITS))
        low, times = (marks & np.uint32((1 << PAIR_BITS) - 1)).astype("<u4"), np.minimum(n, 255).astype("u1")
        # what does not fit a byte goes on in further entries of the same mark
        more = np.flatnonzero(n > 255)
        ranges = [
            (k, zlib.compress(np.diff(low[a:b], prepend=low[a : a + 1] * 0).astype("<u4").tobytes() + times[a:b].tobytes(), 1))
            for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])) if b > a
        ]
        ranges += [(int(marks[i]) >> PAIR_BITS, np.array([low[i], n[i] - 255], "<u8").tobytes()) for i in more]
        of, blobs = zip(*ranges)
        large = [False] * (len(ranges) - len(more)) + [True] * len(more)
        return pa.RecordBatch.from_arrays([pa.array(of, pa.int32()), pa.array(large), pa.array(blobs, pa.binary())], ["part", "large", "counts"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            for _, _, _, piece, _, marks in _cut(batch):
                held.append(_joined(marks, piece, frequent)[2].astype(np.uint32))
            if sum(map(len, held)) >= PAIRS_HELD:
                yield packed(held)
                held = []
        if sum(map(len, held)):
            yield packed(held)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = None, np.zeros(1 << PAIR_BITS, np.int64)

        def reached() -> pa.RecordBatch:
            marks = (np.flatnonzero(total >= least).astype(np.uint64) | np.uint64(part << PAIR_BITS)).astype(np.uint32)
            return pa.RecordBatch.from_arrays([pa.array(marks.view(np.int32))], ["mark"])

        for batch in batches:
            for of, large, counts in zip(*(batch.column(c).to_pylist() for c in ("part", "large", "counts"))):
                if of != part:
                    if part is not None:
                        yield reached()
                        total[:] = 0
                    part = of
                if large:
                    mark, n = np.frombuffer(counts, "<u8")
                    total[int(mark)] += int(n)
                    continue
                raw = zlib.decompress(counts)
                size = len(raw) // 5
                total[np.cumsum(np.frombuffer(raw, "<u4", size).astype(np.int64))] += np.frombuffer(raw, "u1", size, 4 * size)
        if part is not None:
            yield reached()

    sent = docs.mapInArrow(send, "part int, large boolean, counts binary")
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return sent.repartition(tasks, "part").sortWithinPartitions("part").mapInArrow(add, "mark int")


def count_edges(docs: DataFrame, frequent: np.ndarray, pairs: np.ndarray) -> DataFrame:
    """Edges (runs of ``LONGEST`` words) and piece ends (the last words of a piece, fewer
    than that) of pieces broken at infrequent words and pairs: ``lang``, ``gram``, ``size``,
    ``n``.  A piece of one word holds no phrase: single words are counted on their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for names, words, at, piece, code, marks in _cut(batch):
                kept, first, found = _joined(marks, piece, frequent)
                same = np.zeros(len(at) - 1, bool)
                same[first[tw.in_bitmap(found, pairs)]] = True
                breaks = np.flatnonzero(np.concatenate([[True], ~same, [True]]))
                length = np.repeat(np.diff(breaks), np.diff(breaks))
                place = np.arange(len(at)) - np.repeat(breaks[:-1], np.diff(breaks))
                ahead = length - place  # words from here to the end of the run
                for size in range(2, LONGEST + 1):
                    if size == LONGEST:
                        starts = np.flatnonzero(kept & (ahead >= LONGEST))
                    else:  # one end per run: its last LONGEST - 1 words, or all of it
                        starts = np.flatnonzero(kept & (ahead == size) & ((size == LONGEST - 1) | (place == 0)))
                    if len(starts) == 0:
                        continue
                    key = code[starts]
                    for k in range(size):
                        _, key = np.unique(key * len(words) + at[starts + k], return_inverse=True)
                    _, first, n = np.unique(key, return_index=True, return_counts=True)
                    chosen = starts[first]
                    gram = pc.binary_join_element_wise(*(words.take(pa.array(at[chosen + k])) for k in range(size)), " ")
                    yield pa.RecordBatch.from_arrays(
                        [names.take(pa.array(code[chosen])), gram, pa.array(np.full(len(n), size, np.int32)), pa.array(n)],
                        ["lang", "gram", "size", "n"],
                    )

    counted = docs.mapInArrow(run, "lang string, gram string, size int, n long")
    return counted.groupBy("lang", "gram", "size").agg(F.sum("n").alias("n"))


def _head(gram: str | Column, n: int) -> Column:
    return F.substring_index(gram, " ", n)


def _begun(size: int) -> Column:
    """The phrases below ``LONGEST`` words a counted run of ``size`` words stands for: an edge
    for those that begin at its first word, an end of a piece for those that begin at any."""
    rests = [F.col("gram")] if size == LONGEST else [F.substring_index("gram", " ", -k) for k in range(2, size + 1)]
    lengths = [LONGEST - 1] if size == LONGEST else range(2, size + 1)
    return F.array(*[_head(rest, n) for rest, k in zip(rests, lengths) for n in range(2, k + 1)])


def phrase_counts(edges: DataFrame, least: int) -> DataFrame:
    """Occurrences ``f`` of all phrases of 2 to ``LONGEST`` words from ``least`` on, by flow."""
    phrases = F.coalesce(*[F.when(F.col("size") == size, _begun(size)) for size in range(2, LONGEST + 1)])
    # an edge is counted already: only those that stay go along
    itself = F.when((F.col("size") == LONGEST) & (F.col("n") >= least), F.array("gram")).otherwise(F.array().cast("array<string>"))
    flow = edges.select("lang", F.explode(F.concat(phrases, itself)).alias("phrase"), "n")
    counts = flow.groupBy("lang", "phrase").agg(F.sum("n").alias("f"))
    return counts.where(F.col("f") >= least).withColumn("size", F.size(F.split("phrase", " ")))


def unary_paths(counts: DataFrame) -> DataFrame:
    """Maximal unary paths of the edges in ``counts``: ``lang``, ``path`` (its words), ``f``.

    A node is inside a path when the edge into it and the edge out of it both carry all
    of its occurrences.  Every edge looks for the first of its path by pointer jumping:
    the steps it sees back double with each round.  A path ends somewhere, as every run
    of words in the texts begins somewhere.
    """
    edges = counts.where(F.col("size") == LONGEST).select(
        "lang", "phrase", "f", _head("phrase", LONGEST - 1).alias("node"), F.substring_index("phrase", " ", 1 - LONGEST).alias("tail")
    )
    nodes = counts.where(F.col("size") == LONGEST - 1).select("lang", F.col("phrase").alias("node"), "f")
    into = edges.select("lang", F.col("tail").alias("node"), "f", F.col("phrase").alias("before"))
    links = nodes.join(into, ["lang", "node", "f"])
    found = edges.join(links, ["lang", "node", "f"], "left").select(
        "lang", "phrase", "f",
        F.coalesce("before", "phrase").alias("first"),
        F.when(F.col("before").isNull(), 0).otherwise(1).alias("steps"),
        F.col("before").isNotNull().alias("open"),
    )
    found = cut_lineage(found)
    while not found.where("open").isEmpty():
        beyond = found.select(
            "lang", F.col("phrase").alias("first"), F.col("first").alias("further"), F.col("steps").alias("more"), F.col("open").alias("still")
        )
        moved = found.where("open").join(beyond, ["lang", "first"]).select(
            "lang", "phrase", "f", F.col("further").alias("first"), (F.col("steps") + F.col("more")).alias("steps"), F.col("still").alias("open")
        )
        found = cut_lineage(moved.unionByName(found.where("not open")))
    chain = F.array_sort(F.collect_list(F.struct("steps", "phrase")))
    last = F.transform(F.slice("chain", 2, F.size("chain")), lambda e: F.substring_index(e["phrase"], " ", -1))
    return found.groupBy("lang", "first").agg(chain.alias("chain"), F.max("f").alias("f")).select(
        "lang", F.concat(F.split("first", " "), last).alias("path"), "f"
    )


def mine(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = 2000) -> DataFrame:
    """Each language's ``top`` collocations: ``lang``, ``rank``, ``phrase``, ``a`` (its
    occurrences), ``l`` and ``r`` (those of the two parts of its weakest cut), ``n`` (words
    of the language) and ``score`` = floor(2000000 * a / (l + r)).

    The weakest cut has the lowest score, among equals the shortest first part.  A phrase
    goes when a longer candidate around it holds ``SWALLOWED`` per cent of its occurrences.
    Order: score, occurrences, then the phrase's bytes.
    """
    spark = docs.sparkSession
    tw.prepare(spark)
    pieces = docs.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text"))
    words = cut_lineage(count_words(pieces))
    single = words.where(F.col("n") >= least)
    frequent = tw.bitmap(word_marks(single))
    pairs = tw.bitmap(count_pairs(pieces, frequent, least).select(F.col("mark").cast("long")))
    longer = phrase_counts(count_edges(pieces, frequent, pairs), least)
    alone = single.select("lang", F.col("word").alias("phrase"), F.col("n").alias("f"), F.lit(1).alias("size"))
    counts = cut_lineage(longer.unionByName(alone))
    paths = cut_lineage(unary_paths(counts))

    inside = F.transform(
        F.sequence(F.lit(2), F.size("path") - LONGEST + 1), lambda i: F.array_join(F.slice("path", i, LONGEST - 1), " ")
    )
    inner = paths.where(F.size("path") > LONGEST).select("lang", F.explode(inside).alias("phrase"))
    whole = F.transform(
        F.sequence(F.lit(1), F.size("path") - LONGEST + 1), lambda i: F.array_join(F.slice("path", i, LONGEST), " ")
    )
    longest = paths.select("lang", F.explode(whole).alias("phrase"), "f", F.lit(LONGEST).alias("size"))
    shorter = counts.where((F.col("size") > 1) & (F.col("size") < LONGEST))
    # all phrases that hold a phrase hold it inside one that is a word longer and no rarer
    around = longest.unionByName(shorter.where("size > 2")).select(
        "lang", "f", F.explode(F.array(_span(1, F.col("size") - 1), _span(2, F.col("size") - 1))).alias("phrase")
    )
    swallow = around.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    own = shorter.join(inner, ["lang", "phrase"], "left_anti").join(swallow, ["lang", "phrase"], "left")
    own = own.where(F.col("most").isNull() | (100 * F.col("most") < SWALLOWED * F.col("f"))).drop("most")
    candidates = own.unionByName(longest)

    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "f", "k",
        _span(1, F.col("k")).alias("head"),
        _span(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"),
    )
    heads = counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    rests = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    value = F.expr(f"(cast({SCALE} as decimal(10,0)) * cast(f as decimal(20,0))) div cast(l + r as decimal(20,0))")
    scored = cuts.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"]).withColumn("score", value)
    weakest = scored.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.max("f").alias("a")
    )
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = weakest.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score").withColumn(
        "rank", F.row_number().over(order)
    )
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.where(F.col("rank") <= top).join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def _span(start: int | Column, n: Column) -> Column:
    """``n`` words of ``phrase`` from its ``start``-th on."""
    return F.array_join(F.slice(F.split("phrase", " "), start, n), " ")
