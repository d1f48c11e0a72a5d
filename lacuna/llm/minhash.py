"""Near-duplicate documents by b-bit MinHash.

A document's set holds the fingerprints of its distinct five-word shingles.  Of
``BANDS * ROWS`` permutations each minimum goes whole into the key of its band and
then only its lowest ``BITS`` bits are kept, packed into 64-bit words.

1. Rows with equal sets form one class, found by a digest of the set: copies are
   counted, not compared.
2. Classes that share a band key are candidates.  Only keys held by two classes or
   more go on.
3. Each candidate is compared with the first class of each of its buckets by counting
   equal packed values; agreement by chance, ``2**-BITS``, is taken out of the
   estimate.  The best of these links is checked on the full sets.
4. Links found so far are contracted to trees; most buckets are within one tree then.
   Buckets that still hold several are gathered to clusters, and the members of a
   cluster are packed into blocks.  A pair of blocks is one row: the task compares all
   its members of different trees, first by the estimate, then on the full sets, and
   gives out a spanning forest of the links, never the pairs.

A pair at the similarity of the threshold 0.85 shares a band with probability
1 - (1 - 0.85**4)**24 = 1 - 2e-8; the estimate must only reach the threshold less
``SLACK``, about six standard deviations.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacuna.llm import textwork as tw
from lacuna.llm.components import components
from lacuna.session import cut_lineage

SHINGLE = 5
BANDS, ROWS, BITS = 24, 4, 4
KEPT = BANDS * ROWS * BITS // 64  # packed 64-bit words
SLACK = 0.22
_AT_ONCE = 4096
BLOCK_ROWS, BLOCK_SHINGLES = 96, 1 << 16

_rng = np.random.default_rng(20240501)
_MULTIPLY = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def shingle_sets(part: tw.Slice, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct shingle fingerprints of each document of a slice.

    Fewer words than a shingle: the whole sequence is one; no words: empty.
    """
    found = tw.words(part)
    hashes, _, bounds = tw.grams(found, size)
    for k in range(part.rows):
        if bounds[k] < bounds[k + 1]:
            yield np.unique(hashes[bounds[k] : bounds[k + 1]])
        else:
            own = found.hashes[found.bounds[k] : found.bounds[k + 1]]
            yield tw.combine(own, len(own)) if len(own) else own


def minima(shingles: np.ndarray) -> np.ndarray:
    """Smallest image of the set under each permutation."""
    low = np.full(len(_MULTIPLY), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), _AT_ONCE):
        part = shingles[None, at : at + _AT_ONCE] * _MULTIPLY[:, None]
        part += _ADD[:, None]
        np.minimum(low, part.min(axis=1), out=low)
    return tw.mix(low)


def _bands(low: np.ndarray) -> np.ndarray:
    rows = low.reshape(-1, BANDS, ROWS)
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), rows.shape[:2]).copy()
    for k in range(ROWS):
        keys = tw.mix(keys * np.uint64(tw._STEP) + rows[:, :, k])
    return tw.signed(keys)


def _packed(low: np.ndarray) -> np.ndarray:
    kept = (low & np.uint64((1 << BITS) - 1)).reshape(len(low), KEPT, 64 // BITS)
    shifts = np.arange(0, 64, BITS, dtype=np.uint64)
    return tw.signed((kept << shifts).sum(axis=2, dtype=np.uint64))


def signatures(docs: DataFrame, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """``id, n, digest, bands, packed``: set size, digest of the set, band keys and
    packed low bits.  The last three are null for an empty set."""
    schema = "id long, n long, digest binary, bands array<long>, packed array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, lows = [], [], []
            for part in tw.slices(batch.column(1)):
                for own in shingle_sets(part):
                    sizes.append(len(own))
                    digests.append(blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                    lows.append(minima(own))
            if not sizes:
                continue
            low, empty = np.array(lows), pa.array([d is None for d in digests])
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary())]
            for values in (_bands(low), _packed(low)):
                ends = np.arange(len(values) + 1) * values.shape[1]
                ends = pa.array(ends, pa.int32())
                columns.append(pa.ListArray.from_arrays(ends, pa.array(values.ravel()), mask=empty))
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "digest", "bands", "packed"])

    return docs.select(F.col(row_id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(tw.tidy(run), schema)


def shingles(docs: DataFrame, wanted: DataFrame, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """``id, shingles``: the full sets, sorted, of the rows whose id is in ``wanted``.

    A bitmap of fixed size keeps most other rows from being shuffled; the join that
    follows is exact.
    """
    bits = tw.bitmap(wanted.select(F.xxhash64("id").alias("hash")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(tw.in_bitmap(batch.column(2).to_numpy().view(np.uint64), bits)))
            ids, at = batch.column(0), 0
            for part in tw.slices(batch.column(1)):
                sets = list(shingle_sets(part))
                ends = pa.array(np.cumsum([0, *map(len, sets)]), pa.int32())
                values = pa.ListArray.from_arrays(ends, pa.array(tw.signed(np.concatenate(sets))))
                yield pa.RecordBatch.from_arrays([ids.slice(at, part.rows), values], ["id", "shingles"])
                at += part.rows

    row = F.col(row_id).cast("long")
    source = docs.select(row.alias("id"), F.col(text).alias("text"), F.xxhash64(row).alias("hash"))
    return source.mapInArrow(tw.tidy(run), "id long, shingles array<long>").join(wanted.select("id"), "id", "left_semi")


def estimate(a: Column, b: Column) -> Column:
    """Similarity of two packed signatures, chance agreement of low bits taken out.

    A value agrees if its BITS bits do: the differing bits of a word are folded onto
    the lowest bit of each value and counted.
    """
    ones = sum(1 << k for k in range(0, 64, BITS))
    ones -= (ones >> 63) << 64

    def differing(x: Column, y: Column) -> Column:
        bits = x.bitwiseXOR(y)
        folded = bits
        for k in range(1, BITS):
            folded = folded.bitwiseOR(F.shiftrightunsigned(bits, k))
        return F.bit_count(folded.bitwiseAND(F.lit(ones)))

    unequal = sum(differing(a[k], b[k]) for k in range(KEPT))
    chance = 2.0**-BITS
    return ((1 - unequal / F.lit(float(BANDS * ROWS))) - chance) / (1 - chance)


def _verified(pairs: DataFrame, docs_of: DataFrame, percent: int) -> DataFrame:
    """Of ``pairs(a, b)`` those whose full sets are similar enough."""
    sets = cut_lineage(docs_of.join(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "id", "left_semi"))
    first, second = sets.toDF("a", "set_a"), sets.toDF("b", "set_b")
    both = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - both
    return pairs.join(first, "a").join(second, "b").where(100 * both >= percent * union).select("a", "b")


def _roots(parents: DataFrame) -> DataFrame:
    """``id, tree``: the root above each ``a`` of links to one smaller ``b`` each."""
    tree = parents.toDF("id", "tree")
    while True:
        up = tree.toDF("tree", "above")
        tree = cut_lineage(
            tree.join(up, "tree", "left").select("id", F.coalesce("above", "tree").alias("tree"), F.col("above").isNotNull().alias("moved"))
        )
        if not tree.where("moved").head(1):
            return tree.select("id", "tree")
        tree = tree.select("id", "tree")


def _unequal(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Packed values that differ between every row of ``a`` and every row of ``b``."""
    ones = np.uint64(sum(1 << k for k in range(0, 64, BITS)))
    out = np.zeros((len(a), len(b)), np.int32)
    for k in range(KEPT):
        bits = a[:, None, k] ^ b[None, :, k]
        folded = bits.copy()
        for shift in range(1, BITS):
            folded |= bits >> np.uint64(shift)
        out += np.bitwise_count(folded & ones)
    return out


def _shared(a: list[np.ndarray], b: list[np.ndarray], columns: int = 8192) -> np.ndarray:
    """Sizes of the intersections of every set of ``a`` with every set of ``b``."""
    both = np.intersect1d(np.concatenate(a), np.concatenate(b))
    out = np.zeros((len(a), len(b)), np.float32)
    places = []
    for sets in (a, b):
        owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        flat = np.concatenate(sets)
        at = np.searchsorted(both, flat)
        hit = at < len(both)
        hit[hit] = both[at[hit]] == flat[hit]
        places.append((owner[hit], at[hit]))
    for lo in range(0, len(both), columns):
        tables = []
        for (owner, at), n in zip(places, out.shape):
            own = (at >= lo) & (at < lo + columns)
            table = np.zeros((n, min(columns, len(both) - lo)), np.float32)
            table[owner[own], at[own] - lo] = 1
            tables.append(table)
        out += tables[0] @ tables[1].T
    return out


def _block_links(rows: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` that connect the members of each cluster as all links would.

    ``rows``: ``id, tree, cluster, n, packed, shingles``.  Blocks hold about
    ``BLOCK_ROWS`` members or ``BLOCK_SHINGLES`` shingles, whichever is reached first.
    """
    sizes = rows.groupBy("cluster").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
    blocks = F.ceil(F.greatest(F.col("c") / BLOCK_ROWS, F.col("s") / BLOCK_SHINGLES))
    number = F.pmod(F.xxhash64("id", F.lit(11)), "blocks").cast("int")
    sizes = cut_lineage(sizes.select("cluster", blocks.alias("blocks")))
    packed = (
        rows.join(sizes, "cluster").groupBy("cluster", number.alias("block"))
        .agg(F.collect_list(F.struct("id", "tree", "n", "packed", "shingles")).alias("docs"))
    )
    packed = cut_lineage(packed)
    left, right = packed.toDF("cluster", "i", "left"), packed.toDF("cluster", "j", "right")
    least = percent / 100 - SLACK
    chance = 2.0**-BITS

    def columns(docs: pa.StructScalar) -> tuple:
        table = docs.values
        ids, tree, n = (table.field(c).to_numpy() for c in ("id", "tree", "n"))
        own = table.field("packed")
        words = own.flatten().to_numpy().view(np.uint64).reshape(len(ids), KEPT)
        sets = [x.values.to_numpy() for x in table.field("shingles")]
        return ids, tree, n, words, sets

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[int, int]] = []
            for docs_a, docs_b in zip(batch.column("left"), batch.column("right")):
                (id_a, tree_a, n_a, words_a, sets_a), (id_b, tree_b, n_b, words_b, sets_b) = columns(docs_a), columns(docs_b)
                agree = 1 - _unequal(words_a, words_b) / (BANDS * ROWS)
                close = ((agree - chance) / (1 - chance) >= least) & (tree_a[:, None] != tree_b[None, :])
                if not close.any():
                    continue
                keep_a, keep_b = np.flatnonzero(close.any(axis=1)), np.flatnonzero(close.any(axis=0))
                both = _shared([sets_a[k] for k in keep_a], [sets_b[k] for k in keep_b])
                union = n_a[keep_a][:, None] + n_b[keep_b][None, :] - both
                linked = close[np.ix_(keep_a, keep_b)] & (100 * both >= percent * union)
                above: dict[int, int] = {}

                def root(x: int) -> int:
                    while above.get(x, x) != x:
                        above[x] = above.get(above[x], above[x])
                        x = above[x]
                    return x

                for x, y in zip(*np.nonzero(linked)):
                    a, b = int(id_a[keep_a[x]]), int(id_b[keep_b[y]])
                    up, down = root(int(tree_a[keep_a[x]])), root(int(tree_b[keep_b[y]]))
                    if up != down:
                        above[max(up, down)] = min(up, down)
                        found.append((a, b))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"]
            )

    pairs = left.join(right, "cluster").where("i <= j").select("left", "right")
    return pairs.mapInArrow(tw.tidy(work), "a long, b long")


def near_duplicates(docs: DataFrame, text: str = "text", row_id: str = "doc_id", percent: int = 85) -> DataFrame:
    """``id, n_shingles, component_id, kept`` of every row of ``docs``.

    Two rows are linked if 100 * |intersection| >= ``percent`` * |union| of their
    shingle sets; ``component_id`` is the smallest id reachable over links, ``kept``
    says whether it is the row's own.  Null, empty or word-less texts have size 0 and
    are their own component.  Rows that repeat an id get the class of their own text.
    A null id takes part in no link: null ``component_id``, ``kept`` false.
    """
    if percent < 75:
        raise ValueError("the bands are laid out for similarities of 0.75 and more")
    tw.prepare(docs.sparkSession)
    rows = cut_lineage(signatures(docs, text, row_id))
    usable = rows.where("id is not null and digest is not null")
    classes = cut_lineage(
        usable.groupBy("digest").agg(
            F.min("id").alias("id"), F.count("*").alias("members"), F.first("n").alias("n"),
            F.first("bands").alias("bands"), F.first("packed").alias("packed"),
        )
    )
    banded = classes.select("id", F.explode("bands").alias("key"))
    shared = cut_lineage(
        banded.groupBy("key").agg(F.min("id").alias("pivot"), F.max("id").alias("top"))
        .where("pivot <> top").select("key", "pivot")
    )
    members = cut_lineage(banded.join(shared, "key").select("key", "id", "pivot"))
    packed = classes.join(members.select("id").distinct(), "id", "left_semi").select("id", "n", "packed")
    packed = cut_lineage(packed)
    least = percent / 100 - SLACK

    def may_match(n_a: str, n_b: str, a: str, b: str) -> Column:
        sizes = 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)
        return sizes & (estimate(F.col(a), F.col(b)) >= least)

    pivots = packed.toDF("pivot", "n_p", "packed_p")
    stars = (
        members.where("id <> pivot").select("id", "pivot").distinct()
        .join(packed, "id").join(pivots, "pivot")
        .where(may_match("n", "n_p", "packed", "packed_p"))
        .groupBy("id").agg(F.max_by("pivot", estimate(F.col("packed"), F.col("packed_p"))).alias("b"))
        .select(F.col("id").alias("a"), "b")
    )
    wanted = cut_lineage(members.select("id").distinct())
    sets = shingles(docs.where(F.col(row_id).isNotNull()), wanted, text, row_id)
    sets = cut_lineage(sets.dropDuplicates(["id", "shingles"]))
    links = cut_lineage(_verified(cut_lineage(stars), sets, percent))
    first = _roots(links)

    placed = cut_lineage(
        members.join(first, "id", "left").select("key", "id", F.coalesce("tree", "id").alias("tree"))
    )
    mixed = cut_lineage(
        placed.groupBy("key").agg(F.min("tree").alias("lo"), F.max("tree").alias("hi"), F.min("id").alias("low"))
        .where("lo <> hi").select("key", "low")
    )
    unsettled = cut_lineage(placed.join(mixed, "key").select("id", "low", "tree").distinct())
    clusters = cut_lineage(components(unsettled.select("id", "low")))
    rows_of = unsettled.select("id", "tree").distinct().join(clusters, "id").join(packed, "id").join(sets, "id")
    more = _block_links(cut_lineage(rows_of.withColumnRenamed("component", "cluster")), percent)
    final = components(cut_lineage(links.union(more)))

    named = classes.join(final, "id", "left").select(
        "digest", "members", "id", F.coalesce("component", "id").alias("component_id")
    )
    named = cut_lineage(named.where("members > 1 or component_id <> id").select("digest", "component_id"))
    component = F.coalesce(F.col("component_id"), F.col("id"))
    return rows.join(named, "digest", "left").select(
        "id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
