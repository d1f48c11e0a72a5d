"""Removal of repeated runs of lines by winnowing.

Empty lines aside, every line has a fingerprint.  Each window of ``run`` consecutive
lines selects its smallest fingerprint (the last of equals), so two equal windows
select the same line: a repeated run of ``run`` lines or more is guaranteed to share a
selected fingerprint.

1. Selected fingerprints are counted; only those met twice or more go on.
2. The windows that selected them are joined to the first window of equal lines, in the
   order of (doc_id, position): one partner each, however often a passage occurs.
3. In each document, matched windows that follow each other here and in the partner
   are one run, so a match is extended both ways as far as lines agree.  The lines of
   such a later run are deleted.

So a line goes exactly if it lies in ``run`` consecutive lines that occur earlier, or,
with ``alone``, if it has so many words and an equal line stands earlier.
Within one document occurrences may overlap: of a line repeated many times in
succession one copy stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lacuna.llm import textwork as tw
from lacuna.session import cut_lineage

RUN = 2
_ONE_RUN = "first_line int, last_line int, source_id long, source_line int"
_RUN_TYPE = pa.struct(
    [("first_line", pa.int32()), ("last_line", pa.int32()), ("source_id", pa.int64()), ("source_line", pa.int32())]
)


def select_minima(hashes: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """Index of the smallest hash, last of equals, of each window beginning at ``first``."""
    chosen, best = first.copy(), hashes[first]
    for k in range(1, size):
        other = hashes[first + k]
        lower = other <= best
        best = np.where(lower, other, best)
        chosen[lower] = first[lower] + k
    return chosen


def _windows(docs: DataFrame, run: int, counts: bool, least: int = 0) -> DataFrame:
    """Windows ``fp, key, id, body, at``, or with ``counts`` selected lines ``fp, n``;
    only windows whose first line has ``least`` words or more."""
    schema = "fp long, n long" if counts else "fp long, key long, id long, body long, at int"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tw.slices(batch.column(2)):
                found = tw.lines(part)
                keys, first, bounds = tw.grams(found, run)
                doc = np.repeat(np.arange(part.rows), np.diff(bounds))
                if least:
                    begins = tw.words(part).start
                    n_words = np.searchsorted(begins, found.end[first]) - np.searchsorted(begins, found.start[first])
                    keys, first, doc = (x[n_words >= least] for x in (keys, first, doc))
                if not len(keys):
                    continue
                chosen = select_minima(found.hashes, first, run)
                if counts:
                    fps, n = np.unique(found.hashes[np.unique(chosen)], return_counts=True)
                    columns = [tw.signed(fps), n]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["fp", "n"])
                    continue
                at = (first - found.bounds[doc]).astype(np.int32)
                take = pa.array(doc + part.first)
                columns = [pa.array(tw.signed(found.hashes[chosen])), pa.array(tw.signed(keys))]
                columns += [batch.column(0).take(take), batch.column(1).take(take), pa.array(at)]
                yield pa.RecordBatch.from_arrays(columns, ["fp", "key", "id", "body", "at"])

    return docs.mapInArrow(tw.tidy(work), schema)


def repeated_windows(docs: DataFrame, text: str = "text", row_id: str = "doc_id", run: int = RUN, least: int = 0) -> DataFrame:
    """Later windows and the first equal one: ``id, body, at, source_id, source_line``.

    ``body`` tells rows that repeat an id apart.  Equal rows of one id count as one.
    Rows without id or text take no part.
    """
    rows = docs.select(F.col(row_id).cast("long").alias("id"), F.xxhash64(text).alias("body"), F.col(text).alias("text"))
    rows = rows.where("id is not null and text is not null")
    often = cut_lineage(_windows(rows, run, True, least).groupBy("fp").agg(F.sum("n").alias("n")).where("n > 1").select("fp"))
    found = cut_lineage(_windows(rows, run, False, least).join(often, "fp", "left_semi").drop("fp"))
    place = F.struct("id", "body", "at")
    first = cut_lineage(
        found.groupBy("key").agg(F.min(place).alias("source"), F.max(place).alias("last"))
        .where("source <> last").select("key", "source")
    )
    return found.join(first, "key").where(place != F.col("source")).select(
        "id", "body", "at", F.col("source.id").alias("source_id"), F.col("source.at").alias("source_line")
    )


def merge_runs(matches: list[dict], run: int) -> list[dict]:
    """Maximal runs from matched windows of one document: neighbours on a diagonal."""
    out: list[dict] = []
    for m in sorted(matches, key=lambda m: (m["source_id"], m["source_line"] - m["at"], m["at"])):
        last = out[-1] if out else None
        follows = (
            last is not None
            and last["source_id"] == m["source_id"]
            and m["at"] - last["first_line"] == m["source_line"] - last["source_line"]
            and m["at"] <= last["last_line"] + 1
        )
        if follows:
            last["last_line"] = max(last["last_line"], m["at"] + m.get("size", run) - 1)
        else:
            out.append(
                {
                    "first_line": m["at"],
                    "last_line": m["at"] + m.get("size", run) - 1,
                    "source_id": m["source_id"],
                    "source_line": m["source_line"],
                }
            )
    return out


def without_runs(text: str, runs: list[dict]) -> tuple[str, int]:
    """``text`` without the non-empty lines of ``runs``, and how many are left.

    Empty lines stay, unless no other line is left: then the text is empty.
    """
    gone = {k for r in runs for k in range(r["first_line"], r["last_line"] + 1)}
    kept, at, left = [], 0, 0
    for line in text.split("\n"):
        if line:
            at += 1
            if at - 1 in gone:
                continue
            left += 1
        kept.append(line)
    return ("\n".join(kept), left) if left else ("", 0)


def dedupe_lines(docs: DataFrame, text: str = "text", row_id: str = "doc_id", run: int = RUN, alone: int | None = None) -> DataFrame:
    """``docs`` with ``text`` rid of later repeated runs, and of later repeated single
    lines of ``alone`` words or more, if that is given; and what was found.

    Adds ``n_lines`` (non-empty lines before), ``n_deleted`` and ``runs`` (first and
    last deleted line, counted from 0 without empty lines, and where they stand
    first); columns of ``docs`` with these names are replaced.  Null text stays null;
    rows without id or text are unchanged and count no deleted line.
    """
    tw.prepare(docs.sparkSession)
    if run < 1:
        raise ValueError("run must be at least 1")
    if alone is not None and alone < 1:
        raise ValueError("alone must be at least 1")
    matches = repeated_windows(docs, text, row_id, run).withColumn("size", F.lit(run))
    if alone is not None:
        matches = matches.union(repeated_windows(docs, text, row_id, 1, alone).withColumn("size", F.lit(1)))
    matches = matches.groupBy("id", "body").agg(
        F.collect_list(F.struct("at", "source_id", "source_line", "size")).alias("found")
    )
    own = [f for f in docs.schema.fields if f.name not in ("n_lines", "n_deleted", "runs")]
    fields = [T.StructField(f.name, f.dataType) for f in own]
    fields += [T.StructField("n_lines", T.LongType()), T.StructField("n_deleted", T.LongType())]
    schema = T.StructType([*fields, T.StructField("runs", T.ArrayType(T.StructType.fromDDL(_ONE_RUN)))])
    names = [f.name for f in own]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value, found = batch.column(text), batch.column("__found")
            lines = np.concatenate([np.zeros(0, int), *(np.diff(tw.lines(p).bounds) for p in tw.slices(value))])
            deleted, runs, changed = np.zeros(len(lines), np.int64), [[]] * len(lines), {}
            for k in np.flatnonzero(found.is_valid().to_numpy(False)):
                runs[k] = merge_runs(found[k].as_py(), run)
                changed[k], left = without_runs(value[k].as_py(), runs[k])
                deleted[k] = lines[k] - left
            if changed:
                at = pa.array([k in changed for k in range(len(lines))])
                value = pc.replace_with_mask(value, at, pa.array(list(changed.values()), value.type))
            columns = [value if n == text else batch.column(n) for n in names]
            columns += [pa.array(lines, pa.int64()), pa.array(deleted), pa.array(runs, pa.list_(_RUN_TYPE))]
            yield pa.RecordBatch.from_arrays(columns, [*names, "n_lines", "n_deleted", "runs"])

    rows = docs.select(
        *[F.col(f"`{n}`") for n in names], F.col(row_id).cast("long").alias("__id"), F.xxhash64(text).alias("__body")
    )
    joined = rows.join(
        matches.toDF("__mid", "__mbody", "__found"),
        (F.col("__id") == F.col("__mid")) & (F.col("__body") == F.col("__mbody")) & F.col(f"`{text}`").isNotNull(),
        "left",
    )
    return joined.select(*[F.col(f"`{n}`") for n in names], "__found").mapInArrow(tw.tidy(work), schema)
