"""Personal data: fixed patterns, and a linear-chain CRF that adds what they miss.

Base kinds are found by pattern and check (``KINDS``).  The conditional random field
tags words with a kind or none from the shapes of the word and its neighbours.  A word
without digit and without ``@`` is never tagged, so a text falls apart into runs of the
other words, and Viterbi decoding of these runs, padded to batches in numpy, is the
decoding of the whole text.  The small labelled table it is trained from holds the
runs of at most ``SAMPLE_ROWS`` documents, tagged by the base patterns.  Tagged
stretches that touch no match of a pattern are added.

All patterns are written so that no start inside a run of their characters is tried
twice: the time is linear in the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lacuna.llm import textwork as tw

KINDS = ("email", "ip", "card", "phone")
SAMPLE_ROWS, SAMPLE_RUNS, LONGEST_RUN = 4000, 6000, 64
SLOT_BITS = 14
STEPS, RATE, SHRINK = 120, 0.1, 1e-3
CONTEXT = 40  # characters in which the neighbouring word is looked for
NONE = len(KINDS)

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]+")
_MARKED = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
_EDGE = ".,;:!?()[]{}<>\"'|"

Span = tuple[int, int, int]  # kind, start, end


def _emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
        at = text.find("@", max(at + 1, free))


def _ip_ok(found: str) -> bool:
    parts = [p.lstrip("0") for p in found.split(".")]
    return all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def _card_ok(found: str) -> bool:
    digits = _DIGITS.sub("", found)
    if not 13 <= len(digits) <= 19:
        return False
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _phone_ok(found: str) -> bool:
    return 9 <= len(_DIGITS.sub("", found)) <= 15


def matches(text: str) -> tuple[list[Span], list[Span]]:
    """Spans of the fixed patterns that pass and that fail their check, by kind, then
    start; code points, end exclusive."""
    good, bad = [(0, a, b) for a, b in _emails(text)], []
    for kind, pattern, passes in ((1, _IP, _ip_ok), (2, _CARD, _card_ok), (3, _PHONE, _phone_ok)):
        if kind != 3 or "+" in text:
            for m in pattern.finditer(text):
                (good if passes(m[0]) else bad).append((kind, m.start(), m.end()))
    return good, bad


def base_spans(text: str) -> list[Span]:
    return matches(text)[0]


def _shape(word: str) -> str:
    """Letters and digits as classes, longer stretches of a class as two."""
    out: list[str] = []
    for c in word[:CONTEXT]:
        s = "d" if "0" <= c <= "9" else "A" if c.isupper() else "a" if c.isalpha() else c
        if len(out) < 2 or s != out[-1] or s != out[-2]:
            out.append(s)
    return "".join(out)


@lru_cache(maxsize=100_000)
def _slots(before: str, word: str, after: str) -> tuple[int, ...]:
    shape = _shape(word)
    digits = sum("0" <= c <= "9" for c in word)
    names = (
        f"s={shape}", f"c={''.join(sorted(set(shape)))}", f"d={min(digits, 20)}", f"n={min(len(word), 24)}",
        f"h={shape[:3]}", f"t={shape[-3:]}", f"b={_shape(before)}", f"a={_shape(after)}", f"w={before.lower()}",
        f"dots={min(word.count('.'), 4)}{'@' in word}{'+' in word}",
    )
    return tuple(crc32(n.encode()) >> (32 - SLOT_BITS) for n in names)


@dataclass
class Run:
    """Neighbouring marked words: their places and feature slots."""

    places: list[tuple[int, int]]
    slots: list[tuple[int, ...]]


def runs(text: str) -> list[Run]:
    out: list[Run] = []
    for m in _MARKED.finditer(text):
        a, b = m.span()
        before = text[max(0, a - CONTEXT) : a].split()
        after = text[b : b + CONTEXT].split()
        own = _slots(before[-1] if before else "", m[0][:CONTEXT], after[0] if after else "")
        if out and not text[out[-1].places[-1][1] : a].strip():
            out[-1].places.append((a, b))
            out[-1].slots.append(own)
        else:
            out.append(Run([(a, b)], [own]))
    return out


@dataclass
class Field:
    emit: np.ndarray  # slots x tags
    move: np.ndarray  # tags x tags, from row to column
    edge: np.ndarray  # 2 x tags: first and last of a run


def _padded(slots: list[list[tuple[int, ...]]]) -> tuple[np.ndarray, np.ndarray]:
    width = max(map(len, slots))
    table = np.zeros((len(slots), width, len(slots[0][0])), np.int64)
    for k, own in enumerate(slots):
        table[k, : len(own)] = own
    return table, np.array([len(own) for own in slots])


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def fit(slots: list[list[tuple[int, ...]]], tags: list[list[int]]) -> Field:
    """Field of largest conditional likelihood of the tagged runs, by Adam."""
    n = NONE + 1
    field = Field(np.zeros((1 << SLOT_BITS, n)), np.zeros((n, n)), np.zeros((2, n)))
    field.edge[:, NONE] = 0.1
    if not slots:
        field.emit[:, NONE] = 1.0
        return field
    table, sizes = _padded(slots)
    rows, width = table.shape[:2]
    truth = np.full((rows, width), NONE)
    for k, own in enumerate(tags):
        truth[k, : len(own)] = own
    inside = np.arange(width)[None, :] < sizes[:, None]
    last = sizes - 1
    each = np.arange(rows)
    gold = np.eye(n)[truth] * inside[:, :, None]
    params = (field.emit, field.move, field.edge)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    for step in range(1, STEPS + 1):
        e = field.emit[table].sum(axis=2)
        ahead, back = np.zeros((rows, width, n)), np.zeros((rows, width, n))
        ahead[:, 0] = e[:, 0] + field.edge[0]
        for t in range(1, width):
            now = _logsum(ahead[:, t - 1, :, None] + field.move, 1) + e[:, t]
            ahead[:, t] = np.where(inside[:, t, None], now, ahead[:, t - 1])
        back[each, last] = field.edge[1]
        for t in range(width - 2, -1, -1):
            now = _logsum(field.move + (e[:, t + 1] + back[:, t + 1])[:, None, :], 2)
            back[:, t] = np.where((t < last)[:, None], now, back[:, t])
        z = _logsum(ahead[each, last] + field.edge[1], 1)
        share = np.exp(ahead + back - z[:, None, None]) * inside[:, :, None]
        wrong = (share - gold) / rows
        grads = [np.zeros_like(p) for p in params]
        for k in range(table.shape[2]):
            np.add.at(grads[0], table[:, :, k][inside], wrong[inside])
        for t in range(1, width):
            pair = np.exp(ahead[:, t - 1, :, None] + field.move + (e[:, t] + back[:, t])[:, None, :] - z[:, None, None])
            seen = np.eye(n)[truth[:, t - 1]][:, :, None] * np.eye(n)[truth[:, t]][:, None, :]
            grads[1] += ((pair - seen) * inside[:, t, None, None]).sum(axis=0) / rows
        grads[2][0] = wrong[:, 0].sum(axis=0)
        grads[2][1] = wrong[each, last].sum(axis=0)
        for p, g, (m, v) in zip(params, grads, moments):
            g += SHRINK / rows * p
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return field


def decode(field: Field, slots: list[list[tuple[int, ...]]]) -> list[np.ndarray]:
    """Most probable tags of each run (Viterbi), runs of like length together."""
    out: list[np.ndarray] = [np.zeros(0, int)] * len(slots)
    order = sorted(range(len(slots)), key=lambda k: len(slots[k]))
    at = 0
    while at < len(order):
        longest = len(slots[order[min(at + 2048, len(order)) - 1]])
        group = order[at : at + max(1, min(2048, 200_000 // longest))]
        at += len(group)
        table, sizes = _padded([slots[k] for k in group])
        rows, width = table.shape[:2]
        e = field.emit[table].sum(axis=2)
        score = e[:, 0] + field.edge[0]
        came = np.zeros((rows, width, NONE + 1), np.int8)
        same = np.arange(NONE + 1, dtype=np.int8)
        for t in range(1, width):
            through = score[:, :, None] + field.move
            live = (t < sizes)[:, None]
            came[:, t] = np.where(live, through.argmax(axis=1), same)
            score = np.where(live, through.max(axis=1) + e[:, t], score)
        tag = (score + field.edge[1]).argmax(axis=1)
        tags = np.zeros((rows, width), int)
        for t in range(width - 1, -1, -1):
            tags[:, t] = tag
            tag = came[np.arange(rows), t, tag]
        for k, row, size in zip(group, tags, sizes):
            out[k] = row[:size]
    return out


def added_spans(text: str, own: list[Run], tags: list[np.ndarray], fixed: list[Span]) -> list[Span]:
    """Stretches of one tag, without punctuation at the ends, that touch no match of a
    fixed pattern: a failed check, such as a card's sum, is not overruled."""
    taken = sorted((a, b) for _, a, b in fixed)
    starts = np.array([a for a, _ in taken])
    reach = np.maximum.accumulate([b for _, b in taken]) if taken else np.zeros(0, int)
    out = []
    for run, kinds in zip(own, tags):
        k = 0
        while k < len(kinds):
            j = k
            while j + 1 < len(kinds) and kinds[j + 1] == kinds[k]:
                j += 1
            if kinds[k] != NONE:
                a, b = run.places[k][0], run.places[j][1]
                while a < b and text[a] in _EDGE:
                    a += 1
                while b > a and text[b - 1] in _EDGE:
                    b -= 1
                before = int(np.searchsorted(starts, b)) - 1
                if a < b and (before < 0 or reach[before] <= a):
                    out.append((int(kinds[k]), a, b))
            k = j + 1
    return out


def labelled_runs(docs: DataFrame, text: str = "text", row_id: str = "doc_id", rows: int = SAMPLE_ROWS) -> DataFrame:
    """``slots, tags``: marked runs of at most ``rows`` documents, chosen by a hash of
    the id, tagged where base spans lie; at most ``SAMPLE_RUNS`` runs of at most
    ``LONGEST_RUN`` words."""
    own = docs.select(F.col(row_id).cast("long").alias("id"), F.col(text).alias("text")).where("id is not null")
    chosen = own.select("id").distinct().orderBy(F.xxhash64("id", F.lit(4)), "id").limit(rows)
    texts = own.where("text is not null").join(F.broadcast(chosen), "id")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots, tags, keys = [], [], []
            for text in batch.column("text").to_pylist():
                kind_at = [(a, b, kind) for kind, a, b in base_spans(text)]
                for run in runs(text):
                    if len(run.places) <= LONGEST_RUN:
                        kinds = [next((k for a, b, k in kind_at if a < y and b > x), NONE) for x, y in run.places]
                        slots.append(run.slots)
                        tags.append(kinds)
                        keys.append(crc32(repr(run.slots).encode()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(slots, pa.list_(pa.list_(pa.int32()))), pa.array(tags, pa.list_(pa.int32())), pa.array(keys, pa.int64())],
                ["slots", "tags", "key"],
            )

    found = texts.select("text").mapInArrow(work, "slots array<array<int>>, tags array<int>, key long")
    return found.orderBy("key", "tags").limit(SAMPLE_RUNS).select("slots", "tags")


def train(docs: DataFrame, text: str = "text", row_id: str = "doc_id", rows: int = SAMPLE_ROWS) -> Field:
    table = labelled_runs(docs, text, row_id, rows).toArrow().to_pydict()
    return fit([[tuple(s) for s in run] for run in table["slots"]], table["tags"])


def find(docs: DataFrame, field: Field, text: str = "text", base: str = "base_spans", added: str = "added_spans") -> DataFrame:
    """``docs`` with base and added spans as arrays of (kind, start, end); ``kind``
    indexes ``KINDS``.  Null text counts as empty.  Columns of these names are replaced.
    """
    tw.prepare(docs.sparkSession)
    kept = [f for f in docs.schema.fields if f.name not in (base, added)]
    kind = T.ArrayType(T.StructType.fromDDL("kind int, start int, end int"))
    arrow = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
    schema = T.StructType([*kept, T.StructField(base, kind), T.StructField(added, kind)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(text).to_pylist()]
            met, own = [matches(t) for t in texts], [runs(t) for t in texts]
            fixed = [good for good, _ in met]
            tags = iter(decode(field, [r.slots for found in own for r in found]))
            more = [
                sorted(added_spans(t, found, [next(tags) for _ in found], good + bad))
                for t, found, (good, bad) in zip(texts, own, met)
            ]
            columns = [batch.column(f.name) for f in kept]
            for spans in (fixed, more):
                columns.append(pa.array([[dict(zip(("kind", "start", "end"), s)) for s in x] for x in spans], arrow))
            yield pa.RecordBatch.from_arrays(columns, [*(f.name for f in kept), base, added])

    return docs.select(*[F.col(f"`{f.name}`") for f in kept]).mapInArrow(work, schema)
