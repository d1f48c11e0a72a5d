"""Word-table BPE, phrase mining and ranked lexical search against plain versions."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lacuna.llm import lexical, phrases, wordtable
from lacuna.llm import textwork as tw
from test_operators import docs, none, odd  # noqa: F401

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
LOWER = {i: i + 32 for i in range(65, 91)}


# ---- byte-level BPE by distinct words ------------------------------------------


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def cut_words(own, texts):
    out = []
    for part in tw.slices(pa.array(texts)):
        starts, doc_at = wordtable.cut(part, own)
        ends, raw = [*starts, len(part.data)], part.data.tobytes()
        words = [raw[ends[i] : ends[i + 1]].decode() for i in range(len(starts))]
        out += [words[doc_at[i] : doc_at[i + 1]] for i in range(part.rows)]
    return out


def test_words_and_merges_are_those_of_the_library(library):
    own = wordtable.Vocabulary(wordtable.load(VOCABULARY))
    draw = random.Random(3)
    atoms = "'s 't 're 've 'll 'm 'd ' a B é 1 ² 中 . !? re s 😀 | <|endoftext|> <|endoftext |>".split()
    atoms += [" ", "  ", "\n", "\t", "\r\n", " ", "　", "̀", "Ᲊ", "\0"]
    texts = ["".join(draw.choices(atoms, k=draw.randint(0, 14))) for _ in range(8000)]
    texts += ["a" * 3000, "ab" * 2000 + " x", "'s'sabc", "", "ſ K"]
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for text, words, ids in zip(texts, cut_words(own, texts), expected):
        assert "".join(words) == text
        assert [i for w in words for i in own.ids(w)] == ids
    for text in texts[-5:] + texts[:500]:
        ids = [own.byte_ids[b] for b in text.encode()]
        assert own._heap(list(ids)) == own._scan(list(ids))


def test_varints_come_back():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2097151, 2097152, (1 << 28) - 1])
    data, at = wordtable.to_varints(values)
    assert wordtable.from_varints(data).tolist() == values.tolist() and at[-1] == len(data)


def test_documents_are_encoded_as_by_the_library_and_come_back(docs, library):  # noqa: F811
    found = wordtable.decode(wordtable.encode(docs, VOCABULARY, keep_text=True), VOCABULARY).collect()
    assert len(found) == docs.count()
    for row in found:
        assert row.tokens == library.encode(row.text or "", add_special_tokens=False).ids
        assert row.decoded == (row.text or "")


def test_blocks_give_the_same_ids_whatever_their_size(docs, library, monkeypatch):  # noqa: F811
    monkeypatch.setattr(wordtable, "BLOCK_BYTES", 1)
    monkeypatch.setattr(wordtable, "LIST_WORDS", 7)
    monkeypatch.setattr(wordtable, "SLICE_CODES", 50)
    few = docs.where("length(text) < 3000").limit(40).repartition(3)
    for row in wordtable.encode(few, VOCABULARY, keep_text=True).collect():
        assert row.tokens == library.encode(row.text or "", add_special_tokens=False).ids


def test_word_table_edges(odd, none, spark, library):  # noqa: F811
    found = wordtable.encode(odd.withColumn("block", F.lit("b")).withColumn("c0", F.lit("c")), VOCABULARY, into="ids", keep_text=True)
    rows = found.collect()
    assert len(rows) == 10 and all(r.block == "b" and r.c0 == "c" and r.tokens == "t" for r in rows)
    assert all(r.ids == library.encode(r.text or "", add_special_tokens=False).ids for r in rows)
    assert wordtable.decode(wordtable.encode(none, VOCABULARY, into="ids"), VOCABULARY, tokens="ids").count() == 0
    ids = spark.createDataFrame([(1, None), (2, []), (3, [50256, 447]), (4, [447]), (5, [447, 247])], "batch int, tokens array<int>")
    texts = {r.batch: r.decoded for r in wordtable.decode(ids, VOCABULARY).collect()}
    assert texts == {1: "", 2: "", **{k: library.decode(i, skip_special_tokens=False) for k, i in ((3, [50256, 447]), (4, [447]), (5, [447, 247]))}}
    with pytest.raises(Exception, match="outside the vocabulary"):
        wordtable.decode(spark.createDataFrame([([60000],)], "tokens array<int>"), VOCABULARY).collect()


# ---- phrases -----------------------------------------------------------------------


def brute_phrases(rows, least, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                f.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    found = {k: v for k, v in f.items() if len(k) > 2 and v >= least}
    gone = set()
    for (lang, *words), v in found.items():
        for k in range(2, len(words)):
            parts = [(lang, *words[i : i + k]) for i in range(len(words) - k + 1)]
            gone.update(p for p in parts if 100 * v >= 80 * f[p])
    ranked = defaultdict(list)
    for key, a in found.items():
        if key in gone:
            continue
        lang, *words = key
        cuts = []
        for k in range(1, len(words)):
            left, right = f[(lang, *words[:k])], f[(lang, *words[k:])]
            cuts.append((2000000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        ranked[lang].append((-score, -a, " ".join(words).encode(), left, right))
    return sorted(
        (lang, i + 1, p.decode(), -a, left, right, n[lang], -s)
        for lang, some in ranked.items()
        for i, (s, a, p, left, right) in enumerate(sorted(some)[:top])
    )


def mined(df, **options):
    return sorted(map(tuple, phrases.mine(df, **options).collect()))


def test_phrases_are_those_of_a_plain_count(spark):
    draw = random.Random(5)
    fixed = ["a long fixed passage that comes again and again", "New York City", "x y x y x y", "one"]
    rows = []
    for i in range(300):
        parts = [draw.choice(fixed) if draw.random() < 0.5 else " ".join(draw.choices("abcdE", k=draw.randint(0, 6))) for _ in range(4)]
        rows.append((draw.choice([". ", "\t", "\n", " , "]).join(parts), draw.choice(["en", "de", None, ""])))
    df = spark.createDataFrame(rows, "text string, lang string")
    for least, top in ((3, 2000), (10, 5)):
        assert mined(df, least=least, top=top) == brute_phrases(rows, least, top)


def test_unary_paths_hold_a_repeated_passage_once(spark):
    words = [f"w{k}" for k in range(40)]
    counts = [("en", " ".join(words[i : i + k]), 50, k) for k in (3, 4) for i in range(41 - k)]
    found = phrases.unary_paths(spark.createDataFrame(counts, "lang string, phrase string, f long, size int")).collect()
    assert [(r.path, r.f) for r in found] == [(words, 50)]


def test_phrase_edges(odd, none):  # noqa: F811
    rows = [(r.text, r.id and "9") for r in odd.collect()]
    assert mined(odd, lang="id", least=5, top=50) == brute_phrases(rows, 5, 50)
    assert mined(none, lang="key") == []


# ---- ranked lexical search -----------------------------------------------------------


def brute_ranks(docs, items, k=10):  # noqa: F811
    terms = lambda text: Counter(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER)))
    held = [(i, terms(t)) for i, t in docs]
    whole, total = sum(bool(c) for _, c in held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in held:
            m = 25 + (75 * sum(c.values()) * whole) // max(total, 1)
            s = sum(
                n * math.floor(1000 * math.log((2 * whole + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t, n in terms(text).items() if t in c
            )
            scores.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(x for x in scores if x[0] < 0)[:k])]
    return sorted(out, key=str)


def ranked(docs, items, **options):  # noqa: F811
    return sorted(map(tuple, lexical.rank(docs, items, **options).collect()), key=str)


def test_ranks_are_those_of_a_full_scoring(spark, monkeypatch):
    draw = random.Random(11)
    words = [f"w{k}" for k in range(60)]
    weights = [1 / (k + 1) for k in range(60)]
    docs = [(i, " ".join(draw.choices(words, weights, k=draw.randint(0, 30)))) for i in range(800)]  # noqa: F811
    docs += [(1000 + i, docs[5][1]) for i in range(20)] + [(5, docs[5][1]), (None, docs[5][1]), (3, None), (4, "")]
    items = [(i, " ".join(draw.choices(words, k=draw.randint(0, 12)))) for i in range(30)] + [(1, "W1, w2"), (None, "w3"), (40, None)]
    own, asked = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    expected = brute_ranks(docs, items)
    monkeypatch.setattr(lexical, "FIRST_STEP", 2)
    assert ranked(own, asked) == expected
    monkeypatch.setattr(lexical, "SHARD_POSTINGS", 500)
    monkeypatch.setattr(lexical, "ITEM_BLOCK", 7)
    assert ranked(own, asked) == expected


def test_reading_stops_before_the_ends_of_long_lists():
    draw = np.random.default_rng(2)
    size, some = 20_000, (20_000, 10_000, 200)
    for shuffled in (True, False):
        order_of = draw.permutation if shuffled else np.arange
        lists = [(order_of(size)[:n], np.sort(draw.pareto(1.0, n) * 1000).astype(np.int64)[::-1] * 7) for n in some]
        total = np.zeros(size, np.int64)
        for held, adds in lists:
            total[held] += adds
        best, score, read = lexical.nra(lists, size, 10)
        order = np.lexsort((np.arange(size), -total))[:10]
        assert best.tolist() == order.tolist() and score.tolist() == total[order].tolist()
        assert shuffled or read < sum(some) / 10


def test_lexical_edges(odd, none, spark):  # noqa: F811
    items = spark.createDataFrame([(1, "one LINE alpha0"), (2, "")], "item_id int, text string")
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert ranked(odd, items) == brute_ranks(rows, [(1, "one LINE alpha0"), (2, "")])
    assert ranked(none, items) == [] and ranked(odd, items.limit(0)) == []
