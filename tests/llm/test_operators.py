"""Operators against brute force, round trips, held-out rows and edge cases."""

from __future__ import annotations

import random
import re
from types import SimpleNamespace
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lacuna.llm import bpe, components, decontam, labelled, linededup, minhash, pii, quality, queries, secretscan, substrings, topk, toxicity
from lacuna.llm import textwork as tw

SMALL = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


@pytest.fixture
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, clashing extra columns."""
    long_text = " ".join(WORDS[(k * k + k // 7) % 19] + str(k % 97) for k in range(40_000))
    rows = [
        (1, "One line here.\nAnother line here.\nAnd a third one."),
        (1, "One line here.\nAnother line here.\nAnd a third one."),
        (2, None),
        (3, ""),
        (4, "   \n\n\t "),
        (5, long_text),
        (6, long_text + " tail"),
        (7, "x" * 200_000),
        (None, "No id. mail me@example.com"),
        (8, "naïve café 10.0.0.1, +49 (30) 1234567, 4111 1111 1111 1111, 你好 🎉"),
    ]
    own = "doc_id long, text string, score double, tokens string, id int, key string, n_lines string, row string"
    return spark.createDataFrame([(i, t, 0.5, "t", 9, "k", "n", "r") for i, t in rows], own)


@pytest.fixture
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SMALL}/labels.parquet")


def first_slice(*texts):
    return next(tw.slices(pa.array(texts), 1 << 40))


# ---- text work ---------------------------------------------------------------


@given(st.lists(st.text(alphabet="ab \n\té中", max_size=30), min_size=1, max_size=6))
@settings(max_examples=60, deadline=None)
def test_words_and_lines_are_those_of_a_plain_split(texts):
    part = first_slice(*texts)
    found = tw.words(part)
    for k, text in enumerate(texts):
        own = slice(found.bounds[k], found.bounds[k + 1])
        raw = [bytes(part.data[a:b]).decode() for a, b in zip(found.start[own], found.end[own])]
        assert raw == re.findall(r"[^\x20\x09-\x0D]+", text)
        alone = tw.words(first_slice(text)).hashes
        assert (alone == found.hashes[own]).all()
    lines = tw.lines(part)
    assert np.diff(lines.bounds).tolist() == [sum(bool(x) for x in t.split("\n")) for t in texts]


# ---- BPE ---------------------------------------------------------------------


@given(st.text(alphabet="abcdeéèñçß the an  \n\t\xa0\x850123's%&*|中文😀", max_size=60))
@settings(max_examples=300, deadline=None)
def test_encoding_is_that_of_the_public_library(text):
    own = bpe.encoder(PATH)
    memo, first = bpe._memos(PATH, PATTERN)
    public = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    got = np.frombuffer(bpe._encoded(text, memo, first), np.int32).tolist() if text else []
    assert got == public.encode_ordinary(text)
    assert b"".join(own.bytes_of[i] for i in got) == text.encode()


def test_bpe_round_trip_and_edges(odd, none):
    back = bpe.decode(bpe.encode(odd, PATH, PATTERN), PATH)
    assert [c for c in odd.columns if c != "tokens"] == [c for c in back.columns if c not in ("tokens", "decoded")]
    for row in back.collect():
        assert bytes(row.decoded).decode() == (row.text or "")
    assert bpe.encode(none, PATH, PATTERN).count() == 0


def test_decoding_of_null_empty_and_unknown_ids(spark):
    words = bpe.encoder(PATH).bytes_of
    rows = [(1, [5, 300, 5]), (2, None), (3, []), (4, [301])]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<int>")
    back = {r.doc_id: bytes(r.decoded) for r in bpe.decode(df, PATH).collect()}
    assert back == {k: b"".join(words[i] for i in ids or []) for k, ids in rows}
    assert [bytes(r.decoded) for r in bpe.decode(df.where("doc_id in (2, 3)"), PATH).collect()] == [b"", b""]
    with pytest.raises(Exception, match="(?i)out of bounds|outside the vocabulary"):
        bpe.decode(spark.createDataFrame([([max(words) + 1],)], "tokens array<int>"), PATH).collect()


def test_a_task_gives_up_its_encoder_if_asked(spark):
    texts = spark.createDataFrame([(k, f"one two {k} three") for k in range(20)], "doc_id long, text string").repartition(1)
    kept = bpe.encode(texts, PATH, PATTERN).collect()
    assert sorted(bpe.encode(texts, PATH, PATTERN, keep=False).collect()) == sorted(kept)
    work = bpe.tw.tidy(lambda batches: batches, bpe._memos, bpe.encoder)
    bpe._memos(PATH, PATTERN)
    assert list(work(iter([]))) == [] and not bpe._memos.cache_info().currsize and not bpe.encoder.cache_info().currsize


# ---- MinHash -----------------------------------------------------------------


def brute_components(texts: dict[int, str | None], percent=85) -> dict[int, int]:
    sets = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    low = {i: i for i in texts}
    changed = True
    while changed:
        changed = False
        for a in texts:
            for b in texts:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both) and low[b] < low[a]:
                    low[a], changed = low[b], True
    return low


def test_near_duplicates_match_brute_force_on_copies_near_the_threshold(spark):
    rng = random.Random(5)
    base = [f"w{rng.randrange(900)}" for _ in range(150)]
    texts = {}
    for i in range(120):
        own = list(base) if i % 3 else [f"v{rng.randrange(900)}" for _ in range(60)]
        for _ in range(rng.choice([0, 1, 2, 3, 4])):
            own[rng.randrange(len(own))] = f"e{rng.randrange(10**6)}"
        texts[i] = " ".join(own)
    texts |= {200: "Only three words", 201: "only THREE\twords", 202: "", 203: None, 204: " \n "}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.id: r.component_id for r in minhash.near_duplicates(df).collect()}
    assert got == brute_components(texts)


def test_estimate_is_corrected_for_chance(spark):
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    b = np.concatenate([a[:3000], rng.integers(0, 1 << 63, 1000, dtype=np.uint64)])
    low = np.array([minhash.minima(a), minhash.minima(b), minhash.minima(rng.integers(0, 1 << 63, 4000, dtype=np.uint64))])
    packed = minhash._packed(low).tolist()
    df = spark.createDataFrame([(packed[0], packed[1], packed[2])], "a array<long>, b array<long>, c array<long>")
    near, far = df.select(minhash.estimate(F.col("a"), F.col("b")), minhash.estimate(F.col("a"), F.col("c"))).first()
    assert near == pytest.approx(0.6, abs=0.2) and far == pytest.approx(0, abs=0.15)


def test_near_duplicates_edges(odd, none):
    rows = minhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by = {r.id: r for r in rows}
    assert by[6].component_id == 5 and not by[6].kept and by[5].kept
    assert by[2].n_shingles == by[3].n_shingles == by[4].n_shingles == 0 and by[3].kept
    assert by[None].component_id is None and not by[None].kept
    assert minhash.near_duplicates(none).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3)]
    got = {r.id: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 160)}}


# ---- lines -------------------------------------------------------------------


def brute_lines(rows: list[tuple[int, str]], run: int) -> dict[int, str]:
    seen, gone = set(), set()
    for i, text in sorted(rows):
        own = [x for x in text.split("\n") if x]
        for a in range(len(own) - run + 1):
            window = tuple(own[a : a + run])
            if window in seen:
                gone |= {(i, a + k) for k in range(run)}
            seen.add(window)
    out = {}
    for i, text in rows:
        kept, at = [], 0
        for line in text.split("\n"):
            if line:
                at += 1
                if (i, at - 1) in gone:
                    continue
            kept.append(line)
        out[i] = "\n".join(kept) if any(kept) else ""
    return out


@pytest.mark.parametrize("run", [1, 2, 3])
def test_line_dedup_matches_brute_force(spark, run):
    rng = random.Random(run)
    rows = [(i, "\n".join(rng.choice(["", "a", "b", "c", "d e", "f"]) for _ in range(rng.randrange(12)))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in linededup.dedupe_lines(df, run=run).collect()}
    assert got == brute_lines(rows, run)


def test_line_dedup_edges(odd, none):
    rows = linededup.dedupe_lines(odd).collect()
    assert len(rows) == odd.count() and {r.doc_id for r in rows} == {1, 2, 3, 4, 5, 6, 7, 8, None}
    assert all(r.n_deleted == 0 for r in rows) and next(r for r in rows if r.doc_id == 2).text is None
    assert linededup.dedupe_lines(none).count() == 0


# ---- decontamination -----------------------------------------------------------


def plain_alignment(text, item):
    best, rows = 0, [[0] * (len(text) + 1) for _ in range(len(item) + 1)]
    for i, x in enumerate(item):
        for j, y in enumerate(text):
            rows[i + 1][j + 1] = max(0, rows[i][j] + (2 if x == y else -1), rows[i][j + 1] - 1, rows[i + 1][j] - 1)
            best = max(best, rows[i + 1][j + 1])
    return best


def test_alignment_scores_are_those_of_the_plain_recurrence():
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 6, rng.integers(1, 40)) for _ in range(80)]
    items = [rng.integers(0, 6, rng.integers(1, 25)) for _ in range(80)]
    best, _ = decontam.align(texts, items)
    assert best.tolist() == [plain_alignment(t.tolist(), i.tolist()) for t, i in zip(texts, items)]


def test_exact_and_edited_copies_are_found_and_other_texts_are_not(spark, odd, none):
    rng = random.Random(8)
    item = [f"q{k}" for k in range(40)]
    edited = [w for k, w in enumerate(item) if k % 9 != 4]
    edited[10] = "changed"
    noise = lambda n: [f"n{rng.randrange(500)}" for _ in range(n)]
    rows = [(1, " ".join(noise(300) + item + noise(50))), (2, " ".join(noise(20) + edited + noise(90)))]
    rows += [(3, " ".join(noise(400))), (4, " ".join(item[:5] + noise(100))), (5, None), (6, "")]
    items = spark.createDataFrame([(10, " ".join(item).upper()), (11, None), (12, "two words"), (10, "short")], "item_id long, text string")
    found = {r.doc_id: r for r in decontam.find_copies(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()}
    assert set(found) == {1, 2} and found[1].score == 1.0 and 0.6 < found[2].score < 1
    assert (found[1].first_word, found[1].end_word) == (300, 340)
    assert decontam.find_copies(odd, items).count() == 0 and decontam.find_copies(none, items).count() == 0
    assert decontam.find_copies(odd, items.limit(0)).count() == 0


@pytest.mark.parametrize("step", [3, 4, 5])
def test_a_lone_edited_copy_is_found_without_any_whole_trigram(spark, step):
    rng = random.Random(step)
    item = [f"q{k}" for k in range(40)]
    noise = lambda n: [f"n{rng.randrange(500)}" for _ in range(n)]
    replaced = [f"z{k}" if k % step == step - 1 else w for k, w in enumerate(item)]
    filled = [w for k, x in enumerate(item) for w in ([f"y{k}", x] if k % step == 0 else [x])]
    rows = [(1, " ".join(noise(99) + replaced + noise(30))), (2, " ".join(noise(60) + filled + noise(9)))]
    items = spark.createDataFrame([(10, " ".join(item))], "item_id long, text string")
    found = {r.doc_id for r in decontam.find_copies(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()}
    assert found == {1, 2}


def test_seeds_lose_no_pair_that_aligns(spark):
    rng = random.Random(21)
    items = [(i, [f"i{i}w{rng.randrange(30)}" for _ in range(rng.choice([7, 12, 25]))]) for i in range(12)]
    rows = []
    for k in range(240):
        rate, own = rng.uniform(0, 0.5), []
        for w in items[k % 12][1]:
            x = rng.random()
            own += [w] if x > rate else [[], [f"x{len(own)}"], [f"x{len(own)}", w]][rng.randrange(3)]
        rows.append((k, ["pad"] * 5 + own + ["pad"] * 5))
    want = {
        (k, i) for k, text in rows for i, item in items if plain_alignment(text, item) >= len(item)
    }
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in rows], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.find_copies(docs, bench).collect()}
    assert got == want and len(want) > 100


def test_copies_in_other_case_are_found_in_all_scripts(spark):
    item = "Ärger über Öfen, straße ΟΔΟΣ Нева élan Ñandú Žena łódź".split()
    docs = spark.createDataFrame([(1, " ".join(item).upper())], "doc_id long, text string")
    (row,) = decontam.find_copies(docs, spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")).collect()
    assert row.score == 1.0


def test_no_task_of_decontamination_has_several_python_processes(spark, monkeypatch):
    plans, store = [], decontam.cut_lineage

    def stored(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(df)

    monkeypatch.setattr(decontam, "cut_lineage", stored)
    item = " ".join(f"w{k}" for k in range(30))
    docs = spark.createDataFrame([(1, item), (2, "nothing of it")], "doc_id long, text string")
    found = decontam.find_copies(docs, spark.createDataFrame([(7, item)], "item_id long, text string"))
    assert [(r.doc_id, r.item_id) for r in found.collect()] == [(1, 7)]
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    for plan in plans:
        for stage in plan.split("Exchange"):
            assert stage.count("MapInArrow") <= 1, plan


# ---- passages ----------------------------------------------------------------


def test_windows_are_the_smallest_tokens_of_all_passages():
    rng = np.random.default_rng(4)
    tokens = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    bounds = np.array([0, 150, 150, 180, 400])
    length = 20
    _, doc, place, lo, hi = substrings.compact_windows(tokens, bounds, length)
    covered = {(d, s) for d, a, b in zip(doc, lo, hi) for s in range(a, b + 1)}
    assert covered == {(d, s) for d in range(4) for s in range(bounds[d + 1] - bounds[d] - length + 1)}
    for d, p, a, b in zip(doc, place, lo, hi):
        assert a <= b and b <= p < a + length  # the smallest token lies in every passage of its window


def test_repeated_passages_are_found_wherever_they_stand(spark, odd, none):
    rng = random.Random(3)
    noise = lambda n: [f"n{rng.randrange(10**6)}" for _ in range(n)]
    passage = noise(60)
    rows = [(i, " ".join(noise(rng.randrange(200)) + passage + noise(rng.randrange(200)))) for i in range(30)]
    rows += [(100 + i, " ".join(noise(150))) for i in range(20)] + [(300, " ".join(passage[:40] + noise(40)))]
    found = substrings.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in found} == set(range(1, 30)) and {r.source_id for r in found} == {0}
    for r in found:
        words = dict(rows)[r.doc_id].split()[r.first_word : r.end_word]
        assert len(words) >= 50 and len(set(words) & set(passage)) >= 40
    assert {6} <= {r.doc_id for r in substrings.repeated_passages(odd).collect()} <= {5, 6}  # 5 has a cycle
    assert substrings.repeated_passages(none).count() == 0


def test_all_exact_repeats_of_50_words_and_more_are_found(spark):
    rng = random.Random(11)
    noise = lambda n: [f"n{rng.randrange(10**7)}" for _ in range(n)]
    rows, want = [], {}
    for k in range(200):
        n, before, other = rng.randrange(50, 61), rng.randrange(100), rng.randrange(100)
        passage = noise(n)
        rows += [(2 * k, " ".join(noise(before) + passage + noise(99))), (2 * k + 1, " ".join(noise(other) + passage + noise(99)))]
        want[2 * k + 1] = (other, other + n)
    cycle = noise(55)
    rows.append((1000, " ".join(noise(30) + cycle + cycle + noise(30))))
    found = {r.doc_id: r for r in substrings.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(found) == {*want, 1000}
    for k, (first, end) in want.items():
        assert found[k].source_id == k - 1 and found[k].first_word <= first and found[k].end_word >= end
    assert found[1000].first_word >= found[1000].source_end_word


def test_passages_just_over_the_similarity_are_found(spark):
    rng = random.Random(12)
    rows = []
    for k in range(200):
        passage = [f"n{rng.randrange(10**7)}" for _ in range(70)]
        near = [*passage[:25], "changed", *passage[26:]]  # 46 tokens at either end differ in 5 at most
        rows += [(2 * k, " ".join(passage)), (2 * k + 1, " ".join(near))]
    found = {r.doc_id for r in substrings.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {2 * k + 1 for k in range(200)}


def test_variants_after_the_first_of_their_keys_are_compared(spark, monkeypatch):
    monkeypatch.setattr(substrings, "HASHES", 1)
    rng = random.Random(17)
    word = lambda n: [f"n{rng.randrange(10**7)}" for _ in range(n)]
    rows, want = [], set()
    for k in range(40):
        passage = word(70)
        # three texts of which the later two are alike, but not the first and these
        first = [*passage[:30], *word(40)]
        second = [*passage[:35], "changed", *passage[36:]]
        rows += [(3 * k, " ".join(first)), (3 * k + 1, " ".join(passage)), (3 * k + 2, " ".join(second))]
        want.add((3 * k + 2, 3 * k + 1))

    def shares_first_key(k):
        keys = []
        for _, text in rows[3 * k : 3 * k + 3]:
            part = next(substrings.tw.slices(substrings.pa.array([text])))
            tokens, _, bounds = substrings.tw.grams(substrings.tw.words(part), substrings.SHINGLE)
            keys.append(set(substrings.compact_windows(tokens, bounds)[0].tolist()))
        return keys[1] & keys[2] and not keys[1] & keys[2] - keys[0]

    hidden = {k for k in range(40) if shares_first_key(k)}
    assert hidden  # nothing but keys whose first holder is another text
    for block in (substrings.BLOCK, 1):
        monkeypatch.setattr(substrings, "BLOCK", block)
        found = substrings.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        pairs = {(r.doc_id, r.source_id) for r in found}
        assert {(3 * k + 2, 3 * k + 1) for k in hidden} <= pairs <= want


def test_passages_get_an_earlier_similar_one_if_there_is_one():
    rng = np.random.default_rng(23)
    length, half = substrings.LENGTH, 0
    for case in range(30):
        base = rng.integers(0, 1 << 31, 91, dtype=np.int32)
        if case % 3 == 0:  # repeated tokens
            base[rng.integers(0, 91, 12)] = base[0]
        rows, tokens = [], []
        for k in range(14):
            # each changes some tokens of one before, so that chains come about
            like = rng.integers(0, k) if k else 0
            full = base.copy() if not k else whole[like].copy()
            whole = [full] if not k else [*whole, full]
            full[rng.integers(0, 91, rng.integers(0, 7))] = rng.integers(0, 1 << 31)
            full[45] = base[45]
            lo, hi = (0, 45) if not k else sorted(rng.integers(0, 46, 2).tolist())
            rows.append((k // 2, k // 2, 45 + 200 * (k % 2), lo + 200 * (k % 2), hi + 200 * (k % 2)))
            tokens.append(full[lo : hi + length])
        side = rng.integers(0, 2, 14)
        for cross in (False, True):
            met, uncovered = substrings.sources(rows, tokens, side, np.ones(14, bool), cross)
            alike = lambda i, k, r: substrings._similarity(*(tokens[x][r + rows[x][2] - rows[x][3] :][:length] for x in (i, k))) >= substrings.SIMILAR
            holds = lambda k, r: rows[k][3] <= rows[k][2] + r <= rows[k][4]
            for i in range(1, 14):
                places = range(rows[i][3] - rows[i][2], rows[i][4] - rows[i][2] + 1)
                assert (i in uncovered) == any(not alike(i, 0, r) for r in places)
                for r in places:
                    some = [k for k in range(i) if holds(k, r) and (not k or not cross or side[i] != side[k]) and alike(i, k, r)]
                    got = [k for a, k in met if a == i and holds(k, r) and alike(i, k, r)]
                    assert bool(some) == bool(got) and set(got) <= set(some)
                    half += bool(some) and 0 not in some
    assert half > 100  # passages whose only sources are later variants


def test_rows_that_share_tokens_but_no_passage_are_not_compared(monkeypatch):
    rng = np.random.default_rng(31)
    length = substrings.LENGTH
    # each row takes every token from another one of the pool, so none has a similar one
    pool = np.sort(rng.integers(0, 1 << 31, (40, 2 * length - 1), dtype=np.int32))
    rows, tokens = [], []
    for k in range(300):
        full = pool[rng.integers(0, 40, 2 * length - 1), np.arange(2 * length - 1)]
        full[length - 1] = 0
        rows.append((k, k, length - 1, 0, length - 1))
        tokens.append(full)
    compared, alike = [], substrings.alike
    monkeypatch.setattr(substrings, "alike", lambda *args: compared.append(1) or alike(*args))
    assert substrings.sources(rows, tokens, np.zeros(300, int), np.zeros(300, bool), False) == ([], [])
    assert not compared
    near = tokens[200].copy()
    near[:4] = -1
    found, _ = substrings.sources([*rows, (300, 300, length - 1, 0, length - 1)], [*tokens, near], np.zeros(301, int), np.zeros(301, bool), False)
    assert [(int(i), int(k)) for i, k in found] == [(300, 200)] and len(compared) == 1


def test_parts_compared_at_once_are_those_compared_one_by_one():
    rng = np.random.default_rng(41)
    length = substrings.LENGTH
    for few in (10**9, 60):  # the tokens of the second come again
        x, y, sizes, parts, most = [], [], [], [], []
        for k in range(60):
            one = rng.integers(0, few, rng.integers(length, 4 * length), dtype=np.uint64)
            two = one.copy()
            two[rng.integers(0, len(one), rng.integers(0, 12))] = rng.integers(0, few, dtype=np.uint64)
            if k % 3 == 0:
                two = np.roll(two, rng.integers(-5, 6))
            x.append(one)
            y.append(two)
            sizes.append(len(one))
            most.append(rng.integers(0, 5 * length))
            for _ in range(rng.integers(1, 4)):
                lo = rng.integers(0, len(one) - length + 1)
                parts.append((k, lo, rng.integers(lo + length, len(one) + 1)))
        own, begin, end, s = substrings.many_alike(np.concatenate(x), np.concatenate(y), np.array(sizes), tuple(np.array(parts).T), np.array(most))
        want = [(k, lo + a, lo + b, v) for k, lo, hi in parts for a, b, v in substrings.alike(x[k][lo:hi], y[k][lo:hi], most[k])]
        assert sorted(zip(own.tolist(), begin.tolist(), end.tolist(), s.tolist())) == sorted(want)
        assert len({v for *_, v in want}) > 5


def test_rows_of_a_key_are_compared_at_once(monkeypatch):
    """Not pair by pair, and small keys together: families of near copies, and what they get."""
    rng = np.random.default_rng(43)
    length = substrings.LENGTH
    groups = []
    for size in (3, 9, 40, 130):
        roots = rng.integers(0, 1 << 31, (max(size // 6, 1), 2 * length - 1), dtype=np.int32)
        tokens = []
        for _ in range(size):
            full = roots[rng.integers(0, len(roots))].copy()
            full[rng.integers(0, 2 * length - 1, 4)] = rng.integers(0, 1 << 31, 4)
            full[length - 1] = 0
            tokens.append(full)
        groups.append(([(k, k, length - 1, 0, length - 1) for k in range(size)], tokens))
    calls, alike = [], substrings.alike
    monkeypatch.setattr(substrings, "alike", lambda *args: calls.append(1) or alike(*args))
    one_by_one = [substrings.sources(rows, tokens, np.zeros(len(rows), int), np.ones(len(rows), bool), False) for rows, tokens in groups]
    assert len(calls) < 20 < sum(len(found) for found, _ in one_by_one)
    group = np.repeat(np.arange(len(groups)), [len(rows) for rows, _ in groups])
    w = tuple(np.array([r for rows, _ in groups for r in rows], np.int64).T)
    flat = [t for _, tokens in groups for t in tokens]
    sizes = np.array([len(t) for t in flat])
    later, earlier, uncovered = substrings.small_sources(group, w, np.concatenate(flat), sizes, np.ones(len(flat), bool))
    begin = np.searchsorted(group, np.arange(len(groups)))
    assert list(zip(later, earlier)) == [(a + i, a + k) for a, (found, _) in zip(begin, one_by_one) for i, k in found]
    assert uncovered.tolist() == [a + i for a, (_, lone) in zip(begin, one_by_one) for i in lone]


def test_windows_of_keys_met_once_are_not_sent(spark):
    text = lambda k: " ".join(f"n{k * 1000 + j}" for j in range(120))
    rows = spark.createDataFrame([(k, k, text(k)) for k in range(50)], "doc_id long, row long, text string")
    again = rows.where("doc_id = 7")
    often = substrings._windows(again.union(again)).groupBy("key").count().select("key")
    sent = substrings._windows(rows, substrings.tw.bitmap(often)).collect()
    assert {r.doc_id for r in sent} == {7}


# ---- top-k -------------------------------------------------------------------


def test_top_k_is_exact_with_ties_copies_and_unusable_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 90)
    rng = np.random.default_rng(6)
    table = rng.normal(0, 0.3, (500, 6)).round(2)
    table[100:250] = table[100]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(table)]
    rows += [(500, None), (550, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (600, [float("nan")] * 6), (None, [1.0] * 6), (650, []), (700, [9.0, 9.0]), rows[3]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("query_id", F.lit("x"))
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") % 50 == 0).collect()}
    whole = np.floor(256 * table).astype(int)
    for q in range(0, 500, 50):
        scores = whole @ whole[q]
        order = sorted((-s, i) for i, s in enumerate(scores) if i != q)[:5]
        assert [got[q, k + 1] for k in range(5)] == [(i, -s) for s, i in order]
    assert {q for q, _ in got} == set(range(0, 500, 50))
    assert topk.top_k(df.limit(0), F.lit(True)).count() == 0


# ---- personal data -------------------------------------------------------------


PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
)


@given(st.text(alphabet="a@.-+ ()0125489\n", max_size=60))
@settings(max_examples=500, deadline=None)
def test_base_spans_are_those_of_the_plain_patterns(text):
    good = (lambda s: True, lambda s: all(int(p) <= 255 for p in s.split(".")), pii._card_ok, lambda s: 9 <= len(re.sub("[^0-9]", "", s)) <= 15)
    plain = [(k, m.start(), m.end()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text) if good[k](m[0])]
    assert pii.base_spans(text) == plain


def test_viterbi_finds_the_best_tags():
    rng = np.random.default_rng(3)
    n = pii.NONE + 1
    field = pii.Field(rng.normal(0, 1, (1 << pii.SLOT_BITS, n)), rng.normal(0, 1, (n, n)), rng.normal(0, 1, (2, n)))
    slots = [[tuple(rng.integers(0, 1 << pii.SLOT_BITS, 3)) for _ in range(size)] for size in (1, 2, 4, 3, 4)]

    def value(run, tags):
        own = sum(field.emit[list(s), t].sum() for s, t in zip(run, tags)) + field.edge[0, tags[0]] + field.edge[1, tags[-1]]
        return own + sum(field.move[a, b] for a, b in zip(tags, tags[1:]))

    for run, tags in zip(slots, pii.decode(field, slots)):
        every = np.array(np.meshgrid(*[range(n)] * len(run))).reshape(len(run), -1).T
        assert value(run, list(tags)) == pytest.approx(max(value(run, list(t)) for t in every))


def test_field_learns_the_kinds_and_edges(docs, odd, none):
    texts = [f"{w} user{k}@host{k % 7}.org or 10.{k}.0.{k % 9} or +49 30 12345{k:03d} in {1900 + k}" for k, w in enumerate(["see", "ask", "try"] * 60)]
    slots, tags = [], []
    for t in texts:
        spans = pii.base_spans(t)
        for run in pii.runs(t):
            slots.append(run.slots)
            tags.append([next((k for k, a, b in spans if a < y and b > x), pii.NONE) for x, y in run.places])
    field = pii.fit(slots[:300], tags[:300])
    right = [list(a) == list(b) for a, b in zip(pii.decode(field, slots[300:]), tags[300:])]
    assert np.mean(right) > 0.95
    found = {r.doc_id: r for r in pii.find(odd, pii.train(docs)).collect()}
    assert {s.kind for s in found[8].base_spans} == {1, 2, 3} and [s.kind for s in found[None].base_spans] == [0]
    assert found[2].base_spans == [] and pii.find(none, pii.fit([], [])).count() == 0


# ---- classifiers ---------------------------------------------------------------


def area(score, label):
    order = np.argsort(np.argsort(score)) + 1
    n = label.sum()
    return (order[label == 1].sum() - n * (n + 1) / 2) / (n * (len(label) - n))


@pytest.mark.parametrize("module, label, divisor, out", [(quality, "quality", 5, 0), (toxicity, "toxic", 4, 2)])
def test_held_out_rows_are_ranked_well(spark, module, label, divisor, out):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = module.train(docs, labels, labelled.remainder("doc_id", divisor) != out, rows=3000)
    held = docs.join(labels, "doc_id").where(labelled.remainder("doc_id", divisor) == out)
    rows = module.score(held, model).select("doc_id", "score", label).collect()
    assert all(crc32(str(r.doc_id).encode()) % divisor == out for r in rows)
    assert area(np.array([r.score for r in rows]), np.array([r[label] for r in rows])) > 0.9


def test_scores_do_not_depend_on_neighbours_or_other_columns(docs, labels):
    net = quality.train(docs, labels, F.lit(True), rows=60)
    weights = toxicity.train(docs, labels, F.lit(True), rows=60)
    texts = [r.text for r in docs.orderBy("doc_id").limit(12).collect()] + ["", "   "]
    for score in (lambda p: quality.probabilities(net, p), lambda p: toxicity.noisy_or(b := toxicity.bags(p), toxicity.log_odds(b, weights))):
        together = score(first_slice(*texts))
        assert together == pytest.approx([score(first_slice(t))[0] for t in texts], abs=1e-5)


def test_noisy_or_is_one_minus_the_product():
    part = first_slice("bad word here. fine one! ok", "", "x")
    own = toxicity.bags(part)
    z = np.array([0.3, -2.0, -1.0, 0.5])
    p = 1 / (1 + np.exp(-z))
    assert toxicity.noisy_or(own, z) == pytest.approx([1 - np.prod(1 - p[:3]), 0, p[3]])


def test_offending_sentences_are_code_points_of_the_text(spark):
    rows = [(k, ("né. This is vile stuff! " if k % 2 else "né. This is plain stuff! ") + f"w{k}.") for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    marked = df.select("doc_id", (F.col("doc_id") % 2).alias("toxic"))
    weights = toxicity.train(df, marked, F.lit(True))
    for r in toxicity.score(df, weights).collect():
        if r.doc_id % 2:
            assert [r.text[s.start : s.end] for s in r.sentences] == ["This is vile stuff"] and r.score >= 0.3
        else:
            assert r.sentences == [] and r.score < 0.3


def test_classifier_edges(odd, none, labels):
    for module in (quality, toxicity):
        model = module.train(none, labels, F.lit(True), label="quality")
        rows = module.score(odd, model).collect()
        assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
        assert module.score(none, model).count() == 0


def test_registered_counts_are_those_of_the_kinds(spark, tmp_path):
    rows = [
        (1, "a@b.org c@d.org e@f.org 10.0.0.1"), (2, "10.0.0.1 10.0.0.2"), (3, "4111 1111 1111 1111"),
        (4, "call +49 30 1234567 now"), (5, None), (None, "no id a@b.org"),
    ]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone) for r in queries.op4_pii(spark, str(tmp_path)).collect()}
    assert found == {1: (3, 1, 0, 0), 2: (0, 2, 0, 0), 3: (0, 0, 1, 0), 4: (0, 0, 0, 1), 5: (0, 0, 0, 0), None: (1, 0, 0, 0)}


# ---- secrets -------------------------------------------------------------------


def test_secrets_are_told_from_other_findings_on_rows_without_labels(spark, odd, none):
    rng = random.Random(9)
    rows = []
    for k in range(400):
        key = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        rows.append((k, f"some words token = {key} end" if k % 2 else f"see report of summer{k}holiday and mail{k}@example.com"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = secretscan.candidates(df)
    known = found.where("doc_id % 4 < 2").select("doc_id", "word_index", (F.col("doc_id") % 2).alias("label"))
    scored = secretscan.scan(df, known).where("doc_id % 4 >= 2").collect()
    assert len(scored) >= 200
    assert all((r.score >= 0.5) == bool(r.doc_id % 2) for r in scored)
    plan = secretscan.features(found, secretscan.dictionary(df))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert secretscan.scan(none).count() == 0
    odd_one = odd.union(odd.limit(1).withColumn("text", F.lit("token = 0123456789abcdef0123")))
    assert [(r.value, r.word_index) for r in secretscan.scan(odd_one).collect()] == [("0123456789abcdef0123", 2)]


def test_known_words_are_not_encoded_again_with_their_punctuation(monkeypatch):
    pieces = []
    own = bpe.Encoder.piece
    monkeypatch.setattr(bpe.Encoder, "piece", lambda self, piece: pieces.append(piece) or own(self, piece))
    memo, first = bpe._memos.__wrapped__(PATH, PATTERN)
    text = "x zutekeit zutekeit. zutekeit.$$$ zutekeit\nAnd And"
    packed = bpe._encoded(text, memo, first)
    assert pieces.count(b" zutekeit") == 1 and pieces.count(b".") == 1
    expected = [i for m in memo.cut.finditer(text) for i in own(memo.own, m[0].encode())]
    assert np.frombuffer(packed, np.int32).tolist() == expected


def test_regions_are_aligned_at_about_their_own_width(monkeypatch):
    rng = np.random.default_rng(6)
    words = [list(map(int, rng.integers(0, 50, n))) for n in [30] * 3000 + [3000]]
    items = [w[:20] for w in words]
    rows = {"id": range(3001), "body": range(3001), "item_id": [0] * 3001, "first": [0] * 3001, "words": words, "item_words": items}
    cells = []
    align = decontam.align

    def counted(texts, items):
        cells.append(len(texts) * max(map(len, texts)))
        return align(texts, items)

    monkeypatch.setattr(decontam, "align", counted)
    frame = SimpleNamespace(mapInArrow=lambda work, schema: work)
    work = decontam._aligned(frame, 0.5)
    (got,) = work(iter([pa.RecordBatch.from_pydict({k: list(v) for k, v in rows.items()})]))
    assert got["score"].to_pylist() == [1.0] * 3001 and got["first_word"].to_pylist() == [0] * 3001
    assert sum(cells) < 4 * sum(map(len, words))
