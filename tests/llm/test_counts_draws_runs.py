"""Token counts, importance resampling and periodic runs against their definitions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.cases import DOCS, awkward, documents, odd_rows, sentence
from tidewire.llm import importance, periodic_runs, token_counts

VOCABULARY = token_counts.default_vocabulary()
ODD = ["a", "b", " ", "  ", "\n", "\t", "é", "ß", "漢", "字", "😀", "▁", "<s>", "</s>", "<0x0A>", "<unk>", "\0", "the", "tion", ",", ".", "'s", "ﬁ", "　", "\r\n", "23", "ا", "​", "é"]


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=VOCABULARY)


@pytest.fixture(scope="module")
def counter():
    return token_counts.PieceCounter(VOCABULARY)


def test_counts_equal_the_library_on_odd_strings(library, counter):
    rng = random.Random(1)
    for _ in range(4000):
        text = "".join(rng.choice(ODD) for _ in range(rng.randrange(14)))
        assert counter.count(text) == len(library.encode(text)), text


@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=60))
def test_counts_equal_the_library_on_any_text(library, counter, text):
    text = text.encode("utf-8", "ignore").decode()
    assert counter.count(text) == len(library.encode(text))


def test_long_parts_and_forgotten_ones(library, monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 50)
    counter = token_counts.PieceCounter(VOCABULARY)
    rng = random.Random(2)
    for text in ("ab" * 20_000, "the" * 9_000, "漢字" * 5_000, " " * 3_000, sentence(rng, 5_000), "x" * 100):
        for _ in range(2):
            assert counter.count(text) == len(library.encode(text))


def test_token_counts_of_odd_rows(spark, library):
    rows = odd_rows()
    got = {r.doc_id: r[1:] for r in token_counts.token_counts(documents(spark, rows), VOCABULARY).collect()}
    want = {i: (len((t or "").encode()), len(library.encode(t or "")), len(library.encode(t or "")) > 4096) for i, t, *_ in rows}
    assert got == want
    assert token_counts.token_counts(documents(spark, []), VOCABULARY).count() == 0
    odd = token_counts.token_counts(awkward(spark), VOCABULARY, limit=2).collect()
    assert sorted((r.n_bytes, r.n_tokens, r.over_limit) for r in odd) == [(0, 0, False)] + [(13, 3, True)] * 3


# -- importance resampling


def drawn_by_definition(rows, targets, percent, least_words, buckets, longest, seed):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return len(words), [zlib.crc32(" ".join(words[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(words) - n + 1)]

    source, target = Counter(), Counter()
    for _, text, *_ in rows:
        source.update(features(text)[1])
    for text in targets:
        target.update(features(text)[1])
    all_s, all_t = sum(source.values()), sum(target.values())
    out = []
    for doc_id, text, *_ in rows:
        n_words, held = features(text)
        gains = [math.floor(1000 * math.log((target[b] + 1.0) * (all_s + buckets) / ((source[b] + 1.0) * (all_t + buckets)))) for b in held]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(held), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words >= least_words])
    best = sorted((r for r in out if r[4]), key=lambda r: (-r[3], math.inf if r[0] is None else r[0]))
    ranks = [(*r[:4], n) for n, r in enumerate(best[: percent * len(best) // 100], 1)]
    rest = [(*r[:4], None) for r in best[len(ranks) :]] + [(*r[:4], None) for r in out if not r[4]]
    return sorted(ranks + rest, key=repr)


@pytest.mark.parametrize(("percent", "longest"), [(10, 1), (60, 2), (0, 1)])
def test_resampling_equals_its_definition(spark, percent, longest):
    rng = random.Random(4)
    rows = odd_rows() + [(5000 + i, sentence(rng, rng.randrange(40), 60), None, None, 0) for i in range(60)]
    rows += [(7000, "same words " * 15, None, None, 0)] * 9 + [(None, "no id " * 15, None, None, 0)] * 3
    targets = [sentence(rng, 30, 200), "W1 w2", None, ""]
    wanted = drawn_by_definition(rows, targets, percent, 20, 500, longest, 7)
    target = spark.createDataFrame([(t,) for t in targets], "item string")
    for parts in (1, 5)[: longest]:
        got = importance.resample(documents(spark, rows).repartition(parts), target, percent, 20, 500, longest, 7)
        assert sorted(map(tuple, got.collect()), key=repr) == wanted


def test_draw_settles_ties_by_id_then_row(spark):
    rows = spark.createDataFrame([(None if i % 7 == 0 else i // 3, 5 if i < 90 else i, i) for i in range(100)], "doc_id long, score long, row long")
    for wanted in (10, 12, 57, 100):
        got = {r.row: r.rank for r in importance.draw(rows, wanted, F.lit(True)).collect()}
        best = sorted(rows.collect(), key=lambda r: (-r.score, math.inf if r.doc_id is None else r.doc_id, r.row))
        assert got == {r.row: n if n <= wanted else None for n, r in enumerate(best, 1)}


def test_bisection_finds_the_least_number(spark):
    values = [-(2**40), -3, -3, 0, 7, 7, 7, 2**62]
    rows = spark.createDataFrame([(v,) for v in values], "v long")
    for wanted in (1, 3, 6, 8):
        assert importance.least_reaching(rows, F.col("v"), wanted, 1 + wanted % 4) == sorted(values)[wanted - 1]


def test_resampling_of_empty_and_awkward_tables(spark):
    target = spark.createDataFrame([("one two",)], "text string")
    assert importance.resample(documents(spark, []), target).count() == 0
    assert importance.resample(awkward(spark), target.filter("false"), least_words=1, percent=50).filter("rank is not null").count() == 1


# -- periodic runs


def shapes(rng: random.Random) -> list:
    base = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randrange(300))]
    unit = [rng.randrange(3) for _ in range(rng.randrange(1, 8))]
    square = unit * rng.randrange(1, 40) + unit[: rng.randrange(len(unit) + 1)]
    q = rng.randrange(40, 200)
    block = [rng.randrange(1000) for _ in range(q)]
    nested = [rng.randrange(2) for _ in range(rng.randrange(1, 6))]
    for _ in range(3):
        nested = (nested * rng.randrange(1, 5) + [rng.randrange(4) for _ in range(rng.randrange(3))])[:250]
    fibonacci = [[0], [0, 1]]
    while len(fibonacci[-1]) < 300:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    return [
        base, base[:30] + square * 2 + square[: rng.randrange(len(square) + 1)] + base[:20], base[:9] + block * 2 + block[: rng.randrange(q)] + base[:9],
        nested * 2, fibonacci[-1], [bin(i).count("1") % 2 for i in range(400)], (square + [7] + square) * 2,
    ]


def test_runs_equal_their_definition():
    rng = random.Random(5)
    for least in (12, 4):
        for _ in range(12):
            texts = shapes(rng)
            words = periodic_runs.Words([np.array(t, dtype=np.int64) for t in texts], least)
            start, end, period = words.runs()
            bounds = np.searchsorted(start, words.starts)
            for n, text in enumerate(texts):
                mine = slice(bounds[n], bounds[n + 1])
                got = list(zip((start[mine] - words.starts[n]).tolist(), (end[mine] - start[mine]).tolist(), period[mine].tolist()))
                assert got == periodic_runs.runs_by_definition(text, least)


def test_windows_of_equal_hash_are_checked_word_by_word(monkeypatch):
    rng = random.Random(6)
    monkeypatch.setattr(periodic_runs, "mix", lambda z: z % np.uint64(3))  # different words with one hash
    text = [rng.randrange(6) for _ in range(80)] * 2 + [1, 4] * 20
    words = periodic_runs.Words([np.array(text, dtype=np.int64)], 12)
    found = set(zip(*(x.tolist() for x in words.stretches(np.array([0, 170]), np.array([80, 2])))))
    assert {(a, a + n, q) for a, n, q in periodic_runs.runs_by_definition(text) if q in (80, 2) and a <= 170 < a + n or a == 0} <= found


def collapsed(words, found):
    gone = {i for a, n, q in found for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_operator_on_odd_rows(spark):
    rng = random.Random(8)
    rows = odd_rows() + [(9000 + i, " ".join(f"v{x}" for x in t), None, None, 0) for i, t in enumerate(shapes(rng))] + [(9999, sentence(rng, 900) + " " + " ".join(["z y x"] * 9000), None, None, 0)]
    texts = {i: (t or "").encode().split() for i, t, *_ in rows}
    for block in (1, 100_000):
        for r in periodic_runs.periodic_runs(documents(spark, rows).repartition(2), block=block).collect():
            words = [w.decode() for w in texts[r.doc_id]]
            found = [(x.start, x.length, x.period) for x in r.runs]
            if len(words) < 2000:
                assert found == periodic_runs.runs_by_definition(words)
            elif r.doc_id == 9999:
                assert found == [(900, 27_000, 3)]
            assert (r.n_words, r.collapsed) == (len(words), collapsed(words, found))


def test_query_gives_documents_a_periodic_tail_first(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i, sentence(rng, rng.choice([0, 1, 2, 13, 60, 150])), None, None, 0) for i in range(300)] + [(None, "a b " * 20, None, None, 0), (777, None, None, None, 0)]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    want = {}
    for doc_id, text, *_ in rows:
        words = (text or "").split()
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if doc_id is not None and h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = periodic_runs.runs_by_definition(words)
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{a},{b},{c}\n" for a, b, c in found), collapsed(words, found))]
        want[doc_id] = (len(found), *best, best[1] and 1000 * best[1] // best[2], *sha)
    got = {r.doc_id: r[1:] for r in periodic_runs.op13_periodic_runs(spark, str(tmp_path)).collect()}
    assert got == want
    assert sum(bool(x[0]) for x in want.values()) > 5


def test_empty_and_awkward_tables(spark):
    assert periodic_runs.periodic_runs(spark.createDataFrame([], DOCS)).count() == 0
    assert sorted((r.n_words, len(r.runs)) for r in periodic_runs.periodic_runs(awkward(spark)).collect()) == [(0, 0)] + [(3, 0)] * 3
