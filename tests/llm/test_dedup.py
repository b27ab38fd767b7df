"""The three de-duplication operators against their definitions."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tests.llm.cases import DOCS, awkward, documents, odd_rows, sentence
from tidewire.llm import near_dup, relative_dedup, suffix_dedup

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def classes_by_definition(rows, width, percent=80):
    sets = {}
    for doc_id, text, *_ in rows:
        words = (text or "").translate(UPPER).encode().split()
        sets[doc_id] = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} or ({tuple(words)} if words else set())
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(i for i in sets if i is not None)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i: (len(sets[i]), root(i)) for i in sets}


def test_relative_dedup_equals_its_definition(spark):
    rows = odd_rows()
    out = relative_dedup.relative_dedup(documents(spark, rows)).withColumn("sha", F.sha2("kept_text", 256)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.sha) for r in out} == relative_dedup.removed_by_definition([r[:2] for r in rows])


def test_factors_point_at_equal_words(spark):
    rows = odd_rows()
    words = {r[0]: (r[1] or "").encode().split() for r in rows}
    for row in relative_dedup.relative_dedup(documents(spark, rows)).collect():
        for f in row.factors:
            assert f.length >= relative_dedup.WINDOW
            assert (f.ref_doc, f.ref_start) < (row.doc_id, f.start)
            assert words[row.doc_id][f.start : f.start + f.length] == words[f.ref_doc][f.ref_start : f.ref_start + f.length]


def test_suffix_dedup_equals_its_definition(spark):
    rows = odd_rows(4)
    rng = random.Random(14)
    line = "a line of seventy-one bytes that many texts hold, between words of own."
    for i in range(60):  # one gram in many texts, with as many bytes equal on either side as can be
        left, right = rng.randrange(45), rng.randrange(45)
        rows.append((2000 + i, f"{sentence(rng, 9)}{line[20 - min(left, 20) : 40 + min(right, 31)]}{sentence(rng, 9)}", "en", "src2", 0))
    want = suffix_dedup.removed_by_definition([r[:2] for r in rows])
    out = suffix_dedup.suffix_dedup(documents(spark, rows)).withColumn("sha", F.sha2("kept", 256)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.sha) for r in out} == want
    assert sum(want[2000 + i][1] > 0 for i in range(60)) > 20


def test_suffix_dedup_of_other_widths(spark):
    rng = random.Random(15)
    rows = [(i, "".join(rng.choices("ab", k=rng.randrange(60))), None, None, 0) for i in range(80)]
    for window, gram in ((12, 5), (9, 4), (7, 6)):
        want = suffix_dedup.removed_by_definition([r[:2] for r in rows], window)
        out = suffix_dedup.suffix_dedup(documents(spark, rows), window=window, gram=gram).withColumn("sha", F.sha2("kept", 256)).collect()
        assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.sha) for r in out} == want


def test_near_duplicates_equal_their_definition(spark):
    rng = random.Random(9)
    rows = odd_rows(5)
    words = sentence(rng, 150).split()
    for i in range(40):  # a chain and a cloud around one text: similarities on both sides of the threshold
        changed = list(words)
        for _ in range(rng.randrange(0, 9)):
            changed[rng.randrange(len(changed))] = f"n{rng.randrange(10**6)}"
        rows.append((1000 + i, " ".join(changed).upper() if i % 2 else " ".join(changed), "en", "src1", 0))
    for width in (4, 5):
        out = near_dup.near_duplicates(documents(spark, rows), width=width).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == classes_by_definition(rows, width)


def test_pairs_within_the_threshold_share_a_key():
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(1)
    one = rng.integers(-(2**15), 2**15, (200, near_dup.CHUNKS * near_dup.PLACES)).astype(np.int16)
    two = one.copy()
    for row in two:
        at = rng.choice(len(row), near_dup.threshold(), replace=False)
        row[at] += 1
    batch = pd.DataFrame({"id": np.arange(400), "signature": list(np.concatenate((one, two)))})
    (out,) = near_dup.key_rows(near_dup.CHUNKS, near_dup.PLACES, near_dup.ERRORS)(iter([batch]))
    keys = out.groupby("id")["key"].agg(set)
    assert all(keys[i] & keys[200 + i] for i in range(200))


def test_parities_differ_in_no_more_places_than_the_sets():
    import numpy as np

    rng = np.random.default_rng(2)
    for n in (0, 1, 5, 300, 5000):
        one, two = (rng.integers(0, 2**63, n, dtype=np.uint64) for _ in "ab")
        two[: n * 3 // 4] = one[: n * 3 // 4]
        apart = sum(int(x).bit_count() for x in (near_dup.parities(one) ^ near_dup.parities(two)).view(np.uint64))
        assert apart <= len(np.setxor1d(one, two))
        assert n != 300 or apart >= 120  # and not much fewer, as long as there are more buckets than shingles


def test_components_follow_long_chains(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 99)], "a long, b long")
    found = {r.id: r.component for r in near_dup.components(links).collect()}
    assert found == {**{i: 0 for i in range(61)}, 99: 99, 100: 99, 101: 99}


def test_awkward_rows_and_empty_tables(spark):
    odd, none = awkward(spark), documents(spark, [])
    assert relative_dedup.relative_dedup(none).count() == suffix_dedup.suffix_dedup(none).count() == near_dup.near_duplicates(none).count() == 0
    assert relative_dedup.relative_dedup(odd).agg(F.count("*"), F.sum("n_removed")).first()[:] == (4, 0)
    assert suffix_dedup.suffix_dedup(odd).agg(F.count("*"), F.sum("n_removed")).first()[:] == (4, 0)
    found = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in near_dup.near_duplicates(odd).collect())
    assert found == [("1", 1, "1"), ("1", 1, "1"), ("None", 0, "None"), ("None", 1, "None")]


def test_results_do_not_depend_on_the_partitioning(spark):
    docs = spark.createDataFrame(odd_rows(6), DOCS)
    for operator, column in ((relative_dedup.relative_dedup, "kept_text"), (suffix_dedup.suffix_dedup, "kept")):
        seen = {tuple(sorted((r.doc_id, r.n_removed, str(r[column])) for r in operator(docs.repartition(n)).collect())) for n in (1, 5)}
        assert len(seen) == 1
