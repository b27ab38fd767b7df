"""Every stage on its own input, against a plain version; the package as an optional part."""

from __future__ import annotations

import subprocess
import sys

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.cases import documents, sentence
from tests.llm.test_dedup import classes_by_definition
from tests.llm.test_text_models import hits_by_definition, labels_table, toxic_rows


def folder_of(spark, tmp_path):
    import random

    rng = random.Random(12)
    rows, labels = toxic_rows(240, seed=11)
    item = sentence(rng, 20, 10**6)
    rows += [(1000 + i, rows[i + 1][1], "en", "s", 5) for i in range(4)]  # copies of clean texts
    rows += [(1100, item, "en", "s", 5), (1101, f"{sentence(rng, 900)} {item}", "en", "s", 5)]  # contaminated, and too little of it
    rows += [(1200, "my password = abcdef123 here", "en", "s", 5), (None, "no id", None, None, None), (1300, None, "en", "s", None)]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    labels_table(spark, labels).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return rows, [(1, item)]


def test_each_stage_on_its_own_input(spark, tmp_path):
    rows, items = folder_of(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    kept = {r[0]: r for r in rows}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        path = f"{tmp_path}/stage{n}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        found = [tuple(r) for r in docs.collect()]
        if name == "toxicity":
            kept = {i: r for i, r in kept.items() if i is None or i >= 240 or i % 6}
        elif name == "near_duplicates":
            classes = classes_by_definition(list(kept.values()), 5)
            kept = {i: r for i, r in kept.items() if i is None or classes[i][1] == i}
        elif name == "decontamination":
            hits = hits_by_definition(list(kept.values()), items)
            kept = {i: r for i, r in kept.items() if not (hits[i][1] and 20 * hits[i][1] >= hits[i][0])}
            assert 1101 in kept and 1100 not in kept
        elif name == "secrets":
            kept[1200] = (1200, "my [SECRET] here", "en", "s", 16)
        if n < 4:
            assert docs.columns == columns and sorted(found, key=str) == sorted(kept.values(), key=str), name
        else:
            assert {r[0] for r in found} == set(kept)
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").collect()} == set(kept)


def test_texts_under_one_id_are_judged_each_by_itself(spark, tmp_path):
    import random

    rng = random.Random(21)
    original, clean, one, two, three = (sentence(rng, 60) for _ in range(5))
    near = " ".join([*original.split()[:-1], "changed"])
    rows = [(3, original), (7, clean), (7, near), (8, one), (8, two), (8, two.upper()), (9, two), (9, three), (10, ""), (10, None), (11, three), (6, f"{three} "), (6, three)]
    for i in range(12, 20):  # whichever of two texts has the lower hash
        rows += [(i, sentence(rng, 50)), (i, " ".join([*original.split()[:-1], f"changed{i}"]))]
    docs = documents(spark, [(i, t, "en", "s", 1) for i, t in rows])
    out = [(r.doc_id, (r.text or "").lower().strip()) for r in corpus_pipeline.drop_near_duplicates(spark, docs, str(tmp_path)).collect()]
    want = [(3, original), (7, clean), (8, one), (8, two), (6, three), (10, "")] + [(i, t) for i, t in rows if i >= 12 and "changed" not in t]
    assert sorted(out) == sorted(want)


def test_private_keys_are_masked_whole(spark, tmp_path):
    import random

    rng = random.Random(4)
    body = "\n".join("".join(rng.choices("abcXYZ0189+/", k=64)) for _ in range(26))
    begin, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    fields = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00FF\n\n"
    cases = {
        1: (f"see {begin}\n{body}\nab+/c=\n{end} and more", "see [SECRET] and more"),
        2: (f"see {begin}\n{fields}{body}\n{end}\nand more", "see [SECRET]\nand more"),
        3: (f"see {begin}\n{body}\nab+/c=\n\nWithout an end.", "see [SECRET]\n\nWithout an end."),
        4: (f"see {begin}\r\n{fields}{body}", "see [SECRET]"),
        5: ("see " + f"{begin}\n{body}\n{end}".replace("\n", "\\n") + "\\n and more", "see [SECRET]\\n and more"),
        6: (f"A {begin} line alone is short, and so on", "A [SECRET] line alone is short, and so on"),
        7: (f"{begin}\n{body}\n{end}\nA well-known word\n{begin}\n{body}\n{end}", "[SECRET]\nA well-known word\n[SECRET]"),
        8: (f"see {begin}\n{body}\nis the key.", "see [SECRET]\nis the key."),
    }
    docs = documents(spark, [(i, text, "en", "s", len(text)) for i, (text, _) in cases.items()])
    out = corpus_pipeline.mask_secrets(spark, docs, str(tmp_path)).collect()
    assert {r.doc_id: (r.text, r.n_chars) for r in out} == {i: (want, len(want)) for i, (_, want) in cases.items()}


CLASHES = "_ _hash _n blob findings masked words row carried key toxic score place order n text_hash set_id n_hit spans a.b".split()


def test_other_columns_do_not_matter(spark, tmp_path):
    rows, _ = folder_of(spark, tmp_path)
    plain = spark.read.parquet(f"{tmp_path}/documents.parquet").drop("n_chars")
    extra = [F.concat(F.lit(f"{c} "), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias(c) for c in CLASHES]
    docs = plain.select("*", *extra, F.create_map(F.lit("k"), F.lit(1)).alias("m"))
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        without, with_all = stage(spark, plain, str(tmp_path)), stage(spark, docs, str(tmp_path))
        assert with_all.columns == docs.columns and without.columns == plain.columns, name
        found = with_all.collect()
        assert sorted((tuple(r[:4]) for r in found), key=str) == sorted(map(tuple, without.collect()), key=str), name
        assert all(r[4 + i] == f"{c} {'' if r.doc_id is None else r.doc_id}" for r in found for i, c in enumerate(CLASHES)), name
        for path, df in (("plain", without), ("docs", with_all)):
            df.write.parquet(f"{tmp_path}/{path}{n}")
        plain, docs = spark.read.parquet(f"{tmp_path}/plain{n}"), spark.read.parquet(f"{tmp_path}/docs{n}")
    assert corpus_pipeline.pack_sequences(spark, docs, str(tmp_path)).count() == corpus_pipeline.pack_sequences(spark, plain, str(tmp_path)).count()


def test_empty_documents(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    labels_table(spark, []).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_the_rest_imports_without_this_part(tmp_path):
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('tidewire.llm'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert 'digest_by_slot' in e.queries() and not [q for q in e.queries() if q.startswith('op') or q == 'pipeline']\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)
