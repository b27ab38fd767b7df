"""The training-data pipeline: stages over documents, each written as Parquet and reread by the next.

Rejected go: documents that the toxicity model marks; all but one document (the one with the least id) of each
near-duplicate group; documents contaminated by the benchmark. Secrets are masked in place. The last stage packs the rest into
sequences. Every stage judges texts, not ids, so repeated ids are safe; of rows that share an id and a set of shingles the near-duplicate
stage keeps one. Documents without an id are never linked. A table may have any other columns, also of names that stages use themselves, and
need not have n_chars; null, empty and very long texts go through every stage, and an empty table gives no piece.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewire.llm.base import read
from tidewire.llm.decontaminate import contaminated, decontaminate
from tidewire.llm.near_dup import near_classes
from tidewire.llm.packing import default_vocabulary, pack, token_pieces
from tidewire.llm.secrets import MASKED, blob_of, findings_of, new_ledger, read_ledger, update_ledger, with_findings, without_findings
from tidewire.llm.toxicity import Model, model_for
from tidewire.session import cut_lineage

#: What stands for a secret in a text.
MASK = "[SECRET]"


def toxic_score(model: Model):
    """The model's score as a column function of the text."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = [model.locations(t)[:2] for t in texts]
            yield pd.Series(model.probability(np.array([x[0] for x in found]), np.array([x[1] for x in found])), dtype="float64")

    return score


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, learned from these documents and the labels, does not mark."""
    model = model_for(docs, read(spark, sf_dir, "labels"))
    return docs.filter(toxic_score(model)("text") < 0.5)


def whole_row(docs: DataFrame) -> Column:
    """All columns of a row as one, so that none can clash with what a stage derives."""
    return F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similarity 0.8 or more on five-word shingles; different texts under one id are judged each by itself."""
    classes = near_classes(docs)
    least = classes.filter("doc_id = component_id and set_id = kept_set").groupBy("doc_id", "set_id").agg(F.min("text_hash").alias("text_hash")).drop("set_id")
    comparable = [docs[f"`{f.name}`"] for f in docs.schema if not re.search("map|variant", f.dataType.simpleString())]
    hashed = docs.filter("doc_id is not null").select(
        whole_row(docs), docs["doc_id"].alias("doc_id"), F.xxhash64(docs["text"].cast("string")).alias("text_hash"), F.xxhash64(*comparable).alias("order")
    )
    one_row = Window.partitionBy("doc_id", "text_hash").orderBy("order")
    kept = hashed.join(least, ["doc_id", "text_hash"], "left_semi").withColumn("place", F.row_number().over(one_row)).filter("place = 1")
    return kept.select("row.*").unionByName(docs.filter("doc_id is null"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate."""
    rows = docs.select("doc_id", "text", whole_row(docs))
    judged = decontaminate(rows, read(spark, sf_dir, "benchmark"), carry=("row",)).filter(~contaminated())
    return judged.select("carried.row.*")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by a mark; n_chars, where there is one, follows the text."""
    ledger = new_ledger(spark)
    update_ledger(docs.select("text"), ledger, MASKED)
    findings = cut_lineage(findings_of(read_ledger(spark, ledger), MASKED))
    rows = docs.select(whole_row(docs), F.col("text").cast("string").alias("text"), blob_of(F.col("text")).alias("blob"))
    found = with_findings(rows, findings).select("row", F.size("findings").alias("n"), without_findings(F.col("text"), F.col("findings"), MASK).alias("masked"))
    new = {"text": F.col("masked"), "n_chars": F.when(F.col("n") > 0, F.length("masked")).otherwise(F.col("row").getField("n_chars"))}
    new = {c: value.cast(docs.schema[c].dataType) for c, value in new.items() if c in docs.columns}
    return found.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in which sequence."""
    return pack(token_pieces(docs, default_vocabulary()))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("packing", pack_sequences),
]

#: The toxicity model, the signatures and the tokens have no SQL form; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the last stage returns for the documents of a folder."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
