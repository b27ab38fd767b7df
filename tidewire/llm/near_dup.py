"""Near-duplicate documents by a multi-index Hamming join of MinHash signatures.

Each document's set of word shingles has a signature of places, b bits of a MinHash at each. Signatures are compared by the
number of places that differ. Split into chunks, two signatures within the threshold have a chunk with few errors (pigeonhole);
each chunk is therefore indexed once for each way of leaving out as many places as errors are allowed, so that every pair
within the threshold meets under some key. Every candidate is confirmed on the full sets.

Classes need connections, not all pairs, so keys are read twice. First every document of a key is compared with the key's
smallest one; the links give components. Then only pairs of a key whose components differ, and whose signatures are within
the threshold, are compared. Documents with equal sets are one representative throughout. Before such a pair's sets are
fetched, a lossless bound on their difference is checked: of each set the parity of its shingles in each of 1,024 buckets is
kept; bits in which two sets differ are never more than the shingles in which they differ.

Production parameters: 80 places of 16 bits in 16 chunks of 5, one error each, so all pairs that differ in at most 31 places
meet; a pair of similarity 0.8 differs in 16 on average and in more than 31 with a probability of about 3.3e-5.

Words are [^\\x20\\x09-\\x0D]+ with A-Z lowered. Shingles are compared by 64 bits of hash, equal sets by 128. Null text and
texts without words have the empty set and are linked with nothing. Rows without an id are not linked and are their own class
(null). Rows that share an id are one document for linking if their sets are equal; otherwise each set is linked by itself.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewire.llm.base import Rolling, U, id_and_text, mix, read, word_hashes
from tidewire.session import cut_lineage

CHUNKS, PLACES, ERRORS = 16, 5, 1
#: Partners that are sent to a task together with one set.
BLOCK = 64
#: Buckets whose parity is kept of each set.
PARITIES = 1024


def threshold(chunks: int = CHUNKS, errors: int = ERRORS) -> int:
    """The greatest number of differing places for which a chunk with at most `errors` errors is certain."""
    return chunks * (errors + 1) - 1


def shingles(text: str | None, width: int) -> np.ndarray:
    """The sorted distinct shingles of a text; one of all words if there are fewer than the width."""
    words = word_hashes(text, lowered=True)
    if not len(words):
        return np.zeros(0, dtype=np.uint64)
    rolling = Rolling(words)
    if len(words) < width:
        return rolling.spans(np.array([0]), np.array([len(words)]))
    return np.unique(rolling.grams(width))


def signature(members: np.ndarray, places: int) -> np.ndarray:
    """16 bits of the least hash of the set at each place."""
    factors = mix(np.arange(1, places + 1, dtype=np.uint64)) | U(1)
    least = np.full(places, U(2**64 - 1))
    for at in range(0, len(members), 1024):
        part = mix(members[at : at + 1024])
        np.minimum(least, (part[:, None] * factors).min(axis=0), out=least)
    return (mix(least) & U(0xFFFF)).astype(np.uint16)


def parities(members: np.ndarray) -> np.ndarray:
    """For each bucket whether it holds an odd number of the set's shingles, 64 to a number."""
    odd = np.bincount((mix(members) >> U(48)).astype(np.int64) % PARITIES, minlength=PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def set_rows(width: int, chunks: int, places: int, with_members: bool):
    """doc_id, n_shingles, digest, and signature, parities and the text's hash (or members) of each text."""
    names = ["doc_id", "n_shingles", "digest", *(["members"] if with_members else ["signature", "parities", "text_hash"])]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            hashes = batch["doc_id"] if with_members else batch["text_hash"]
            for doc_id, text, text_hash in zip(batch["doc_id"], batch["text"], hashes):
                members = shingles(text, width)
                digest = hashlib.blake2b(members.tobytes(), digest_size=16).digest()
                if with_members:
                    last = (members.tobytes(),)
                elif len(members):
                    last = (signature(members, chunks * places).view(np.int16), parities(members), text_hash)
                else:
                    last = (None, None, text_hash)
                out.append((doc_id, len(members), digest, *last))
            yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})

    return rows


def key_rows(chunks: int, places: int, errors: int):
    """The keys of each signature: for each chunk, the places left when any `errors` of them are left out."""
    left = [list(x) for x in itertools.combinations(range(places), places - errors)]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = mix(np.arange(1, chunks * len(left) + 1, dtype=np.uint64)).reshape(chunks, len(left))
        for batch in batches:
            if not len(batch):
                continue
            table = np.stack(batch["signature"].to_numpy()).view(np.uint16).astype(np.uint64).reshape(-1, chunks, places)
            keys = np.empty((len(batch), chunks, len(left)), dtype=np.uint64)
            for i, kept in enumerate(left):
                key = np.broadcast_to(names[:, i], (len(batch), chunks))
                for place in kept:
                    key = mix(key * U(0x9E3779B97F4A7C15) + table[:, :, place])
                keys[:, :, i] = key
            each = chunks * len(left)
            yield pd.DataFrame({"key": keys.reshape(-1).view(np.int64), "id": np.repeat(batch["id"].to_numpy(np.int64), each)})

    return rows


def linked_rows(percent: int):
    """Of each block (one set, some partners) the pairs whose sets are similar enough."""

    def rows(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(x, dtype=np.uint64) for x in block["members"]]
        one = next(m for m, head in zip(sets, block["head"]) if head)
        found = []
        for other, members, head in zip(block["id"], sets, block["head"]):
            if not head:
                common = len(one) + len(members) - len(np.union1d(one, members))
                if 100 * common >= percent * (len(one) + len(members) - common):
                    found.append(other)
        return pd.DataFrame({"a": np.full(len(found), key[0], dtype=np.int64), "b": np.array(found, dtype=np.int64)})

    return rows


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the distinct pairs (a, b) those whose full sets (id, members) reach the similarity.

    A set goes to a task once for each block of partners, so a document with many partners is spread over many tasks.
    """
    blocks = pairs.withColumn("block", F.floor((F.row_number().over(Window.partitionBy("a").orderBy("b")) - 1) / BLOCK))
    wanted = blocks.select("a", "block", F.col("b").alias("id"), F.lit(False).alias("head")).unionByName(
        blocks.select("a", "block", F.col("a").alias("id"), F.lit(True).alias("head")).distinct()
    )
    return wanted.join(sets, "id").groupBy("a", "block").applyInPandas(linked_rows(percent), "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """id and component (the least id reachable) of every id in links (a, b).

    Large-star and small-star steps in turn: every neighbour of a vertex is hung on the least vertex around it, first the
    greater ones, then the others, until nothing changes. Each round is written to the shared folder.
    """
    edges = cut_lineage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u")
        small = hung.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = cut_lineage(small.filter("u <> v").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )


def places_apart(one: Column, two: Column) -> Column:
    return F.size(F.filter(F.zip_with(one, two, lambda x, y: x != y), lambda x: x))


def parities_apart(one: Column, two: Column) -> Column:
    """The buckets whose parity differs: at most the number of shingles that one of the sets lacks."""
    return F.aggregate(F.zip_with(one, two, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)


def near_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = 80,
    chunks: int = CHUNKS,
    places: int = PLACES,
    errors: int = ERRORS,
) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, set_id and kept_set of every row.

    set_id names the row's set; kept_set is the one that stands for its class: of the sets under the least id, the least.
    """
    rows = id_and_text(docs, id_col, text_col)
    hashed = rows.withColumn("text_hash", F.xxhash64("text"))
    columns = "doc_id long, n_shingles long, digest binary, signature array<short>, parities array<long>, text_hash long"
    sets = cut_lineage(hashed.mapInPandas(set_rows(width, chunks, places, False), columns))
    members = sets.filter("doc_id is not null and n_shingles > 0")
    equal = members.groupBy("digest").agg(F.min("doc_id").alias("first"))
    # a representative is named by the digest, so that two sets under one id stay apart
    named = equal.select("digest", "first", F.xxhash64("digest").alias("id"))
    signed = cut_lineage(
        members.join(named, "digest").filter("doc_id = first").dropDuplicates(["id"]).select("id", F.col("first"), "n_shingles", "signature", "parities")
    )
    keys = signed.select("id", "signature").mapInPandas(key_rows(chunks, places, errors), "key long, id long")
    # the smallest member of a key leads it: the one with the least document id
    led = Window.partitionBy("key")
    met = keys.withColumn("low", F.min("id").over(led)).withColumn("high", F.max("id").over(led)).filter("low <> high").select("key", "id")
    met = cut_lineage(met.join(signed.select("id", "first"), "id"))
    leads = met.groupBy("key").agg(F.min(F.struct("first", "id")).alias("lead"))
    stars = met.join(leads, "key").select(F.col("lead.id").alias("a"), F.col("id").alias("b")).filter("a <> b").distinct()
    wanted = met.select("id").distinct().join(signed.select("id", "first"), "id")
    texts = rows.join(wanted.select(F.col("first").alias("doc_id")).distinct(), "doc_id")
    full = texts.mapInPandas(set_rows(width, chunks, places, True), "doc_id long, n_shingles long, digest binary, members binary")
    full = cut_lineage(full.withColumn("id", F.xxhash64("digest")).dropDuplicates(["id"]).join(wanted.select("id"), "id").select("id", "members"))
    links = cut_lineage(confirmed(stars, full, percent))
    parts = components(links)
    ids = met.join(parts, "id", "left").withColumn("component", F.coalesce("component", "id"))
    across = Window.partitionBy("key")
    mixed = (
        ids.withColumn("low", F.min("component").over(across))
        .withColumn("high", F.max("component").over(across))
        .filter("low <> high")
        .join(signed.select("id", "n_shingles", "signature", "parities"), "id")
    )
    mixed = cut_lineage(mixed.select("key", "id", "component", "n_shingles", "signature", "parities"))
    fields = ("id", "component", "n_shingles", "signature", "parities", "keys")
    mixed = mixed.join(mixed.groupBy("id").agg(F.collect_list("key").alias("keys")), "id")
    left, right = (mixed.select("key", *(F.col(c).alias(f"{c}_{side}") for c in fields)) for side in "ab")
    near = (
        (F.col("component_a") != F.col("component_b"))
        & (F.col("id_a") < F.col("id_b"))
        & (100 * F.least("n_shingles_a", "n_shingles_b") >= percent * F.greatest("n_shingles_a", "n_shingles_b"))
        & (places_apart(F.col("signature_a"), F.col("signature_b")) <= threshold(chunks, errors))
        # sets of that similarity differ in at most this share of their shingles together
        & ((100 + percent) * parities_apart(F.col("parities_a"), F.col("parities_b")) <= (100 - percent) * (F.col("n_shingles_a") + F.col("n_shingles_b")))
        # a pair that meets under several keys is judged at the least of them
        & (F.array_min(F.array_intersect("keys_a", "keys_b")) == left["key"])
    )
    pairs = left.join(right, (left["key"] == right["key"]) & near).select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()
    links = links.unionByName(cut_lineage(confirmed(pairs, full, percent)))
    parts = components(links)
    smallest = parts.join(signed.select("id", "first"), "id").groupBy("component").agg(F.min(F.struct("first", "id")).alias("least"))
    of_set = parts.join(smallest, "component").select("id", "least")
    classes = named.join(of_set, "id", "left").select("digest", F.coalesce("least.first", "first").alias("component_id"), F.coalesce("least.id", "id").alias("kept_set"))
    out = sets.select("doc_id", "n_shingles", "digest", "text_hash").join(classes, "digest", "left").withColumn("set_id", F.xxhash64("digest"))
    alone = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    return out.select("doc_id", "text_hash", "n_shingles", component, "set_id", F.when(alone, F.col("set_id")).otherwise(F.col("kept_set")).alias("kept_set"))


def near_duplicates(docs: DataFrame, *args, **kwargs) -> DataFrame:
    """doc_id, n_shingles and component_id of every row; parameters as of near_classes."""
    return near_classes(docs, *args, **kwargs).select("doc_id", "n_shingles", "component_id")


def op3_near_dup(spark: SparkSession, folder: str) -> DataFrame:
    out = near_duplicates(read(spark, folder, "documents"), width=4)
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
