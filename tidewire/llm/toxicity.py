"""Toxicity by maximum-scoring segments of token log-odds.

Learning: counts of words and of word beginnings in labelled toxic and clean texts give log-odds under an informative Dirichlet
prior (the corpus rate of each feature). Features whose log-odds are positive and significant form the lexicon; every other
token has the small negative log-odds of "not in the lexicon", so that scores of clean text drift down and the exponential
parameter of the score distribution is 1 by construction.

Scoring: a linear scan finds all maximal-scoring segments of a text. A segment's score, less the logarithm of the text's
length and of a constant fitted on clean texts, is its extreme-value (Gumbel) location: the expected number of segments as good
by chance is the exponential of its negative. The best of these and the sum of the significant ones are put on the 0 to 1
scale by a logistic curve fitted on the labelled texts.

Labels: rows with a null in any column count for nothing; an id with several labels is toxic if one says so. At most
`max_labelled` labelled ids are learned from (those with the least hash; a documented bound on the training sample, so that
labels, scores to be fitted and the significant features may be held in one place); scoring covers every document. Null and empty texts
score like a text without a toxic word. Every row of a repeated id counts; texts are read whole, whatever their length;
any other columns of the documents and labels are not looked at. With no toxic or no clean example all scores are the label's base rate (0 with no label at all).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm.base import read
from tidewire.session import cut_lineage

#: Bound of the training sample, and with it of the lexicon.
MAX_LABELLED = 100_000
#: Toxic texts a feature must occur in, its z-score, and the weight of the corpus rate in the prior (in tokens).
LEAST_TEXTS, LEAST_Z, PRIOR = 3, 3.0, 100.0
BEGINNINGS = (5, 4)
#: From this score on clean segments fit the constant of the length correction.
FITTED_FROM = 2.0
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def features_of(word: str) -> list[str]:
    """A word and its beginnings (marked with a trailing star) that are shorter than it."""
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n)]


def feature_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each batch and feature its counts in toxic and in clean texts and the toxic texts that have it; '' counts all words."""
    for batch in batches:
        toxic: Counter[str] = Counter()
        texts: Counter[str] = Counter()
        clean: Counter[str] = Counter()
        clean_words: Counter[str] = Counter()
        for text, marked in zip(batch["text"], batch["toxic"]):
            words = words_of(text)
            if marked:
                own = Counter(f for w in words for f in features_of(w))
                own[""] = len(words)
                toxic.update(own)
                texts.update(own.keys())
            else:
                clean_words.update(words)
        clean[""] = clean_words.total()
        for word, n in clean_words.items():
            for feature in features_of(word):
                clean[feature] += n
        every = list(toxic.keys() | clean.keys())
        yield pd.DataFrame({"feature": every, "toxic": [toxic[f] for f in every], "texts": [texts[f] for f in every], "clean": [clean[f] for f in every]})


class Model:
    """The lexicon, the score of any other token and the calibration."""

    def __init__(self, lexicon: dict[str, float], other: float):
        self.lexicon, self.other, self.scale = lexicon, other, 1.0
        self.weights: np.ndarray | None = None
        self.base = 0.0

    def score_of(self, word: str) -> float | None:
        found = self.lexicon.get(word)
        if found is None:
            for n in BEGINNINGS:
                if len(word) > n and (found := self.lexicon.get(word[:n] + "*")) is not None:
                    break
        return found

    def segments(self, words: list[str]) -> list[tuple[float, int, int]]:
        """(score, start, end) of all maximal-scoring segments, in order."""
        stack: list[tuple[float, float, int, int]] = []  # sums before and after, start, end
        total, last = 0.0, 0
        for at, word in enumerate(words):
            score = self.score_of(word)
            if score is None:
                continue
            before = total + self.other * (at - last)
            total, last = before + score, at + 1
            low, start = before, at
            while True:
                j = len(stack) - 1
                while j >= 0 and stack[j][0] >= low:
                    j -= 1
                if j < 0 or stack[j][1] >= total:
                    stack.append((low, total, start, at + 1))
                    break
                low, start = stack[j][0], stack[j][2]
                del stack[j:]
        return [(high - low, start, end) for low, high, start, end in stack]

    def locations(self, text: str | None) -> tuple[float, float, list[tuple[float, int, int]]]:
        """The best and the sum of the significant extreme-value locations, and the significant segments."""
        words = words_of(text)
        chance = math.log(max(1e-12, self.scale) * max(1, len(words)))
        found = [(s - chance, a, b) for s, a, b in self.segments(words)]
        significant = [x for x in found if x[0] > 0]
        return max([x[0] for x in found], default=-chance), sum(x[0] for x in significant), significant

    def probability(self, best: np.ndarray, total: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(best), self.base)
        return 1 / (1 + np.exp(-np.clip(design(best, total) @ self.weights, -700, 700)))


def design(best: np.ndarray, total: np.ndarray) -> np.ndarray:
    return np.column_stack((np.ones(len(best)), np.tanh(np.asarray(best) / 20), np.log1p(np.asarray(total))))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Weights of a logistic curve, by Newton's method with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def chance_rows(model: Model):
    """Tokens and good segments of clean texts."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            tokens = good = 0
            for text in batch["text"]:
                words = words_of(text)
                tokens += len(words)
                good += sum(s >= FITTED_FROM for s, _, _ in model.segments(words))
            yield pd.DataFrame({"tokens": [tokens], "good": [good]})

    return rows


def location_rows(model: Model):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [model.locations(t)[:2] for t in batch["text"]]
            yield pd.DataFrame({"toxic": batch["toxic"], "best": [x[0] for x in found], "total": [x[1] for x in found]})

    return rows


def significant_features(counts: DataFrame, n_toxic: int, n_clean: int) -> DataFrame:
    """feature, toxic, clean and odds of the features whose log-odds are positive and significant under the Dirichlet prior."""
    y, x = F.col("toxic"), F.col("clean")
    prior = PRIOR * (y + x) / (n_toxic + n_clean) + 0.5
    odds = F.log((y + prior) / (n_toxic + PRIOR - y)) - F.log((x + prior) / (n_clean + PRIOR - x))
    z = F.col("odds") / F.sqrt(1 / (y + prior) + 1 / (x + prior))
    return counts.withColumn("odds", odds).filter((z >= LEAST_Z) & (F.col("odds") > 1)).select("feature", "toxic", "clean", "odds")


def learn_toxicity(labelled: DataFrame) -> Model:
    """A model from rows with text and toxic (0 or 1); its lexicon holds every significant feature of them."""
    rows = cut_lineage(labelled.select("text", F.col("toxic").cast("int").alias("toxic")))
    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if not n.get(1) or not n.get(0):
        model = Model({}, 0.0)
        model.base = n.get(1, 0) / max(1, sum(n.values()))
        return model
    counts = rows.mapInPandas(feature_rows, "feature string, toxic long, texts long, clean long")
    counts = counts.groupBy("feature").agg(*[F.sum(c).alias(c) for c in ("toxic", "texts", "clean")])
    counts = cut_lineage(counts.filter((F.col("texts") >= LEAST_TEXTS) | (F.col("feature") == "")))
    tokens = counts.filter("feature = ''").first()
    n_toxic, n_clean = max(1, tokens["toxic"]), max(1, tokens["clean"])
    table = significant_features(counts.filter("feature <> ''"), n_toxic, n_clean).toPandas()
    whole = ~table["feature"].str.endswith("*").astype(bool)
    share = [min(0.5, (table.loc[whole, c].sum() + 0.5) / n) for c, n in (("toxic", n_toxic), ("clean", n_clean))]
    model = Model(dict(zip(table["feature"], table["odds"])), min(-0.005, math.log((1 - share[0]) / (1 - share[1]))))
    chance = rows.filter("toxic = 0").mapInPandas(chance_rows(model), "tokens long, good long").agg(F.sum("tokens").alias("t"), F.sum("good").alias("g")).first()
    model.scale = (chance["g"] + 0.5) * math.exp(FITTED_FROM) / max(1, chance["t"])
    fitted = rows.mapInPandas(location_rows(model), "toxic int, best double, total double").toPandas()
    model.weights = logistic(design(fitted["best"], fitted["total"]), fitted["toxic"].to_numpy(float))
    return model


def scored_rows(model: Model):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [model.locations(t) for t in batch["text"]]
            score = model.probability(np.array([x[0] for x in found]), np.array([x[1] for x in found]))
            spans = [[{"start_word": a, "end_word": b, "location": s} for s, a, b in x[2]] for x in found]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "score": score, "predicted": (score >= 0.5).astype("int32"), "segments": spans})

    return rows


def sample_of_labels(labels: DataFrame, used: Column, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """doc_id and toxic of at most max_labelled labelled ids."""
    known = labels.filter(used).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropna()
    return known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted and the significant segments of every document."""
    return docs.select("doc_id", "text").mapInPandas(
        scored_rows(model), "doc_id long, score double, predicted int, segments array<struct<start_word:int,end_word:int,location:double>>"
    )


def model_for(docs: DataFrame, labels: DataFrame) -> Model:
    """Learned from the labels whose crc32(doc_id) is not divisible by 5."""
    sample = sample_of_labels(labels, F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    return learn_toxicity(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id"))


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    scored = score_toxicity(docs, model_for(docs, read(spark, folder, "labels")))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted", F.size("segments").alias("n_segments"))
