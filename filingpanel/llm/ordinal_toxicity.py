"""Toxicity by cumulative-link ordinal regression over sparse text features.

A text's features are its distinct words and their beginnings of four, five and six letters. One weight
vector serves all severity grades; ordered thresholds tell them apart: P(grade >= k) is the logistic
function of (weights . features - threshold k). The expected severity is the sum of these over k.

The model is fitted on a bounded sample of labelled rows (``per_class``, a parameter). Everything else,
features and predictions, covers every row. Labels say toxic or not; grades among toxic rows follow from
how many of their words are marked by the sample itself, in thirds, so a text full of them is graver.
"""

from __future__ import annotations

import dataclasses
import math
import re
import uuid
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filingpanel.llm.common import Memo, kept, prepare, text_or_empty, tidy

PREFIXES = (4, 5, 6)
GRADES = 3

#: Labelled rows of either class that the model is fitted on.
PER_CLASS = 6000

#: Features that the model may weigh: so many, each in so many toxic rows, and with log odds that lie above
#: this even two standard errors lower. Up to SURE_ROWS toxic rows fewer errors are asked for, with their logarithm,
#: and up to FEW_ROWS one row less: few labels would otherwise mark next to nothing.
MAX_FEATURES, LEAST_ROWS, LEAST_ODDS = 2048, 3, 1.5
SURE_ROWS, FEW_ROWS = 1000, 100


def evidence(toxic: int) -> tuple[int, float]:
    """In how many toxic rows a feature must be, and by how many standard errors its odds must hold, given so many toxic rows."""
    return LEAST_ROWS - (toxic <= FEW_ROWS), 2 * min(1.0, math.log(max(toxic, 1)) / math.log(SURE_ROWS))

#: Steps, step size and the two penalties of the fit (small weights become exactly 0).
STEPS, RATE, RIDGE, LASSO = 600, 0.1, 1e-5, 3e-5

KEPT_WORDS = 400_000

_WORD = re.compile(r"[^\W\d_]+")


def features_of(word: str) -> tuple[str, ...]:
    return (word, *(f"{word[:n]}*" for n in PREFIXES if len(word) >= n))


def text_features(text: str) -> set[str]:
    found: set[str] = set()
    for word in set(_WORD.findall(text.lower())):
        found.update(features_of(word))
    return found


@dataclasses.dataclass
class Model:
    """Weights by feature, rising thresholds, and the sum of weights from which a text counts as toxic.

    Without thresholds everything has severity 0 and nothing is toxic.
    """

    weights: dict[str, float]
    thresholds: list[float]
    cut: float = float("inf")
    name: str = dataclasses.field(default_factory=lambda: uuid.uuid4().hex)

    def grades(self, sums: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k from 1, a column each."""
        if not self.thresholds:
            return np.zeros((len(sums), GRADES))
        return 1 / (1 + np.exp(-np.clip(sums[:, None] - np.array(self.thresholds)[None, :], -500, 500)))


def fit(rows: list[list[int]], grades: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds that make the graded rows most likely; rows are lists of feature numbers."""
    levels = int(grades.max())
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    index = np.fromiter((f for r in rows for f in r), np.int64, len(owner))
    weight = np.where(grades > 0, 0.5 / max(1, (grades > 0).sum()), 0.5 / max(1, (grades == 0).sum()))
    w, cuts = np.zeros(size), np.linspace(0.5, 1.5, levels)
    mean, square = np.zeros(size + levels), np.zeros(size + levels)
    for step in range(1, STEPS + 1):
        eta = np.bincount(owner, w[index], len(rows))
        at_least = 1 / (1 + np.exp(-np.clip(eta[:, None] - cuts[None, :], -30, 30)))
        edges = np.concatenate([np.ones((len(rows), 1)), at_least, np.zeros((len(rows), 1))], axis=1)
        upper = edges[np.arange(len(rows)), grades]
        lower = edges[np.arange(len(rows)), grades + 1]
        share = np.maximum(upper - lower, 1e-12)
        slope = weight * (1 - upper - lower)
        g = np.zeros(size + levels)
        g[:size] = RIDGE * w - np.bincount(index, slope[owner], size)
        for k in range(levels):  # the threshold below grade k + 1, and above grade k
            curve = at_least[:, k] * (1 - at_least[:, k]) / share * weight
            g[size + k] = curve[grades == k + 1].sum() - curve[grades == k].sum()
        mean = 0.9 * mean + 0.1 * g
        square = 0.99 * square + 0.01 * g * g
        move = RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        w = w - move[:size]
        w = np.sign(w) * np.maximum(np.abs(w) - LASSO * RATE, 0)
        cuts = np.maximum.accumulate(cuts - move[size:] + 0.0)
        cuts += 1e-3 * np.arange(levels) * (np.diff(cuts, prepend=cuts[0] - 1) <= 0)
    return w, cuts


def best_cut(sums: np.ndarray, toxic: np.ndarray) -> float:
    """The sum that parts toxic from other rows with the least error, both kinds weighing the same; the middle of the widest.

    Only sums above 0, that of a text without features, part rows; where there are none the cut is infinite.
    """
    values = np.unique(sums[sums > 0])
    if not len(values):
        return float("inf")
    missed = np.array([(sums[toxic] < v).mean() for v in values]) + np.array([(sums[~toxic] >= v).mean() for v in values])
    gaps = np.diff(values, prepend=0.0)
    best = np.flatnonzero(missed <= missed.min() + 1e-12)
    place = best[gaps[best].argmax()]
    return float(values[place] - gaps[place] / 2)


def learn(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """A model from the texts of ``docs`` whose ``doc_id`` is in ``labels`` (``doc_id, toxic`` 0 or 1).

    At most ``per_class`` rows of either class are used, chosen by a hash of the id. Null ids, texts and
    labels are left out; an id with several labels is toxic if one of them says so, and so is a text that
    several ids share, which counts once. If a class has no rows, or no feature marks toxic rows, nothing is learnt.
    """
    spark = docs.sparkSession
    prepare(spark)
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    order = F.xxhash64("doc_id"), F.col("doc_id")
    drawn = [known.where(F.col("toxic") == c).orderBy(*order).limit(per_class) for c in (0, 1)]
    sample = F.broadcast(drawn[0].union(drawn[1]))  # bounded by per_class
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    matched = texts.where(F.col("text").isNotNull()).join(sample, "doc_id")
    rows = matched.groupBy("text").agg(F.max("toxic").alias("toxic"))  # copies would make any word a mark

    def counted(batches):
        seen = {0: Counter(), 1: Counter()}
        for part in batches:
            for text, toxic in zip(part["text"], part["toxic"]):
                seen[toxic].update(text_features(text))
        for toxic, counts in seen.items():
            if not counts:
                continue
            yield pd.DataFrame({"feature": list(counts), "toxic": toxic, "n": np.array(list(counts.values()), np.int64)})

    counts = rows.mapInPandas(tidy(counted), "feature string, toxic int, n long").groupBy("feature")
    both = counts.agg(F.sum(F.col("n") * F.col("toxic")).alias("yes"), F.sum(F.col("n") * (1 - F.col("toxic"))).alias("no"))
    total = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(total) < 2:
        return Model({}, [])
    odds = F.log((F.col("yes") + 0.5) / (total[1] - F.col("yes") + 0.5)) - F.log((F.col("no") + 0.5) / (total[0] - F.col("no") + 0.5))
    spread = F.sqrt(1 / (F.col("yes") + 0.5) + 1 / (F.col("no") + 0.5))
    least, errors = evidence(total[1])
    sure = both.where(F.col("yes") >= least).select("feature", odds.alias("odds"), (odds - errors * spread).alias("bound"))
    best = sure.where(F.col("bound") > LEAST_ODDS).orderBy(F.desc("bound"), "feature").limit(MAX_FEATURES).collect()
    names = sorted(r["feature"] for r in best)
    strong = {r["feature"] for r in best if r["odds"] > 3 and not r["feature"].endswith("*")}
    number = {f: i for i, f in enumerate(names)}
    if not names:
        return Model({}, [])

    def chosen(batches):
        for part in batches:
            found = [text_features(t) for t in part["text"]]
            yield pd.DataFrame(
                {
                    "toxic": part["toxic"],
                    "hits": [len(f & strong) for f in found],
                    "features": [sorted(number[x] for x in f if x in number) for f in found],
                }
            )

    table = rows.mapInPandas(tidy(chosen), "toxic int, hits int, features array<int>").toPandas()
    table["key"] = [tuple(f) for f in table["features"]]
    table = table.sort_values(["toxic", "hits", "key"], kind="stable").reset_index(drop=True)  # the fit sees one order
    toxic = table["toxic"].to_numpy() == 1
    hits = table["hits"].to_numpy()
    cuts = np.quantile(hits[toxic], [i / GRADES for i in range(1, GRADES)])
    grades = np.where(toxic, 1 + (hits[:, None] > cuts[None, :]).sum(axis=1), 0)
    present = np.unique(grades)  # a grade without rows has no threshold to learn
    features = [list(f) for f in table["key"]]
    weights, thresholds = fit(features, np.searchsorted(present, grades), len(names))
    cut = best_cut(np.array([weights[f].sum() if f else 0.0 for f in features]), toxic)
    return Model({f: float(weights[i]) for f, i in number.items() if weights[i] != 0}, [float(t) for t in thresholds], cut)


class Scorer:
    """Sums the weights of a text's distinct features; most words have none."""

    def __init__(self, model: Model, kept_words: int = KEPT_WORDS):
        self.model = model
        self.words = Memo(self._weighed, kept_words)

    def _weighed(self, word: str) -> tuple[str, ...]:
        return tuple(f for f in features_of(word) if f in self.model.weights)

    def sums(self, texts: list[str]) -> np.ndarray:
        out, weights, words = np.zeros(len(texts)), self.model.weights, self.words
        for i, text in enumerate(texts):
            found: set[str] = set()
            for features in map(words.__getitem__, set(_WORD.findall(text.lower()))):
                if features:
                    found.update(features)
            out[i] = sum(sorted(weights[f] for f in found))
        return out


def severity_of(spark: SparkSession, model: Model, text: Column) -> Column:
    """A struct ``severity, p_toxic, grade, toxic`` for a text column; null and empty texts have severity by their lack of features."""
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("severity double, p_toxic double, grade int, toxic boolean")
    def scored(batches: pd.Series) -> pd.DataFrame:
        sums = _scorer(shared.value).sums(text_or_empty(batches))
        at_least = shared.value.grades(sums)
        return pd.DataFrame(
            {
                "severity": at_least.sum(axis=1),
                "p_toxic": at_least[:, 0],
                "grade": (at_least >= 0.5).sum(axis=1).astype(np.int32),
                "toxic": sums >= shared.value.cut,
            }
        )

    return scored(text.cast("string"))


def _scorer(model: Model) -> Scorer:
    return kept(("scorer", model.name), lambda: Scorer(model))


def grade_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, severity, p_toxic, grade, toxic`` for every row; ``toxic`` from the model's cut on.

    Null texts are empty, repeated rows and ids give a row each, null ids stay null, and other columns
    are not looked at. No shuffle.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), severity_of(docs.sparkSession, model, F.col("text")).alias("s"))
    return rows.select("doc_id", "s.*")


def reject_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that are not toxic."""
    return docs.where(~severity_of(docs.sparkSession, model, F.col("text"))["toxic"])
