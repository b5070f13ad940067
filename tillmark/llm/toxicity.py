"""Toxicity by non-negative positive-unlabelled learning.

A numpy logistic model over the words and word beginnings of a text is trained from confirmed toxic texts
and from texts without a label. The unlabelled risk is corrected by the class prior, R_u(-) - pi * R_p(-), which no
true risk lets fall below zero; where the model makes it fall below -beta it fits noise, and a step then goes up that
term instead of down the whole risk pi * R_p(+) + R_u(-) - pi * R_p(-). Beta is ``BETA`` priors.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.llm.quality import held_out
from tillmark.llm.texts import with_texts
from tillmark.session import checkpointed

#: Expected numbers of texts that the model is fitted on; a bound on the driver's share, whatever the corpus.
POSITIVES = 5_000
UNLABELLED = 10_000
#: Least estimated share of toxic texts among those with a feature: prior times its lift.
MIN_PRECISION = 0.3
PREFIXES = (3, 4, 5, 6, 7, 8)
MIN_TEXTS = 3
#: Least excess of a feature in toxic texts, in standard deviations: few of a million others reach it by chance.
MIN_EXCESS = 5.0
THRESHOLD = 0.3
STEPS = 400
RATE = 0.1
RIDGE = 2e-4
#: How far, in priors, the corrected unlabelled risk may go below zero before a step turns back.
BETA = 0.5
#: Texts that agree in as many least hashes of their words count as copies: of words half shared, one pair in 64 does.
MINIMA = 6
SEED = 17
CACHED_WORDS = 500_000
_WORD = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[str]:
    """A word and its beginnings; a beginning ends with a star."""
    return [word] + [f"{word[:k]}*" for k in PREFIXES if k <= len(word)]


def words(text: str | None) -> set[str]:
    """Distinct words of one whole text in lower case; none for a null text."""
    return set(_WORD.findall((text or "").lower()))


class Weights:
    """A linear model over text features, with the features of common words looked up once."""

    def __init__(self, names: Iterable[str], weights: Iterable[float], bias: float):
        self.weight, self.bias = dict(zip(names, weights)), bias
        self.known: dict[str, tuple[str, ...]] = {}

    def present(self, text: str | None) -> set[str]:
        found: set[str] = set()
        for word in words(text):
            own = self.known.get(word)
            if own is None:
                if len(self.known) >= CACHED_WORDS:
                    self.known.clear()
                own = self.known[word] = tuple(f for f in word_features(word) if f in self.weight)
            found.update(own)
        return found

    def score(self, text: str | None) -> float:
        z = self.bias + sum(self.weight[f] for f in sorted(self.present(text)))
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def risk_slope(z: np.ndarray, is_p: np.ndarray, prior: float) -> tuple[float, float, np.ndarray]:
    """Positive risk, corrected unlabelled risk, and the slope by ``z`` that a step goes down, for logits ``z`` under the logistic loss."""
    n_p, n_u = is_p.sum(), (~is_p).sum()
    up = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
    loss_as_negative = np.logaddexp(0, z)
    kept = prior * np.logaddexp(0, -z[is_p]).mean()
    corrected = loss_as_negative[~is_p].mean() - prior * loss_as_negative[is_p].mean()
    to_positive = np.where(is_p, -prior * (1 - up) / n_p, 0)
    to_negative = np.where(is_p, -prior * up / n_p, up / n_u)
    return kept, corrected, to_positive + to_negative if corrected >= -BETA * prior else -to_negative


def train(positive: list[list[int]], unlabelled: list[list[int]], n_features: int, prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk over texts given as lists of feature numbers."""
    n_p, n_u = len(positive), len(unlabelled)
    if not n_p or not n_u:
        return np.zeros(n_features), float(np.log(prior / (1 - prior)))
    lists = positive + unlabelled
    rows = np.repeat(np.arange(n_p + n_u), [len(x) for x in lists])
    columns = np.array([f for x in lists for f in x], dtype=np.int64)
    is_p = np.arange(n_p + n_u) < n_p
    w, bias = np.zeros(n_features), float(np.log(prior / (1 - prior)))
    first, second = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for step in range(1, STEPS + 1):
        z = np.bincount(rows, weights=w[columns], minlength=n_p + n_u) + bias
        slope = risk_slope(z, is_p, prior)[2]
        gradient = np.append(np.bincount(columns, weights=slope[rows], minlength=n_features) + RIDGE * w, slope.sum())
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return w, float(bias)


def _share(column: F.Column, seed: int) -> F.Column:
    """Uniform number of [0, 1) of a value, the same in every run."""
    return F.pmod(F.xxhash64(column, F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))


def fit(docs: DataFrame, labels: DataFrame) -> Weights:
    """Model of ``docs`` and of the toxic marks in ``labels``, held-out documents' labels unseen.

    About ``POSITIVES`` toxic and ``UNLABELLED`` other texts, chosen by a hash of their id, are used; the
    labels' values of the latter are not. The prior is the share of toxic labels.
    """
    marks = labels.where("toxic in (0, 1)").where(~held_out()).select("doc_id", "toxic")
    counts = marks.agg(F.count("*").alias("n"), F.sum("toxic").alias("p")).first()
    n_p, n = counts["p"] or 0, counts["n"]
    prior = min(0.9, (n_p + 1) / (n + 2)) if n else 0.5
    n_docs = docs.select("doc_id").count()
    toxic = marks.where("toxic = 1").where(_share(F.col("doc_id"), SEED) < POSITIVES / max(1, n_p)).select("doc_id").distinct()
    drawn = _share(F.col("doc_id"), SEED + 1) < UNLABELLED / max(1, n_docs)
    # About POSITIVES ids are broadcast, so the texts are only filtered. A drawn toxic text stands in both samples.
    kept = docs.select("doc_id", "text").join(F.broadcast(toxic.withColumn("kind", F.lit(1))), "doc_id", "left")
    kept = kept.where(F.col("kind").isNotNull() | drawn).select(F.array_compact(F.array(F.col("kind"), F.when(drawn, F.lit(0)))).alias("kinds"), "text")
    rows = with_texts(kept, ["kinds"], "text", {"w": "array<string>"}, lambda texts: [[sorted(words(t)) for t in texts]])
    # of texts that agree in all their least hashes, near copies, one counts
    rows = rows.select(F.explode("kinds").alias("kind"), "w")
    minima = [F.array_min(F.transform("w", lambda w: F.xxhash64(w, F.lit(SEED + k)))).alias(f"m{k}") for k in range(MINIMA)]  # noqa: B023
    rows = rows.groupBy("kind", *minima).agg(F.min("w").alias("w")).select("kind", "w")
    rows = checkpointed(rows)
    sizes = {r["kind"]: r["n"] for r in rows.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(1) or not sizes.get(0):
        return Weights([], [], float(np.log(prior / (1 - prior))))

    def with_beginnings(word: F.Column) -> F.Column:
        return F.array_compact(F.array(word, *[F.when(F.length(word) >= k, F.concat(F.substring(word, 1, k), F.lit("*"))) for k in PREFIXES]))

    by_text = rows.select("kind", F.explode(F.array_distinct(F.flatten(F.transform("w", with_beginnings)))).alias("f"))
    by_feature = by_text.groupBy("f").agg(F.sum("kind").alias("p"), F.sum(1 - F.col("kind")).alias("u"))
    n_all = sizes[0] + sizes[1]
    share = (F.col("p") + F.col("u")) / n_all
    spread = F.sqrt(share * (1 - share) * n_all / (sizes[0] * sizes[1]))
    excess = by_feature.where((F.col("p") >= MIN_TEXTS) & (share < 1)).select(
        "f", ((F.col("p") / sizes[1] - F.col("u") / sizes[0]) / spread).alias("excess"),
        (prior * (F.col("p") / sizes[1]) / ((F.col("u") + 1) / sizes[0])).alias("precision"),
    )
    excess = excess.where((F.col("excess") >= MIN_EXCESS) & (F.col("precision") >= MIN_PRECISION))
    names = [r["f"] for r in excess.orderBy(F.desc("excess"), "f").collect()]  # of a bounded sample
    number = {f: i for i, f in enumerate(names)}

    def numbered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lists = [sorted({number[f] for word in own for f in word_features(word) if f in number}) for own in batch["w"]]
            yield pd.DataFrame({"kind": batch["kind"], "f": lists})

    lists: dict[int, list[list[int]]] = {0: [], 1: []}
    for r in rows.mapInPandas(numbered, "kind int, f array<int>").collect():
        lists[r["kind"]].append(r["f"])
    lists = {kind: sorted(own) for kind, own in lists.items()}  # sums in one order, so that reruns agree
    w, bias = train(lists[1], lists[0], len(names), prior)
    return Weights(names, w.tolist(), bias)


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row of ``docs``, learnt from ``labels`` (doc_id, toxic).

    Null, empty and white texts have no feature; their score is that of the bias. Labels that are null or
    not 0 or 1 are not used, repeated labels count for the prior as often as they appear. Without toxic
    labels or documents to learn from the score is the prior. A null ``doc_id`` is not held out. Rows that
    repeat a ``doc_id`` are rows of the result. Other columns are not read. No rows give no rows.
    """
    model = fit(docs, labels)

    found = with_texts(docs, ["doc_id"], "text", {"score": "double"}, lambda texts: [[model.score(t) for t in texts]])
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
