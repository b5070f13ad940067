"""Document quality by a regularised quadratic discriminant over transformed text statistics.

Every text becomes a vector of transformed statistics. Per class, Spark sums counts, values and products
over all labelled training rows; the class covariances are shrunk towards the pooled one and then towards
a multiple of the identity, and factored once. A score is the posterior of the good class, from the
difference of the two log densities, whose Mahalanobis terms use the cached Cholesky factors.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.llm.texts import with_texts
from tillmark.session import checkpointed

TO_POOLED = 0.1
TO_IDENTITY = 0.05
THRESHOLD = 0.7
#: Log-density differences are divided by this, because the statistics are not independent normals.
TEMPERATURE = 2.0

STATISTICS = (
    "log_words", "word_length", "word_length_spread", "upper", "symbols", "marks", "separators", "distinct",
    "top_word", "repeated_pairs", "sentence_ends", "plain_words", "digits", "short_words", "line_words", "repeated_lines",
)
_SYMBOLS = re.compile(r"[#*$%&|<>{}\[\]\\^~=@_]")
_MARKS = re.compile(r"[!?]")
_PLAIN = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*[.,;:!?]?\Z")
_DIGITS = re.compile(r"\d")


def _logit(share: float, n: int) -> float:
    """Log odds of a share of n, a half count away from 0 and 1."""
    return math.log((share * n + 0.5) / ((1 - share) * n + 0.5))


def statistics(text: str | None) -> list[float]:
    """Transformed statistics of one whole text; a null text counts as empty."""
    text = text or ""
    words = text.split()
    n, chars = len(words), len(text)
    counts = Counter(words)
    lengths = Counter(map(len, words))
    mean = sum(k * c for k, c in lengths.items()) / n if n else 0.0
    spread = math.sqrt(sum(c * (k - mean) ** 2 for k, c in lengths.items()) / n) if n else 0.0
    share = lambda k, of: k / of if of else 0.0
    pairs = len(set(zip(words, words[1:])))
    upper = plain = ends = short = bare = 0
    for word, c in counts.items():
        plain += c * bool(_PLAIN.match(word))
        upper += c * (len(word) > 1 and word.isupper())
        ends += c * (word[-1] in ".?!")
        short += c * (len(word) <= 3)
        bare += c * (not any(map(str.isalnum, word)))
    lines = [line for line in text.split("\n") if line.strip()]
    symbols, marks, digits = (len(p.findall(text)) for p in (_SYMBOLS, _MARKS, _DIGITS))
    rows = len(lines)
    return [
        math.log1p(n),
        math.log1p(mean),
        math.log1p(spread),
        _logit(share(upper, n), min(n, 200)),
        _logit(share(symbols, chars), min(chars, 1000)),
        _logit(share(marks, chars), min(chars, 1000)),
        _logit(share(bare, n), min(n, 200)),
        math.log1p(len(counts)) - 0.8 * math.log1p(n),
        _logit(share(max(counts.values(), default=0), n), min(n, 200)),
        _logit(1 - share(pairs, n - 1) if n > 1 else 0.0, min(n, 200)),
        _logit(share(ends, n), min(n, 200)),
        _logit(share(plain, n), min(n, 200)),
        _logit(share(digits, chars), min(chars, 1000)),
        _logit(share(short, n), min(n, 200)),
        math.log1p(share(n, rows)),
        _logit(1 - share(len(set(lines)), rows) if rows else 0.0, min(rows, 50)),
    ]


def document_statistics(docs: DataFrame) -> DataFrame:
    """``(doc_id, x)`` of every row: the vector of ``STATISTICS``."""
    return with_texts(docs, ["doc_id"], "text", {"x": "array<double>"}, lambda texts: [[statistics(t) for t in texts]])


def held_out() -> F.Column:
    """Whether a document's label must not be learnt from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


@dataclass
class Discriminant:
    """Class means, inverse Cholesky factors, log determinants and the log prior odds of the good class."""

    means: list[np.ndarray]
    whiteners: list[np.ndarray]
    log_dets: list[float]
    log_odds: float

    def score(self, x: np.ndarray) -> np.ndarray:
        distance = [np.square((x - m) @ w.T).sum(axis=1) for m, w in zip(self.means, self.whiteners)]
        gap = 0.5 * (distance[0] - distance[1] + self.log_dets[0] - self.log_dets[1])
        return 1 / (1 + np.exp(-np.clip(gap / TEMPERATURE + self.log_odds, -500, 500)))


def _moment_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums of 1, x and x x' by class over all rows of the task, as one matrix each."""
    size = len(STATISTICS) + 1
    sums = np.zeros((2, size, size))
    for batch in batches:
        x = np.column_stack([np.ones(len(batch)), np.array(batch["x"].tolist()).reshape(len(batch), -1)])
        for k in (0, 1):
            rows = x[batch["label"].to_numpy() == k]
            sums[k] += rows.T @ rows
    k, i, j = np.nonzero(np.ones_like(sums))
    yield pd.DataFrame({"k": k, "i": i, "j": j, "s": sums.ravel()})


def fit(labelled: DataFrame, to_pooled: float = TO_POOLED, to_identity: float = TO_IDENTITY) -> Discriminant:
    """Discriminant of all rows of ``labelled`` (``x``, ``label`` 0 or 1); one class or none gives a constant score.

    The driver receives a matrix of sums per class, whatever the number of rows.
    """
    size = len(STATISTICS) + 1
    sums = np.zeros((2, size, size))
    rows = labelled.where("label in (0, 1)").mapInPandas(_moment_rows, "k int, i int, j int, s double")
    for r in rows.groupBy("k", "i", "j").agg(F.sum("s").alias("s")).collect():
        sums[r.k, r.i, r.j] = r.s
    n = sums[:, 0, 0]
    d = size - 1
    pooled_n = max(1.0, n.sum() - 2)
    means = [sums[k, 0, 1:] / max(1.0, n[k]) for k in (0, 1)]
    scatter = [sums[k, 1:, 1:] - n[k] * np.outer(means[k], means[k]) for k in (0, 1)]
    pooled = (scatter[0] + scatter[1]) / pooled_n
    if min(n) == 0:
        means = [np.zeros(d), np.zeros(d)]
    whiteners, log_dets = [], []
    for k in (0, 1):
        own = scatter[k] / max(1.0, n[k] - 1) if min(n) else np.eye(d)
        mixed = (1 - to_pooled) * own + to_pooled * pooled if min(n) else own
        shrunk = (1 - to_identity) * mixed + to_identity * max(np.trace(mixed) / d, 1e-9) * np.eye(d)
        factor = np.linalg.cholesky(shrunk)
        whiteners.append(np.linalg.inv(factor))
        log_dets.append(2 * float(np.log(np.diag(factor)).sum()))
    return Discriminant(means, whiteners, log_dets, float(np.log((n[1] + 1) / (n[0] + 1))))


def score(found: DataFrame, model: Discriminant) -> DataFrame:
    """``(doc_id, score)`` of every row of ``found``."""

    size = len(STATISTICS)
    return with_texts(found, ["doc_id"], "x", {"score": "double"}, lambda rows: [model.score(np.array(rows, dtype=float).reshape(len(rows), size))])


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row of ``docs``, learnt from ``labels`` (doc_id, quality).

    Only rows whose ``held_out`` is false are learnt from. Null, empty and white texts have statistics and
    a score like any other. Labels that are null or not 0 or 1 are not used; a document's repeated labels
    or rows count as often as they appear. Without a label of both classes the score is the smoothed prior. A null ``doc_id``
    is not held out and has no label. Other columns are not read. No rows give no rows.
    """
    found = checkpointed(document_statistics(docs))
    marks = labels.select("doc_id", F.col("quality").alias("label")).where("label in (0, 1)")
    model = fit(found.where(~held_out()).join(marks, "doc_id"))
    return score(found, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that are predicted bad; rows that repeat a ``doc_id`` stay or go together.

    A document stays if any row of it scores ``threshold`` or more; rows without ``doc_id`` are one document.
    """
    good = quality_scores(docs.select("doc_id", "text"), labels, threshold).where("predicted = 1")
    kept = good.select(F.col("doc_id").alias("__kept")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["__kept"]), "left_semi")
