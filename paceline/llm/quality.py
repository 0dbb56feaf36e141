"""Quality classifier by Bradley-Terry pairwise ranking.

A document's worth is a linear score of its features. The chance that a document is preferred to
another is the logistic function of the difference of their scores, so the weights are found by
logistic loss on feature differences of preference pairs: each pair sets a document labelled 1
against one labelled 0. The cut between good and bad is the quantile of the scores that
corresponds to the share of the label 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.llm.common import in_pieces
from paceline.llm.langid import held_out

#: Labelled documents that the model is fitted on, at most: those first in hash order.
SAMPLE = 20_000
#: Preference pairs drawn from them.
PAIRS = 60_000
#: Score at the cut.
CUT = 0.3
RIDGE = 1.0
SEED = 7

_SIGNS = [b"!", b"?", b".", b",", b";:", b"|", b"#$%&*@^~=+_<>\\", b"()[]{}", b"\"'`", b"-/"]


def features(text: str | None) -> np.ndarray:
    """Features of a whole text: how it is written, not which words it uses."""
    data = (text or "").encode()
    hist = np.bincount(np.frombuffer(data, np.uint8), minlength=256).astype(float)
    n = max(len(data), 1)
    words = data.split()
    lower, upper, digits = hist[97:123].sum(), hist[65:91].sum(), hist[48:58].sum()
    high = hist[128:].sum()
    letters = max(lower + upper + high / 2, 1.0)
    share = hist[hist > 0] / n
    count = max(len(words), 1)
    lines = [x for x in data.split(b"\n") if x.strip()]
    signs = [hist[list(s)].sum() / count for s in _SIGNS]
    lengths = np.fromiter(map(len, words), float, len(words)) if words else np.zeros(1)
    return np.array([
        np.log1p(len(data)), np.log1p(len(words)), np.log1p(len(lines)), np.log1p(len(data) / max(len(lines), 1)),
        lengths.mean(), lengths.std(), np.log1p(lengths.max()), upper / letters, digits / n, high / n, (n - lower - upper - high) / n,
        -(share * np.log2(share)).sum() if len(data) else 0.0,
        len(set(words)) / count, len(set(zip(words, words[1:]))) / count, len(set(lines)) / max(len(lines), 1),
        sum(w[:1].isupper() for w in words) / count, sum(w[-1:] in b".!?" for w in words) / count,
        *signs, *np.log1p(100 * np.array(signs)), np.log1p(100 * upper / letters), np.log1p(100 * digits / n), float(not words)])


@dataclass
class Ranking:
    """Weights on standardised features, and the score at the cut."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; ``CUT`` at the cut."""
        z = ((x - self.mean) / self.scale).clip(-8, 8) @ self.weights - self.cut + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-z.clip(-700, 700)))


def fit(x: np.ndarray, label: np.ndarray, pairs: int = PAIRS, ridge: float = RIDGE, seed: int = SEED) -> Ranking | None:
    """Newton's method on the logistic loss of preference pairs. None without both labels."""
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(bad):
        return None
    mean, scale = x.mean(0), x.std(0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = ((x - mean) / scale).clip(-8, 8)
    rng = np.random.default_rng(seed)
    # Every document of either label takes part before one takes part again.
    turn = lambda own: np.concatenate([rng.permutation(own) for _ in range(-(-pairs // len(own)))])[:pairs]
    diff = z[turn(good)] - z[turn(bad)]
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp((diff @ w).clip(-30, 30)))  # chance given to the wrong order
        grad = ridge * w - diff.T @ p
        step = np.linalg.solve((diff * (p * (1 - p))[:, None]).T @ diff + ridge * np.eye(len(w)), grad)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return Ranking(mean, scale, w, float(np.quantile(z @ w, len(bad) / len(label))))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality",
          sample: int = SAMPLE) -> Ranking | None:
    """Fit on at most ``sample`` labelled documents that are not held out.

    Rows without a label or a document are not used; an id with several labels counts with each.
    """
    rows = (labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
            .select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_label"))
            .orderBy(F.xxhash64("_id"), "_id", "_label").limit(sample))

    @F.pandas_udf("array<double>")
    def measure(texts: pd.Series) -> pd.Series:
        return texts.map(features)

    # The sample is bounded, and so is what is broadcast and what comes back.
    pdf = (in_pieces(docs.select(id_col, text)).join(F.broadcast(rows), F.col(id_col) == F.col("_id"))
           .select("_id", "_label", measure(F.col(text)).alias("x")).toPandas()
           .sort_values(["_id", "_label"], kind="stable"))
    if pdf.empty:
        return None
    return fit(np.stack(pdf["x"].to_numpy()), pdf["_label"].to_numpy())


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality",
             sample: int = SAMPLE) -> DataFrame:
    """Append held_out, score and predicted (1 from a score of ``CUT``).

    NULL texts are scored as empty ones. Without labelled documents of both kinds every score is
    0.5. Columns of these names in the input are replaced; an empty table gives an empty result.
    """
    model = learn(docs, labels, id_col, text, label, sample)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        for texts in batches:
            if model is None or not len(texts):
                yield pd.Series(np.full(len(texts), 0.5))
            else:
                yield pd.Series(model.score(np.stack([features(t) for t in texts])))

    return (in_pieces(docs).withColumn("held_out", held_out(F.col(id_col))).withColumn("score", run(F.col(text)))
            .withColumn("predicted", (F.col("score") >= CUT).cast("int")))
