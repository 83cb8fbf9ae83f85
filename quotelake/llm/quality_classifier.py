"""Quality scores from a regularised quadratic discriminant.

A text becomes a fixed vector of transformed statistics. Both classes get a mean
and a covariance, shrunk towards the pooled covariance and its diagonal; a score
is the logistic of the difference of the Gaussian log densities plus the log
ratio of class sizes, computed with Cholesky factors that are factored once on
the driver. Only sums of vectors and of their products leave the tasks.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import staged
from quotelake.llm.shingles import Shingler

FEATURES = (
    "words",
    "word_length",
    "repeated_words",
    "repeated_triples",
    "repeated_neighbours",
    "top_word",
    "upper",
    "digits",
    "marks",
    "exclamations",
    "pipes",
    "stops",
    "repeated_lines",
    "long_words",
)
_MARKS = np.frombuffer(b"#*$%&<>@^~=+_{}[]\\/`", dtype=np.uint8)


def features(text: str | None, shingler: Shingler) -> np.ndarray:
    """The vector of one whole text; a null text is an empty one."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    seen = np.bincount(raw, minlength=256)
    found = (text or "").split()
    n, size = len(found), max(1, int(seen.sum() - seen[[32, 9, 10, 11, 12, 13]].sum()))
    hashes = shingler.words(text) if n else np.zeros(0, np.uint64)
    triples = max(1, len(hashes) - 2)
    lines = [line for line in (text or "").split("\n") if line.strip()]
    upper, lower = int(seen[65:91].sum()), int(seen[97:123].sum())
    top = Counter(found).most_common(1)[0][1] if n else 0

    def share(part, whole, prior=20):
        # A short text shows little: its shares shrink towards none.
        return np.log(part / (whole + prior) + 0.005)

    return np.array(
        [
            np.log1p(n),
            np.log1p(size / max(1, n)),
            share(n - len(set(found)), n),
            share(triples - len(shingler.of(text)) if n else 0, triples),
            share(int((hashes[1:] == hashes[:-1]).sum()), n),
            share(max(0, top - 1), n),
            share(upper, upper + lower),
            share(int(seen[48:58].sum()), size),
            share(int(seen[_MARKS].sum()), size),
            share(int(seen[33]), size),
            share(int(seen[124]), size),
            share(int(seen[[44, 46]].sum()), n),
            share(len(lines) - len(set(lines)), len(lines)),
            share(sum(len(w) > 20 for w in found), n),
        ]
    )


def featurise(docs: DataFrame) -> DataFrame:
    """(doc_id, x) of whole texts."""

    def batches(source):
        shingler = Shingler(3)
        for batch in source:
            rows = [features(t.as_py(), shingler) for t in batch.column(1)]
            flat = np.concatenate(rows) if rows else np.zeros(0)
            ends = np.arange(len(rows) + 1, dtype=np.int32) * len(FEATURES)
            x = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), x], names=["doc_id", "x"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        batches, "doc_id long, x array<double>"
    )


def _moments(labelled: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Count, sum and sum of products per label; d * d numbers a task and label."""
    d = len(FEATURES)

    def batches(source):
        total = {}
        for batch in source:
            label = np.asarray(batch.column(0))
            x = np.asarray(batch.column(1).flatten()).reshape(-1, d)
            for y in np.unique(label):
                one = np.column_stack((np.ones((label == y).sum()), x[label == y]))
                total[int(y)] = total.get(int(y), 0) + one.T @ one
        for y, m in total.items():
            i, j = np.divmod(np.arange(m.size), d + 1)
            yield pa.RecordBatch.from_pydict(
                {
                    "y": pa.array([y] * m.size, pa.int32()),
                    "i": pa.array(i, pa.int32()),
                    "j": pa.array(j, pa.int32()),
                    "s": m.ravel(),
                }
            )

    parts = labelled.select(F.col("y").cast("int"), "x").mapInArrow(
        batches, "y int, i int, j int, s double"
    )
    found: dict[int, np.ndarray] = {}
    for y, i, j, s in parts.groupBy("y", "i", "j").agg(F.sum("s")).collect():
        found.setdefault(y, np.zeros((d + 1, d + 1)))[i, j] = s
    return {y: (m[0, 0], m[0, 1:], m[1:, 1:]) for y, m in found.items()}


@dataclass(frozen=True)
class Discriminant:
    """Per class: log share, mean and the inverse Cholesky factor with its log determinant."""

    classes: dict

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.classes:
            return np.full(len(x), 0.5)
        if len(self.classes) == 1:
            return np.full(len(x), float(next(iter(self.classes))))
        density = {}
        for y, (share, mean, whiten, log_det) in self.classes.items():
            z = (x - mean) @ whiten.T
            density[y] = share - log_det - 0.5 * (z * z).sum(axis=1)
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -50, 50)))


def fit(labelled: DataFrame, pooled: float = 0.1, diagonal: float = 0.05) -> Discriminant:
    """Fit on (y, x) rows, y being 0 or 1. ``pooled`` and ``diagonal`` are shrinkage weights."""
    found = _moments(labelled)
    total = sum(n for n, _, _ in found.values())
    spread = {y: (p - np.outer(s, s) / n) for y, (n, s, p) in found.items()}
    joint = sum(spread.values()) / max(1.0, total) if spread else None
    classes = {}
    for y, (n, s, _) in found.items():
        cov = (1 - pooled) * spread[y] / max(1.0, n) + pooled * joint
        cov = (1 - diagonal) * cov + diagonal * np.diag(np.diag(cov)) + 1e-4 * np.eye(len(s))
        factor = np.linalg.cholesky(cov)
        classes[y] = (
            np.log(n / total),
            s / n,
            np.linalg.inv(factor),
            np.log(np.diag(factor)).sum(),
        )
    return Discriminant(classes)


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, score) per row of ``docs``: how likely ``labels.quality`` is 1.

    Label rows whose doc_id or quality is null or unknown are left out; a repeated
    label counts as often as it comes. Null, empty and very long texts are scored
    like others. With no labels every score is 0.5; with one class it is that class.
    Rows that repeat a doc_id are scored one by one. No other column is read.
    """
    vectors = staged(featurise(docs), "features")
    known = labels.where(F.col("quality").isin(0, 1)).select(
        F.col("doc_id").cast("long"), F.col("quality").alias("y")
    )
    model = fit(vectors.join(known, "doc_id").select("y", "x"))

    def batches(source):
        for batch in source:
            x = np.asarray(batch.column(1).flatten()).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(model.scores(x))], names=["doc_id", "score"]
            )

    return vectors.mapInArrow(batches, "doc_id long, score double")
