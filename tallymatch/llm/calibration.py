"""Labelled samples of bounded size, and logistic calibration of compression measurements."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text has that remainder (a null id has not)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus == remainder, F.lit(False))


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    modulus: int,
    remainder: int,
    rows: int,
    chars: int,
    folder: str,
) -> tuple[list[tuple[str, int]], float]:
    """The share of label 1 among all rows that are not held out, and of them (text, label) of at most ``rows`` rows of each label that are not held out, in a fixed random order.

    Texts above ``chars`` characters are not taken for learning (they are scored like all
    others), so the sample is bounded by ``2 * rows * chars`` characters whatever the input.
    """
    usable = labels.where(
        F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id"), modulus, remainder)
    ).select("doc_id", F.col(label).alias("label"))
    order = [F.xxhash64(F.col("doc_id")), F.col("doc_id")]
    parts = [usable.where(F.col("label") == k).orderBy(*order).limit(rows) for k in (0, 1)]
    chosen = stored(parts[0].unionByName(parts[1]), folder)  # at most 2 * rows ids
    found = (
        docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .where(F.length("text") <= chars)
        .select("text", "label", "doc_id")
        .collect()
    )
    share = usable.agg(F.avg(F.col("label").cast("double"))).first()[0] or 0.0
    found.sort(key=lambda r: (r.doc_id * 2654435761 % 2**32, r.doc_id, r.text))
    return [(r.text, r.label) for r in found], share


@dataclass(frozen=True)
class Logistic:
    """Probability of label 1 from measurements that are centred and scaled first."""

    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        # Summed row by row, so that a row's score does not depend on the rows beside it.
        z = ((x - self.mean) / self.scale * self.weight[1:]).sum(axis=1) + self.weight[0]
        z = np.clip(z, -30, 30)
        return 1 / (1 + np.exp(-z))


def fit_logistic(x: np.ndarray, y: np.ndarray, share: float, ridge: float = 1e-2, steps: int = 50) -> Logistic:
    """Newton's method with a ridge, so that labels which separate perfectly have a finite answer too.

    ``share`` is that of label 1 where the score is to hold; the sample may have another.
    """
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    each = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    w = np.zeros(z.shape[1])
    penalty = np.full(z.shape[1], ridge * len(x) / 100)
    penalty[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (each * (p - y)) + penalty * w
        curve = (z * (each * p * (1 - p))[:, None]).T @ z + np.diag(penalty + 1e-9)
        step = np.linalg.solve(curve, slope)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return Logistic(mean, scale, w)
