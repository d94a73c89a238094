"""A hashed linear scorer: logistic loss, L1 and L2 penalties, and pairs whose scores should agree."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import xxhash


def bucket(feature: str, buckets: int) -> int:
    return xxhash.xxh64_intdigest(feature.encode("utf-8", "surrogatepass"), 17) % buckets


@dataclass
class Rows:
    """Sparse rows: column numbers (and values, all 1 if None) one after another, and where each row begins."""

    columns: np.ndarray
    values: np.ndarray | None
    starts: np.ndarray

    @classmethod
    def of(cls, rows: list[np.ndarray], values: list[np.ndarray] | None = None) -> Rows:
        flat = np.concatenate([*rows, np.zeros(0, np.int32)]).astype(np.int32)
        starts = np.concatenate([[0], np.cumsum([len(c) for c in rows])]).astype(np.int64)
        return cls(flat, None if values is None else np.concatenate([*values, np.zeros(0)]).astype(float), starts)

    def __len__(self) -> int:
        return len(self.starts) - 1

    def numbers(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.starts))

    def absolute(self) -> np.ndarray:
        return np.ones(len(self.columns)) if self.values is None else np.abs(self.values)

    def dot(self, w: np.ndarray, at: np.ndarray) -> np.ndarray:
        own = w[self.columns]
        return np.bincount(at, own if self.values is None else own * self.values, minlength=len(self))

    def back(self, r: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
        own = r[at]
        return np.bincount(self.columns, own if self.values is None else own * self.values, minlength=size)


def fit(
    rows: Rows,
    labels: np.ndarray,
    size: int,
    pairs: Rows | None = None,
    agree: float = 1.0,
    l1: float = 2e-4,
    l2: float = 1e-5,
    rounds: int = 150,
) -> tuple[np.ndarray, float]:
    """Weights and intercept: mean logistic loss + l1 |w| + l2 |w|^2 / 2 + agree * mean((pair . w)^2) / 2.

    ``labels`` may be fractions.  A row of ``pairs`` is the difference of the features of a
    sentence and of its counterfactual.  Accelerated proximal gradient with a step from
    the largest curvature per column (diagonal scaling), deterministic.
    """
    at = rows.numbers()
    n = max(1, len(rows))
    w, b = np.zeros(size), 0.0
    if not len(rows):
        return w, b
    mean = min(1 - 1e-6, max(1e-6, float(labels.mean())))
    b = float(np.log(mean / (1 - mean)))
    pair_at = pairs.numbers() if pairs is not None and len(pairs) else None
    # rows overlap in many columns: bound the curvature of each column by the row sums
    sums = np.bincount(at, rows.absolute(), minlength=len(rows)) + 1.0
    curve = np.bincount(rows.columns, rows.absolute() * sums[at], minlength=size) / (4 * n) + l2
    if pair_at is not None:
        reach = np.bincount(pair_at, pairs.absolute(), minlength=len(pairs))
        curve += agree * np.bincount(pairs.columns, pairs.absolute() * reach[pair_at], minlength=size) / len(pairs)
    curve = np.maximum(curve, 1e-12)
    curve_b = float(sums.mean()) / 4
    v, vb, t = w.copy(), b, 1.0
    for _ in range(rounds):
        z = rows.dot(v, at) + vb
        residual = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels) / n
        grad = rows.back(residual, at, size) + l2 * v
        if pair_at is not None:
            grad += agree * pairs.back(pairs.dot(v, pair_at) / len(pairs), pair_at, size)
        moved = v - grad / curve
        new = np.sign(moved) * np.maximum(np.abs(moved) - l1 / curve, 0)
        new_b = vb - float(residual.sum()) / curve_b
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = new + (t - 1) / t_next * (new - w), new_b + (t - 1) / t_next * (new_b - b)
        w, b, t = new, new_b, t_next
    return w, b
