"""A small recurrent network for sequence windows (M15), trained data-parallel.

The network reads a window's standardised values one by one into a hidden
state (``h = tanh(x * wx + h @ wh + b)``) and predicts the next value from the
last state.  A training step is one Spark job: every task runs its windows
forward and back through time and returns the sum of its gradients, Spark
adds the sums up, and the driver moves the weights (Adam) and sends them with the
next step's tasks.  What travels is some hundred numbers per task; no task sees
more than its own windows, a batch at a time.

Windows with a null among their values or as target are neither learned from nor predicted (null).
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Windows that go through the network together.
TOGETHER = 4096


def sizes(hidden: int) -> list[tuple[str, tuple[int, ...]]]:
    return [("wx", (hidden,)), ("wh", (hidden, hidden)), ("b", (hidden,)), ("wy", (hidden,)), ("by", (1,))]


def split(weights: np.ndarray, hidden: int) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in sizes(hidden):
        n = int(np.prod(shape))
        out[name] = weights[at:at + n].reshape(shape)
        at += n
    return out


def start(hidden: int, seed: int = 7) -> np.ndarray:
    rng = np.random.default_rng(seed)
    parts = [rng.normal(0, 0.5 / np.sqrt(hidden), shape).ravel() if name.startswith("w") else np.zeros(shape)
             for name, shape in sizes(hidden)]
    return np.concatenate([p.ravel() for p in parts])


def forward(x: np.ndarray, w: dict[str, np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Predictions of windows (rows of ``x``) and the states on the way."""
    states = [np.zeros((len(x), len(w["b"])))]
    for t in range(x.shape[1]):
        states.append(np.tanh(np.outer(x[:, t], w["wx"]) + states[-1] @ w["wh"] + w["b"]))
    return states[-1] @ w["wy"] + w["by"][0], states


def loss_and_gradient(x: np.ndarray, y: np.ndarray, weights: np.ndarray, hidden: int) -> tuple[float, np.ndarray]:
    """Sum of squared errors (halved) and its gradient, by going back through time."""
    w = split(weights, hidden)
    predicted, states = forward(x, w)
    error = predicted - y
    grad = {name: np.zeros(shape) for name, shape in sizes(hidden)}
    grad["wy"], grad["by"] = states[-1].T @ error, np.array([error.sum()])
    back = np.outer(error, w["wy"])
    for t in range(x.shape[1] - 1, -1, -1):
        back = back * (1 - states[t + 1] ** 2)
        grad["wx"] += x[:, t] @ back
        grad["wh"] += states[t].T @ back
        grad["b"] += back.sum(0)
        back = back @ w["wh"].T
    return 0.5 * float(error @ error), np.concatenate([grad[name].ravel() for name, _ in sizes(hidden)])


@dataclasses.dataclass(frozen=True)
class Recurrent:
    """A fitted network; values are standardised with ``mean`` and ``std``."""
    weights: np.ndarray
    hidden: int
    mean: float
    std: float
    losses: tuple[float, ...] = ()

    def transform(self, windows: DataFrame, history: str = "history", out: str = "prediction") -> DataFrame:
        """``windows`` with the predicted next value."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            w = split(self.weights, self.hidden)
            for batch in batches:
                for at in range(0, batch.num_rows, TOGETHER):
                    part = batch.slice(at, TOGETHER)
                    x = _matrix(part.column(history), self.mean, self.std)
                    whole = np.isfinite(x).all(1)
                    values = np.full(len(x), np.nan)
                    if whole.any():
                        values[whole] = forward(x[whole], w)[0] * self.std + self.mean
                    yield part.append_column(out, pa.array(values, mask=~whole))

        return windows.mapInArrow(run, windows.withColumn(out, F.lit(None).cast("double")).schema)


def _matrix(column: pa.Array, mean: float, std: float) -> np.ndarray:
    lists = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return (lists.reshape(len(column), -1) - mean) / std if len(column) else np.zeros((0, 1))


def fit(windows: DataFrame, history: str = "history", target: str = "target", hidden: int = 8,
        steps: int = 30, rate: float = 0.05, seed: int = 7) -> Recurrent:
    """Train on all ``windows`` (written or cheap to read: every step reads them)."""
    rows = windows.select(F.col(history).alias("x"), F.col(target).cast("double").alias("y")).where(
        F.col("y").isNotNull() & ~F.exists("x", lambda v: v.isNull() | F.isnan(v)))
    n, mean, std = rows.agg(F.count("*"), F.avg("y"), F.stddev_pop("y")).first()
    if not n:
        raise ValueError("no whole window to learn from")
    std = std or 1.0
    weights = start(hidden, seed)
    count = len(weights)

    def step(current: np.ndarray) -> tuple[float, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            loss, grad = 0.0, np.zeros(count)
            for batch in batches:
                for at in range(0, batch.num_rows, TOGETHER):
                    part = batch.slice(at, TOGETHER)
                    y = (part.column("y").to_numpy(zero_copy_only=False) - mean) / std
                    more, own = loss_and_gradient(_matrix(part.column("x"), mean, std), y, current, hidden)
                    loss, grad = loss + more, grad + own
            yield pa.record_batch({"loss": pa.array([loss]), "grad": pa.array([grad], pa.list_(pa.float64()))})

        sums = rows.mapInArrow(run, "loss double, grad array<double>").agg(
            F.sum("loss"), F.array(*[F.sum(F.get("grad", F.lit(i))) for i in range(count)])).first()
        return sums[0] / n, np.array(sums[1]) / n

    first, second, losses = np.zeros(count), np.zeros(count), []
    for t in range(1, steps + 1):
        loss, grad = step(weights)
        losses.append(loss)
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad ** 2
        weights = weights - rate * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.999 ** t)) + 1e-8)
    return Recurrent(weights, hidden, mean, std, tuple(losses))
