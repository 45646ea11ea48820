"""Losses and metrics of training as sums over rows (M4).

A loss gives a number per row and the gradient at the network's output.  A
metric is an accumulator: a vector that a task adds up over its rows, so any
metric is summed on the executors in the job that computes the gradients, and a
function that turns the total into one number.  Sums of tasks, epochs' parts
or frames merge by addition.

Arrays are rows x outputs.  A class is predicted per output (score clipped to
[0, 1], rounded half to even); a softmax network predicts its largest output.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np

# The probability clip of the cross-entropies, and the long names of the losses.
EPS = 1e-7
LONG_NAMES = {"binary_crossentropy": "bce", "categorical_crossentropy": "cce", "mean_squared_error": "mse",
              "mean_absolute_error": "mae"}
LOSSES = ("bce", "cce", "mse", "mae")


def loss_name(loss: str | None, output: str) -> str:
    """The short name of a loss; by default the cross-entropy that belongs to the output."""
    name = LONG_NAMES.get(loss, loss) or ("cce" if output == "softmax" else "bce")
    if name not in LOSSES:
        raise ValueError(f"unknown loss {loss!r}: one of {', '.join(LOSSES)}")
    if (name == "cce") != (output == "softmax") and name in ("cce", "bce"):
        raise ValueError("'cce' is the cross-entropy of a softmax output, 'bce' of every other one")
    return name


def clipped(score: np.ndarray) -> np.ndarray:
    return np.clip(score, EPS, 1.0 - EPS)


def row_loss(loss: str, output: str, y: np.ndarray, score: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Loss per row: the mean over outputs, or the cross-entropy of the class."""
    if loss == "mse":
        return np.mean((score - y) ** 2, axis=1)
    if loss == "mae":
        return np.mean(np.abs(score - y), axis=1)
    if loss == "cce":
        top = z.max(axis=1, keepdims=True)
        log_p = z - top - np.log(np.exp(z - top).sum(axis=1, keepdims=True))
        return -(y * log_p).sum(axis=1)
    if output == "sigmoid":  # softplus(z) - y z, the stable form of -[y ln p + (1-y) ln(1-p)]
        return (np.logaddexp(0.0, z) - y * z).mean(axis=1)
    p = clipped(score)
    return -(y * np.log(p) + (1.0 - y) * np.log(1.0 - p)).mean(axis=1)


def output_gradient(loss: str, output: str, y: np.ndarray, score: np.ndarray) -> np.ndarray:
    """Gradient of each row's loss with respect to the output before its activation."""
    k = score.shape[1]
    if loss == "cce":
        return score * y.sum(axis=1, keepdims=True) - y
    if loss == "bce":
        if output == "sigmoid":
            return (score - y) / k
        p = clipped(score)  # no gradient where the clip is active
        return np.where(p == score, (p - y) / (p * (1.0 - p)), 0.0) / k
    g = (2.0 * (score - y) if loss == "mse" else np.sign(score - y)) / k
    if output == "sigmoid":
        return g * score * (1.0 - score)
    if output == "softmax":
        return score * (g - (g * score).sum(axis=1, keepdims=True))
    return g


def predicted(score: np.ndarray, output: str) -> np.ndarray:
    """0 or 1 per output."""
    if output == "softmax":
        return (np.arange(score.shape[1]) == score.argmax(axis=1)[:, None]).astype(float)
    return np.rint(np.clip(score, 0.0, 1.0))


@dataclass(frozen=True)
class Metric:
    """``add(y, score)``: a vector of ``size`` sums over rows; ``value(total, rows)``: the metric."""

    name: str
    size: int
    add: Callable[[np.ndarray, np.ndarray], np.ndarray]
    value: Callable[[np.ndarray, float], float]


def mean_of(name: str, per_row: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> Metric:
    """The mean over rows of a function of (y, score) that gives a number per row."""
    return Metric(name, 1, lambda y, s: np.array([np.sum(per_row(y, s))]), lambda total, n: float(total[0] / n))


def _ratio(a: float, b: float) -> float:
    return float(a / b) if b else 0.0


def _counts(y: np.ndarray, yhat: np.ndarray) -> np.ndarray:
    """True positives, predicted positives, positives."""
    return np.array([np.sum((y == 1) & (yhat == 1)), np.sum(yhat == 1), np.sum(y == 1)], dtype=float)


def named_metric(name: str, output: str, outputs: int) -> Metric:
    """A metric by name; ``name[j]`` is that of output j alone."""
    m = re.fullmatch(r"(\w+)(?:\[(\d+)\])?", name)
    short = LONG_NAMES.get(m.group(1), m.group(1)) if m else name
    only = int(m.group(2)) if m and m.group(2) else None
    if only is not None and only >= outputs:
        raise ValueError(f"{name!r}: the network has {outputs} outputs")
    pick = (lambda a: a) if only is None else (lambda a: a[:, only:only + 1])
    labels = lambda s: pick(predicted(s, output))
    if short in ("acc", "accuracy"):
        if output == "softmax" and only is None:
            return mean_of(name, lambda y, s: s.argmax(axis=1) == y.argmax(axis=1))
        return mean_of(name, lambda y, s: (labels(s) == pick(y)).mean(axis=1))
    if short == "mse":
        return mean_of(name, lambda y, s: np.mean((pick(s) - pick(y)) ** 2, axis=1))
    if short == "mae":
        return mean_of(name, lambda y, s: np.mean(np.abs(pick(s) - pick(y)), axis=1))
    if short == "bce":
        return mean_of(name, lambda y, s: row_loss("bce", "linear", pick(y), pick(s), pick(s)))
    if short in ("precision", "recall", "f1"):
        def value(t: np.ndarray, n: float) -> float:
            precision, recall = _ratio(t[0], t[1]), _ratio(t[0], t[2])
            return {"precision": precision, "recall": recall, "f1": _ratio(2 * precision * recall, precision + recall)}[short]
        return Metric(name, 3, lambda y, s: _counts(pick(y), labels(s)), value)
    if short == "r2":
        def moments(y: np.ndarray, s: np.ndarray) -> np.ndarray:
            y, s = pick(y), pick(s)
            return np.array([np.sum((s - y) ** 2), np.sum(y), np.sum(y * y), y.size])
        return Metric(name, 4, moments, lambda t, n: 1.0 - _ratio(t[0], t[2] - t[1] ** 2 / t[3]) if t[3] else float("nan"))
    raise ValueError(f"unknown metric {name!r}")


def resolve_metrics(metrics: Sequence[str | Metric | Callable], output: str, outputs: int) -> list[Metric]:
    """Names, ``Metric`` objects, or functions of (y, score) that give a number per row."""
    out = []
    for m in metrics:
        if isinstance(m, str):
            out.append(named_metric(m, output, outputs))
        elif isinstance(m, Metric):
            out.append(m)
        else:
            out.append(mean_of(getattr(m, "__name__", "metric"), m))
    names = [m.name for m in out]
    if len(set(names)) < len(names) or "loss" in names:
        raise ValueError("metric names must differ from each other and from 'loss'")
    return out
