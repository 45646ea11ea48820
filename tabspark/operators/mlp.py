"""Dense ReLU networks as plain numpy (M1-M3).

This is the per-task arithmetic of training and scoring: forward pass,
backpropagation of a weighted loss (``losses``), and the optimizer
update rules.  Spark decides which rows a task sees; this module only does
the math for one batch.  Parameters travel as one flat float64 vector.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

import numpy as np

from .losses import loss_name, output_gradient, row_loss


@dataclass(frozen=True)
class MLPSpec:
    """Layer sizes of a dense network (M1, M2).

    ``hidden``: (units, dropout rate) per ReLU layer.  ``l2`` is the weight of
    the L2 penalty on hidden kernels only (not biases, not the output layer).
    ``output``: ``"sigmoid"`` (default; with several outputs independent ones),
    ``"linear"`` (raw scores, which the cross-entropy clips into (0, 1), the
    reference's setting) or ``"softmax"`` (one class of ``outputs``).
    """

    inputs: int
    hidden: tuple[tuple[int, float], ...] = ()
    outputs: int = 1
    l2: float = 0.0
    output: str = "sigmoid"

    def __post_init__(self):
        object.__setattr__(self, "hidden", tuple((int(u), float(d)) for u, d in self.hidden))
        if self.output not in ("sigmoid", "linear", "softmax"):
            raise ValueError("output must be 'sigmoid', 'linear' or 'softmax'")
        if self.outputs < 1 or (self.output == "softmax" and self.outputs < 2):
            raise ValueError("a network has at least one output, a softmax one at least two")

    def layer_shapes(self) -> list[tuple[int, int]]:
        sizes = [self.inputs] + [u for u, _ in self.hidden] + [self.outputs]
        return list(zip(sizes[:-1], sizes[1:]))

    def n_params(self) -> int:
        return sum(i * o + o for i, o in self.layer_shapes())

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> "MLPSpec":
        d = json.loads(text)
        d["hidden"] = tuple(tuple(h) for h in d["hidden"])
        return MLPSpec(**d)


@dataclass
class MLPModel:
    spec: MLPSpec
    weights: list[np.ndarray]
    biases: list[np.ndarray]
    meta: dict = field(default_factory=dict)

    def flat(self) -> np.ndarray:
        parts = []
        for w, b in zip(self.weights, self.biases):
            parts += [w.ravel(), b.ravel()]
        return np.concatenate(parts).astype(np.float64)

    @staticmethod
    def from_flat(spec: MLPSpec, theta: np.ndarray, meta: dict | None = None) -> "MLPModel":
        weights, biases, k = [], [], 0
        for i, o in spec.layer_shapes():
            weights.append(np.asarray(theta[k:k + i * o], dtype=np.float64).reshape(i, o))
            k += i * o
            biases.append(np.asarray(theta[k:k + o], dtype=np.float64).copy())
            k += o
        if k != len(theta):
            raise ValueError(f"parameter vector has {len(theta)} values, spec needs {k}")
        return MLPModel(spec, weights, biases, dict(meta or {}))

    def param_rows(self) -> list[tuple[int, str, int, int, float]]:
        """(layer, kind, row, col, value) rows: kind 'W' kernels, 'b' biases."""
        rows = []
        for layer, (w, b) in enumerate(zip(self.weights, self.biases)):
            for r in range(w.shape[0]):
                for c in range(w.shape[1]):
                    rows.append((layer, "W", r, c, float(w[r, c])))
            for c in range(b.shape[0]):
                rows.append((layer, "b", 0, c, float(b[c])))
        return rows

    @staticmethod
    def from_param_rows(spec: MLPSpec, rows) -> "MLPModel":
        shapes = spec.layer_shapes()
        weights = [np.zeros(s) for s in shapes]
        biases = [np.zeros(s[1]) for s in shapes]
        for layer, kind, r, c, v in rows:
            if kind == "W":
                weights[layer][r, c] = v
            else:
                biases[layer][c] = v
        return MLPModel(spec, weights, biases)


def param_index(spec: MLPSpec) -> list[tuple[int, str, int, int]]:
    """(layer, kind, row, col) of each position of the flat vector."""
    index = []
    for layer, (i, o) in enumerate(spec.layer_shapes()):
        index += [(layer, "W", r, c) for r in range(i) for c in range(o)]
        index += [(layer, "b", 0, c) for c in range(o)]
    return index


def init_model(spec: MLPSpec, seed: int = 0) -> MLPModel:
    """Glorot-uniform kernels and zero biases (the Keras defaults)."""
    rng = np.random.default_rng(seed)
    weights, biases = [], []
    for i, o in spec.layer_shapes():
        limit = np.sqrt(6.0 / (i + o))
        weights.append(rng.uniform(-limit, limit, size=(i, o)))
        biases.append(np.zeros(o))
    return MLPModel(spec, weights, biases)


def activate(output: str, z: np.ndarray) -> np.ndarray:
    """Scores from the last layer's sums."""
    if output == "sigmoid":
        return 0.5 * (1.0 + np.tanh(0.5 * z))
    if output == "softmax":
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)
    return z


def forward(model: MLPModel, x: np.ndarray, rng: np.random.Generator | None = None):
    """Scores and the activations needed by ``backward``.

    ``rng`` switches dropout on (training); scoring passes none.
    """
    acts, masks, pre = [x], [], []
    a = x
    for (w, b), (_, rate) in zip(zip(model.weights[:-1], model.biases[:-1]), model.spec.hidden):
        z = a @ w + b
        pre.append(z)
        a = np.maximum(z, 0.0)
        if rng is not None and rate > 0.0:
            mask = (rng.random(a.shape) >= rate) / (1.0 - rate)
            a = a * mask
            masks.append(mask)
        else:
            masks.append(None)
        acts.append(a)
    z_out = a @ model.weights[-1] + model.biases[-1]
    return activate(model.spec.output, z_out), (acts, masks, pre, z_out)


def predict_scores(model: MLPModel, x: np.ndarray) -> np.ndarray:
    return forward(model, x)[0]


def row_losses(model: MLPModel, y: np.ndarray, score: np.ndarray, z_out: np.ndarray, loss: str | None = None) -> np.ndarray:
    """Loss per row, without penalty."""
    output = model.spec.output
    return row_loss(loss_name(loss, output), output, y.reshape(score.shape), score, z_out)


def l2_penalty(model: MLPModel) -> float:
    if model.spec.l2 == 0.0:
        return 0.0
    return float(model.spec.l2 * sum(np.sum(w * w) for w in model.weights[:-1]))


def loss_and_grad(model: MLPModel, x: np.ndarray, y: np.ndarray, w: np.ndarray | None = None,
                  rng: np.random.Generator | None = None, normalize: bool = True, loss: str | None = None):
    """Weighted mean loss (+ L2) of one batch and its gradient as a flat vector.

    With ``normalize=False`` the data part is a *sum* over rows (for adding
    up partial gradients over partitions) and the L2 part is left out.
    Returns (loss, grad, scores).
    """
    n = x.shape[0]
    w = np.ones(n) if w is None else w
    score, (acts, masks, pre, z_out) = forward(model, x, rng)
    name, output = loss_name(loss, model.spec.output), model.spec.output
    yy = y.reshape(score.shape)
    per_row = row_loss(name, output, yy, score, z_out)
    scale = 1.0 / n if normalize else 1.0
    dz = output_gradient(name, output, yy, score) * (w[:, None] * scale)
    grads_w, grads_b = [None] * len(model.weights), [None] * len(model.weights)
    grads_w[-1] = acts[-1].T @ dz
    grads_b[-1] = dz.sum(axis=0)
    da = dz @ model.weights[-1].T
    for layer in range(len(model.weights) - 2, -1, -1):
        if masks[layer] is not None:
            da = da * masks[layer]
        dz_l = da * (pre[layer] > 0.0)
        grads_w[layer] = acts[layer].T @ dz_l
        grads_b[layer] = dz_l.sum(axis=0)
        if normalize and model.spec.l2:
            grads_w[layer] = grads_w[layer] + 2.0 * model.spec.l2 * model.weights[layer]
        if layer > 0:
            da = dz_l @ model.weights[layer].T
    data_loss = float(np.sum(w * per_row) * scale)
    total = data_loss + (l2_penalty(model) if normalize else 0.0)
    parts = []
    for gw, gb in zip(grads_w, grads_b):
        parts += [gw.ravel(), gb.ravel()]
    return total, np.concatenate(parts), score


@dataclass(frozen=True)
class OptimizerSpec:
    """Update rule (M3): ``sgd`` (with ``momentum``), ``rmsprop`` or ``adagrad``.

    ``decay`` shrinks the step as lr / (1 + decay * iterations).
    """

    name: str = "rmsprop"
    lr: float = 0.001
    epsilon: float = 1e-8
    rho: float = 0.9
    momentum: float = 0.0
    decay: float = 0.0

    def __post_init__(self):
        if self.name not in ("sgd", "rmsprop", "adagrad"):
            raise ValueError(f"unknown optimizer {self.name!r}")


def optimizer_step(opt: OptimizerSpec, theta: np.ndarray, grad: np.ndarray, state: np.ndarray, iteration: int):
    """One update; ``state`` is the accumulator (rmsprop, adagrad) or velocity (sgd)."""
    lr = opt.lr / (1.0 + opt.decay * iteration) if opt.decay else opt.lr
    if opt.name == "sgd":
        state = opt.momentum * state - lr * grad
        theta = theta + state
    elif opt.name == "rmsprop":
        state = opt.rho * state + (1.0 - opt.rho) * grad * grad
        theta = theta - lr * grad / (np.sqrt(state) + opt.epsilon)
    else:
        state = state + grad * grad
        theta = theta - lr * grad / (np.sqrt(state) + opt.epsilon)
    return theta, state
