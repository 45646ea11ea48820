"""Fixed inputs of the driver's query set: seeds, maps and small scorers.

These are parameters of the checked queries, shared by the Spark side and
the SQL oracle so both compute the same thing.
"""

from __future__ import annotations

import numpy as np

from ..operators.mlp import MLPModel, MLPSpec

SEED = 42
BATCH = 256
STATUS_MAP = {"O": 1.0, "F": 0.0}
LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
ORDER_FEATURES = ["o_totalprice", "o_custkey"]
CLASS_WEIGHT = {0.0: 1.0, 1.0: 2.0}

# A 4-2-1 ReLU network (Q25).
RELU_W0 = [[0.5, -0.3], [0.8, 0.1], [-0.4, 0.6], [0.2, -0.7]]
RELU_B0 = [0.1, -0.2]
RELU_W1 = [[1.2], [-0.9]]
RELU_B1 = [0.05]

# Linear scorers (hidden=[]) on standardized features.
LINE_SCORER_W = [[0.3], [-0.2], [0.5], [0.1]]
LINE_SCORER_B = [0.0]
GRAD_START_W = [[0.1], [-0.1], [0.2], [0.0]]
GRAD_START_B = [0.0]
ORDER_SCORER_W = [[1.5], [0.0]]
ORDER_SCORER_B = [-0.2]
ENSEMBLE = [([[0.8], [0.1]], [0.0]), ([[-0.5], [0.3]], [0.2])]


def model(weights: list, biases: list, hidden: tuple = ()) -> MLPModel:
    ws = [np.array(w, dtype=np.float64) for w in weights]
    bs = [np.array(b, dtype=np.float64) for b in biases]
    spec = MLPSpec(ws[0].shape[0], hidden, ws[-1].shape[1])
    return MLPModel(spec, ws, bs)


def relu_net() -> MLPModel:
    return model([RELU_W0, RELU_W1], [RELU_B0, RELU_B1], ((2, 0.0),))


def line_scorer() -> MLPModel:
    return model([LINE_SCORER_W], [LINE_SCORER_B])


def grad_start() -> MLPModel:
    return model([GRAD_START_W], [GRAD_START_B])


def order_scorer() -> MLPModel:
    return model([ORDER_SCORER_W], [ORDER_SCORER_B])


def ensemble_members() -> list[MLPModel]:
    return [model([w], [b]) for w, b in ENSEMBLE]

# Starting points of the fits in closed form: two outputs, three classes, a linear score, a network with a hidden layer.
TWO_OUTPUTS_W = [[0.1, -0.2], [-0.1, 0.3], [0.2, 0.1], [0.0, -0.1]]
TWO_OUTPUTS_B = [0.1, -0.3]
CLASSES_W = [[0.1, -0.1, 0.0], [0.2, 0.0, -0.1], [-0.2, 0.1, 0.1], [0.0, 0.3, -0.2]]
CLASSES_B = [0.0, 0.1, -0.1]
FLAG_MAP = {"A": 0.0, "N": 1.0, "R": 2.0}
HIDDEN_L2 = 0.05
ORDER_LINEAR_W = [[0.4]]
ORDER_LINEAR_B = [0.1]


def started(weights: list, biases: list, output: str, hidden: tuple = (), l2: float = 0.0) -> MLPModel:
    ws = [np.array(w, dtype=np.float64) for w in weights]
    spec = MLPSpec(ws[0].shape[0], hidden, ws[-1].shape[1], l2, output)
    return MLPModel(spec, ws, [np.array(b, dtype=np.float64) for b in biases])
