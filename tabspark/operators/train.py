"""Training and evaluation on the executors.

The reference pulls every batch to the driver and trains there.  Here one
epoch is one Spark job:

1. rows carry ``batch_id`` / ``batch_pos`` (``assign_batches``) and are
   grouped so that each batch sits in one partition, in batch order;
2. every task (``mapInArrow``: features arrive as one matrix per Arrow
   batch) starts from the same parameters (a broadcast variable), runs
   its batches in order with the optimizer, and emits its parameters and
   optimizer state weighted by its row count, with the sums of the loss and of
   every metric;
3. the outputs, cut into blocks of ``BLOCK`` values, are shuffled by block
   and added up as arrays (parameter averaging, local SGD); the driver
   receives one vector whose size is the model's, in blocks.

With one partition this is exactly the sequential minibatch loop.  The
validation of an epoch's parameters runs inside the next epoch's job (the
parameters it starts from; the last epoch's in a job of its own), and the
parameters of the lowest validation loss are kept (the reference's best
checkpoint).  With ``checkpoint=`` the state after every epoch is a table in
that folder, and a fit that is started again goes on from the last one.

``strategy="sync"`` instead takes one full-batch gradient step per epoch:
tasks return gradient sums (and metric sums) for the same parameters.

Several members (``fit_members``: one model per sample of an ensemble) train
in the same jobs: rows carry the member's number, the broadcast holds every member's
parameters, and the sums are kept by member.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import assign_batches_counted, group_batches
from .losses import Metric, loss_name, resolve_metrics
from .mlp import (MLPModel, MLPSpec, OptimizerSpec, forward, init_model, l2_penalty, loss_and_grad, optimizer_step,
                  param_index, row_losses)
from .scoring import feature_matrix, features_array

# A task's output for a member: its vectors as one flat vector, cut into blocks.
_OUT_SCHEMA = "member int, block int, vals array<double>"
BLOCK = 4096
MEMBER = "__member"


class Layout:
    """Places of named vectors in a flat one."""

    def __init__(self, **sizes: int):
        ends = np.cumsum([0, *sizes.values()])
        self.places = {k: slice(int(a), int(b)) for k, a, b in zip(sizes, ends, ends[1:])}
        self.size = int(ends[-1])

    def pack(self, **vectors) -> np.ndarray:
        flat = np.zeros(self.size)
        for k, v in vectors.items():
            flat[self.places[k]] = v
        return flat

    def unpack(self, flat: np.ndarray | None) -> dict[str, np.ndarray]:
        flat = np.zeros(self.size) if flat is None else flat
        return {k: flat[s] for k, s in self.places.items()}


def _emit(member: int, flat: np.ndarray) -> pa.RecordBatch:
    """A flat vector as ``BLOCK``-sized rows; blocks of zeros stay away."""
    starts = [a for a in range(0, len(flat), BLOCK) if a == 0 or flat[a:a + BLOCK].any()]
    offsets = np.cumsum([0, *[len(flat[a:a + BLOCK]) for a in starts]]).astype(np.int32)
    vals = np.concatenate([flat[a:a + BLOCK] for a in starts])
    return pa.RecordBatch.from_arrays(
        [pa.array([member] * len(starts), pa.int32()), pa.array([a // BLOCK for a in starts], pa.int32()),
         pa.ListArray.from_arrays(pa.array(offsets), pa.array(vals))], names=["member", "block", "vals"])


def _sum_outputs(outputs: DataFrame, size: int) -> dict[int, np.ndarray]:
    """The sum of the tasks' vectors (of ``size``) of each member, in one job.

    The one shuffle moves tasks x blocks rows, dealt by block; a task adds the
    arrays of its blocks, and the driver gets one row per block.
    """
    def add(chunks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for rb in chunks:
            lists = zip(rb.column(0).to_pylist(), rb.column(1).to_pylist(), rb.column(2))
            for member, block, vals in lists:
                own = vals.values.to_numpy(zero_copy_only=False)
                if (member, block) in sums:
                    sums[member, block] += own
                else:
                    sums[member, block] = own.copy()
        for (member, block), total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([member], pa.int32()), pa.array([block], pa.int32()),
                                              pa.array([total], pa.list_(pa.float64()))], names=["member", "block", "vals"])

    found = outputs.repartition("member", "block").mapInArrow(add, _OUT_SCHEMA).toArrow()
    out: dict[int, np.ndarray] = {}
    for member, block, vals in zip(found.column(0).to_pylist(), found.column(1).to_pylist(), found.column(2)):
        own = vals.values.to_numpy()
        out.setdefault(member, np.zeros(size))[block * BLOCK:block * BLOCK + len(own)] = own
    return out


def weight_column(label: str | Column, class_weight: Mapping[float, float] | None) -> Column:
    """Per-row loss weight from a class-weight map (M6); 1.0 for other labels."""
    if not class_weight:
        return F.lit(1.0)
    y = F.col(f"`{label}`") if isinstance(label, str) else label
    expr = None
    for cls, w in class_weight.items():
        cond = y.cast("double") == F.lit(float(cls))
        expr = F.when(cond, F.lit(float(w))) if expr is None else expr.when(cond, F.lit(float(w)))
    return expr.otherwise(F.lit(1.0))


def label_column(df: DataFrame, label: str | Sequence[str], outputs: int = 1) -> Column:
    """The label as training reads it: a double, or ``array<double>`` for several outputs.

    ``label``: a column per output, one array column, or (several outputs) one
    column of class numbers 0 to ``outputs`` - 1, any other class is missing.
    """
    if not isinstance(label, str):
        if len(label) != outputs:
            raise ValueError(f"{len(label)} label columns for {outputs} outputs")
        columns = [F.col(f"`{c}`").cast("double") for c in label]
        return F.array(*columns) if outputs > 1 else columns[0]
    y = F.col(f"`{label}`")
    if isinstance(df.schema[label].dataType, T.ArrayType):
        y = y.cast("array<double>")
        # An array of another length is no label.
        return F.when(F.size(y) == outputs, y) if outputs > 1 else F.when(F.size(y) == 1, y[0])
    if outputs == 1:
        return y.cast("double")
    y = y.cast("double")
    known = (y >= 0) & (y < outputs) & (y == F.floor(y))
    return F.when(known, F.array(*[(y == F.lit(float(k))).cast("double") for k in range(outputs)]))


def training_frame(
    df: DataFrame,
    features: Sequence[str] | str,
    label: str | Sequence[str],
    class_weight: Mapping[float, float] | None = None,
    keep: Sequence[str] = (),
    outputs: int = 1,
) -> DataFrame:
    """(keep..., x array<double>, y double or array<double>, w double): the only columns training reads."""
    if class_weight and (not isinstance(label, str) or isinstance(df.schema[label].dataType, T.ArrayType)):
        raise ValueError("class weights need one label column of classes")
    return df.select(
        *[F.col(f"`{k}`") for k in keep],
        features_array(df, features).alias("x"),
        label_column(df, label, outputs).alias("y"),
        weight_column(label if isinstance(label, str) else label[0], class_weight).alias("w"),
    )


def _arrays(rb: pa.RecordBatch, names: Sequence[str]) -> dict[str, np.ndarray]:
    """numpy views of the named columns; ``x`` and ``y`` as matrices (rows x features, rows x outputs).

    A missing feature or label (null or NaN) would poison the parameters, so
    it stops the job (``nulls="drop"`` in ``fit`` removes such rows first).
    """
    out = {}
    for n in names:
        column = rb.column(n)
        lists = pa.types.is_list(column.type) or pa.types.is_large_list(column.type)
        if n in ("x", "y"):
            missing = bool(column.null_count)
            if not missing:
                out[n] = feature_matrix(column) if lists else column.to_numpy(zero_copy_only=False).reshape(-1, 1)
                missing = bool(np.isnan(out[n]).any())
            if missing:
                raise ValueError(f"missing value (null or NaN) in {'a feature' if n == 'x' else 'the label'}; "
                                 "drop or fill such rows (fit(..., nulls='drop'), fill_nulls)")
        else:
            out[n] = column.to_numpy(zero_copy_only=False)
    return out


def complete_rows(frame: DataFrame) -> DataFrame:
    """Rows of a training frame whose features and labels are all present (not null, not NaN)."""
    def whole(name: str) -> Column:
        c = F.col(name)
        if isinstance(frame.schema[name].dataType, T.ArrayType):
            return c.isNotNull() & ~F.exists(c, lambda v: v.isNull() | F.isnan(v))
        return c.isNotNull() & ~F.isnan(c)

    return frame.where(whole("x") & whole("y"))


def _batches_in_order(chunks: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(member, batch_id, x, y, w) of whole batches from Arrow chunks sorted by (member, batch_id, batch_pos).

    Arrow slices a partition into chunks of at most
    ``spark.sql.execution.arrow.maxRecordsPerBatch`` rows; a batch cut by a
    chunk boundary is carried into the next chunk.
    """
    def one(a: dict[str, np.ndarray]) -> tuple:
        return int(a[MEMBER][0]), int(a["batch_id"][0]), a["x"], a["y"], a["w"]

    carry = None
    for rb in chunks:
        if rb.num_rows == 0:
            continue
        cur = _arrays(rb, (MEMBER, "batch_id", "x", "y", "w"))
        if carry is not None:
            cur = {k: np.concatenate([carry[k], cur[k]]) for k in cur}
        new = (cur["batch_id"][1:] != cur["batch_id"][:-1]) | (cur[MEMBER][1:] != cur[MEMBER][:-1])
        starts = np.flatnonzero(np.r_[True, new])
        for a, b in zip(starts[:-1], starts[1:]):
            yield one({k: v[a:b] for k, v in cur.items()})
        carry = {k: v[starts[-1]:] for k, v in cur.items()}
    if carry is not None:
        yield one(carry)


@dataclass(frozen=True)
class _Job:
    """What the tasks of a fit know: everything but the parameters."""

    spec: MLPSpec
    loss: str
    metrics: tuple[Metric, ...]
    optimizer: OptimizerSpec
    seeds: tuple[int, ...]
    layout: Layout

    def metric_sums(self, y: np.ndarray, score: np.ndarray) -> np.ndarray:
        return np.concatenate([np.zeros(0), *[m.add(y, score) for m in self.metrics]])

    def metric_values(self, sums: np.ndarray, rows: float) -> list[tuple[str, float]]:
        out, at = [], 0
        for m in self.metrics:
            out.append((m.name, float(m.value(sums[at:at + m.size], rows))))
            at += m.size
        return out


def _job(spec: MLPSpec, loss: str | None, metrics: Sequence, optimizer: OptimizerSpec = OptimizerSpec(),
         seeds: Sequence[int] = (0,)) -> _Job:
    chosen = tuple(resolve_metrics(metrics, spec.output, spec.outputs))
    k, p = sum(m.size for m in chosen), spec.n_params()
    layout = Layout(rows=1, loss=1, batches=1, tasks=1, metrics=k, val_rows=1, val_loss=1, val_metrics=k, theta=p, state=p)
    return _Job(spec, loss_name(loss, spec.output), chosen, optimizer, tuple(seeds), layout)


def _epoch_task(holder, job: _Job, epoch: int):
    def run(chunks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, it = None, 0

        def finished() -> pa.RecordBatch:
            rows = total["rows"]
            return _emit(current, job.layout.pack(**total, tasks=1.0, theta=theta * rows, state=state * rows))

        for member, batch_id, x, y, w in _batches_in_order(chunks):
            if member != current:
                if current is not None:
                    yield finished()
                current, (theta, state, it) = member, holder.value[member]
                it = int(it)
                total = {"rows": 0.0, "loss": 0.0, "batches": 0.0, "metrics": 0.0}
            rng = np.random.default_rng([job.seeds[member], epoch, batch_id])
            loss, grad, score = loss_and_grad(MLPModel.from_flat(job.spec, theta), x, y, w, rng=rng, loss=job.loss)
            theta, state = optimizer_step(job.optimizer, theta, grad, state, it)
            it += 1
            total = {"rows": total["rows"] + len(y), "loss": total["loss"] + loss * len(y),
                     "batches": total["batches"] + 1, "metrics": total["metrics"] + job.metric_sums(y, score)}
        if current is not None:
            yield finished()
    return run


def _members_of(a: dict[str, np.ndarray]) -> Iterator[tuple[int, dict[str, np.ndarray]]]:
    """The rows of each member."""
    members = a.pop(MEMBER)
    for member in np.unique(members):
        own = members == member
        yield int(member), a if own.all() else {k: v[own] for k, v in a.items()}


def _grad_task(holder, job: _Job):
    def run(chunks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for rb in chunks:
            if rb.num_rows == 0:
                continue
            for member, a in _members_of(_arrays(rb, (MEMBER, "x", "y", "w"))):
                model = MLPModel.from_flat(job.spec, holder.value[member][0])
                loss, grad, score = loss_and_grad(model, a["x"], a["y"], a["w"], normalize=False, loss=job.loss)
                part = job.layout.pack(rows=len(a["y"]), loss=loss, metrics=job.metric_sums(a["y"], score), theta=grad)
                totals[member] = totals[member] + part if member in totals else part
        for member, total in totals.items():
            yield _emit(member, total)
    return run


def _eval_task(holder, job: _Job, prefix: str = "", every_member: bool = False):
    """Loss and metric sums: of each row's own member, or of ``every_member`` on all rows."""
    def run(chunks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for rb in chunks:
            if rb.num_rows == 0:
                continue
            a = _arrays(rb, ("x", "y") if every_member else (MEMBER, "x", "y"))
            for member, own in ((m, a) for m in range(len(holder.value))) if every_member else _members_of(a):
                model = MLPModel.from_flat(job.spec, holder.value[member][0])
                score, (_, _, _, z_out) = forward(model, own["x"])
                per = row_losses(model, own["y"], score, z_out, job.loss)
                part = job.layout.pack(**{f"{prefix}rows": len(score), f"{prefix}loss": per.sum(),
                                          f"{prefix}metrics": job.metric_sums(own["y"], score)})
                totals[member] = totals[member] + part if member in totals else part
        for member, total in totals.items():
            yield _emit(member, total)
    return run


def _with_broadcast(spark: SparkSession, value, outputs: Callable, job: _Job) -> dict[int, np.ndarray]:
    """Sum the outputs of tasks that read ``value`` from a broadcast variable."""
    holder = spark.sparkContext.broadcast(value)
    try:
        return _sum_outputs(outputs(holder), job.layout.size)
    finally:
        holder.unpersist()


def _gradient_from(sums: dict[str, np.ndarray], model: MLPModel) -> tuple[np.ndarray, float, float]:
    """(gradient of the weighted mean loss incl. L2, data loss, rows) from gradient-task sums."""
    n = float(sums["rows"][0])
    if n == 0:
        raise ValueError("empty training frame")
    grad = sums["theta"] / n
    if model.spec.l2:
        l2 = MLPModel.from_flat(model.spec, np.zeros(model.spec.n_params()))
        for layer in range(len(model.weights) - 1):
            l2.weights[layer] = 2.0 * model.spec.l2 * model.weights[layer]
        grad = grad + l2.flat()
    return grad, float(sums["loss"][0]) / n, n


def gradient_sums(model: MLPModel, frame: DataFrame, loss: str | None = None) -> tuple[np.ndarray, float, float]:
    """(gradient of the weighted mean loss incl. L2, data loss, rows) over a training frame."""
    job = _job(model.spec, loss, ())
    own = frame.select(F.lit(0).alias(MEMBER), "x", "y", "w")
    sums = _with_broadcast(frame.sparkSession, [(model.flat(),)], lambda h: own.mapInArrow(_grad_task(h, job), _OUT_SCHEMA), job)
    return _gradient_from(job.layout.unpack(sums.get(0)), model)


def sync_gradient(
    df: DataFrame,
    model: MLPModel,
    features: Sequence[str] | str,
    label: str | Sequence[str],
    class_weight: Mapping[float, float] | None = None,
    loss: str | None = None,
) -> DataFrame:
    """Gradient of one synchronous full-batch step (M5 step mode).

    (layer, kind, row, col, gradient): the weighted mean-loss gradient summed
    over all partitions for the same parameters.
    """
    frame = training_frame(df, features, label, class_weight, outputs=model.spec.outputs)
    grad, _, _ = gradient_sums(model, frame, loss)
    rows = [(l, k, r, c, float(g)) for (l, k, r, c), g in zip(param_index(model.spec), grad)]
    return df.sparkSession.createDataFrame(rows, "layer int, kind string, row int, col int, gradient double")


@dataclass
class FitResult:
    model: MLPModel
    best_model: MLPModel
    best_epoch: int
    history: DataFrame
    history_rows: list[tuple[int, str, float]]


class _Member:
    """One model in training: parameters, optimizer state, history and best parameters."""

    def __init__(self, model: MLPModel):
        self.theta, self.state, self.iteration = model.flat(), np.zeros(model.spec.n_params()), 0
        self.best, self.best_value, self.best_epoch = self.theta, math.inf, 0
        self.history: list[tuple[int, str, float]] = []
        # (epoch, parameters) whose validation runs inside the next epoch's job:
        # they are that job's starting point, so one broadcast and one job serve both.
        self.pending = 0

    def monitor(self, epoch: int, params: np.ndarray, value: float) -> None:
        if value < self.best_value:
            self.best, self.best_value, self.best_epoch = params.copy(), value, epoch

    def record_val(self, job: _Job, epoch: int, sums: dict[str, np.ndarray], prefix: str) -> None:
        rows = float(sums[f"{prefix}rows"][0])
        if rows == 0:
            raise ValueError("empty validation frame")
        loss = float(sums[f"{prefix}loss"][0]) / rows + l2_penalty(MLPModel.from_flat(job.spec, self.theta))
        self.history.append((epoch, "val_loss", loss))
        self.history += [(epoch, f"val_{name}", v) for name, v in job.metric_values(sums[f"{prefix}metrics"], rows)]
        self.monitor(epoch, self.theta, loss)
        self.pending = 0

    def step(self, job: _Job, epoch: int, sums: dict[str, np.ndarray], strategy: str, monitored: bool) -> None:
        """Take over the result of an epoch's training pass."""
        n = float(sums["rows"][0])
        if n == 0:
            raise ValueError("empty training frame")
        if strategy == "average":
            measured = self.theta = sums["theta"] / n
            self.state = sums["state"] / n
            self.iteration += int(math.ceil(sums["batches"][0] / sums["tasks"][0]))
            loss = float(sums["loss"][0]) / n
        else:
            measured = self.theta  # the loss is that of the parameters before the step
            current = MLPModel.from_flat(job.spec, self.theta)
            grad, data_loss, n = _gradient_from(sums, current)
            loss = data_loss + l2_penalty(current)
            self.theta, self.state = optimizer_step(job.optimizer, self.theta, grad, self.state, self.iteration)
            self.iteration += 1
        self.history += [(epoch, "loss", loss), *[(epoch, name, v) for name, v in job.metric_values(sums["metrics"], n)]]
        if monitored:
            self.monitor(epoch, measured, loss)

    def result(self, spark: SparkSession, job: _Job) -> FitResult:
        if self.history and not self.best_epoch:
            raise ValueError("no epoch has a finite loss")
        names = ["loss", *[m.name for m in job.metrics]]
        rank = {m: i for i, m in enumerate([*names, *[f"val_{m}" for m in names]])}
        rows = sorted(self.history, key=lambda h: (h[0], rank[h[1]]))
        meta = {"best_epoch": self.best_epoch, "iterations": self.iteration}
        frame = spark.createDataFrame(rows, "epoch int, metric string, value double")
        return FitResult(MLPModel.from_flat(job.spec, self.theta, meta), MLPModel.from_flat(job.spec, self.best, meta),
                         self.best_epoch, frame, rows)


_STATE = "member int, name string, key string, vals array<double>"


def save_state(spark: SparkSession, path: str, epoch: int, settings: str, members: Sequence[_Member]) -> None:
    """The whole state after an epoch as one table of one file (S4): it is there whole or not at all."""
    rows = []
    for i, m in enumerate(members):
        rows += [(i, "theta", settings, m.theta.tolist()), (i, "state", "", m.state.tolist()), (i, "best", "", m.best.tolist()),
                 (i, "numbers", "", [float(m.iteration), m.best_value, float(m.best_epoch), float(m.pending)])]
        for name in dict.fromkeys(h[1] for h in m.history):
            own = [h for h in m.history if h[1] == name]
            rows.append((i, "history", name, [float(v) for h in own for v in (h[0], h[2])]))
    spark.createDataFrame(rows, _STATE).coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/epoch={epoch}")


def _states(spark: SparkSession, path: str) -> DataFrame | None:
    """The saved states under ``path``, if there are any."""
    try:
        return spark.read.schema(_STATE + ", epoch int").parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def load_state(spark: SparkSession, path: str, settings: str | None = None) -> tuple[int, list[_Member]]:
    """(epoch, members) of the last saved state, (0, []) without one; other ``settings`` are refused."""
    states = _states(spark, path.rstrip("/"))
    last = states.agg(F.max("epoch")).first()[0] if states is not None else None
    if last is None:
        return 0, []
    found: dict[int, dict] = {}
    for r in states.where(F.col("epoch") == last).collect():  # of the model's size
        own = found.setdefault(r["member"], {"history": []})
        if r["name"] == "history":
            v = r["vals"]
            own["history"] += [(int(e), r["key"], x) for e, x in zip(v[::2], v[1::2])]
        else:
            own[r["name"]] = np.array(r["vals"])
            if r["name"] == "theta" and settings is not None and r["key"] != settings:
                raise ValueError(f"the state under {path} is that of another fit")
    members = []
    for i in sorted(found):
        own, m = found[i], _Member.__new__(_Member)
        m.theta, m.state, m.best, m.history = own["theta"], own["state"], own["best"], own["history"]
        m.iteration, m.best_value, m.best_epoch, m.pending = own["numbers"].tolist()
        m.iteration, m.best_epoch, m.pending = int(m.iteration), int(m.best_epoch), int(m.pending)
        members.append(m)
    return int(last), members


def best_checkpoint(spark: SparkSession, path: str, spec: MLPSpec, member: int = 0) -> MLPModel:
    """The best parameters so far of a fit that may still run or was lost."""
    epoch, members = load_state(spark, path)
    if not members:
        raise ValueError(f"no state under {path}")
    return MLPModel.from_flat(spec, members[member].best, {"best_epoch": members[member].best_epoch, "epoch": epoch})


def fit(
    train: DataFrame,
    spec: MLPSpec,
    features: Sequence[str] | str,
    label: str | Sequence[str],
    val: DataFrame | None = None,
    epochs: int = 10,
    batch_size: int = 256,
    optimizer: OptimizerSpec = OptimizerSpec(),
    class_weight: Mapping[float, float] | None = None,
    keys: Sequence[str] | None = None,
    seed: int = 0,
    partitions: int | None = None,
    init: MLPModel | None = None,
    strategy: str = "average",
    mode: str = "equal",
    nulls: str = "raise",
    loss: str | None = None,
    metrics: Sequence[str | Metric | Callable] = ("acc",),
    checkpoint: str | None = None,
    resume: bool = True,
) -> FitResult:
    """Train ``spec`` on ``train`` (M5); history (epoch, metric, value) (M8, M9).

    Per epoch: ``loss`` (class-weighted, with L2, averaged over
    batches by rows) and every metric; with ``val``: ``val_loss`` (unweighted,
    with L2) and ``val_<metric>``.  ``best_model`` has the lowest ``val_loss`` (the
    lowest ``loss`` without validation).  ``nulls="raise"`` stops on a
    missing feature or label; ``"drop"`` removes such rows (of ``train`` and
    ``val``) before the batches are cut.

    ``loss``: ``bce``, ``cce``, ``mse`` or ``mae`` (or their long names); by default the
    cross-entropy of the output.  ``metrics``: see ``losses.resolve_metrics``.
    ``label``: see ``label_column``.  ``checkpoint``: a shared folder for the
    state after every epoch; if it holds one of the same fit, training goes on from
    there (``resume=False``: it must hold none).
    """
    if MEMBER in train.columns:
        raise ValueError(f"{MEMBER!r} is a column of the training frame")
    return fit_members(train.withColumn(MEMBER, F.lit(0)), MEMBER, [seed], spec, features, label, val, epochs, batch_size,
                       optimizer, class_weight, keys, seed, partitions, None if init is None else [init], strategy, mode,
                       nulls, loss, metrics, checkpoint, resume)[0]


def fit_members(
    train: DataFrame,
    member: str,
    seeds: Sequence[int],
    spec: MLPSpec,
    features: Sequence[str] | str,
    label: str | Sequence[str],
    val: DataFrame | None = None,
    epochs: int = 10,
    batch_size: int = 256,
    optimizer: OptimizerSpec = OptimizerSpec(),
    class_weight: Mapping[float, float] | None = None,
    keys: Sequence[str] | None = None,
    seed: int = 0,
    partitions: int | None = None,
    inits: Sequence[MLPModel] | None = None,
    strategy: str = "average",
    mode: str = "equal",
    nulls: str = "raise",
    loss: str | None = None,
    metrics: Sequence[str | Metric | Callable] = ("acc",),
    checkpoint: str | None = None,
    resume: bool = True,
) -> list[FitResult]:
    """One model per number in ``member`` (0 to ``len(seeds)`` - 1), all in the same job of every epoch.

    Each result is that of ``fit`` on the member's rows with its seed (``seeds``: initial
    parameters and dropout; ``seed``: the order of rows in batches).  All members are validated on ``val``.
    """
    if strategy not in ("average", "sync"):
        raise ValueError("strategy must be 'average' or 'sync'")
    if nulls not in ("raise", "drop"):
        raise ValueError("nulls must be 'raise' or 'drop'")
    spark = train.sparkSession
    n_parts = int(partitions or int(spark.conf.get("spark.sql.shuffle.partitions")))
    job = _job(spec, loss, metrics, optimizer, seeds)
    keep = list(keys or [])
    frame = training_frame(train, features, label, class_weight, [*keep, member], spec.outputs)
    frame = frame.withColumn(MEMBER, F.col(f"`{member}`").cast("int")) if member != MEMBER else frame
    if nulls == "drop":
        frame = complete_rows(frame)
    if strategy == "average":
        own = frame.select(*[F.col(f"`{k}`") for k in keep], MEMBER, "x", "y", "w")
        batched = assign_batches_counted(own, batch_size, keep or None, seed, mode, partitions=n_parts, within=[MEMBER])[0]
        # How many tasks average their parameters is the caller's choice (or the
        # session's), never a consequence of the row count.
        work = group_batches(batched.select(MEMBER, "batch_id", "batch_pos", "x", "y", "w"), n_parts, [MEMBER])
    else:
        # Gradient sums do not depend on which rows share a task: no shuffle.
        work = frame.select(MEMBER, "x", "y", "w")
    # Read once per epoch: spread over the training partitions and keep.
    work = work.persist(StorageLevel.MEMORY_AND_DISK)
    val_frame = None
    if val is not None:
        val_frame = training_frame(val, features, label, outputs=spec.outputs).select("x", "y")
        if nulls == "drop":
            val_frame = complete_rows(val_frame)
        val_frame = val_frame.persist(StorageLevel.MEMORY_AND_DISK)
    settings = "|".join([spec.to_json(), repr(optimizer), job.loss, strategy, mode, str(batch_size), repr(tuple(seeds)), str(seed),
                         ",".join(m.name for m in job.metrics), str(n_parts) if strategy == "average" else ""])
    done, members = load_state(spark, checkpoint, settings) if checkpoint else (0, [])
    if done and not resume:
        raise ValueError(f"there is the state of a fit under {checkpoint}")
    if done > epochs:
        raise ValueError(f"the state under {checkpoint} is that of epoch {done}, after the last one asked for")
    members = members or [_Member(m) for m in (inits or [init_model(spec, s) for s in seeds])]

    def validation(holder, every_member: bool = True) -> DataFrame:
        return val_frame.mapInArrow(_eval_task(holder, job, "val_", every_member), _OUT_SCHEMA)

    try:
        for epoch in range(done + 1, epochs + 1):
            # One job per epoch: the training pass, plus the validation of the
            # parameters it starts from (the previous epoch's result).
            pending = members[0].pending

            def outputs(holder) -> DataFrame:
                task = _epoch_task(holder, job, epoch) if strategy == "average" else _grad_task(holder, job)
                out = work.mapInArrow(task, _OUT_SCHEMA)
                return out.unionByName(validation(holder)) if pending else out

            sums = _with_broadcast(spark, [(m.theta, m.state, m.iteration) for m in members], outputs, job)
            for i, m in enumerate(members):
                own = job.layout.unpack(sums.get(i))
                if pending:
                    m.record_val(job, pending, own, "val_")
                m.step(job, epoch, own, strategy, val_frame is None)
                m.pending = epoch if val_frame is not None else 0
            if val_frame is not None and epoch == epochs:
                _validate(spark, job, members, validation)
            if checkpoint:
                save_state(spark, checkpoint, epoch, settings, members)
        if members[0].pending and val_frame is not None:  # resumed after the last epoch
            _validate(spark, job, members, validation)
    finally:
        work.unpersist()
        if val_frame is not None:
            val_frame.unpersist()
    return [m.result(spark, job) for m in members]


def _validate(spark: SparkSession, job: _Job, members: Sequence[_Member], validation: Callable) -> None:
    sums = _with_broadcast(spark, [(m.theta,) for m in members], validation, job)
    for i, m in enumerate(members):
        m.record_val(job, m.pending, job.layout.unpack(sums.get(i)), "val_")


def evaluate(
    model: MLPModel,
    frames: Mapping[str, DataFrame],
    features: Sequence[str] | str,
    label: str | Sequence[str],
    loss: str | None = None,
    metrics: Sequence[str | Metric | Callable] = ("acc",),
) -> DataFrame:
    """(dataset, metric, value): loss (with L2), metrics and rows of a model on named frames (M7).

    All frames are scored in one job: their union carries the frame's number as
    the member, and every task adds its rows up per frame.
    """
    names = list(frames)
    if not names:
        raise ValueError("no frames")
    parts = [training_frame(df, features, label, outputs=model.spec.outputs).select(F.lit(i).alias(MEMBER), "x", "y")
             for i, df in enumerate(frames.values())]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    spark, job = union.sparkSession, _job(model.spec, loss, metrics)
    sums = _with_broadcast(spark, [(model.flat(),)] * len(names), lambda h: union.mapInArrow(_eval_task(h, job), _OUT_SCHEMA), job)
    penalty = l2_penalty(model)
    rows = []
    for i, name in enumerate(names):
        own = job.layout.unpack(sums.get(i))
        n = float(own["rows"][0])
        values = job.metric_values(own["metrics"], n) if n else [(m.name, float("nan")) for m in job.metrics]
        rows += [(name, "loss", float(own["loss"][0]) / n + penalty if n else float("nan")),
                 *[(name, m, v) for m, v in values], (name, "rows", n)]
    return spark.createDataFrame(rows, "dataset string, metric string, value double")


def history_frame(result: FitResult) -> DataFrame:
    """The per-epoch history of a fit as a DataFrame (M8)."""
    return result.history


def loss_curve(history: DataFrame) -> DataFrame:
    """(epoch, loss, val_loss) for a loss plot (M9)."""
    return (history.where(F.col("metric").isin("loss", "val_loss"))
            .groupBy("epoch").pivot("metric", ["loss", "val_loss"]).agg(F.first("value")).orderBy("epoch"))
