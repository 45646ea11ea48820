"""The full training workflow and what it leaves behind.

load -> prepare -> split -> statistics of the training split -> standardize
-> fit on the executors -> evaluate the best parameters.  Every step is a
DataFrame operator; only statistics (one row per column), parameter vectors
(model size) and per-epoch metrics reach the driver.

A trained workflow is stored as one folder of tables (``save_workflow``): the
parameters, the statistics, the steps that turn a raw row into features, the history
and the scores.  Loaded again it scores raw rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.batches import assign_batches
from ..operators.columns import feature_columns
from ..operators.encode import DEFAULT_STRING_MAP, prepare
from ..operators.losses import Metric
from ..operators.metrics import DEFAULT_METRICS, score
from ..operators.mlp import MLPModel, MLPSpec, OptimizerSpec, init_model
from ..operators.profile import drop_nulls
from ..operators.sampling import hash_side, stratified_sample
from ..operators.scale import ColumnStats, collect_stats, scaling_stats, standardize, unscale
from ..operators.scoring import ensemble_predict, predict
from ..operators.train import FitResult, evaluate, fit, fit_members
from ..sources.runs import load_history, load_model, save_history, save_model

FORMAT = 1  # version of the stored tables


@dataclass
class ScoringPipeline:
    """From raw rows to scores: drop, encode, scale by the training statistics, predict."""

    label: str
    features: list[str]
    drop: list[str]
    mapping: dict[str, float]
    stats: dict[str, ColumnStats]
    model: MLPModel

    def features_of(self, df: DataFrame) -> DataFrame:
        """``df`` prepared and scaled; a missing feature column is an error."""
        prepared = prepare(df, [c for c in self.drop if c in df.columns], self.mapping)
        missing = [c for c in self.features if c not in prepared.columns]
        if missing:
            raise ValueError(f"no columns {missing}")
        return standardize(prepared, self.stats, self.features)

    def score(self, df: DataFrame, keep: Sequence[str] = (), output_col: str = "prediction", method: str = "auto") -> DataFrame:
        """``keep`` (columns of ``df`` after preparation) and the prediction of every row."""
        out = predict(self.features_of(df), self.model, self.features, output_col, method)
        return out.select(*[F.col(f"`{c}`") for c in keep], output_col)


@dataclass
class TrainedWorkflow:
    features: list[str]
    label: str
    stats: dict
    fit: FitResult
    scores: DataFrame
    drop: Sequence[str] = ()
    mapping: Mapping[str, float] | None = None

    def pipeline(self) -> ScoringPipeline:
        """The best model with the steps before it."""
        return ScoringPipeline(self.label, list(self.features), list(self.drop), dict(self.mapping or DEFAULT_STRING_MAP),
                               dict(self.stats), self.fit.best_model)


# The defaults of the arguments below are those of the reference's workflow.
def train_workflow(
    df: DataFrame,
    label: str,
    drop: Sequence[str] = (),
    mapping: Mapping[str, float] = DEFAULT_STRING_MAP,
    keys: Sequence[str] | None = None,
    val_ratio: float = 0.2,
    seed: int = 3,
    batch_size: int = 256,
    hidden: Sequence[tuple[int, float]] = ((64, 0.0), (64, 0.0), (64, 0.0)),
    l2: float = 0.07,
    epochs: int = 50,
    optimizer: OptimizerSpec = OptimizerSpec("rmsprop", lr=0.001),
    class_weight: Mapping[float, float] | None = None,
    output: str = "sigmoid",
    partitions: int | None = None,
    nulls: str = "raise",
    strategy: str = "average",
    init: MLPModel | None = None,
    loss: str | None = None,
    metrics: Sequence[str | Metric | Callable] = ("acc",),
    checkpoint: str | None = None,
) -> TrainedWorkflow:
    """Train a dense network on a table.

    ``class_weight`` e.g. {0.0: 1.0, 1.0: 6.0}.  ``keys`` make the split and
    the batches independent of partitioning.  ``nulls="drop"`` removes rows
    with a missing feature or label before the statistics and the fit.
    ``strategy``, ``init``, ``loss``, ``metrics`` and ``checkpoint`` as in ``fit``.

    The source is read once: the prepared rows (features, label and keys only) are
    kept with their side of the split while statistics, fit and evaluation use them.
    """
    prepared = prepare(df, drop, mapping)
    features = feature_columns(prepared, label, exclude=keys or ())
    if nulls == "drop":
        prepared = drop_nulls(prepared, [*features, label])
    columns = [F.col(f"`{c}`") for c in dict.fromkeys([*(keys or ()), *features, label])]
    if keys:
        sided = hash_side(prepared, keys, (1.0 - val_ratio, val_ratio), seed, "__side")
    else:  # layout-dependent, as the reference's randomSplit
        sided = prepared.withColumn("__side", (F.rand(seed) < val_ratio).cast("int"))
    kept = sided.select(*columns, "__side").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        train, val = (kept.where(F.col("__side") == k).drop("__side") for k in (0, 1))
        stats = collect_stats(scaling_stats(train, features))
        train_z, val_z = standardize(train, stats, features), standardize(val, stats, features)
        spec = init.spec if init is not None else MLPSpec(len(features), tuple(hidden), 1, l2, output)
        result = fit(train_z, spec, features, label, val_z, epochs, batch_size, optimizer, class_weight, keys=keys,
                     seed=seed, partitions=partitions, init=init, strategy=strategy, nulls=nulls, loss=loss,
                     metrics=metrics, checkpoint=checkpoint)
        scores = evaluate(result.best_model, {"train": train_z, "validation": val_z}, features, label, loss, metrics)
    finally:
        kept.unpersist()
    return TrainedWorkflow(features, label, stats, result, scores, list(drop), dict(mapping))


def save_workflow(spark: SparkSession, workflow: TrainedWorkflow, path: str, mode: str = "errorifexists") -> str:
    """One folder: ``model``, ``last_model``, ``stats``, ``steps``, ``history`` and ``scores`` tables.

    ``steps`` is written last: a folder without it is not whole.
    """
    pipe = workflow.pipeline()
    save_model(spark, pipe.model, f"{path}/model", mode)
    save_model(spark, workflow.fit.model, f"{path}/last_model", mode)
    stats = [(c, s.count, s.mean, s.stddev, s.min, s.max) for c, s in pipe.stats.items()]
    schema = "column_name string, count double, mean double, stddev double, min double, max double"
    stats = [(name, *[None if v is None else float(v) for v in numbers]) for name, *numbers in stats]
    spark.createDataFrame(stats, schema).coalesce(1).write.mode(mode).parquet(f"{path}/stats")
    save_history(workflow.fit.history, f"{path}/history", mode)
    workflow.scores.coalesce(1).write.mode(mode).parquet(f"{path}/scores")
    steps = [("format", str(FORMAT)), ("label", pipe.label), ("features", json.dumps(pipe.features)),
             ("drop", json.dumps(pipe.drop)), ("mapping", json.dumps(pipe.mapping)), ("best_epoch", str(workflow.fit.best_epoch))]
    spark.createDataFrame(steps, "name string, value string").coalesce(1).write.mode(mode).parquet(f"{path}/steps")
    return path


def load_workflow(spark: SparkSession, path: str) -> ScoringPipeline:
    """The scoring pipeline of a stored workflow (S6); its history and scores are ``history`` and ``scores`` beside it."""
    steps = {r["name"]: r["value"] for r in spark.read.parquet(f"{path}/steps").collect()}
    if steps.get("format") != str(FORMAT):
        raise ValueError(f"{path} has format {steps.get('format')}, not {FORMAT}")
    return ScoringPipeline(steps["label"], json.loads(steps["features"]), json.loads(steps["drop"]), json.loads(steps["mapping"]),
                           collect_stats(spark.read.parquet(f"{path}/stats")), load_model(spark, f"{path}/model"))


def load_workflow_history(spark: SparkSession, path: str) -> DataFrame:
    return load_history(spark, f"{path}/history")


def score_model(
    df: DataFrame,
    model: MLPModel,
    features: Sequence[str],
    label: str,
    stats: dict | None = None,
    batch_size: int = 32,
    keys: Sequence[str] | None = None,
    seed: int = 0,
    average: str = "batch",
    metrics: Sequence[str | Metric | Callable] = DEFAULT_METRICS,
    classes: Sequence[float] = (0.0, 1.0),
    label_stats: ColumnStats | None = None,
    units: str = "scaled",
    n_batches: int | None = None,
) -> DataFrame:
    """Scale, score and measure a table in one plan (R1): (metric, class, value).

    ``average="batch"`` is the reference's mean of per-batch metrics over
    ``n // batch_size`` batches (or ``n_batches``); ``"pooled"`` scores all rows at once.
    Both give the same metrics; see ``metrics.score`` for ``metrics``.

    ``label_stats``: the model was trained on the label scaled by these statistics (E7).
    ``units="scaled"`` compares its scores with the scaled label, as the
    reference does; ``"original"`` scales the scores back instead.
    """
    if units not in ("scaled", "original"):
        raise ValueError("units must be 'scaled' or 'original'")
    scaled = standardize(df, stats, features) if stats is not None else df
    scored = ensemble_predict(scaled, [model], list(features), "__score")
    if label_stats is not None and units == "scaled":
        scored = standardize(scored, {label: label_stats}, [label])
    elif label_stats is not None:
        scored = scored.withColumn("__score", unscale(F.col("__score"), label_stats))
    if average == "batch":
        scored = assign_batches(scored, batch_size, keys, seed, n_batches=n_batches)
    return score(scored, label, "__score", average=average, classes=classes, metrics=metrics)


def train_members(
    df: DataFrame,
    label: str,
    features: Sequence[str] | str,
    keys: Sequence[str],
    spec: MLPSpec,
    members: int = 3,
    epochs: int = 10,
    batch_size: int = 256,
    optimizer: OptimizerSpec = OptimizerSpec(),
    seed: int = 0,
    val: DataFrame | None = None,
    n_per_class: int | None = None,
    inits: Sequence[MLPModel] | None = None,
    **options,
) -> list[FitResult]:
    """One model per balanced stratified sample (T1 + T2), all trained in the same job of every epoch.

    Member k has the sample, the initial parameters and the dropout of seed + k; ``options`` go to ``fit_members``.
    """
    seeds = [seed + k for k in range(members)]
    samples = [stratified_sample(df, label, keys, n_per_class, seed=s).withColumn("__member", F.lit(k))
               for k, s in enumerate(seeds)]
    rows = samples[0]
    for sample in samples[1:]:
        rows = rows.unionByName(sample)
    inits = inits or [init_model(spec, s) for s in seeds]
    return fit_members(rows, "__member", seeds, spec, features, label, val, epochs, batch_size, optimizer, keys=keys,
                       seed=seed, inits=inits, **options)


def train_ensemble(df: DataFrame, label: str, features: Sequence[str] | str, keys: Sequence[str], spec: MLPSpec,
                   members: int = 3, **options) -> list[MLPModel]:
    """The best model of each member of ``train_members``, for ``ensemble_predict``."""
    return [r.best_model for r in train_members(df, label, features, keys, spec, members, **options)]


__all__ = ["ScoringPipeline", "TrainedWorkflow", "train_workflow", "save_workflow", "load_workflow", "load_workflow_history",
           "train_ensemble", "train_members", "score_model", "ensemble_predict"]
