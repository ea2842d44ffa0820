"""Multinomial logistic models of all folds and penalties, fitted together.

Every pass over the rows sums, for each model, the loss, gradient and Hessian at its trial weights. Tasks send a row per model,
these are added by model in the executors, and the next Newton step is solved there too, so only weights and losses reach
the driver and the number of passes is that of the slowest model, not the sum over all.

What a model sees of a row is a ``Design``: standardised features for logistic regression, or the margins of support vector
machines that were trained without the row's fold, for their calibration. The Hessian of c classes and w inputs
has (c w)**2 numbers; ``fits`` says whether that is small enough for this method.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext, cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame, functions as F

# Tasks get this module's code with the function, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Doubles of one model's sums at most, and of all that a task adds up in one pass.
MODEL_SIZE, PASS_SIZE = 1_000_000, 4_000_000
SPREAD = 16
MOST_PASSES = 60


@dataclass(frozen=True)
class Design:
    """One model: the fold it is not fitted on, its inputs, and the ridge on each input's weights, on the mean loss.

    ``train`` and ``score`` turn (features, folds) into inputs without the constant; ``train`` is for rows of other folds.
    """

    held: int
    train: Callable[[np.ndarray, np.ndarray], np.ndarray]
    score: Callable[[np.ndarray], np.ndarray]
    ridge: np.ndarray


@dataclass(frozen=True)
class Standardised:
    """Inputs of logistic regression."""

    mean: np.ndarray
    scale: np.ndarray

    def __call__(self, x: np.ndarray, fold: np.ndarray | None = None) -> np.ndarray:
        return (x - self.mean) / self.scale


def fits(classes: int, inputs: int) -> bool:
    return (classes * (inputs + 1)) ** 2 <= MODEL_SIZE


def moments(ready: DataFrame, features: Sequence[str]) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Per held-out fold: rows, means and variances (divisor n) of the other folds."""
    rows = ready.groupBy("fold_id").agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.avg(c) for c in features]).alias("mean"),
        F.array(*[F.var_pop(c) for c in features]).alias("var")).collect()  # one row per fold
    out = {}
    for held in (r["fold_id"] for r in rows):
        others = [r for r in rows if r["fold_id"] != held]
        n = sum(r["n"] for r in others)
        mean = sum(r["n"] * np.array(r["mean"]) for r in others) / max(n, 1)
        var = sum(r["n"] * (np.array(r["var"]) + (np.array(r["mean"]) - mean) ** 2) for r in others) / max(n, 1)
        out[held] = (n, mean, var)
    return out


def regression(held: int, rows: int, mean: np.ndarray, var: np.ndarray, penalty: float, standardised: bool) -> Design:
    """Logistic regression with a ridge of ``penalty`` on the weights of standardised (sample deviation) or raw features."""
    scale = np.sqrt(var * rows / max(rows - 1, 1))
    scale = np.where(scale > 0, scale, 1.0)
    inputs = Standardised(mean, scale)
    return Design(held, inputs, inputs, np.full(len(mean), penalty) if standardised else penalty / scale**2)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _with_constant(z: np.ndarray) -> np.ndarray:
    return np.hstack([z, np.ones((len(z), 1))])


def fit(ready: DataFrame, features: Sequence[str], classes: int, designs: Sequence[Design], tolerance: float = 1e-9) -> list[np.ndarray]:
    """Per design a (classes, inputs + 1) weight matrix; the last column is the constant, with mean 0 over the classes."""
    sizes = [(classes * (len(d.ridge) + 1)) ** 2 for d in designs]
    out: list[np.ndarray] = []
    at = 0
    while at < len(designs):
        stop, total = at, 0
        while stop < len(designs) and (stop == at or total + sizes[stop] <= PASS_SIZE):
            total += sizes[stop]
            stop += 1
        out += _fit_together(ready, features, classes, designs[at:stop], tolerance)
        at = stop
    return out


def _fit_together(ready, features, classes, designs, tolerance):
    best = [np.zeros((classes, len(d.ridge) + 1)) for d in designs]
    loss = np.full(len(designs), np.inf)
    trial, done = [w.copy() for w in best], np.zeros(len(designs), bool)
    for _ in range(MOST_PASSES):
        todo = np.flatnonzero(~done)
        if not len(todo):
            break
        found = _pass(ready, features, classes, [designs[i] for i in todo], [trial[i] for i in todo])
        for at, i in enumerate(todo):
            objective, following = found[at]
            if objective < loss[i]:
                done[i] = loss[i] - objective < tolerance * max(abs(objective), 1e-12)
                best[i], loss[i], trial[i] = trial[i], objective, following
            else:  # a step that made things worse is halved
                done[i] = objective - loss[i] < tolerance * max(abs(objective), 1e-12) or np.abs(trial[i] - best[i]).max() < 1e-10
                trial[i] = (trial[i] + best[i]) / 2
    for w in best:
        w[:, -1] -= w[:, -1].mean()
    return best


def _pass(ready, features, classes, designs, weights):
    """Per model the objective at its weights and the weights after the next Newton step."""
    names = list(features)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        widths = [len(d.ridge) + 1 for d in designs]
        sums = [np.zeros((classes * w) ** 2 + classes * w + 2) for w in widths]
        for batch in batches:
            x, target, fold = batch[names].to_numpy(float), batch["target"].to_numpy(int), batch["fold_id"].to_numpy(int)
            for held in {d.held for d in designs}:
                train = fold != held
                own, y = fold[train], target[train]
                for d, w, width, total in zip(designs, weights, widths, sums):
                    if d.held != held or not len(y):
                        continue
                    z = _with_constant(d.train(x[train], own))
                    p = _softmax(z @ w.T)
                    total[-2] -= np.log(np.maximum(p[np.arange(len(y)), y], 1e-300)).sum()
                    total[-1] += len(y)
                    gap = p.copy()
                    gap[np.arange(len(y)), y] -= 1
                    n = classes * width
                    total[n * n:-2] += (gap.T @ z).ravel()
                    hessian = total[:n * n].reshape(classes, width, classes, width)
                    for a in range(classes):
                        for b in range(classes):
                            hessian[a, :, b] += (z * (p[:, a] * ((a == b) - p[:, b]))[:, None]).T @ z
        salt = TaskContext.get().partitionId() % SPREAD
        yield pd.DataFrame({"model": range(len(designs)), "salt": salt, "part": [s.tobytes() for s in sums]})

    def total(parts) -> np.ndarray:
        return np.sum([np.frombuffer(p) for p in parts], axis=0)

    def add(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"model": [group["model"].iloc[0]], "part": [total(group["part"]).tobytes()]})

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        i = int(group["model"].iloc[0])
        d, w, sums = designs[i], weights[i], total(group["part"])
        n, rows = w.size, max(sums[-1], 1.0)
        ridge = np.tile(np.append(d.ridge, 0.0), classes)
        gradient = sums[n * n:-2] / rows + ridge * w.ravel()
        # constants may move together without a change; a speck of ridge picks one step
        hessian = sums[:n * n].reshape(n, n) / rows + np.diag(np.maximum(ridge, 1e-10))
        step = np.linalg.solve(hessian, gradient)
        objective = sums[-2] / rows + 0.5 * float((ridge * w.ravel() ** 2).sum())
        return pd.DataFrame({"model": [i], "objective": [objective], "following": [(w.ravel() - step).tobytes()]})

    parts = ready.select("fold_id", "target", *names).mapInPandas(partial, "model int, salt int, part binary")
    added = parts.groupBy("model", "salt").applyInPandas(add, "model int, part binary")
    rows = added.groupBy("model").applyInPandas(solve, "model int, objective double, following binary").collect()
    found = {r["model"]: (r["objective"], np.frombuffer(r["following"]).reshape(weights[r["model"]].shape).copy()) for r in rows}
    if not all(np.isfinite(o) and np.isfinite(f).all() for o, f in found.values()):
        raise ValueError("logistic fit: sums are not finite; features are too large to be squared")
    # without a row nothing is learned: all classes are equally probable
    return [found.get(i, (0.0, weights[i])) for i in range(len(designs))]


def score(ready: DataFrame, features: Sequence[str], designs: Sequence[Design], weights: Sequence[np.ndarray], classes: int) -> DataFrame:
    """(row, forest, probs) for every row of ``ready`` (row, fold_id, features) and model that holds its fold out, in one pass."""
    # pickled here, so that workers need no copy of the package
    shared = ready.sparkSession.sparkContext.broadcast(cloudpickle.dumps((list(designs), list(weights))))
    names = list(features)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        designs, weights = pickle.loads(shared.value)
        for batch in batches:
            x, fold, row = batch[names].to_numpy(float), batch["fold_id"].to_numpy(int), batch["row"].to_numpy()
            for i, (d, w) in enumerate(zip(designs, weights)):
                own = fold == d.held
                if own.any():
                    p = _softmax(_with_constant(d.score(x[own])) @ w.T)
                    yield pd.DataFrame({"row": row[own], "forest": i, "probs": list(p)})

    return ready.select("row", "fold_id", *names).mapInPandas(run, "row long, forest long, probs array<double>")


def pipeline(inputs: Sequence, source: str, weights: np.ndarray) -> PipelineModel:
    """Transformers that add ``probability`` and ``prediction``, after ``inputs`` that add the array column ``source``.

    They are SQL over arrays: they can be saved, and score in the JVM.
    """
    rows = ", ".join(f"array({', '.join(number(v) for v in row)})" for row in weights)
    dot = f"aggregate(zip_with(row, concat({source}, array(1D)), (a, b) -> a * b), 0D, (t, v) -> t + v)"
    names = [f"class_{j}" for j in range(len(weights))]
    steps = [
        f"transform(array({rows}), row -> {dot}) AS class_scores",
        "transform(class_scores, v -> exp(v - array_max(class_scores))) AS class_weights",
        ", ".join(f"class_weights[{j}] / aggregate(class_weights, 0D, (t, v) -> t + v) AS {n}" for j, n in enumerate(names)),
        f"CAST(array_position(array({', '.join(names)}), greatest({', '.join([*names, '0D'])})) - 1 AS DOUBLE) AS prediction",
    ]
    return PipelineModel([
        *inputs, *[SQLTransformer(statement=f"SELECT *, {s} FROM __THIS__") for s in steps],
        VectorAssembler(inputCols=names, outputCol="probability"),
    ])


def standardising(features: Sequence[str], inputs: Standardised) -> SQLTransformer:
    scaled = ", ".join(f"(`{c}` - {number(m)}) / {number(s)}" for c, m, s in zip(features, inputs.mean, inputs.scale))
    return SQLTransformer(statement=f"SELECT *, array({scaled}) AS regression_x FROM __THIS__")


def number(value: float) -> str:
    return f"{float(value)!r}D"
