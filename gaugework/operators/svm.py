"""One-vs-rest support vector machines for all folds and classes at once.

Fitting one machine per fold and class is a separate optimisation each, with its own passes
over the data. Here all of them advance together: one pass of a Newton iteration on the
squared hinge loss (Chapelle, "Training a support vector machine in the primal", 2007) sums,
for every fold and class, the small matrices the next step needs, and passes go on until every
machine has converged. The machines of a fold share the matrix of all its rows, from which each takes the rows outside its margin. Tasks send one row per machine; these are added up by machine in the
executors, where the next step is solved as well. Only weights and losses reach the driver.

Margins become probabilities by a joint logistic fit. Its rows have margins of machines that have not seen them: besides the
machines without a held-out fold, the same passes train those without that fold and one more.

A machine's matrix has the square of its inputs; inputs beyond ``MOST_INPUTS`` are refused, as are features whose squares are not finite.

The Gaussian kernel is approximated by random Fourier features (Rahimi and Recht, 2007).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark import TaskContext, cloudpickle
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, functions as F

from gaugework.operators import logistic

# Tasks get this module's code with the function, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FOURIER_FEATURES = 64
# Doubles that a task sums at a time; machines beyond that take their turn in further passes.
PARTIAL_SIZE = 4_000_000
# Partial sums of one machine are first added in this many groups.
SPREAD = 16
#: 128 MB of sums for one machine in a task.
MOST_INPUTS = 4_000
#: Ridge of the calibration, on the mean loss; separable margins would have no finite fit.
CALIBRATION_RIDGE = 1e-4

#: Folds that a machine is trained without: a held-out one, or two.
Without = tuple[int, ...]


@dataclass(frozen=True)
class Kernel:
    """How the inputs of one fold become machine inputs: standardise, then maybe Fourier."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None = None
    shifts: np.ndarray | None = None

    def inputs(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.scale
        if self.weights is not None:
            z = np.sqrt(2.0 / len(self.shifts)) * np.cos(z @ self.weights.T + self.shifts)
        return np.hstack([z, np.ones((len(z), 1))])


def fold_kernels(
    ready: DataFrame, features: Sequence[str], gaussian: bool, seed: int, fourier: int = FOURIER_FEATURES, pairs: bool = False,
) -> dict[Without, Kernel]:
    """Per held-out fold (with ``pairs`` also per two folds): standardisation from the other folds' rows, in one aggregate.

    The kernel width is 1 / number of features on standardised inputs.
    """
    rows = ready.groupBy("fold_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.avg(c) for c in features]).alias("mean"),
        F.array(*[F.var_pop(c) for c in features]).alias("var"),
    ).collect()  # one row per fold
    n = {r["fold_id"]: r["n"] for r in rows}
    mean = {r["fold_id"]: np.array(r["mean"]) for r in rows}
    var = {r["fold_id"]: np.array(r["var"]) for r in rows}
    if not all(np.isfinite(v).all() for v in [*mean.values(), *var.values()]):
        raise ValueError("SVM: features are too large to be squared")
    d = len(features)
    weights = shifts = None
    if gaussian:
        rng = np.random.default_rng(seed)
        weights = rng.normal(0.0, np.sqrt(2.0 / d), size=(fourier, d))
        shifts = rng.uniform(0.0, 2.0 * np.pi, size=fourier)
    left_out: list[Without] = [(f,) for f in sorted(n)]
    if pairs and len(n) > 2:
        left_out += list(combinations(sorted(n), 2))
    kernels = {}
    for without in left_out:
        train = [f for f in n if f not in without]
        total = sum(n[f] for f in train)
        m = sum(n[f] * mean[f] for f in train) / total
        v = sum(n[f] * (var[f] + (mean[f] - m) ** 2) for f in train) / total
        kernels[without] = Kernel(m, np.where(v > 0, np.sqrt(v), 1.0), weights, shifts)
    return kernels


def fit(
    ready: DataFrame,
    features: Sequence[str],
    classes: int,
    complexity: float,
    kernels: dict[Without, Kernel],
    tolerance: float = 1e-4,
) -> dict[Without, np.ndarray]:
    """Per kernel a (classes, inputs + 1) weight matrix; the last column is the bias.

    Minimises 0.5 |w|^2 + complexity * sum(max(0, 1 - y f(x))^2) for every kernel and class, over the rows of the folds it has
    not left out. Each pass of a machine lowers its objective by more than ``tolerance``, or halves its step, or ends it, so
    all machines converge.
    """
    first = next(iter(kernels.values()))
    width = (len(features) if first.weights is None else len(first.shifts)) + 1
    if width > MOST_INPUTS:
        raise ValueError(f"SVM: {width} inputs, at most {MOST_INPUTS} are supported")
    step = max(1, PARTIAL_SIZE // (width * (width + 2)))
    weights = {f: np.zeros((classes, width)) for f in kernels}
    # machines without two folds start from those without the first of them, which are close
    for left_out in (1, 2):
        machines = [(f, c) for f in sorted(kernels) if len(f) == left_out for c in range(classes)]
        for i in range(0, len(machines), step):
            part = machines[i:i + step]
            start = np.array([weights[f[:1]][c] if f[:1] in weights else np.zeros(width) for f, c in part])
            for (f, c), w in zip(part, _fit_machines(ready, features, part, complexity, kernels, start, tolerance)):
                weights[f][c] = w
    return weights


@dataclass(frozen=True)
class Margins:
    """Inputs of the calibration of the machines without fold ``held``: their margins, for training rows those of
    machines that left out the row's fold as well, if there are such."""

    held: int
    kernels: dict[Without, Kernel]
    weights: dict[Without, np.ndarray]

    def of(self, without: Without, x: np.ndarray) -> np.ndarray:
        return self.kernels[without].inputs(x) @ self.weights[without].T

    def train(self, x: np.ndarray, fold: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), len(self.weights[(self.held,)])))
        for f in np.unique(fold):
            pair = tuple(sorted((self.held, int(f))))
            out[fold == f] = self.of(pair if pair in self.kernels else (self.held,), x[fold == f])
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.of((self.held,), x)

    def design(self) -> logistic.Design:
        classes = len(self.weights[(self.held,)])
        return logistic.Design(self.held, self.train, self.score, np.full(classes, CALIBRATION_RIDGE))


def _fit_machines(ready, features, machines, complexity, kernels, start, tolerance):
    n, width = start.shape
    best, best_loss = start.copy(), np.full(n, np.inf)
    trial, done = best.copy(), np.zeros(n, bool)
    while not done.all():
        todo = np.flatnonzero(~done)
        losses, steps = _pass(ready, features, [machines[i] for i in todo], complexity, kernels, trial[todo], width)
        for at, i in enumerate(todo):
            objective = 0.5 * (trial[i, :-1] ** 2).sum() + complexity * losses[at]
            if objective < best_loss[i]:
                # one that barely helped ends the machine
                done[i] = best_loss[i] - objective < tolerance * abs(objective)
                best[i], best_loss[i], trial[i] = trial[i], objective, steps[at]
            else:
                # a step that made things worse is halved
                done[i] = np.abs(trial[i] - best[i]).max() < 1e-9
                trial[i] = (trial[i] + best[i]) / 2
    return best


def _pass(ready, features, machines, complexity, kernels, weights, width):
    """Per machine the summed squared hinge and the next Newton step, from one pass over the rows."""
    names, square = list(features), width * width
    left_out = sorted({f for f, _ in machines})

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((len(machines), square + width + 1))
        for batch in batches:
            x = batch[names].to_numpy(float)
            target, fold = batch["target"].to_numpy(int), batch["fold_id"].to_numpy(int)
            for without in left_out:
                train = ~np.isin(fold, without)
                z, own = kernels[without].inputs(x[train]), target[train]
                of_fold = [(at, c) for at, (f, c) in enumerate(machines) if f == without]
                margins = z @ weights[[at for at, _ in of_fold]].T
                whole = None
                for (at, c), margin in zip(of_fold, margins.T):
                    y = np.where(own == c, 1.0, -1.0)
                    slack = np.maximum(0.0, 1.0 - y * margin)
                    inside = slack > 0
                    if 2 * np.count_nonzero(inside) < len(z):
                        zi = z[inside]
                        sums[at, :square] += (zi.T @ zi).ravel()
                    else:  # all rows, whose sum the machines of a fold share, but those outside
                        whole = z.T @ z if whole is None else whole
                        zo = z[~inside]
                        sums[at, :square] += (whole - zo.T @ zo).ravel()
                    sums[at, square:-1] += np.where(inside, y, 0.0) @ z
                    sums[at, -1] += (slack ** 2).sum()
        salt = TaskContext.get().partitionId() % SPREAD
        yield pd.DataFrame({"machine": range(len(machines)), "salt": salt, "part": [r.tobytes() for r in sums]})

    def total(parts) -> np.ndarray:
        out = np.zeros(square + width + 1)
        for p in parts:
            out += np.frombuffer(p)
        return out

    def add(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"machine": [group["machine"].iloc[0]], "part": [total(group["part"]).tobytes()]})

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        sums = total(group["part"])
        ridge = np.diag([1.0] * (width - 1) + [1e-8])
        step = np.linalg.solve(ridge + 2 * complexity * sums[:square].reshape(width, width), 2 * complexity * sums[square:-1])
        return pd.DataFrame({"machine": [group["machine"].iloc[0]], "loss": [sums[-1]], "step": [step.tobytes()]})

    parts = ready.select("fold_id", "target", *names).mapInPandas(partial, "machine int, salt int, part binary")
    added = parts.groupBy("machine", "salt").applyInPandas(add, "machine int, part binary")
    rows = added.groupBy("machine").applyInPandas(solve, "machine int, loss double, step binary").collect()
    losses, steps = np.zeros(len(machines)), np.zeros((len(machines), width))
    for r in rows:
        losses[r["machine"]], steps[r["machine"]] = r["loss"], np.frombuffer(r["step"])
    if not (np.isfinite(losses).all() and np.isfinite(steps).all()):
        raise ValueError("SVM: sums are not finite; features are too large to be squared")
    return losses, steps


def margin_stages(features: Sequence[str], kernel: Kernel, weights: np.ndarray) -> list:
    """Transformers that add the class margins as array column ``machine_margins``.

    They are SQL over arrays: they score in the JVM and can be saved.
    """
    scaled = [
        f"(`{c}` - {logistic.number(m)}) / {logistic.number(s)}"
        for c, m, s in zip(features, kernel.mean, kernel.scale)
    ]
    steps = [f"array({', '.join(scaled)}, 1D) AS machine_x"]
    if kernel.weights is not None:
        height = logistic.number(np.sqrt(2.0 / len(kernel.shifts)))
        waves = _products(np.column_stack([kernel.weights, kernel.shifts]), "machine_x")
        steps.append(f"concat(transform({waves}, v -> {height} * cos(v)), array(1D)) AS machine_z")
    source = "machine_z" if kernel.weights is not None else "machine_x"
    steps.append(f"{_products(weights, source)} AS machine_margins")
    return [SQLTransformer(statement=f"SELECT *, {step} FROM __THIS__") for step in steps]


def _products(matrix: np.ndarray, column: str) -> str:
    """SQL for the matrix times an array column, as an array."""
    rows = ", ".join(f"array({', '.join(logistic.number(v) for v in row)})" for row in matrix)
    dot = f"aggregate(zip_with(row, {column}, (a, b) -> a * b), 0D, (t, v) -> t + v)"
    return f"transform(array({rows}), row -> {dot})"
