"""Hyper-parameter catalog: parameter sets, their settings, and model specifications."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from gaugework.operators.reshape import parameters_text

# Fixed values: (algorithm, version tag, ((setting name, setting value), ...)).
CATALOG = (
    ("DECISION_TREE", "v1", (
        ("ALGO_NAME", "ALGO_DECISION_TREE"),
        ("TREE_TERM_MAX_DEPTH", "6"),
        ("TREE_IMPURITY_METRIC", "TREE_IMPURITY_GINI"),
    )),
    ("DECISION_TREE", "v2", (
        ("ALGO_NAME", "ALGO_DECISION_TREE"),
        ("TREE_TERM_MAX_DEPTH", "12"),
        ("TREE_IMPURITY_METRIC", "TREE_IMPURITY_ENTROPY"),
    )),
    ("RANDOM_FOREST", "v1", (
        ("ALGO_NAME", "ALGO_RANDOM_FOREST"),
        ("RF_NUM_TREES", "20"),
        ("RF_MAX_DEPTH", "8"),
    )),
    ("RANDOM_FOREST", "v2", (
        ("ALGO_NAME", "ALGO_RANDOM_FOREST"),
        ("RF_NUM_TREES", "40"),
        ("RF_MAX_DEPTH", "12"),
    )),
    ("SVM", "v1", (
        ("ALGO_NAME", "ALGO_SUPPORT_VECTOR_MACHINES"),
        ("SVMS_COMPLEXITY_FACTOR", "0.5"),
        ("SVMS_KERNEL_FUNCTION", "SVMS_LINEAR"),
    )),
    ("SVM", "v2", (
        ("ALGO_NAME", "ALGO_SUPPORT_VECTOR_MACHINES"),
        ("SVMS_COMPLEXITY_FACTOR", "1.0"),
        ("SVMS_KERNEL_FUNCTION", "SVMS_GAUSSIAN"),
    )),
)

# The single-algorithm runs.
LOGISTIC_50 = ("LOGISTIC_REGRESSION", "v1", (("MAX_ITERATIONS", "50"), ("L2_REG", "0.1")))
LOGISTIC_100 = ("LOGISTIC_REGRESSION", "v2", (("MAX_ITERATIONS", "100"), ("L2_REG", "0.1")))
LOGISTIC_200 = ("LOGISTIC_REGRESSION", "v3", (("MAX_ITERATIONS", "200"), ("SOLVER", "lbfgs")))
FOREST_200 = ("RANDOM_FOREST", "v3", (
    ("RF_NUM_TREES", "200"), ("RF_MAX_DEPTH", "5"), ("RF_SAMPLING_RATIO", "1.0"),
))

#: Every set has one id, whatever part of the catalog a caller passes on.
_IDS = {(a, v): i for i, (a, v, _) in enumerate([*CATALOG, LOGISTIC_50, LOGISTIC_100, LOGISTIC_200, FOREST_200], start=1)}

# What each setting name means here, and the type or the allowed values. All but
# FOURIER_FEATURES, the size of the kernel's approximation, occur in the catalog.
_SETTINGS = {
    "ALGO_NAME": ("algo_name", {
        "ALGO_DECISION_TREE": "DECISION_TREE",
        "ALGO_RANDOM_FOREST": "RANDOM_FOREST",
        "ALGO_SUPPORT_VECTOR_MACHINES": "SVM",
    }),
    "TREE_TERM_MAX_DEPTH": ("max_depth", int),
    "TREE_IMPURITY_METRIC": ("impurity", {
        "TREE_IMPURITY_GINI": "gini", "TREE_IMPURITY_ENTROPY": "entropy",
    }),
    "RF_NUM_TREES": ("num_trees", int),
    "RF_MAX_DEPTH": ("max_depth", int),
    "RF_SAMPLING_RATIO": ("subsampling_rate", float),
    "SVMS_COMPLEXITY_FACTOR": ("complexity", float),
    "SVMS_KERNEL_FUNCTION": ("kernel", {"SVMS_LINEAR": "linear", "SVMS_GAUSSIAN": "gaussian"}),
    "FOURIER_FEATURES": ("fourier_features", int),
    "MAX_ITERATIONS": ("max_iter", int),
    "L2_REG": ("l2_reg", float),
    "SOLVER": ("solver", {"lbfgs": "lbfgs"}),
}


def typed_settings(settings: Mapping[str, str]) -> dict:
    """Parse text settings to typed values; unknown names and values are errors."""
    typed = {}
    for name, text in settings.items():
        if name not in _SETTINGS:
            raise ValueError(f"unknown setting {name}")
        out, kind = _SETTINGS[name]
        if isinstance(kind, dict):
            if text not in kind:
                raise ValueError(f"unknown value {text} for {name}")
            typed[out] = kind[text]
        else:
            typed[out] = kind(text)
    return typed


@dataclass(frozen=True)
class ParameterSet:
    parameter_set_id: int
    algorithm: str
    version_tag: str
    settings: Mapping[str, str] = field(hash=False)

    def typed(self) -> dict:
        return typed_settings(self.settings)

    def text(self) -> str:
        return "; ".join(f"{n}={v}" for n, v in sorted(self.settings.items()))


def parameter_sets(catalog: Sequence = CATALOG) -> list[ParameterSet]:
    """The sets of ``catalog`` with their fixed ids; sets of the caller's own follow after those."""
    own = [(a, v) for a, v, _ in catalog if (a, v) not in _IDS]
    ids = _IDS | {name: len(_IDS) + i for i, name in enumerate(own, start=1)}
    return [ParameterSet(ids[a, v], a, v, dict(s)) for a, v, s in catalog]


def sets_frame(spark: SparkSession, catalog: Sequence = CATALOG) -> DataFrame:
    """(parameter_set_id, algorithm, version_tag)."""
    return spark.createDataFrame(
        [(p.parameter_set_id, p.algorithm, p.version_tag) for p in parameter_sets(catalog)],
        "parameter_set_id bigint, algorithm string, version_tag string",
    )


def settings_frame(spark: SparkSession, catalog: Sequence = CATALOG) -> DataFrame:
    """(algorithm, version_tag, parameter_name, parameter_value): the catalog's settings."""
    return spark.createDataFrame(
        [(a, v, n, t) for a, v, s in catalog for n, t in s],
        "algorithm string, version_tag string, parameter_name string, parameter_value string",
    )


def parameter_grid(sets: DataFrame, catalog: Sequence = CATALOG) -> DataFrame:
    """(parameter_set_id, parameter_name, parameter_value): each set with its settings.

    ``sets`` may be any size. The catalog is a constant of a few lines and is broadcast; the
    pairing is an equi-join on (algorithm, version), not a product with a filter.
    """
    settings = F.broadcast(settings_frame(sets.sparkSession, catalog))
    return sets.join(settings, ["algorithm", "version_tag"]).select(
        "parameter_set_id", "parameter_name", "parameter_value"
    )


def model_specs(
    folds_present: DataFrame, prefix: str = "MODEL", catalog: Sequence = CATALOG
) -> DataFrame:
    """Every fold with every parameter set, numbered by (fold, algorithm, version).

    (spec_no, model_name, fold_id, parameter_set_id, algorithm, version_tag, hyperparameters).
    """
    ordered = sorted(parameter_sets(catalog), key=lambda p: (p.algorithm, p.version_tag))
    lines = F.array(*[
        F.struct(
            F.lit(i).cast("bigint").alias("place"),
            F.lit(p.parameter_set_id).cast("bigint").alias("parameter_set_id"),
            F.lit(p.algorithm).alias("algorithm"),
            F.lit(p.version_tag).alias("version_tag"),
            F.lit(p.text()).alias("hyperparameters"),
        )
        for i, p in enumerate(ordered, start=1)
    ])
    # one row per fold and set, so numbering them in one task is small
    number = F.row_number().over(Window.orderBy("fold_id", "place")).cast("bigint")
    return folds_present.select("fold_id", F.inline(lines)).select(
        number.alias("spec_no"), model_name(prefix).alias("model_name"),
        "fold_id", "parameter_set_id", "algorithm", "version_tag", "hyperparameters",
    )


def model_name(prefix: str):
    """``PREFIX_ALGORITHM_F<fold>_<version>`` from the columns of a model row."""
    return F.concat(
        F.lit(f"{prefix}_"), F.col("algorithm"), F.lit("_F"), F.col("fold_id").cast("string"),
        F.lit("_"), F.col("version_tag"),
    )


def grid_text(grid: DataFrame) -> DataFrame:
    """(parameter_set_id, hyperparameters) as ``name=value; ...`` text."""
    return parameters_text(grid, ["parameter_set_id"])
