"""Regression and classification models on MLlib.

Fitting is an action; data stay distributed and only the fitted coefficients,
one per feature, reach the driver.
"""

from __future__ import annotations

import datetime as dt
import math
from dataclasses import dataclass, field
from itertools import accumulate
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.stats import filter_range
from tidemark.session import settle

MODELS = ("linear", "logistic", "probit", "lasso", "rf_classification", "rf_regression")
SEED = 42
#: Forests on so many rows, but at most so many points, grow on points with weights.
FOLD_ROWS, FOLD_POINTS = 1_000_000, 100_000
GROW_AT_ONCE = 8


@dataclass(frozen=True)
class ModelSpec:
    """What to fit: ``x`` lists (column, "categorical" | "continuous").

    ``resample`` (each tree on rows drawn again), ``max_depth`` (30 is the library's limit) and ``max_bins`` (split points of
    a number) hold for forests, ``max_iter`` for the iterative models, whose
    summaries say how many steps they took and whether they converged.
    """

    model: str
    y: str
    x: tuple[tuple[str, str], ...]
    alpha: float | None = None
    n_estimators: int = 100
    resample: bool = True
    max_depth: int = 30
    max_bins: int = 256
    max_iter: int = 1000
    date_col: str | None = None
    start: dt.date | None = None
    end: dt.date | None = None

    @property
    def categorical(self) -> list[str]:
        return [c for c, kind in self.x if kind == "categorical"]

    @property
    def continuous(self) -> list[str]:
        return [c for c, kind in self.x if kind == "continuous"]


@dataclass
class Fit:
    coefficients: DataFrame
    summary: DataFrame
    predictions: DataFrame
    features: list[str] = field(default_factory=list)
    labels: list[str] = field(default_factory=list)


def spec_problems(spec: ModelSpec) -> list[str]:
    """Faults visible without data."""
    names = [c for c, _ in spec.x]
    out = []
    if spec.model not in MODELS:
        out.append(f"unknown model {spec.model!r}")
    if not names:
        out.append("no x variable")
    if spec.y in names:
        out.append("y is among the x variables")
    if set(spec.categorical) & set(spec.continuous):
        out.append("a variable is both categorical and continuous")
    if spec.model == "lasso" and not (isinstance(spec.alpha, (int, float)) and spec.alpha > 0):
        out.append("alpha must be a positive number")
    if spec.model.startswith("rf_") and spec.n_estimators < 1:
        out.append("n_estimators must be at least 1")
    return out


def validate_variables(df: DataFrame, spec: ModelSpec) -> DataFrame:
    """One row per variable and rule: (variable, role, missing, unique_values,
    rule, ok). Findings are warnings; nothing is raised."""
    numeric = {c for c, t in df.dtypes if t in ("tinyint", "smallint", "int", "bigint", "float", "double") or t.startswith("decimal")}
    rules: list[tuple] = []

    def add(var: str, role: str, rule: str, ok) -> None:
        rules.append((var, role, rule, ok))

    names = [spec.y, *[c for c, _ in spec.x]]
    for i, var in enumerate(names):
        role = "y" if i == 0 else "x"
        add(var, role, "no_missing", F.col("missing") == 0)
        if role == "y" and spec.model in ("linear", "lasso", "rf_regression"):
            add(var, role, "numeric", F.lit(var in numeric))
        if role == "y" and spec.model in ("logistic", "probit"):
            add(var, role, "binary", F.col("unique_values") == 2)
        if role == "x" and (spec.model == "linear" or var in spec.continuous):
            add(var, role, "numeric", F.lit(var in numeric))
    if spec.model == "lasso":
        add(spec.y, "y", "alpha_positive", F.lit(spec.alpha is not None and spec.alpha > 0))
    add(spec.y, "y", "y_not_in_x", F.lit(spec.y not in names[1:]))
    cells = F.array(*[F.struct(F.lit(v).alias("variable"), F.col(v).cast("string").alias("value")) for v in dict.fromkeys(names)])
    counts = (
        df.select(F.inline(cells))
        .groupBy("variable", "value")
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy("variable")
        .agg(
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("_n"))), F.lit(0)).alias("missing"),
            F.count("value").alias("unique_values"),
        )
    )
    # One array of rules per variable name, so no join is needed.
    def rules_of(var: str):
        return F.array(
            *[
                F.struct(F.lit(r).alias("role"), F.lit(rule).alias("rule"), ok.alias("ok"))
                for v, r, rule, ok in rules
                if v == var
            ]
        )

    chain = None
    for var in dict.fromkeys(names):
        chain = (F if chain is None else chain).when(F.col("variable") == var, rules_of(var))
    return counts.select("variable", "missing", "unique_values", F.inline(chain))


def prepare(df: DataFrame, spec: ModelSpec) -> tuple[DataFrame, list[str], list[str]]:
    """Date filter, rows with any NULL dropped, encoding, feature vector.

    Categories become sparse indicators of all their levels but the first, so a
    column may have any number of levels; only their names, which the table of
    coefficients lists as well, reach the driver. Returns the data, the feature
    names and, for a text class, its sorted labels (the class number is the
    position of the label).
    """
    problems = spec_problems(spec)
    if problems:
        raise ValueError("; ".join(problems))
    if spec.date_col:
        df = filter_range(df, spec.date_col, spec.start, spec.end)
    text_class = spec.model == "rf_classification" and dict(df.dtypes)[spec.y] == "string"
    label = F.col(spec.y).cast("string" if text_class else "double").alias("_label")
    rows = df.select(
        label,
        *[F.col(c).cast("double").alias(c) for c in spec.continuous],
        *[F.col(c).cast("string").alias(c) for c in spec.categorical],
    ).dropna()
    labels: list[str] = []
    if text_class:
        classes = StringIndexer(inputCol="_label", outputCol="label", stringOrderType="alphabetAsc").fit(rows)
        rows, labels = classes.transform(rows), list(classes.labels)
    else:
        rows = rows.withColumn("label", F.col("_label"))
    parts, features = list(spec.continuous), list(spec.continuous)
    for i, c in enumerate(spec.categorical):
        # in descending order the first level is the last, which is dropped
        index = StringIndexer(inputCol=c, outputCol=f"_i{i}", stringOrderType="alphabetDesc").fit(rows)
        if len(index.labels) < 2:
            continue
        rows = index.transform(rows)
        rows = OneHotEncoder(inputCol=f"_i{i}", outputCol=f"_o{i}", dropLast=True).fit(rows).transform(rows)
        parts.append(f"_o{i}")
        code = len(index.labels) == 2 and spec.model != "rf_classification"
        features += [f"{c}_code"] if code else [f"{c}_{v}" for v in index.labels[:-1]]
    rows = VectorAssembler(inputCols=parts, outputCol="features").transform(rows).select("label", "features")
    # iterative fits read their input once per step, from a stored table
    return settle(rows, "model_input") if spec.model in ("logistic", "probit") else rows, features, labels


def _table(df: DataFrame, rows: list[tuple], ddl: str) -> DataFrame:
    return df.sparkSession.createDataFrame(rows, ddl)


def _stat(name: str, value) -> tuple[str, float | None]:
    return name, None if value is None else float(value)


def _linear(data: DataFrame, features: list[str]) -> Fit:
    model = LinearRegression(solver="auto").fit(data)
    s = model.summary
    rows = [
        (f, float(c), float(e), float(t), float(p))
        for f, c, e, t, p in zip(
            [*features, "intercept"],
            [*model.coefficients, model.intercept],
            s.coefficientStandardErrors,
            s.tValues,
            s.pValues,
        )
    ]
    coefficients = _table(data, rows, "feature string, value double, std_err double, t_value double, p_value double")
    summary = _table(
        data,
        [_stat("r2", s.r2), _stat("r2_adj", s.r2adj), _stat("n", s.numInstances)],
        "stat string, value double",
    )
    return Fit(coefficients, summary, _score(model, data), features)


def _steps(n: int, most: int) -> list[tuple[str, float | None]]:
    return [_stat("iterations", n), _stat("converged", n < most)]


def _glm(data: DataFrame, features: list[str], link: str, max_iter: int) -> Fit:
    model = GeneralizedLinearRegression(family="binomial", link=link, maxIter=max_iter, tol=1e-10).fit(data)
    s = model.summary
    rows = [
        (f, float(c), float(e), float(t), float(p))
        for f, c, e, t, p in zip(
            [*features, "intercept"],
            [*model.coefficients, model.intercept],
            s.coefficientStandardErrors,
            s.tValues,
            s.pValues,
        )
    ]
    coefficients = _table(data, rows, "feature string, value double, std_err double, t_value double, p_value double")
    summary = _table(
        data,
        [
            _stat("deviance", s.deviance),
            _stat("null_deviance", s.nullDeviance),
            _stat("aic", s.aic),
            _stat("n", s.numInstances),
            *_steps(s.numIterations, max_iter),
        ],
        "stat string, value double",
    )
    return Fit(coefficients, summary, _score(model, data), features)


def _lasso(data: DataFrame, features: list[str], alpha: float, max_iter: int) -> Fit:
    """Least squares over 2n plus alpha times the absolute coefficients, on
    the features as they are."""
    model = LinearRegression(
        elasticNetParam=1.0, regParam=alpha, standardization=False, maxIter=max_iter, tol=1e-12
    ).fit(data)
    rows = [(f, float(c)) for f, c in zip([*features, "intercept"], [*model.coefficients, model.intercept])]
    found = [_stat("mse", model.summary.meanSquaredError), _stat("r2", model.summary.r2)]
    summary = _table(data, [*found, *_steps(model.summary.totalIterations, max_iter)], "stat string, value double")
    return Fit(_table(data, rows, "feature string, value double"), summary, _score(model, data), features)


def _forest(data: DataFrame, features: list[str], spec: ModelSpec) -> Fit:
    kind = RandomForestClassifier if spec.model == "rf_classification" else RandomForestRegressor
    trees = spec.n_estimators
    if _repeats(data, spec):
        importances, predictions = _folded_forest(data, spec, kind)
    else:
        model = kind(numTrees=trees, maxDepth=spec.max_depth, maxBins=spec.max_bins, bootstrap=spec.resample, seed=SEED).fit(data)
        importances, predictions = model.featureImportances.toArray(), _score(model, data)
    rows = [(f, float(v)) for f, v in zip(features, importances)]
    summary = _table(data, [_stat("trees", trees), _stat("features", len(features))], "stat string, value double")
    return Fit(_table(data, rows, "feature string, value double"), summary, predictions, features)


def _repeats(data: DataFrame, spec: ModelSpec) -> bool:
    """Whether many rows share few points, as estimated to some percent."""
    point = ["label", "features"] if spec.model == "rf_classification" else ["features"]
    rows, points = data.agg(F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64(*point))).first()
    return rows >= FOLD_ROWS and points <= min(FOLD_POINTS, rows // 10)


def _poisson(u: Column) -> Column:
    """How often a row is drawn for a tree: a Poisson number of mean 1, from a
    uniform one."""
    ends = list(accumulate(math.exp(-1) / math.factorial(k) for k in range(18)))
    drawn = F.when(u < ends[0], 0)
    for k, end in enumerate(ends[1:], start=1):
        drawn = drawn.when(u < end, k)
    return drawn.otherwise(len(ends))


def _folded_forest(data: DataFrame, spec: ModelSpec, kind: type) -> tuple[np.ndarray, DataFrame]:
    """A forest on rows that share few points: (importances, predictions).

    A tree only sees how many rows of a point were drawn and, in regression, the
    mean of their labels: no split parts a point, so the rest of their variance is
    the same for every split. One pass draws each row for each tree and sums up
    the points; every tree then grows on points with weights, and each is scored
    once a point.
    """
    by_class, trees = spec.model == "rf_classification", spec.n_estimators
    numbers = range(trees if spec.resample else 1)
    chances = data.withColumns({f"_u{t}": F.rand(SEED + 1_000_003 * (t + 1)) for t in numbers}) if spec.resample else data
    counts = {t: _poisson(F.col(f"_u{t}")) if spec.resample else F.lit(1) for t in numbers}
    sums = [F.sum(n).cast("double").alias(f"_w{t}") for t, n in counts.items()]
    if not by_class:
        sums += [F.sum(n * F.col("label")).alias(f"_y{t}") for t, n in counts.items()]
    points = settle(chances.groupBy("features", *["label"] * by_class).agg(*sums), "points").coalesce(1)
    classes = int(points.agg(F.max("label")).first()[0]) + 1 if by_class else 0
    nominal = {"ml_attr": {"type": "nominal", "num_vals": classes}}
    subset = "all" if trees == 1 else "sqrt" if by_class else "onethird"

    def grow(t: int):
        drawn = t if spec.resample else 0
        label = F.col("label").alias("label", metadata=nominal) if by_class else (F.col(f"_y{drawn}") / F.col(f"_w{drawn}")).alias("label")
        seen = points.filter(F.col(f"_w{drawn}") > 0).select("features", label, F.col(f"_w{drawn}").alias("_w"))
        tree = kind(numTrees=1, maxDepth=spec.max_depth, maxBins=spec.max_bins, bootstrap=False, featureSubsetStrategy=subset, weightCol="_w", seed=SEED + t)
        return tree.fit(seen)

    with ThreadPool(min(trees, GROW_AT_ONCE)) as pool:
        grown = pool.map(inheritable_thread_target(points.sparkSession)(grow), range(trees))
    importances = sum(m.featureImportances.toArray() for m in grown)
    scored = points.select("features").distinct()
    for t, m in enumerate(grown):
        if by_class:
            m.setRawPredictionCol("").setPredictionCol("").setProbabilityCol("_q")
            scored = m.transform(scored).withColumn(f"_p{t}", vector_to_array("_q")).drop("_q")
        else:
            scored = m.setPredictionCol(f"_p{t}").transform(scored)
    mean = [F.expr("+".join(f"_p{t}{at}" for t in range(trees))) / trees for at in ([f"[{k}]" for k in range(classes)] or [""])]
    if by_class:
        votes = scored.select("features", F.array(*mean).alias("_votes"))
        best = (F.array_position("_votes", F.array_max("_votes")) - 1).cast("double")
        scored = votes.select("features", best.alias("y_hat"), *[F.col("_votes")[1].alias("probability")] * (classes > 1))
    else:
        scored = scored.select("features", mean[0].alias("y_hat"))
    scored = settle(scored, "scored")  # at most ``FOLD_POINTS`` rows
    predictions = data.join(F.broadcast(scored), "features").select(F.col("label").alias("y"), *scored.columns[1:])
    return importances / (importances.sum() or 1.0), predictions


def _score(model, data: DataFrame) -> DataFrame:
    scored = model.transform(data)
    extra = []
    if "probability" in scored.columns:
        extra = [vector_to_array("probability")[1].alias("probability")]
    return scored.select(F.col("label").alias("y"), F.col("prediction").alias("y_hat"), *extra)


def fit(df: DataFrame, spec: ModelSpec) -> Fit:
    """Fit the model: coefficients (or importances), summary, predictions."""
    data, features, labels = prepare(df, spec)
    if spec.model == "linear":
        return _linear(data, features)
    if spec.model in ("logistic", "probit"):
        return _glm(data, features, "logit" if spec.model == "logistic" else "probit", spec.max_iter)
    if spec.model == "lasso":
        return _lasso(data, features, float(spec.alpha), spec.max_iter)
    result = _forest(data, features, spec)
    if labels:
        names = F.array(*[F.lit(v) for v in labels])
        result.predictions = result.predictions.withColumns(
            {c: F.element_at(names, F.col(c).cast("int") + 1) for c in ("y", "y_hat")}
        )
        result.labels = labels
    return result
