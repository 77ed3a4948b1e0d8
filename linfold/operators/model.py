"""Linear regression, grid tuning, reports, holdout evaluation and scoring (Spark ML).

Tuning reads the rows once: ``sufficient`` sums means and co-moments of features and label for both inner
sides on the executors, and every grid point, its validation error and the refit follow from these matrices of
features x features. MLlib's own fits remain for widths beyond ``STATS_WIDTH`` and for an absolute error.
"""

from __future__ import annotations

import uuid
import warnings
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.common import _py2java
from pyspark.ml.feature import Imputer
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linfold.functions.exprs import present, q
from linfold.operators.encode import (category_indexer, feature_assembler, index_name, one_hot_encoder, vector_name,
                                      vector_size, vector_slot_names)
from linfold.operators import sufficient
from linfold.operators.metrics import regression_metrics
from linfold.operators.split import side_of

# The source job's search grid and inner split.
REG_PARAMS = (0.01, 0.1, 0.5)
ELASTIC_NET_PARAMS = (0.0, 0.5, 1.0)
TRAIN_RATIO = 0.8


def linear_regression(label: str = "label", features: str = "features", **params) -> LinearRegression:
    return LinearRegression(labelCol=label, featuresCol=features, **params)


def param_grid(lr: LinearRegression, reg_params=REG_PARAMS, elastic_net_params=ELASTIC_NET_PARAMS):
    """regParam outer, elasticNetParam inner (9 points by default)."""
    return ParamGridBuilder().addGrid(lr.regParam, list(reg_params)) \
        .addGrid(lr.elasticNetParam, list(elastic_net_params)).build()


def simple_ols(df: DataFrame, x: str, label: str = "label") -> DataFrame:
    """One-feature least squares: (feature, slope, intercept, r2, n) from one aggregate.

    Rows without a value or a label (NULL or NaN) are left out.
    """
    xv, yv = present(f"CAST({q(x)} AS DOUBLE)"), present(f"CAST({q(label)} AS DOUBLE)")
    pairs = df.selectExpr(f"{xv} AS x", f"{yv} AS y")
    return pairs.agg(F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept"),
                     F.regr_r2("y", "x").alias("r2"), F.regr_count("y", "x").alias("n")).select(
        F.lit(x).alias("feature"), "slope", "intercept", "r2", "n")


def ols_apply(df: DataFrame, x: str, slope: float, intercept: float, label: str | None = "label",
              keep=()) -> DataFrame:
    """Predictions of a fitted line; NULL for a missing value. With a label, residuals too."""
    prediction = F.expr(present(f"CAST({q(x)} AS DOUBLE)")) * F.lit(slope) + F.lit(intercept)
    scored = df.withColumn("prediction", prediction)
    if label is None:
        return scored.select(*keep, "prediction")
    return scored.select(*keep, label, "prediction", (F.col(label) - F.col("prediction")).alias("residual"))


def ols_predict(df: DataFrame, x: str, label: str = "label", keep=()) -> DataFrame:
    """Predictions of the one-feature model fitted on ``df`` (two numbers are read back), with a residual column."""
    fitted = simple_ols(df, x, label).first()
    return ols_apply(df, x, fitted["slope"], fitted["intercept"], label, keep)


def onehot_group_mean(df: DataFrame, category: str, label: str = "label") -> DataFrame:
    """Unpenalised regression on one one-hot category; per category (n, prediction).

    Its predictions are the category means, which is the SQL identity it is checked
    against.
    """
    stages = [category_indexer([category], handle_invalid="error"), one_hot_encoder([category]),
              feature_assembler([vector_name(category)]),
              linear_regression(label, regParam=0.0, solver="normal")]
    scored = Pipeline(stages=stages).fit(df).transform(df)
    return scored.groupBy(category).agg(F.count(F.lit(1)).alias("n"), F.avg("prediction").alias("prediction"))


def model_inputs(numeric, binary, categorical) -> list[str]:
    """Assembler inputs: numeric and 0/1 columns as they are, categoricals as one-hot vectors."""
    return list(numeric) + list(binary) + [vector_name(c) for c in categorical]


#: What to do with a missing numeric value: fail, leave the row out, or put the training mean in its place.
MISSING = ("error", "skip", "mean")

#: Up to this many features tuning works from sums; a task's state is then 2 MB a side.
STATS_WIDTH = 512

#: Above this many features MLlib's automatic solver changes from normal equations to iterations.
NORMAL_SOLVER_FEATURES = 4096


def preparation(numeric, binary, categorical, missing: str = "error") -> Pipeline:
    """Every step before the regression: impute (if asked), index, one-hot, assemble.

    The same fitted steps serve training, batch scoring and streams, so a missing value is
    treated alike everywhere. A category unseen in training gets a slot of its own.
    """
    if missing not in MISSING:
        raise ValueError(f"missing must be one of {MISSING}")
    numeric, stages = list(numeric), []
    if missing == "mean" and numeric:
        filled = [f"{c}_filled" for c in numeric]
        stages.append(Imputer(inputCols=numeric, outputCols=filled, strategy="mean"))
        numeric = filled
    if categorical:
        stages += [category_indexer(categorical, "keep"), one_hot_encoder(categorical)]
    stages.append(feature_assembler(model_inputs(numeric, binary, categorical),
                                    handle_invalid="skip" if missing == "skip" else "error"))
    return Pipeline(stages=stages)


@dataclass
class Tuned:
    """A tuned model: ``model`` scores raw rows; ``grid`` has (regParam, elasticNetParam, value) in grid order."""

    model: PipelineModel
    grid: list[tuple[float, float, float]]
    metric: str
    #: Training rows, R2 and RMSE of the winner.
    n_train: int | None = None
    train_r2: float | None = None
    train_rmse: float | None = None

    @property
    def best(self) -> int:
        values = [v for *_, v in self.grid]
        return values.index(max(values) if self.metric == "r2" else min(values))


def _validate(models, valid: DataFrame, label: str, metric: str) -> list[float]:
    """The metric of every model from one scan of the validation rows and one aggregate."""
    y = F.col(label).cast("double")
    for i, m in enumerate(models):
        valid = m.setPredictionCol(f"_p{i}").transform(valid)
    sums = [F.var_pop(y).alias("var")]
    for i in range(len(models)):
        err = y - F.col(f"_p{i}")
        sums += [F.avg(err * err).alias(f"s{i}"), F.avg(F.abs(err)).alias(f"a{i}")]
    row = valid.agg(*sums).first()
    if row["s0"] is None:
        raise ValueError("no validation rows: the training side is too small to tune on")
    value = {"mse": lambda i: row[f"s{i}"], "rmse": lambda i: row[f"s{i}"] ** 0.5, "mae": lambda i: row[f"a{i}"],
             "r2": lambda i: 1 - row[f"s{i}"] / row["var"] if row["var"] else float("-inf")}[metric]
    return [value(i) for i in range(len(models))]


def _fitted(solution, reg: float, elastic: float, label: str) -> LinearRegressionModel:
    """MLlib's model with these coefficients, so that pipelines save, load and score it like one of its own fits."""
    spark = _session()
    uid = f"LinearRegression_{uuid.uuid4().hex[:12]}"
    made = LinearRegressionModel(spark._jvm.org.apache.spark.ml.regression.LinearRegressionModel(
        uid, _py2java(spark.sparkContext, Vectors.dense(solution.coefficients)), float(solution.intercept)))
    made._resetUid(uid)
    for param, value in ((made.regParam, reg), (made.elasticNetParam, elastic), (made.labelCol, label)):
        made.set(param, value)
    return made


def _tune_from_sums(rows: DataFrame, label: str, steps: PipelineModel, points, metric: str) -> Tuned:
    """One scan: the sums of both sides, from which all else follows."""
    sides = sufficient.sums(rows, label, vector_size(rows, "features"))
    if 0 not in sides:
        raise ValueError("no rows to fit on: the training side is too small")
    if 1 not in sides:
        raise ValueError("no validation rows: the training side is too small to tune on")
    fit_side, valid = sides[0], sides[1]
    fits = sufficient.elastic_net_path(fit_side, points)
    values = [sufficient.score(valid, f, metric) for f in fits]
    found = Tuned(steps, [(r, e, v) for (r, e), v in zip(points, values)], metric)
    reg, elastic = points[found.best]
    whole = fit_side.merge(valid)
    winner = sufficient.elastic_net_path(whole, [(reg, elastic)])[0]
    return Tuned(PipelineModel(stages=[*steps.stages, _fitted(winner, reg, elastic, label)]), found.grid, metric,
                 int(whole.n), sufficient.score(whole, winner, "r2"), sufficient.score(whole, winner, "rmse"))


def tune(train: DataFrame, key: str, numeric, binary=(), categorical=(), label: str = "label",
         outer: float = 0.7, train_ratio: float = TRAIN_RATIO, hash_fn: str = "xxhash64", reg_params=REG_PARAMS,
         elastic_net_params=ELASTIC_NET_PARAMS, metric: str = "rmse", missing: str = "error",
         parallelism: int = 3, solver: str = "auto") -> Tuned:
    """Grid search on an inner split by key hash, then a refit of the winner on all of ``train``.

    ``train`` is the side of a key-hash split below ``outer``; its rows below ``outer * train_ratio``
    fit the grid points, the others validate them. A row's part depends on its key alone, so
    partitions, cores and executors do not change the result (but for summation order).
    Categories and means are learned once on all of ``train``, so validation rows meet none unseen.

    ``solver``: "sums" fits, validates and refits from one scan's sums; "mllib" fits each point by MLlib
    on persisted rows; "auto" takes sums for up to ``STATS_WIDTH`` features and every metric but "mae",
    whose value no sums give. Both minimise the same function. If an executor is lost, its part is computed
    again from the source, with the same result.
    """
    if solver not in ("auto", "sums", "mllib"):
        raise ValueError(f"unknown solver {solver!r}")
    inner = side_of(key, (outer * train_ratio, outer * (1 - train_ratio), 1 - outer), hash_fn)
    columns = dict.fromkeys([label, *numeric, *binary, *categorical])
    raw = train.select(*columns, inner.alias("_side"))
    steps = preparation(numeric, binary, categorical, missing).fit(raw)
    data = steps.transform(raw).select(label, "features", "_side")
    width = vector_size(data, "features")
    if solver == "sums" or (solver == "auto" and width <= STATS_WIDTH and metric != "mae"):
        return _tune_from_sums(data, label, steps, [(float(r), float(e)) for r in reg_params for e in elastic_net_params], metric)
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if width > NORMAL_SOLVER_FEATURES:
            warnings.warn(f"{width} features: the solver iterates instead of solving normal equations", stacklevel=2)
        lr = linear_regression(label)
        grid = param_grid(lr, reg_params, elastic_net_params)
        fit_side = data.filter("_side = 0")
        with ThreadPool(max(1, parallelism)) as pool:
            models = pool.map(lambda pm: lr.fit(fit_side, pm), grid)
        values = _validate(models, data.filter("_side = 1"), label, metric)
        points = [(float(pm[lr.regParam]), float(pm[lr.elasticNetParam]), float(v)) for pm, v in zip(grid, values)]
        tuned = Tuned(steps, points, metric)
        winner = lr.fit(data, grid[tuned.best])
        s = winner.summary
        return Tuned(PipelineModel(stages=[*steps.stages, winner]), points, metric, int(s.numInstances), float(s.r2),
                     float(s.rootMeanSquaredError))
    finally:
        data.unpersist()


def _session() -> SparkSession:
    return SparkSession.getActiveSession()


def regression(model: PipelineModel):
    """The fitted regression, the last stage."""
    return model.stages[-1]


def grid_metrics(tuned: Tuned) -> DataFrame:
    """(regParam, elasticNetParam, metric, value, is_best): one row per grid point."""
    rows = [(r, e, tuned.metric, v, i == tuned.best) for i, (r, e, v) in enumerate(tuned.grid)]
    return _session().createDataFrame(rows, "regParam double, elasticNetParam double, metric string, value double, "
                                    "is_best boolean")


def model_report(model: Tuned | PipelineModel) -> DataFrame:
    """The winner's training R2/RMSE, its parameters, intercept and width: one row."""
    tuned = model if isinstance(model, Tuned) else Tuned(model, [], "")
    best = regression(tuned.model)
    told = (tuned.train_r2, tuned.train_rmse, tuned.n_train)
    if told[0] is None and best.hasSummary:  # a reloaded model has none (metrics are kept in the run log)
        told = (float(best.summary.r2), float(best.summary.rootMeanSquaredError), int(best.summary.numInstances))
    return _session().createDataFrame([(told[0], told[1], float(best.getRegParam()), float(best.getElasticNetParam()),
                                float(best.intercept), int(best.numFeatures), told[2])],
                              "train_r2 double, train_rmse double, regParam double, elasticNetParam double, "
                              "intercept double, n_features int, n_train bigint")


def model_coefficients(model: PipelineModel, sample: DataFrame) -> DataFrame:
    """(slot, feature, coefficient), names from the assembled vector's metadata.

    ``sample`` only supplies the input schema; no job runs on it.
    """
    best = regression(model)
    prepared = PipelineModel(stages=list(model.stages[:-1])).transform(sample)
    names = vector_slot_names(prepared, best.getFeaturesCol())
    coef = best.coefficients.toArray()
    if len(names) != len(coef):
        names = [f"f{i}" for i in range(len(coef))]
    rows = [(i, n, float(c)) for i, (n, c) in enumerate(zip(names, coef))]
    return sample.sparkSession.createDataFrame(rows, "slot int, feature string, coefficient double")


def holdout_metrics(model: PipelineModel, holdout: DataFrame, label: str = "label") -> DataFrame:
    """Score the holdout once and compute every metric in one aggregate."""
    return regression_metrics(model.transform(holdout), label=label)


__all__ = ["REG_PARAMS", "ELASTIC_NET_PARAMS", "TRAIN_RATIO", "MISSING", "Tuned", "linear_regression", "param_grid",
           "simple_ols", "ols_apply", "ols_predict", "onehot_group_mean", "preparation", "tune", "grid_metrics",
           "model_report", "model_coefficients", "holdout_metrics", "regression", "index_name"]
