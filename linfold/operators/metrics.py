"""Regression metrics in one aggregate (the source job evaluated twice per frame)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(n, mse, rmse, mae, r2, n_missing) in one pass; same definitions as ``RegressionEvaluator``.

    r2 = 1 - SSE / SST with SST = n * var_pop(label); NULL when the label is constant.
    Rows without a label or a prediction (NULL or NaN) are left out and counted in ``n_missing``.
    """
    gap = F.col(label).cast("double") - F.col(prediction).cast("double")
    err = F.when(~F.isnan(gap), gap)
    agg = df.agg(F.count(err).alias("n"), (F.count(F.lit(1)) - F.count(err)).alias("n_missing"), F.sum(err * err).alias("sse"), F.sum(F.abs(err)).alias("sae"),
                 F.var_pop(F.when(err.isNotNull(), F.col(label).cast("double"))).alias("var_label"))
    mse = F.try_divide(F.col("sse"), F.col("n"))
    return agg.select(
        "n", mse.alias("mse"), F.sqrt(mse).alias("rmse"),
        F.try_divide(F.col("sae"), F.col("n")).alias("mae"),
        (F.lit(1.0) - F.try_divide(F.col("sse"), F.col("var_label") * F.col("n"))).alias("r2"), "n_missing")
