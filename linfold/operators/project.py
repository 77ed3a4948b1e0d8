"""Projections of the source job: label rename, column drops, derived ratios, role projection."""

from __future__ import annotations

from pyspark.sql import DataFrame

from linfold.functions.exprs import safe_ratio
from linfold.spec import FeatureSpec, Ratio


def rename_label(df: DataFrame, source: str, label: str = "label") -> DataFrame:
    return df.withColumnRenamed(source, label)


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    return df.drop(*cols)


def add_ratio(df: DataFrame, ratio: Ratio) -> DataFrame:
    """``name = numerator / denominator``, NULL on a zero divisor (the same function
    serves training and scoring, so the two cannot drift apart)."""
    return df.withColumn(ratio.name, safe_ratio(ratio.numerator, ratio.denominator))


def add_ratios(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    for r in spec.ratios:
        df = add_ratio(df, r)
    return df


def project_roles(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Keep only what a model reads (key, label, features); column pruning reaches the scan."""
    return df.select(*spec.model_columns())
