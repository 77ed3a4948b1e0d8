"""The regression frame built on the driver's ``lineitem`` table.

The driver's tables have no housing data, so a line item plays a house: its
charge (``extended price * (1 - discount) * (1 + tax)``) is the value to predict.
Roles mirror the source job: a strong feature, weak ones, a redundant and
label-dependent one (``disc_price``), a derived ratio, a 0/1 flag, categoricals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linfold.functions.exprs import row_key
from linfold.operators.project import add_ratios, rename_label
from linfold.spec import FeatureSpec, Ratio

SPEC = FeatureSpec(
    label="label",
    key="row_key",
    numeric=("l_extendedprice", "l_quantity", "l_discount", "l_tax", "disc_price"),
    categorical=("l_returnflag", "l_linestatus", "l_linenumber"),
    binary=("is_open",),
    ratios=(Ratio("unit_price", "l_extendedprice", "l_quantity"),),
    ignored=("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate"),
    dependent=("disc_price",),
)

RAW_LABEL = "charge"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled input table (plays the part of the source job's raw table)."""
    li = table(spark, sf_dir, "lineitem")
    ext, disc, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    return li.select(
        row_key("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("row_key"),
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
        (ext * (1 - disc)).alias("disc_price"),
        (F.col("l_linestatus") == "O").cast("int").alias("is_open"),
        (ext * (1 - disc) * (1 + tax)).alias(RAW_LABEL))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rename_label(charges(spark, sf_dir), RAW_LABEL, SPEC.label)


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label renamed and ratios derived: the frame every analysis step reads."""
    return add_ratios(labelled(spark, sf_dir), SPEC)


def screen_columns() -> list[str]:
    """Columns screened by correlation: label plus every numeric input and ratio."""
    return [SPEC.label] + list(SPEC.numeric) + list(SPEC.ratio_names)
