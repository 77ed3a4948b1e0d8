"""Managed tables: create-as-select (replacing), the unlabelled copy, scans and drops.

Parquet by default; Delta when its jars are on the classpath (``fmt="delta"``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def qualified(name: str, database: str | None = None) -> str:
    return f"`{database}`.`{name}`" if database else f"`{name}`"


def create_table(df: DataFrame, name: str, database: str | None = None, fmt: str = "parquet",
                 mode: str = "overwrite", partition_by=None) -> str:
    """``CREATE OR REPLACE TABLE name AS SELECT ...``: the write runs in parallel, one
    file set per task; overwrite replaces an existing table of that name."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    full = qualified(name, database)
    w.saveAsTable(full)
    return full


def create_unlabeled_table(df: DataFrame, name: str, label: str, database: str | None = None,
                           fmt: str = "parquet") -> str:
    """The same rows without the label column (what new data to score looks like)."""
    return create_table(df.drop(label), name, database, fmt)


def drop_table(spark: SparkSession, name: str, database: str | None = None) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {qualified(name, database)}")


def read_table(spark: SparkSession, name: str, database: str | None = None) -> DataFrame:
    return spark.table(qualified(name, database))
