"""Namespaces: one database per user, created on demand and dropped with its tables."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


def namespace_for(user: str, prefix: str = "linfold_") -> str:
    """Database name from a free-form user string: non-alphanumerics removed, lower-cased."""
    clean = re.sub("[^A-Za-z0-9]+", "", user or "").lower()
    if not clean:
        raise ValueError("user name has no letters or digits")
    return f"{prefix}{clean}"


def create_namespace(spark: SparkSession, name: str, location: str | None = None, use: bool = False) -> str:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{loc}")
    if use:
        spark.catalog.setCurrentDatabase(name)
    return name


def drop_namespace(spark: SparkSession, name: str) -> None:
    """Drop the database and every table in it (a non-empty database needs CASCADE)."""
    if spark.catalog.currentDatabase() == name:
        spark.catalog.setCurrentDatabase("default")
    spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")


def namespace_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.databaseExists(name)
