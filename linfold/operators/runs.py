"""Experiment run log kept as a table (replaces the tracking-server client).

One row per run: (experiment, run_id, started, params, metrics, model_uri). Rows
are appended by a one-row write to the experiment's partition; lookups are filters on
the table. An experiment is a name, never NULL.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linfold.functions.exprs import lit_str
from linfold.session import fresh_name, shared_dir
from linfold.sources.tables import qualified

RUN_SCHEMA = ("experiment string, run_id string, started timestamp, params map<string,string>, "
              "metrics map<string,double>, model_uri string")


def _append(spark: SparkSession, rows, table: str, database: str | None) -> None:
    frame = spark.createDataFrame(rows, RUN_SCHEMA)
    # The partition column goes last, as Spark stores it.
    frame.select(*[c for c in frame.columns if c != "experiment"], "experiment").write.mode("append") \
        .format("parquet").partitionBy("experiment").saveAsTable(qualified(table, database))


def _row(experiment: str, params: dict, metrics: dict, model_uri: str | None, run_id: str | None = None):
    if not experiment:
        raise ValueError("a run needs the name of an experiment")
    return (experiment, run_id or uuid.uuid4().hex, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
            {str(k): str(v) for k, v in params.items()},
            {str(k): float(v) for k, v in metrics.items() if v is not None}, model_uri)


def log_runs(spark: SparkSession, table: str, runs, database: str | None = None) -> list[str]:
    """Append several runs ``(experiment, params, metrics, model_uri)`` in one write."""
    rows = [_row(*r) for r in runs]
    _append(spark, rows, table, database)
    return [r[1] for r in rows]


def log_run(spark: SparkSession, table: str, experiment: str, params: dict, metrics: dict,
            model_uri: str | None, database: str | None = None, run_id: str | None = None) -> str:
    row = _row(experiment, params, metrics, model_uri, run_id)
    _append(spark, [row], table, database)
    return row[1]


def runs_frame(runs: DataFrame, experiment: str | None = None) -> DataFrame:
    return runs if experiment is None else runs.filter(F.col("experiment") == experiment)


def best_run(runs: DataFrame, metric: str = "rmse", experiment: str | None = None,
             larger_is_better: bool = False) -> DataFrame:
    """The run with the best value of ``metric`` (ties by run_id): one row."""
    v = F.col("metrics").getItem(metric)
    order = v.desc_nulls_last() if larger_is_better else v.asc_nulls_last()
    return runs_frame(runs, experiment).filter(v.isNotNull()).orderBy(order, F.col("run_id")).limit(1)


def delete_runs(spark: SparkSession, table: str, experiment: str, database: str | None = None) -> int:
    """Remove every run of ``experiment`` by dropping its partition; no other row is read or
    rewritten, and runs that are appended meanwhile stay. Returns the rows removed."""
    full = qualified(table, database)
    removed = spark.table(full).filter(F.col("experiment") == experiment).count()
    if removed:
        spark.sql(f"ALTER TABLE {full} DROP IF EXISTS PARTITION (experiment = {lit_str(experiment)})")
    return removed


def compact_runs(spark: SparkSession, table: str, experiment: str, database: str | None = None) -> int:
    """Rewrites the runs of ``experiment``, a file for each run until then, as one file; returns how many files there were.

    The new file is written to a folder of its own and then named as the partition's place by one change in the
    catalog, so readers see the old files or the new one. Meant for an experiment that nobody is logging to: a run
    logged between the two steps would stay behind in the old folder.
    """
    full = qualified(table, database)
    rows = spark.table(full).filter(F.col("experiment") == experiment)
    files = len(rows.select("run_id").inputFiles())
    if files < 2:
        return files
    path = shared_dir(spark, "runs", fresh_name("compact"))
    rows.drop("experiment").coalesce(1).write.parquet(path)  # one row for each run: a log, not data
    spark.sql(f"ALTER TABLE {full} PARTITION (experiment = {lit_str(experiment)}) SET LOCATION {lit_str(path)}")
    spark.catalog.refreshTable(full)
    return files
