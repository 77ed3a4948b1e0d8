"""The source job's own workflow on its housing CSV, end to end.

CSV -> a database per user with a labelled and an unlabelled table -> explore ->
select -> split -> tune -> report -> holdout -> save -> run log -> score the
unlabelled table with the reloaded model. ``clean_up`` drops the database.
The column roles below are the source job's, its analyst's choices (``explored``, ``keep``)
included; correlations of all of them are computed and shown.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from linfold.operators import model as mdl
from linfold.operators.project import add_ratios, rename_label
from linfold.plans import regression_job
from linfold.session import shared_dir
from linfold.sources import catalog, csv, tables
from linfold.spec import FeatureSpec, Ratio

# The source data's column names and types, in file order.
HOUSE_SCHEMA = (
    "id BIGINT, date STRING, price DOUBLE, bedrooms INT, bathrooms DOUBLE, sqft_living INT, sqft_lot INT, "
    "floors DOUBLE, waterfront INT, view INT, condition INT, grade INT, sqft_above INT, sqft_basement INT, "
    "yr_built INT, yr_renovated INT, zipcode INT, lat DOUBLE, long DOUBLE, sqft_living15 INT, sqft_lot15 INT")

# The source job's column roles.
HOUSE_SPEC = FeatureSpec(
    label="label",
    key="id",
    numeric=("bedrooms", "bathrooms", "sqft_living", "floors"),
    categorical=("condition", "grade", "zipcode"),
    binary=("waterfront",),
    ratios=(Ratio("sqft_above_percentage", "sqft_above", "sqft_living"),),
    ignored=("id", "date", "view", "yr_renovated", "lat", "long"),
    # The source job looked at these and left them out: weak, or told by other columns.
    explored=("sqft_above", "sqft_basement", "sqft_lot", "sqft_lot15", "sqft_living15", "yr_built"),
    keep=("bedrooms", "bathrooms", "floors", "sqft_living", "sqft_above_percentage"),
)
RAW_LABEL = "price"
LABELLED_TABLE = "houses_labelled"
UNLABELLED_TABLE = "houses_to_score"
RUNS_TABLE = "model_runs"


@dataclass
class HouseRun:
    database: str
    job: regression_job.JobResult
    report: DataFrame
    coefficients: DataFrame
    holdout_metrics: DataFrame
    scored: DataFrame


def ingest(spark: SparkSession, csv_path: str, user: str, infer_schema: bool = False) -> str:
    """Database for ``user``, the CSV written as a labelled and an unlabelled table."""
    db = catalog.namespace_for(user)
    catalog.create_namespace(spark, db, location=shared_dir(spark, "warehouse", f"{db}.db"))
    raw = csv.read_csv(spark, csv_path, schema=None if infer_schema else HOUSE_SCHEMA, infer_schema=infer_schema)
    tables.create_table(raw, LABELLED_TABLE, db)
    tables.create_unlabeled_table(raw, UNLABELLED_TABLE, RAW_LABEL, db)
    return db


def prepared(spark: SparkSession, db: str) -> DataFrame:
    df = rename_label(tables.read_table(spark, LABELLED_TABLE, db), RAW_LABEL, HOUSE_SPEC.label)
    return add_ratios(df, HOUSE_SPEC)


def run(spark: SparkSession, csv_path: str, user: str, experiment: str = "house-prices",
        **job_options) -> HouseRun:
    """The whole job; its results are lazy frames over the user's tables, so drop those (``clean_up``) after reading them."""
    db = ingest(spark, csv_path, user)
    job = regression_job.run(prepared(spark, db), HOUSE_SPEC, experiment=experiment, runs_table=RUNS_TABLE,
                             database=db, **job_options)
    scored = regression_job.score(job.model_uri, tables.read_table(spark, UNLABELLED_TABLE, db), HOUSE_SPEC)
    return HouseRun(db, job, mdl.model_report(job.tuned), mdl.model_coefficients(job.model, job.holdout),
                      mdl.holdout_metrics(job.model, job.holdout), scored)


def clean_up(spark: SparkSession, out: HouseRun) -> None:
    """Drops the user's database with its tables."""
    catalog.drop_namespace(spark, out.database)


def main(argv=None) -> int:
    """``python -m linfold.plans.house_prices --csv PATH --user NAME [--cleanup]`` on any cluster."""
    import argparse

    from linfold.sources.preview import ordered_preview

    parser = argparse.ArgumentParser(description="Tune, evaluate, save and apply a house-price model.")
    parser.add_argument("--csv", required=True, help="headered CSV file or folder (any Hadoop URI)")
    parser.add_argument("--user", required=True, help="user name; the database is derived from it")
    parser.add_argument("--experiment", default="house-prices")
    parser.add_argument("--cleanup", action="store_true", help="drop the user's database at the end")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.getOrCreate()
    out = run(spark, args.csv, args.user, experiment=args.experiment)
    out.report.show(truncate=False)
    out.holdout_metrics.show(truncate=False)
    tables.create_table(out.coefficients, "model_coefficients", out.database)  # many zip codes: a table, not a print
    ordered_preview(out.coefficients, "slot", 20).show(truncate=False)
    ordered_preview(out.scored, HOUSE_SPEC.key, 20).show(truncate=False)
    if args.cleanup:
        clean_up(spark, out)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
