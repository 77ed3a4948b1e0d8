"""The source job's housing workflow on a hand-made CSV with its schema (FIXTURES section 1)."""

import os

import numpy as np
from pyspark.sql import functions as F

from linfold.plans import house_prices
from linfold.session import fresh_name, shared_dir
from linfold.sources import catalog


def _write_house_csv(path: str, n: int = 400, seed: int = 5) -> None:
    rng = np.random.default_rng(seed)
    os.makedirs(path, exist_ok=True)
    cols = [c.split()[0] for c in house_prices.HOUSE_SCHEMA.split(", ")]
    with open(os.path.join(path, "houses.csv"), "w") as fh:
        fh.write(",".join(cols) + "\n")
        for i in range(n):
            living = int(rng.integers(600, 4000))
            above = int(living * rng.uniform(0.6, 1.0))
            grade = int(rng.integers(5, 11))
            zipcode = int(rng.choice([98001, 98052, 98103, 98118]))
            bedrooms = int(max(1, round(living / 700 + rng.normal(0, 0.7))))
            price = 150.0 * living + 20000.0 * grade + (80000.0 if zipcode == 98052 else 0.0) + rng.normal(0, 30000)
            row = [7000000000 + i, f"2014{1 + i % 12:02d}13T000000", round(price, 1), bedrooms,
                   round(bedrooms * 0.6 + rng.uniform(0, 1), 2), living, int(rng.integers(2000, 20000)),
                   float(rng.choice([1.0, 1.5, 2.0])), int(rng.random() < 0.05), int(rng.integers(0, 4)),
                   int(rng.integers(1, 6)), grade, above, living - above, int(rng.integers(1920, 2015)),
                   0 if rng.random() < 0.9 else 2000, zipcode, 47.5, -122.2,
                   int(living * rng.uniform(0.9, 1.1)), int(rng.integers(2000, 20000))]
            fh.write(",".join(str(v) for v in row) + "\n")


def test_house_workflow_end_to_end(spark):
    path = shared_dir(spark, "house", fresh_name("csv")).replace("file:", "")
    _write_house_csv(path)
    user = "Test.User-" + fresh_name("u")
    out = house_prices.run(spark, path, user, parallelism=2)
    assert out.database == catalog.namespace_for(user)
    rep = out.report.first()
    assert 0.5 < rep["train_r2"] <= 1.0
    hold = out.holdout_metrics.first()
    assert hold["n"] > 0 and hold["r2"] > 0.3
    # The source job's nine inputs: five numeric ones, three encoded categories and a 0/1 flag.
    assert sorted(out.job.numeric) == ["bathrooms", "bedrooms", "floors", "sqft_above_percentage", "sqft_living"]
    names = {r["feature"].split("_vector")[0] for r in out.coefficients.collect()}
    assert names == {*out.job.numeric, "condition", "grade", "zipcode", "waterfront"}
    shown = {r["column_name"] for r in out.job.selection.label_corr.collect()}
    assert {"sqft_above", "sqft_basement", "yr_built", "sqft_living15"} <= shown
    assert out.scored.count() == 400
    assert out.scored.filter(F.col("prediction").isNull()).count() == 0
    runs = spark.table(f"{out.database}.{house_prices.RUNS_TABLE}").collect()
    assert len(runs) == 1 and runs[0]["model_uri"] == out.job.model_uri
    house_prices.clean_up(spark, out)
    assert not catalog.namespace_exists(spark, out.database)


def test_house_cli_runs_and_cleans_up(spark, capsys):
    path = shared_dir(spark, "house", fresh_name("csv")).replace("file:", "")
    _write_house_csv(path, n=250, seed=9)
    user = "cli-" + fresh_name("u")
    assert house_prices.main(["--csv", path, "--user", user, "--cleanup"]) == 0
    assert not catalog.namespace_exists(spark, catalog.namespace_for(user))
    assert "train_r2" in capsys.readouterr().out
