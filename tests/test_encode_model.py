import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from linfold.operators import encode, metrics, model as mdl
from linfold.plans import stand_in

SF = "/root/testdata/sf0.001"


def test_frequency_ties_order(spark):
    df = spark.createDataFrame([(k,) for k in [10, 10, 9, 9, 2, 30, 30, 30]], "k int")
    freq = encode.category_frequencies(df, ["k"]).orderBy("category_index").collect()
    assert [r["category"] for r in freq] == ["30", "10", "9", "2"]
    fitted = encode.category_indexer(["k"]).fit(df)
    assert list(fitted.labelsArray[0]) == ["30", "10", "9", "2"]


def test_frequencies_match_indexer_on_lineitem(spark):
    df = stand_in.prepared(spark, SF)
    cols = ["l_returnflag", "l_linenumber"]
    fitted = encode.category_indexer(cols).fit(df)
    freq = encode.category_frequencies(df, cols)
    for i, c in enumerate(cols):
        got = [r["category"] for r in freq.filter(F.col("column_name") == c).orderBy("category_index").collect()]
        assert got == list(fitted.labelsArray[i])


def test_unseen_and_null_categories(spark):
    train = spark.createDataFrame([(k,) for k in [10, 10, 9]], "k int")
    new = spark.createDataFrame([(77,), (9,), (None,)], "k int")
    keep = encode.category_indexer(["k"], "keep").fit(train).transform(new)
    assert sorted(r["k_index"] for r in keep.collect()) == [1.0, 2.0, 2.0]
    skip = encode.category_indexer(["k"], "skip").fit(train).transform(new)
    assert skip.count() == 1
    with pytest.raises(Exception):
        encode.category_indexer(["k"], "error").fit(train).transform(new).collect()


def test_one_hot_drop_last_and_row_sums(spark):
    df = stand_in.prepared(spark, SF)
    stages = [encode.category_indexer(["l_returnflag"], "error"), encode.one_hot_encoder(["l_returnflag"])]
    out = Pipeline(stages=stages).fit(df).transform(df)
    k = df.select("l_returnflag").distinct().count()
    assert encode.vector_size(out, "l_returnflag_vector") == k - 1
    sums = out.select(F.aggregate(vector_to_array("l_returnflag_vector"), F.lit(0.0), lambda a, x: a + x).alias("s"))
    assert {r["s"] for r in sums.collect()} <= {0.0, 1.0}


def _cd_elastic_net(X, y, lam, alpha, iters=5000):
    """Coordinate descent on z-scored data (population std), Spark's standardised objective."""
    mx, sx = X.mean(0), X.std(0)
    my, sy = y.mean(), y.std()
    Z, t = (X - mx) / sx, (y - my) / sy
    n, p = Z.shape
    l1, l2 = alpha * lam / sy, (1 - alpha) * lam / sy
    w = np.zeros(p)
    for _ in range(iters):
        w_old = w.copy()
        for j in range(p):
            r = t - Z @ w + Z[:, j] * w[j]
            rho = Z[:, j] @ r / n
            w[j] = np.sign(rho) * max(abs(rho) - l1, 0.0) / (1.0 + l2)
        if np.max(np.abs(w - w_old)) < 1e-13:
            break
    beta = w * sy / sx
    return beta, my - beta @ mx


@pytest.mark.parametrize("alpha", [0.0, 0.5, 1.0])
def test_elastic_net_matches_coordinate_descent(spark, alpha):
    rng = np.random.default_rng(3)
    X = rng.normal(size=(40, 3))
    y = X @ np.array([1.5, -2.0, 0.3]) + 0.7 + rng.normal(scale=0.5, size=40)
    df = spark.createDataFrame([tuple(map(float, r)) + (float(v),) for r, v in zip(X, y)],
                               "a double, b double, c double, label double")
    data = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    lam = 0.1
    m = LinearRegression(regParam=lam, elasticNetParam=alpha, tol=1e-12, maxIter=1000).fit(data)
    beta, b0 = _cd_elastic_net(X, y, lam, alpha)
    assert np.allclose(m.coefficients.toArray(), beta, atol=1e-5)
    assert m.intercept == pytest.approx(b0, abs=1e-5)


def test_simple_ols_matches_numpy(spark):
    df = stand_in.prepared(spark, SF)
    r = mdl.simple_ols(df, "l_extendedprice").first()
    pdf = df.select("l_extendedprice", "label").toPandas()
    slope, intercept = np.polyfit(pdf["l_extendedprice"], pdf["label"], 1)
    assert r["slope"] == pytest.approx(slope, rel=1e-9)
    assert r["intercept"] == pytest.approx(intercept, rel=1e-6, abs=1e-6)
    assert r["n"] == len(pdf)


def test_metrics_equal_evaluator_and_summary(spark):
    df = stand_in.prepared(spark, SF)
    data = VectorAssembler(inputCols=["l_extendedprice", "l_quantity"], outputCol="features").transform(df)
    m = LinearRegression(regParam=0.1).fit(data)
    pred = m.transform(data)
    ours = metrics.regression_metrics(pred).first()
    for name in ("rmse", "mse", "mae", "r2"):
        ev = RegressionEvaluator(metricName=name).evaluate(pred)
        assert ours[name] == pytest.approx(ev, rel=1e-9)
    assert ours["r2"] == pytest.approx(m.summary.r2, rel=1e-9)


def test_onehot_no_penalty_equals_group_mean(spark):
    df = stand_in.prepared(spark, SF)
    got = {r["l_returnflag"]: r["prediction"] for r in mdl.onehot_group_mean(df, "l_returnflag").collect()}
    exp = {r[0]: r[1] for r in df.groupBy("l_returnflag").agg(F.avg("label")).collect()}
    for k, v in exp.items():
        assert got[k] == pytest.approx(v, rel=1e-9)


@pytest.fixture(scope="module")
def tuned(spark):
    from linfold.plans import regression_job
    from linfold.plans.stand_in import SPEC

    df = stand_in.prepared(spark, SF)
    return regression_job.run(df, SPEC, parallelism=2)


def test_tuning_winner_is_grid_minimum(tuned):
    grid = mdl.grid_metrics(tuned.tuned).collect()
    assert len(grid) == 9
    best = [g for g in grid if g["is_best"]]
    assert len(best) >= 1 and best[0]["value"] == min(g["value"] for g in grid)
    report = mdl.model_report(tuned.tuned).first()
    assert report["regParam"] == best[0]["regParam"]
    assert report["elasticNetParam"] == best[0]["elasticNetParam"]


def test_grid_order_regparam_outer(tuned):
    grid = mdl.grid_metrics(tuned.tuned).collect()
    assert [(g["regParam"], g["elasticNetParam"]) for g in grid] == [
        (r, e) for r in mdl.REG_PARAMS for e in mdl.ELASTIC_NET_PARAMS]


def test_holdout_one_pass_equals_evaluate(tuned):
    prepared = PipelineModel(stages=tuned.model.stages[:-1]).transform(tuned.holdout)
    summ = mdl.regression(tuned.model).evaluate(prepared)
    ours = mdl.holdout_metrics(tuned.model, tuned.holdout).first()
    assert ours["r2"] == pytest.approx(summ.r2, rel=1e-9)
    assert ours["rmse"] == pytest.approx(summ.rootMeanSquaredError, rel=1e-9)


def test_save_reload_predicts_identically(tuned):
    from linfold.sources.models import load_model

    a = tuned.model.transform(tuned.holdout).agg(F.sum("prediction")).first()[0]
    reloaded = load_model(tuned.model_uri)
    b = reloaded.transform(tuned.holdout).agg(F.sum("prediction")).first()[0]
    assert a == b
    rep = mdl.model_report(reloaded).first()  # no training summary after a reload
    assert rep["train_r2"] is None and rep["regParam"] == mdl.model_report(tuned.tuned).first()["regParam"]


def test_coefficient_names_from_metadata(tuned):
    coef = mdl.model_coefficients(tuned.model, tuned.holdout).collect()
    names = [r["feature"] for r in coef]
    assert names[0] == tuned.numeric[0]
    assert any(n.startswith("l_returnflag_vector") for n in names)


def test_batch_score_rebuilds_ratio(spark, tuned):
    from linfold.plans import regression_job
    from linfold.plans.stand_in import SPEC

    unlabelled = stand_in.charges(spark, SF).drop("charge")
    scored = regression_job.score(tuned.model_uri, unlabelled, SPEC)
    assert scored.count() == unlabelled.count()
    assert scored.filter(F.col("prediction").isNull()).count() == 0


def test_category_bound_only_if_asked(spark):
    df = spark.range(500).withColumn("k", F.col("id") % 3).withColumn("s", F.col("id").cast("string"))
    assert encode.check_category_bounds(df, ["k"], 100)["k"] == 3
    with pytest.raises(ValueError):
        encode.check_category_bounds(df, ["id"], max_categories=100)
    _, indexed = encode.index_categories(df, ["s"])
    assert indexed.count() == 500


def test_distributed_ranking_equals_a_plain_one(spark):
    from pyspark.sql import Window

    df = stand_in.prepared(spark, SF).repartition(4)
    cols = ["l_returnflag", "l_linenumber", "l_quantity", "row_key"]
    got = {(r["column_name"], r["category"]): (r["n"], r["category_index"])
           for r in encode.category_frequencies(df, cols).collect()}
    want = {}
    for c in cols:
        per = df.groupBy(F.col(c).cast("string").alias("v")).count()
        rank = F.row_number().over(Window.orderBy(F.desc("count"), "v")) - 1
        want.update({(c, r["v"]): (r["count"], float(r["i"])) for r in per.withColumn("i", rank).collect()})
    assert got == want


def test_tuning_does_not_depend_on_the_layout(spark):
    from linfold.plans import regression_job
    from linfold.plans.stand_in import SPEC

    df = stand_in.prepared(spark, SF)
    one = regression_job.fit(df, SPEC, ["l_extendedprice", "unit_price"])[0]
    other = regression_job.fit(df.repartition(7, "l_partkey"), SPEC, ["l_extendedprice", "unit_price"])[0]
    for a, b in zip(one.grid, other.grid):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], rel=1e-8)
    assert one.best == other.best


@pytest.mark.parametrize("missing", ["skip", "mean", "error"])
def test_missing_features_in_fit_and_score(spark, missing):
    rows = [(i, None if i % 10 == 0 else float(i), 2.0 * i + 1) for i in range(200)]
    df = spark.createDataFrame(rows, "k long, x double, label double")
    if missing == "error":
        with pytest.raises(Exception, match="null|NaN|Encountered"):
            mdl.tune(df, "k", ["x"], missing=missing)
        return
    tuned = mdl.tune(df, "k", ["x"], missing=missing)
    scored = tuned.model.transform(df.drop("label")).select("k", "prediction").collect()
    assert len(scored) == (180 if missing == "skip" else 200)
    m = mdl.holdout_metrics(tuned.model, df).first()
    assert m["n"] == len(scored) and m["n_missing"] == 0 and m["rmse"] is not None


def test_a_missing_feature_has_no_prediction_and_is_counted(spark):
    from linfold.operators.metrics import regression_metrics

    df = spark.createDataFrame([(1.0, 3.0), (2.0, 5.0), (3.0, 7.0), (None, 9.0), (float("nan"), 1.0)], "x double, label double")
    p = mdl.ols_predict(df, "x", keep=["x"])
    assert [r["prediction"] is None for r in p.collect()] == [False, False, False, True, True]
    m = regression_metrics(p).first()
    assert (m["n"], m["n_missing"]) == (3, 2) and m["rmse"] == pytest.approx(0, abs=1e-9)


def test_pipeline_scores_a_category_unseen_in_training(spark):
    """The source job's default indexer fails when holdout holds a category training lacked."""
    from linfold.plans.stand_in import SPEC

    df = stand_in.prepared(spark, SF)
    train = df.filter(F.col("l_linenumber") != 7)
    unseen = df.filter(F.col("l_linenumber") == 7)
    model = mdl.tune(train, "row_key", ["l_extendedprice"], SPEC.binary, SPEC.categorical,
                     reg_params=(0.1,), elastic_net_params=(0.0,)).model
    scored = model.transform(unseen)
    assert scored.count() == unseen.count() > 0
    assert scored.filter(F.col("prediction").isNull()).count() == 0


def test_explore_outputs(spark):
    from linfold.plans import regression_job
    from linfold.plans.stand_in import SPEC

    out = regression_job.explore(stand_in.prepared(spark, SF), SPEC)
    assert {"profile", "cardinality", "times", "label_corr"} == set(out)
    assert out["label_corr"].count() == len(SPEC.correlation_candidates()) + 1
    assert out["cardinality"].filter("column_name = 'l_returnflag'").first()["n_distinct"] == 3
