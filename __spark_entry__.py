"""

Every query reads the driver's tables (``lineitem``, ``part``) through the
stand-in regression frame in ``linfold.plans.stand_in``. Computed doubles are
rounded identically on both sides where the two engines sum in a different order.
The model queries tune an elastic net on one feature, whose solution has a closed
form that SQL can state; each query runs its own fit. Timestamps are compared as text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linfold.operators import correlate, encode, metrics, model as mdl, profile, split
from linfold.operators.project import drop_columns, project_roles
from linfold.operators.runs import best_run, delete_runs, log_runs
from linfold.plans import regression_job, stand_in
from linfold.plans.stand_in import SPEC
from linfold.session import fresh_name, shared_dir
from linfold.sources import catalog, csv, tables, versions
from linfold.sources.preview import ordered_preview
from linfold.sources.models import load_model, save_model
from linfold.spec import FeatureSpec

# The text operators are optional: without their subpackage, all other queries still work.
try:
    from linfold.llm import queries as llm_queries
except ImportError as missing:
    if missing.name != "linfold.llm":
        raise
    llm_queries = None
try:
    import corpus_pipeline
except ImportError as missing:
    if missing.name not in ("linfold.llm", "corpus_pipeline"):
        raise
    corpus_pipeline = None

SF_SMOKE = "/root/testdata/sf0.001"

# Analysis settings (ours; the source job chose by eye).
WEAK_CORR = 0.1
REDUNDANT_CORR = 0.9
OLS_FEATURE = "l_extendedprice"
INDEX_COLUMNS = ("l_returnflag", "l_linestatus", "l_linenumber")
ONE_HOT_COLUMNS = ("l_returnflag", "l_linestatus")
PART_INDEX_COLUMNS = ("p_brand", "p_size")
ASSEMBLED = ("l_extendedprice", "unit_price", "is_open")
WORK_DB = "linfold_work"

SCREEN = stand_in.screen_columns()
CHARGE_COLS = ["row_key", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
               "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
               "disc_price", "is_open", "charge"]


def _r(c, d):
    return F.round(F.col(c), d).alias(c)


# Rounding by magnitude for statistics of decimal data: small values keep more places
# (exact means of 2-decimal data end by the 7th place, so 8+ places never tie), large
# values fewer (their last bits differ with the summation order). Same tiers in SQL.
_TIERS = ((1.0, 10), (1e3, 8), (1e6, 5))


def _tiered(c):
    x = F.col(c)
    expr = F.round(x, 2)
    for bound, places in reversed(_TIERS):
        expr = F.when(F.abs(x) < bound, F.round(x, places)).otherwise(expr)
    return expr.alias(c)


def _sql_tiered(e: str) -> str:
    whens = " ".join(f"WHEN abs({e}) < {b} THEN round({e}, {p})" for b, p in _TIERS)
    return f"CASE {whens} ELSE round({e}, 2) END"


def _told(df: DataFrame) -> DataFrame:
    """The frame with its timestamp as text, in a form that both engines write."""
    return df.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))


def _work_db(spark: SparkSession) -> str:
    return catalog.create_namespace(spark, WORK_DB, location=shared_dir(spark, "warehouse", f"{WORK_DB}.db"))


# --- sources, projections -------------------------------------------------------------

def q_csv_scan(spark, sf_dir):
    src = stand_in.charges(spark, sf_dir)
    path = shared_dir(spark, "csv", fresh_name("charges"))
    csv.write_csv(src, path)
    return _told(csv.read_csv(spark, path, schema=src.schema))


def _labelled_table(spark, sf_dir) -> str:
    """A table of its own for each call: nothing that an earlier query left is read or replaced."""
    name = fresh_name("charges")
    tables.create_table(stand_in.charges(spark, sf_dir), name, _work_db(spark))
    return name


def _unlabelled_table(spark, sf_dir) -> str:
    name = fresh_name("charges_unlabeled")
    tables.create_unlabeled_table(stand_in.charges(spark, sf_dir), name, stand_in.RAW_LABEL, _work_db(spark))
    return name


def q_table_ctas(spark, sf_dir):
    return _told(tables.read_table(spark, _labelled_table(spark, sf_dir), WORK_DB))


def q_unlabeled_ctas(spark, sf_dir):
    return _told(tables.read_table(spark, _unlabelled_table(spark, sf_dir), WORK_DB))


def q_table_replace(spark, sf_dir):
    """A table replaced by a version of other columns that reads the version before it."""
    name, db = fresh_name("charges_versions"), _work_db(spark)
    versions.replace_table(stand_in.charges(spark, sf_dir).withColumn("extra", F.lit(1)), name, db)
    current = versions.replace_table(tables.read_table(spark, name, db).drop("extra"), name, db)
    versions.remove_old(spark, name, current, db)
    return _told(tables.read_table(spark, name, db))


INFERRED = ("row_key", "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate", "charge")


def _csv_lines(spark, sf_dir) -> str:
    """Charges as lines of CSV, and a malformed line (too short) for each first line of an order."""
    src = _told(stand_in.charges(spark, sf_dir))
    lines = src.select(F.concat_ws(",", *[F.col(c).cast("string") for c in INFERRED]).alias("value"))
    bad = src.where("l_linenumber = 1").select(F.concat_ws(",", F.lit("broken"), "row_key").alias("value"))
    path = shared_dir(spark, "csv", fresh_name("lines"))
    lines.unionByName(bad).write.text(path)
    return path


def q_csv_infer(spark, sf_dir):
    good, _ = csv.read_csv_inferred(spark, _csv_lines(spark, sf_dir), names=INFERRED, header=False)
    return good.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))


def q_csv_malformed(spark, sf_dir):
    return csv.read_csv_inferred(spark, _csv_lines(spark, sf_dir), names=INFERRED, header=False)[1]


def q_table_scan(spark, sf_dir):
    return _told(spark.sql(f"SELECT * FROM {WORK_DB}.{_labelled_table(spark, sf_dir)}"))


def q_preview_topk(spark, sf_dir):
    return ordered_preview(_told(stand_in.prepared(spark, sf_dir)), "row_key", 20)


def q_label_rename(spark, sf_dir):
    return _told(stand_in.labelled(spark, sf_dir))


def q_drop_columns(spark, sf_dir):
    return drop_columns(stand_in.labelled(spark, sf_dir), *SPEC.ignored)


def q_ratio_feature(spark, sf_dir):
    return stand_in.prepared(spark, sf_dir).select("row_key", "l_extendedprice", "l_quantity", "unit_price")


def q_feature_projection(spark, sf_dir):
    return project_roles(stand_in.prepared(spark, sf_dir), SPEC)


# --- profiles and correlations ----------------------------------------------------------

PROFILE_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                   "l_discount", "l_tax", "disc_price", "is_open", "label", "unit_price"]
PROFILE_STRING = ["row_key", "l_returnflag", "l_linestatus"]
CARDINALITY = ["l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "is_open",
               "l_extendedprice", "row_key"]


def q_profile_numeric(spark, sf_dir):
    p = profile.profile_numeric(stand_in.prepared(spark, sf_dir), PROFILE_NUMERIC)
    return p.select("column_name", "n", "n_null", _tiered("mean"), _tiered("stddev"), "min_value", "max_value")


def q_profile_string(spark, sf_dir):
    return profile.profile_string(stand_in.prepared(spark, sf_dir), PROFILE_STRING)


def q_profile_cardinality(spark, sf_dir):
    p = profile.profile_cardinality(stand_in.prepared(spark, sf_dir), CARDINALITY, exact=True)
    return p.select("column_name", "n", "n_distinct", "n_null", "n_zero", _r("null_share", 6), _r("zero_share", 6))


def q_profile_ranges(spark, sf_dir):
    """Counts and ranges of merged states: one for the first lines of orders, one for the others."""
    df = stand_in.prepared(spark, sf_dir)
    parts = [profile.profile_state(df.where(c), PROFILE_NUMERIC) for c in ("l_linenumber = 1", "l_linenumber <> 1")]
    return profile.profile_ranges(profile.merge_states(*parts)).select("column_name", "n", "n_null", "n_zero", "min_value", "max_value")


def q_corr_with_label(spark, sf_dir):
    r = correlate.corr_with_label(stand_in.prepared(spark, sf_dir), "label", SCREEN[1:])
    return r.select("column_name", "n", _r("corr", 6))


def q_corr_matrix(spark, sf_dir):
    r = correlate.corr_matrix(stand_in.prepared(spark, sf_dir), SCREEN)
    return r.select("col_a", "col_b", "n", _r("corr", 6))


def q_select_by_label_corr(spark, sf_dir):
    lc = correlate.corr_with_label(stand_in.prepared(spark, sf_dir), "label", SCREEN[1:])
    return correlate.select_by_label_corr(lc, WEAK_CORR).select("column_name", _r("corr", 6), _r("abs_corr", 6))


def _screened(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(screened features, matrix) from one scan; the matrix is a row for each pair of columns."""
    found = correlate.corr_matrix(stand_in.prepared(spark, sf_dir), SCREEN)
    matrix = spark.createDataFrame(found.collect(), found.schema)
    screened = correlate.select_by_label_corr(correlate.label_row(matrix, "label"), WEAK_CORR)
    return screened.select("column_name", "corr"), matrix


def q_redundant_features(spark, sf_dir):
    red = correlate.redundant_features(*_screened(spark, sf_dir), REDUNDANT_CORR)
    return red.select("column_name", _r("label_corr", 6), "rank", "keep", "dominated_by")


def q_redundant_greedy(spark, sf_dir):
    red = correlate.redundant_greedy(*_screened(spark, sf_dir), REDUNDANT_CORR)
    return red.select("column_name", _r("label_corr", 6), "rank", "keep", "dominated_by")


def q_profile_time(spark, sf_dir):
    p = profile.profile_time(stand_in.prepared(spark, sf_dir), ["l_shipdate"])
    return p.select("column_name", "n", "n_null", "n_distinct",
                    *[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("min_value", "max_value")])


# --- splits -------------------------------------------------------------------------------

# The split queries use the portable md5 hash: it is the form another engine (the
# DuckDB twin) can reproduce; the library's default hash is Spark's xxhash64.
PORTABLE = "md5"


def q_split_train(spark, sf_dir):
    return _told(split.hash_split(stand_in.prepared(spark, sf_dir), "row_key", hash_fn=PORTABLE)[0])


def q_split_holdout(spark, sf_dir):
    return _told(split.hash_split(stand_in.prepared(spark, sf_dir), "row_key", hash_fn=PORTABLE)[1])


def q_split_exact(spark, sf_dir):
    """The larger side of a split of exact size."""
    return _told(split.exact_split(stand_in.prepared(spark, sf_dir), "row_key", hash_fn=PORTABLE)[0])


def q_split_summary(spark, sf_dir):
    s = split.split_summary(stand_in.prepared(spark, sf_dir), "row_key", "label", hash_fn=PORTABLE)
    return s.select("side", "n", _r("mean_label", 6))


def q_split_default_check(spark, sf_dir):
    """The default hash (xxhash64, which no other engine has): its sides are disjoint, complete and near their shares."""
    df = stand_in.prepared(spark, sf_dir)
    sides = split.hash_split(df, "row_key")
    keys = [s.select("row_key", F.lit(i).alias("side")) for i, s in enumerate(sides)]
    told = keys[0].unionByName(keys[1]).groupBy("row_key").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("side").alias("sides"), F.min("side").alias("side"))
    return told.agg(F.sum("rows").alias("n_rows"), F.count_if(F.col("sides") > 1).alias("n_on_two_sides"),
                    (F.abs(F.avg("side") - 0.3) < 0.02).alias("near_share"))


def q_namespace_lifecycle(spark, sf_dir):
    """A namespace of a user's name, a table in it, then drop both."""
    user = catalog.namespace_for(fresh_name("Some.User@"))
    db = catalog.create_namespace(spark, user, location=shared_dir(spark, "warehouse", fresh_name("db")))
    tables.create_table(stand_in.charges(spark, sf_dir), "charges", db)
    n = tables.read_table(spark, "charges", db).count()
    made = spark.catalog.tableExists(f"{db}.charges")
    tables.drop_table(spark, "charges", db)
    left = spark.catalog.tableExists(f"{db}.charges")
    tables.create_table(stand_in.charges(spark, sf_dir), "charges", db)  # the cascade takes this one along
    catalog.drop_namespace(spark, db)
    return spark.createDataFrame([(n, made, left, spark.catalog.databaseExists(db))],
                                 "n_rows bigint, made boolean, left_after_drop boolean, namespace_left boolean")


# --- categorical encodings ------------------------------------------------------------------

def q_category_index(spark, sf_dir):
    return encode.category_frequencies(stand_in.prepared(spark, sf_dir), INDEX_COLUMNS)


def q_category_index_apply(spark, sf_dir):
    part = stand_in.table(spark, sf_dir, "part").select("p_partkey", *PART_INDEX_COLUMNS)
    _, indexed = encode.index_categories(part, PART_INDEX_COLUMNS)
    return indexed


ENCODED = ("l_partkey", "l_returnflag")


def q_category_encode(spark, sf_dir):
    """Dictionary encoding: the 1,024 most frequent parts broadcast, the others looked up through a shuffle."""
    df = stand_in.prepared(spark, sf_dir).select("row_key", *ENCODED)
    return encode.encode_categories(df, ENCODED, heavy=2048)


def _one_hot_frame(spark, sf_dir):
    df = stand_in.prepared(spark, sf_dir)
    # The source job's indexer default: an unseen value is an error, so k categories
    # give k - 1 one-hot slots (with "keep" an extra unknown value would add a slot).
    stages = [encode.category_indexer(ONE_HOT_COLUMNS, handle_invalid="error"),
              encode.one_hot_encoder(ONE_HOT_COLUMNS)]
    from pyspark.ml import Pipeline
    return Pipeline(stages=stages).fit(df).transform(df)


def q_one_hot(spark, sf_dir):
    enc = _one_hot_frame(spark, sf_dir)
    cols = [F.col("row_key")]
    for c in ONE_HOT_COLUMNS:
        v = encode.vector_name(c)
        arr = encode.vector_to_array(F.col(v))
        cols += [arr.getItem(i).alias(f"{v}_{i}") for i in range(encode.vector_size(enc, v))]
    return enc.select(*cols)


def q_assembled_features(spark, sf_dir):
    enc = _one_hot_frame(spark, sf_dir)
    inputs = list(ASSEMBLED) + [encode.vector_name(c) for c in ONE_HOT_COLUMNS]
    out = encode.feature_assembler(inputs).transform(enc)
    return encode.unpack_vector(out, "features", encode.vector_size(out, "features"), "f", keep=["row_key"])


# --- models with SQL identities -----------------------------------------------------------------

def q_ols_simple(spark, sf_dir):
    r = mdl.simple_ols(stand_in.prepared(spark, sf_dir), OLS_FEATURE)
    return r.select("feature", _r("slope", 6), _r("intercept", 4), _r("r2", 6), "n")


def q_ols_predict(spark, sf_dir):
    p = mdl.ols_predict(stand_in.prepared(spark, sf_dir), OLS_FEATURE, keep=["row_key"])
    return p.select("row_key", _r("prediction", 2))


def q_residuals(spark, sf_dir):
    p = mdl.ols_predict(stand_in.prepared(spark, sf_dir), OLS_FEATURE, keep=["row_key"])
    return p.select("row_key", "label", _r("prediction", 2), _r("residual", 2))


def q_onehot_group_mean(spark, sf_dir):
    g = mdl.onehot_group_mean(stand_in.prepared(spark, sf_dir), "l_returnflag")
    return g.select("l_returnflag", "n", _r("prediction", 4))


def q_regression_metrics(spark, sf_dir):
    train, holdout = split.hash_split(stand_in.prepared(spark, sf_dir), "row_key", hash_fn=PORTABLE)
    fitted = mdl.simple_ols(train, OLS_FEATURE).first()
    m = metrics.regression_metrics(mdl.ols_apply(holdout, OLS_FEATURE, fitted["slope"], fitted["intercept"]))
    return m.select("n", _r("mse", 2), _r("rmse", 4), _r("mae", 4), _r("r2", 6))


# --- tuned model and what follows from it ----------------------------------------------------------

TUNE_SPEC = FeatureSpec(label="label", key="row_key", numeric=(OLS_FEATURE,))


def _tuned(spark, sf_dir):
    """(tuned, train, holdout) of this call's own fit."""
    return regression_job.fit(stand_in.prepared(spark, sf_dir), TUNE_SPEC, [OLS_FEATURE], split_hash=PORTABLE)


def _saved(spark, sf_dir) -> tuple[str, DataFrame]:
    tuned, _, holdout = _tuned(spark, sf_dir)
    return save_model(tuned.model, shared_dir(spark, "models", fresh_name("pipeline"))), holdout


def q_tuned_grid_metrics(spark, sf_dir):
    return mdl.grid_metrics(_tuned(spark, sf_dir)[0]).select(
        "regParam", "elasticNetParam", "metric", _r("value", 5), "is_best")


def q_model_report(spark, sf_dir):
    r = mdl.model_report(_tuned(spark, sf_dir)[0])
    return r.select(_r("train_r2", 8), _r("train_rmse", 4), "regParam", "elasticNetParam", _r("intercept", 4),
                    "n_features", "n_train")


def q_model_coefficients(spark, sf_dir):
    tuned, _, holdout = _tuned(spark, sf_dir)
    return mdl.model_coefficients(tuned.model, holdout).select("slot", "feature", _r("coefficient", 8))


def q_holdout_metrics(spark, sf_dir):
    tuned, _, holdout = _tuned(spark, sf_dir)
    m = mdl.holdout_metrics(tuned.model, holdout)
    return m.select("n", _r("mse", 2), _r("rmse", 4), _r("mae", 4), _r("r2", 6), "n_missing")


def q_scored_after_reload(spark, sf_dir):
    uri, holdout = _saved(spark, sf_dir)
    return load_model(uri).transform(holdout).select("row_key", _r("prediction", 2))


def q_batch_score(spark, sf_dir):
    """New rows: the unlabelled copy of the rows that the model was not trained on."""
    uri, _ = _saved(spark, sf_dir)
    unlabelled = tables.read_table(spark, _unlabelled_table(spark, sf_dir), WORK_DB)
    new = split.hash_split(unlabelled, "row_key", hash_fn=PORTABLE)[1]
    return regression_job.score(uri, new, TUNE_SPEC).select("row_key", _r("prediction", 2))


# The whole set of inputs: numbers, a derived ratio, a 0/1 column and three one-hot categories. Ridge penalties,
# whose solution SQL can state as normal equations.
FULL_NUMERIC = ("l_extendedprice", "l_quantity", "l_discount", "l_tax", "unit_price")
RIDGE = {"elastic_net_params": (0.0,)}


def _full(spark, sf_dir):
    return regression_job.fit(stand_in.prepared(spark, sf_dir), SPEC, FULL_NUMERIC, split_hash=PORTABLE, **RIDGE)


def q_full_grid_metrics(spark, sf_dir):
    return mdl.grid_metrics(_full(spark, sf_dir)[0]).select("regParam", "elasticNetParam", _r("value", 5), "is_best")


def q_full_coefficients(spark, sf_dir):
    """Named coefficients of every slot of the winner."""
    tuned, _, holdout = _full(spark, sf_dir)
    return mdl.model_coefficients(tuned.model, holdout).select("slot", "feature", _r("coefficient", 4))


def q_full_report(spark, sf_dir):
    r = mdl.model_report(_full(spark, sf_dir)[0])
    return r.select(_r("train_r2", 8), _r("train_rmse", 4), "regParam", "elasticNetParam", _r("intercept", 3),
                    "n_features", "n_train")


def q_full_holdout_metrics(spark, sf_dir):
    tuned, _, holdout = _full(spark, sf_dir)
    m = mdl.holdout_metrics(tuned.model, holdout)
    return m.select("n", _r("rmse", 4), _r("mae", 4), _r("r2", 8), "n_missing")


def q_full_batch_score(spark, sf_dir):
    """Unlabelled rows scored by the reloaded model; their ratio column is derived again."""
    tuned, _, _ = _full(spark, sf_dir)
    uri = save_model(tuned.model, shared_dir(spark, "models", fresh_name("pipeline")))
    unlabelled = tables.read_table(spark, _unlabelled_table(spark, sf_dir), WORK_DB)
    new = split.hash_split(unlabelled, "row_key", hash_fn=PORTABLE)[1]
    return regression_job.score(uri, new, SPEC).select("row_key", _r("prediction", 2))


def _logged(spark, sf_dir, experiments) -> str:
    """The grid points of a fit as runs of each experiment, in a run log of its own."""
    tuned = _tuned(spark, sf_dir)[0]
    runs = fresh_name("model_runs")
    log_runs(spark, runs, [(e, {"regParam": r, "elasticNetParam": a}, {tuned.metric: v}, None)
                           for e in experiments for r, a, v in tuned.grid], _work_db(spark))
    return runs


def _runs_told(df: DataFrame) -> DataFrame:
    return df.select("experiment", F.col("params")["regParam"].cast("double").alias("regParam"),
                     F.col("params")["elasticNetParam"].cast("double").alias("elasticNetParam"),
                     F.round(F.col("metrics")["rmse"], 5).alias("rmse"))


def q_best_run(spark, sf_dir):
    runs = _logged(spark, sf_dir, ["grid", "other"])
    return _runs_told(best_run(tables.read_table(spark, runs, WORK_DB), "rmse", "grid"))


def q_runs_after_delete(spark, sf_dir):
    """Log the grid as runs of two experiments, delete every run of the first: the rest remains."""
    runs = _logged(spark, sf_dir, ["gone", "kept"])
    delete_runs(spark, runs, "gone", WORK_DB)
    return _runs_told(tables.read_table(spark, runs, WORK_DB))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "csv_scan": q_csv_scan,
        "table_ctas": q_table_ctas,
        "unlabeled_ctas": q_unlabeled_ctas,
        "table_scan": q_table_scan,
        "table_replace": q_table_replace,
        "csv_infer": q_csv_infer,
        "csv_malformed": q_csv_malformed,
        "preview_topk": q_preview_topk,
        "label_rename": q_label_rename,
        "drop_columns": q_drop_columns,
        "ratio_feature": q_ratio_feature,
        "feature_projection": q_feature_projection,
        "profile_numeric": q_profile_numeric,
        "profile_string": q_profile_string,
        "profile_cardinality": q_profile_cardinality,
        "profile_ranges": q_profile_ranges,
        "profile_time": q_profile_time,
        "corr_with_label": q_corr_with_label,
        "corr_matrix": q_corr_matrix,
        "select_by_label_corr": q_select_by_label_corr,
        "redundant_features": q_redundant_features,
        "redundant_greedy": q_redundant_greedy,
        "split_train": q_split_train,
        "split_holdout": q_split_holdout,
        "split_summary": q_split_summary,
        "split_exact": q_split_exact,
        "category_index": q_category_index,
        "category_index_apply": q_category_index_apply,
        "category_encode": q_category_encode,
        "one_hot": q_one_hot,
        "assembled_features": q_assembled_features,
        "ols_simple": q_ols_simple,
        "ols_predict": q_ols_predict,
        "residuals": q_residuals,
        "onehot_group_mean": q_onehot_group_mean,
        "regression_metrics": q_regression_metrics,
        "tuned_grid_metrics": q_tuned_grid_metrics,
        "model_report": q_model_report,
        "model_coefficients": q_model_coefficients,
        "holdout_metrics": q_holdout_metrics,
        "scored_after_reload": q_scored_after_reload,
        "batch_score": q_batch_score,
        "full_grid_metrics": q_full_grid_metrics,
        "full_coefficients": q_full_coefficients,
        "full_report": q_full_report,
        "full_holdout_metrics": q_full_holdout_metrics,
        "full_batch_score": q_full_batch_score,
        "split_default_check": q_split_default_check,
        "namespace_lifecycle": q_namespace_lifecycle,
        "best_run": q_best_run,
        "runs_after_delete": q_runs_after_delete,
        **(llm_queries.QUERIES if llm_queries else {}),
        **({"pipeline": corpus_pipeline.run} if corpus_pipeline else {}),
    }


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: correlation of every screened column with the label, one pass."""
    return q_corr_with_label(spark, SF_SMOKE)


# --- DuckDB twins ---------------------------------------------------------------------------------

_CHARGES = """
charges AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_key,
         l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
         l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate,
         l_extendedprice * (1 - l_discount) AS disc_price,
         CAST(l_linestatus = 'O' AS INTEGER) AS is_open,
         l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge
  FROM lineitem),
labelled AS (SELECT * EXCLUDE (charge), charge AS label FROM charges),
prepared AS (SELECT *, l_extendedprice / nullif(CAST(l_quantity AS DOUBLE), 0) AS unit_price FROM labelled),
bucketed AS (SELECT *, ('0x' || substr(md5(row_key), 1, 8))::BIGINT / 4294967296::DOUBLE AS share FROM prepared)"""


def _with(body: str) -> str:
    return f"WITH {_CHARGES}\n{body}"


def _sql_profile_numeric() -> str:
    parts = [f"SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS n, "
             f"CAST(count(*) - count({c}) AS BIGINT) AS n_null, {_sql_tiered(f'avg(CAST({c} AS DOUBLE))')} AS mean, "
             f"{_sql_tiered(f'stddev_samp(CAST({c} AS DOUBLE))')} AS stddev, CAST(min({c}) AS DOUBLE) AS min_value, "
             f"CAST(max({c}) AS DOUBLE) AS max_value FROM prepared" for c in PROFILE_NUMERIC]
    return _with("\nUNION ALL\n".join(parts))


def _sql_profile_string() -> str:
    parts = [f"SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS n, "
             f"CAST(count(*) - count({c}) AS BIGINT) AS n_null, min({c}) AS min_value, max({c}) AS max_value, "
             f"CAST(max(length({c})) AS BIGINT) AS max_length FROM prepared" for c in PROFILE_STRING]
    return _with("\nUNION ALL\n".join(parts))


def _sql_profile_cardinality() -> str:
    numeric = {"l_linenumber", "l_quantity", "l_discount", "l_tax", "is_open", "l_extendedprice"}
    parts = []
    for c in CARDINALITY:
        zero = f"CAST(sum(CAST({c} = 0 AS BIGINT)) AS BIGINT)" if c in numeric else "CAST(NULL AS BIGINT)"
        parts.append(
            f"SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS n, CAST(count(DISTINCT {c}) AS BIGINT) "
            f"AS n_distinct, CAST(count(*) - count({c}) AS BIGINT) AS n_null, {zero} AS n_zero, "
            f"round((count(*) - count({c})) / count(*), 6) AS null_share, "
            f"round({zero} / count(*), 6) AS zero_share FROM prepared")
    return _with("\nUNION ALL\n".join(parts))


def _sql_corr(a: str, b: str) -> str:
    if a == b:
        return f"CASE WHEN var_pop({a}) > 0 THEN CAST(1 AS DOUBLE) END"
    return f"greatest(CAST(-1 AS DOUBLE), least(CAST(1 AS DOUBLE), corr({a}, {b})))"


def _sql_corr_with_label() -> str:
    parts = [f"SELECT '{c}' AS column_name, CAST(regr_count(label, {c}) AS BIGINT) AS n, "
             f"round({_sql_corr('label', c)}, 6) AS corr FROM prepared" for c in SCREEN]
    return _with("\nUNION ALL\n".join(parts))


def _sql_corr_matrix() -> str:
    parts = [f"SELECT '{a}' AS col_a, '{b}' AS col_b, CAST(regr_count({a}, {b}) AS BIGINT) AS n, "
             f"round({_sql_corr(a, b)}, 6) AS corr FROM prepared" for a in SCREEN for b in SCREEN]
    return _with("\nUNION ALL\n".join(parts))


def _sql_label_corr_cte() -> str:
    parts = [f"SELECT '{c}' AS column_name, corr(label, {c}) AS corr FROM prepared" for c in SCREEN[1:]]
    return "lc AS (" + "\nUNION ALL\n".join(parts) + ")"


def _sql_select_by_label_corr() -> str:
    return _with(f", {_sql_label_corr_cte()}\n"
                 f"SELECT column_name, round(corr, 6) AS corr, round(abs(corr), 6) AS abs_corr FROM lc "
                 f"WHERE abs(corr) >= {WEAK_CORR}")


def _sql_redundant_features() -> str:
    pairs = [f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr({a}, {b}) AS corr FROM prepared"
             for a in SCREEN[1:] for b in SCREEN[1:] if a != b]
    return _with(f""", {_sql_label_corr_cte()},
m AS ({" UNION ALL ".join(pairs)}),
s AS (SELECT column_name, corr FROM lc WHERE abs(corr) >= {WEAK_CORR}),
r AS (SELECT column_name, corr, row_number() OVER (ORDER BY abs(corr) DESC, column_name) AS rank FROM s),
d AS (SELECT f.column_name, arg_min(g.column_name, g.rank) AS dominated_by
      FROM r f JOIN m ON m.col_a = f.column_name JOIN r g ON g.column_name = m.col_b
      WHERE abs(m.corr) >= {REDUNDANT_CORR} AND g.rank < f.rank GROUP BY f.column_name)
SELECT r.column_name, round(r.corr, 6) AS label_corr, CAST(r.rank AS INTEGER) AS rank,
       d.dominated_by IS NULL AS keep, d.dominated_by
FROM r LEFT JOIN d ON d.column_name = r.column_name""")


def _sql_redundant_greedy() -> str:
    pairs = [f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr({a}, {b}) AS corr FROM prepared"
             for a in SCREEN[1:] for b in SCREEN[1:] if a != b]
    body = _with(f""", {_sql_label_corr_cte()},
m AS ({" UNION ALL ".join(pairs)}),
r AS (SELECT column_name, corr, row_number() OVER (ORDER BY abs(corr) DESC, column_name) AS rank FROM lc
      WHERE abs(corr) >= {WEAK_CORR}),
c AS (SELECT r.column_name, r.corr, r.rank, coalesce(list(m.col_b) FILTER (m.col_b IS NOT NULL), []::VARCHAR[]) AS clashes
      FROM r LEFT JOIN m ON m.col_a = r.column_name AND abs(m.corr) >= {REDUNDANT_CORR}
      GROUP BY r.column_name, r.corr, r.rank),
walk AS (SELECT 0::BIGINT AS rank, []::VARCHAR[] AS kept
         UNION ALL
         SELECT c.rank, CASE WHEN list_has_any(walk.kept, c.clashes) THEN walk.kept
                             ELSE list_append(walk.kept, c.column_name) END
         FROM walk JOIN c ON c.rank = walk.rank + 1)
SELECT c.column_name, round(c.corr, 6) AS label_corr, CAST(c.rank AS INTEGER) AS rank,
       list_contains(walk.kept, c.column_name) AS keep,
       CASE WHEN NOT list_contains(walk.kept, c.column_name)
            THEN [x FOR x IN walk.kept IF list_contains(c.clashes, x)][1] END AS dominated_by
FROM c JOIN walk ON walk.rank = c.rank""")
    return body.replace("WITH ", "WITH RECURSIVE ", 1)


def _sql_category_index() -> str:
    parts = [f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS category, CAST(count(*) AS BIGINT) AS n "
             f"FROM prepared WHERE {c} IS NOT NULL GROUP BY {c}" for c in INDEX_COLUMNS]
    return _with(", f AS (" + " UNION ALL ".join(parts) + ")\n"
                 "SELECT column_name, category, n, CAST(row_number() OVER (PARTITION BY column_name "
                 "ORDER BY n DESC, category) - 1 AS DOUBLE) AS category_index FROM f")


def _sql_category_index_apply() -> str:
    ctes = []
    for c in PART_INDEX_COLUMNS:
        ctes.append(f"i_{c} AS (SELECT CAST({c} AS VARCHAR) AS v, CAST(row_number() OVER "
                    f"(ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) - 1 AS DOUBLE) AS idx FROM part GROUP BY {c})")
    sel = ", ".join(f"i_{c}.idx AS {c}_index" for c in PART_INDEX_COLUMNS)
    joins = " ".join(f"LEFT JOIN i_{c} ON i_{c}.v = CAST(part.{c} AS VARCHAR)" for c in PART_INDEX_COLUMNS)
    return (f"WITH {', '.join(ctes)}\nSELECT part.p_partkey, part.p_brand, part.p_size, {sel} "
            f"FROM part {joins}")


def _sql_index_ctes(cols) -> str:
    return ", ".join(
        f"i_{c} AS (SELECT {c} AS v, row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) - 1 AS idx "
        f"FROM prepared GROUP BY {c})" for c in cols)


# Category counts of the one-hot columns in the driver's lineitem table.
ONE_HOT_SIZES = {"l_returnflag": 3, "l_linestatus": 2}


def _sql_one_hot_cols() -> list[str]:
    out = []
    for c in ONE_HOT_COLUMNS:
        for i in range(ONE_HOT_SIZES[c] - 1):
            out.append(f"CASE WHEN i_{c}.idx = {i} THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS {c}_vector_{i}")
    return out


def _sql_one_hot_from() -> str:
    return "prepared " + " ".join(f"JOIN i_{c} ON i_{c}.v = prepared.{c}" for c in ONE_HOT_COLUMNS)


def _sql_one_hot() -> str:
    return _with(f", {_sql_index_ctes(ONE_HOT_COLUMNS)}\n"
                 f"SELECT prepared.row_key, {', '.join(_sql_one_hot_cols())} FROM {_sql_one_hot_from()}")


def _sql_assembled() -> str:
    base = [f"CAST({c} AS DOUBLE)" for c in ASSEMBLED]
    hot = [e.rsplit(" AS ", 1)[0] for e in _sql_one_hot_cols()]
    cols = ", ".join(f"{e} AS f_{i}" for i, e in enumerate(base + hot))
    return _with(f", {_sql_index_ctes(ONE_HOT_COLUMNS)}\nSELECT prepared.row_key, {cols} FROM {_sql_one_hot_from()}")


_OLS_FIT = f"""fit AS (SELECT regr_slope(label, {OLS_FEATURE}) AS slope, regr_intercept(label, {OLS_FEATURE}) AS intercept
              FROM prepared)"""


def _sql_ols_simple() -> str:
    return _with(f""", {_OLS_FIT},
pred AS (SELECT label, fit.intercept + fit.slope * {OLS_FEATURE} AS prediction FROM prepared, fit)
SELECT '{OLS_FEATURE}' AS feature, round(any_value(fit.slope), 6) AS slope, round(any_value(fit.intercept), 4) AS intercept,
       round(1 - sum((label - prediction) * (label - prediction)) / (var_pop(label) * count(*)), 6) AS r2,
       CAST(count(*) AS BIGINT) AS n
FROM pred, fit""")


def _sql_ols_predict(with_residual: bool) -> str:
    pred = f"fit.intercept + fit.slope * {OLS_FEATURE}"
    extra = f", label, round(label - ({pred}), 2) AS residual" if with_residual else ""
    return _with(f", {_OLS_FIT}\nSELECT row_key, round({pred}, 2) AS prediction{extra} FROM prepared, fit")


def _sql_onehot_group_mean() -> str:
    return _with("SELECT l_returnflag, CAST(count(*) AS BIGINT) AS n, round(avg(label), 4) AS prediction "
                 "FROM prepared GROUP BY l_returnflag")


def _sql_regression_metrics() -> str:
    return _with(f""",
fit AS (SELECT regr_slope(label, {OLS_FEATURE}) AS slope, regr_intercept(label, {OLS_FEATURE}) AS intercept
        FROM bucketed WHERE share < 0.7::DOUBLE),
e AS (SELECT label, label - (fit.intercept + fit.slope * {OLS_FEATURE}) AS err FROM bucketed, fit WHERE share >= 0.7::DOUBLE)
SELECT CAST(count(*) AS BIGINT) AS n, round(avg(err * err), 2) AS mse, round(sqrt(avg(err * err)), 4) AS rmse,
       round(avg(abs(err)), 4) AS mae, round(1 - sum(err * err) / (var_pop(label) * count(*)), 6) AS r2 FROM e""")


# One-feature elastic net in closed form (population moments, standardised feature and label).
def _sql_tuned() -> str:
    inner = split.cuts((0.7 * mdl.TRAIN_RATIO, 0.7 * (1 - mdl.TRAIN_RATIO), 1 - 0.7))[0]
    grid = ", ".join(f"({r}::DOUBLE, {e}::DOUBLE)" for r in mdl.REG_PARAMS for e in mdl.ELASTIC_NET_PARAMS)
    moments = f"""avg(label) AS my, avg({OLS_FEATURE}) AS mx, stddev_pop(label) AS sy, stddev_pop({OLS_FEATURE}) AS sx,
            corr(label, {OLS_FEATURE}) AS r"""
    w = "sign(r) * greatest(abs(r) - a * l / sy, 0) / (1 + (1 - a) * l / sy)"
    return f""",
sides AS (SELECT *, CASE WHEN share < {inner!r}::DOUBLE THEN 0 WHEN share < 0.7::DOUBLE THEN 1 ELSE 2 END AS side FROM bucketed),
grid(l, a) AS (VALUES {grid}),
m0 AS (SELECT {moments} FROM sides WHERE side = 0),
f0 AS (SELECT l, a, {w} * sy / sx AS slope, my - {w} * sy / sx * mx AS intercept FROM m0, grid),
points AS (SELECT l, a, sqrt(avg((label - intercept - slope * {OLS_FEATURE}) * (label - intercept - slope * {OLS_FEATURE}))) AS v
           FROM sides, f0 WHERE side = 1 GROUP BY l, a),
best AS (SELECT l, a FROM points ORDER BY v, l, a LIMIT 1),
m1 AS (SELECT {moments} FROM sides WHERE side < 2),
fit AS (SELECT l, a, {w} * sy / sx AS slope, my - {w} * sy / sx * mx AS intercept FROM m1, best),
scored AS (SELECT row_key, side, label, fit.intercept + fit.slope * {OLS_FEATURE} AS prediction FROM sides, fit)"""


def _sql_model(body: str) -> str:
    return _with(f"{_sql_tuned()}\n{body}")


# Category counts of the model's columns in the driver's lineitem table.
FULL_SIZES = {"l_returnflag": 3, "l_linestatus": 2, "l_linenumber": 7}


def _sql_full(body: str) -> str:
    """Ridge over all inputs by normal equations of standardised columns, solved by Gauss-Jordan steps."""
    inner = split.cuts((0.7 * mdl.TRAIN_RATIO, 0.7 * (1 - mdl.TRAIN_RATIO), 1 - 0.7))[0]
    index = ", ".join(f"i_{c} AS (SELECT {c} AS v, row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) - 1 AS idx "
                      f"FROM sides WHERE side < 2 GROUP BY {c})" for c in FULL_SIZES)
    columns = [f"CAST({c} AS DOUBLE)" for c in (*FULL_NUMERIC, "is_open")]
    names = [f"'{c}'" for c in (*FULL_NUMERIC, "is_open")]
    for c, size in FULL_SIZES.items():
        columns += [f"CAST(coalesce(i_{c}.idx, -1) = {i} AS INTEGER)::DOUBLE" for i in range(size)]
        names += [f"(SELECT '{c}_vector_' || v FROM i_{c} WHERE idx = {i})" for i in range(size)]
    k = range(len(columns))
    x = ", ".join(f"{e} AS f{i}" for i, e in enumerate(columns))
    joins = " ".join(f"LEFT JOIN i_{c} ON i_{c}.v = sides.{c}" for c in FULL_SIZES)
    gram = "[" + ", ".join("[" + ", ".join("1::DOUBLE" if i == j else f"corr(f{min(i, j)}, f{max(i, j)})" for j in k) + "]"
                           for i in k) + "]"
    state = f"""{gram} AS r, [{", ".join(f"corr(f{i}, label)" for i in k)}] AS rho, [{", ".join(f"stddev_pop(f{i})" for i in k)}] AS sd,
        [{", ".join(f"avg(f{i})" for i in k)}] AS mu, stddev_pop(label) AS sy, avg(label) AS my"""
    full = f"[{', '.join(f'f{i}' for i in k)}]"

    def solved(tag: str, source: str) -> str:
        return f"""
s{tag} AS (SELECT l, sd, mu, sy, my, [list_concat([r[i][j] + CASE WHEN i = j THEN l / sy ELSE 0 END FOR j IN range(1, len(r) + 1)],
        [rho[i]]) FOR i IN range(1, len(r) + 1)] AS m FROM {source}),
g{tag} AS (SELECT l, 0 AS k, m FROM s{tag} UNION ALL
      SELECT l, k + 1, [CASE WHEN i = k + 1 THEN [x / m[k + 1][k + 1] FOR x IN m[k + 1]]
                        ELSE [m[i][j] - m[i][k + 1] * m[k + 1][j] / m[k + 1][k + 1] FOR j IN range(1, len(m[i]) + 1)] END
                        FOR i IN range(1, len(m) + 1)] FROM g{tag} WHERE k < len(m)),
w{tag} AS (SELECT s{tag}.l, [g{tag}.m[i][len(g{tag}.m) + 1] * sy / sd[i] FOR i IN range(1, len(sd) + 1)] AS c, mu, my
      FROM g{tag} JOIN s{tag} ON s{tag}.l = g{tag}.l WHERE g{tag}.k = len(g{tag}.m)),
fit{tag} AS (SELECT l, c, my - list_dot_product(c, mu) AS intercept FROM w{tag})"""

    grid = ", ".join(f"({r}::DOUBLE)" for r in mdl.REG_PARAMS)
    text = f""",
sides AS (SELECT *, CASE WHEN share < {inner!r}::DOUBLE THEN 0 WHEN share < 0.7::DOUBLE THEN 1 ELSE 2 END AS side FROM bucketed),
{index},
x AS (SELECT row_key, side, label, {x} FROM sides {joins}),
grid(l) AS (VALUES {grid}),
m0 AS (SELECT * FROM (SELECT {state} FROM x WHERE side = 0), grid),{solved("0", "m0")},
points AS (SELECT l, sqrt(avg((label - intercept - list_dot_product(c, {full})) * (label - intercept - list_dot_product(c, {full})))) AS v
           FROM x, fit0 WHERE side = 1 GROUP BY l),
best AS (SELECT l FROM points ORDER BY v, l LIMIT 1),
m1 AS (SELECT * FROM (SELECT {state} FROM x WHERE side < 2), best),{solved("1", "m1")},
names AS (SELECT [{", ".join(names)}] AS names),
scored AS (SELECT row_key, side, label, intercept + list_dot_product(c, {full}) AS prediction FROM x, fit1)
{body}"""
    return _with(text).replace("WITH ", "WITH RECURSIVE ", 1)


_SQL_RUNS = "SELECT '{0}' AS experiment, l AS regParam, a AS elasticNetParam, round(v, 5) AS rmse FROM points"

_ALL_CHARGE_COLS = ", ".join(CHARGE_COLS)
_LABELLED_COLS = ", ".join(c if c != "charge" else "label" for c in CHARGE_COLS)
_PREPARED_COLS = _LABELLED_COLS + ", unit_price"


def oracle_sql() -> dict[str, str]:
    return {
        "csv_scan": _with(f"SELECT {_ALL_CHARGE_COLS} FROM charges"),
        "table_ctas": _with(f"SELECT {_ALL_CHARGE_COLS} FROM charges"),
        "unlabeled_ctas": _with(f"SELECT {_ALL_CHARGE_COLS.replace(', charge', '')} FROM charges"),
        "table_scan": _with(f"SELECT {_ALL_CHARGE_COLS} FROM charges"),
        "table_replace": _with(f"SELECT {_ALL_CHARGE_COLS} FROM charges"),
        "csv_infer": _with(f"SELECT row_key, CAST(l_orderkey AS INTEGER) AS l_orderkey, CAST(l_linenumber AS INTEGER) AS l_linenumber, "
                           "l_quantity, l_returnflag, l_shipdate, charge FROM charges"),
        "csv_malformed": _with("SELECT 'broken,' || row_key AS line FROM charges WHERE l_linenumber = 1"),
        "preview_topk": _with(f"SELECT {_PREPARED_COLS} FROM prepared ORDER BY row_key LIMIT 20"),
        "label_rename": _with(f"SELECT {_LABELLED_COLS} FROM labelled"),
        "drop_columns": _with("SELECT * EXCLUDE (l_orderkey, l_partkey, l_suppkey, l_shipdate) FROM labelled"),
        "ratio_feature": _with("SELECT row_key, l_extendedprice, l_quantity, unit_price FROM prepared"),
        "feature_projection": _with(
            "SELECT row_key, label, l_extendedprice, l_quantity, l_discount, l_tax, unit_price, is_open, "
            "l_returnflag, l_linestatus, l_linenumber FROM prepared"),
        "profile_numeric": _sql_profile_numeric(),
        "profile_string": _sql_profile_string(),
        "profile_cardinality": _sql_profile_cardinality(),
        "profile_ranges": _with("\nUNION ALL\n".join(
            f"SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS n, CAST(count(*) - count({c}) AS BIGINT) AS n_null, "
            f"CAST(count(*) FILTER ({c} = 0) AS BIGINT) AS n_zero, CAST(min({c}) AS DOUBLE) AS min_value, "
            f"CAST(max({c}) AS DOUBLE) AS max_value FROM prepared" for c in PROFILE_NUMERIC)),
        "corr_with_label": _sql_corr_with_label(),
        "corr_matrix": _sql_corr_matrix(),
        "select_by_label_corr": _sql_select_by_label_corr(),
        "redundant_features": _sql_redundant_features(),
        "redundant_greedy": _sql_redundant_greedy(),
        "split_train": _with(f"SELECT {_PREPARED_COLS} FROM bucketed WHERE share < 0.7::DOUBLE"),
        "split_holdout": _with(f"SELECT {_PREPARED_COLS} FROM bucketed WHERE share >= 0.7::DOUBLE"),
        "split_exact": _with(
            f"SELECT {_PREPARED_COLS} FROM (SELECT *, row_number() OVER (ORDER BY share, row_key) AS nth FROM bucketed) "
            "WHERE nth <= (SELECT CAST(floor(count(*) * 0.7::DOUBLE + 0.5) AS BIGINT) FROM bucketed)"),
        "split_summary": _with("SELECT CAST(CASE WHEN share < 0.7::DOUBLE THEN 0 ELSE 1 END AS INTEGER) AS side, "
                               "CAST(count(*) AS BIGINT) AS n, round(avg(label), 6) AS mean_label FROM bucketed "
                               "GROUP BY 1"),
        "category_index": _sql_category_index(),
        "category_index_apply": _sql_category_index_apply(),
        "category_encode": _with(
            ", " + ", ".join(f"i_{c} AS (SELECT {c} AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) - 1 "
                             f"AS DOUBLE) AS idx FROM prepared GROUP BY {c})" for c in ENCODED)
            + "\nSELECT row_key, l_partkey, l_returnflag, i_l_partkey.idx AS l_partkey_index, i_l_returnflag.idx AS l_returnflag_index "
            "FROM prepared LEFT JOIN i_l_partkey ON i_l_partkey.v = l_partkey LEFT JOIN i_l_returnflag ON i_l_returnflag.v = l_returnflag"),
        "one_hot": _sql_one_hot(),
        "assembled_features": _sql_assembled(),
        "ols_simple": _sql_ols_simple(),
        "ols_predict": _sql_ols_predict(False),
        "residuals": _sql_ols_predict(True),
        "onehot_group_mean": _sql_onehot_group_mean(),
        "regression_metrics": _sql_regression_metrics(),
        "profile_time": _with(
            "SELECT 'l_shipdate' AS column_name, CAST(count(l_shipdate) AS BIGINT) AS n, "
            "CAST(count(*) - count(l_shipdate) AS BIGINT) AS n_null, CAST(count(DISTINCT l_shipdate) AS BIGINT) AS n_distinct, "
            "min(l_shipdate) AS min_value, max(l_shipdate) AS max_value FROM charges"),
        "tuned_grid_metrics": _sql_model(
            "SELECT l AS regParam, a AS elasticNetParam, 'rmse' AS metric, round(v, 5) AS value, "
            "(l, a) = (SELECT (l, a) FROM best) AS is_best FROM points"),
        "model_report": _sql_model(
            "SELECT round(1 - sum((label - prediction) * (label - prediction)) / (var_pop(label) * count(*)), 8) AS train_r2, "
            "round(sqrt(avg((label - prediction) * (label - prediction))), 4) AS train_rmse, any_value(l) AS regParam, "
            "any_value(a) AS elasticNetParam, round(any_value(intercept), 4) AS intercept, CAST(1 AS INTEGER) AS n_features, "
            "CAST(count(*) AS BIGINT) AS n_train FROM scored, fit WHERE side < 2"),
        "model_coefficients": _sql_model(
            f"SELECT CAST(0 AS INTEGER) AS slot, '{OLS_FEATURE}' AS feature, round(slope, 8) AS coefficient FROM fit"),
        "holdout_metrics": _sql_model(
            "SELECT CAST(count(*) AS BIGINT) AS n, round(avg((label - prediction) * (label - prediction)), 2) AS mse, "
            "round(sqrt(avg((label - prediction) * (label - prediction))), 4) AS rmse, "
            "round(avg(abs(label - prediction)), 4) AS mae, "
            "round(1 - sum((label - prediction) * (label - prediction)) / (var_pop(label) * count(*)), 6) AS r2, "
            "CAST(0 AS BIGINT) AS n_missing FROM scored WHERE side = 2"),
        "scored_after_reload": _sql_model("SELECT row_key, round(prediction, 2) AS prediction FROM scored WHERE side = 2"),
        "batch_score": _sql_model("SELECT row_key, round(prediction, 2) AS prediction FROM scored WHERE side = 2"),
        "full_grid_metrics": _sql_full("SELECT l AS regParam, 0::DOUBLE AS elasticNetParam, round(v, 5) AS value, "
                                       "l = (SELECT l FROM best) AS is_best FROM points"),
        "full_coefficients": _sql_full(
            "SELECT CAST(i - 1 AS INTEGER) AS slot, names[i] AS feature, round(c[i], 4) AS coefficient "
            "FROM fit1, names, (SELECT unnest(range(1, 19)) AS i)"),
        "full_report": _sql_full(
            "SELECT round(1 - sum((label - prediction) * (label - prediction)) / (var_pop(label) * count(*)), 8) AS train_r2, "
            "round(sqrt(avg((label - prediction) * (label - prediction))), 4) AS train_rmse, any_value(l) AS regParam, "
            "0::DOUBLE AS elasticNetParam, round(any_value(intercept), 3) AS intercept, CAST(any_value(len(c)) AS INTEGER) AS "
            "n_features, CAST(count(*) AS BIGINT) AS n_train FROM scored, fit1 WHERE side < 2"),
        "full_holdout_metrics": _sql_full(
            "SELECT CAST(count(*) AS BIGINT) AS n, round(sqrt(avg((label - prediction) * (label - prediction))), 4) AS rmse, "
            "round(avg(abs(label - prediction)), 4) AS mae, "
            "round(1 - sum((label - prediction) * (label - prediction)) / (var_pop(label) * count(*)), 8) AS r2, "
            "CAST(0 AS BIGINT) AS n_missing FROM scored WHERE side = 2"),
        "full_batch_score": _sql_full("SELECT row_key, round(prediction, 2) AS prediction FROM scored WHERE side = 2"),
        "split_default_check": _with("SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_on_two_sides, "
                                     "true AS near_share FROM prepared"),
        "namespace_lifecycle": _with("SELECT CAST(count(*) AS BIGINT) AS n_rows, true AS made, false AS left_after_drop, "
                                     "false AS namespace_left FROM charges"),
        "best_run": _sql_model(_SQL_RUNS.format("grid") + " ORDER BY v, l, a LIMIT 1"),
        "runs_after_delete": _sql_model(_SQL_RUNS.format("kept")),
        **(llm_queries.ORACLE_SQL if llm_queries else {}),
    }
