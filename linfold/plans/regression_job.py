"""The end-to-end regression job over any frame described by a ``FeatureSpec``.

explore (profile, label correlation, correlation matrix) -> select features (weak
and redundant pruning) -> split by key hash -> fit index/encode/assemble/grid-search
on the persisted training side -> report -> holdout metrics -> save the model ->
log the run -> score unlabelled rows with the reloaded model.

Data never passes through the driver: only k-sized correlation results (one row
per feature) are read back to choose the model inputs.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linfold.operators import correlate, model as mdl, profile, split
from linfold.operators.project import add_ratios
from linfold.operators.runs import log_run
from linfold.session import fresh_name, shared_dir
from linfold.sources.models import load_model, save_model
from linfold.spec import FeatureSpec


@dataclass
class Selection:
    label_corr: DataFrame
    matrix: DataFrame
    screened: list[str]
    kept: list[str]


@dataclass
class JobResult:
    spec: FeatureSpec
    selection: Selection
    numeric: list[str]
    train: DataFrame
    holdout: DataFrame
    tuned: mdl.Tuned
    model_uri: str
    run_id: str | None = None
    extras: dict = field(default_factory=dict)

    @property
    def model(self) -> PipelineModel:
        return self.tuned.model


def select_features(df: DataFrame, spec: FeatureSpec, weak: float = 0.1, redundant: float = 0.9) -> Selection:
    """Label screen then redundancy pruning from one matrix over label and candidates: one scan of ``df``."""
    spark = df.sparkSession
    cands = list(spec.correlation_candidates())
    found = correlate.corr_matrix(df, [spec.label, *cands])
    rows = found.collect()  # one row for each pair of columns
    matrix = spark.createDataFrame(rows, found.schema)
    label_corr = correlate.label_row(matrix, spec.label)
    to_label = [(r["col_b"], r["corr"]) for r in rows if r["col_a"] == spec.label and r["col_b"] != spec.label]
    inputs = [(c, r) for c, r in to_label if c not in spec.explored]
    screened = [c for c, r in inputs if (r is not None and abs(r) >= weak) or c in spec.keep]
    walked = correlate.redundant_greedy(label_corr.filter(F.col("column_name").isin(screened)), matrix, redundant, spec.label,
                                        spec.keep).filter("keep").orderBy("rank").collect()
    kept = [r["column_name"] for r in walked]
    return Selection(label_corr, matrix, screened, kept)


def fit(df: DataFrame, spec: FeatureSpec, numeric, weights=(0.7, 0.3), split_hash: str = "xxhash64",
        **tuning) -> tuple[mdl.Tuned, DataFrame, DataFrame]:
    """Split by key hash and tune on the training side: (tuned, train, holdout)."""
    if spec.key is None:
        raise ValueError("tuning needs a row key: its splits are by key hash")
    train, holdout = split.hash_split(df, spec.key, weights, hash_fn=split_hash)
    tuned = mdl.tune(train, spec.key, numeric, spec.binary, spec.categorical, label=spec.label,
                     outer=weights[0] / sum(weights), hash_fn=split_hash, **tuning)
    return tuned, train, holdout


def run(df: DataFrame, spec: FeatureSpec, *, weak: float = 0.1, redundant: float = 0.9, experiment: str | None = None, runs_table: str | None = None,
        database: str | None = None, model_uri: str | None = None, **tuning) -> JobResult:
    """Run every step; ``df`` must already hold the ratios (see ``prepare``)."""
    spark = df.sparkSession
    sel = select_features(df, spec, weak, redundant)
    numeric = [c for c in sel.kept if c not in spec.dependent]
    tuned, train, holdout = fit(df, spec, numeric, **tuning)
    model = tuned.model
    uri = model_uri or shared_dir(spark, "models", fresh_name("pipeline"))
    save_model(model, uri)
    run_id = None
    if runs_table:
        best = mdl.regression(model)
        metrics = mdl.holdout_metrics(model, holdout, spec.label).first().asDict()
        run_id = log_run(spark, runs_table, experiment or "default",
                         {"regParam": best.getRegParam(), "elasticNetParam": best.getElasticNetParam(),
                          "features": ",".join(numeric + list(spec.binary) + list(spec.categorical))},
                         {f"holdout_{k}": v for k, v in metrics.items() if v is not None}, uri, database)
    extras = {"profile": profile.profile_numeric(df, [c for c in profile.numeric_columns(df)])}  # lazy
    return JobResult(spec, sel, numeric, train, holdout, tuned, uri, run_id, extras)


def prepare(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    return add_ratios(df, spec)


def score(model_uri: str, unlabelled: DataFrame, spec: FeatureSpec, keep=None) -> DataFrame:
    """Rebuild derived columns on new rows, load the saved pipeline, predict."""
    scored = load_model(model_uri).transform(prepare(unlabelled, spec))
    keep = keep if keep is not None else ([spec.key] if spec.key else [])
    return scored.select(*keep, F.col("prediction"))


def explore(df: DataFrame, spec: FeatureSpec) -> dict[str, DataFrame]:
    """The exploration outputs as lazy frames (the source job printed them)."""
    num = [c for c in profile.numeric_columns(df)]
    return {
        "profile": profile.profile_numeric(df, num),
        # A screen, so HyperLogLog: one pass, fixed state, no shuffle of distinct values.
        "cardinality": profile.profile_cardinality(
            df, [c for c in df.columns if c in num or c in spec.categorical], exact=False),
        "times": profile.profile_time(df),
        "label_corr": correlate.corr_with_label(df, spec.label, spec.correlation_candidates()),
    }
