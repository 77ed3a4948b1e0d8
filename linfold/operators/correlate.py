"""Correlation operators (label screen, all-pairs matrix, weak and redundant feature pruning).

The source job ran one ``stat.corr`` job per pair (11 + 49 jobs). Here all pairs come from one
scan: ``comoments`` keeps a mergeable state for each pair of column blocks, summed as matrix
products over Arrow batches. Its cost is linear in the pairs, with no row copied and no
aggregate expression per pair (those overflow generated code at some forty columns).

Missing values: NULL and NaN are missing and are deleted pairwise. An infinite value
counts, but has no finite mean, so the pair's correlation is NULL. It is NULL too for a
constant side or fewer than two rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linfold.operators.comoments import co_moments
from linfold.operators.profile import numeric_columns

_PAIR_SCHEMA = "col_a string, col_b string, n bigint, corr double"
_PAIRS = pa.schema([("col_a", pa.string()), ("col_b", pa.string()), ("n", pa.int64()), ("corr", pa.float64())])

#: Columns in a block of the label's strip (one row of cells a block).
STRIP = 4096


def _correlations(plan, block, state) -> tuple[list[str], list[str], np.ndarray, np.ndarray]:
    """Names of a block's sides, and the cells' counts and r (NaN where it is not defined)."""
    n, _, _, xx, yy, xy = state.cells
    with np.errstate(invalid="ignore", divide="ignore"):
        r = np.clip(xy / (np.sqrt(xx) * np.sqrt(yy)), -1.0, 1.0)
    r[(n < 2) | (xx <= 0) | (yy <= 0)] = np.nan
    a, b = plan.blocks[block]
    left, right = [plan.left[i] for i in a], [plan.right[j] for j in b]
    same = np.array(left, dtype=object)[:, None] == np.array(right, dtype=object)[None, :]
    r[same & ~np.isnan(r)] = 1.0
    return left, right, n.astype(np.int64), r


def _rows(names_a, names_b, n, r) -> pa.Table:
    r = np.asarray(r, dtype=float)
    return pa.table([pa.array(names_a, pa.string()), pa.array(names_b, pa.string()), pa.array(n, pa.int64()),
                     pa.array(r, pa.float64(), mask=np.isnan(r))], schema=_PAIRS)


def _numeric(df: DataFrame, cols) -> None:
    wrong = sorted(set(cols) - set(numeric_columns(df)))
    if wrong:
        raise ValueError(f"correlation needs numeric columns; not numeric: {wrong}")


def pair_correlations(df: DataFrame, pairs, mirrored: bool = False) -> DataFrame:
    """Pearson r for each (a, b) in ``pairs`` from one scan: (col_a, col_b, n, corr).

    ``n`` counts rows where both sides are present. ``mirrored`` also gives (b, a) for
    each pair of different columns.
    """
    pairs = [(a, b) for a, b in pairs]
    if not pairs:
        return df.sparkSession.createDataFrame([], _PAIR_SCHEMA)
    _numeric(df, [c for p in pairs for c in p])
    wanted: dict[str, list[str]] = {}
    for a, b in pairs:
        wanted.setdefault(a, []).append(b)

    def finish(plan, block, state):
        left, right, n, r = _correlations(plan, block, state)
        at = {c: j for j, c in enumerate(right)}
        cells = [(i, at[b]) for i, a in enumerate(left) for b in wanted[a] if b in at]
        cells = [(left[i], right[j], n[i, j], r[i, j]) for i, j in cells]
        if mirrored:
            cells += [(b, a, m, x) for a, b, m, x in cells if a != b]
        return _rows(*(zip(*cells) if cells else ([], [], [], [])))
    left, right = list(wanted), list(dict.fromkeys(b for _, b in pairs))
    return co_moments(df, left, right, finish, _PAIR_SCHEMA, block=STRIP if len(left) == 1 else None)


def corr_with_label(df: DataFrame, label: str, cols) -> DataFrame:
    """Correlation of each column with the label: (column_name, n, corr).

    The label's own row (r = 1) is kept, as in the source job's loop.
    """
    pairs = [(label, c) for c in cols if c != label] + [(label, label)]
    return pair_correlations(df, pairs).select(F.col("col_b").alias("column_name"), "n", "corr")


def corr_matrix(df: DataFrame, cols) -> DataFrame:
    """Full k x k correlation matrix in long form: (col_a, col_b, n, corr).

    Only the k(k+1)/2 distinct pairs are computed; both directions come from the same sums.
    """
    cols = list(dict.fromkeys(cols))
    if not cols:
        return df.sparkSession.createDataFrame([], _PAIR_SCHEMA)
    _numeric(df, cols)

    def finish(plan, block, state):
        left, right, n, r = _correlations(plan, block, state)
        a, b = plan.blocks[block]
        i, j = np.triu_indices(len(left)) if a == b else map(np.ravel, np.indices(r.shape))
        other = (np.ones(len(i), dtype=bool) if a != b else i != j)
        left, right = np.array(left, dtype=object), np.array(right, dtype=object)
        return _rows([*left[i], *right[j[other]]], [*right[j], *left[i[other]]],
                     np.concatenate((n[i, j], n[i, j][other])), np.concatenate((r[i, j], r[i, j][other])))
    return co_moments(df, cols, cols, finish, _PAIR_SCHEMA, same=True)


def label_row(matrix: DataFrame, label: str) -> DataFrame:
    """The label's row of a matrix in the form of ``corr_with_label``."""
    return matrix.filter(F.col("col_a") == label).select(F.col("col_b").alias("column_name"), "n", "corr")


def select_by_label_corr(label_corr: DataFrame, threshold: float, label: str = "label",
                         keep=()) -> DataFrame:
    """Features whose |r| with the label reaches ``threshold`` (plus the keep-list)."""
    a = F.abs(F.col("corr"))
    strong = a >= threshold
    if keep:
        strong = strong | F.col("column_name").isin(list(keep))
    return label_corr.filter((F.col("column_name") != label) & strong) \
        .select("column_name", "corr", a.alias("abs_corr"))


def redundant_features(label_corr: DataFrame, matrix: DataFrame, threshold: float,
                       label: str = "label", keep=()) -> DataFrame:
    """Flag the weaker of mutually correlated features (dominance rule, set-at-once).

    Features are ranked by |r with label| desc, then name. A feature is dropped when
    some other candidate ranked before it has |r| >= ``threshold`` with it, unless
    it is on the keep-list. Output: (column_name, label_corr, rank, keep, dominated_by).
    """
    cands = label_corr.filter(F.col("column_name") != label).select(
        "column_name", F.col("corr").alias("label_corr"))
    # k candidate rows: the ordering window sees feature names, not data rows.
    ranked = cands.withColumn("rank", F.row_number().over(
        Window.orderBy(F.desc_nulls_last(F.abs("label_corr")), F.col("column_name"))))
    g = ranked.select(F.col("column_name").alias("col_b"), F.col("rank").alias("rank_b"))
    # One row for each column, or pair of columns, on both sides of the joins: sizes that no data changes.
    strong = matrix.filter((F.col("col_a") != F.col("col_b")) & (F.abs("corr") >= threshold)) \
        .join(F.broadcast(g), "col_b")
    dom = ranked.alias("f").join(F.broadcast(strong).alias("s"), F.col("f.column_name") == F.col("s.col_a"), "left") \
        .groupBy("f.column_name", "f.label_corr", "f.rank") \
        .agg(F.min_by(F.when(F.col("s.rank_b") < F.col("f.rank"), F.col("s.col_b")),
                      F.when(F.col("s.rank_b") < F.col("f.rank"), F.col("s.rank_b"))).alias("dominated_by"))
    kept = F.col("dominated_by").isNull()
    if keep:
        kept = kept | F.col("column_name").isin(list(keep))
    return dom.select("column_name", "label_corr", F.col("rank").cast("int").alias("rank"),
                      kept.alias("keep"), "dominated_by")


def redundant_greedy(label_corr: DataFrame, matrix: DataFrame, threshold: float, label: str = "label", keep=()) -> DataFrame:
    """The greedy walk-down as a table: (column_name, label_corr, rank, keep, dominated_by).

    Features come in the order of ``redundant_features``; one is dropped when a feature *kept* before it has
    |r| >= ``threshold`` with it (``dominated_by`` names the first of these), unless it is on the keep-list.
    The walk is a fold over one row that holds the features and whom each clashes with.
    """
    strong = matrix.filter((F.col("col_a") != F.col("col_b")) & (F.abs("corr") >= threshold)) \
        .groupBy(F.col("col_a").alias("name")).agg(F.collect_set("col_b").alias("clashes"))
    cands = label_corr.filter(F.col("column_name") != label).select(F.col("column_name").alias("name"), F.col("corr").alias("r"))
    # Rows are features, not data: broadcast a row for each column, and sorted inside one array.
    listed = cands.join(F.broadcast(strong), "name", "left").select(
        F.coalesce(-F.abs("r"), F.lit(2.0)).alias("place"), "name", "r", F.coalesce("clashes", F.array().cast("array<string>"))
        .alias("clashes"), F.col("name").isin(list(keep)).alias("forced")) \
        .groupBy().agg(F.sort_array(F.collect_list(F.struct("place", "name", "r", "clashes", "forced"))).alias("features"))
    walk = """aggregate(features,
        named_struct('kept', CAST(array() AS ARRAY<STRING>),
                     'told', CAST(array() AS ARRAY<STRUCT<name: STRING, r: DOUBLE, keep: BOOLEAN, by: STRING>>)),
        (done, f) -> named_struct(
            'kept', IF(f.forced OR NOT arrays_overlap(done.kept, f.clashes), array_append(done.kept, f.name), done.kept),
            'told', array_append(done.told, named_struct('name', f.name, 'r', f.r,
                'keep', f.forced OR NOT arrays_overlap(done.kept, f.clashes),
                'by', get(array_intersect(done.kept, f.clashes), 0)))),
        done -> done.told)"""
    return listed.select(F.posexplode(F.expr(walk)).alias("at", "t")).select(
        F.col("t.name").alias("column_name"), F.col("t.r").alias("label_corr"), (F.col("at") + 1).alias("rank"),
        F.col("t.keep").alias("keep"), F.col("t.by").alias("dominated_by"))


def greedy_keep(label_corr_rows, matrix_rows, threshold: float, keep=()) -> list[str]:
    """Greedy walk-down form of the rule over already-collected k-sized results.

    ``label_corr_rows``: [(name, r)], ``matrix_rows``: [(a, b, r)]; the plain form that
    ``redundant_greedy`` is checked against.
    """
    r = {(a, b): v for a, b, v in matrix_rows}
    order = sorted(label_corr_rows, key=lambda t: (-(abs(t[1]) if t[1] is not None else -1.0), t[0]))
    kept: list[str] = []
    for name, _ in order:
        clash = any(r.get((name, k)) is not None and abs(r[(name, k)]) >= threshold for k in kept)
        if not clash or name in keep:
            kept.append(name)
    return kept
