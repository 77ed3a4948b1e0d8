import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from linfold.operators import correlate



def _frame(spark, n=300, seed=7, with_nulls=True):
    rng = np.random.default_rng(seed)
    a = rng.normal(50, 5, n)
    b = 0.8 * a + rng.normal(0, 2, n) + 1e6  # large offset: tests the shift
    c = rng.normal(-3, 1, n)
    rows = []
    for i in range(n):
        ra, rb, rc = float(a[i]), float(b[i]), float(c[i])
        if with_nulls and i % 7 == 0:
            rb = None
        if with_nulls and i % 11 == 0:
            rc = None
        rows.append((ra, rb, rc, 1.0))
    return spark.createDataFrame(rows, "a double, b double, c double, k double").repartition(3), (a, b, c)


def _pairwise_numpy(x, y):
    m = ~(np.isnan(x) | np.isnan(y))
    return np.corrcoef(x[m], y[m])[0, 1]


def test_pairwise_nulls_match_numpy_and_builtin(spark):
    df, _ = _frame(spark)
    pdf = df.toPandas().astype(float)
    got = {(r["col_a"], r["col_b"]): r for r in correlate.corr_matrix(df, ["a", "b", "c"]).collect()}
    for x, y in itertools.permutations("abc", 2):
        exp = _pairwise_numpy(pdf[x].to_numpy(), pdf[y].to_numpy())
        assert got[(x, y)]["corr"] == pytest.approx(exp, abs=1e-12)
        builtin = df.agg(F.corr(x, y)).first()[0]  # built-in corr drops pairs with a NULL too
        assert got[(x, y)]["corr"] == pytest.approx(builtin, abs=1e-9)  # numpy above is the tight reference
        n_exp = int((pdf[[x, y]].notna().all(axis=1)).sum())
        assert got[(x, y)]["n"] == n_exp


def test_constant_column_is_null_not_error(spark):
    df, _ = _frame(spark, with_nulls=False)
    rows = {r["column_name"]: r["corr"] for r in correlate.corr_with_label(df, "a", ["b", "k"]).collect()}
    assert rows["k"] is None
    assert rows["a"] == 1.0
    assert -1.0 <= rows["b"] <= 1.0


def test_matrix_symmetric_bounded_unit_diagonal(spark):
    df, _ = _frame(spark)
    rows = correlate.corr_matrix(df, ["a", "b", "c"]).collect()
    assert len(rows) == 9
    r = {(x["col_a"], x["col_b"]): x["corr"] for x in rows}
    for (x, y), v in r.items():
        assert -1.0 <= v <= 1.0
        assert v == pytest.approx(r[(y, x)], abs=0)
        if x == y:
            assert v == 1.0


def test_one_row_and_empty_frames(spark):
    one = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    assert correlate.pair_correlations(one, [("x", "y")]).first()["corr"] is None
    empty = one.limit(0)
    out = correlate.pair_correlations(empty, [("x", "y")]).collect()
    assert all(r["corr"] is None for r in out)


def test_select_and_redundant_rules(spark):
    lc = spark.createDataFrame([("label", 1.0), ("a", 0.9), ("b", 0.95), ("c", 0.05), ("d", -0.5)],
                               "column_name string, corr double")
    mat = spark.createDataFrame(
        [("a", "b", 0.97), ("b", "a", 0.97), ("a", "d", 0.1), ("d", "a", 0.1), ("b", "d", 0.2), ("d", "b", 0.2)],
        "col_a string, col_b string, corr double")
    sel = {r["column_name"] for r in correlate.select_by_label_corr(lc, 0.1).collect()}
    assert sel == {"a", "b", "d"}
    red = {r["column_name"]: r for r in correlate.redundant_features(
        lc.filter(F.col("column_name") != "c"), mat, 0.9).collect()}
    assert red["b"]["keep"] and red["d"]["keep"]
    assert not red["a"]["keep"] and red["a"]["dominated_by"] == "b"
    kept_list = {r["column_name"]: r for r in correlate.redundant_features(
        lc.filter(F.col("column_name") != "c"), mat, 0.9, keep=["a"]).collect()}
    assert kept_list["a"]["keep"]
    greedy = correlate.greedy_keep([("a", 0.9), ("b", 0.95), ("d", -0.5)],
                                   [(r["col_a"], r["col_b"], r["corr"]) for r in mat.collect()], 0.9)
    assert greedy == ["b", "d"]


def test_matches_reference_stat_corr_and_ml_correlation(spark):
    """Parity with the source job's ``stat.corr`` and with ``ml.stat.Correlation`` (no NULLs)."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation

    df, _ = _frame(spark, with_nulls=False)
    cols = ["a", "b", "c"]
    ours = {(r["col_a"], r["col_b"]): r["corr"] for r in correlate.corr_matrix(df, cols).collect()}
    vec = VectorAssembler(inputCols=cols, outputCol="v").transform(df)
    m = Correlation.corr(vec, "v").first()[0].toArray()
    for i, x in enumerate(cols):
        for j, y in enumerate(cols):
            assert ours[(x, y)] == pytest.approx(m[i, j], abs=1e-9)
            assert ours[(x, y)] == pytest.approx(df.stat.corr(x, y), abs=1e-9)


def test_nan_counts_as_missing(spark):
    rows = [(float(i), 2.0 * i + (i % 3), None) for i in range(20)]
    rows[4] = (float("nan"), 9.0, None)
    df = spark.createDataFrame(rows, "x double, y double, z double")
    clean = df.filter(~F.isnan("x"))
    got = correlate.pair_correlations(df, [("x", "y")]).first()
    exp = correlate.pair_correlations(clean, [("x", "y")]).first()
    assert got["n"] == 19
    assert got["corr"] == pytest.approx(exp["corr"], abs=1e-12)


def test_non_numeric_column_is_rejected(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "s string, x double")
    with pytest.raises(ValueError):
        correlate.pair_correlations(df, [("s", "x")])




def test_leading_nulls_and_large_offsets(spark):
    """Columns that start with NULLs longer than any sample, offsets of 1e9, spread of 1."""
    rng = np.random.default_rng(4)
    n = 20_000
    x = 1e9 + rng.normal(size=n)
    y = 1e9 + 0.5 * (x - 1e9) + rng.normal(size=n)
    rows = [(None, None) if i < 3000 else (float(x[i]), float(y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "x double, y double").coalesce(2)
    truth = np.corrcoef(x[3000:] - 1e9, y[3000:] - 1e9)[0, 1]
    got = correlate.pair_correlations(df, [("x", "y")]).first()
    assert got["n"] == n - 3000 and got["corr"] == pytest.approx(truth, abs=1e-6)
    m = {(r["col_a"], r["col_b"]): r["corr"] for r in correlate.corr_matrix(df, ["x", "y"]).collect()}
    assert m["x", "y"] == m["y", "x"] == pytest.approx(truth, abs=1e-6)


def test_infinity_has_no_correlation(spark):
    rows = [(float(i), float(i * i)) for i in range(50)] + [(math.inf, 3.0)]
    got = correlate.pair_correlations(spark.createDataFrame(rows, "x double, y double"), [("x", "y"), ("y", "y")]).collect()
    by = {(r["col_a"], r["col_b"]): r for r in got}
    assert by["x", "y"]["n"] == 51 and by["x", "y"]["corr"] is None
    assert by["y", "y"]["corr"] == pytest.approx(1.0)


def test_many_columns_match_numpy(spark):
    rng = np.random.default_rng(2)
    k, n = 12, 400
    data = rng.normal(size=(n, k)) @ rng.normal(size=(k, k)) + 1e6
    cols = [f"c{i}" for i in range(k)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in data], cols).repartition(5)
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in correlate.corr_matrix(df, cols).collect()}
    truth = np.corrcoef(data.T)
    assert len(got) == k * k
    for i, j in itertools.product(range(k), range(k)):
        assert got[cols[i], cols[j]] == pytest.approx(truth[i, j], abs=1e-9)


def _numpy_pair(x, y):
    m = ~(np.isnan(x) | np.isnan(y))
    return int(m.sum()), (np.corrcoef(x[m], y[m])[0, 1] if m.sum() > 1 else np.nan)


def test_blocks_and_batches_change_nothing(spark, monkeypatch):
    """Tiny blocks, batches and merges of tasks, with nulls, offsets and rows in few partitions: equal to numpy."""
    from linfold.operators import comoments

    rng = np.random.default_rng(21)
    k, n = 9, 500
    x = rng.normal(size=(n, k)) @ rng.normal(size=(k, k)) + np.array([0, 1e9, -5, 0, 1e6, 3, 0, 0, 2])
    x[rng.random((n, k)) < 0.2] = np.nan
    x[:, 3] = 4.25  # constant
    x[:300, 5] = np.nan  # begins late
    cols = [f"c{i}" for i in range(k)]
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in x]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(11)
    for block, cells, fan, state in ((64, 1 << 21, 256, 256 << 20), (2, 40, 2, 1), (3, 9, 3, 4000)):
        monkeypatch.setattr(comoments, "BLOCK", block)
        monkeypatch.setattr(comoments, "CELLS", cells)
        monkeypatch.setattr(comoments, "FAN_IN", fan)
        monkeypatch.setattr(comoments, "MERGE_BYTES", state)  # small: tasks' states meet a few at a time first
        monkeypatch.setattr(comoments, "STATE_BYTES", state)  # 1: every pair of blocks has a scan of its own
        got = {(r["col_a"], r["col_b"]): (r["n"], r["corr"]) for r in correlate.corr_matrix(df, cols).collect()}
        assert len(got) == k * k
        for i, a in enumerate(cols):
            for j, b in enumerate(cols):
                m, r = _numpy_pair(x[:, i], x[:, j])
                assert got[a, b][0] == m
                if 3 in (i, j):
                    assert got[a, b][1] is None
                else:
                    assert got[a, b][1] == pytest.approx(r, abs=1e-6 if 1 in (i, j) else 1e-10)


def test_infinite_values_spoil_their_own_pairs_only(spark):
    rows = [(float(i), float(i * i), float(-i), None if i == 4 else float(i % 3)) for i in range(12)]
    rows[4] = (float("inf"), *rows[4][1:])
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(3)
    got = {(r["col_a"], r["col_b"]): (r["n"], r["corr"]) for r in correlate.corr_matrix(df, ["a", "b", "c", "d"]).collect()}
    assert got["a", "b"] == (12, None) and got["a", "a"] == (12, None)
    assert got["b", "c"][1] is not None
    x = np.array([r[0] for r in rows if r[3] is not None])
    y = np.array([r[3] for r in rows if r[3] is not None])
    assert got["a", "d"] == (11, pytest.approx(np.corrcoef(x, y)[0, 1]))  # d is missing where a is infinite


def test_a_column_constant_where_the_other_is_present(spark):
    rows = [(0.1 if i % 2 else float(i) / 3, float(i) if i % 2 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "a double, b double").repartition(7)
    got = correlate.pair_correlations(df, [("a", "b")]).first()
    assert (got["n"], got["corr"]) == (20, None)


def test_three_hundred_columns(spark):
    """Wide frames: no expression for a pair, no row copied, one scan."""
    df = spark.range(2000, numPartitions=4).select(
        *[(F.rand(i) + (F.col("id") / 2000 if i % 3 == 0 else F.lit(0.0))).alias(f"c{i}") for i in range(300)]).persist()
    try:
        got = {(r["col_a"], r["col_b"]): r["corr"] for r in correlate.corr_matrix(df, df.columns).collect()}
        want = np.corrcoef(np.array(df.collect()).T)
        assert len(got) == 90000
        for i, j in itertools.product(range(0, 300, 7), range(0, 300, 11)):
            assert got[f"c{i}", f"c{j}"] == pytest.approx(want[i, j], abs=1e-12)
    finally:
        df.unpersist()


@pytest.mark.parametrize("keep", [(), ("f3", "f7")])
def test_greedy_table_is_the_walk(spark, keep):
    rng = np.random.default_rng(17)
    names = [f"f{i}" for i in range(14)]
    r = {n: round(float(v), 1) for n, v in zip(names, rng.uniform(-1, 1, 14))}  # ties
    r["f5"] = None
    m = [(a, b, float(abs(hash((min(a, b), max(a, b))) % 100) / 100)) for a in names for b in names if a != b]
    lc = spark.createDataFrame([("label", 1.0), *r.items()], "column_name string, corr double")
    matrix = spark.createDataFrame(m, "col_a string, col_b string, corr double")
    got = correlate.redundant_greedy(lc, matrix, 0.7, keep=keep).orderBy("rank").collect()
    kept = [x["column_name"] for x in got if x["keep"]]
    assert kept == correlate.greedy_keep(list(r.items()), m, 0.7, keep)
    clash = {(a, b) for a, b, v in m if v >= 0.7}
    for x in got:
        before = [k for k in kept if kept.index(k) < len(kept) and (x["column_name"], k) in clash
                  and [y["column_name"] for y in got].index(k) < x["rank"] - 1]
        assert x["dominated_by"] == (before[0] if before else None)
