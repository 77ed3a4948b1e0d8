import pytest

from linfold.functions.exprs import key_hash, safe_ratio
from linfold.operators import profile, split
from linfold.plans import stand_in

SF = "/root/testdata/sf0.001"


def test_profile_numeric_matches_pandas(spark):
    df = stand_in.prepared(spark, SF)
    cols = ["l_quantity", "l_extendedprice", "label", "is_open"]
    got = {r["column_name"]: r for r in profile.profile_numeric(df, cols).collect()}
    pdf = df.select(*cols).toPandas().astype(float)
    for c in cols:
        assert got[c]["n"] == pdf[c].count()
        assert got[c]["mean"] == pytest.approx(pdf[c].mean(), rel=1e-12)
        assert got[c]["stddev"] == pytest.approx(pdf[c].std(ddof=1), rel=1e-10)
        assert got[c]["min_value"] == pdf[c].min() and got[c]["max_value"] == pdf[c].max()


def test_profile_nulls_one_row_empty(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, 2.0)], "a double, b double")
    got = {r["column_name"]: r for r in profile.profile_numeric(df).collect()}
    assert got["b"]["n"] == 1 and got["b"]["n_null"] == 1 and got["b"]["stddev"] is None
    assert got["a"]["mean"] == 2.0
    empty = profile.profile_numeric(df.limit(0)).collect()
    assert sorted(r["column_name"] for r in empty) == ["a", "b"]
    assert all(r["n"] == 0 and r["n_null"] == 0 and r["mean"] is None for r in empty)


def test_cardinality_exact_and_approx(spark):
    df = stand_in.prepared(spark, SF)
    cols = ["l_returnflag", "l_linenumber", "l_discount", "row_key"]
    exact = {r["column_name"]: r for r in profile.profile_cardinality(df, cols).collect()}
    approx = {r["column_name"]: r for r in profile.profile_cardinality(df, cols, exact=False).collect()}
    pdf = df.select(*cols).toPandas()
    for c in cols:
        assert exact[c]["n_distinct"] == pdf[c].nunique()
        assert abs(approx[c]["n_distinct"] - pdf[c].nunique()) <= max(2, 0.06 * pdf[c].nunique())
    assert exact["l_discount"]["n_zero"] == int((pdf["l_discount"] == 0).sum())
    assert exact["l_returnflag"]["n_zero"] is None


def test_zero_divisor_gives_null(spark):
    df = spark.createDataFrame([(3, 0), (3, 2)], "x int, y int")
    out = [r[0] for r in df.select(safe_ratio("x", "y")).collect()]
    assert out == [None, 1.5]


def test_hash_split_is_a_partition_and_layout_independent(spark):
    df = stand_in.prepared(spark, SF)
    parts = split.hash_split(df, "row_key")
    keys = [set(r[0] for r in p.select("row_key").collect()) for p in parts]
    total = set(r[0] for r in df.select("row_key").collect())
    assert keys[0].isdisjoint(keys[1]) and keys[0] | keys[1] == total
    again = split.hash_split(df.repartition(5, "l_partkey"), "row_key")
    assert set(r[0] for r in again[0].select("row_key").collect()) == keys[0]
    share = len(keys[0]) / len(total)
    assert 0.65 < share < 0.75


def test_key_hash_matches_md5_rule(spark):
    import hashlib

    df = spark.createDataFrame([("a",), ("1-2-3-4",), (None,)], "k string")
    got = [r[0] for r in df.select(key_hash("k", hash_fn="md5")).collect()]
    assert got == [int(hashlib.md5(k.encode()).hexdigest()[:8], 16) / 2**32 for k in ["a", "1-2-3-4", ""]]


@pytest.mark.parametrize("hash_fn", ["xxhash64", "md5"])
def test_null_keys_stay_and_any_share_is_met(spark, hash_fn):
    df = spark.range(100).selectExpr("IF(id < 10, NULL, CAST(id AS STRING)) AS k", "id")
    sides = split.hash_split(df, "k", hash_fn=hash_fn)
    n = [x.count() for x in sides]
    assert sum(n) == 100
    assert {r["side"]: r["n"] for r in split.split_summary(df, "k", hash_fn=hash_fn).collect()} == dict(enumerate(n))
    many = spark.range(200_000).selectExpr("CAST(id AS STRING) AS k")
    small = split.hash_split(many, "k", (0.996, 0.004), hash_fn=hash_fn)[1].count()
    assert 600 < small < 1000
    assert abs(split.hash_split(many, "k", (0.875, 0.125), hash_fn=hash_fn)[1].count() - 25_000) < 800


def test_three_way_split_and_summary(spark):
    df = stand_in.prepared(spark, SF)
    parts = split.hash_split(df, "row_key", (0.5, 0.25, 0.25))
    counts = [p.count() for p in parts]
    assert sum(counts) == df.count()
    summ = {r["side"]: r["n"] for r in split.split_summary(df, "row_key", "label", (0.5, 0.25, 0.25)).collect()}
    assert [summ[i] for i in range(3)] == counts


def test_random_split_parity_form(spark):
    df = stand_in.prepared(spark, SF)
    a, b = split.split(df, method="random", seed=100)
    assert a.count() + b.count() == df.count()


def test_missing_and_zero_values_are_typed(spark):
    """-0.0 is 0.0, NaN is missing: as SQL counts them once NaN is NULL."""
    rows = [(0.0,), (-0.0,), (float("nan"),), (None,), (1.0,)]
    df = spark.createDataFrame(rows, "x double")
    c = profile.profile_cardinality(df).first()
    assert (c["n"], c["n_distinct"], c["n_null"], c["n_zero"], c["zero_share"]) == (3, 2, 2, 2, 0.4)
    p = profile.profile_numeric(df).first()
    assert (p["n"], p["n_null"], p["max_value"]) == (3, 2, 1.0) and p["mean"] == pytest.approx(1 / 3)


def test_profile_of_timestamps(spark):
    df = spark.sql("SELECT * FROM VALUES (TIMESTAMP '2020-01-02 03:04:05', DATE '2021-01-01'), (NULL, NULL), "
                   "(TIMESTAMP '2019-01-02 00:00:00', DATE '2021-01-01') AS t(a, b)")
    got = {r["column_name"]: r for r in profile.profile_time(df).collect()}
    assert (got["a"]["n"], got["a"]["n_null"], got["a"]["n_distinct"]) == (2, 1, 2)
    assert str(got["a"]["min_value"]) == "2019-01-02 00:00:00" and got["b"]["n_distinct"] == 1


def test_profiles_of_no_columns_are_empty_with_schema(spark):
    from linfold.operators import encode

    df = spark.createDataFrame([("x",)], "s string")
    assert profile.profile_numeric(df).count() == 0
    assert profile.profile_numeric(df).columns == ["column_name", "n", "n_null", "mean", "stddev",
                                                   "min_value", "max_value"]
    assert profile.profile_string(df.select()).count() == 0
    assert profile.profile_cardinality(df, []).count() == 0
    assert encode.category_frequencies(df, []).count() == 0
    assert profile.profile_string(df).first()["max_length"] == 1


def test_boolean_columns_profile_without_zero_share(spark):
    df = spark.createDataFrame([(True, 0), (False, 2), (None, 0)], "b boolean, k int")
    card = {r["column_name"]: r for r in profile.profile_cardinality(df).collect()}
    assert card["b"]["n_zero"] is None and card["k"]["n_zero"] == 2
    prof = {r["column_name"]: r for r in profile.profile_numeric(df).collect()}
    assert prof["b"]["mean"] == 0.5 and prof["b"]["n_null"] == 1


@pytest.mark.parametrize("hash_fn", ["xxhash64", "md5"])
def test_both_hashes_split_stably(spark, hash_fn):
    df = stand_in.prepared(spark, SF)
    a = split.hash_split(df, "row_key", hash_fn=hash_fn)
    b = split.hash_split(df.repartition(7), "row_key", hash_fn=hash_fn)
    ka = {r[0] for r in a[1].select("row_key").collect()}
    kb = {r[0] for r in b[1].select("row_key").collect()}
    assert ka == kb and 0.25 < len(ka) / df.count() < 0.35
