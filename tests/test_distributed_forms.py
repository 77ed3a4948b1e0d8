"""Forms that keep nothing whole on the driver or in one task: dictionaries, sketches, exact splits, inferred CSV, versions, sums."""

import contextlib
import io
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from linfold.operators import encode, model as mdl, profile, split, sufficient
from linfold.plans import regression_job, stand_in
from linfold.session import fresh_name, shared_dir
from linfold.sources import csv, tables, versions

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


# --- dictionary encoding ----------------------------------------------------------------------------------------

def skewed(spark, n=4000):
    """A value with a third of all rows, ties, NULLs, and a long tail; an extra column."""
    rows = [(i, "hot" if i % 3 == 0 else None if i % 17 == 0 else f"v{i % 700}", i % 5, "x") for i in range(n)]
    return spark.createDataFrame(rows, "id long, a string, b int, _v string").repartition(6)


@pytest.mark.parametrize("heavy", [1 << 16, 8, 2])
def test_encoding_equals_the_indexer(spark, heavy):
    df = skewed(spark)
    want = encode.index_categories(df, ["a", "b"])[1]
    got = encode.encode_categories(df, ["a", "b"], heavy=heavy)
    assert got.columns == want.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


@pytest.mark.parametrize("heavy", [1 << 16, 4])
def test_unseen_and_null_values(spark, heavy):
    train = spark.createDataFrame([("x",), ("x",), ("y",), ("z",), (None,)], "c string")
    new = spark.createDataFrame([(1, "x"), (2, "unseen"), (3, None), (4, "z")], "id int, c string")
    known = encode.category_frequencies(train, ["c"])
    kept = encode.encode_categories(new, ["c"], known, "keep", heavy)
    assert {r["id"]: r["c_index"] for r in kept.collect()} == {1: 0.0, 2: 3.0, 3: 3.0, 4: 2.0}
    assert sorted(r["id"] for r in encode.encode_categories(new, ["c"], known, "skip", heavy).collect()) == [1, 4]
    with pytest.raises(Exception, match="vocabulary lacks"):
        encode.encode_categories(new, ["c"], known, "error", heavy).collect()
    assert encode.encode_categories(new.limit(0), ["c"], known, "keep", heavy).count() == 0


def test_a_large_vocabulary_stays_distributed(spark):
    """Many categories, few of them broadcast: the plan broadcasts the head only and scans the rows once."""
    df = spark.range(300000, numPartitions=8).select("id", F.concat(F.lit("c"), F.pmod("id", F.lit(200000))).alias("c"))
    got = encode.encode_categories(df, ["c"], heavy=1000)
    assert "ShuffledHashJoin" in plan(got)
    row = got.agg(F.count_distinct("c_index").alias("k"), F.max("c_index").alias("top"), F.count("c_index").alias("n")).first()
    assert (row["k"], row["top"], row["n"]) == (200000, 199999.0, 300000)
    first = got.where("c_index < 100000").agg(F.count(F.lit(1))).first()[0]
    assert first == 200000  # those that come twice rank first


# --- profiles ----------------------------------------------------------------------------------------------------

def test_distinct_counts_copy_no_rows(spark):
    df = stand_in.prepared(spark, SF)
    p = plan(profile.profile_cardinality(df, E.CARDINALITY))
    assert "Expand" not in p


def test_distinct_counts_of_odd_values(spark, monkeypatch):
    monkeypatch.setattr(profile, "_HELD", 50)
    import datetime as dt
    rows = [(float(i % 90), i % 7 == 0, dt.date(2024, 1, 1 + i % 28), f"s{i % 120}", [i % 3]) for i in range(600)]
    rows += [(-0.0, None, None, "", [1]), (float("nan"), None, None, None, None), (None, None, None, "\x00", [])]
    df = spark.createDataFrame(rows, "d double, b boolean, t date, s string, a array<int>").repartition(5)
    got = {r["column_name"]: r["n_distinct"] for r in profile.profile_cardinality(df).collect()}
    assert got == {"d": 90, "b": 2, "t": 28, "s": 122, "a": 4}
    none = {r["column_name"]: (r["n"], r["n_distinct"]) for r in profile.profile_cardinality(df.limit(0)).collect()}
    assert set(none.values()) == {(0, 0)}


def test_merged_states_are_the_state_of_the_union(spark):
    df = stand_in.prepared(spark, SF)
    cols = ["l_quantity", "l_extendedprice", "l_orderkey", "label"]
    parts = [profile.profile_state(df.where(f"l_linenumber % 3 = {i}"), cols) for i in range(3)]
    path = shared_dir(spark, "states", fresh_name("s"))
    for p in parts:
        p.write.mode("append").parquet(path)  # a state is data: it is stored and read again
    merged = profile.profile_ranges(profile.merge_states(spark.read.parquet(path))).collect()
    whole = {r["column_name"]: r for r in profile.profile_ranges(profile.profile_state(df, cols)).collect()}
    pdf = df.select(*cols).toPandas().astype(float)
    for r in merged:
        w, x = whole[r["column_name"]], np.sort(pdf[r["column_name"]].to_numpy())
        for f in ("n", "n_null", "n_zero", "min_value", "max_value"):
            assert r[f] == w[f], f
        # One registers' content, two estimators: a sketch that was never merged remembers the order of its values.
        assert r["n_distinct"] == pytest.approx(w["n_distinct"], rel=0.03)
        for share, name in ((0.01, "q01"), (0.25, "q25"), (0.5, "q50"), (0.75, "q75"), (0.99, "q99")):
            low, high = np.searchsorted(x, r[name], "left") / len(x), np.searchsorted(x, r[name], "right") / len(x)
            assert low - 0.03 <= share <= high + 0.03, name  # rank error, not value error
        assert abs(r["n_distinct"] - len(np.unique(x))) <= max(2, 0.06 * len(np.unique(x)))


def test_states_merge_in_any_order(spark):
    df = stand_in.prepared(spark, SF)
    a, b, c = (profile.profile_state(df.where(f"l_linenumber % 3 = {i}"), ["l_orderkey", "label"]) for i in range(3))
    one = profile.merge_states(profile.merge_states(a, b), c)
    two = profile.merge_states(a, profile.merge_states(c, b))
    fields = ("column_name", "n", "n_distinct", "min_value", "max_value")
    assert sorted(map(tuple, profile.profile_ranges(one).select(*fields).collect())) == \
        sorted(map(tuple, profile.profile_ranges(two).select(*fields).collect()))


def test_missing_values_in_states(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (None, None), (1000.0, None), (1.5, None), (2.0, None)],
                               "x double, y double")
    got = {r["column_name"]: r for r in profile.profile_ranges(profile.profile_state(df)).collect()}
    assert (got["x"]["n"], got["x"]["n_null"], got["x"]["n_distinct"], got["x"]["max_value"]) == (4, 2, 4, 1000.0)
    assert (got["y"]["n"], got["y"]["n_null"], got["y"]["n_distinct"], got["y"]["q50"]) == (0, 6, 0, None)
    assert profile.profile_ranges(profile.profile_state(df.limit(0))).count() == 2


# --- exact split -------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("hash_fn", ["xxhash64", "md5"])
@pytest.mark.parametrize("share", [0.7, 0.0, 1.0, 0.001])
def test_exact_sizes_whatever_the_layout(spark, hash_fn, share):
    df = stand_in.prepared(spark, SF).select("row_key", "l_quantity")
    n = df.count()
    one, two = split.exact_split(df, "row_key", share, hash_fn)
    assert (one.count(), two.count()) == (int(n * share + 0.5), n - int(n * share + 0.5))
    again = split.exact_split(df.repartition(13), "row_key", share, hash_fn)[0]
    assert Counter(map(tuple, one.collect())) == Counter(map(tuple, again.collect()))


def test_exact_split_of_equal_keys_and_rows(spark, monkeypatch):
    """A third of the rows share a key at the bound, and many rows are equal in everything."""
    monkeypatch.setattr(split, "STEP_BITS", 5)
    rows = [("hot", i % 4) for i in range(400)] + [(None, 1)] * 90 + [(f"k{i}", 0) for i in range(110)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(7)
    for share in (0.1, 0.33, 0.5, 0.62, 0.9):
        sides = [Counter(map(tuple, s.collect())) for s in split.exact_split(df, "k", share)]
        assert sum(sides[0].values()) == int(600 * share + 0.5)
        assert sides[0] + sides[1] == Counter(rows)
        other = [Counter(map(tuple, s.collect())) for s in split.exact_split(df.coalesce(1), "k", share)]
        assert other == sides
    empty = split.exact_split(df.limit(0), "k")
    assert [s.count() for s in empty] == [0, 0]


# --- CSV ---------------------------------------------------------------------------------------------------------

def test_inferred_types_and_malformed_lines(spark):
    lines = ["id,amount,big,flag,day,at,text,none", "1,2.5,9000000000,true,2024-01-02,2024-01-02 03:04:05,20141013T000000,",
             " 2 ,3,4,FALSE,2024-02-30x,2024-01-02,abc,", "3,-1e3,5,true,2024-01-03,2024-05-01T10:00:00,,", "too,few", "1,2,3,4,5,6,7,8,9",
             '4,0.5,6,false,2024-01-04,2024-01-02 00:00:00,"with, comma",']
    path = shared_dir(spark, "csv", fresh_name("odd"))
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    good, bad = csv.read_csv_inferred(spark, path)
    assert dict(good.dtypes) == {"id": "int", "amount": "double", "big": "bigint", "flag": "boolean", "day": "string",
                                 "at": "timestamp", "text": "string", "none": "string"}
    rows = {r["id"]: r for r in good.collect()}
    assert sorted(rows) == [1, 2, 3, 4] and rows[4]["text"] == "with, comma" and rows[2]["flag"] is False and rows[3]["text"] is None
    assert sorted(r["line"] for r in bad.collect()) == ["1,2,3,4,5,6,7,8,9", "too,few"]


def test_inferred_charges_equal_the_table(spark):
    src = stand_in.charges(spark, SF)
    path = shared_dir(spark, "csv", fresh_name("charges"))
    csv.write_csv(src, path)
    good, bad = csv.read_csv_inferred(spark, path)
    assert bad.count() == 0 and good.count() == src.count()
    assert good.agg(F.sum("charge")).first()[0] == pytest.approx(src.agg(F.sum("charge")).first()[0], rel=1e-12)
    none = shared_dir(spark, "csv", fresh_name("none"))
    csv.write_csv(src.limit(0).coalesce(1), none)
    assert csv.read_csv_inferred(spark, none, names=src.columns)[0].count() == 0


def test_type_tests_agree_with_the_casts(spark):
    texts = ["0", "+7", "-1", "-", "007", "2147483647", "2147483648", "-2147483648", "-2147483649", "9223372036854775807", "9223372036854775808",
             "-9223372036854775808", "-9223372036854775809", "0000000000000000000009", "18446744073709551615", "\t5\n", "5\x7f", "1.", ".5", ".",
             "1e3", "1e", "1.5f", "2D", "0x1p3", "0x1", "NaN", "-inf", "Infinity", "infinit", "31521-6-9346-437", "4136-6-155-59", "1234-5",
             "2024-02-29", "2023-02-29", "2024-04-31", "0000-00-00", "2024-1-2", "2024-01-02T", "2024-01-02 3", "2024-01-02 03:04:05.123456789",
             "2024-01-02 24:00:00", "2024-01-02 03:04:05 UTC+01:00", "2024-01-02T03:04:05Z", "2024-01-02 03:04:05 INFO x", "2024-01-02 03:04:05 PST",
             "2024-01-02 03:04 UTC", "2024-01", "2024-", "20141013T000000", "true", "N", "\uff11\uff12", "1\u2028", ""]
    df = spark.createDataFrame([(v,) for v in [*texts, None]], "v string")
    begins = {"date": "v RLIKE '^[0-9]{4}-[0-9]{2}-[0-9]{2}$' AND ", "timestamp": "v RLIKE '^[0-9]{4}-' AND "}
    for kind, shape, test in csv.LATTICE:
        cast = "lower(v) IN ('true', 'false')" if kind == "boolean" else f"{begins.get(kind, '')}try_cast(v AS {kind}) IS NOT NULL"
        assert df.where(f"NOT (({cast}) <=> ({csv.type_test('v', shape, test)}))").collect() == [], kind


def test_text_is_inferred_as_fast_as_numbers(spark):
    def took(value):
        path = shared_dir(spark, "csv", fresh_name("pace"))
        spark.range(0, 100_000, 1, 4).select(F.concat_ws(",", *[F.expr(value).cast("string")] * 4).alias("value")).write.text(path)
        texts = csv._text_columns(spark, path, list("abcd"), False, ",", {})
        seconds = []
        for _ in range(3):
            begin = time.perf_counter()
            kinds = csv.infer_types(texts, list("abcd"))
            seconds.append(time.perf_counter() - begin)
        return min(seconds), kinds["a"]
    numbers, texts = took("id"), took("concat('key-', id)")
    assert (numbers[1], texts[1]) == ("int", "string")
    assert texts[0] < 4 * numbers[0] + 0.5  # a failed try_cast throws, which costs many times what a number does


def _by_casts(rows, names, spark):
    """The narrowest type of each column, from casts of all values alone (a NULL is of no type but boolean, as in the lattice)."""
    df, kinds = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in names)), {}
    ok = {"boolean": "lower(trim({c})) IN ('true', 'false')",
          "date": "trim({c}) RLIKE '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$' AND try_cast(trim({c}) AS DATE) IS NOT NULL",
          "timestamp": "trim({c}) RLIKE '^[0-9]{{4}}-' AND try_cast(trim({c}) AS TIMESTAMP) IS NOT NULL"}
    for c in names:
        tests = [f"bool_and({ok.get(k, f'try_cast(trim({{c}}) AS {k}) IS NOT NULL').format(c=c)}) AS {k}" for k, *_ in csv.LATTICE]
        row = df.selectExpr(*tests).first()
        kinds[c] = next((k for k, *_ in csv.LATTICE if row[k]), "string")
    return kinds


def test_plain_texts_are_of_the_types_that_the_tests_give(spark):
    texts = ["0", "-0", "7", "-7", "007", "999999999", "-99999999", "-999999999", "9999999999", "-", "", "5\n", "1.", ".5", "1.5", "-0.0", "00.50",
             "1.5\n", "1.2.3", "-1-2.3", "9" * 400 + ".0", "0." + "0" * 400 + "1", "1.5f", "12345.1e3", "2024-02-28", "2024-02-29", "2023-02-29",
             "2024-04-30", "2024-04-31", "2024-12-31", "2024-13-01", "2024-00-10", "2024-01-00", "0000-01-01", "0001-01-01", "9999-12-31", "2024-01-02\n",
             "2024-01-02 03:04:05", "2024-02-29 03:04:05", "2023-02-29 03:04:05", "2024-04-31 03:04:05", "2024-01-02 24:00:00", "2024-01-02 23:59:60",
             "2024-01-02T03:04:05", "0000-01-01 00:00:00", "9999-12-31 23:59:59", "2024-03-31 02:30:00", "31234.5678900000019", "1234567890123456789",
             "true", "FALSE", "N", "nan", "\uff11\uff12", "2024-1-2", "2024-01", "+7"]
    df = spark.createDataFrame([(v,) for v in [*texts, None]], "v string")
    for kinds in ({k for k, *_ in csv.LATTICE}, {"int", "double"}, {"date"}, {"boolean", "timestamp"}):
        each = [f"CASE WHEN coalesce({csv.type_test('v', shape, test)}, true) THEN {1 << j} ELSE 0 END"
                for j, (kind, shape, test) in enumerate(csv.LATTICE) if kind in kinds]
        assert df.selectExpr("v", f"{csv.types_of('v', kinds)} AS got", f"{' | '.join(each)} AS due").where("got <> due").collect() == []


def test_late_values_and_late_nulls_rule_types_out(spark):
    """What the first lines leave open is decided by all lines, wherever a value stands."""
    names, n = list("abcdefghij"), 3 * csv.FIRST_LINES
    usual = {"a": "1", "b": "1", "c": "1", "d": "2024-01-02", "e": "2024-01-02 03:04:05", "f": None, "g": None, "h": "0.5", "i": "key", "j": "true"}
    late = {"b": "9000000000", "c": "1e3", "d": "2024-01-02 00:00:00", "e": "2024-02-30 00:00:00", "f": "TRUE", "h": None, "i": "1", "j": None}
    rows = [tuple(usual[c] for c in names)] * n
    rows[-1] = tuple(late.get(c, usual[c]) for c in names)
    due = {"a": "int", "b": "bigint", "c": "double", "d": "timestamp", "e": "string", "f": "boolean", "g": "string", "h": "string", "i": "string",
           "j": "boolean"}
    assert _by_casts(rows, names, spark) == due
    for parts in (1, 5):
        path = shared_dir(spark, "csv", fresh_name("late"))
        lines = [(",".join(v or "" for v in r),) for r in rows] + [("too,few",)]
        spark.createDataFrame(lines, "value string").coalesce(1).repartition(parts).write.text(path)
        good, bad = csv.read_csv_inferred(spark, path, names=names, header=False)
        assert dict(good.dtypes) == due and good.count() == n and [r["line"] for r in bad.collect()] == ["too,few"]
    # A file without a line that has all columns: every column is text.
    path = shared_dir(spark, "csv", fresh_name("few"))
    spark.createDataFrame([("1,2",)] * 9, "value string").write.text(path)
    good, bad = csv.read_csv_inferred(spark, path, names=names, header=False)
    assert {k for _, k in good.dtypes} == {"string"} and (good.count(), bad.count()) == (0, 9)


def test_all_lines_are_tested_only_for_types_left_open(spark, monkeypatch):
    seen, types_of_all = [], csv._types_of_all

    def watched(cells, left):
        seen.append((left, cells.agg(F.count("1")).first()[0]))
        return types_of_all(cells, left)
    monkeypatch.setattr(csv, "_types_of_all", watched)
    path = shared_dir(spark, "csv", fresh_name("open"))
    n = 20 * csv.FIRST_LINES
    spark.range(0, n, 1, 3).selectExpr("concat_ws(',', concat(id, '-', id), id, id / 8, 'N', date'2024-01-01' + CAST(id AS INT)) AS value").write.text(path)
    good, _ = csv.read_csv_inferred(spark, path, names=list("abcde"), header=False)
    assert [k for _, k in good.dtypes] == ["string", "int", "double", "string", "date"]
    assert seen[0][1] == csv.FIRST_LINES and seen[1] == ({"1": {"int", "bigint", "double"}, "2": {"double"}, "4": {"date", "timestamp"}}, n)


def test_types_cost_little_more_than_reading(spark):
    path, names = shared_dir(spark, "csv", fresh_name("cost")), list("abcdef")
    spark.range(0, 1_000_000, 1, 8).selectExpr("concat_ws(',', concat_ws('-', id, id % 7, id), id, concat_ws('.', id, id, id), substr('ANR', 1 + id % 3, 1), "
                                               "date_format(timestamp_seconds(id * 977), 'yyyy-MM-dd HH:mm:ss'), concat(id, ' pieces')) AS value").write.text(path)
    texts = csv._text_columns(spark, path, names, False, ",", {})

    def took(act):
        seconds = []
        for _ in range(3):
            begin = time.perf_counter()
            out = act()
            seconds.append(time.perf_counter() - begin)
        return min(seconds), out
    reading, _ = took(lambda: texts.selectExpr(*[f"sum(length({c})) AS {c}" for c in names]).first())
    inferring, kinds = took(lambda: csv.infer_types(texts, names))
    assert list(kinds.values()) == ["string", "int", "string", "string", "timestamp", "string"]
    assert inferring < 3 * reading + 0.3, (inferring, reading)  # with every test on every value it is more than four times the reading


# --- versions ----------------------------------------------------------------------------------------------------

def test_a_failed_write_leaves_the_old_version(spark):
    name = fresh_name("kept")
    old = versions.replace_table(spark.range(10), name)
    reader = tables.read_table(spark, name)
    broken = spark.range(10).select(F.raise_error(F.lit("broken")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        versions.replace_table(broken, name)
    assert tables.read_table(spark, name).count() == 10
    new = versions.replace_table(tables.read_table(spark, name).selectExpr("id * 2 AS twice", "id"), name)  # reads what it replaces
    assert new != old and tables.read_table(spark, name).columns == ["twice", "id"]
    assert reader.columns == ["id"] and reader.count() == 10  # began before the switch
    assert versions.remove_old(spark, name, new) == 2  # the old one, and what the failed write left
    assert tables.read_table(spark, name).agg(F.sum("twice")).first()[0] == 90
    versions.drop_versions(spark, name)
    assert not spark.catalog.tableExists(name)


# --- tuning from sums ----------------------------------------------------------------------------------------------

def objective(x, y, w, b, lam, a):
    sx, sy = x.std(axis=0), y.std()
    z = w * sx / sy
    err = (y - x @ w - b) / sy
    return 0.5 * (err @ err) / len(y) + lam / sy * (a * np.abs(z).sum() + (1 - a) / 2 * z @ z)


def test_sums_merge_to_the_whole():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 5)) * [1, 10, 0, 1, 1e-3] + [1e9, -4, 7.7, 0, 2]
    whole = sufficient.Sums.of(x)
    parts = [sufficient.Sums.load(sufficient.Sums.of(p).dump()) for p in np.array_split(x, 7)]
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.merge(p)
    assert merged.n == 300 and np.allclose(merged.mean, x.mean(axis=0), rtol=1e-12)
    exact = x - x.mean(axis=0)
    assert np.allclose(merged.moments[1:, 1:], (exact.T @ exact)[1:, 1:], rtol=1e-9, atol=1e-9)
    assert merged.moments[2, 2] == 0 == whole.moments[2, 2]  # a constant column does not vary at all


@pytest.mark.parametrize("share", [0.0, 0.5, 1.0])
def test_elastic_net_meets_its_conditions(share):
    rng = np.random.default_rng(4)
    hot = np.eye(4)[rng.integers(0, 4, 400)]  # one-hot columns depend on each other
    x = np.column_stack((rng.normal(size=(400, 6)), hot, np.ones(400)))
    y = x @ rng.normal(size=11) + rng.normal(size=400) * 0.1 + 3
    state = sufficient.Sums.of(np.column_stack((x, y)))
    fits = sufficient.elastic_net_path(state, [(r, share) for r in (0.01, 0.1, 0.5)])
    for lam, f in zip((0.01, 0.1, 0.5), fits):
        assert f.coefficients[-1] == 0
        best = objective(x, y, f.coefficients, f.intercept, lam, share)
        for _ in range(200):  # no step in any direction is lower
            step = rng.normal(size=11) * 10.0 ** rng.uniform(-6, -1)
            w = f.coefficients + step * (x.std(axis=0) > 0)
            assert objective(x, y, w, y.mean() - w @ x.mean(axis=0), lam, share) >= best - 1e-13
        err = y - x @ f.coefficients - f.intercept
        assert sufficient.score(state, f, "rmse") == pytest.approx(np.sqrt((err ** 2).mean()), rel=1e-9)
        assert sufficient.score(state, f, "r2") == pytest.approx(1 - (err ** 2).mean() / y.var(), rel=1e-9)


def test_sums_and_mllib_tune_alike(spark):
    """Same grid errors, winner, and predictions; MLlib's own stopping rule is coarser with an absolute penalty."""
    df = stand_in.prepared(spark, SF)
    numeric = ["l_extendedprice", "l_quantity", "l_discount", "l_tax", "unit_price"]
    spec = stand_in.SPEC
    ours, _, holdout = regression_job.fit(df, spec, numeric, solver="sums", elastic_net_params=(0.0,))
    theirs, _, _ = regression_job.fit(df, spec, numeric, solver="mllib", elastic_net_params=(0.0,))
    assert np.allclose([v for *_, v in ours.grid], [v for *_, v in theirs.grid], rtol=1e-6) and ours.best == theirs.best
    assert (ours.n_train, ours.train_r2) == (theirs.n_train, pytest.approx(theirs.train_r2, rel=1e-6))
    a, b = ([r["prediction"] for r in t.model.transform(holdout).orderBy("row_key").select("prediction").collect()]
            for t in (ours, theirs))
    assert np.allclose(a, b, rtol=1e-6)
    assert mdl.model_coefficients(ours.model, holdout).count() == 18
    mixed = [regression_job.fit(df, spec, numeric, solver=s, reg_params=(0.1,), elastic_net_params=(0.5, 1.0))[0] for s in ("sums", "mllib")]
    assert np.allclose([v for *_, v in mixed[0].grid], [v for *_, v in mixed[1].grid], rtol=1e-5)


def test_absolute_error_is_tuned_by_mllib(spark):
    df = spark.createDataFrame([(f"k{i}", float(i % 13), 2.0 * (i % 13) + i % 2) for i in range(200)], "k string, x double, y double")
    tuned = mdl.tune(df, "k", ["x"], label="y", metric="mae", reg_params=(0.1,), elastic_net_params=(0.0,))
    assert 0 < tuned.grid[0][2] < 2
    with pytest.raises(ValueError, match="solver"):
        mdl.tune(df, "k", ["x"], label="y", solver="other")
