import pytest
from pyspark.sql import functions as F

from linfold.operators import runs
from linfold.session import fresh_name, shared_dir
from linfold.sources import catalog, csv, preview, tables


def test_namespace_for_and_lifecycle(spark):
    assert catalog.namespace_for("Jane.Doe@Example.com") == "linfold_janedoeexamplecom"
    with pytest.raises(ValueError):
        catalog.namespace_for("@@")
    name = fresh_name("ns")
    catalog.create_namespace(spark, name, location=shared_dir(spark, "ns", name), use=True)
    tables.create_table(spark.range(5), "t", name)
    assert spark.catalog.currentDatabase() == name
    catalog.drop_namespace(spark, name)
    assert not catalog.namespace_exists(spark, name)
    assert spark.catalog.currentDatabase() == "default"


def test_ctas_replaces_and_unlabeled_drops_label(spark):
    db = catalog.create_namespace(spark, "t_ctas", location=shared_dir(spark, "ns", "t_ctas"))
    df = spark.createDataFrame([(1, 2.0, 3.0)], "id bigint, price double, x double")
    tables.create_table(df, "house", db)
    tables.create_table(df.union(df), "house", db)
    assert tables.read_table(spark, "house", db).count() == 2
    tables.create_unlabeled_table(df, "house_unl", "price", db)
    assert tables.read_table(spark, "house_unl", db).columns == ["id", "x"]
    tables.drop_table(spark, "house", db)
    assert not spark.catalog.tableExists(f"{db}.house")
    catalog.drop_namespace(spark, db)


def test_csv_round_trip_and_inference(spark):
    path = shared_dir(spark, "csvtest", fresh_name("c"))
    import os

    os.makedirs(path.replace("file:", ""), exist_ok=True)
    with open(os.path.join(path.replace("file:", ""), "part.csv"), "w") as fh:
        fh.write("id,date,price,bedrooms,bathrooms,zipcode\n")
        fh.write("7129300520,20141013T000000,221900.0,3,1.0,98178\n")
        fh.write("6414100192,20141209T000000,538000.0,3,2.25,98125\n")
    df = csv.read_csv(spark, path, infer_schema=True)
    types = dict(df.dtypes)
    assert types == {"id": "bigint", "date": "string", "price": "double", "bedrooms": "int",
                     "bathrooms": "double", "zipcode": "int"}
    out = shared_dir(spark, "csvtest", fresh_name("o"))
    csv.write_csv(df, out)
    back = csv.read_csv(spark, out, schema=df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_preview_is_ordered_top_n(spark):
    df = spark.range(100).withColumn("k", (F.lit(99) - F.col("id")))
    got = [r["k"] for r in preview.ordered_preview(df, "k", 5).collect()]
    assert got == [0, 1, 2, 3, 4]


def test_run_log_best_and_delete(spark):
    db = catalog.create_namespace(spark, "t_runs", location=shared_dir(spark, "ns", "t_runs"))
    t = fresh_name("runs")
    runs.log_run(spark, t, "exp1", {"regParam": 0.1}, {"rmse": 3.0}, "uri-a", db)
    runs.log_run(spark, t, "exp1", {"regParam": 0.5}, {"rmse": 2.0}, "uri-b", db)
    runs.log_run(spark, t, "exp2", {"regParam": 0.5}, {"rmse": 1.0}, "uri-c", db)
    log = tables.read_table(spark, t, db)
    best = runs.best_run(log, "rmse", "exp1").first()
    assert best["model_uri"] == "uri-b"
    assert runs.delete_runs(spark, t, "exp1", db) == 2
    left = tables.read_table(spark, t, db).collect()
    assert [r["experiment"] for r in left] == ["exp2"]
    catalog.drop_namespace(spark, db)


def test_delete_runs_leaves_other_rows(spark):
    db = catalog.create_namespace(spark, "t_runs3", location=shared_dir(spark, "ns", "t_runs3"))
    t = fresh_name("runs")
    runs.log_runs(spark, t, [(e, {}, {"rmse": 1.0}, None) for e in ("a", "it's", "b")], db)
    with pytest.raises(ValueError):
        runs.log_run(spark, t, None, {}, {}, None, db)
    assert runs.delete_runs(spark, t, "a", db) == 1 and runs.delete_runs(spark, t, "absent", db) == 0
    assert sorted(r["experiment"] for r in tables.read_table(spark, t, db).collect()) == ["b", "it's"]
    assert runs.delete_runs(spark, t, "it's", db) == 1
    assert [r["experiment"] for r in tables.read_table(spark, t, db).collect()] == ["b"]
    catalog.drop_namespace(spark, db)


def test_log_runs_batch(spark):
    db = catalog.create_namespace(spark, "t_runs2", location=shared_dir(spark, "ns", "t_runs2"))
    t = fresh_name("runs")
    ids = runs.log_runs(spark, t, [("e", {"p": 1}, {"rmse": 2.0}, "u1"), ("e", {"p": 2}, {"rmse": 1.5}, "u2")], db)
    assert len(set(ids)) == 2
    assert runs.best_run(tables.read_table(spark, t, db), "rmse", "e").first()["model_uri"] == "u2"
    catalog.drop_namespace(spark, db)


def test_compacted_runs_are_the_same_runs(spark):
    db = catalog.create_namespace(spark, "t_runs4", location=shared_dir(spark, "ns", "t_runs4"))
    t = fresh_name("runs")
    for i in range(4):
        runs.log_run(spark, t, "it's", {"p": i}, {"rmse": float(i)}, f"u{i}", db)
    runs.log_run(spark, t, "other", {}, {"rmse": 9.0}, "v", db)

    def told():
        return sorted((r["experiment"], r["run_id"], r["metrics"]["rmse"]) for r in tables.read_table(spark, t, db).collect())
    before = told()
    assert runs.compact_runs(spark, t, "it's", db) == 4
    assert told() == before
    assert runs.compact_runs(spark, t, "it's", db) == 1 and runs.compact_runs(spark, t, "absent", db) == 0
    runs.log_run(spark, t, "it's", {"p": 9}, {"rmse": -1.0}, "u9", db)
    assert runs.best_run(tables.read_table(spark, t, db), "rmse", "it's").first()["model_uri"] == "u9"
    assert runs.delete_runs(spark, t, "it's", db) == 5 and told() == [x for x in before if x[0] == "other"]
