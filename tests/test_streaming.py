from pyspark.sql import functions as F

from linfold.plans import regression_job, stand_in
from linfold.plans.stand_in import SPEC
from linfold.session import fresh_name, shared_dir
from linfold.streaming.score_stream import score_available

SF = "/root/testdata/sf0.001"


def test_stream_scores_each_arriving_batch_once(spark):
    df = stand_in.prepared(spark, SF)
    tuned, _, _ = regression_job.fit(df, SPEC, ["l_extendedprice", "unit_price"], parallelism=2)
    uri = shared_dir(spark, "models", fresh_name("m"))
    tuned.model.write().overwrite().save(uri)
    unlabelled = stand_in.charges(spark, SF).drop("charge", "l_shipdate")
    src, sink, ckpt = (shared_dir(spark, "stream", fresh_name(p)) for p in ("src", "sink", "ckpt"))
    first, second = unlabelled.randomSplit([0.5, 0.5], seed=1)
    first.write.mode("append").parquet(src)
    score_available(spark, src, unlabelled.schema, uri, SPEC, sink, ckpt)
    second.write.mode("append").parquet(src)
    score_available(spark, src, unlabelled.schema, uri, SPEC, sink, ckpt)
    out = spark.read.parquet(sink)
    assert out.count() == unlabelled.count()
    batch = regression_job.score(uri, unlabelled, SPEC)
    a = out.agg(F.sum("prediction")).first()[0]
    b = batch.agg(F.sum("prediction")).first()[0]
    assert abs(a - b) <= 1e-6 * abs(b)


def test_stream_appends_to_a_catalog_table(spark):
    from linfold.sources import catalog

    df = stand_in.prepared(spark, SF)
    tuned, _, _ = regression_job.fit(df, SPEC, ["l_extendedprice"], parallelism=2)
    uri = shared_dir(spark, "models", fresh_name("m"))
    tuned.model.write().overwrite().save(uri)
    unlabelled = stand_in.charges(spark, SF).drop("charge", "l_shipdate")
    src, ckpt = (shared_dir(spark, "stream", fresh_name(p)) for p in ("src", "ckpt"))
    unlabelled.write.parquet(src)
    db = catalog.create_namespace(spark, "t_stream", location=shared_dir(spark, "ns", "t_stream"))
    score_available(spark, src, unlabelled.schema, uri, SPEC, None, ckpt, table=f"{db}.scored")
    assert spark.table(f"{db}.scored").count() == unlabelled.count()
    catalog.drop_namespace(spark, db)
