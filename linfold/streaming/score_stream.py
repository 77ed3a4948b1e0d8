"""Score batches of new rows as they land, with a saved pipeline (Structured Streaming).

The batch scorer (derive the ratio columns, ``PipelineModel.transform``) applied to
a file stream: each micro-batch is a row-local projection, so it needs no state;
progress lives in the checkpoint folder, so a restarted query resumes where it
stopped and a lost executor only re-runs its tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from linfold.operators.project import add_ratios
from linfold.sources.models import load_model
from linfold.spec import FeatureSpec


def scored_stream(spark: SparkSession, source_dir: str, schema: StructType, model_uri: str, spec: FeatureSpec,
                  fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming frame of (key, prediction) for every row of every new file."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.load(source_dir)
    scored = load_model(model_uri).transform(add_ratios(rows, spec))
    keep = [spec.key] if spec.key else []
    return scored.select(*keep, F.col("prediction"))


def score_available(spark: SparkSession, source_dir: str, schema: StructType, model_uri: str, spec: FeatureSpec,
                    sink_dir: str | None, checkpoint_dir: str, fmt: str = "parquet", table: str | None = None):
    """Score everything not yet scored, append it (to ``sink_dir`` as parquet, or to the
    catalog table ``table``), then stop."""
    writer = (scored_stream(spark, source_dir, schema, model_uri, spec, fmt)
              .writeStream.outputMode("append").option("checkpointLocation", checkpoint_dir)
              .trigger(availableNow=True))
    if table is not None:
        q = writer.format("parquet").toTable(table)
    else:
        q = writer.format("parquet").option("path", sink_dir).start()
    q.awaitTermination()
    return q
