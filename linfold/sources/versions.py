"""Tables that are replaced as a whole: a name points at one of several written versions.

Overwriting a managed table drops it first, so a write that fails leaves nothing, and readers see files
vanish. Here every version is written to a folder of its own and only then named, by one change in
the catalog (a view over the folder). A failed write leaves the old version named; a reader that began before the
switch reads its version to the end. Old versions stay until ``remove_old`` deletes them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from linfold.session import fresh_name, shared_dir
from linfold.sources.tables import qualified


def _folder(spark: SparkSession, name: str, database: str | None) -> str:
    return shared_dir(spark, "versions", database or "default", name)


def replace_table(df: DataFrame, name: str, database: str | None = None, partition_by=()) -> str:
    """Writes ``df`` as the new version of ``name`` and switches to it; returns the version's folder.

    ``df`` may read the version that it replaces. Columns may change from version to version.
    """
    spark = df.sparkSession
    path = f"{_folder(spark, name, database)}/{fresh_name('v')}"
    df.write.partitionBy(*partition_by).parquet(path) if partition_by else df.write.parquet(path)
    columns = ", ".join(f"`{c.replace('`', '``')}`" for c in df.columns)
    spark.sql(f"CREATE OR REPLACE VIEW {qualified(name, database)} AS SELECT {columns} FROM parquet.`{path}`")
    return path


def drop_versions(spark: SparkSession, name: str, database: str | None = None) -> None:
    """Forgets the name and deletes all its versions."""
    spark.sql(f"DROP VIEW IF EXISTS {qualified(name, database)}")
    _delete(spark, _folder(spark, name, database))


def remove_old(spark: SparkSession, name: str, current: str, database: str | None = None) -> int:
    """Deletes every version but ``current`` (the folder that ``replace_table`` gave); returns how many."""
    place = spark._jvm.org.apache.hadoop.fs.Path(_folder(spark, name, database))
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = 0
    for status in fs.listStatus(place):  # a folder for each version
        if status.getPath().getName() != current.rsplit("/", 1)[-1]:
            fs.delete(status.getPath(), True)
            gone += 1
    return gone


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
