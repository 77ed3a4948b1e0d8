"""Categorical indexing, dictionary encoding, one-hot encoding and vector assembly.

The source job fitted one ``StringIndexer`` per categorical column (three passes);
here one multi-column estimator fits them all in one pass. Indexing, encoding and
assembly are row-local projections: no shuffle, scale with the partitions.
"""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linfold.functions.exprs import lit_str, q
from linfold.session import fresh_name, shared_dir


def index_name(c: str) -> str:
    return f"{c}_index"


def vector_name(c: str) -> str:
    return f"{c}_vector"


_FREQ_SCHEMA = "column_name string, category string, n bigint, category_index double"
def _order():
    return F.col("column_name"), F.desc("n"), F.asc("category")


def _rank_distributed(vocab: DataFrame) -> DataFrame:
    """Frequency rank of every category with no per-column task: one global range sort.

    The sorted vocabulary is checkpointed so partition contents are fixed; a row's
    global position is its partition's start (a running sum over one row per
    partition) plus its position inside the partition (low 33 bits of
    ``monotonically_increasing_id``). A column's first position is subtracted.
    Both broadcast sides are size-proven: one row per partition, one per column.
    """
    ordered = vocab.orderBy(*_order()).checkpoint(eager=True)
    tagged = ordered.withColumn("_part", F.spark_partition_id()) \
        .withColumn("_pos", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33))
    sizes = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    placed = tagged.join(F.broadcast(starts), "_part").withColumn("_g", F.col("_start") + F.col("_pos"))
    first = placed.groupBy("column_name").agg(F.min("_g").alias("_first"))
    return placed.join(F.broadcast(first), "column_name").select(
        "column_name", "category", "n", (F.col("_g") - F.col("_first")).cast("double").alias("category_index"))


def category_frequencies(df: DataFrame, cols) -> DataFrame:
    """Frequency table and the index a frequency-ordered indexer assigns.

    Output: (column_name, category, n, category_index). Order: count desc, then the
    category's text asc (numbers compare as text, as ``StringIndexer`` does);
    NULLs are not categories. Counting is a map-side-combined group-by on
    (column, value), so hot values cost nothing extra; the vocabulary is then ranked
    by a distributed sort, whatever its size.
    """
    cols = list(cols)
    if not cols:
        return df.sparkSession.createDataFrame([], _FREQ_SCHEMA)
    structs = ", ".join(f"named_struct('column_name', {lit_str(c)}, 'category', CAST({q(c)} AS STRING))"
                        for c in cols)
    long = df.selectExpr(f"inline(array({structs}))")
    counts = long.filter(F.col("category").isNotNull()).groupBy("column_name", "category") \
        .agg(F.count(F.lit(1)).alias("n"))
    shared_dir(df.sparkSession)  # checkpoint folder: the cluster's, or set locally only when unset
    return _rank_distributed(counts)


def check_category_bounds(df: DataFrame, cols, max_categories: int) -> dict:
    """Raises if a column has more distinct values than the caller allows (an id column
    given the wrong role). Exact counts; asked for by the caller only: no limit is assumed."""
    cols = list(cols)
    if not cols:
        return {}
    row = df.agg(*[F.count_distinct(c).alias(c) for c in cols]).first()
    counts = {c: int(row[c]) for c in cols}
    wide = {c: n for c, n in counts.items() if n > max_categories}
    if wide:
        raise ValueError(f"too many distinct values for a categorical column: {wide}; "
                         f"treat it as numeric or hash it (limit {max_categories})")
    return counts


def category_indexer(cols, handle_invalid: str = "keep", order: str = "frequencyDesc") -> StringIndexer:
    """One estimator for all categorical columns. ``keep`` maps unseen and NULL values to
    one extra index (the source job's default ``error`` failed on a rare holdout value)."""
    cols = list(cols)
    return StringIndexer(inputCols=cols, outputCols=[index_name(c) for c in cols],
                         handleInvalid=handle_invalid, stringOrderType=order)


def one_hot_encoder(cols, drop_last: bool = True, handle_invalid: str = "error") -> OneHotEncoder:
    cols = list(cols)
    return OneHotEncoder(inputCols=[index_name(c) for c in cols], outputCols=[vector_name(c) for c in cols],
                         dropLast=drop_last, handleInvalid=handle_invalid)


def feature_assembler(cols, output: str = "features", handle_invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(cols), outputCol=output, handleInvalid=handle_invalid)


#: Categories of all columns that encoding broadcasts, the most frequent ones; the others are joined through a shuffle.
HEAVY = 1 << 16
#: Ways in which rows that need no lookup are dealt out in that shuffle.
SALTS = 4096


def encode_categories(df: DataFrame, cols, vocabulary: DataFrame | None = None, handle_invalid: str = "keep",
                      heavy: int = HEAVY) -> DataFrame:
    """``df`` with ``{c}_index`` for each column, from a vocabulary as ``category_frequencies`` gives it (by default its own).

    No vocabulary reaches the driver or a task as a whole. The ``heavy`` most frequent categories are
    broadcast: they are the only hot keys, and most rows. Columns with more categories look the others up by a
    shuffle join on the value, in which no key has more rows than the least frequent broadcast category; rows that
    need no lookup are dealt out evenly there. The plan has one scan of ``df``.

    A NULL or unseen value gets the index after the last one ("keep"), fails the job ("error") or drops its row
    ("skip"), as with ``category_indexer``.
    """
    if handle_invalid not in ("keep", "error", "skip"):
        raise ValueError(f"unknown handle_invalid {handle_invalid!r}")
    cols = list(cols)
    known = vocabulary if vocabulary is not None else category_frequencies(df, cols)
    spark = df.sparkSession
    path = shared_dir(spark, "vocabulary", fresh_name("ranked"))
    known.select("column_name", "category", "n", "category_index").write.parquet(path)
    known = spark.read.parquet(path)
    sizes = {r["column_name"]: r["k"] for r in known.groupBy("column_name").agg(F.count(F.lit(1)).alias("k")).collect()}
    # By rank, so that ties of counts do not matter: the first ``each`` categories of a column, ``heavy`` in all.
    each = max(1, heavy // max(1, len(cols)))
    out = df
    for i, c in enumerate(cols):
        mine = known.filter(F.col("column_name") == c).select(F.col("category").alias("_v"), F.col("category_index").alias("_i"))
        value = F.col(q(c)).cast("string")
        top = F.broadcast(mine.filter(F.col("_i") < each).select(F.col("_v").alias(f"_hv{i}"), F.col("_i").alias(f"_hi{i}")))
        out = out.join(top, value == F.col(f"_hv{i}"), "left").drop(f"_hv{i}")
        if sizes.get(c, 0) > each:
            tail = mine.filter(F.col("_i") >= each).select(F.col("_v").alias(f"_tv{i}"), F.col("_i").alias(f"_ti{i}"),
                                                           F.lit(0).cast("long").alias(f"_ts{i}"))
            done = F.col(f"_hi{i}").isNotNull() | F.col(q(c)).isNull()
            out = out.withColumn(f"_key{i}", F.when(~done, value)) \
                .withColumn(f"_salt{i}", F.when(done, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)) + 1).otherwise(0)) \
                .join(tail.hint("shuffle_hash"), (F.col(f"_key{i}") == F.col(f"_tv{i}")) & (F.col(f"_salt{i}") == F.col(f"_ts{i}")),
                      "left").drop(f"_key{i}", f"_salt{i}", f"_tv{i}", f"_ts{i}")
            index = F.coalesce(f"_hi{i}", f"_ti{i}")
        else:
            index = F.col(f"_hi{i}")
        if handle_invalid == "keep":
            index = F.coalesce(index, F.lit(float(sizes.get(c, 0))))
        elif handle_invalid == "error":
            unseen = F.concat(F.lit(f"column {c} has a value that the vocabulary lacks: "), F.coalesce(value, F.lit("NULL")))
            index = F.coalesce(index, F.raise_error(unseen).cast("double"))
        out = out.withColumn(index_name(c), index).drop(f"_hi{i}", f"_ti{i}")
        if handle_invalid == "skip":
            out = out.filter(F.col(q(index_name(c))).isNotNull())
    return out


def index_categories(df: DataFrame, cols, handle_invalid: str = "keep", max_categories: int | None = None):
    """Fit MLlib's indexer over ``cols`` and apply it: returns (model, indexed frame).

    The form that pipelines save. Its fit collects the vocabulary and the model ships it to every task; a caller
    who wants a bound gives ``max_categories`` (checked on exact counts). ``encode_categories`` has no such limit.
    """
    if max_categories is not None:
        check_category_bounds(df, cols, max_categories)
    model = category_indexer(cols, handle_invalid).fit(df)
    return model, model.transform(df)


def unpack_vector(df: DataFrame, vec_col: str, size: int, prefix: str | None = None,
                  keep=()) -> DataFrame:
    """Spread a vector column into ``size`` double columns ``{prefix}_{i}``."""
    prefix = prefix or vec_col
    arr = vector_to_array(F.col(vec_col))
    return df.select(*keep, *[arr.getItem(i).alias(f"{prefix}_{i}") for i in range(size)])


def vector_size(df: DataFrame, vec_col: str) -> int:
    """Width of a vector column, read from its ML attribute metadata (no job)."""
    meta = df.schema[vec_col].metadata.get("ml_attr", {})
    if "num_attrs" in meta:
        return int(meta["num_attrs"])
    attrs = meta.get("attrs", {})
    return sum(len(v) for v in attrs.values())


def vector_slot_names(df: DataFrame, vec_col: str) -> list[str]:
    """Slot names of an assembled vector, in slot order, from its metadata."""
    attrs = df.schema[vec_col].metadata.get("ml_attr", {}).get("attrs", {})
    slots = sorted((a["idx"], a.get("name", f"f{a['idx']}")) for group in attrs.values() for a in group)
    return [name for _, name in slots]
