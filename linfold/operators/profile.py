"""Column profiles (the source job's ``describe()`` and its by-eye range/cardinality check).

Each profile is one global aggregate (no key, so no sort and no replicated rows; one
partial row per task crosses the shuffle), then one output row per column. Statistics
are typed. NaN is missing, like NULL, in every numeric statistic. Exact distinct counts
are an aggregate over (column, value) of their own. ``profile_state`` keeps sketches that
merge, so that new data is profiled without reading the old again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linfold.functions.exprs import lit_str, present, q

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType,
            T.BooleanType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


NUMERIC_PROFILE_SCHEMA = ("column_name string, n bigint, n_null bigint, mean double, stddev double, "
                          "min_value double, max_value double")
STRING_PROFILE_SCHEMA = ("column_name string, n bigint, n_null bigint, min_value string, max_value string, "
                         "max_length bigint")
CARDINALITY_SCHEMA = ("column_name string, n bigint, n_distinct bigint, n_null bigint, n_zero bigint, "
                      "null_share double, zero_share double")


def _empty(df: DataFrame, schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame([], schema)


def _rows(df: DataFrame, aggregates: list[str], fields: list[str], cols) -> DataFrame:
    """One global aggregate, then a row for each column; ``fields`` are 'name: expression', {i} is the column's number."""
    structs = ", ".join(f"named_struct('column_name', {lit_str(c)}, " + ", ".join(
        f"'{name}', {expr.format(i=i)}" for name, expr in (x.split(": ", 1) for x in fields)) + ")"
        for i, c in enumerate(cols))
    return df.selectExpr("count(1) AS n_rows", *aggregates).selectExpr(f"inline(array({structs}))")


def profile_numeric(df: DataFrame, cols=None) -> DataFrame:
    """count, missing, mean, sample stddev, min, max per numeric column.

    Output: (column_name, n, n_null, mean, stddev, min_value, max_value); all
    statistics double, counts bigint; NaN counts as missing.
    """
    cols = list(cols) if cols is not None else numeric_columns(df)
    if not cols:
        return _empty(df, NUMERIC_PROFILE_SCHEMA)
    aggregates = []
    for i, c in enumerate(cols):
        v = present(f"CAST({q(c)} AS DOUBLE)")
        aggregates += [f"count({v}) AS n{i}", f"avg({v}) AS mean{i}", f"stddev_samp({v}) AS sd{i}",
                       f"min({v}) AS lo{i}", f"max({v}) AS hi{i}"]
    return _rows(df, aggregates, ["n: n{i}", "n_null: n_rows - n{i}", "mean: mean{i}", "stddev: sd{i}",
                                  "min_value: lo{i}", "max_value: hi{i}"], cols)


def profile_string(df: DataFrame, cols=None) -> DataFrame:
    """count, nulls, min, max and longest length per string column."""
    cols = list(cols) if cols is not None else string_columns(df)
    if not cols:
        return _empty(df, STRING_PROFILE_SCHEMA)
    aggregates = []
    for i, c in enumerate(cols):
        aggregates += [f"count({q(c)}) AS n{i}", f"min({q(c)}) AS lo{i}", f"max({q(c)}) AS hi{i}",
                       f"CAST(max(length({q(c)})) AS BIGINT) AS len{i}"]
    return _rows(df, aggregates, ["n: n{i}", "n_null: n_rows - n{i}", "min_value: lo{i}", "max_value: hi{i}",
                                  "max_length: len{i}"], cols)


TIME_PROFILE_SCHEMA = ("column_name string, n bigint, n_null bigint, n_distinct bigint, min_value timestamp, "
                       "max_value timestamp")


def time_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))]


def profile_time(df: DataFrame, cols=None) -> DataFrame:
    """count, nulls, distinct values and range per date or timestamp column (values as timestamps)."""
    cols = list(cols) if cols is not None else time_columns(df)
    if not cols:
        return _empty(df, TIME_PROFILE_SCHEMA)
    aggregates = []
    for i, c in enumerate(cols):
        v = f"CAST({q(c)} AS TIMESTAMP)"
        aggregates += [f"count({v}) AS n{i}", f"count(DISTINCT {v}) AS d{i}", f"min({v}) AS lo{i}", f"max({v}) AS hi{i}"]
    return _rows(df, aggregates, ["n: n{i}", "n_null: n_rows - n{i}", "n_distinct: d{i}", "min_value: lo{i}",
                                  "max_value: hi{i}"], cols)


#: Distinct values that a task holds before it hands them on.
_HELD = 1 << 18
_VALUES = pa.schema([("i", pa.int32()), ("x", pa.int64()), ("v", pa.string())])
#: Types whose values are whole numbers, bits or text one to one.
_PLAIN = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _distinct_of_task(batches):
    """(column, value) of the values that a task has seen, each once: rows are not copied for their columns."""
    held: dict[int, list] = {}
    size = 0

    def told():
        for i, parts in held.items():
            values = pc.unique(pa.chunked_array(parts))
            number = pa.types.is_int64(values.type)
            none = pa.nulls(len(values), pa.string() if number else pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), i, dtype=np.int32)),
                                              *((values, none) if number else (none, values))], schema=_VALUES)

    for batch in batches:
        for i, column in enumerate(batch.columns):
            values = pc.unique(column).drop_null()
            kind = values.type
            if pa.types.is_floating(kind):  # a double by its bits
                values = pa.array(values.cast(pa.float64()).to_numpy(zero_copy_only=False).view(np.int64))
            elif pa.types.is_date(kind) or pa.types.is_timestamp(kind):
                values = values.cast(pa.timestamp("us")).cast(pa.int64())
            elif pa.types.is_integer(kind) or pa.types.is_boolean(kind):
                values = values.cast(pa.int64())
            else:
                values = values.cast(pa.string())
            held.setdefault(i, []).append(values)
            size += len(values)
        if size > _HELD:
            held = {i: [pc.unique(pa.chunked_array(parts))] for i, parts in held.items()}
            size = sum(len(p[0]) for p in held.values())
            if size > _HELD // 2:
                yield from told()
                held, size = {}, 0
    yield from told()


def _distinct_counts(df: DataFrame, cols) -> DataFrame:
    """(i, d): distinct values of each column, in two levels: each task's distinct (column, value), then by column."""
    types = {f.name: f.dataType for f in df.schema.fields}
    plain = [(i, c) for i, c in enumerate(cols) if isinstance(types[c], _PLAIN)]
    told = None
    if plain:
        at = F.element_at(F.array(*[F.lit(i) for i, _ in plain]), F.col("i") + 1).alias("i")
        told = df.selectExpr(*[f"{_one_zero(c, types[c])} AS c{i}" for i, c in plain]) \
            .mapInArrow(_distinct_of_task, "i int, x long, v string").groupBy("i", "x", "v").agg(F.lit(1).alias("one")) \
            .groupBy("i").agg(F.count(F.lit(1)).alias("d")).select(at, "d")
    for i, c in enumerate(cols):
        if not isinstance(types[c], _PLAIN):  # nested and binary values: one aggregate each
            one = df.select(q(c)).where(F.col(q(c)).isNotNull()).distinct().agg(F.count(F.lit(1)).alias("d")) \
                .select(F.lit(i).alias("i"), "d")
            told = one if told is None else told.unionByName(one)
    return told


def _one_zero(c: str, kind: T.DataType) -> str:
    """``_valued`` with -0.0 as 0.0."""
    v = _valued(c, kind)
    return f"{v} + 0D" if isinstance(kind, (T.FloatType, T.DoubleType)) else v


def _valued(c: str, kind: T.DataType) -> str:
    """A column's value with NaN as NULL."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return present(f"CAST({q(c)} AS DOUBLE)")
    return q(c)


def profile_cardinality(df: DataFrame, cols=None, exact: bool = True, lg_k: int = 12) -> DataFrame:
    """Distinct values, missing share and zero share per column (range/cardinality screen).

    ``exact`` counts distinct typed values (-0.0 is 0.0) in two levels: (column, value) as each task has seen it, then
    column. A dominant value is one row a task, and no row is copied for each column, as several ``count(DISTINCT)``
    in one aggregate do. ``exact=False`` reads the estimate of an HLL sketch
    with 2**``lg_k`` registers: one pass, fixed-size state, the form for very wide or very large tables. NaN is missing.
    Output: (column_name, n, n_distinct, n_null, n_zero, null_share, zero_share).
    """
    cols = list(cols) if cols is not None else df.columns
    if not cols:
        return _empty(df, CARDINALITY_SCHEMA)
    types = {f.name: f.dataType for f in df.schema.fields}
    aggregates = []
    for i, c in enumerate(cols):
        v = _valued(c, types[c])
        zero = isinstance(types[c], _NUMERIC) and not isinstance(types[c], T.BooleanType)
        aggregates += [f"count({v}) AS n{i}", (f"count_if({v} = 0)" if zero else "CAST(NULL AS BIGINT)") + f" AS z{i}"]
        if not exact:
            aggregates.append(f"coalesce(hll_sketch_estimate(hll_sketch_agg({_sketched(c, types[c])}, {lg_k})), 0L) AS d{i}")
    fields = ["i: {i}", "n: n{i}", "n_distinct: " + ("0L" if exact else "d{i}"), "n_null: n_rows - n{i}", "n_zero: z{i}",
              "null_share: try_divide(n_rows - n{i}, n_rows)", "zero_share: try_divide(z{i}, n_rows)"]
    told = _rows(df, aggregates, fields, cols)
    if exact:  # a row for each column on both sides
        told = told.drop("n_distinct").join(F.broadcast(_distinct_counts(df, cols)), "i", "left") \
            .withColumn("n_distinct", F.coalesce("d", F.lit(0).cast("long")))
    return told.select("column_name", "n", "n_distinct", "n_null", "n_zero", "null_share", "zero_share")


def _sketched(c: str, kind: T.DataType) -> str:
    """A value that an HLL sketch takes: whole numbers and text as they are, the rest by a 64-bit hash."""
    if isinstance(kind, (T.IntegerType, T.LongType, T.StringType, T.BinaryType)):
        return q(c)
    v = _one_zero(c, kind)
    return f"IF({v} IS NULL, NULL, xxhash64({v}))"


#: Rank error of a quantile read from a KLL state with this k is about 1.33 % (99 % of the time).
KLL_K = 200
STATE_SCHEMA = ("column_name string, n_rows bigint, n bigint, n_zero bigint, min_value double, max_value double, "
                "distinct_state binary, quantile_state binary")


def profile_state(df: DataFrame, cols=None, lg_k: int = 12, k: int = KLL_K) -> DataFrame:
    """A mergeable state for each numeric column: counts, range, an HLL sketch of the distinct values and a KLL
    sketch of the quantiles. One scan; a few kilobytes a column, whatever the rows.

    Store one for each file, day or partition; ``merge_states`` makes the state of any union of them, so a profile
    of new data does not read the old again. Output: ``STATE_SCHEMA``.
    """
    cols = list(cols) if cols is not None else numeric_columns(df)
    if not cols:
        return _empty(df, STATE_SCHEMA)
    types = {f.name: f.dataType for f in df.schema.fields}
    aggregates = []
    for i, c in enumerate(cols):
        v = present(f"CAST({q(c)} AS DOUBLE)")
        aggregates += [f"count({v}) AS n{i}", f"count_if({v} = 0) AS z{i}", f"min({v}) AS lo{i}", f"max({v}) AS hi{i}",
                       f"hll_sketch_agg({_sketched(c, types[c])}, {lg_k}) AS h{i}", f"kll_sketch_agg_double({v}, {k}) AS q{i}"]
    return _rows(df, aggregates, ["n_rows: n_rows", "n: n{i}", "n_zero: z{i}", "min_value: lo{i}", "max_value: hi{i}",
                                  "distinct_state: h{i}", "quantile_state: q{i}"], cols)


def merge_states(*states: DataFrame) -> DataFrame:
    """The state of the union of the rows behind ``states`` (each of ``profile_state``)."""
    rows = states[0]
    for s in states[1:]:
        rows = rows.unionByName(s)
    return rows.groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n").alias("n"), F.sum("n_zero").alias("n_zero"),
        F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"),
        F.hll_union_agg("distinct_state").alias("distinct_state"), F.kll_merge_agg_double("quantile_state").alias("quantile_state"))


def profile_ranges(states: DataFrame, quantiles=(0.01, 0.25, 0.5, 0.75, 0.99), wide: float = 100.0) -> DataFrame:
    """What the states say: (column_name, n, n_null, n_zero, n_distinct, min_value, q..., max_value, is_wide).

    ``is_wide``: the whole range is more than ``wide`` times the distance of the outer quartiles, the source job's
    "wide value range" judged by number instead of by eye (a column whose quartiles agree is wide if its ends differ).
    Quantiles have a bounded rank error, not a bounded value error.
    """
    def at(share: float):
        return F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("quantile_state", F.lit(float(share))))
    told = states.select(
        "column_name", "n", (F.col("n_rows") - F.col("n")).alias("n_null"), "n_zero",
        F.coalesce(F.hll_sketch_estimate("distinct_state"), F.lit(0).cast("long")).alias("n_distinct"), "min_value",
        *[at(p).alias(f"q{round(100 * p):02d}") for p in quantiles], "max_value", at(0.25).alias("_a"), at(0.75).alias("_b"))
    return told.withColumn("is_wide", F.col("max_value") - F.col("min_value") > wide * (F.col("_b") - F.col("_a"))).drop("_a", "_b")
