"""Mixing sources to target weights by systematic sampling.

A source's target is its weight's share of all words, at most ``most`` times its own words; what
exceeds that is shared out again by weight until no target is above its limit. Every document of
a source is expected ``target / source words`` times. Documents are put in order of size (then
id), the expected copies are summed along that order, one random offset is added for each source,
and a document is emitted once for each integer boundary that its step of the sum crosses. With
sizes in order, neighbours are of like size, so the words taken stay within a few documents'
sizes of the target although only whole documents are taken. A source with one very long document
would still miss by that document's size, so the drawn offset is moved by the multiple of
1 / OFFSETS whose taken words come nearest to the target (the first of equals). The words taken at
every one of these offsets come from one aggregate: a document is taken once more from the offset at
which the end of its step passes an integer, and once less from where the start of its step does, so
differences are summed by offset and then added up (at most ``OFFSETS`` rows for each source).

The order inside a source is made with a range partitioning over (source, size, id), so a source
with a third of all rows is spread over many tasks: each range numbers its own rows, and one row
for each range and source gives the numbers to add. Sizes are counted once and written before the
ranges are drawn. Offsets come from a hash of the source, so reruns agree.

Defined results: null or empty texts have size 0; they are dealt like others of their source and
take no words. A null source is a source of its own, last in order. A source without words has
target 0 and takes no copies. Null ids and repeated rows are rows of their own, in a fixed order.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linfold.llm.texts import WORD, free_name, row_key, settled

MOST = 3.0
#: Steps between 0 and 1 that an offset can have (all are odd multiples of half a step).
STEPS = 1 << 20
#: Places of the offset that are compared, evenly spread from the drawn one.
OFFSETS = 4096


def size_of(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def _key(source: str) -> Column:
    """Joins treat a null source as a value."""
    return F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("n"))


def targets(sizes: DataFrame, most: float = MOST, weights: DataFrame | None = None, seed: int = 11) -> DataFrame:
    """(key, source_size, target, phase) for each source of ``sizes`` (source, size).

    ``weights`` (source, weight) replaces the default 1, 2, 3, repeating in order of code point, null last.
    One row for each source from here on, so its windows are small whatever the rows.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("key", _key("source"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    if weights is None:
        weighed = per.withColumn("weight", ((F.row_number().over(order) - 1) % 3 + 1).cast("double"))
    else:
        given = weights.select(_key("source").alias("key"), F.col("weight").cast("double").alias("weight"))
        weighed = per.join(given, "key", "left").fillna(0.0, ["weight"])
    # Sources in order of limit / weight reach their limit in that order. A source is at its limit if the share
    # that is left when all before it are at theirs exceeds it.
    ratio = F.when(F.col("weight") > 0, F.col("source_size") * F.lit(most) / F.col("weight")).otherwise(F.lit(0.0))
    by_ratio = Window.orderBy("ratio", "key")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("ratio", "key").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    limit = F.when(F.col("weight") > 0, F.col("source_size") * F.lit(most)).otherwise(F.lit(0.0))
    w = weighed.withColumn("ratio", ratio).withColumn("limit", limit)
    w = w.withColumn("left", F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) \
        .withColumn("weights_left", F.sum("weight").over(everything)
                    - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    level = F.try_divide(F.col("left"), F.col("weights_left"))
    full = F.coalesce(F.col("ratio") <= level, F.lit(True))
    w = w.withColumn("full", full).withColumn("open_level", F.when(~full, level))
    first_open = F.first("open_level", ignorenulls=True).over(everything)
    target = F.when(F.col("full"), F.col("limit")).otherwise(F.col("weight") * first_open)
    digits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.col("key"))), 1, 5), 16, 10).cast("double")
    return w.select("key", "source_size", target.alias("target"), ((digits + 0.5) / STEPS).alias("phase"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        most: float = MOST, weights: DataFrame | None = None, seed: int = 11) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies) of every row, with its row key (_k1, _k2).

    Copies are whole and at most ``ceil(most)``.
    """
    sized = settled(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"),
                                size_of(text).alias("size"), *row_key(doc_id, text)), "sizes")
    columns = [F.col("source").isNull(), F.col("source"), F.col("size"), F.col("doc_id"), F.col("_k1")]
    ranged = sized.repartitionByRange(*columns).sortWithinPartitions(*columns)
    place = F.monotonically_increasing_id()
    # Written once: ranges are drawn from a sample, and both uses below must see the same ones.
    rows = settled(ranged.withColumn("part", F.shiftright(place, 33)).withColumn("place", place), "ranged")
    per = rows.groupBy("source", "part").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per.withColumn("shift", F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")) \
        .select(_key("source").alias("key"), "part", "shift")
    goal = settled(targets(rows.select("source", "size"), most, weights, seed), "targets")  # a row for each source
    ranked = rows.withColumn("key", _key("source")).join(starts.join(goal, "key"), ["key", "part"])
    rank = (F.col("place") + F.col("shift")).cast("double")  # 0-based, within the source
    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size").cast("double")), F.lit(0.0))

    # At offset (b + phase) / OFFSETS a document is taken ``whole`` times, once more from its bin ``more`` on, and
    # once less from its bin ``less`` on: the first offsets at which the end and the start of its step pass an integer.
    def bin_of(place: Column) -> Column:
        return F.ceil((1 - (place - F.floor(place))) * OFFSETS - F.col("phase"))

    start, end = F.col("rank") * F.col("rate"), (F.col("rank") + 1) * F.col("rate")
    ranked = ranked.withColumns({"rank": rank, "rate": rate}).withColumns({
        "whole": (F.floor(end) - F.floor(start)).cast("long"), "more": bin_of(end), "less": bin_of(start)})
    steps = F.array(F.struct(F.lit(0).cast("long").alias("b"), (F.col("whole") * F.col("size")).alias("d")),
                    F.struct(F.col("more").alias("b"), F.col("size").alias("d")),
                    F.struct(F.col("less").alias("b"), (-F.col("size")).alias("d")))
    bins = ranked.select("key", "target", F.inline(steps)).where(F.col("b") < OFFSETS) \
        .groupBy("key", "target", "b").agg(F.sum("d").alias("d"))
    along = Window.partitionBy("key").orderBy("b")
    miss = F.abs(F.sum("d").over(along) - F.col("target"))
    chosen = settled(bins.select("key", "b", miss.alias("miss")).groupBy("key").agg(
        F.min(F.struct("miss", "b"))["b"].alias("chosen")), "offsets")
    copies = F.col("whole") + (F.col("chosen") >= F.col("more")).cast("long") - (F.col("chosen") >= F.col("less")).cast("long")
    return ranked.join(chosen, "key").withColumn("copies", copies).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies",
        "_k1", "_k2")


def _copies(df: DataFrame, times: Column, name: str, columns: list[str]) -> DataFrame:
    return df.withColumn(name, F.explode(F.sequence(F.lit(0).cast("long"), times - 1))).select(*columns, name)


def emitted(docs: DataFrame, mixed: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` once for each copy, with the copy's number (from 0) in ``copy`` (or a free name like it).

    Rows that repeat (same id and text) differ at most in other columns; if there are any, they are numbered, task by
    task, so that each gets the copies of one row of ``mixed``. No window holds more rows than a task has read.
    """
    name = free_name(docs, "copy")
    k1, k2, n, part, times, till, rows = (free_name(docs, c) for c in (
        "_k1", "_k2", "_n", "_part", "_times", "_till", "_rows"))
    keys = row_key(doc_id, text)
    keyed = docs.withColumns({k1: keys[0], k2: keys[1]})
    # For each key the rows that get 3, 2, 1, 0 copies: a few runs of numbers, however often a row repeats.
    runs = mixed.groupBy(F.col("_k1").alias(k1), F.col("_k2").alias(k2), F.col("copies").alias(times)).agg(
        F.count("*").alias(rows))
    same = Window.partitionBy(k1, k2)
    runs = settled(runs.withColumns({till: F.sum(rows).over(same.orderBy(F.desc(times))), n: F.sum(rows).over(same)}), "runs")
    single = _copies(keyed.join(runs.where((F.col(n) == 1) & (F.col(times) > 0)).select(k1, k2, times), [k1, k2]),
                     F.col(times), name, docs.columns)
    many = runs.where(F.col(n) > 1)
    if many.isEmpty():
        return single
    repeated = settled(keyed.join(many.select(k1, k2).distinct(), [k1, k2]).withColumn(part, F.spark_partition_id()), "repeated")
    before = repeated.groupBy(k1, k2, part).agg(F.count("*").alias(rows)).withColumn(
        till, F.sum(rows).over(same.orderBy(part)) - F.col(rows)).select(k1, k2, part, till)
    numbered = repeated.withColumn(n, F.row_number().over(Window.partitionBy(k1, k2, part).orderBy(F.lit(1)))) \
        .join(before, [k1, k2, part]).withColumn(n, F.col(n) + F.col(till)).drop(till)
    run = many.where(F.col(times) > 0).select(k1, k2, times, (F.col(till) - F.col(rows)).alias(rows), till)
    given = numbered.join(run, [k1, k2]).where((F.col(n) > F.col(rows)) & (F.col(n) <= F.col(till)))
    return single.unionByName(_copies(given, F.col(times), name, docs.columns))
