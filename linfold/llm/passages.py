"""Which windows of texts are repeated: the part that word and byte passages share.

A *window* is a run of ``window`` units (words or bytes) of one text. It chooses its *piece*: of the
``length``-unit runs in it, the one with the least hash, the leftmost of equals. The choice depends
on the window's content alone, so equal windows choose equal pieces at the same distance. Neighbouring
windows mostly choose the same piece: such a run of windows is a *segment*, known by its content and
the piece's distance. So a table of places, one row for each segment (about two in ``window - length``
units), says for all windows at once:

* the piece occurs once: none of the segment's windows is repeated (``candidates`` leaves them out);
* the segment's content occurs twice or more: all of them are;
* other segments have the same piece: some may be.

Words (``decide``) take copies as decided by 128 bits and send one representative of each other
content to a finer test; bytes send two representatives of each copied content to their sort as well.

Counts are combined before they are shuffled. Joins that carry verdicts back have a hot key on one
side only, with one row on the other, so Spark can split them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linfold.llm.texts import batch_of, discard, leftmost_minima, settled, signed, spans_hash, windows_hash

#: piece hash, segment hash (together 128 bits for a segment), text, first and last window, asked or only a witness.
PLACES = pa.schema([("p", pa.int64()), ("s", pa.int64()), ("_k1", pa.int64()), ("_k2", pa.int64()),
                    ("first", pa.int32()), ("last", pa.int32()), ("ask", pa.bool_())])
PLACES_DDL = "p long, s long, _k1 long, _k2 long, first int, last int, ask boolean"


def places_of(part: pa.RecordBatch, one: np.ndarray, two: np.ndarray, begins: np.ndarray, row: np.ndarray,
              at: np.ndarray, ask: np.ndarray | None, length: int, window: int) -> pa.RecordBatch | None:
    """Rows of ``PLACES`` for the windows that start at ``at`` (places in the piece of the table).

    ``one`` and ``two`` are the units' values under two hash families, ``begins`` the first unit of each
    row, ``row`` the row of each window in ``at``, ``ask`` whether each is asked about (None: all).
    """
    if not len(at):
        return None
    pieces = windows_hash(one, length)
    choice = leftmost_minima(pieces, window - length + 1)[at]
    new = (choice[1:] != choice[:-1]) | (at[1:] != at[:-1] + 1)
    if ask is not None:
        new |= ask[1:] != ask[:-1]
    new = np.flatnonzero(np.concatenate(([True], new)))
    stop = np.concatenate((new[1:], [len(at)])) - 1
    first, last, place, owner = at[new], at[stop], choice[new], row[new]
    inside = spans_hash(two, first, last + window, 1)
    with np.errstate(over="ignore"):
        content = inside + (place - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    owners = pa.array(owner)
    return batch_of(PLACES, signed(pieces[place]), signed(content),
                    part.column(part.schema.get_field_index("_k1")).take(owners),
                    part.column(part.schema.get_field_index("_k2")).take(owners),
                    (first - begins[owner]).astype(np.int32), (last - begins[owner]).astype(np.int32),
                    np.ones(len(new), dtype=bool) if ask is None else ask[new])


def candidates(places: DataFrame) -> DataFrame:
    """The segments whose piece occurs twice or more; no window of the others is repeated."""
    places = settled(places, "places")
    # Written before it is joined: a join of two plain scans is one whose hot keys Spark can split.
    twice = settled(places.groupBy("p").agg(F.count("*").alias("m")).where("m > 1").select("p"), "twice")
    some = settled(places.join(twice, "p"), "candidates")
    discard(places, twice)
    return some


def decide(places: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(repeated, open): runs of windows known to be repeated, and representatives that a finer test must tell apart.

    Both are (_k1, _k2, first, last); ``open`` also says which are asked about, and the piece ``p`` with its
    number of distinct segments, ``kinds``.
    """
    some = candidates(places)
    contents = settled(some.groupBy("p", "s").agg(
        F.count("*").alias("n"), F.min(F.struct("_k1", "_k2", "first", "last")).alias("rep"),
        F.bool_or("ask").alias("asked")), "contents")
    copied = contents.where("n > 1").select("p", "s")
    repeated = settled(some.where("ask").join(copied, ["p", "s"]).select("_k1", "_k2", "first", "last"), "repeated")
    discard(some)
    mixed = settled(contents.groupBy("p").agg(F.count("*").alias("kinds"), F.bool_or(F.expr("n = 1 AND asked")).alias("alone"))
                    .where("kinds > 1 AND alone").select("p", "kinds"), "mixed")
    unsure = contents.join(mixed, "p").select("rep.*", F.expr("n = 1 AND asked").alias("ask"), "p", "kinds")
    return repeated, unsure


def runs_of(spans: DataFrame) -> DataFrame:
    """(_k1, _k2, firsts, lasts): the runs of each text in one row; equal rows have equal runs, kept once."""
    return spans.groupBy("_k1", "_k2").agg(F.sort_array(F.collect_set(F.struct("first", "last"))).alias("r")).select(
        "_k1", "_k2", F.col("r")["first"].alias("firsts"), F.col("r")["last"].alias("lasts"))


def lists(part: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and values of a list column (a null list is empty)."""
    column = part.column(part.schema.get_field_index(name))
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return lengths, column.flatten().to_numpy(zero_copy_only=False)


def marked(starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """True from each start up to its end (exclusive)."""
    step = np.zeros(size + 1, dtype=np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, ends, -1)
    return np.cumsum(step[:-1]) > 0


def covered(part: pa.RecordBatch, begins: np.ndarray, size: int, window: int) -> np.ndarray:
    """Which units of the piece are in a window of the runs in ``firsts`` and ``lasts``."""
    n, first = lists(part, "firsts")
    _, last = lists(part, "lasts")
    begin = np.repeat(begins, n)
    return marked(first + begin, last + begin + window, size)
