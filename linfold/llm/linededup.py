"""Line dedup: lines that many documents share stay in one of them.

A line's *key* is the line without white space at its ends, A-Z lower-cased. Two Bloom filters find the keys
that can be shared, so that only those are shuffled with their text:

1. Every task reduces its lines to 64-bit hashes, those seen in one of its documents and those seen in more.
   The hash space is cut into slices of bounded size; a slice's hashes meet in one task, which puts each into
   the *once* filter, or, if the filter may hold it already, into the *twice* list. No line crosses this
   shuffle, and a key that a task has seen a million times crosses it as one hash.
2. The twice list becomes the *twice* filter, of at most ``TWICE_BITS`` bits, which is broadcast. Only lines
   that it may hold (the suspected repeats) are shuffled, by their whole text: counting documents and choosing
   the one that keeps the line are one map-side combined aggregate, so a line in a third of all documents is
   one row a task.
3. Documents that lose a line go through a join with the numbers of the lost lines; a third filter, over their
   keys, lets all others pass without a shuffle.

Filters err on one side: a line held by one document may be suspected and is then acquitted by the count. So
results are exact; the size of the filters decides only how much is shuffled.

Handling: a null or empty text is one empty line. Keys shorter than ``MIN_CHARS`` code points always stay. A
document is a row. Of the rows with the largest id that hold a key, all keep it (equal rows and several rows of
one id are alike); rows without an id rank below all others, and among those alone the largest hash of the text
keeps it. Long texts are one piece each (``texts.pieces``). Other columns are not read, so their names cannot
clash. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linfold.llm.filters import Filter, filter_of, places
from linfold.llm.texts import _IS_SPACE, _TABLES, batch_of, keyed, pieces, settled, spans_hash

MIN_CHARS = 20
MIN_DOCS = 3
#: Hashes in a slice of the once filter, and its bits.
SLICE_KEYS, SLICE_BITS = 1 << 16, 1 << 20
#: Most bits of a filter that is broadcast: 16 MiB.
TWICE_BITS = 1 << 27
#: Hashes that a task gathers before it hands them on.
GATHER = 1 << 18

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


class Lines:
    """Lines of a piece: their spans, the row of each, the spans of their keys, and which keys are long enough."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, min_chars: int):
        breaks = np.flatnonzero(raw == 10)
        upto = np.searchsorted(breaks, offsets)
        self.counts = np.diff(upto) + 1
        self.first = np.concatenate(([0], np.cumsum(self.counts)))
        n = int(self.first[-1])
        self.row = np.repeat(np.arange(len(self.counts)), self.counts)
        self.starts, self.ends = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
        inner = np.ones(n, dtype=bool)
        inner[self.first[:-1]] = False
        self.starts[self.first[:-1]], self.starts[inner] = offsets[:-1], breaks + 1
        inner[:] = True
        inner[self.first[1:] - 1] = False
        self.ends[self.first[1:] - 1], self.ends[inner] = offsets[1:], breaks
        solid = np.flatnonzero(~_IS_SPACE[raw])
        a, b = np.searchsorted(solid, self.starts), np.searchsorted(solid, self.ends)
        some = np.flatnonzero(b > a)
        key_starts, key_ends = solid[a[some]], solid[b[some] - 1] + 1
        points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
        enough = points[key_ends] - points[key_starts] >= min_chars
        self.lines, self.key_starts, self.key_ends = some[enough], key_starts[enough], key_ends[enough]
        self.hashes = spans_hash(_TABLES[0, True][raw], self.key_starts, self.key_ends)


def _apart(h: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes that come once, hashes that come again): ``more`` are known to come again."""
    values, n = np.unique(h, return_counts=True)
    again = np.unique(np.concatenate((values[n > 1], more)))
    return np.setdiff1d(values, again, assume_unique=True), again


_SEEN = pa.schema([("once", pa.list_(pa.int64())), ("again", pa.list_(pa.int64()))])


def _seen(min_chars: int):
    """Hashes of lines as each task sees them: in one of its documents, or in more."""
    def row(once, again):
        return batch_of(_SEEN, pa.array([once.view(np.int64)], _SEEN[0].type), pa.array([again.view(np.int64)], _SEEN[1].type))

    def run(batches):
        none = np.zeros(0, dtype=np.uint64)
        once, again, size = [], [none], 0
        for _, raw, offsets in pieces(batches):
            lines = Lines(raw, offsets, min_chars)
            owner = lines.row[lines.lines]
            order = np.lexsort((owner, lines.hashes))
            h, owner = lines.hashes[order], owner[order]
            new = np.ones(len(h), dtype=bool)
            new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])  # a document counts once
            once.append(h[new])
            size += int(new.sum())
            if size >= GATHER:
                yield row(*_apart(np.concatenate(once), np.concatenate(again)))
                once, again, size = [], [none], 0
        if size:
            yield row(*_apart(np.concatenate(once), np.concatenate(again)))
    return run


_SLICED = pa.schema([("slice", pa.int64()), ("hashes", pa.list_(pa.int64())), ("again", pa.list_(pa.bool_()))])


def _sliced(bits: int):
    """Each task's hashes cut by their leading ``bits``."""
    def run(batches):
        for batch in batches:
            for once, again in zip(batch.column(0), batch.column(1)):
                one, two = (x.values.to_numpy(zero_copy_only=False).view(np.uint64) for x in (once, again))
                h = np.concatenate((one, two))
                more = np.zeros(len(h), dtype=bool)
                more[len(one):] = True
                order = np.argsort(h)
                h, more = h[order], more[order]
                top = (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), dtype=np.int64)
                cut = np.flatnonzero(np.concatenate(([True], top[1:] != top[:-1]))) if len(h) else np.zeros(0, dtype=np.int64)
                ends = pa.array(np.concatenate((cut, [len(h)])).astype(np.int32))
                yield batch_of(_SLICED, top[cut], pa.ListArray.from_arrays(ends, pa.array(h.view(np.int64))),
                               pa.ListArray.from_arrays(ends, pa.array(more)))
    return run


_HASH = pa.schema([("h", pa.int64())])


def _twice(batches):
    """Slices in order (their tasks' rows side by side): hashes that the once filter may hold already."""
    current, once, found = None, None, []

    def emit():
        return batch_of(_HASH, np.unique(np.concatenate(found)).view(np.int64))

    for batch in batches:
        for key, hashes, again in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            if key != current:
                if found:
                    yield emit()
                current, once, found = key, np.zeros(SLICE_BITS, dtype=bool), []
            h = hashes.values.to_numpy(zero_copy_only=False).view(np.uint64)
            one, two = places(h, SLICE_BITS)
            hit = (once[one] & once[two]) | again.values.to_numpy(zero_copy_only=False)
            once[one] = once[two] = True
            if hit.any():
                found.append(h[hit])
                if len(found) > 64:
                    found = [np.unique(np.concatenate(found))]
    if found:
        yield emit()


def twice_seen(texts: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(h): hashes of the keys that two documents or more may hold; ``texts`` is ``keyed`` rows."""
    seen = settled(texts.select("_text").mapInArrow(_seen(min_chars), "once array<long>, again array<long>"), "seen")
    n = seen.agg(F.coalesce(F.sum(F.size("once") + F.size("again")), F.lit(0))).first()[0]
    bits = max(0, int(-(-n // SLICE_KEYS) - 1).bit_length())
    cut = seen.mapInArrow(_sliced(bits), "slice long, hashes array<long>, again array<boolean>")
    tasks = max(1, min(1 << bits, 2048))
    return settled(cut.repartition(tasks, "slice").sortWithinPartitions("slice").mapInArrow(_twice, "h long"), "twice")


_SUSPECT = pa.schema([("line", pa.binary()), ("_id", pa.int64()), ("_k1", pa.int64()), ("_k2", pa.int64()),
                      ("places", pa.list_(pa.int32()))])


def _suspects(min_chars: int, known):
    """A row for each document and key that the filter may hold, with the numbers of its lines."""
    def run(batches):
        for part, raw, offsets in pieces(batches):
            lines = Lines(raw, offsets, min_chars)
            at = np.flatnonzero(known.value.may_hold(lines.hashes))
            if not len(at):
                continue
            data = raw.tobytes()
            number = lines.lines[at]
            owner = lines.row[number]
            number = number - lines.first[owner]
            rows: dict = {}
            for r, k, s, e in zip(owner.tolist(), number.tolist(), lines.key_starts[at].tolist(), lines.key_ends[at].tolist()):
                rows.setdefault((r, data[s:e].translate(_LOWER)), []).append(k)
            owners = pa.array([r for r, _ in rows], pa.int64())
            told = [part.column(part.schema.get_field_index(c)).take(owners) for c in ("_id", "_k1", "_k2")]
            yield batch_of(_SUSPECT, [x for _, x in rows], *told, list(rows.values()))
    return run


def lost_lines(texts: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
               twice_bits: int = TWICE_BITS) -> DataFrame:
    """(_k1, _k2, places): numbers of the lines that a text loses; ``texts`` is ``keyed`` rows with a long ``_id``."""
    spark = texts.sparkSession
    twice = twice_seen(texts, min_chars)
    known = spark.sparkContext.broadcast(filter_of(twice, "h", twice.count(), twice_bits))
    some = settled(texts.mapInArrow(_suspects(min_chars, known),
                                    "line binary, _id long, _k1 long, _k2 long, places array<int>"), "suspects")
    # Written before it is joined: a join of two plain scans is one whose hot keys Spark can split.
    shared = settled(some.groupBy("line").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("_id", "_k1", "_k2")).alias("keep"))
                     .where(F.col("n") >= min_docs).select("line", "keep"), "shared")
    keeps = F.expr("_id <=> keep._id AND (_id IS NOT NULL OR (_k1 = keep._k1 AND _k2 = keep._k2))")
    lost = some.join(shared, "line").where(~keeps).select("_k1", "_k2", "places")
    # Equal rows have one key and lose the same lines.
    return settled(lost.groupBy("_k1", "_k2").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("places"))))
                                                  .alias("places")), "lost")


def _parted(known, want: bool):
    """Rows whose key the filter may hold (or not)."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                h = batch.column(batch.schema.get_field_index("_k1")).to_numpy(zero_copy_only=False)
                yield batch.filter(pa.array(known.value.may_hold(np.ascontiguousarray(h)) == want))
    return run


_LEFT = pa.schema([("_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("_text", pa.string())])


def _left(batches):
    for batch in batches:
        text, gone = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("_text", "places"))
        rows = []
        for t, p in zip(text, gone):
            lines, drop = (t or "").split("\n"), set(p or ())
            rows.append((len(lines), len(drop), "\n".join([x for i, x in enumerate(lines) if i not in drop])))
        yield batch_of(_LEFT, batch.column(batch.schema.get_field_index("_id")), *[[x[i] for x in rows] for i in range(3)])


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
                min_docs: int = MIN_DOCS, twice_bits: int = TWICE_BITS) -> DataFrame:
    """(doc_id, n_lines, n_dropped, text) of every row: lines before dropping, lines dropped, and the text left.

    A null text is left as an empty one.
    """
    texts = keyed(docs, doc_id, text).withColumn("_id", F.col("_id").cast("long"))
    lost = lost_lines(texts, min_chars, min_docs, twice_bits)
    known: Filter = filter_of(lost, "_k1", lost.count(), twice_bits)
    shared = texts.sparkSession.sparkContext.broadcast(known)
    ddl = "_k1 long, _k2 long, _id long, _text string"
    whole = F.coalesce("_text", F.lit(""))
    same = texts.mapInArrow(_parted(shared, False), ddl).select(
        "_id", (F.length(whole) - F.length(F.replace(whole, F.lit("\n"))) + 1).cast("long").alias("n_lines"),
        F.lit(0).cast("long").alias("n_dropped"), whole.alias("_text"))
    touched = settled(texts.mapInArrow(_parted(shared, True), ddl), "touched")
    changed = touched.join(lost, ["_k1", "_k2"], "left").select("_id", "_text", "places").mapInArrow(
        _left, "_id long, n_lines long, n_dropped long, _text string")
    return same.unionByName(changed).select(F.col("_id").alias("doc_id"), "n_lines", "n_dropped", F.col("_text").alias("text"))


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of every row."""
    return dedup_lines(docs, doc_id, text).select("doc_id", "n_lines", "n_dropped",
                                                  F.sha2(F.col("text"), 256).alias("kept_sha256"))
