"""Repeated passages of bytes by a distributed suffix sort.

A window is ``WINDOW`` consecutive bytes of one text (UTF-8); it is repeated if the same bytes also
start anywhere else, in the same text or another, overlaps included. In a sorted list of all
suffixes, a window is repeated exactly if its suffix agrees with a neighbour in ``WINDOW`` bytes.

1. *Which suffixes need sorting.* Every window's leading token is the ``TOKEN``-byte piece that its
   content chooses (see ``passages``): equal windows have equal tokens. Windows whose token occurs
   once need no sorting. Of the other segments, copies collapse by 128 bits of hashes: the first and
   the last place of each content go on (the only one, where there is one), each as one row that
   holds all its suffixes. So a group of thousands of copies sorts two, and no window counts as
   repeated before the sort has found it equal to another, byte by byte.
2. *Range partitioning.* Rows are dealt by ``repartitionByRange`` (splitters from a sample) on the
   leading token. A token that more than ``HOT`` segments share does not fit one bucket: its
   suffixes become rows of their own, ordered by their bytes and then by place, so splitters fall
   inside the token, and inside runs of equal suffixes too.
3. *Local sort.* Each bucket sorts its suffixes by multikey quicksort, breadth first: all groups
   that still tie are split by their next eight bytes at once; groups of one leave. What still ties
   after ``WINDOW`` bytes is repeated.
4. *Across boundaries.* Each bucket tells its first and last single suffix; one that two buckets tell
   is repeated (two small rows for each bucket, grouped by the suffix).
5. *Back to the places.* What the sort found for a content holds for all its places.

Matches never cross texts. Windows are judged on the input, not on what is left. Defined results:
null texts are empty, nothing is removed from texts shorter than a window; rows that repeat (same id
and text) count as two texts; null ids are rows like others; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linfold.llm.passages import PLACES_DDL, candidates, covered, lists, places_of, runs_of
from linfold.llm.texts import batch_of, byte_values, discard, keyed, pieces, settled

WINDOW = 200
TOKEN = 64
#: Rows of one token that a bucket may have to hold together.
HOT = 4096
#: Bytes of segments in a bucket, about; the number of buckets follows the data.
BUCKET_BYTES = 1 << 22


def _window_starts(offsets: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and row of every window inside a row."""
    n = np.maximum(np.diff(offsets) - window + 1, 0)
    row = np.repeat(np.arange(len(n)), n)
    return np.arange(len(row)) + np.repeat(offsets[:-1] - np.concatenate(([0], np.cumsum(n)[:-1])), n), row


def _places(window: int, token: int):
    def run(batches):
        for part, raw, offsets in pieces(batches):
            at, row = _window_starts(offsets, window)
            rows = places_of(part, byte_values(raw), byte_values(raw, 1), offsets[:-1], row, at, None, token, window)
            if rows is not None:
                yield rows
    return run


_SUFFIXES = pa.schema([("p", pa.int64()), ("lead", pa.binary()), ("t1", pa.int64()), ("t2", pa.int64()),
                       ("t3", pa.int32()), ("s", pa.int64()), ("start", pa.int32()), ("body", pa.binary())])
_SUFFIXES_DDL = "p long, lead binary, t1 long, t2 long, t3 int, s long, start int, body binary"


def _rows(window: int):
    """A row for each segment (its bytes), or for each suffix of a hot token (``lead`` is its window).

    ``start`` is the first window of the row, counted from the segment's first; ``t1`` to ``t3`` are the place.
    """
    def run(batches):
        for part, raw, offsets in pieces(batches):
            data = raw.tobytes()
            n, first = lists(part, "firsts")
            _, last = lists(part, "lasts")
            _, token = lists(part, "tokens")
            _, content = lists(part, "contents")
            _, hot = lists(part, "hots")
            k1 = part.column(part.schema.get_field_index("_k1")).to_pylist()
            k2 = part.column(part.schema.get_field_index("_k2")).to_pylist()
            row = np.repeat(np.arange(len(n)), n)
            out: list[tuple] = []
            for r, f, z, p, s, h in zip(row.tolist(), first.tolist(), last.tolist(), token.tolist(), content.tolist(),
                                        hot.tolist(), strict=True):
                begin = int(offsets[r])
                if h:
                    out += [(p, data[begin + i:begin + i + window], k1[r], k2[r], i, s, i - f, None)
                            for i in range(f, z + 1)]
                else:
                    out.append((p, b"", 0, 0, 0, s, 0, data[begin + f:begin + z + window]))
                if len(out) >= 8192:
                    yield batch_of(_SUFFIXES, *zip(*out))
                    out = []
            if out:
                yield batch_of(_SUFFIXES, *zip(*out))
    return run


def tied(text: np.ndarray, starts: np.ndarray, groups: np.ndarray, window: int) -> np.ndarray:
    """Group number of each suffix after sorting by ``groups`` and ``window`` bytes; -1 for those that tie with none.

    Multikey quicksort, one level of eight bytes at a time over all open groups; a group whose next bytes are
    all equal goes on as it is.
    """
    n = len(text)
    word = np.zeros(n + 8, dtype=np.uint64)
    padded = np.concatenate((text, np.zeros(16, dtype=np.uint8)))
    for j in range(8):
        word |= padded[j:j + n + 8].astype(np.uint64) << np.uint64(56 - 8 * j)
    out = np.full(len(starts), -1, dtype=np.int64)
    live = np.arange(len(starts))
    group = groups.astype(np.int64)
    for depth in range(0, window + 7, 8):
        if not len(live):
            break
        if depth < window:
            key = word[starts[live] + depth]
            if window - depth < 8:
                key = key >> np.uint64(8 * (8 - (window - depth)))
            if depth:
                differ = (group[1:] == group[:-1]) & (key[1:] != key[:-1])
                split = np.zeros(group[-1] + 1, dtype=bool)
                split[group[1:][differ]] = True
                at = np.flatnonzero(split[group])
                order = np.arange(len(group))
                order[at] = at[np.lexsort((key[at], group[at]))]
            else:
                order = np.lexsort((key, group))
            live, group, key = live[order], group[order], key[order]
            new = np.concatenate(([True], (group[1:] != group[:-1]) | (key[1:] != key[:-1])))
            number = np.cumsum(new) - 1
            alone = np.bincount(number) == 1
            stay = ~alone[number]
            live, group = live[stay], number[stay]
    out[live] = group
    return out


_FOUND = pa.schema([("p", pa.int64()), ("s", pa.int64()), ("first", pa.int32()), ("last", pa.int32()),
                    ("bucket", pa.int32()), ("lead", pa.binary())])
_FOUND_DDL = "p long, s long, first int, last int, bucket int, lead binary"


def _sorted(window: int):
    """Sorts the suffixes of a bucket; gives runs of repeated windows of each segment, and the bucket's edges (``lead``)."""
    def run(batches):
        names = ("p", "lead", "s", "start", "body")
        got = [[] for _ in names]
        for batch in batches:
            for i, name in enumerate(names):
                got[i] += batch.column(batch.schema.get_field_index(name)).to_pylist()
        p, lead, s, base, body = got
        if not p:
            return
        texts = [b if b is not None else x for b, x in zip(body, lead, strict=True)]
        lengths = np.array([len(x) for x in texts])
        begin = np.concatenate(([0], np.cumsum(lengths)))
        text = np.frombuffer(b"".join(texts), dtype=np.uint8)
        del texts, body
        count = lengths - window + 1
        row = np.repeat(np.arange(len(p)), count)
        inner = np.arange(len(row)) - np.repeat(np.concatenate(([0], np.cumsum(count)[:-1])), count)
        tokens, contents = np.array(p, dtype=np.int64), np.array(s, dtype=np.int64)
        _, token = np.unique(tokens, return_inverse=True)
        hit = np.flatnonzero(tied(text, begin[row] + inner, token[row], window) >= 0)
        bucket = TaskContext.get().partitionId()
        if len(hit):
            new = np.concatenate(([True], (row[hit][1:] != row[hit][:-1]) | (inner[hit][1:] != inner[hit][:-1] + 1)))
            a = np.flatnonzero(new)
            z = np.concatenate((a[1:], [len(hit)])) - 1
            at = row[hit[a]]
            start = np.array(base)[at]
            yield batch_of(_FOUND, tokens[at], contents[at], (start + inner[hit[a]]).astype(np.int32),
                           (start + inner[hit[z]]).astype(np.int32), np.full(len(a), bucket, dtype=np.int32),
                           [None] * len(a))
        # Only rows of hot tokens may have an equal suffix in another bucket: the least and the greatest row.
        whole = [i for i, x in enumerate(lead) if x]
        if whole:
            order = lambda i: (p[i], lead[i])
            ends = (min(whole, key=order), max(whole, key=order))
            yield batch_of(_FOUND, [p[i] for i in ends], [s[i] for i in ends], [base[i] for i in ends],
                           [base[i] for i in ends], [bucket, bucket], [lead[i] for i in ends])
    return run


def repeated_runs(texts: DataFrame, window: int = WINDOW, token: int = TOKEN, hot: int = HOT,
                  bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(_k1, _k2, firsts, lasts): runs of repeated windows of each text that has some; ``texts`` is ``keyed`` rows."""
    base = texts.select("_k1", "_k2", "_text")
    some = candidates(base.mapInArrow(_places(window, token), PLACES_DDL))
    place = F.struct("_k1", "_k2", "first", "last")
    contents = settled(some.groupBy("p", "s").agg(
        F.least(F.count("*"), F.lit(2)).alias("n"), F.min(place).alias("one"), F.max(place).alias("two")), "contents")
    crowded = settled(contents.groupBy("p").agg(F.sum("n").alias("m")).where(F.col("m") > hot)
                      .select("p", F.lit(True).alias("hot")), "crowded")
    sent = settled(contents.join(crowded, "p", "left").select(
        "p", "s", F.coalesce("hot", F.lit(False)).alias("hot"),
        F.explode(F.when(F.col("n") > 1, F.array("one", "two")).otherwise(F.array("one"))).alias("at"))
        .select("p", "s", "hot", "at.*"), "sent")
    discard(contents, crowded)
    windows = (F.col("last") - F.col("first") + 1).cast("long")
    size = sent.agg(F.sum(F.when(F.col("hot"), windows * window).otherwise(windows + window)).alias("n")).first()["n"] or 0
    left = sent.groupBy("_k1", "_k2").agg(F.sort_array(F.collect_list(F.struct(
        "first", "last", F.col("p").alias("token"), F.col("s").alias("content"), "hot"))).alias("r")).select(
        "_k1", "_k2", *[F.col("r")[c].alias(c + "s") for c in ("first", "last", "token", "content", "hot")])
    holders = base.join(left, ["_k1", "_k2"]).dropDuplicates(["_k1", "_k2"])  # equal rows have one key
    rows = holders.mapInArrow(_rows(window), _SUFFIXES_DDL)
    buckets = max(1, -(-size // bucket_bytes))
    dealt = rows.repartitionByRange(buckets, "p", "lead", "t1", "t2", "t3")
    found = settled(dealt.mapInArrow(_sorted(window), _FOUND_DDL), "sorted")
    edges = found.where("lead IS NOT NULL")
    shared = edges.groupBy("lead").agg(F.min("bucket").alias("a"), F.max("bucket").alias("z")).where("a < z").select("lead")
    runs = found.where("lead IS NULL").unionByName(edges.join(shared, "lead"))
    # A content's runs are equal or apart (both its places have the same bytes); those that touch become one.
    near = runs.groupBy("p", "s").agg(F.sort_array(F.collect_set(F.struct("first", "last"))).alias("r"))
    verdict = settled(near.select("p", "s", F.expr(
        "zip_with(filter(r, (x, i) -> coalesce(get(r, i - 1).last + 1 < x.first, true)), "
        "filter(r, (x, i) -> coalesce(get(r, i + 1).first > x.last + 1, true)), "
        "(x, y) -> named_struct('first', x.first, 'last', y.last))").alias("r")), "verdict")
    repeated = settled(some.join(verdict, ["p", "s"]).select(
        "_k1", "_k2", F.col("first").alias("begin"), F.explode("r").alias("r")).select(
        "_k1", "_k2", (F.col("begin") + F.col("r")["first"]).alias("first"),
        (F.col("begin") + F.col("r")["last"]).alias("last")), "repeated")
    discard(some, sent, found, verdict)
    return runs_of(repeated)


_DIGESTED = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                       ("n_spans", pa.int64()), ("kept_sha256", pa.string())])


def _digest(window: int):
    def run(batches):
        for part, raw, offsets in pieces(batches):
            gone = covered(part, offsets[:-1], len(raw), window)
            rows = []
            for a, z in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                mine = gone[a:z]
                spans = int(mine[:1].sum() + (mine[1:] & ~mine[:-1]).sum())
                rows.append((z - a, int(mine.sum()), spans, hashlib.sha256(raw[a:z][~mine].tobytes()).hexdigest()))
            yield batch_of(_DIGESTED, part.column(part.schema.get_field_index("_id")), *zip(*rows))
    return run


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    rows = keyed(docs, doc_id, text).withColumn("_id", F.col("_id").cast("long"))
    found = rows.join(repeated_runs(rows, window), ["_k1", "_k2"], "left")
    return found.select("_id", "_text", "firsts", "lasts").mapInArrow(
        _digest(window), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
