"""Repeated passages of words, found level by level with windows of doubling length.

A window is ``WINDOW`` consecutive words of one text; it is repeated if its words also start
anywhere else, in the same text or another. Whether it can be is first asked of a short piece of it,
``BASE`` words that the window's content chooses (see ``passages``). Windows whose piece occurs once
are done. What is repeated alone goes on: its piece is doubled in length, level by level, until the
last level's piece is the window itself. On each level, segments whose whole content occurs twice
are settled at once, and one representative of each other content is asked again; so copies of
documents and passages are decided on the first level, and later levels see only the edges at which
passages that share words part.

A level shuffles hashes and places, about two for 28 words on the first level. Texts are shuffled
twice: for the representatives that go on, and at the end, to cut the words out.

All windows are judged on the input, not on what is left. Defined results: null and empty texts
have no words: nothing is removed and the kept text is empty. Texts shorter than a window stay
whole. Rows that repeat (same id and text) count as two texts, so all their windows are repeated.
Null ids are rows like others. Other columns are not read (``cut`` carries them).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linfold.llm.passages import PLACES_DDL, covered, decide, lists, marked, places_of, runs_of
from linfold.llm.texts import Words, batch_of, free_name, keyed, pieces, row_key, settled

WINDOW = 35
BASE = 8

def levels(window: int = WINDOW, base: int = BASE) -> list[int]:
    """base, 2 base, 4 base ... below the window, then the window itself."""
    out, size = [], min(base, window)
    while size < window:
        out.append(size)
        size *= 2
    return [*out, window]


def _places(length: int, window: int, judged: bool):
    """Segments of the open windows (all windows on the first level), see ``passages``."""
    def run(batches):
        for part, raw, offsets in pieces(batches):
            words = Words(raw, offsets)
            at, ask = words.window_starts(window), None
            if judged:
                n, first = lists(part, "firsts")
                _, last = lists(part, "lasts")
                _, asked = lists(part, "asks")
                begin = np.repeat(words.first[:-1], n)
                first, last, asked = first + begin, last + begin, asked.astype(bool)
                wanted = marked(first[asked], last[asked] + 1, len(words))
                at = at[(wanted | marked(first, last + 1, len(words)))[at]]
                ask = wanted[at]
            rows = places_of(part, words.hashes(), words.hashes(which=1), words.first[:-1], words.row[at], at, ask,
                             length, window)
            if rows is not None:
                yield rows
    return run


def repeated_runs(texts: DataFrame, window: int = WINDOW, base: int = BASE) -> DataFrame:
    """(_k1, _k2, firsts, lasts): runs of repeated windows of each text that has some; ``texts`` is ``keyed`` rows."""
    current, judged, found = texts.select("_k1", "_k2", "_text"), False, None
    for length in levels(window, base):
        repeated, unsure = decide(current.mapInArrow(_places(length, window, judged), PLACES_DDL))
        found = repeated if found is None else found.unionByName(repeated)
        if length == window:
            return runs_of(found)
        left = unsure.groupBy("_k1", "_k2").agg(F.sort_array(F.collect_list(F.struct("first", "last", "ask"))).alias("r")) \
            .select("_k1", "_k2", F.col("r")["first"].alias("firsts"), F.col("r")["last"].alias("lasts"),
                    F.col("r")["ask"].alias("asks"))
        rows = current if not judged else current.drop("firsts", "lasts", "asks")
        # Equal rows have one key: the first stands for all.
        current = settled(rows.join(left, ["_k1", "_k2"]).dropDuplicates(["_k1", "_k2"]), "open")
        judged = True


def _cut_texts(part: pa.RecordBatch, raw: np.ndarray, offsets: np.ndarray, window: int):
    """For each row: words, removed words, and the bytes of the kept words joined by one space."""
    words = Words(raw, offsets)
    gone = covered(part, words.first[:-1], len(words), window)
    data = raw.tobytes()
    for r in range(len(offsets) - 1):
        a, b = words.first[r], words.first[r + 1]
        kept = np.flatnonzero(~gone[a:b]) + a
        yield int(b - a), int(b - a - len(kept)), b" ".join([data[s:e] for s, e in zip(
            words.starts[kept].tolist(), words.ends[kept].tolist())])


_DIGESTED = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                       ("kept_sha256", pa.string())])


def _digest(window: int):
    def run(batches):
        for part, raw, offsets in pieces(batches):
            rows = list(_cut_texts(part, raw, offsets, window))
            yield batch_of(_DIGESTED, part.column(part.schema.get_field_index("_id")), [x[0] for x in rows],
                           [x[1] for x in rows], [hashlib.sha256(x[2]).hexdigest() for x in rows])
    return run


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row."""
    rows = keyed(docs, doc_id, text).withColumn("_id", F.col("_id").cast("long"))
    found = rows.join(repeated_runs(rows, window), ["_k1", "_k2"], "left")
    return found.select("_id", "_text", "firsts", "lasts").mapInArrow(
        _digest(window), "doc_id long, n_words long, n_removed long, kept_sha256 string")


def cut(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with repeated passages cut out of the text, kept words joined by one space.

    Texts without a repeated passage stay byte for byte (null ones too). All columns are carried.
    """
    k1, k2, body, starts, ends = (free_name(docs, c) for c in ("_k1", "_k2", "_text", "_firsts", "_lasts"))
    keys = row_key(doc_id, text)
    runs = repeated_runs(keyed(docs, doc_id, text), window).select(
        F.col("_k1").alias(k1), F.col("_k2").alias(k2), F.col("firsts").alias(starts), F.col("lasts").alias(ends))
    rows = docs.withColumns({k1: keys[0], k2: keys[1], body: F.col(text).cast("string")}).join(runs, [k1, k2], "left")
    names, at = docs.columns, docs.columns.index(text)

    def run(batches):
        for part, raw, offsets in pieces(batches, body):
            told = part.select([body, starts, ends]).rename_columns(["_text", "firsts", "lasts"])
            n, _ = lists(told, "firsts")
            kept = [x[2].decode() for x in _cut_texts(told, raw, offsets, window)]
            old = part.column(part.schema.get_field_index(body))
            new = pa.array([k if c else o.as_py() for k, c, o in zip(kept, n.tolist(), old)], type=pa.string())
            yield part.select(names).set_column(at, text, new)
    return rows.mapInArrow(run, docs.schema)
