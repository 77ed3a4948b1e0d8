"""Near-duplicate documents by fast similarity sketches, banding and exact verification.

A document's set is its distinct ``SHINGLE``-word shingles (A-Z lower-cased; a shorter text is one
shingle; no word, no set). Documents are linked if their sets' Jaccard similarity is at least
``PERCENT`` / 100.

1. *Sketch.* In rounds, each shingle is hashed to a bin and a value; a bin keeps the least
   (round, value). The first ``COORDINATES`` rounds hash to random bins, the next ones fill one given
   bin each, so after at most twice as many rounds every coordinate is filled, whatever the set's
   size; a set stops when it is full (mostly after one or two rounds). Equal coordinates of two
   sketches estimate the similarity with strong concentration.
2. *Equal sets* collapse to one node, whatever ids their rows have; copies never make pairs.
3. *Banding.* ``ROWS`` coordinates make a band; sets that share a band meet in its bucket. A pair at
   the threshold shares none of the bands with a probability of about 2.4e-8.
4. *Exact verification* on the full sets, without listing a bucket's pairs:
   a) each set against one hub (the smallest node of a bucket it is in; the hub it shares most bands
   with); links give components; b) only buckets that still hold several components are looked at
   again: their members outside the largest component meet all members of other components, in
   tasks of at most ``BLOCK`` x ``BLOCK``, so a bucket of any size is many such tasks. A pair goes on
   if its sizes allow the threshold, its sketches agree in ``LEAST_EQUAL`` coordinates (a pair at the
   threshold has fewer with a probability of about 1e-7) and this is the first bucket that it
   shares; the task fetches the texts of such members and tests their pairs, best first, until the
   components are joined. Only links that join components leave the task. Links inside a component
   need no test, as they change nothing.

Texts are shuffled once, to fetch those of sets that share a bucket with another (by the key of a row that has the set);
the tests read them from there.

Defined results: null and empty texts have no set: n_shingles 0, a component of their own. Rows are
told apart by id and text (``row_key``): the texts of one id are judged each by itself, and rows without an
id like others. A component carries the smallest id in it (null if none of its rows has an id);
``kept`` is the row with that id (of its several texts in the component, the one with the least key) and
its repeats. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linfold.llm.components import components
from linfold.llm.texts import (
    Words, batch_of, free_name, keyed, mix, pieces, row_key, settled, signed, spans_hash, windows_hash)

SHINGLE = 5
PERCENT = 75
ROWS, BANDS = 3, 32
COORDINATES = ROWS * BANDS
LEAST_EQUAL = 50
BLOCK = 1024
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def shingles(raw: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text as (row, hash), in order of row and hash."""
    words = Words(raw, offsets)
    hashes = words.hashes(lower=True)
    at = words.window_starts(size)
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    row = np.concatenate((words.row[at], short))
    value = np.concatenate((windows_hash(hashes, size)[at] if len(at) else hashes[:0],
                            spans_hash(hashes, words.first[short], words.first[short + 1])))
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    if len(row):
        new = np.concatenate(([True], (row[1:] != row[:-1]) | (value[1:] != value[:-1])))
        row, value = row[new], value[new]
    return row, value


def sketches(row: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
    """rows x COORDINATES of (round << 32 | value); rows without a shingle stay all ones."""
    t = COORDINATES
    flat = np.full(rows * t, _FULL)
    row, value = row.astype(np.int64), value.copy()
    for step in range(2 * t):
        if not len(row):
            break
        hashed = mix(value + np.uint64((step + 1) * int(_GOLD) % (1 << 64)))
        low = (hashed & np.uint64(0xFFFFFFFF)) | np.uint64(step << 32)
        if step < t:
            place = row * t + (((hashed >> np.uint64(32)) * np.uint64(t)) >> np.uint64(32)).astype(np.int64)
        else:
            place = row * t + (step - t)
        np.minimum.at(flat, place, low)
        open_rows = (flat.reshape(rows, t) == _FULL).any(axis=1)
        still = open_rows[row]
        row, value = row[still], value[still]
    return flat.reshape(rows, t)


_SKETCHED = pa.schema([("_k1", pa.int64()), ("_k2", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("h1", pa.int64()),
                       ("h2", pa.int64()), ("bands", pa.list_(pa.int64())), ("coords", pa.binary())])


def _sketch(batches):
    for part, raw, offsets in pieces(batches):
        rows = len(offsets) - 1
        row, value = shingles(raw, offsets)
        n = np.bincount(row, minlength=rows)
        flat = sketches(row, value, rows)
        sums = np.concatenate(([np.uint64(0)], np.cumsum(mix(value ^ _GOLD), dtype=np.uint64)))
        sums2 = np.concatenate(([np.uint64(0)], np.cumsum(mix(value + _GOLD), dtype=np.uint64)))
        cut = np.searchsorted(row, np.arange(rows + 1))
        bands = np.zeros((rows, BANDS), dtype=np.uint64)
        for r in range(ROWS):
            bands = mix(bands + flat[:, r::ROWS] + np.uint64(r + 1))
        bands = mix(bands + np.arange(1, BANDS + 1, dtype=np.uint64) * _GOLD).view(np.int64)
        small = mix(flat).astype(np.uint16)
        lists = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(np.where(n > 0, BANDS, 0)))).astype(np.int32),
                                         pa.array(bands[n > 0].ravel()))
        yield batch_of(_SKETCHED, *(part.column(part.schema.get_field_index(c)) for c in ("_k1", "_k2", "doc_id")), n,
                       signed(sums[cut[1:]] - sums[cut[:-1]]), signed(sums2[cut[1:]] - sums2[cut[:-1]]),
                       lists, [x.tobytes() for x in small])


_LINKED = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("linked", pa.bool_())])


def _verify(batches):
    """Pairs with both texts: the sets' sizes of intersection and union decide."""
    for batch in batches:
        a, b = batch.column(0), batch.column(1)
        verdict, done = [], 0
        left = pa.RecordBatch.from_arrays([batch.column(2)], ["_text"])
        for part, raw, offsets in pieces([left]):
            size = part.num_rows
            right = pa.RecordBatch.from_arrays([batch.column(3).slice(done, size)], ["_text"])
            row, value = shingles(raw, offsets)
            cut = np.searchsorted(row, np.arange(size + 1))
            at = 0
            for part2, raw2, offsets2 in pieces([right]):
                row2, value2 = shingles(raw2, offsets2)
                cut2 = np.searchsorted(row2, np.arange(part2.num_rows + 1))
                for i in range(part2.num_rows):
                    x, y = value[cut[at + i]:cut[at + i + 1]], value2[cut2[i]:cut2[i + 1]]
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    verdict.append(100 * common >= PERCENT * (len(x) + len(y) - common) and common > 0)
                at += part2.num_rows
            done += size
        yield batch_of(_LINKED, a, b, verdict)


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, linked) of distinct pairs; ``texts`` (node, text) holds every id of a pair."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return settled(both.mapInArrow(_verify, "a long, b long, linked boolean"), "verified")


_CANDIDATES = pa.schema([("key", pa.int64()), ("i", pa.int32()), ("j", pa.int32()),
                         ("a", pa.list_(pa.int64())), ("b", pa.list_(pa.int64()))])
#: Sketch comparisons made at once.
_AT_ONCE = 1 << 15


def _agreeing(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which coordinates of each x and y agree, and how many; bytes of 0 and 1 are summed eight at a time."""
    equal = y[None, :, :] == x[:, None, :]
    words = equal.view(np.uint64).sum(axis=2, dtype=np.uint64)
    return equal, ((words * np.uint64(0x0101010101010101)) >> np.uint64(56)).astype(np.int64)


def _compare(group: pa.Table) -> pa.Table:
    """Candidate pairs of one task, as two lists, best first: ``minor`` members against ``home`` members."""
    got = {c: group.column(c).to_numpy() for c in ("node", "comp", "major", "n", "minor")}
    coords = np.frombuffer(b"".join(group.column("coords").to_pylist()), dtype=np.uint16).reshape(-1, COORDINATES)
    band = group.column("band")[0].as_py()
    minor = np.flatnonzero(got["minor"])
    home = np.flatnonzero(~got["minor"])
    minor = minor[np.lexsort((got["node"][minor], got["n"][minor]))]
    home = home[np.lexsort((got["node"][home], got["n"][home]))]
    yi, yc, yn, ym = (got[c][home] for c in ("node", "comp", "n", "major"))
    y, inner = coords[home], yc == ym
    a, b, best = [], [], []
    step = max(1, _AT_ONCE // max(1, len(home)))
    for k in range(0, len(minor), step):
        at = minor[k:k + step]
        xn = got["n"][at]
        # sizes alone rule out the others
        low = int(np.searchsorted(yn * 100, xn[0] * PERCENT, side="left"))
        high = int(np.searchsorted(yn * PERCENT, xn[-1] * 100, side="right"))
        if low >= high:
            continue
        equal, count = _agreeing(coords[at], y[low:high])
        # both outside the largest component: they meet twice, one of the two counts
        fit = ((count >= LEAST_EQUAL) & (yc[low:high][None, :] != got["comp"][at][:, None])
               & (inner[low:high][None, :] | (yi[low:high][None, :] > got["node"][at][:, None])))
        r, c = np.nonzero(fit)
        if band and len(r):
            earlier = equal[r, c, :band * ROWS].reshape(len(r), band, ROWS).all(axis=2).any(axis=1)
            r, c = r[~earlier], c[~earlier]
        a.append(got["node"][at][r])
        b.append(yi[low:high][c])
        best.append(count[r, c])
    if not sum(map(len, a)):
        return _CANDIDATES.empty_table()
    order = np.argsort(-np.concatenate(best), kind="stable")
    one = {c: group.column(c)[0].as_py() for c in ("key", "i", "j")}
    return pa.Table.from_pydict({**{c: [v] for c, v in one.items()}, "a": [np.concatenate(a)[order]],
                                 "b": [np.concatenate(b)[order]]}, schema=_CANDIDATES)


def _test(pairs: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
    """Links of one task that join components, from its pairs (best first) and its members' texts."""
    at, sets, up = {}, [], {}
    batch = pa.RecordBatch.from_pandas(members[["_text"]].reset_index(drop=True), preserve_index=False)
    for i, (doc, comp) in enumerate(zip(members["node"].tolist(), members["comp"].tolist(), strict=True)):
        at[doc] = i
        up[comp] = comp
    for part, raw, offsets in pieces([batch]):
        row, value = shingles(raw, offsets)
        cut = np.searchsorted(row, np.arange(part.num_rows + 1))
        sets += [value[x:y] for x, y in zip(cut, cut[1:])]
    comps = members["comp"].tolist()

    def root(c):
        while up[c] != c:
            up[c] = up[up[c]]
            c = up[c]
        return c
    found = []
    for a, b in zip(np.concatenate(pairs["a"].tolist()).tolist(), np.concatenate(pairs["b"].tolist()).tolist()):
        x, y = root(comps[at[a]]), root(comps[at[b]])
        if x != y:
            p, q = sets[at[a]], sets[at[b]]
            common = len(np.intersect1d(p, q, assume_unique=True))
            if common and 100 * common >= PERCENT * (len(p) + len(q) - common):
                up[x] = y
                found.append((a, b))
    return pd.DataFrame(found, columns=["a", "b"]).astype("int64")


def _open_links(members: DataFrame, comps: DataFrame, coords: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) that join components, from the buckets that hold several."""
    known = comps.select("node", F.col("component").alias("c"))
    rows = settled(members.join(known, "node", "left").select(
        "key", "band", "node", F.coalesce("c", "node").alias("comp")), "placed")
    per = rows.groupBy("key", "comp").agg(F.count("*").alias("m"))
    sums = settled(per.groupBy("key").agg(F.count("*").alias("comps"), F.sum("m").alias("m"),
                                  F.max(F.struct("m", "comp")).alias("top")).where("comps > 1") \
        .select("key", "m", F.col("top")["comp"].alias("major"), F.col("top")["m"].alias("majors")), "sums")
    got = rows.join(sums, "key").join(coords, "node")
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    minor_blocks = F.ceil((F.col("m") - F.col("majors")) / BLOCK).cast("int")
    place = F.pmod(F.xxhash64("node"), blocks.cast("long")).cast("int")
    minor_place = F.pmod(F.xxhash64("node", F.lit(1)), minor_blocks.cast("long")).cast("int")
    columns = ("key", "band", "node", "comp", "major", "n", "coords")
    home = got.select(*columns, F.lit(False).alias("minor"), place.alias("j"),
                      F.explode(F.sequence(F.lit(0), minor_blocks - 1)).alias("i"))
    minor = got.where("comp <> major").select(*columns, F.lit(True).alias("minor"), minor_place.alias("i"),
                                              F.explode(F.sequence(F.lit(0), blocks - 1)).alias("j"))
    found = settled(home.unionByName(minor.select(home.columns)).groupBy("key", "i", "j").applyInArrow(
        _compare, "key long, i int, j int, a array<long>, b array<long>"), "candidates")
    wanted = found.select("key", "i", "j", F.explode(F.array_distinct(F.concat("a", "b"))).alias("node"))
    fetched = wanted.join(texts.select("node", F.col("text").alias("_text")), "node").join(known, "node", "left") \
        .select(F.col("key").alias("k"), F.col("i").alias("x"), F.col("j").alias("y"), "node",
                F.coalesce("c", "node").alias("comp"), "_text")
    return settled(found.groupBy("key", "i", "j").cogroup(fetched.groupBy("k", "x", "y")).applyInPandas(
        lambda p, m: _test(p, m), "a long, b long"), "links")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    return judged(docs, doc_id, text).drop("_k1", "_k2")


def judged(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row, with its row key (_k1, _k2)."""
    rows = keyed(docs, doc_id, text).select("_k1", "_k2", F.col("_id").cast("long").alias("doc_id"),
                                            F.coalesce("_text", F.lit("")).alias("_text"))
    sketched = settled(rows.mapInArrow(
        _sketch, "_k1 long, _k2 long, doc_id long, n long, h1 long, h2 long, bands array<long>, coords binary")
        .withColumn("node", F.monotonically_increasing_id()), "sketches")
    # A set's node is the number of one of its rows; its first row is the one that stays.
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_k1", "_k2")
    sets = settled(sketched.where("n > 0").groupBy("h1", "h2", "n").agg(
        F.min("node").alias("node"), F.min(first).alias("first")), "sets")
    reps = sketched.select("node", "_k1", "_k2", "n", "bands", "coords").join(sets.select("node"), "node", "left_semi")
    banded = reps.select("node", F.posexplode("bands").alias("band", "key"))
    # Written before they are joined: a join of two plain scans is one whose hot keys Spark can split.
    buckets = settled(banded.groupBy("key").agg(F.count("*").alias("m"), F.min("node").alias("hub")).where("m > 1")
                      .select("key", "hub"), "buckets")
    members = settled(banded.join(buckets, "key"), "members")
    nodes = members.select("node").distinct()
    coords = settled(reps.select("node", "_k1", "_k2", "n", "coords").join(nodes, "node", "left_semi"), "coords")
    texts = settled(rows.select("_k1", "_k2", F.col("_text").alias("text")).join(
        coords.select("node", "_k1", "_k2"), ["_k1", "_k2"]).select("node", "text"), "texts")
    if texts.count() > coords.count():  # rows that are repeated, id and text
        texts = settled(texts.dropDuplicates(["node"]), "texts")
    coords = coords.drop("_k1", "_k2")
    # a) one hub for each member
    shared = members.where("node <> hub").groupBy("node", "hub").agg(F.count("*").alias("n"))
    near = shared.groupBy("node").agg(F.max(F.struct("n", -F.col("hub"))).alias("top")).select(
        (-F.col("top")["col2"]).alias("a"), F.col("node").alias("b"))
    links = _verified(near, texts).where("linked").select("a", "b")
    comps = components(links)
    more = _open_links(members, comps, coords, texts)
    if more.limit(1).count():
        comps = components(links.unionByName(more))
    found = settled(sets.join(comps, "node", "left").withColumn("component", F.coalesce("component", "node")), "found")
    tops = settled(found.groupBy("component").agg(F.min("first").alias("top")), "tops")
    verdict = settled(found.join(tops, "component").select("h1", "h2", "n", "top"), "verdict")
    out = sketched.select("doc_id", "n", "h1", "h2", "_k1", "_k2").join(verdict, ["h1", "h2", "n"], "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("top")["doc_id"])
    top = (F.col("_k1") == F.col("top")["_k1"]) & (F.col("_k2") == F.col("top")["_k2"])
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      ((F.col("n") == 0) | top).alias("kept"), "_k1", "_k2")


def survivors(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: one for each component, the one with its smallest id.

    Texts without a set stay. Of rows that repeat id and text, one stays; without an id and a set, all of them.
    """
    k1, k2 = free_name(docs, "_k1"), free_name(docs, "_k2")
    rows = docs.withColumns(dict(zip((k1, k2), row_key(doc_id, text), strict=True)))
    found = settled(judged(docs, doc_id, text).where("doc_id IS NOT NULL OR n_shingles > 0").groupBy(
        F.col("_k1").alias(k1), F.col("_k2").alias(k2)).agg(F.bool_or("kept").alias("kept"), F.count("*").alias("n"))
        .where("NOT kept OR n > 1"), "gone")
    alone = rows.join(found.select(k1, k2), [k1, k2], "left_anti").select(*docs.columns)
    again = found.where("kept").select(k1, k2)
    if not again.limit(1).count():
        return alone
    # Written before it is combined, so that a key of many rows is never gathered.
    repeated = settled(rows.join(again, [k1, k2], "left_semi"), "repeated")
    return alone.unionByName(repeated.dropDuplicates([k1, k2]).select(*docs.columns))
