"""Benchmark decontamination by greedy string tiling.

Texts are lower-cased and cut into tokens (letters and digits; all else separates), so punctuation
and case do not hide a copy. For a document and a benchmark item that share seeds, i.e. runs of
``LEAST`` tokens found by a running Karp-Rabin hash, tiles are laid greedily: the longest match that
touches no marked token is marked in both texts, again and again, until no match of ``LEAST`` tokens
is left. A document is contaminated by an item if tiles cover at least ``COVERAGE`` of the item's
tokens. As tiles may come in any order, reordered passages count like verbatim ones; marking keeps a
phrase that a document repeats from counting twice.

Seeds of the benchmark are joined with the documents' running hashes. Up to ``BROADCAST_SEEDS``
seeds (counted first) are broadcast and documents are only scanned; beyond that, the seeds of
documents and items are joined through a shuffle, which gives the same pairs. In both ways, only
pairs whose seeds could cover enough of the item are tiled, and no group of a hot seed is gathered:
each hit is summed up in its pair.

Defined results: null or empty documents are clean, with 0 tokens. Items of fewer than ``LEAST``
tokens (null ones too) are too short to be evidence and match nothing. Items that repeat count
once (an id with several texts: its best one). Of several items with the same coverage, the smallest
id is named, and items without an id last (item_id is null then); each text without an id is an item.
Null ids are rows like others; repeated rows give repeated results. An empty benchmark
leaves all documents clean.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linfold.llm.texts import Words, batch_of, free_name, keyed, pieces, row_key, settled, signed, windows_hash

LEAST = 4
COVERAGE = 0.5
BROADCAST_SEEDS = 1 << 20
TOKEN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: ASCII other than letters and digits becomes a space; what is left are tokens.
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[[c for c in range(128) if not chr(c).isalnum()]] = 32


def _tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray]:
    words = Words(_PLAIN[raw], offsets)
    return words, words.hashes()


def tile(doc_at: np.ndarray, item_at: np.ndarray, least: int, doc_size: int, item_size: int) -> int:
    """Tokens of the item that greedy tiles cover, from the places of all common runs of ``least`` tokens.

    Seeds that follow each other on a diagonal are one maximal match. The longest match is taken
    first (then the first in the document, then in the item); one that marked tokens have cut is put
    back with what is left of it.
    """
    order = np.lexsort((item_at, doc_at - item_at))
    doc_at, item_at = doc_at[order], item_at[order]
    diagonal = doc_at - item_at
    new = np.flatnonzero(np.concatenate(([True], (diagonal[1:] != diagonal[:-1]) | (item_at[1:] != item_at[:-1] + 1))))
    length = np.diff(np.concatenate((new, [len(item_at)]))) + least - 1
    heap = [(-n, d, i) for n, d, i in zip(length.tolist(), doc_at[new].tolist(), item_at[new].tolist(), strict=True)]
    heapq.heapify(heap)
    doc_marked, item_marked = np.zeros(doc_size, dtype=bool), np.zeros(item_size, dtype=bool)
    covered = 0
    while heap:
        n, d, i = heapq.heappop(heap)
        n = -n
        taken = doc_marked[d:d + n] | item_marked[i:i + n]
        if not taken.any():
            doc_marked[d:d + n] = item_marked[i:i + n] = True
            covered += n
            continue
        free = np.flatnonzero(np.diff(np.concatenate(([True], taken, [True])).astype(np.int8)))
        for a, z in zip(free[::2].tolist(), free[1::2].tolist(), strict=True):
            if z - a >= least:
                heapq.heappush(heap, (-(z - a), d + a, i + a))
    return covered


class Seeds:
    """Sorted running hashes of the items, with the item's number and the place of each; ``names`` sort unnamed items last."""

    def __init__(self, hashes: np.ndarray, item: np.ndarray, place: np.ndarray, names: list[tuple[bool, int]],
                 sizes: np.ndarray):
        order = np.lexsort((place, item, hashes))
        self.hashes, self.item, self.place, self.names, self.sizes = hashes[order], item[order], place[order], names, sizes

    @staticmethod
    def of(items: list[tuple[int | None, str]], least: int) -> Seeds:
        raw = [t.encode() for _, t in items]
        offsets = np.concatenate(([0], np.cumsum([len(x) for x in raw]))).astype(np.int64)
        words, hashes = _tokens(np.frombuffer(b"".join(raw), dtype=np.uint8), offsets)
        at = words.window_starts(least)
        return Seeds(windows_hash(hashes, least)[at] if len(at) else hashes[:0], words.row[at],
                     at - words.first[words.row[at]], [(i is None, k if i is None else i) for k, (i, _) in enumerate(items)], words.counts)

    def hits(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into ``hashes``, index of the seed) of each agreement."""
        left = np.searchsorted(self.hashes, hashes, side="left")
        n = np.searchsorted(self.hashes, hashes, side="right") - left
        found = np.flatnonzero(n)
        n = n[found]
        which = np.repeat(found, n)
        return which, np.repeat(left[found] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(len(which))


def _union(places: np.ndarray, least: int) -> int:
    """Tokens that runs of ``least`` at these places (sorted, distinct) cover."""
    return int(np.minimum(np.diff(places), least).sum()) + least


_HITS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_items", pa.int64()),
                   ("item_id", pa.int64()), ("coverage", pa.float64()), ("_k1", pa.int64()), ("_k2", pa.int64())])
_HITS_DDL = "doc_id long, n_tokens long, n_items long, item_id long, coverage double, _k1 long, _k2 long"


def _scan(shared, least: int, threshold: float):
    def run(batches):
        seeds = shared.value
        for part, raw, offsets in pieces(batches):
            words, hashes = _tokens(raw, offsets)
            rows = len(offsets) - 1
            found: list[list[tuple[float, tuple[bool, int]]]] = [[] for _ in range(rows)]
            at = words.window_starts(least)
            if len(at) and len(seeds.hashes):
                which, seed = seeds.hits(windows_hash(hashes, least)[at])
                doc, item = words.row[at[which]], seeds.item[seed]
                order = np.lexsort((seeds.place[seed], item, doc))
                which, seed, doc, item = which[order], seed[order], doc[order], item[order]
                cut = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]), [True]))) \
                    if len(doc) else np.zeros(0, dtype=np.int64)
                for a, z in zip(cut[:-1].tolist(), cut[1:].tolist()):
                    size = int(seeds.sizes[item[a]])
                    places = seeds.place[seed[a:z]]
                    if _union(np.unique(places), least) < threshold * size:
                        continue
                    first = int(words.first[doc[a]])
                    share = tile(at[which[a:z]] - first, places, least, int(words.counts[doc[a]]), size) / size
                    if share >= threshold:
                        found[doc[a]].append((-share, seeds.names[item[a]]))
            best = [min(x) if x else (0.0, (True, 0)) for x in found]
            yield batch_of(_HITS, part.column(part.schema.get_field_index("_id")), words.counts.astype(np.int64),
                           [len({i for _, i in x}) for x in found], [None if no_id else i for _, (no_id, i) in best],
                           [-s for s, _ in best],
                           *(part.column(part.schema.get_field_index(k)) for k in ("_k1", "_k2")))
    return run


_SEEDED = pa.schema([("_k1", pa.int64()), ("_k2", pa.int64()), ("seed", pa.int64())])


def _seeded(least: int):
    """The distinct seeds of each text."""
    def run(batches):
        for part, raw, offsets in pieces(batches):
            words, hashes = _tokens(raw, offsets)
            at = words.window_starts(least)
            if len(at):
                row, value = words.row[at], windows_hash(hashes, least)[at]
                order = np.lexsort((value, row))
                row, value = row[order], value[order]
                new = np.concatenate(([True], (row[1:] != row[:-1]) | (value[1:] != value[:-1])))
                owner = pa.array(row[new])
                yield batch_of(_SEEDED, part.column(0).take(owner), part.column(1).take(owner), signed(value[new]))
    return run


_PAIRED = pa.schema([("_k1", pa.int64()), ("_k2", pa.int64()), ("item", pa.int64()), ("item_id", pa.int64()),
                     ("coverage", pa.float64())])


def _tile_pairs(least: int):
    """Pairs with both texts."""
    def run(batches):
        for batch in batches:
            item_id = batch.column(batch.schema.get_field_index("item_id")).to_pylist()
            item_text = batch.column(batch.schema.get_field_index("item_text")).to_pylist()
            done, shares = 0, []
            for part, raw, offsets in pieces([batch]):
                words, hashes = _tokens(raw, offsets)
                at = words.window_starts(least)
                value = windows_hash(hashes, least) if len(at) else hashes[:0]
                for r in range(part.num_rows):
                    seeds = Seeds.of([(item_id[done + r], item_text[done + r])], least)
                    mine = at[(at >= words.first[r]) & (at < words.first[r + 1])]
                    which, seed = seeds.hits(value[mine])
                    size = int(seeds.sizes[0])
                    shares.append(tile(mine[which] - words.first[r], seeds.place[seed], least, int(words.counts[r]),
                                       size) / size if len(which) else 0.0)
                done += part.num_rows
            yield batch_of(_PAIRED, batch.column(0), batch.column(1), batch.column(batch.schema.get_field_index("item")),
                           item_id, shares)
    return run


def _plain(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_text", F.lower(F.coalesce("_text", F.lit(""))))


def tiled(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
          item_text: str = "text", least: int = LEAST, threshold: float = COVERAGE,
          broadcast_seeds: int = BROADCAST_SEEDS) -> DataFrame:
    """(doc_id, n_tokens, n_items, item_id, coverage, contaminated) of every row, with its row key (_k1, _k2)."""
    rows = _plain(keyed(docs, doc_id, text)).withColumn("_id", F.col("_id").cast("long"))
    items = _plain(benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("_text"))).distinct()
    words = items.agg(F.sum(F.regexp_count("_text", F.lit(TOKEN))).alias("n")).first()["n"] or 0
    if words <= broadcast_seeds:
        index = Seeds.of([(r["item_id"], r["_text"]) for r in items.orderBy("item_id", "_text").collect()], least)
        shared = docs.sparkSession.sparkContext.broadcast(index)  # at most broadcast_seeds entries
        hits = rows.mapInArrow(_scan(shared, least, threshold), _HITS_DDL)
    else:
        hits = _joined(rows, items, least, threshold)
    return hits.withColumn("contaminated", F.col("n_items") > 0)


def _joined(rows: DataFrame, items: DataFrame, least: int, threshold: float) -> DataFrame:
    """The same as the scan, with both sides' seeds joined through a shuffle."""
    ids = items.withColumn("i", F.xxhash64("item_id", "_text"))
    item_seeds = ids.select(F.col("i").alias("_k1"), F.lit(0).cast("long").alias("_k2"), "_text").mapInArrow(
        _item_seeds(least), "item long, seed long, place int, size int")
    doc_seeds = rows.select("_k1", "_k2", "_text").mapInArrow(_seeded(least), "_k1 long, _k2 long, seed long")
    item_seeds = settled(item_seeds, "item_seeds")
    held = settled(doc_seeds.join(item_seeds.select("seed").distinct(), "seed", "left_semi"), "held")
    # A document that covers enough of an item hits at least ``need`` of its places, for a tile covers at most ``least``
    # tokens from each place that it hits. So it hits one of the places that are left without the need - 1 whose seeds
    # are most common, and only those are joined: a phrase that all documents and items share pairs nobody.
    spread = item_seeds.join(held.groupBy("seed").agg(F.count(F.lit(1)).alias("docs")), "seed")
    need = F.greatest(F.ceil(F.col("size") * threshold / least - 1e-9), F.lit(1))
    places = F.greatest(F.col("size") - least + 1, F.lit(1))
    common = Window.partitionBy("item").orderBy(F.desc("docs"), "place")  # the places of one benchmark item
    rare = spread.withColumn("nth", F.row_number().over(common)).where(F.col("nth") >= need).where(places >= need)
    candidates = held.join(settled(rare.select("item", "seed").distinct(), "rare"), "seed").select("_k1", "_k2", "item").distinct()
    hit = settled(candidates, "candidates").join(item_seeds, "item").join(held, ["_k1", "_k2", "seed"])
    pairs = hit.groupBy("_k1", "_k2", "item").agg(F.countDistinct("place").alias("n"), F.first("size").alias("size")) \
        .where(F.col("n") * least >= F.col("size") * threshold).select("_k1", "_k2", "item")
    texts = rows.select("_k1", "_k2", "_text").join(pairs, ["_k1", "_k2"]).dropDuplicates(["_k1", "_k2", "item"])
    both = texts.join(ids.select(F.col("i").alias("item"), "item_id", F.col("_text").alias("item_text")), "item")
    shares = both.select("_k1", "_k2", "item", "_text", "item_id", "item_text").mapInArrow(
        _tile_pairs(least), "_k1 long, _k2 long, item long, item_id long, coverage double") \
        .where(F.col("coverage") >= threshold)
    named = F.col("item_id").isNotNull()
    best = settled(shares.groupBy("_k1", "_k2").agg(
        F.countDistinct(named, F.coalesce("item_id", "item")).alias("n_items"),
        F.max(F.struct("coverage", named.alias("named"), (-F.col("item_id")).alias("id"))).alias("top")), "tiled")
    counted = rows.select("_id", "_k1", "_k2", F.regexp_count(
        "_text", F.lit(TOKEN)).cast("long").alias("n_tokens"))
    return counted.join(best, ["_k1", "_k2"], "left").select(
        F.col("_id").alias("doc_id"), "n_tokens", F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        (-F.col("top")["id"]).alias("item_id"), F.coalesce(F.col("top")["coverage"], F.lit(0.0)).alias("coverage"),
        "_k1", "_k2")


_ITEM_SEEDS = pa.schema([("item", pa.int64()), ("seed", pa.int64()), ("place", pa.int32()), ("size", pa.int32())])


def _item_seeds(least: int):
    def run(batches):
        for part, raw, offsets in pieces(batches):
            words, hashes = _tokens(raw, offsets)
            at = words.window_starts(least)
            if len(at):
                row = words.row[at]
                yield batch_of(_ITEM_SEEDS, part.column(0).take(pa.array(row)), signed(windows_hash(hashes, least)[at]),
                               (at - words.first[row]).astype(np.int32), words.counts[row].astype(np.int32))
    return run


def clean(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``found`` (of ``tiled``) does not call contaminated."""
    k1, k2 = free_name(docs, "_k1"), free_name(docs, "_k2")
    keys = row_key(doc_id, text)
    gone = found.where("contaminated").select(F.col("_k1").alias(k1), F.col("_k2").alias(k2)).distinct()
    return docs.withColumns({k1: keys[0], k2: keys[1]}).join(gone, [k1, k2], "left_anti").select(*docs.columns)
