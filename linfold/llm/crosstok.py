"""Cross-tokenizer alignment: which tokens of one vocabulary lie over which tokens of another.

Both tokenizers cut the same bytes. Where a token of A and a token of B end at the same byte, the text is cut
into *groups*; inside a group every A token is linked with every B token.

*Galloping intersection.* The shorter of a text's two lists of token ends drives: each of its ends is sought in
the longer list from the place that its rank suggests, by steps that double until the end is passed, then by
binary search between the last two steps. Searches of a whole piece of the table run side by side in numpy.
The indices of common ends slice both lists into groups, and differences of neighbouring indices (ranks) are
the lengths of the token ranges that overlap.

*Counts over the corpus.* Every text is tokenized once and leaves its distinct linked id pairs with how often
each is linked. A pair's count is the number of texts that hold it. The most frequent pairs, ``HEAD`` at most,
are broadcast (they make up nearly all rows that would have to be joined, and every hot key); texts look the
others up through a shuffle in which no key is hot, as their counts lie below that of the head.

Handling: texts that are null, empty or not reproduced byte for byte by both vocabularies have no tokens: zeros
and an empty digest. White space counts like any text. Equal rows and rows of one id are rows like others, null
ids are kept. A long text is a piece of its own; its links are listed in blocks of ``LINKS``, so a stretch
without common ends costs time, not memory. Other columns are not read. An empty table gives an empty result.

The vocabularies' files are a parameter (``folder``); both are public and are only read. A's file is read by the
library that it was written for; where its merges stand in the order of their ids, which makes every id a rank,
a faster library encodes with the same entries and ranks (the test compares them).
"""

from __future__ import annotations

import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linfold.llm.texts import batch_of, pieces, settled

FOLDER = "/opt/tokenizers"
FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Pairs that are broadcast (17 bytes each), and links listed at a time.
HEAD, LINKS = 1 << 20, 1 << 20
#: Text bytes tokenized at a time.
PIECE = 1 << 18

#: Fixed value: how byte-level vocabularies of this kind cut a text before merging.
BYTE_LEVEL_WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The faster library's pattern matcher runs out of stack on runs of white space far longer than this.
_LONG_SPACE = re.compile(r"\s{1000}")

_LOADED: dict = {}


class Vocabulary:
    """Token bytes of all ids, one after another."""

    def __init__(self, tokens: list[bytes]):
        self.flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.sizes = np.array([len(t) for t in tokens], dtype=np.int64)
        self.begins = np.concatenate(([0], np.cumsum(self.sizes)))[:-1]

    def __len__(self) -> int:
        return len(self.sizes)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ids) else 0
        return self.flat[np.repeat(self.begins[ids] - (ends - sizes), sizes) + np.arange(total)]


def _byte_of_sign() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for: printable Latin-1 signs stand for themselves,
    the other bytes are numbered from U+0100 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Pair:
    """Both tokenizers of one process, and their vocabularies."""

    def __init__(self, folder: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        import sentencepiece
        from tokenizers import Tokenizer

        path = f"{folder}/{FILE_A}"
        self.a = Tokenizer.from_file(path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{FILE_B}")
        known = self.a.get_vocab(with_added_tokens=True)
        signs = _byte_of_sign()
        entries: list[bytes] = [b""] * (max(known.values()) + 1)
        for entry, i in known.items():
            entries[i] = bytes(signs[c] for c in entry) if all(c in signs for c in entry) else entry.encode()
        self.vocab_a = Vocabulary(entries)
        self.vocab_b = Vocabulary([
            bytes([int(self.b.id_to_piece(i)[3:-1], 16)]) if self.b.is_byte(i)
            else self.b.id_to_piece(i).replace("▁", " ").encode() for i in range(self.b.get_piece_size())])
        self.quick = _ranked(path, entries)

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        if self.quick is None:
            return [e.ids for e in self.a.encode_batch(texts, add_special_tokens=False)]
        return [self.a.encode(t, add_special_tokens=False).ids if _LONG_SPACE.search(t) else self.quick.encode_ordinary(t)
                for t in texts]

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        return self.encode_a([" " + t for t in texts]), self.b.encode(texts, num_threads=1)


def _ranked(path: str, entries: list[bytes]):
    """The faster encoder of a byte-level file, if its merges stand in the order of their ids; else None."""
    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    vocab, merges = told["model"]["vocab"], told["model"]["merges"]
    made = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in merges]
    first = len(vocab) - len(merges) - len([t for t in told["added_tokens"] if t["content"] in vocab])
    cut = told["pre_tokenizer"] or {}
    if cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True) \
            or told["normalizer"] is not None or any(vocab.get(m) != first + i for i, m in enumerate(made)):
        return None
    import tiktoken

    ranks = {entries[i]: i for i in range(first + len(merges))}
    return tiktoken.Encoding("byte_level", pat_str=BYTE_LEVEL_WORDS, mergeable_ranks=ranks, special_tokens={})


def loaded(folder: str) -> Pair:
    if folder not in _LOADED:
        _LOADED[folder] = Pair(folder)
    return _LOADED[folder]


def gallop(wanted: np.ndarray, ends: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Index of the first of ``ends`` that is not below each wanted value, sought outwards from ``start``.

    Both lists ascend, and the last end is not below any wanted value.
    """
    high = start.copy()
    low = start.copy()
    below = ends[start] < wanted
    step = 1
    go = np.flatnonzero(below)
    while len(go):  # to the right
        low[go] = high[go]
        high[go] = np.minimum(high[go] + step, len(ends) - 1)
        go = go[ends[high[go]] < wanted[go]]
        step *= 2
    step = 1
    go = np.flatnonzero(~below)
    while len(go):  # to the left; -1 is below everything
        high[go] = np.maximum(low[go], 0)
        low[go] = np.maximum(low[go] - step, -1)
        go = go[low[go] >= 0]
        go = go[ends[low[go]] >= wanted[go]]
        step *= 2
    go = np.flatnonzero(high - low > 1)
    while len(go):
        mid = (high[go] + low[go]) >> 1
        up = ends[mid] < wanted[go]
        low[go[up]] = mid[up]
        high[go[~up]] = mid[~up]
        go = go[high[go] - low[go] > 1]
    return high


def common_ends(ends_a: np.ndarray, ends_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices, in both lists, of the ends that both have; texts lie one after another, ``n_a`` and ``n_b`` tokens each."""
    first_a, first_b = (np.concatenate(([0], np.cumsum(n))) for n in (n_a, n_b))
    found_a, found_b = [], []
    for a_drives in (True, False):
        rows = np.flatnonzero((n_a <= n_b if a_drives else n_a > n_b) & (n_a > 0))
        if not len(rows):
            continue
        n, first, m, other = (n_a, first_a, n_b, first_b) if a_drives else (n_b, first_b, n_a, first_a)
        driver, longer = (ends_a, ends_b) if a_drives else (ends_b, ends_a)
        row = np.repeat(rows, n[rows])
        rank = np.arange(len(row)) - np.repeat(np.cumsum(n[rows]) - n[rows], n[rows])
        at = first[row] + rank
        hit = gallop(driver[at], longer, other[row] + rank * m[row] // n[row])
        same = longer[hit] == driver[at]
        found_a.append((at if a_drives else hit)[same])
        found_b.append((hit if a_drives else at)[same])
    if not found_a:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.sort(np.concatenate(found_a)), np.sort(np.concatenate(found_b))


class Aligned:
    """The tokens and groups of a piece: ids, tokens of each text, and for each group its text and token ranges."""

    def __init__(self, pair: Pair, texts: list[str]):
        lists_a, lists_b = pair.encode(texts)
        ids_a, n_a = _flat(lists_a)
        ids_b, n_b = _flat(lists_b)
        want = [b" " + t.encode() for t in texts]
        sizes = np.array([len(w) for w in want], dtype=np.int64)
        whole = np.frombuffer(b"".join(want), dtype=np.uint8)
        good = (sizes > 1) & _reproduced(pair.vocab_a, ids_a, n_a, whole, sizes) \
            & _reproduced(pair.vocab_b, ids_b, n_b, whole, sizes)
        self.ids_a, self.ids_b = ids_a[np.repeat(good, n_a)], ids_b[np.repeat(good, n_b)]
        self.n_a, self.n_b = np.where(good, n_a, 0), np.where(good, n_b, 0)
        ends_a, ends_b = np.cumsum(pair.vocab_a.sizes[self.ids_a]), np.cumsum(pair.vocab_b.sizes[self.ids_b])
        self.stop_a, self.stop_b = (x + 1 for x in common_ends(ends_a, ends_b, self.n_a, self.n_b))
        self.start_a, self.start_b = (np.concatenate(([0], x))[:-1] for x in (self.stop_a, self.stop_b))
        row_a = np.repeat(np.arange(len(texts)), self.n_a)
        self.row = row_a[self.start_a]
        self.links = (self.stop_a - self.start_a) * (self.stop_b - self.start_b)

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sums over each text's groups."""
        total = np.concatenate(([0], np.cumsum(values)))
        edge = np.searchsorted(self.row, np.arange(len(self.n_a) + 1))
        return total[edge[1:]] - total[edge[:-1]]

    def pairs(self, size_b: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(text * width + a * size_b + b, how often it is linked), sorted."""
        group = np.repeat(np.arange(len(self.links)), self.stop_a - self.start_a)
        reach = (self.stop_b - self.start_b)[group]
        upto = np.cumsum(reach)
        keys, times, at = [], [], 0
        while at < len(group):
            end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + LINKS, side="right")))
            n = reach[at:end]
            ahead = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            b = self.ids_b[np.repeat(self.start_b[group[at:end]], n) + ahead]
            base = self.row[group[at:end]] * width + self.ids_a[at:end] * size_b
            k, c = np.unique(np.repeat(base, n) + b, return_counts=True)
            keys.append(k)
            times.append(c)
            at = end
        if len(keys) < 2:
            return (keys[0], times[0]) if keys else (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))
        k, where = np.unique(np.concatenate(keys), return_inverse=True)
        return k, np.bincount(where, weights=np.concatenate(times)).astype(np.int64)

    def spelled(self) -> list[str]:
        """Of each text, ``a1,a2|b1;a3|b2,b3``: the ids of its groups."""
        most = int(max(self.ids_a.max(initial=0), self.ids_b.max(initial=0))) + 1
        sign = _SIGNS.get(most)
        if sign is None:
            ids = [str(i) for i in range(most)]
            sign = _SIGNS[most] = np.array([i + s for s in (",", "|", ";") for i in ids], dtype=object)
        group_a = np.repeat(np.arange(len(self.links)), self.stop_a - self.start_a)
        group_b = np.repeat(np.arange(len(self.links)), self.stop_b - self.start_b)
        codes = np.empty(len(self.ids_a) + len(self.ids_b), dtype=np.int64)
        last_a, last_b = np.zeros(len(self.ids_a), dtype=bool), np.zeros(len(self.ids_b), dtype=bool)
        last_a[self.stop_a - 1] = last_b[self.stop_b - 1] = True
        codes[np.arange(len(self.ids_a)) + self.start_b[group_a]] = self.ids_a + most * last_a
        codes[np.arange(len(self.ids_b)) + self.stop_a[group_b]] = self.ids_b + 2 * most * last_b
        words = sign[codes].tolist()
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        return ["".join(words[s:e])[:-1] for s, e in zip([0, *ends], ends)]


_SIGNS: dict = {}


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    n = np.array([len(x) for x in lists], dtype=np.int64)
    return np.fromiter((i for x in lists for i in x), dtype=np.int64, count=int(n.sum())), n


def _reproduced(vocab: Vocabulary, ids: np.ndarray, n: np.ndarray, whole: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Texts whose tokens' bytes are the text's own."""
    made = vocab.joined(ids)
    length = np.concatenate(([0], np.cumsum(vocab.sizes[ids])))
    edge = np.concatenate(([0], np.cumsum(n)))
    at = length[edge]
    if len(made) == len(whole) and (np.diff(at) == sizes).all() and (made == whole).all():
        return np.ones(len(n), dtype=bool)
    out, begin = np.zeros(len(n), dtype=bool), 0
    for r, size in enumerate(sizes.tolist()):
        out[r] = at[r + 1] - at[r] == size and bool((made[at[r]:at[r + 1]] == whole[begin:begin + size]).all())
        begin += size
    return out


def _texts(part: pa.RecordBatch) -> list[str]:
    return part.column(part.schema.get_field_index("_text")).fill_null("").to_pylist()


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("_id"), F.col(text).cast("string").alias("_text"))


_GROUPS = pa.schema([("doc_id", pa.int64()), ("a_ids", pa.list_(pa.int32())), ("b_ids", pa.list_(pa.int32())),
                     ("a_stops", pa.list_(pa.int32())), ("b_stops", pa.list_(pa.int32()))])


def _listed(values: np.ndarray, n: np.ndarray, kind) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))).astype(np.int32)), pa.array(values, kind))


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folder: str = FOLDER) -> DataFrame:
    """(doc_id, a_ids, b_ids, a_stops, b_stops): the ids of each text in both vocabularies, and behind which of its
    tokens each group ends."""
    def run(batches):
        pair = loaded(folder)
        for part, _, _ in pieces(batches, max_bytes=PIECE):
            x = Aligned(pair, _texts(part))
            n = x.per_text(np.ones(len(x.row), dtype=np.int64))
            before = [(np.cumsum(k) - k)[x.row] for k in (x.n_a, x.n_b)]
            yield batch_of(_GROUPS, part.column(0), _listed(x.ids_a, x.n_a, pa.int32()), _listed(x.ids_b, x.n_b, pa.int32()),
                           _listed(x.stop_a - before[0], n, pa.int32()), _listed(x.stop_b - before[1], n, pa.int32()))
    return _rows(docs, doc_id, text).mapInArrow(
        run, "doc_id long, a_ids array<int>, b_ids array<int>, a_stops array<int>, b_stops array<int>")


_LINKED = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                     ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int64())),
                     ("times", pa.list_(pa.int32()))])
_LINKED_DDL = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, " \
              "times array<int>"


def _linked(folder: str):
    def run(batches):
        pair = loaded(folder)
        size_b = len(pair.vocab_b)
        width = len(pair.vocab_a) * size_b
        for part, _, _ in pieces(batches, max_bytes=PIECE):
            x = Aligned(pair, _texts(part))
            keys, times = x.pairs(size_b, width)
            n = np.bincount(keys // width, minlength=len(x.n_a))
            digests = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in x.spelled()]
            yield batch_of(_LINKED, part.column(0), x.n_a, x.n_b, x.per_text(np.ones(len(x.row), dtype=np.int64)),
                           x.per_text(x.links), digests, _listed(keys % width, n, pa.int64()), _listed(times, n, pa.int32()))
    return run


def pair_counts(linked: DataFrame, size_b: int) -> DataFrame:
    """(pair, n, best): in how many texts each id pair is linked, and whether no pair of its A id is in more."""
    # Written before it is joined; one row for each A id at most, however many texts there are.
    counts = settled(linked.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")), "counts")
    a = F.floor(F.col("pair") / size_b).alias("a")
    top = counts.groupBy(a).agg(F.max("n").alias("top"))
    return settled(counts.withColumn("a", a).join(F.broadcast(top), "a").select(
        "pair", "n", (F.col("n") == F.col("top")).alias("best")), "known")


def _head(known: DataFrame, most: int):
    """(lowest count in the head, its pairs ascending with counts and best marks): ``most`` pairs at most."""
    sizes = known.groupBy(F.floor(F.log2("n")).cast("int").alias("b")).count().orderBy(F.desc("b")).collect()
    total, least = 0, None
    for r in sizes:  # a row for each power of two
        total += r["count"]
        if total > most:
            break
        least = 1 << r["b"]
    if least is None:
        least = (2 << sizes[0]["b"]) if sizes else 1
    table = known.where(F.col("n") >= least).toArrow().sort_by("pair")
    return least, [table.column(c).to_numpy() for c in ("pair", "n", "best")]


_SCORED = pa.schema([("n_best", pa.int64()), ("count_sum", pa.int64()), ("pairs", pa.list_(pa.int64())),
                     ("times", pa.list_(pa.int32()))])


def _looked_up(head):
    """What the head says of each text's pairs; pairs that it does not hold are handed on."""
    def run(batches):
        pairs, n, best = head.value
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("pairs"))
            size = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            mine = column.flatten().to_numpy(zero_copy_only=False)
            times = batch.column(batch.schema.get_field_index("times")).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.searchsorted(pairs, mine)
            here = np.zeros(len(mine), dtype=bool)
            inside = at < len(pairs)
            here[inside] = pairs[at[inside]] == mine[inside]
            count, top = np.zeros(len(mine), dtype=np.int64), np.zeros(len(mine), dtype=np.int64)
            count[here], top[here] = n[at[here]] * times[here], best[at[here]] * times[here]
            row = np.repeat(np.arange(len(size)), size)
            sums = [np.diff(np.concatenate(([0], np.cumsum(x)))[np.concatenate(([0], np.cumsum(size)))]) for x in (top, count)]
            rest = np.bincount(row[~here], minlength=len(size))
            kept = [batch.column(i) for i in range(7)]
            yield pa.RecordBatch.from_arrays(
                [*kept, *map(pa.array, sums), _listed(mine[~here], rest, pa.int64()), _listed(times[~here], rest, pa.int32())],
                names=[*batch.schema.names[:7], "n_best", "count_sum", "pairs", "times"])
    return run


def aligned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folder: str = FOLDER, head: int = HEAD) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    spark = docs.sparkSession
    linked = settled(_rows(docs, doc_id, text).mapInArrow(_linked(folder), _LINKED_DDL)
                     .select(F.monotonically_increasing_id().alias("_row"), "*"), "linked")
    size_b = len(loaded(folder).vocab_b)
    known = pair_counts(linked, size_b)
    least, top = _head(known, head)
    shared = spark.sparkContext.broadcast(top)
    told = settled(linked.select("_row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times").mapInArrow(
        _looked_up(shared), "_row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "n_best long, count_sum long, pairs array<long>, times array<int>"), "told")
    rest = told.select("_row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("_row", "p.pairs", "p.times")
    more = rest.join(known.where(F.col("n") < least), rest["pairs"] == known["pair"]).groupBy("_row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("b"), F.sum(F.col("times") * F.col("n")).alias("c"))
    zero = F.lit(0).cast("long")
    return told.join(more, "_row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("b", zero)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("c", zero)).alias("count_sum"), "groups_sha256")
