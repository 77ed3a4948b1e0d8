"""Shared helpers of the text operators: Arrow text pieces, words, rolling hashes, row keys.

Everything here works on a bounded piece of one Arrow batch as flat numpy arrays, so no
Python loop runs per word or byte. A word is ``[^\\x20\\x09-\\x0D]+`` in the UTF-8 bytes.
Hashes are polynomials modulo 2**64 over well-mixed values, finished with a mixer; callers
that need certainty take two of them (128 bits) or compare the content itself.
"""

from __future__ import annotations

import contextlib
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linfold.session import fresh_name, shared_dir

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
#: Text bytes worked on at a time; a longer text is one piece of its own.
PIECE_BYTES = 1 << 19

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
#: Odd multipliers of the two polynomial families.
BASES = (0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93 | 1)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finisher."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _byte_table(seed: int, lower: bool) -> np.ndarray:
    codes = np.arange(256, dtype=np.uint64)
    if lower:
        codes = np.where((codes >= 65) & (codes <= 90), codes + np.uint64(32), codes)
    return mix((codes + np.uint64(1) + np.uint64(seed) * np.uint64(1000)) * _GOLD)


_TABLES = {(s, low): _byte_table(s, low) for s in (0, 1) for low in (False, True)}


def _powers(n: int, which: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i < n (kept and grown by doubling)."""
    have = _POWERS.get(which)
    if have is None or len(have[0]) < n:
        size = max(1 << 16, 1 << int(n - 1).bit_length())
        base = BASES[which]
        inverse = pow(base, -1, 1 << 64)
        up, down = np.full(size, base, dtype=np.uint64), np.full(size, inverse, dtype=np.uint64)
        up[0] = down[0] = 1
        have = (np.multiply.accumulate(up), np.multiply.accumulate(down))
        if size <= 1 << 22:
            _POWERS[which] = have
    return have[0][:n], have[1][:n]


def _prefix(values: np.ndarray, which: int) -> np.ndarray:
    up, _ = _powers(len(values), which)
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up, out=out[1:])
    return out


def spans_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """Hash of values[start:end] for each span (shift-free: equal contents hash equally anywhere)."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    total = _prefix(values, which)
    down = _powers(len(values), which)[1]
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _GOLD)


def windows_hash(values: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """Hash of each run of ``size`` values (one for each start; empty if there are fewer)."""
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = _prefix(values, which)
    down = _powers(len(values), which)[1]
    return mix((total[size:] - total[:n]) * down[:n])


def pieces(batches, text: str = "_text", max_bytes: int = PIECE_BYTES):
    """(slice of the batch, its text bytes, offsets) for runs of rows of bounded bytes; null texts are empty."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        if column.null_count:
            column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
        wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
        kind = np.int64 if wide else np.int32
        _, place, data = column.buffers()
        all_offsets = np.frombuffer(place, dtype=kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
        raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
        row = 0
        while row < batch.num_rows:
            end = int(np.searchsorted(all_offsets, all_offsets[row] + max_bytes, side="right")) - 1
            end = min(max(end, row + 1), batch.num_rows)
            yield (batch.slice(row, end - row), raw[all_offsets[row]:all_offsets[end]],
                   all_offsets[row:end + 1] - all_offsets[row])
            row = end


class Words:
    """Words of a piece: byte starts and ends, the row of each, and each row's first word (``first[r]:first[r+1]``)."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        n = len(raw)
        inside = ~_IS_SPACE[raw]
        edge = np.zeros(n + 1, dtype=bool)
        edge[offsets] = True
        before = np.empty(n, dtype=bool)
        after = np.empty(n, dtype=bool)
        if n:
            before[0], after[-1] = True, True
            before[1:] = ~inside[:-1]
            after[:-1] = ~inside[1:]
        self.starts = np.flatnonzero(inside & (before | edge[:n]))
        self.ends = np.flatnonzero(inside & (after | edge[1:])) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)
        self.row = np.repeat(np.arange(len(offsets) - 1), self.counts)
        self.raw = raw

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, lower: bool = False, which: int = 0) -> np.ndarray:
        return spans_hash(_TABLES[which, lower][self.raw], self.starts, self.ends, which)

    def window_starts(self, size: int) -> np.ndarray:
        """Words at which a window of ``size`` words of one row begins."""
        n = len(self) - size + 1
        if n <= 0:
            return np.zeros(0, dtype=np.int64)
        return np.flatnonzero(self.row[:n] == self.row[size - 1:])


def byte_values(raw: np.ndarray, which: int = 0) -> np.ndarray:
    return _TABLES[which, False][raw]


#: Bits for the place in a packed (hash, place) value; fixed, so that every piece orders hashes alike.
_PLACE_BITS = np.uint64(28)


#: Hashes whose minima are sought at a time; a longer text is worked on in blocks that overlap by a window.
MINIMA_BLOCK = 1 << 24


def leftmost_minima(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each start s, the leftmost place of the least hash in hashes[s:s+width] (block prefix and suffix minima).

    Any number of hashes: places are packed from the start of a block, and a window never leaves its block.
    """
    out = len(hashes) - width + 1
    if out <= 0:
        return np.zeros(0, dtype=np.int64)
    if width == 1:
        return np.arange(out)
    step = max(MINIMA_BLOCK - width + 1, width)
    if out <= step:
        return _minima(hashes, width)
    return np.concatenate([_minima(hashes[s:s + step + width - 1], width) + s for s in range(0, out, step)])


def _minima(hashes: np.ndarray, width: int) -> np.ndarray:
    n = len(hashes)
    out = n - width + 1
    keep = np.uint64((1 << int(_PLACE_BITS)) - 1)
    packed = (hashes & ~keep) | np.arange(n, dtype=np.uint64)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:n] = packed
    square = padded.reshape(blocks, width)
    left = np.minimum.accumulate(square, axis=1).ravel()
    right = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(right[:out], left[width - 1:width - 1 + out]) & keep).astype(np.int64)


def signed(x: np.ndarray) -> pa.Array:
    """uint64 hashes as the bigint that Spark has."""
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def row_key(doc_id: str, text: str) -> list[Column]:
    """Two longs that name a row by its id and text (null-safe; equal rows share the key)."""
    return [F.xxhash64(F.col(text)).alias("_k1"),
            F.xxhash64(F.col(doc_id).cast("string"), F.length(text), F.lit(17)).alias("_k2")]


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(_k1, _k2, _id, _text) of any frame; no other column is carried, so names cannot clash."""
    two = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("_text"))
    return two.select(*row_key("_id", "_text"), "_id", "_text")


def on_workers(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it (an installed package needs none of it)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (known, root) if x)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Folders written since each open ``scratch`` began.
_WRITTEN: list[list[str]] = []


def settled(df: DataFrame, what: str = "step") -> DataFrame:
    """The frame written to the shared folder and read back: lineage is cut, and a lost executor loses nothing.

    ``discard`` deletes the files of frames that nothing reads any more; ``scratch`` does so for a whole step.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "llm", fresh_name(what))
    for made in _WRITTEN:
        made.append(path)
    schema = df.schema
    df.write.parquet(path)
    back = spark.read.schema(schema).parquet(path)
    back._settled_at = path
    return back


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def discard(*frames: DataFrame) -> None:
    """Deletes what ``settled`` wrote for these frames."""
    for df in frames:
        _delete(df.sparkSession, df._settled_at)


@contextlib.contextmanager
def scratch(spark: SparkSession, keep: list[DataFrame]):
    """Deletes, at the end, what ``settled`` wrote inside, but for the frames in ``keep``."""
    made: list[str] = []
    _WRITTEN.append(made)
    try:
        yield
    finally:
        _WRITTEN.remove(made)
        kept = {df._settled_at for df in keep}
        for path in made:
            if path not in kept:
                _delete(spark, path)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that the frame does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, type=f.type)
         for c, f in zip(columns, schema, strict=True)], schema=schema)
