"""Language identification with one bit-sliced Bloom filter that answers for every language at once.

Each slot of the filter holds a bitmask with one bit for each language, and an n-gram sets the bit of
every language in which it was seen at all. A lookup ANDs the masks of ``HASHES`` slots, so one probe
returns all languages that contain the n-gram (and, rarely, one that does not). For a text, the hits of
each language are counted over all its n-grams (whole texts, repeats included), and the hits that the
filter's false-positive rate for that language explains are taken off:  (hits / n - fpr) / (1 - fpr).
The highest corrected share wins and is the ``score``. N-grams without any letter are not counted.

Learning may use a bounded sample: about ``docs_per_language`` labelled texts of each language,
chosen by a hash of the row (all of them while there are fewer). The counting runs in Spark; the
driver gets one row for each language and for each used slot, at most ``SLOTS``, whatever the input's
size: that is the model.

``accepted`` keeps texts whose score is ``LEAST_SHARE`` or more, and texts with a letter that are too
short to judge (fewer than ``FEW`` n-grams).

Defined results: null text or no letter: ``und``, score 0. A text with letters but no known
n-gram: the language with most training rows, score 0. No labelled row: ``und`` for all. Null
languages are never learned. Equal shares: the first language by code point. Repeated rows are
scored alike. Other columns are neither read nor kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linfold.llm.texts import batch_of, byte_values, free_name, mix, pieces, signed, windows_hash

GRAM = 4
SLOTS = 1 << 20
HASHES = 3
UNKNOWN = "und"
#: A kept text has at least this share of its n-grams (corrected) in one language ...
LEAST_SHARE = 0.3
#: ... or fewer n-grams than this, which say too little either way.
FEW = 24

#: ASCII that is no letter counts as a space; bytes over 127 belong to letters.
_LETTERS = np.arange(256, dtype=np.uint8)
_LETTERS[[c for c in range(128) if not chr(c).isalpha()]] = 32


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    fallback: str | None
    filter: np.ndarray   # slots x planes, one bit for each language
    false_positive: np.ndarray


def _grams(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams inside texts that hold a letter, and the first of each text."""
    plain = _LETTERS[raw]
    hashes = windows_hash(byte_values(plain), GRAM)
    if not len(hashes):
        return hashes, np.zeros(len(offsets), dtype=np.int64)
    letters = np.concatenate(([0], np.cumsum(plain != 32)))
    use = letters[GRAM:] > letters[:-GRAM]
    for back in range(1, GRAM):  # windows that begin before a text's start and end after it
        cut = offsets[1:-1] - back
        use[cut[(cut >= 0) & (cut < len(use))]] = False
    before = np.concatenate(([0], np.cumsum(use)))
    return hashes[use], before[np.minimum(offsets, len(use))]


def _slots(hashes: np.ndarray) -> list[np.ndarray]:
    second = mix(hashes + np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    return [((hashes + np.uint64(i) * second) % np.uint64(SLOTS)).astype(np.int64) for i in range(HASHES)]


def _spaced(text: Column) -> Column:
    """Lower case, with a space at both ends, so that a short word still has n-grams."""
    return F.concat(F.lit("  "), F.lower(text), F.lit("  "))


_SEEN = pa.schema([("lang", pa.int32()), ("gram", pa.int64())])


def _seen(batches):
    for part, raw, offsets in pieces(batches, max_bytes=1 << 22):
        hashes, first = _grams(raw, offsets)
        codes = part.column(part.schema.get_field_index("_code")).to_numpy(zero_copy_only=False)
        owner = np.repeat(codes, np.diff(first))
        for code in np.unique(codes):
            values = np.unique(hashes[owner == code])
            yield batch_of(_SEEN, np.full(len(values), code, dtype=np.int32), signed(values))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", order: str = "doc_id",
        docs_per_language: int = 1500) -> LanguageModel:
    """Learn from every row with a language (see the module for the bound on the sample)."""
    rows = docs.select(F.col(text).cast("string").alias("_text"), F.col(lang).cast("string").alias("_lang"),
                       F.col(order).cast("string").alias("_order")).where("_text IS NOT NULL AND _lang IS NOT NULL")
    counts = {r["_lang"]: r["n"] for r in rows.groupBy("_lang").agg(F.count("*").alias("n")).collect()}
    languages = tuple(sorted(counts))
    planes = max(1, -(-len(languages) // 63))
    filled = np.zeros((SLOTS, planes), dtype=np.int64)
    if not languages:
        return LanguageModel((), None, filled, np.zeros(0))
    # One row for each language, as in the model itself: its number and the share of its rows that is read.
    part = docs.sparkSession.createDataFrame(
        [(x, i, min(1_000_000, -(-1_000_000 * docs_per_language // counts[x]))) for i, x in enumerate(languages)],
        "_lang string, _code int, _part int")
    draw = F.pmod(F.xxhash64("_order", F.lit("langid")), F.lit(1_000_000))
    chosen = rows.join(F.broadcast(part), "_lang").where(draw < F.col("_part")) \
        .select(_spaced(F.col("_text")).alias("_text"), "_code")
    slots = chosen.mapInArrow(_seen, "lang int, gram long").distinct().mapInArrow(
        _place, "slot int, plane int, bit long").groupBy("slot", "plane").agg(F.bit_or("bit").alias("bits"))
    for r in slots.collect():  # at most SLOTS rows for each 63 languages
        filled[r["slot"], r["plane"]] = r["bits"]
    rate = np.array([((filled[:, i // 63] >> (i % 63)) & 1).mean() for i in range(len(languages))]) ** HASHES
    most = min(languages, key=lambda x: (-counts[x], x))
    return LanguageModel(languages, most, filled, rate)


_PLACED = pa.schema([("slot", pa.int32()), ("plane", pa.int32()), ("bit", pa.int64())])


def _place(batches):
    for b in batches:
        lang = b.column(0).to_numpy().astype(np.int64)
        for slot in _slots(b.column(1).to_numpy().view(np.uint64)):
            yield batch_of(_PLACED, slot.astype(np.int32), (lang // 63).astype(np.int32), np.int64(1) << (lang % 63))


def _judge(part: pa.RecordBatch, raw: np.ndarray, offsets: np.ndarray, model: LanguageModel, table: np.ndarray,
           letter: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Language (its number; one past the last: none), score and number of n-grams of each row of a piece."""
    has_letter = part.column(part.schema.get_field_index(letter)).to_numpy(zero_copy_only=False)
    rows, size = len(has_letter), len(model.languages)
    if not size:
        return np.zeros(rows, dtype=np.int64), np.zeros(rows), np.zeros(rows, dtype=np.int64)
    hashes, first = _grams(raw, offsets)
    n = np.diff(first)
    masks = None
    for slot in _slots(hashes):
        got = table[slot]
        masks = got if masks is None else masks & got
    shares = np.zeros((rows, size))
    for i in range(size):
        total = np.concatenate(([0], np.cumsum((masks[:, i // 63] >> (i % 63)) & 1, dtype=np.int64)))
        hits = total[first[1:]] - total[first[:-1]]
        rate = model.false_positive[i]
        shares[:, i] = np.clip((hits / np.maximum(n, 1) - rate) / max(1 - rate, 1e-9), 0, 1)
    score = shares.max(axis=1)
    best = np.where(score > 0, shares.argmax(axis=1), model.languages.index(model.fallback))
    return np.where(has_letter, best, size), np.where(has_letter, score, 0.0), np.where(has_letter, n, 0)


def _table(model: LanguageModel) -> np.ndarray:
    """A filter of few languages in one byte for each slot stays in the CPU's cache."""
    return model.filter.astype(np.uint8) if model.filter.shape[1] == 1 and len(model.languages) <= 7 else model.filter


_PREDICTED = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])


def _predict(shared):
    def run(batches):
        model = shared.value
        table, names = _table(model), [*model.languages, UNKNOWN]
        for part, raw, offsets in pieces(batches):
            best, score, _ = _judge(part, raw, offsets, model, table, "_letter")
            yield batch_of(_PREDICTED, part.column(part.schema.get_field_index("doc_id")),
                           [names[i] for i in best], score)
    return run


def predict(docs: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row, over whole texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # SLOTS x planes x 8 bytes
    body = F.col(text).cast("string")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), _spaced(body).alias("_text"),
                       F.coalesce(body.rlike(r"\p{L}"), F.lit(False)).alias("_letter"))
    return rows.mapInArrow(_predict(shared), "doc_id long, lang_pred string, score double")


def accepted(docs: DataFrame, model: LanguageModel, text: str = "text", least: float = LEAST_SHARE,
             few: int = FEW) -> DataFrame:
    """The rows of ``docs`` in a learned language, or with too few letters to tell (see the module). No shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    body, letter = free_name(docs, "_text"), free_name(docs, "_letter")
    plain = F.col(text).cast("string")
    rows = docs.withColumns({body: _spaced(plain), letter: F.coalesce(plain.rlike(r"\p{L}"), F.lit(False))})
    names = docs.columns

    def run(batches):
        table = _table(shared.value)
        for part, raw, offsets in pieces(batches, body):
            has = part.column(part.schema.get_field_index(letter)).to_numpy(zero_copy_only=False)
            _, score, n = _judge(part, raw, offsets, shared.value, table, letter)
            yield part.select(names).filter(pa.array(has & ((score >= least) | (n < few))))
    return rows.mapInArrow(run, docs.schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text leaves 1 when divided by 3 (false for a null id)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))
