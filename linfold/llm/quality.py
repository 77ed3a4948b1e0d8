"""Quality classifier: supervised subword embeddings, averaged per document, with a softmax output.

A document's features are its words and the character n-grams of its words: ``SIZES`` code points of
the word between two boundary marks, A-Z in lower case. Each is hashed to one of ``BUCKETS`` learned
vectors. One feature is not part of the method: a word equal to the one before it has a vector of its
own, whatever the word, because an average has no order and misses texts that say one ordinary word
again and again (the README has the figures without it). The features' average goes through a softmax layer, and both are trained together by stochastic
gradient descent in numpy. As the output is linear in the average, scoring needs just one number for
each bucket (its vector times the difference of the two output rows), so a text is scored with one
table lookup for each feature, over its whole length.

Fitting uses a bounded sample: about ``max_docs`` labelled rows, chosen by a hash of the id (all
of them while there are fewer). The sample's ids are broadcast (bounded), so texts are not
shuffled; the sampled texts are hashed where they lie, and a single task trains on their feature
counts (at most ``BUCKETS`` for each text, however long) and returns the model (``BUCKETS`` numbers).

Defined results: null or empty texts score as the average features of nothing, i.e. the output's
bias alone. Null labels are not used; several labels of an id count as the lowest. Without usable
labels every score is 0.5; with one class only, the score is near that class. Repeated rows score
alike. Very long texts are worked on whole, one at a time. Only id and text are read, so other
columns may have any name. Labels, language, source and id are never inputs of a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linfold.llm.texts import Words, batch_of, mix, pieces, windows_hash

SIZES = (3, 4, 5)
BUCKETS = 1 << 17
#: The bucket of a word that repeats the one before it.
REPEAT = BUCKETS
DIMENSION = 12
MAX_DOCS = 4000
EPOCHS = 8
RATE = 2.0
#: Code points that no word has: before its first and after its last character.
_BEGIN, _END = 0x20, 0x0A


@dataclass(frozen=True)
class QualityModel:
    weight: np.ndarray  # of each bucket, for label 1
    bias: float


def _characters(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, each between its two marks, and the word that each belongs to."""
    raw = words.raw
    points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    number = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))  # code points before each byte
    starts, ends = number[words.starts], number[words.ends]
    sizes = ends - starts + 2
    begin = np.concatenate(([0], np.cumsum(sizes)))
    owner = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(begin[-1]) - begin[owner] + starts[owner] - 1
    out = points[np.clip(place, 0, max(len(points) - 1, 0))]
    out = np.where((out >= 65) & (out <= 90), out + 32, out)
    out[begin[:-1]], out[begin[1:] - 1] = _BEGIN, _END
    return out, owner


def _features(raw: np.ndarray, offsets: np.ndarray):
    """(row, bucket) of every word, character n-gram inside a marked word, and word that repeats its predecessor."""
    words = Words(raw, offsets)
    rows, hashes = [words.row], [words.hashes(lower=True)]
    again = np.flatnonzero((hashes[0][1:] == hashes[0][:-1]) & (words.row[1:] == words.row[:-1])) + 1
    if len(words):
        points, owner = _characters(words)
        values = mix(points.astype(np.uint64) + np.uint64(1))
        for size in SIZES:
            inside = owner[:-(size - 1)] == owner[size - 1:]
            hashes.append(mix(windows_hash(values, size)[inside] + np.uint64(size)))
            rows.append(words.row[owner[:len(inside)][inside]])
    buckets = (np.concatenate(hashes) % np.uint64(BUCKETS)).astype(np.int64)
    return np.concatenate((*rows, words.row[again])), np.concatenate((buckets, np.full(len(again), REPEAT)))


_COUNTED = pa.schema([("label", pa.int32()), ("key", pa.int64()), ("bucket", pa.list_(pa.int32())),
                      ("part", pa.list_(pa.float32()))])


def _vectorise(batches):
    for piece, raw, offsets in pieces(batches):
        row, bucket = _features(raw, offsets)
        both, counts = np.unique(row * (BUCKETS + 1) + bucket, return_counts=True)
        owner = both // (BUCKETS + 1)
        cut = np.searchsorted(owner, np.arange(len(offsets)))
        totals = np.maximum(np.bincount(row, minlength=len(offsets) - 1), 1)
        yield batch_of(_COUNTED, piece.column(piece.schema.get_field_index("_label")),
                       piece.column(piece.schema.get_field_index("_key")),
                       [both[a:b] % (BUCKETS + 1) for a, b in zip(cut, cut[1:])],
                       [(counts[a:b] / t).astype(np.float32) for a, b, t in zip(cut, cut[1:], totals)])


def train(buckets: list[np.ndarray], parts: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS,
          rate: float = RATE, seed: int = 7) -> QualityModel:
    """SGD over one document at a time; the rate falls linearly. ``parts`` are the features' shares of a document."""
    draw = np.random.default_rng(seed)
    vectors = draw.uniform(-1 / DIMENSION, 1 / DIMENSION, (BUCKETS + 1, DIMENSION))
    output, bias = np.zeros((2, DIMENSION)), np.zeros(2)
    steps, done = epochs * len(labels), 0
    for _ in range(epochs):
        for i in draw.permutation(len(labels)):
            now = rate * (1 - done / steps)
            done += 1
            hidden = parts[i] @ vectors[buckets[i]]
            logits = output @ hidden + bias
            prob = np.exp(logits - logits.max())
            error = prob / prob.sum()
            error[labels[i]] -= 1
            back = error @ output
            output -= now * np.outer(error, hidden)
            bias -= now * error
            vectors[buckets[i]] -= now * np.outer(parts[i], back)
    return QualityModel(vectors @ (output[1] - output[0]), float(bias[1] - bias[0]))


def _train_group(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("key", kind="stable")  # the same order wherever the rows came from
    model = train([np.asarray(x, dtype=np.int64) for x in pdf["bucket"]],
                  [np.asarray(x, dtype=np.float64) for x in pdf["part"]], pdf["label"].to_numpy())
    return pd.DataFrame({"weight": [model.weight.astype(np.float64).tobytes()], "bias": [model.bias]})


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
        max_docs: int = MAX_DOCS) -> QualityModel:
    """Learn ``label`` (0 or 1) of ``labels`` from the texts of ``docs``; give only rows that may be learned from."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()) \
        .groupBy(F.col(doc_id).alias("_id")).agg(F.min(F.col(label)).cast("int").alias("_label"))
    n = known.count()
    part = min(1_000_000, -(-1_000_000 * max_docs // max(n, 1)))
    sample = known.where(F.pmod(F.xxhash64("_id", F.lit("quality")), F.lit(1_000_000)) < part)
    rows = docs.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text")) \
        .join(F.broadcast(sample), "_id")  # about max_docs small rows, whatever the input
    made = rows.select("_label", F.xxhash64("_id", "_text").alias("_key"), "_text") \
        .mapInArrow(_vectorise, "label int, key long, bucket array<int>, part array<float>")
    got = made.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(_train_group, "weight binary, bias double").collect()
    if not got:
        return QualityModel(np.zeros(BUCKETS + 1), 0.0)
    return QualityModel(np.frombuffer(got[0]["weight"], dtype=np.float64), got[0]["bias"])


_SCORED = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())])


def _score(shared):
    def run(batches):
        model = shared.value
        for piece, raw, offsets in pieces(batches):
            row, bucket = _features(raw, offsets)
            rows = len(offsets) - 1
            mean = np.bincount(row, weights=model.weight[bucket], minlength=rows) / np.maximum(
                np.bincount(row, minlength=rows), 1)
            score = 1 / (1 + np.exp(-np.clip(mean + model.bias, -500, 500)))
            yield batch_of(_SCORED, piece.column(piece.schema.get_field_index("doc_id")), score,
                           (score >= 0.5).astype(np.int32))
    return run


def score(docs: DataFrame, model: QualityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, predicted) of every row, over whole texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    return rows.mapInArrow(_score(shared), "doc_id long, score double, predicted int")
