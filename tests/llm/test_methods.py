"""Language filters, quality features and mixing offsets against plain loops; language decisions; hot repeated rows."""

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from helpers import frame, vocabulary, words
from pyspark.sql import functions as F

from linfold.llm import langid, mixing, quality
from linfold.llm.texts import on_workers, pieces, read_table

SF = "/root/testdata/sf0.01"


# --- language --------------------------------------------------------------------------------------

def plain_grams(text: str) -> list[bytes]:
    raw = f"  {text.lower()}  ".encode()
    raw = bytes(32 if b < 128 and not chr(b).isalpha() else b for b in raw)
    grams = [raw[i:i + langid.GRAM] for i in range(len(raw) - langid.GRAM + 1)]
    return [g for g in grams if g != b" " * langid.GRAM]


def test_filter_holds_every_language_of_an_ngram(spark):
    docs = read_table(spark, SF, "documents")
    model = langid.fit(docs.where(~langid.held_out()))
    rows = [(r["doc_id"], r["text"], r["lang"], r["h"]) for r in
            docs.select("doc_id", "text", "lang", langid.held_out().alias("h")).collect()]
    seen = defaultdict(set)
    for _, text, lang, h in rows:
        if text is not None and lang is not None and not h:
            seen[lang].update(plain_grams(text))
    assert tuple(sorted(seen)) == model.languages
    got = {r["doc_id"]: r for r in langid.predict(docs, model).collect()}
    for i, text, _, _ in rows:
        if text is None or not any(c.isalpha() for c in text):
            assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0)
            continue
        grams = plain_grams(text)
        share = {x: sum(g in seen[x] for g in grams) / len(grams) for x in model.languages}
        assert abs(got[i]["score"] - max(share.values())) < 0.01
        assert share[got[i]["lang_pred"]] > max(share.values()) - 0.01


def test_grams_end_with_their_text(spark):
    texts = ["abc", "", "x1y", "--", "abcdefgh", "é ü", "z"]
    padded = [f"  {t}  " for t in texts] + ["", "ab"]  # the last two are shorter than an n-gram
    batch = pa.record_batch([pa.array(padded)], names=["_text"])
    (_, raw, offsets), = pieces([batch])
    hashes, first = langid._grams(raw, offsets)
    assert np.diff(first).tolist() == [len(plain_grams(t)) for t in texts] + [0, 0]
    alone = {}
    for t, a, z in zip(texts, first, first[1:]):
        for g, h in zip(plain_grams(t), hashes[a:z]):
            assert alone.setdefault(g, h) == h
    assert len(set(alone.values())) == len(alone)


def test_language_stage_drops_what_no_language_explains(spark):
    learn = read_table(spark, SF, "documents")
    model = langid.fit(learn)
    russian = "Это довольно длинный текст на языке, которого нет в обучающей выборке. " * 30
    rows = [(1, russian, None, "a"), (2, russian + " the and", None, "a"), (3, "Xylophon", "de", "a"), (4, "?? 12", "de", "a"),
            (5, None, "de", "a"), (6, "The and. " * 20, "en", "a"), (7, "The and. " * 200000, "en", "a"), (None, "Und", "de", "a")]
    left = langid.accepted(frame(spark, rows), model)
    assert sorted(str(r["doc_id"]) for r in left.collect()) == ["3", "6", "7", "None"]
    assert langid.accepted(learn, model).count() == learn.where(F.col("text").rlike(r"\p{L}")).count()


# --- quality ---------------------------------------------------------------------------------------

def plain_features(text: str) -> Counter:
    found, last = Counter(), None
    for w in words(text):
        low = w.lower()  # bytes: only A-Z
        found["word", low] += 1
        marked = "\x20" + low.decode() + "\n"
        for size in quality.SIZES:
            for k in range(len(marked) - size + 1):
                found["gram", marked[k:k + size]] += 1
        found["again"] += low == last
        last = low
    return found


def test_quality_features_are_words_and_character_ngrams():
    texts = ["The the cat", "", "ÉTÉ été naïve 日本語のテキスト", " \n", "a a a ÿ", vocabulary(3, 200), "x" * 50]
    batch = pa.record_batch([pa.array(texts)], names=["_text"])
    (_, raw, offsets), = pieces([batch])
    row, bucket = quality._features(raw, offsets)
    names = {}
    for i, text in enumerate(texts):
        want = plain_features(text)
        got = Counter(bucket[row == i].tolist())
        assert got[quality.REPEAT] == want.pop("again", 0)
        got.pop(quality.REPEAT, None)
        assert sum(got.values()) == sum(want.values())
        if len(want) < 60:  # few features: hardly any shares its bucket
            assert sorted(got.values()) == sorted(want.values())
        names[text] = set(got)
    assert names["The the cat"] & names["a a a ÿ"] == set()


def test_training_follows_the_gradient():
    draw = np.random.default_rng(3)
    buckets = [np.sort(draw.choice(200, 12, replace=False)) for _ in range(10)]
    parts = [p / p.sum() for p in draw.integers(1, 5, (10, 12)).astype(float)]
    labels = np.array([0, 1] * 5)
    got = quality.train(buckets, parts, labels, epochs=2, rate=0.7)
    rng = np.random.default_rng(7)
    d = quality.DIMENSION
    v = rng.uniform(-1 / d, 1 / d, (quality.BUCKETS + 1, d))
    out, bias, step = [[0.0] * d for _ in range(2)], [0.0, 0.0], 0
    for _ in range(2):
        for i in rng.permutation(10):
            now = 0.7 * (1 - step / 20)
            step += 1
            mean = [sum(p * v[b][k] for b, p in zip(buckets[i], parts[i])) for k in range(d)]
            z = [sum(o * m for o, m in zip(out[c], mean)) + bias[c] for c in range(2)]
            e = [math.exp(x) for x in z]
            error = [e[c] / sum(e) - (labels[i] == c) for c in range(2)]
            back = [sum(error[c] * out[c][k] for c in range(2)) for k in range(d)]
            for c in range(2):
                out[c] = [o - now * error[c] * m for o, m in zip(out[c], mean)]
                bias[c] -= now * error[c]
            for b, p in zip(buckets[i], parts[i]):  # the share of a feature in the mean is its share of the gradient
                v[b] -= [now * p * x for x in back]
    assert np.allclose(got.weight, v @ (np.array(out[1]) - np.array(out[0]))) and np.isclose(got.bias, bias[1] - bias[0])


def test_quality_of_long_texts_and_clashing_columns(spark):
    rows = [(i, vocabulary(i, 30 + i), "en", "a") for i in range(40)] + [(40, vocabulary(50, 300000), "en", "a")]
    df = frame(spark, rows)
    labels = spark.createDataFrame([(i, i % 2) for i in range(41)], "doc_id long, quality int")
    model = quality.fit(df, labels)
    got = {r["doc_id"]: r["score"] for r in quality.score(df, model).collect()}
    batch = pa.record_batch([pa.array([rows[40][1]])], names=["_text"])
    (_, raw, offsets), = pieces([batch], max_bytes=1 << 30)
    _, bucket = quality._features(raw, offsets)
    assert np.isclose(got[40], 1 / (1 + np.exp(-(model.weight[bucket].mean() + model.bias))))


# --- mixing ----------------------------------------------------------------------------------------

def test_offset_is_the_best_of_all_places(spark):
    on_workers(spark)
    rows = [(i, "w " * (3 + i * i % 41 + (4000 if i % 97 == 5 else 0)), "en", f"s{i % 7}") for i in range(400)]
    df = frame(spark, rows)
    got = mixing.mix(df).collect()
    phase = {r["key"]: r["phase"] for r in mixing.targets(df.select("source", mixing.size_of("text").alias("size"))).collect()}
    for source in {r[3] for r in rows}:
        mine = sorted((len(words(t)), i) for i, t, _, s in rows if s == source)
        one = next(r for r in got if r["doc_id"] == mine[0][1])
        rate = one["target"] / one["source_size"]
        misses = []
        for b in range(mixing.OFFSETS):
            o = (b + phase["s" + source]) / mixing.OFFSETS
            misses.append(abs(sum(n * (math.floor(o + (k + 1) * rate) - math.floor(o + k * rate))
                                  for k, (n, _) in enumerate(mine)) - one["target"]))
        ids = {i for _, i in mine}
        taken = sum(r["taken"] for r in got if r["doc_id"] in ids)
        assert abs(abs(taken - one["target"]) - min(misses)) < 1e-6
        assert abs(taken - one["target"]) <= max(0.02 * one["target"], mine[-1][0] / 2)  # whole documents only


def test_repeated_rows_are_emitted_as_often_as_they_are_taken(spark):
    rows = [(None, "", None, None)] * 300 + [(5, "one two three", "en", "a")] * 90 + [(6, "a b", "en", "b")] * 7 + [
        (i, vocabulary(i, 20 + i), "en", "ab"[i % 2]) for i in range(10, 60)]
    df = frame(spark, rows).repartition(6)
    mixed = mixing.mix(df)
    out = mixing.emitted(df, mixed)
    assert out.columns == [*df.columns, "copy_"]
    copies = defaultdict(list)
    for r in mixed.collect():
        copies[r["doc_id"]].append(r["copies"])
    got = out.groupBy("doc_id", "copy_").count().collect()
    want = Counter((i, c) for i, times in copies.items() for n in times for c in range(n))
    assert {(r["doc_id"], r["copy_"]): r["count"] for r in got} == dict(want)
    assert mixing.emitted(frame(spark, []), mixing.mix(frame(spark, []))).count() == 0
