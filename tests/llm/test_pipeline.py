"""The corpus pipeline against brute force, stage by stage."""

from collections import Counter

import corpus_pipeline
from helpers import cut_units, frame, near_components, odd_documents, vocabulary, words
from pyspark.sql import functions as F

from linfold.llm import mixing, substring
from linfold.llm.texts import settled
from linfold.session import fresh_name, shared_dir


def test_stages(spark):
    leak = vocabulary(70, 40, 5000)
    passage = vocabulary(71, 55, 5000)
    rows = odd_documents() + [
        (400, vocabulary(72, 90) + " " + leak, "en", "a"), (401, "?? 123 --", "en", "a"),
        (402, vocabulary(73, 70) + " " + passage + " " + vocabulary(74, 70), "de", "b"),
        (403, vocabulary(75, 70) + " " + passage + " " + vocabulary(76, 70), "de", "b")]
    # each language has letters of its own, so texts are not alike for the wrong reason
    sf = shared_dir(spark, "pipeline", fresh_name("sf"))
    frame(spark, rows).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(0, leak), (1, vocabulary(77, 30, 5000))], "item_id long, text string") \
        .write.parquet(f"{sf}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = settled(stage(spark, docs, sf), name)
        assert docs.columns == columns, name
        kept[name] = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in docs.collect()]
    started = Counter((i, t) for i, t, *_ in rows)
    letters = Counter({k: n for k, n in started.items() if k[1] and any(c.isalpha() for c in k[1])})
    assert Counter((r[0], r[1]) for r in kept["language"]) == letters
    comp = near_components([(i, t) for (i, t) in letters if i is not None])
    left = [r[0] for r in kept["near_duplicates"]]
    assert sorted(i for i in left if i is not None) == sorted({c for _, c in comp.values()})
    before = kept["near_duplicates"]
    gone = cut_units([words(t) for _, t, *_ in before], substring.WINDOW)
    want = {(i, b" ".join(x for x, y in zip(words(t), g) if not y).decode() if any(g) else t)
            for (i, t, *_), g in zip(before, gone)}
    assert {(r[0], r[1]) for r in kept["passages"]} == want
    assert all(r[4] == len(r[1]) for r in kept["passages"])
    assert not any(passage in r[1] for r in kept["passages"]) and any(passage in r[1] for r in before)
    assert {r[0] for r in kept["passages"]} - {r[0] for r in kept["decontamination"]} == {400}
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert mixed.columns == [*columns, "copy_"]
    copies = {r["doc_id"]: r["n"] for r in mixing.mix(docs).groupBy("doc_id").agg(F.sum("copies").alias("n")).collect()}
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter({i: n for i, n in copies.items() if n})


def test_run_writes_every_stage(spark):
    sf = shared_dir(spark, "pipeline", fresh_name("sf"))
    frame(spark, [(i, vocabulary(500 + i, 30 + i), "en", "ab"[i % 2]) for i in range(30)], extra=()) \
        .write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "copy"]
    first = sorted(map(tuple, out.collect()))
    assert first and first == sorted(map(tuple, corpus_pipeline.run(spark, sf).collect()))
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language", "near_duplicates", "passages", "decontamination", "mixing"]
    assert corpus_pipeline.ORACLE_SQL is None
