"""Quality, mixing, rules, WARC packages, chat windows, language ID and tiling: odd cases and brute force."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import frame, odd_documents, sha, vocabulary, words
from pyspark.sql import functions as F

from linfold.llm import chat, langid, mixing, quality, rules, tiling, warczip
from linfold.llm.texts import on_workers, read_table, settled
from linfold.session import fresh_name, shared_dir

SF = "/root/testdata/sf0.01"


def held(i) -> bool:
    return zlib.crc32(str(i).encode()) % 3 == 1


# --- quality ---------------------------------------------------------------------------------------

def test_quality_ranks_held_out_documents(spark):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    model = quality.fit(docs, labels.where(~langid.held_out()))
    got = {r["doc_id"]: r for r in quality.score(docs, model).collect()}
    truth = {r["doc_id"]: r["quality"] for r in labels.collect() if held(r["doc_id"])}
    good = [got[i]["score"] for i, y in truth.items() if y == 1]
    bad = [got[i]["score"] for i, y in truth.items() if y == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    again = quality.fit(docs.repartition(7), labels.where(~langid.held_out()))
    assert np.allclose(model.weight, again.weight)


def test_quality_of_odd_documents(spark):
    df = frame(spark, odd_documents())
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.fit(df, none)
    assert {r["score"] for r in quality.score(df, model).collect()} == {0.5}
    labels = spark.createDataFrame([(1, 1), (1, None), (9, 0), (9, 1), (None, 0), (10, 0), (5, 1)], "doc_id long, quality int")
    rows = quality.score(df, quality.fit(df, labels)).collect()
    assert len(rows) == df.count() and all(0 <= r["score"] <= 1 for r in rows)
    same = defaultdict(set)
    for r in rows:
        same[r["doc_id"]].add(r["score"])
    assert len(same[3]) == 1 and same[4] == same[5]
    assert quality.score(frame(spark, []), model).count() == 0


# --- language --------------------------------------------------------------------------------------

def test_languages_of_held_out_documents(spark):
    docs = read_table(spark, SF, "documents")
    model = langid.fit(docs.where(~langid.held_out()))
    got = langid.predict(docs, model).withColumnRenamed("doc_id", "i").join(docs, F.col("i") == F.col("doc_id"))
    rows = [r for r in got.collect() if held(r["doc_id"])]
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_odd_documents(spark):
    df = frame(spark, odd_documents())
    model = langid.fit(df)
    rows = langid.predict(df, model).collect()
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (4, 5, 6))
    assert [r["lang_pred"] for r in rows if r["doc_id"] is None].count("und") == 1  # digits only
    assert all(r["lang_pred"] in (*model.languages, "und") for r in rows)
    left = langid.accepted(df, model)
    assert left.columns == df.columns
    assert {4, 5, 6}.isdisjoint({r["doc_id"] for r in left.collect()}) and left.count() == len(rows) - 4
    nothing = langid.fit(df.where("lang = 'none'"))
    assert {r["lang_pred"] for r in langid.predict(df, nothing).collect()} == {"und"}
    assert langid.predict(frame(spark, []), model).count() == 0


def test_more_languages_than_a_mask_has_bits(spark):
    rows = [(i, " ".join(f"{chr(97 + i // 10)}{chr(97 + i % 10)}{w}x" for w in ("ba", "ce", "di", "fo")), f"l{i:02}", "a")
            for i in range(70) for _ in range(2)]
    df = frame(spark, rows, extra=())
    model = langid.fit(df)
    assert model.filter.shape[1] == 2
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(df, model).collect()}
    assert got == {i: f"l{i:02}" for i in range(70)}


# --- mixing ----------------------------------------------------------------------------------------

def brute_targets(sizes: dict) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    total, target, open_ = sum(sizes.values()), {}, set(order)
    while open_:
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            target.update(share)
            break
        target.update({s: 3 * sizes[s] for s in over})
        open_ -= over
    return target


@pytest.mark.parametrize("which", ["odd", "skewed", "empty"])
def test_mixing_targets_and_copies(spark, which):
    rows = {"odd": odd_documents(), "empty": [],
            "skewed": [(i, "w " * (1 + i % 40), "en", "hot" if i % 3 else ("tiny" if i < 9 else f"s{i % 4}"))
                       for i in range(900)]}[which]
    df = frame(spark, rows)
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    if not rows:
        return
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    target = brute_targets(sizes)
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r[0]].append(r[3])
    taken = Counter()
    for r in got:
        source = by_doc[r["doc_id"]][0]
        assert r["source_size"] == sizes[source] and r["target"] == pytest.approx(target[source], rel=1e-9)
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        taken[source] += r["taken"]
    if which == "skewed":
        assert all(abs(taken[s] - target[s]) <= max(0.02 * target[s], 40) for s in sizes)
    again = {(r["doc_id"], r["size"], r["copies"]) for r in mixing.mix(df.repartition(9)).collect()}
    assert again == {(r["doc_id"], r["size"], r["copies"]) for r in got}
    out = mixing.emitted(df, mixing.mix(df))
    assert out.columns == [*df.columns, "copy_"]
    assert Counter(r["doc_id"] for r in out.collect()) == Counter(
        {i: n for i, n in ((i, sum(r["copies"] for r in got if r["doc_id"] == i)) for i in by_doc) if n})


# --- rules -----------------------------------------------------------------------------------------

def test_rules_measure_exactly(spark):
    rows = odd_documents() + [(200, "a b c a b c a b c d", "en", "a"), (201, "x y\nx y\n\n \nz & x y\nx y", "en", "a"),
                              (202, "t " * 5000, "en", "a"), (203, "### $$ <b> a|b 100% of the and to", "en", "a")]
    got = rules.judge(frame(spark, rows)).collect()
    want = []
    for i, t, *_ in rows:
        t = t or ""
        w = [x.decode() for x in words(t)]
        tri = list(zip(w, w[1:], w[2:]))
        seen, covered = Counter(tri), set()
        for k, x in enumerate(tri):
            if seen[x] > 1:
                covered |= {k, k + 1, k + 2}
        lines = [x for x in t.split("\n") if words(x)]
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        want.append((str(i), len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)),
                     len(covered), failed))
    assert sorted((str(r["doc_id"]), r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"],
                   r["base_failed"]) for r in got) == sorted(want)
    assert not any(r["kept"] and r["base_failed"] for r in got)
    assert rules.judge(frame(spark, [])).count() == 0


def test_rules_keep_clean_documents(spark):
    got = rules.judge(read_table(spark, SF, "documents").select("doc_id", "text")).join(read_table(spark, SF, "labels"), "doc_id")
    rows = [r for r in got.collect() if not r["base_failed"]]
    assert np.mean([r["kept"] for r in rows if r["quality"] == 1]) > 0.99
    assert np.mean([r["kept"] for r in rows if r["quality"] == 0]) < 0.6


# --- WARC ------------------------------------------------------------------------------------------

PAGES = [(1, "http://a/", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "http://b/ c\r\nX: y", ""), (4, "u", None),
         (5, "é", "ü" * 5000), (None, "n", "<p>one</p>"), (None, "n", "alone"), (7, "r", "twice"), (7, "r", "twice")]


@pytest.mark.parametrize("least,package", [(0, 1 << 24), (5, 100)])
def test_warc_round_trip(spark, least, package):
    on_workers(spark)
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    packages = warczip.write(pages, shared_dir(spark, "warc", fresh_name("t")), min_bytes=least, package_bytes=package)
    got = warczip.read(spark, packages, split_bytes=64).withColumns(
        {"id": warczip.page_of("record_id"), "to": warczip.page_of("refers_to")}).collect()
    first = {}
    for i, _, h in PAGES:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = []
    for i, _, h in PAGES:
        p = (h or "").encode()
        to = first.get(h or "") if len(p) >= least else None
        to = None if to == i else to
        want.append((str(i), len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if to else "response",
                     str(to), None if to else p))
    assert sorted(map(str, want)) == sorted(str((str(r["id"]), r["payload_bytes"], r["payload_digest"], r["record_type"],
                                                 str(r["to"]), None if r["payload"] is None else bytes(r["payload"])))
                                            for r in got)
    assert warczip.read(spark, warczip.write(pages.limit(0), shared_dir(spark, "warc", fresh_name("t")))).count() == 0


@pytest.mark.parametrize("zip64", [True, False])
def test_zip_directories(zip64):
    import io
    import zipfile

    parts = [("a.txt", b"hello"), ("dir/ü.bin", bytes(range(256)) * 10), ("empty", b"")]
    data = warczip.zip_bytes(parts, zip64)
    with zipfile.ZipFile(io.BytesIO(data)) as z:  # another reader agrees
        assert z.testzip() is None and [(n, z.read(n)) for n in z.namelist()] == parts

    class File:
        def read_at(self, n, at):
            return data[at:at + n]
    found = warczip.members(File(), len(data))
    assert {n: data[at:at + size] for n, (method, at, size) in found.items() if method == 0} == dict(parts)
    with pytest.raises(ValueError):
        warczip.members(File(), 10)


# --- chat ------------------------------------------------------------------------------------------

def test_chat_windows_read_back(spark):
    draw = random.Random(3)
    turns = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok"),
             (None, 0, None, None), (None, None, "assistant", ""), (5, 1, "assistant", "b"), (5, 1, "assistant", "a"),
             (5, 0, "system", "sys \\h <x> ##"), (5, 1, "assistant", "b"), (6, 0, "assistant", "only " * 3000),
             (8, 0, "we: ird#", "\\c\\l\\\\h")]
    turns += [(9, t, ("system", "user", "assistant")[0 if t == 0 else 1 + t % 2], vocabulary(t, draw.randrange(1, 200)))
              for t in range(80)]
    on_workers(spark)
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("window", F.lit("x"))
    wide = chat.windows(df)
    got = {r["conv_id"]: r for r in chat.digests(chat.read_back(wide)).collect()}
    by = defaultdict(list)
    for c, t, role, text in turns:
        by[c].append((t is not None, t or 0, role or "", text or ""))
    for c, rows in by.items():
        rows = [(r, x) for *_, r, x in sorted(rows)]
        loss = "".join(x for r, x in rows if r == "assistant")
        assert (got[c]["n_turns"], got[c]["turns_sha256"], got[c]["loss_chars"], got[c]["loss_sha256"]) == (
            len(rows), sha("".join(f"{r}\n{x}\n" for r, x in rows).encode()), len(loss), sha(loss.encode())), c
    long = wide.where("conv_id = 9").orderBy("window").collect()
    assert len(long) > 3 and all(r["formatted"].startswith("### system: ") for r in long)
    assert all(r["context_turns"] >= 2 for r in long[1:])
    for r in long:
        assert len(words(r["formatted"])) <= chat.BUDGET + 4 * 200
        spans = [(x["start"], x["start"] + x["length"]) for x in r["loss"]]
        assert all(a <= b <= c for (_, a), (b, c) in zip(spans, spans[1:]))
    assert chat.digests(chat.read_back(chat.windows(df.limit(0)))).count() == 0


# --- tiling ----------------------------------------------------------------------------------------

def brute_tiles(doc: list, item: list, least: int) -> int:
    """Greedy string tiling by comparing everything with everything."""
    a, b, covered = [False] * len(doc), [False] * len(item), 0
    while True:
        best = (least - 1, 0, 0)
        for d in range(len(doc)):
            for i in range(len(item)):
                n = 0
                while (d + n < len(doc) and i + n < len(item) and doc[d + n] == item[i + n]
                       and not a[d + n] and not b[i + n]):
                    n += 1
                if n > best[0]:
                    best = (n, d, i)
        n, d, i = best
        if n < least:
            return covered
        a[d:d + n] = b[i:i + n] = [True] * n
        covered += n


def test_tiles_match_brute_force():
    draw = random.Random(8)
    for case in range(60):
        item = [draw.randrange(5) for _ in range(draw.randrange(4, 25))]
        doc = [draw.randrange(5) for _ in range(draw.randrange(4, 40))]
        if case % 2:
            cut = len(item) // 2
            doc[5:5] = item[cut:] + [9] + item[:cut]
        for least in (2, 3):
            pairs = [(d, i) for d in range(len(doc) - least + 1) for i in range(len(item) - least + 1)
                     if doc[d:d + least] == item[i:i + least]]
            got = tiling.tile(np.array([p[0] for p in pairs], dtype=int), np.array([p[1] for p in pairs], dtype=int),
                              least, len(doc), len(item)) if pairs else 0
            assert got == brute_tiles(doc, item, least), (case, least)


@pytest.mark.parametrize("broadcast", [1 << 20, 0])
def test_reordered_leaks_are_caught(spark, broadcast):
    items = [(i, vocabulary(900 + i, 40, 5000)) for i in range(6)] + [(50, None), (51, "too short"), (None, "no id at all here")]
    a, b = items[0][1].split(), items[1][1].split()
    rows = odd_documents() + [
        (300, vocabulary(1, 50) + " " + items[2][1].upper().replace(" ", ", "), "en", "a"),
        (301, " ".join(a[20:] + ["x"] + a[10:20] + ["y"] + a[:10]) + " " + vocabulary(5, 30), "en", "a"),
        (302, " ".join(b[:12]) + " " + vocabulary(6, 200), "en", "a"), (303, (" ".join(b[:12]) + " z ") * 9, "en", "a"),
        (None, items[3][1], "en", "a"), (304, items[4][1] + " " + items[5][1], "en", "a")]
    df = frame(spark, rows)
    bench = spark.createDataFrame(items + items[:1], "item_id long, text string").withColumn("n", F.lit(1))
    found = settled(tiling.tiled(df, bench, broadcast_seeds=broadcast), "found")
    got = {r["doc_id"]: (r["item_id"], r["n_items"]) for r in found.collect() if r["contaminated"]}
    assert got == {300: (2, 1), 301: (0, 1), None: (3, 1), 304: (4, 2)}
    assert found.count() == len(rows)
    left = tiling.clean(df, found)
    assert left.columns == df.columns and left.count() == len(rows) - 4
    assert tiling.tiled(df, bench.limit(0), broadcast_seeds=broadcast).where("contaminated").count() == 0
    assert tiling.tiled(frame(spark, []), bench, broadcast_seeds=broadcast).count() == 0
