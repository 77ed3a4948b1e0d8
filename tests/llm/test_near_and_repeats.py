"""Near-duplicates and repeated passages against all pairs and all windows."""

import random

import numpy as np
import pytest
from helpers import cut_units, frame, near_components, odd_documents, sha, vocabulary, words

from linfold.llm import components, minhash, passages, substring, suffix
from linfold.llm.texts import Words, keyed, leftmost_minima, on_workers


def test_words_of_a_piece_do_not_cross_rows():
    raw = np.frombuffer(b"ab cdef\x0bg", dtype=np.uint8)
    w = Words(raw, np.array([0, 4, 4, len(raw)]))
    assert w.counts.tolist() == [2, 0, 2]
    assert [raw[a:b].tobytes() for a, b in zip(w.starts, w.ends)] == [b"ab", b"c", b"def", b"g"]


def test_leftmost_minima():
    draw = np.random.default_rng(0)
    x = draw.integers(0, 50, 500).astype(np.uint64) << np.uint64(40)
    for width in (1, 2, 7, 100, 500, 501):
        want = [i + int(np.argmin(x[i:i + width])) for i in range(max(0, len(x) - width + 1))]
        assert leftmost_minima(x, width).tolist() == want


def test_sketches_fill_and_estimate():
    draw = np.random.default_rng(1)
    pool = draw.integers(1, 2**63, 4000).astype(np.uint64)
    for n in (1, 2, 5, 30, 500):
        a, b = np.unique(pool[:n]), np.unique(pool[n // 4:n + n // 4])
        s = minhash.sketches(np.concatenate((np.zeros(len(a), int), np.ones(len(b), int))), np.concatenate((a, b)), 2)
        assert (s < minhash._FULL).all()
        truth = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        if n >= 30:
            assert abs((s[0] == s[1]).mean() - truth) < 0.2
    assert (minhash.sketches(np.zeros(0, int), np.zeros(0, np.uint64), 1) == minhash._FULL).all()


def test_components_of_chains_and_stars(spark):
    draw = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(9, 9)]
    edges += [(draw.randrange(1000, 1100), draw.randrange(1000, 1100)) for _ in range(60)]
    got = {r["node"]: r["component"] for r in components.components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    up = {x: x for e in edges for x in e}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in edges:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    assert all(got.get(x, x) == find(x) for x in up)


def test_near_duplicates_of_odd_documents(spark):
    rows = odd_documents()
    got = minhash.near_duplicates(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    want = near_components([r for r in rows if r[0] is not None])
    for r in got:
        if r["doc_id"] is not None:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]], r
            assert r["kept"] == (r["doc_id"] == r["component_id"])
    # The row without an id that copies document 1 is in its group; the one like no other is in none.
    missing = {(r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is None}
    assert missing == {(1, None), (want[1][0], 1)}


def test_links_that_no_hub_shows(spark):
    """A family whose members differ pairwise by growing edits: links run through chains, and two families share a bucket."""
    rows, base = [], vocabulary(11, 120, 5000).split()
    for i in range(40):
        rows.append((1000 - i, " ".join(base), "en", "a"))
        base = list(base)
        base[(i * 7) % 120] = f"edit{i}"
    other = base[:80] + vocabulary(12, 40, 5000).split()
    for i in range(20):
        rows.append((500 + i, " ".join(other), "en", "a"))
        other = list(other)
        other[(i * 11) % 120] = f"other{i}"
    want = near_components(rows)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(frame(spark, rows)).collect()}
    assert got == want


def test_survivors_keep_one_row_of_each_group(spark):
    rows = odd_documents()
    df = frame(spark, rows)
    left = minhash.survivors(df)
    assert left.columns == df.columns
    ids = [r["doc_id"] for r in left.select("doc_id").collect()]
    want = near_components([r for r in rows if r[0] is not None])
    assert sorted(i for i in ids if i is not None) == sorted({c for _, c in want.values()})
    assert [r["text"] for r in left.collect() if r["doc_id"] is None] == ["12345 678 !!"]  # the other copies document 1


def test_empty_tables(spark):
    empty = frame(spark, [])
    assert minhash.near_duplicates(empty).count() == 0
    assert substring.digests(empty).count() == 0
    assert suffix.digests(empty).count() == 0
    assert substring.cut(empty).columns == empty.columns


@pytest.mark.parametrize("window", [35, 6])
def test_passages_of_words(spark, window):
    rows = odd_documents()
    texts = [words(r[1]) for r in rows]
    gone = cut_units(texts, window)
    want = sorted((str(r[0]), len(t), sum(g), sha(b" ".join(x for x, y in zip(t, g) if not y)))
                  for r, t, g in zip(rows, texts, gone))
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"])
                 for r in substring.digests(frame(spark, rows), window=window).collect())
    assert got == want


def test_cut_carries_columns_and_leaves_clean_texts_alone(spark):
    rows = odd_documents()
    df = frame(spark, rows)
    left = substring.cut(df)
    assert left.columns == df.columns
    gone = cut_units([words(r[1]) for r in rows], substring.WINDOW)
    want = sorted((str(r[0]), str(r[1] if not any(g) else b" ".join(
        x for x, y in zip(words(r[1]), g) if not y).decode())) for r, g in zip(rows, gone))
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in left.collect()) == want


@pytest.mark.parametrize("window,token,hot,bucket", [(200, 64, 4096, 1 << 22), (30, 12, 2, 1 << 10)])
def test_passages_of_bytes(spark, window, token, hot, bucket, monkeypatch):
    rows = [r for r in odd_documents() if r[0] != 12] + [(90 + i, f"{vocabulary(50 + i, 30)} the same line of some length "
                                                          f"{vocabulary(60 + i, 30)}", "en", "a") for i in range(12)]
    runs = suffix.repeated_runs
    monkeypatch.setattr(suffix, "repeated_runs", lambda t, w: runs(t, w, token=token, hot=hot, bucket_bytes=bucket))
    texts = [(r[1] or "").encode() for r in rows]
    want = []
    for r, t, g in zip(rows, texts, cut_units(texts, window)):
        spans = sum(y and not (k and g[k - 1]) for k, y in enumerate(g))
        want.append((str(r[0]), len(t), sum(g), spans, sha(bytes(x for x, y in zip(t, g) if not y))))
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
                 for r in suffix.digests(frame(spark, rows), window=window).collect())
    assert got == sorted(want)


def test_no_byte_goes_without_the_sort(spark, monkeypatch):
    rows = [(i, vocabulary(40, 120), "en", "a") for i in range(6)]  # copies
    assert {r["n_removed"] for r in suffix.digests(frame(spark, rows)).collect()} == {len(rows[0][1])}
    monkeypatch.setattr(suffix, "_sorted", lambda window: lambda batches: (b for b in batches if False))
    assert {r["n_removed"] for r in suffix.digests(frame(spark, rows)).collect()} == {0}


def test_hot_copies_across_buckets(spark):
    """Suffixes of a hot token are dealt one by one; those whose copy is in another bucket are found at its edge."""
    rows = keyed(frame(spark, [(i, vocabulary(41, 40) + f" {i % 3}", "en", "a") for i in range(9)]), "doc_id", "text")

    def windows(**parameters):
        got = suffix.repeated_runs(rows, 30, 12, **parameters).collect()
        return {(r["_k2"], i) for r in got for a, z in zip(r["firsts"], r["lasts"]) for i in range(a, z + 1)}
    whole = windows()
    assert whole == windows(hot=1, bucket_bytes=1 << 10) and len({k for k, _ in whole}) == 9


def test_multikey_sort_finds_all_ties():
    draw = np.random.default_rng(3)
    text = draw.integers(97, 99, 3000).astype(np.uint8)
    starts = np.arange(0, 2900)
    for window in (5, 8, 13, 20):
        group = suffix.tied(text, starts, np.zeros(len(starts), dtype=int), window)
        keys = [text[s:s + window].tobytes() for s in starts]
        many = {k for k in keys if keys.count(k) > 1} if window > 8 else None
        for i, k in enumerate(keys):
            if many is not None:
                assert (group[i] >= 0) == (k in many)
        by = {}
        for k, g in zip(keys, group.tolist()):
            if g >= 0:
                assert by.setdefault(g, k) == k


def test_levels_double():
    assert substring.levels(35, 8) == [8, 16, 32, 35]
    assert substring.levels(5, 8) == [5]
    assert passages.PLACES.names[0] == "p"


def test_workers_can_import(spark):
    on_workers(spark)
    assert "PYTHONPATH" in spark.sparkContext.environment
