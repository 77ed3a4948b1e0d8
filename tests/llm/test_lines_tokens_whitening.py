"""Line dedup, cross-tokenizer alignment and embedding whitening against brute force."""

import base64
import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import frame, odd_documents, vocabulary

from linfold.llm import crosstok, linededup, singular, texts, tiling, whitening
from linfold.llm.filters import filter_of

SPACES = " \t\n\x0b\x0c\r"
LOWER = {c: c + 32 for c in range(65, 91)}


# --- lines ----------------------------------------------------------------------------------------------------

def lined_documents():
    shared = "This very line stands in a good many documents"
    short = "nineteen characters"
    rows = [(i, f"{'  ' * (i % 3)}{shared.upper() if i % 2 else shared}\t\nown line number {i} of its document\n{short}", "en", "a")
            for i in range(1, 9)]
    two = "a line that only two documents hold"
    rows += [(20, two + "\n" + two + "\n", "en", "b"), (21, two + "\r\n\n", "en", "b"), (22, shared + "\n" + shared, "en", "b"),
             (23, None, "en", "c"), (24, "", "en", "c"), (25, "\n\n", "en", "c"), (26, "éèàüö" * 4 + "\n" + shared, "fr", "c"),
             (27, "éèàüö" * 4, "fr", "c"), (28, " " + "éèàüö" * 4, "fr", "c"), (22, shared + "\n" + shared, "en", "b"),
             (22, "other text of that id\n" + shared, "en", "b"), (None, shared + "\nno id here", "en", "d"),
             (29, "\n".join(vocabulary(900 + k, 9) for k in range(4000)) + "\n" + vocabulary(905, 9), "de", "d"),
             (30, vocabulary(905, 9) + "\n" + vocabulary(906, 9), "de", "d"), (31, vocabulary(905, 9), "de", "d")]
    return rows


def brute_lines(rows):
    holders = defaultdict(set)
    key = lambda line: line.strip(SPACES).translate(LOWER)
    for i, (_, text, *_) in enumerate(rows):
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(i)
    out = []
    for doc_id, text, *_ in rows:
        lines, kept = (text or "").split("\n"), []
        for line in lines:
            with_it = holders.get(key(line), ())
            keeper = max((rows[j][0] for j in with_it if rows[j][0] is not None), default=doc_id)
            if len(with_it) < 3 or doc_id == keeper:
                kept.append(line)
        out.append((doc_id, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("rows", [lined_documents(), odd_documents()])
def test_lines_match_brute_force(spark, rows):
    assert Counter(map(tuple, linededup.digests(frame(spark, rows)).collect())) == brute_lines(rows)


def test_lines_do_not_depend_on_the_size_of_filters_and_slices(spark, monkeypatch):
    """Full filters suspect every line; a slice of a few keys makes many slices. Neither changes a result."""
    rows = lined_documents()
    monkeypatch.setattr(linededup, "SLICE_KEYS", 64)
    monkeypatch.setattr(texts, "PIECE_BYTES", 300)
    got = linededup.dedup_lines(frame(spark, rows), twice_bits=8).selectExpr("doc_id", "n_lines", "n_dropped", "sha2(text, 256)")
    assert Counter(map(tuple, got.collect())) == brute_lines(rows)


def test_only_suspected_lines_are_shuffled(spark):
    """Thousands of lines that one document holds: the twice list has hardly any of them."""
    rows = [(i, "\n".join(f"line {k} of document {i}, like no other" for k in range(400)), "en", "a") for i in range(20)]
    rows += [(100 + i, "the same closing line everywhere\n" * 3, "en", "a") for i in range(30)]
    twice = linededup.twice_seen(texts.keyed(frame(spark, rows), "doc_id", "text"))
    assert 1 <= twice.count() < 400  # of 8,001 keys


def test_rows_without_id_keep_one_line(spark):
    line = "a line in rows that have no id at all"
    rows = [(None, f"{line}\n{i}", "en", "a") for i in range(5)]
    got = linededup.dedup_lines(frame(spark, rows)).collect()
    assert sorted(r["n_dropped"] for r in got) == [0, 1, 1, 1, 1]


def test_lines_of_an_empty_table(spark):
    out = linededup.digests(frame(spark, []))
    assert out.columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"] and out.count() == 0


def test_filter_holds_every_key(spark):
    keys = np.random.default_rng(3).integers(-2 ** 63, 2 ** 63 - 1, 5000)
    df = spark.createDataFrame([(int(k),) for k in keys], "h long")
    f = filter_of(df, "h", len(keys), 1 << 24)
    assert f.may_hold(keys).all()
    others = np.random.default_rng(4).integers(-2 ** 63, 2 ** 63 - 1, 20000)
    assert f.may_hold(others).mean() < 0.05


def test_long_texts_are_worked_on_in_blocks(monkeypatch):
    """Leftmost minima of blocks are those of the whole, ties included."""
    rng = np.random.default_rng(1)
    for n, width in ((1000, 7), (1000, 1), (63, 20), (500, 499), (20, 20)):
        h = rng.integers(0, 1 << 30, n).astype(np.uint64) << np.uint64(33)
        h[rng.integers(0, n, n // 2)] = h[0]
        want = [s + int(np.argmin(h[s:s + width])) for s in range(n - width + 1)]
        for block in (width + 1, 64, 1 << 24):
            monkeypatch.setattr(texts, "MINIMA_BLOCK", block)
            assert texts.leftmost_minima(h, width).tolist() == (want if width > 1 else list(range(n)))


# --- tokens ---------------------------------------------------------------------------------------------------

def token_documents():
    return odd_documents() + [
        (600, " lead  two  spaces ", "en", "a"), (601, "<|endoftext|> </s> <unk> <0x41>", "en", "a"), (602, "▁ under", "en", "a"),
        (603, "日本語テキスト 😀😀 é́ \t\n\n  x", "ja", "a"), (604, "a" * 5000, "en", "a"), (605, "\x00nul\x00", "en", "a"),
        (606, "  ", "en", "a"), (606, "zero​width ﬁ ligature", "en", "a"), (607, " " * 3000 + "x" + "\n" * 3000, "en", "a")]


def brute_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(f"{crosstok.FOLDER}/{crosstok.FILE_A}")
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=f"{crosstok.FOLDER}/{crosstok.FILE_B}")
    # bytes of A's tokens from the same vocabulary as another library has it
    with open(f"{crosstok.FOLDER}/byte_bpe_50k.tiktoken", "rb") as f:
        bytes_a = {int(i): base64.b64decode(t) for t, i in map(bytes.split, f)}
    docs, count = [], Counter()
    for doc_id, text, *_ in rows:
        told = None
        if text:
            ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            one = [bytes_a[i] for i in ids_a]
            two = [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
                   for i in ids_b]
            if b"".join(one) == b"".join(two) == (" " + text).encode():
                ends = [list(np.cumsum([len(t) for t in x])) for x in (one, two)]
                groups, p, q = [], 0, 0
                for c in sorted(set(ends[0]) & set(ends[1])):
                    s, t = ends[0].index(c, p) + 1, ends[1].index(c, q) + 1
                    groups.append((ids_a[p:s], ids_b[q:t]))
                    p, q = s, t
                told = groups, [(x, y) for u, v in groups for x in u for y in v], len(ids_a), len(ids_b)
                count.update(set(told[1]))
        docs.append((doc_id, told))
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for doc_id, told in docs:
        if told is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        groups, links, n_a, n_b = told
        spelled = ";".join(",".join(map(str, u)) + "|" + ",".join(map(str, v)) for u, v in groups)
        out.append((doc_id, n_a, n_b, len(groups), len(links), sum(count[x] == best[x[0]] for x in links),
                    sum(count[x] for x in links), hashlib.sha256(spelled.encode()).hexdigest()))
    return Counter(out)


def test_alignment_matches_brute_force(spark, monkeypatch):
    rows = token_documents()
    want, df = brute_alignment(rows), frame(spark, rows)
    for head in (crosstok.HEAD, 50, 0):  # all pairs broadcast, some, none
        assert Counter(map(tuple, crosstok.aligned(df, head=head).collect())) == want, head


def test_groups_hold_the_same_bytes(spark):
    pair = crosstok.loaded(crosstok.FOLDER)
    for r in crosstok.groups(frame(spark, token_documents())).collect():
        assert len(r["a_stops"]) == len(r["b_stops"])
        p = q = 0
        for s, t in zip(r["a_stops"], r["b_stops"]):
            one, two = pair.vocab_a.joined(np.array(r["a_ids"][p:s])), pair.vocab_b.joined(np.array(r["b_ids"][q:t]))
            assert one.tobytes() == two.tobytes() and len(one)
            p, q = s, t
        assert (p, q) == (len(r["a_ids"]), len(r["b_ids"]))


def test_both_encoders_of_one_vocabulary_agree():
    pair = crosstok.loaded(crosstok.FOLDER)
    assert pair.quick is not None
    told = [" " + (r[1] or "") for r in token_documents()]
    quick = pair.encode_a(told)
    assert quick == [e.ids for e in pair.a.encode_batch(told, add_special_tokens=False)]


def test_links_in_small_blocks(monkeypatch):
    pair = crosstok.loaded(crosstok.FOLDER)
    x = crosstok.Aligned(pair, [r[1] or "" for r in token_documents()])
    width = len(pair.vocab_a) * len(pair.vocab_b)
    whole = x.pairs(len(pair.vocab_b), width)
    assert whole[1].sum() == x.links.sum()
    monkeypatch.setattr(crosstok, "LINKS", 7)
    assert all((a == b).all() for a, b in zip(whole, x.pairs(len(pair.vocab_b), width)))


def test_gallop_finds_the_first_end():
    rng = np.random.default_rng(5)
    ends = np.unique(rng.integers(0, 5000, 900))
    wanted = np.sort(rng.integers(0, ends[-1] + 1, 300))
    for start in (np.zeros(300, dtype=np.int64), np.full(300, len(ends) - 1), rng.integers(0, len(ends), 300)):
        assert (crosstok.gallop(wanted, ends, start) == np.searchsorted(ends, wanted)).all()


def test_alignment_of_an_empty_table(spark):
    assert crosstok.aligned(frame(spark, [])).count() == 0
    assert crosstok.aligned(frame(spark, [(1, None, None, None)])).collect()[0]["n_links"] == 0


# --- whitening ------------------------------------------------------------------------------------------------

def matrices():
    rng = np.random.default_rng(0)
    for n in (1, 2, 5, 40):
        yield rng.normal(size=(n, n))
    yield np.linalg.qr(rng.normal(size=(200, 30)) * np.logspace(0, -9, 30), mode="r")  # variances over 18 decades
    yield np.vstack([np.linalg.qr(rng.normal(size=(6, 20)), mode="r"), np.zeros((14, 20))])  # few rows
    yield np.eye(9)
    q = np.linalg.qr(rng.normal(size=(24, 24)))[0]
    yield q @ np.diag(np.r_[np.full(12, 3.0), np.ones(12)]) @ q.T  # repeated values
    yield np.diag(np.abs(np.arange(-10, 11.0)) + 1e-3) + np.diag(np.ones(20), 1)  # pairs that nearly touch


@pytest.mark.parametrize("r", list(matrices()))
def test_singular_values_and_directions(r):
    values, axes = singular.right_singular(r, 10 ** 6)
    want = np.linalg.svd(r)[1] ** 2
    k = len(values)
    assert k == (want > (len(r) * singular.EPS) ** 2 * want[0] * 4).sum()
    # numpy itself is exact to rounding of the largest value only
    assert np.abs(values - want[:k]).max() <= 1e-13 * want[0]
    assert np.abs(axes.T @ axes - np.eye(k)).max() < 1e-10
    assert np.abs(r.T @ r @ axes - axes * values).max() <= 1e-13 * want[0]


def test_no_variance_has_no_direction():
    assert singular.right_singular(np.zeros((4, 4)), 9)[0].shape == (0,)


def embeddings(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, component string, n string, _vec int")


def check_components(got, vectors, most):
    x = np.floor(64 * vectors.astype(np.float64)).astype(np.int64) + 1_000_000
    n = len(x)
    whole = n * x - x.sum(axis=0)
    c = whole / n
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1][:most], v[:, ::-1][:, :most]
    white = c @ v / np.sqrt(e)
    rows = defaultdict(dict)
    for r in got:
        rows[r["vec_id"]][r["component"]] = r
        assert r["n"] == n and r["identity_error"] <= 1e-9
        assert r["explained"] == pytest.approx(e[r["component"] - 1] / np.trace(c.T @ c / n), rel=1e-9)
    found = np.array([[rows[i][k + 1]["whitened"] for k in range(len(e))] for i in range(n)])
    sign = np.sign((found * white).sum(axis=0))
    assert np.abs(found * sign - white).max() < 1e-8
    assert [rows[i][1]["deviation"] for i in range(n)] == [int((w.astype(object) ** 2).sum()) for w in whole]


def test_whitening_matches_eigenvectors(spark):
    rng = np.random.default_rng(8)
    vectors = (rng.normal(size=(300, 12)) @ rng.normal(size=(12, 12))).astype(np.float32)
    vectors[100:140] = vectors[0]  # a vector that comes often
    rows = [(i, [float(c) for c in v], 0, "x", "y", 1) for i, v in enumerate(vectors)]
    odd = [(900, None, 0, "x", "y", 1), (901, [1.0] * 11 + [None], 0, "x", "y", 1), (902, [float("nan")] * 12, 0, "x", "y", 1),
           (903, [float("inf")] + [0.0] * 11, 0, "x", "y", 1), (904, [1.0, 2.0], 0, "x", "y", 1), (905, [], 0, "x", "y", 1),
           (906, [1e20] * 12, 0, "x", "y", 1)]
    df = embeddings(spark, rows + odd).repartition(13)
    got = whitening.components(df, most=9).collect()
    assert len(got) == 300 * 9
    check_components(got, vectors, 9)
    again = whitening.components(df.coalesce(1), most=9).collect()
    check_components(again, vectors, 9)


def test_whitening_without_variance_or_rows(spark):
    same = [(i, [0.5, 0.25, 1.0], 0, "x", "y", 1) for i in range(5)]
    assert whitening.components(embeddings(spark, same)).count() == 0
    assert whitening.components(embeddings(spark, same[:1])).count() == 0
    assert whitening.components(embeddings(spark, [])).count() == 0
    assert whitening.components(embeddings(spark, [(1, None, 0, "x", "y", 1)])).count() == 0
    flat = [(None if i == 3 else i, [float(i), 2.0 * i, 7.0], 0, "x", "y", 1) for i in range(6)]  # one direction only
    got = whitening.components(embeddings(spark, flat)).collect()
    assert {r["component"] for r in got} == {1} and len(got) == 6 and sum(r["vec_id"] is None for r in got) == 1
    assert got[0]["explained"] == pytest.approx(1.0)


def test_deviations_beyond_a_long_are_null():
    model = whitening.Whitening(1 << 40, np.array([0]), np.array([0]), np.zeros(0), np.zeros((1, 0)), 0.0)
    assert model.deviations(np.array([[1], [1 << 30]])) == [None, None]
    assert model.deviations(np.array([[0]])) == [0]


# --- tiling by join -------------------------------------------------------------------------------------------

def test_common_phrase_pairs_nobody(spark):
    """Documents and items that share one opening phrase: the joined way finds what the scan finds."""
    phrase = vocabulary(700, 9, 5000)
    items = [(i, f"{phrase} {vocabulary(1000 + i, 14, 5000)}") for i in range(25)]
    rows = [(i, f"{phrase} {vocabulary(3000 + i, 40, 5000)}", "en", "a") for i in range(60)]
    rows += [(100 + i, f"{vocabulary(4000 + i, 20, 5000)} {items[i][1]}", "en", "a") for i in range(5)]
    rows += [(200, " ".join(items[7][1].split()[12:] + items[7][1].split()[:12]), "en", "a")]
    df, bench = frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    scan, joined = (Counter((r["doc_id"], r["n_items"], r["item_id"], r["coverage"]) for r in
                            tiling.tiled(df, bench, broadcast_seeds=b).collect()) for b in (1 << 20, 0))
    assert scan == joined
    assert sorted(k[0] for k in scan if k[1]) == [100, 101, 102, 103, 104, 200]
