"""Near-duplicates among rows that lack an id, against all pairs."""

from collections import Counter

from helpers import frame, near_components, odd_documents, vocabulary

from linfold.llm import minhash


def without_ids():
    """Families with ids, with none and with both; near and exact copies; texts without a word."""
    base, other, third = (vocabulary(200 + i, 200, 3000) for i in range(3))

    def near(text, k):
        w = text.split()
        w[k] = f"edit{k}"
        return " ".join(w)
    return [(None, base, "en", "a"), (None, base, "en", "b"), (None, near(base, 50), "en", "a"),
            (None, near(base, 150), "en", "a"), (30, near(other, 20), "en", "a"), (None, other, "en", "a"),
            (20, near(other, 120), "en", "a"), (None, third, "en", "a"), (None, "", "en", "a"), (None, None, "en", "a"),
            (None, "", "en", "a"), (40, "some text of its own with an id", "en", "a")]


def brute(rows):
    """Group of each row, from all pairs of rows (the row's number as id)."""
    return {i: c for i, (_, c) in near_components([(i, r[1]) for i, r in enumerate(rows)]).items()}


def test_null_ids_are_linked(spark):
    for rows in (without_ids(), odd_documents()):
        group = brute(rows)
        least = {}
        for i, r in enumerate(rows):
            if r[0] is not None:
                least[group[i]] = min(r[0], least.get(group[i], r[0]))
        sets = near_components([(i, r[1]) for i, r in enumerate(rows)])
        want = Counter((r[0], sets[i][0], least.get(group[i])) for i, r in enumerate(rows))
        got = minhash.near_duplicates(frame(spark, rows)).collect()
        assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == want
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got if r["component_id"] is not None)


def test_survivors_are_one_of_each_group(spark):
    for rows in (without_ids(), odd_documents()):
        df = frame(spark, rows)
        left = minhash.survivors(df)
        assert left.columns == df.columns
        group = brute(rows)
        groups = {}
        for i, r in enumerate(rows):
            groups.setdefault(group[i], []).append((r[0], r[1]))
        left = [(r["doc_id"], r["text"]) for r in left.collect()]
        assert len(left) == len(groups)
        for members in groups.values():
            ids = [i for i, _ in members if i is not None]
            fit = [m for m in members if m[0] == (min(ids) if ids else None)]
            assert any(m in left for m in fit), members
            left.remove(next(m for m in fit if m in left))
        assert not left
