"""Different texts under one id: each is judged by itself."""

from collections import Counter

from helpers import frame, vocabulary

from linfold.llm import minhash


def test_texts_of_one_id_are_judged_each_by_itself(spark):
    copy = vocabulary(300, 150, 3000)
    near = copy.replace(copy.split()[70], "edit", 1)
    rows, want, components = [], [], Counter()
    for i in range(8):  # several ids, so that no order of hashes hides a loss
        alone = vocabulary(310 + i, 150, 3000)
        rows += [(50 + i, copy, "en", "a"), (50 + i, alone, "en", "a"), (50 + i, alone, "en", "b")]
        want.append((50 + i, alone))
        components[(50 + i, 3)] += 1
        components[(50 + i, 50 + i)] += 2
    two = vocabulary(330, 150, 3000)
    edited = two.replace(two.split()[80], "edit", 1)
    rows += [(3, copy, "en", "a"), (70, near, "en", "a"), (80, two, "en", "a"), (80, edited, "en", "a")]
    components += Counter({(3, 3): 1, (70, 3): 1, (80, 80): 2})
    df = frame(spark, rows)
    got = minhash.near_duplicates(df).collect()
    assert Counter((r["doc_id"], r["component_id"]) for r in got) == components
    assert [r["kept"] for r in got if r["doc_id"] == 80].count(True) == 1
    left = sorted((r["doc_id"], r["text"]) for r in minhash.survivors(df).collect())
    assert [x for x in left if x[0] != 80] == sorted([(3, copy), *want])
    assert [x[0] for x in left].count(80) == 1
