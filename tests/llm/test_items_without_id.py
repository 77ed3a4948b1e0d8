"""Benchmark items that lack an id are evidence like others."""

import pytest
from helpers import frame, vocabulary

from linfold.llm import tiling


@pytest.mark.parametrize("broadcast", [1 << 20, 0])
def test_items_without_id_are_found(spark, broadcast):
    first, second, named = (vocabulary(700 + i, 30, 5000) for i in range(3))
    items = [(None, first), (None, first), (None, second), (7, named), (9, None), (None, None), (None, "too short")]
    rows = [(1, vocabulary(710, 40) + " " + first, "en", "a"), (2, f"{first} {second}", "en", "a"),
            (3, f"{second} {named} {first}", "en", "a"), (4, vocabulary(711, 60), "en", "a"), (None, second, "en", "a"),
            (5, None, "en", "a")]
    df = frame(spark, rows)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = tiling.tiled(df, bench, broadcast_seeds=broadcast)
    got = {r["doc_id"]: (r["n_items"], r["item_id"], r["coverage"], r["contaminated"]) for r in found.collect()}
    assert got == {1: (1, None, 1.0, True), 2: (2, None, 1.0, True), 3: (3, 7, 1.0, True), 4: (0, None, 0.0, False),
                   None: (1, None, 1.0, True), 5: (0, None, 0.0, False)}
    assert sorted(r["doc_id"] for r in tiling.clean(df, found).collect()) == [4, 5]
