"""Brute-force forms of the text operators, and frames with every odd case."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

from linfold.llm.texts import on_workers

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
#: Names that the operators use inside; a table may have them too.
CLASHING = ("_text", "_k1", "_k2", "n", "copy", "key", "rep", "n_words", "kept", "size", "firsts")


def frame(spark, rows, extra=CLASHING):
    """Documents from (doc_id, text, lang, source) with n_chars and columns of clashing names."""
    on_workers(spark)
    schema = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", {c} string" for c in extra)
    full = [(*r, None if r[1] is None else len(r[1]), *["x"] * len(extra)) for r in rows]
    return spark.createDataFrame(full, schema)


def words(text) -> list[bytes]:
    return WORD.findall((text or "").encode())


def near_components(rows) -> dict:
    """(number of shingles, component) by id, from all pairs."""
    sets = {}
    for i, text, *_ in rows:
        w = [x.lower() for x in words(text)]  # bytes: only A-Z
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def cut_units(texts: list, window: int) -> list[list[bool]]:
    """Which units of each text a repeated window covers (texts are lists or bytes)."""
    seen = Counter(tuple(t[k:k + window]) for t in texts for k in range(len(t) - window + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for k in range(len(t) - window + 1):
            if seen[tuple(t[k:k + window])] > 1:
                gone[k:k + window] = [True] * window
        out.append(gone)
    return out


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def vocabulary(seed: int, n: int, size: int = 400) -> str:
    import random
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(size)}" for _ in range(n))


def odd_documents():
    """Nulls, empty and long texts, repeated rows, ties, shared passages, near and exact copies."""
    base = vocabulary(1, 300)
    near = base.split()
    near[50], near[200] = "changed", "also"
    passage = vocabulary(2, 60)
    rows = [
        (1, base, "en", "a"), (2, " ".join(near), "en", "a"), (3, base.upper(), "en", None), (3, base.upper(), "en", None),
        (4, None, "en", "b"), (5, "", None, "b"), (6, "  \n\t ", "de", "b"), (7, "one two", "de", "c"),
        (8, "One  two", "de", "c"), (9, vocabulary(3, 100) + " " + passage + " " + vocabulary(4, 80), "fr", "c"),
        (10, vocabulary(5, 40) + "\n" + passage + "\n" + vocabulary(6, 90), "fr", "c"), (None, base, "fr", "d"),
        (None, "12345 678 !!", "es", "d"), (11, "a " * 120, "es", "d"), (12, vocabulary(7, 20000), "es", "e"),
        (13, "é ü " * 60 + vocabulary(8, 50), "fr", "e"), (14, "one two three four five six", "en", "e"),
    ]
    rows += [(20 + i, vocabulary(100 + i, 60 + i), "en" if i % 2 else "de", "abc"[i % 3]) for i in range(12)]
    return rows
