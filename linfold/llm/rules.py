"""Quality rules as a table of thresholds, compiled into one projection of built-in functions.

``measures`` turns a text into its counts (words, characters, symbols, lines, repeats, stop
words); ``RULES`` names ratios of them with the range in which a text passes; ``judge`` compiles
both into columns. Nothing leaves the JVM and nothing is shuffled: a row needs only itself.

Words in repeated 3-word windows, exactly: each window's 64-bit hash, with its low bits replaced
by the place, is sorted as a plain long array; only places whose neighbour agrees in the high bits
are looked at again, with the window's own words, in a second, small sort. So a text of n words
costs n log n, whatever repeats in it.

Defined results: null and empty texts have no words and fail the base rule (fewer than 50 words).
Ratios with nothing to divide by are 0. Repeated rows are judged alike; other columns are not read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linfold.llm.texts import SPACE, free_name

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "it", "was", "for", "on", "with", "as", "are", "this", "be", "by",
    "der", "die", "und", "das", "den", "von", "zu", "mit", "ist", "im", "ein", "eine", "nicht", "auf", "für",
    "le", "la", "les", "de", "des", "et", "du", "un", "une", "dans", "que", "qui", "pour", "est", "par", "sur",
    "el", "los", "las", "y", "en", "del", "se", "por", "con", "una", "su", "al", "para",
)

#: Rule, ratio of two measures (or one measure over 1), least and greatest passing value (None: open).
RULES: tuple[tuple[str, str, str | None, float | None, float | None], ...] = (
    ("word_length", "word_chars", "n_words", 2.0, 12.0),
    ("symbols_to_words", "n_symbols", "n_words", None, 0.2),
    ("stop_words", "n_stop_words", "n_words", 0.02, None),
    ("duplicate_lines", "n_dup_lines", "n_lines", None, 0.4),
)


MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_stop_words", "n_repeat_words")


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a long column for each of ``MEASURES``; names that the frame has already are replaced.

    Each step names what the next ones use more than once, so that nothing is worked out twice.
    """
    keep = [c for c in docs.columns if c.lower() not in MEASURES]
    temp = {n: free_name(docs, f"_{n}") for n in ("text", "words", "lines", "hashes", "bits", "windows", "packed",
                                                  "places", "exact", "marked")}
    t = {n: F.col(c) for n, c in temp.items()}
    df = docs.withColumn(temp["text"], F.coalesce(F.col(text).cast("string"), F.lit("")))
    df = df.withColumns({
        temp["words"]: F.filter(F.split(t["text"], SPACE), lambda w: w != ""),
        temp["lines"]: F.filter(F.split(t["text"], "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))})
    df = df.withColumns({
        "n_words": F.size(t["words"]).cast("long"),
        "word_chars": F.length(F.array_join(t["words"], "")).cast("long"),
        "n_symbols": F.regexp_count(t["text"], F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_lines": F.size(t["lines"]).cast("long"),
        "n_dup_lines": (F.size(t["lines"]) - F.size(F.array_distinct(t["lines"]))).cast("long"),
        "n_stop_words": F.size(F.filter(t["words"], lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long"),
        temp["hashes"]: F.transform(t["words"], lambda w: F.xxhash64(w))})
    # Bits that any place in the text fits in.
    df = df.withColumns({
        temp["bits"]: F.length(F.bin(F.size(t["words"]))),
        temp["windows"]: F.transform(
            F.slice(t["hashes"], 1, F.greatest(F.size(t["hashes"]) - 2, F.lit(0))),
            lambda h, i: F.xxhash64(h, F.get(t["hashes"], i + 1), F.get(t["hashes"], i + 2)))})
    bits, packed = t["bits"], temp["packed"]
    high = lambda x: F.call_function("shiftrightunsigned", x, bits)
    up = lambda x: F.call_function("shiftleft", x, bits)
    df = df.withColumn(packed, F.sort_array(F.transform(
        t["windows"], lambda h, i: up(high(h)).bitwiseOR(i.cast("long")))))
    near = lambda x, i: F.coalesce(high(x) == high(F.get(t["packed"], i + 1)), F.lit(False)) | F.coalesce(
        high(x) == high(F.get(t["packed"], i - 1)), F.lit(False))
    low = lambda x: (x - up(high(x))).cast("int")
    df = df.withColumn(temp["places"], F.transform(F.filter(t["packed"], near), low))
    word = lambda p: F.get(t["words"], p)
    df = df.withColumn(temp["exact"], F.sort_array(F.transform(t["places"], lambda p: F.struct(
        F.struct(word(p).alias("a"), word(p + 1).alias("b"), word(p + 2).alias("c")).alias("window"), p.alias("place")))))
    same = lambda e, i: F.coalesce(e["window"] == F.get(t["exact"], i + 1)["window"], F.lit(False)) | F.coalesce(
        e["window"] == F.get(t["exact"], i - 1)["window"], F.lit(False))
    df = df.withColumn(temp["marked"], F.sort_array(F.transform(F.filter(t["exact"], same), lambda e: e["place"])))
    # A marked window adds three words, less those that the marked window before it has covered.
    step = F.transform(t["marked"], lambda p, i: F.least(F.lit(3), p - F.coalesce(F.get(t["marked"], i - 1), p - 3)))
    df = df.withColumn("n_repeat_words", F.aggregate(step, F.lit(0).cast("long"), lambda a, x: a + x))
    return df.select(*keep, *MEASURES)


def passes(rules=RULES) -> Column:
    """All rules of the table as one condition over the measures."""
    verdict = F.lit(True)
    for _, top, bottom, least, most in rules:
        value = F.col(top).cast("double")
        if bottom:
            value = F.coalesce(F.try_divide(value, F.col(bottom).cast("double")), F.lit(0.0))
        if least is not None:
            verdict = verdict & (value >= least)
        if most is not None:
            verdict = verdict & (value <= most)
    return verdict


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


def judge(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """``docs`` with the measures, ``base_failed`` and ``kept`` (these names are replaced where the frame has them)."""
    measured = measures(docs, text)
    keep = [c for c in measured.columns if c.lower() not in ("base_failed", "kept")]
    return measured.select(*keep, base_failed().alias("base_failed"), (~base_failed() & passes(rules)).alias("kept"))
