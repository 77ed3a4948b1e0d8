"""Chat formatting into budgeted windows, with a loss mask; built-in functions only.

A turn becomes ``### role: text</turn>`` and a line feed. ``escape`` leaves no ``#``, ``<`` or
unpaired backslash in a text (``\\`` becomes ``\\\\``, ``#`` becomes ``\\h``, ``<`` becomes ``\\l``;
in a role also ``:`` becomes ``\\c``), so control strings inside texts cannot be taken for marks
and ``unescape`` gives back every text exactly.

Prefix sums of turn tokens (words plus ``MARK_TOKENS``) cut a conversation into turn-aligned spans:
a turn belongs to span ``ceil(end / (budget / 2))``. Each window is the conversation's system turn
(its first turn, if its role is system), up to ``history`` turns just before the span that start
within ``budget / 4`` tokens of it, and the span itself. So a window stays within the budget unless
the system turn or a single turn exceeds a quarter of it; no turn is ever cut. The loss mask holds
the texts of assistant turns of the span; system turn and repeated history are context and carry no
loss, so each assistant text is a target once.

One shuffle by conversation serves prefix sums, windows and digests. A window's rows stay few, as
each turn counts ``MARK_TOKENS`` at least.

Defined results: null texts and roles are empty; null turns sort first; equal turn numbers are put
in order of role and text; a null conversation id is a conversation like others; rows that repeat
are turns of their own. An empty table gives no rows. Further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linfold.llm.texts import WORD

BUDGET = 1024
HISTORY = 2
MARK_TOKENS = 4
END = "</turn>\n"


def escape(text: Column, role: bool = False) -> Column:
    out = text
    for plain, mark in (("\\", "\\\\"), ("#", "\\h"), ("<", "\\l"), *(((":", "\\c"),) if role else ())):
        out = F.replace(out, F.lit(plain), F.lit(mark))
    return out


def unescape(text: Column) -> Column:
    """Paired backslashes are set apart first; in what lies between, a backslash starts a mark."""
    def plain(x: Column) -> Column:
        for mark, letter in (("\\h", "#"), ("\\l", "<"), ("\\c", ":")):
            x = F.replace(x, F.lit(mark), F.lit(letter))
        return x
    return F.array_join(F.transform(F.split(text, r"\\\\"), plain), "\\")


def windows(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
            budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """(conv_id, window, formatted, context_turns, loss): ``loss`` is an array of (start, length) in characters."""
    empty = F.lit("")
    rows = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
                        F.coalesce(F.col(role).cast("string"), empty).alias("role"),
                        F.coalesce(F.col(text).cast("string"), empty).alias("text"))
    rows = rows.select("conv_id", "turn", "role", "text", escape(F.col("text")).alias("body"),
                       F.concat(F.lit("### "), escape(F.col("role"), role=True), F.lit(": ")).alias("head"),
                       (F.regexp_count("text", F.lit(WORD)) + MARK_TOKENS).cast("long").alias("tokens"))
    rows = rows.withColumn("chars", (F.length("head") + F.length("body") + len(END)).cast("long"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({
        "n": F.row_number().over(order), "end": F.sum("tokens").over(so_far),
        "char_end": F.sum("chars").over(so_far), "first_role": F.first("role").over(so_far),
        "first_piece": F.first(F.concat("head", "body", F.lit(END))).over(so_far)})
    rows = rows.withColumn("span", F.ceil(F.col("end") / (budget / 2)).cast("long"))
    rows = rows.withColumn("opens", F.coalesce(F.lag("span").over(order) != F.col("span"), F.lit(True)))
    rows = rows.withColumn("system", (F.col("n") == 1) & (F.col("first_role") == "system"))
    places = [F.struct(F.col("span").alias("span"), F.lit(True).alias("own"))]
    for j in range(1, history + 1):
        near = (F.lead("end", j).over(order) - F.lead("tokens", j).over(order)
                - (F.col("end") - F.col("tokens"))) <= budget / 4
        places.append(F.when(F.lead("opens", j).over(order) & near & ~F.col("system"), F.struct(
            F.lead("span", j).over(order).alias("span"), F.lit(False).alias("own"))))
    rows = rows.withColumn("place", F.filter(F.array(*places), lambda x: x.isNotNull()))
    dealt = rows.select("*", F.explode("place").alias("at"))
    one = F.struct("n", F.col("at")["own"].alias("own"), "role", "head", "body", F.col("char_end").alias("stop"), "chars")
    grouped = dealt.groupBy("conv_id", F.col("at")["span"].alias("window")).agg(
        F.sort_array(F.collect_list(one)).alias("all"),
        F.first(F.when(F.col("first_role") == "system", F.col("first_piece"))).alias("opening"))
    grouped = grouped.withColumns({
        "context": F.filter("all", lambda t: ~t["own"]), "own": F.filter("all", lambda t: t["own"])})
    joined = lambda a: F.array_join(F.transform(a, lambda t: F.concat(t["head"], t["body"], F.lit(END))), "")
    has_first = F.get("own", F.lit(0))["n"] == 1
    opening = F.when(~has_first, F.col("opening"))  # the first window has the system turn in its span
    grouped = grouped.withColumns({
        "before": F.concat(F.coalesce(opening, F.lit("")), joined("context")), "span_text": joined("own"),
        "context_turns": F.size("context") + F.when(opening.isNotNull(), 1).otherwise(0)})
    grouped = grouped.withColumn("shift", F.length("before") - (
        F.get("own", F.lit(0))["stop"] - F.get("own", F.lit(0))["chars"]))
    loss = F.transform(F.filter("own", lambda t: t["role"] == "assistant"), lambda t: F.struct(
        (F.col("shift") + t["stop"] - t["chars"] + F.length(t["head"])).cast("long").alias("start"),
        F.length(t["body"]).cast("long").alias("length")))
    return grouped.select("conv_id", "window", F.concat("before", "span_text").alias("formatted"),
                          "context_turns", loss.alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, window, formatted_chars, turns, losses) parsed from the windows alone.

    ``turns`` are the (role, text) that are not context; ``losses`` the texts under the mask.
    """
    pieces = F.split("formatted", END, -1)
    own = F.slice(pieces, F.col("context_turns") + 1, F.greatest(F.size(pieces) - 1 - F.col("context_turns"), F.lit(0)))
    turn = lambda p: F.struct(
        unescape(F.substring_index(F.substring(p, 5, 2147483647), ": ", 1)).alias("role"),
        unescape(p.substr(F.locate(": ", p) + 2, F.lit(2147483647))).alias("text"))
    under = F.transform("loss", lambda s: unescape(F.col("formatted").substr(
        (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return formatted.select("conv_id", "window", F.length("formatted").cast("long").alias("formatted_chars"),
                            F.transform(own, turn).alias("turns"), under.alias("losses"))


def digests(parsed: DataFrame) -> DataFrame:
    """One row for each conversation with the digests of what ``read_back`` found, windows in order."""
    per = parsed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("window", "turns", "losses"))).alias("all"),
        F.sum("formatted_chars").alias("formatted_chars"))
    turns, losses = F.flatten(F.col("all")["turns"]), F.array_join(F.flatten(F.col("all")["losses"]), "")
    told = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return per.select("conv_id", F.size(turns).cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
                      F.length(losses).cast("long").alias("loss_chars"), F.sha2(losses, 256).alias("loss_sha256"),
                      "formatted_chars")
