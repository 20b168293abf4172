"""Conversations as training text: windows of whole turns within a budget, with a loss mask. Built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Control strings of the template.
OPEN, CLOSE, BREAK = "<|im_start|>", "<|im_end|>\n", "<|nl|>"


def escape(text: Column) -> Column:
    """Text without control strings: a backslash is doubled, ``<|`` gets one in between."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escape_role(role: Column) -> Column:
    """Like ``escape``; a line break, which ends the role, becomes a control string."""
    return F.replace(escape(role), F.lit("\n"), F.lit(BREAK))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(BREAK), F.lit("\n")))


def tokens(text: Column) -> Column:
    """Words and single other signs; what the budget is counted in."""
    return F.regexp_count(text, F.lit(r"\w+|[^\w\s]")).cast("long")


def chat_windows(
    conversations: DataFrame, budget: int = 512, history_turns: int = 2, history_tokens: int = 128,
    target: str = "assistant", system: str = "system",
) -> DataFrame:
    """Formatted windows: (conv_id, window, formatted, loss, n_turns, n_repeated).

    Turns in order of (turn, role, text) are ``<|im_start|>role``, line break, text, ``<|im_end|>``, line break. Prefix sums of
    the turns' tokens deal whole turns to windows: with capacity c = budget - system turn - history and m the longest
    ordinary turn, all turns whose sum before them lies in the same multiple of c - m share a window and have at most c tokens.
    A turn of more than c / 2 tokens is a window of its own and is never cut, so it alone may pass the budget.
    A leading system turn stands in every window. Up to ``history_turns`` turns before a window are repeated in
    it, as far back as they have ``history_tokens`` together. ``loss`` has the (start, end) code points of
    the ``target`` turns' texts; in repeated turns it has none, so each target counts once.

    A null text or role is empty, a null turn comes last, a null conv_id is a conversation like others; repeated rows are
    turns of their own; other columns are not read. A conversation's windows are computed where its turns are sorted;
    its formatted text is split over its windows.
    """
    turns = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    conv = W.partitionBy("conv_id")
    order = conv.orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    running = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    before = order.rowsBetween(W.unboundedPreceding, -1)
    piece = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n"), escape(F.col("text")), F.lit(CLOSE))
    t = turns.withColumn("pos", F.row_number().over(order)).withColumn("piece", piece)
    t = t.withColumn("leads", (F.col("pos") == 1) & (F.col("role") == system)).withColumn("size", tokens(F.col("piece")))
    t = t.withColumn("room", F.greatest(
        F.lit(budget) - history_tokens - F.coalesce(F.max(F.when(F.col("leads"), F.col("size"))).over(conv), F.lit(0)),
        F.lit(max(2, budget // 4)),
    ))
    t = t.withColumn("big", ~F.col("leads") & (F.col("size") > F.floor(F.col("room") / 2)))
    small = F.when(F.col("big") | F.col("leads"), 0).otherwise(F.col("size"))
    t = t.withColumn("step", F.col("room") - F.max(small).over(conv))
    t = t.withColumn("bucket", F.floor(F.coalesce(F.sum(small).over(before), F.lit(0)) / F.col("step")))
    t = t.withColumn("place", F.coalesce(F.sum(F.when(F.col("leads"), 0).otherwise(F.col("size"))).over(before), F.lit(0)))
    key = F.struct(F.sum(F.col("big").cast("int")).over(running).alias("s"), "big", "bucket")
    t = t.withColumn("key", key)
    opens = F.when((F.col("pos") == 1) | F.lag("leads").over(order), 0).otherwise(
        (F.col("key") != F.lag("key").over(order)).cast("int")
    )
    t = t.withColumn("opens", opens).withColumn("own", F.sum("opens").over(running))
    ahead = F.collect_list(F.struct(F.col("own").alias("w"), F.col("place").alias("p"))).over(order.rowsBetween(1, history_turns))
    near = F.filter("ahead", lambda x: (x["w"] > F.col("own")) & (x["p"] - F.col("place") <= history_tokens))
    # of a window's turns the first is the nearest, so a turn in reach means that the first one is
    later = F.array_distinct(F.transform(near, lambda x: x["w"]))
    everywhere = F.sequence(F.lit(0).cast("long"), F.max("own").over(conv))
    t = t.withColumn("ahead", ahead if history_turns > 0 else F.array().cast("array<struct<w:bigint,p:bigint>>"))
    t = t.withColumn("windows", F.when(F.col("leads"), everywhere).otherwise(F.concat(F.array("own"), later)))
    t = t.withColumn("window", F.explode("windows")).withColumn("again", F.col("window") != F.col("own"))
    here = W.partitionBy("conv_id", "window").orderBy("pos").rowsBetween(W.unboundedPreceding, -1)
    t = t.withColumn("at", F.coalesce(F.sum(F.length("piece")).over(here), F.lit(0)))
    text_at = F.col("at") + len(OPEN) + F.length(escape_role(F.col("role"))) + 1
    t = t.withColumn("span", F.when((F.col("role") == target) & ~F.col("again"), F.struct(
        text_at.alias("start"), (text_at + F.length(escape(F.col("text")))).alias("end"))))
    held = t.groupBy("conv_id", "window").agg(
        F.array_sort(F.collect_list(F.struct("pos", "piece", "span"))).alias("x"), F.count("*").alias("n_turns"),
        F.count_if("again").alias("n_repeated"),
    )
    return held.select(
        "conv_id", "window", F.array_join(F.transform("x", lambda x: x["piece"]), "").alias("formatted"),
        F.filter(F.transform("x", lambda x: x["span"]), lambda s: s.isNotNull()).alias("loss"), "n_turns", "n_repeated",
    )


def read_back(windows: DataFrame) -> DataFrame:
    """(conv_id, turns, targets, chars) read from formatted windows: each turn once, and the texts under the mask.

    ``turns`` is an array of (role, text), ``targets`` one of texts, both in order; ``chars`` counts the formatted code points.
    """
    parts = F.expr("slice(split(formatted, '<\\\\|im_start\\\\|>', -1), 2 + CAST(n_repeated AS INT), CAST(n_turns - n_repeated AS INT))")
    head = lambda p: F.substring_index(p, "\n", 1)
    turns = F.transform(parts, lambda p: F.struct(
        unescape_role(head(p)).alias("role"),
        unescape(F.substr(p, F.length(head(p)) + 2, F.length(p) - F.length(head(p)) - 1 - len(CLOSE))).alias("text"),
    ))
    masked = F.transform("loss", lambda s: unescape(F.substr("formatted", (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    read = windows.select("conv_id", "window", turns.alias("turns"), masked.alias("targets"), F.length("formatted").alias("chars"))
    held = read.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("window", "turns", "targets"))).alias("x"), F.sum("chars").alias("chars")
    )
    return held.select(
        "conv_id", F.flatten(F.transform("x", lambda x: x["turns"])).alias("turns"),
        F.flatten(F.transform("x", lambda x: x["targets"])).alias("targets"), "chars",
    )
