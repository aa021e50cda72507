"""Conversations as training windows of a token budget.

Turns are marked by control strings; the same strings inside texts are escaped and can
be read back. Prefix sums of the turns' tokens place every turn in a span, so windows
begin and end with whole turns. Every window starts with the conversation's system turn
and a limited number of turns before its span; what a window repeats is masked, so each
assistant text is a target once. All of it is native.

Prefix sums go over blocks of turns first, so that no task holds a whole conversation.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
BUDGET, HISTORY = 2048, 256
TURN_BLOCK = 256
TURN_COST = 4


def escaped(text: Column) -> Column:
    """No control string can occur: every ``<|`` is followed by one more ``|``."""
    return F.replace(text, F.lit("<|"), F.lit("<||"))


def unescaped(text: Column) -> Column:
    return F.replace(text, F.lit("<||"), F.lit("<|"))


def byte_tokens(text: Column) -> Column:
    """About the tokens of a byte-level vocabulary: a quarter of the UTF-8 bytes."""
    return F.ceil(F.octet_length(text) / 4) + TURN_COST


def windows(
    rows: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    budget: int = BUDGET,
    history: int = HISTORY,
    tokens: Callable[[Column], Column] = byte_tokens,
    target: str = "assistant",
) -> DataFrame:
    """Formatted windows of all conversations.

    Returns (conv_id, window, formatted, spans, n_repeated, tokens, over_budget): spans are
    the (start, length) in code points, from 0, under the loss mask; the first
    ``n_repeated`` turns of a window repeat earlier ones. A turn with more than half the
    room of a window stands in its own; only a window that one turn or the system turn
    overfills exceeds the budget. Null texts and roles are empty; rows of a conversation
    are ordered by turn (null first), role and text; repeated rows are turns of their own;
    null conversation ids are one conversation. Other columns are ignored.
    """
    base = rows.select(
        F.struct(F.col(conv).alias("id")).alias("ck"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    block = F.struct(F.col("turn").isNotNull(), F.floor(F.col("turn") / TURN_BLOCK))
    base = base.withColumn("block", block).withColumn("cost", tokens(F.col("text")))
    # place of every turn in its conversation: rows of earlier blocks, then own block
    blocks = base.groupBy("ck", "block").agg(F.count(F.lit(1)).alias("rows"))
    earlier = Window.partitionBy("ck").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        "ck", "block", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before")
    )
    inside = Window.partitionBy("ck", "block").orderBy("turn", "role", "text")
    turns = base.withColumn("at", F.row_number().over(inside)).join(blocks, ["ck", "block"])
    turns = turns.withColumn("n", F.col("rows_before") + F.col("at")).drop("at", "rows_before", "turn")
    leads = (F.col("n") == 1) & (F.col("role") == "system")
    head = f"{OPEN}"
    marked_role = F.replace(escaped(F.col("role")), F.lit("\n"), F.lit("<|n|>"))
    header = F.concat(F.lit(head), marked_role, F.lit("\n"))
    turns = turns.select(
        "ck", "block", "n", "role", "cost", leads.alias("leads"), header.alias("header"),
        escaped(F.col("text")).alias("body"),
    )
    # prefix sums of the tokens of all turns but the system turn
    own = F.when(F.col("leads"), 0).otherwise(F.col("cost"))
    sums = turns.groupBy("ck", "block").agg(F.sum(own).alias("sum"))
    sums = sums.select(
        "ck", "block", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("sum_before")
    )
    inner = Window.partitionBy("ck", "block").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("before", F.coalesce(F.sum(own).over(inner), F.lit(0)))
    turns = turns.join(sums, ["ck", "block"]).withColumn("before", F.col("before") + F.col("sum_before"))
    turns = turns.drop("block", "sum_before")
    system = turns.where("leads").select(
        "ck", F.col("cost").alias("system_cost"), "header", "body", "role"
    )
    costs = system.select("ck", "system_cost")
    turns = turns.join(costs, "ck", "left").fillna({"system_cost": 0})
    room = F.floor((F.lit(budget) - F.col("system_cost") - history) / 2)
    turns = turns.withColumn("stride", F.greatest(room, F.lit(1)))
    turns = turns.withColumn("span", F.floor(F.col("before") / F.col("stride")))
    alone = (~F.col("leads") & (F.col("cost") > F.col("stride"))).cast("long")
    turns = turns.withColumn("window", F.col("span") * 2 + alone)
    # turns before a window, as far as the history reaches
    body = turns.where("not leads")
    starts = body.groupBy("ck", "window").agg(F.min("before").alias("start"))
    near = F.explode(F.sequence(F.col("span") * 2, F.col("span") * 2 + 3))
    reach = F.least(F.lit(history), F.col("stride"))
    past = body.select(
        "ck", "n", "before", "cost", "window", reach.alias("reach"), near.alias("later")
    ).where("later > window and cost <= reach")
    past = past.join(starts.withColumnRenamed("window", "later"), ["ck", "later"])
    past = past.where("start > before and start - before <= reach")
    past = past.select("ck", "n", F.col("later").alias("window"))
    content = turns.select("ck", "n", "role", "cost", "header", "body")
    repeated = content.join(past, ["ck", "n"]).withColumn("repeated", F.lit(True))
    fresh = turns.select("ck", "n", "role", "cost", "header", "body", "window").withColumn(
        "repeated", F.lit(False)
    )
    # the system turn is new in the first window (0, or 1 if its first turn is alone)
    firsts = body.groupBy("ck").agg(F.min("window").alias("first"))
    fresh = fresh.join(firsts, "ck", "left")
    fresh = fresh.withColumn(
        "window", F.when((F.col("n") == 1) & F.col("first").isNotNull(), F.col("first")).otherwise(F.col("window"))
    ).drop("first")
    again = starts.join(firsts, "ck").where("window > first").select("ck", "window")
    again = again.join(system, "ck").select(
        "ck", F.lit(1).cast("long").alias("n"), "role", F.col("system_cost").alias("cost"), "header",
        "body", "window", F.lit(True).alias("repeated"),
    )
    parts = fresh.unionByName(repeated.select(*fresh.columns)).unionByName(again.select(*fresh.columns))
    parts = parts.withColumn("piece", F.concat("header", "body", F.lit(f"{CLOSE}\n")))
    running = Window.partitionBy("ck", "window").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum(F.char_length("piece")).over(running), F.lit(0))
    span = F.when(
        (F.col("role") == target) & ~F.col("repeated"),
        F.struct(
            (F.col("offset") + F.char_length("header")).alias("start"),
            F.char_length("body").cast("long").alias("length"),
        ),
    )
    parts = parts.withColumn("offset", offset).withColumn("span", span)
    # a window holds few turns: each costs TURN_COST tokens at least
    out = parts.groupBy("ck", "window").agg(
        F.array_sort(F.collect_list(F.struct("n", "piece"))).alias("pieces"),
        F.array_sort(F.collect_list("span")).alias("spans"),
        F.sum(F.col("repeated").cast("int")).alias("n_repeated"),
        F.sum("cost").alias("tokens"),
    )
    return out.select(
        F.col("ck.id").alias("conv_id"),
        "window",
        F.array_join(F.col("pieces.piece"), "").alias("formatted"),
        "spans",
        F.col("n_repeated").cast("int").alias("n_repeated"),
        "tokens",
        (F.col("tokens") > budget).alias("over_budget"),
    )


def read_turns(formatted: Column, skipped: Column) -> Column:
    """(role, text) of the turns in a window, without its first ``skipped`` ones."""
    parts = F.split(formatted, r"<\|im_start\|>")
    parts = F.slice(parts, skipped + 2, F.size(parts))
    ending = len(CLOSE) + 1

    def turn(part: Column) -> Column:
        role = F.replace(F.substring_index(part, "\n", 1), F.lit("<|n|>"), F.lit("\n"))
        begin = F.instr(part, "\n") + 1
        body = F.substring(part, begin, F.char_length(part) - begin - ending + 1)
        return F.struct(unescaped(role).alias("role"), unescaped(body).alias("text"))

    return F.transform(parts, turn)


def read_targets(formatted: Column, spans: Column) -> Column:
    """Unescaped texts under the loss mask, in order."""
    return F.transform(spans, lambda s: unescaped(F.substring(formatted, s.start + 1, s.length)))
