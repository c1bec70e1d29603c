"""Chat formatting into budgeted windows.

A conversation becomes one or more windows of a template. Prefix sums of turn tokens choose spans of whole turns; every
window opens with the system turn, repeats a limited history before its span, and puts under the loss only the assistant
texts that are new in it. Turn texts are escaped reversibly, so a window can be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixwright.llm.common import let, prefix_sums

#: The template: a new or a repeated turn, its role, TEXT, its text, END.
NEW, AGAIN, TEXT, END = "<|turn|>", "<|again|>", "<|text|>", "<|end|>"
#: Control strings that texts can't hold, here and in common chat templates, and what stands for them. The escape character comes first.
ESCAPES = (("\\", "\\b"), ("<|", "\\l"), ("[INST]", "\\i"), ("[/INST]", "\\I"), ("<s>", "\\s"), ("</s>", "\\S"))
BUDGET, HISTORY, CHARS_PER_TOKEN = 1024, 256, 4


def escape(text: Column) -> Column:
    for raw, code in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for raw, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(raw))
    return text


def _rendered(marker: Column, turn: Column) -> Column:
    return F.concat(marker, turn["role"], F.lit(TEXT), turn["text"], F.lit(END))


def _starts(size: Column) -> Column:
    """Where spans start, of a row with sums, lead and room: a turn whose end is more than the room beyond the start of its span
    opens the next. A fold that grows an array copies it at every step, so starts are grown in blocks of about the root of the
    turns."""

    def step(a: Column, i: Column) -> Column:
        over = (F.get("sums", i + 1) - F.get("sums", a["last"]) > F.col("room")) & (i > a["last"])
        return F.struct(F.when(over, i).otherwise(a["last"]).alias("last"), F.when(over, F.concat(a["grown"], F.array(i))).otherwise(a["grown"]).alias("grown"))

    width = F.greatest(F.ceil(F.sqrt(size.cast("double"))).cast("int"), F.lit(1))
    blocks = F.when(size > F.col("lead"), F.sequence(F.col("lead"), size - 1, width)).otherwise(F.array().cast("array<int>"))

    def block(a: Column, first: Column) -> Column:
        inside = F.sequence(first, F.least(first + width, size) - 1)
        inner = F.aggregate(inside, F.struct(a["last"].alias("last"), F.array().cast("array<int>").alias("grown")), step)
        return let(inner, lambda x: F.struct(x["last"].alias("last"), F.concat(a["parts"], F.array(x["grown"])).alias("parts")))

    grown = F.aggregate(blocks, F.struct(F.col("lead").alias("last"), F.array(F.array(F.col("lead"))).alias("parts")), block)
    return F.flatten(grown["parts"])


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, chars_per_token: int = CHARS_PER_TOKEN) -> DataFrame:
    """``conversations`` (conv_id, turn, role, text) -> conv_id, window, formatted, loss (start, length in code points).

    Spans hold as many turns as fit into ``budget`` tokens after the system turn and a reserve of ``history`` tokens, and one
    turn at least: no text is cut. Null roles and texts count as empty; null turns come first; rows of a conversation that
    share a turn number stand by role and text, repeated rows stay. A null conv_id is a conversation. Empty tables give no
    rows; extra columns are ignored, whatever their names. A conversation's turns meet in one row, as its windows need them in order;
    time and memory grow with their number, and no window carries more than its own.
    """
    text = lambda c: escape(F.coalesce(F.col(c).cast("string"), F.lit("")))
    turns = conversations.select("conv_id", F.struct("turn", text("role").alias("role"), text("text").alias("text")).alias("row")).groupBy("conv_id").agg(F.array_sort(F.collect_list("row")).alias("turns"))
    tokens = F.transform("turns", lambda t: F.ceil((F.length(t["text"]) + F.length(t["role"])) / chars_per_token).cast("long") + 3)
    turns = turns.withColumn("tokens", tokens)
    turns = turns.withColumn("sums", prefix_sums(F.col("tokens")))
    lead = F.when(F.get("turns", F.lit(0))["role"] == "system", 1).otherwise(0)
    turns = turns.withColumn("lead", lead)
    room = F.greatest(F.lit(budget - history).cast("long") - F.get("sums", F.col("lead")), F.lit(1).cast("long"))
    turns = turns.withColumn("room", room)

    size = F.size("turns")
    turns = turns.withColumn("starts", _starts(size))
    reach = history // 3 + 1  # a turn has three tokens at least

    def window(start: Column, number: Column) -> Column:
        """The turns of a window alone: no window carries the whole conversation."""
        stop = F.coalesce(F.get("starts", number + 1), size)
        first = F.greatest(F.col("lead"), start - reach)
        near = F.when(start > F.col("lead"), F.filter(F.sequence(first, start - 1), lambda j: F.get("sums", start) - F.get("sums", j) <= history)).otherwise(F.array().cast("array<int>"))
        again = F.size(near)
        system = F.when(F.col("lead") == 1, F.slice("turns", 1, 1)).otherwise(F.slice("turns", 1, 0))
        marked = lambda rows, marker: F.transform(rows, lambda t: F.struct(marker.alias("marker"), t["role"].alias("role"), t["text"].alias("text")))
        return F.struct(
            number.alias("window"),
            F.concat(
                marked(system, F.when(number == 0, NEW).otherwise(AGAIN)), marked(F.slice("turns", start - again + 1, again), F.lit(AGAIN)), marked(F.slice("turns", start + 1, F.greatest(stop - start, F.lit(0))), F.lit(NEW)),
            ).alias("shown"),
        )

    shown = turns.select("conv_id", F.explode(F.transform("starts", window)).alias("w")).select("conv_id", "w.window", "w.shown")
    pieces = F.transform("shown", lambda t: F.struct(_rendered(t["marker"], t).alias("piece"), ((t["marker"] == NEW) & (t["role"] == "assistant")).alias("target"), F.length(t["text"]).alias("chars")))
    shown = shown.withColumn("pieces", pieces)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("loss"))

    def mark(a: Column, p: Column) -> Column:
        end = a["at"] + F.length(p["piece"])
        span = F.struct((end - len(END) - p["chars"]).alias("start"), p["chars"].alias("length"))
        return F.struct(end.alias("at"), F.when(p["target"], F.concat(a["loss"], F.array(span))).otherwise(a["loss"]).alias("loss"))

    return shown.select("conv_id", "window", F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"), F.aggregate("pieces", start, mark)["loss"].alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """The windows -> conv_id, turns (role, text) in order without repeats, and target: all text under the loss, unescaped."""
    turn = lambda p: F.struct(unescape(F.substring_index(F.substr(p, F.lit(len(NEW) + 1)), TEXT, 1)).alias("role"), unescape(F.substring_index(p, TEXT, -1)).alias("text"))
    parts = F.split("formatted", r"\Q" + END + r"\E")
    read = F.transform(F.filter(parts, lambda p: p.startswith(NEW)), turn)
    target = F.array_join(F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"]))), "")
    rows = formatted.select("conv_id", F.struct("window", read.alias("turns"), target.alias("target"), F.length("formatted").cast("long").alias("chars")).alias("w"))
    rows = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("w")).alias("w"))
    return rows.select(
        "conv_id",
        F.flatten(F.transform("w", lambda x: x["turns"])).alias("turns"),
        F.array_join(F.transform("w", lambda x: x["target"]), "").alias("target"),
        F.aggregate("w", F.lit(0).cast("long"), lambda a, x: a + x["chars"]).alias("formatted_chars"),
        F.size("w").cast("long").alias("n_windows"),
    )
