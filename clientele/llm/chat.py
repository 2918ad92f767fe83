"""Chat formatting into budgeted windows, with DataFrame functions only.

A conversation is cut into windows of whole turns. Prefix sums of turn tokens
place each turn in a cell of the budget; turns that start and end in a cell
share a window, a turn that crosses the end of its cell has one of its own.
The leading system turn stands at the head of every window, the turns just
before a window are repeated in it as history, limited by what its budget
leaves, and both are left out of
the loss there: every assistant turn is a target exactly once.

Windows are found without ever having a conversation in one task: turns are
summed in blocks of consecutive turn numbers, and what is grouped is a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BUDGET = 1024
HISTORY = 256
#: Turn numbers of one block of the prefix sums.
BLOCK = 64

OPEN, CLOSE = "### ", "</turn>\n"
#: Tokens that the marks of a turn are counted as.
MARKS = 6
TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]"


def escape(text: Column) -> Column:
    r"""Take the control strings out of a text.

    ``\`` becomes ``\b``, ``</turn>`` becomes ``<\/turn>`` and ``### `` becomes
    ``#\## ``. Each backslash is then followed by the letter that tells which
    it was, so ``unescape`` gives the text back exactly.
    """
    text = F.replace(text, F.lit("\\"), F.lit("\\b"))
    text = F.replace(text, F.lit("</turn>"), F.lit("<\\/turn>"))
    return F.replace(text, F.lit("### "), F.lit("#\\## "))


def unescape(text: Column) -> Column:
    text = F.replace(text, F.lit("#\\## "), F.lit("### "))
    text = F.replace(text, F.lit("<\\/turn>"), F.lit("</turn>"))
    return F.replace(text, F.lit("\\b"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(":"), F.lit("\\c"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\c"), F.lit(":")))


def head(role: Column) -> Column:
    return F.concat(F.lit(OPEN), escape_role(role), F.lit(": "))


def chat_windows(
    turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, target: str = "assistant"
) -> DataFrame:
    """One row per window: ``conv_id``, ``window``, ``formatted``, ``context_turns``, ``loss``, ``tokens``.

    ``turns`` has ``conv_id``, ``turn``, ``role``, ``text``; other columns do not
    matter. Windows are in order of ``window``, which has gaps. The first
    ``context_turns`` turns of a window are repeated from earlier windows.
    ``loss`` has the spans (start, length in code points of ``formatted``) of the
    escaped texts of the targets. A window has no more than ``budget`` tokens
    unless the system turn with one other turn exceed it; turns are never cut.
    A null text or role is empty, null conversations are one conversation, null
    turns come first, equal turns are ordered by role, then text; repeated rows
    are turns like others. An empty table has no windows.
    """
    clean = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumns(
        {
            "block": F.floor(F.col("turn") / BLOCK),
            "tokens": F.regexp_count("text", F.lit(TOKEN)).cast("long") + MARKS,
        }
    )
    earlier = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = (
        clean.groupBy("conv_id", "block")
        .agg(F.sum("tokens").alias("sum"), F.min(F.struct("turn", "role", "text")).alias("top"))
        .withColumns(
            {
                "base": F.coalesce(F.sum("sum").over(earlier), F.lit(0)),
                "top": F.first("top").over(W.partitionBy("conv_id").orderBy("block")),
            }
        )
        .select(
            F.col("conv_id").alias("of"),
            F.col("block").alias("of_block"),
            "base",
            F.when(F.col("top.role") == "system", F.col("top.text")).alias("system"),
        )
    )
    inside = W.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    upto = inside.rowsBetween(W.unboundedPreceding, -1)
    system_tokens = F.coalesce(
        F.regexp_count("system", F.lit(TOKEN)).cast("long") + MARKS, F.lit(0)
    )
    least = F.lit(max(1, budget // 4))
    beside = F.when(system_tokens < budget, F.least(least, F.lit(budget) - system_tokens)).otherwise(least)
    stride = F.greatest(F.lit(budget - history) - system_tokens, beside)
    placed = (
        clean.withColumn("inside", F.coalesce(F.sum("tokens").over(upto), F.lit(0)))
        .join(
            blocks,
            F.col("conv_id").eqNullSafe(F.col("of"))
            & F.col("block").eqNullSafe(F.col("of_block")),
        )
        .withColumn("start", F.col("base") + F.col("inside"))
        .withColumn("stride", stride)
        .withColumn("cell", F.floor(F.col("start") / F.col("stride")))
        .withColumn(
            "window",
            2 * F.col("cell")
            + F.when(
                F.col("start") + F.col("tokens") > (F.col("cell") + 1) * F.col("stride"), 1
            ).otherwise(0),
        )
        .select("conv_id", "window", "start", "tokens", "role", "text", "system")
    )
    is_system = F.col("system").isNotNull() & (F.col("start") == 0)
    windows = (
        placed.groupBy("conv_id", "window")
        .agg(F.min("start").alias("first"), F.sum("tokens").alias("owned"), F.first("system").alias("system"))
        .withColumn("left", F.lit(budget) - F.col("owned") - F.when(F.col("first") > 0, system_tokens).otherwise(0))
        .select(
            F.col("conv_id").alias("in_conv"),
            F.col("window").alias("in_window"),
            "first",
            F.greatest(F.lit(0), F.least(F.lit(history), "left")).alias("history"),
            "system",
        )
    )
    piece = ["conv_id", "window", "start", "tokens", "role", "text", "fresh"]
    own = placed.withColumn("fresh", F.lit(True)).select(piece)
    # a window begins at most `history` tokens after a turn that it repeats
    near = F.floor(F.col("start") / history)
    repeated = (
        placed.where(~is_system)
        .drop("window", "system")
        .withColumn("reach", F.explode(F.array(near, near + 1)))
        .join(
            windows.drop("system").withColumn("reached", F.floor(F.col("first") / history)),
            F.col("conv_id").eqNullSafe(F.col("in_conv")) & (F.col("reach") == F.col("reached")),
        )
        .where((F.col("start") < F.col("first")) & (F.col("start") >= F.col("first") - F.col("history")))
        .withColumns({"window": F.col("in_window"), "fresh": F.lit(False)})
        .select(piece)
    )
    systems = windows.where(F.col("system").isNotNull() & (F.col("first") > 0)).select(
        F.col("in_conv").alias("conv_id"),
        F.col("in_window").alias("window"),
        F.lit(0).cast("long").alias("start"),
        (F.regexp_count("system", F.lit(TOKEN)) + MARKS).cast("long").alias("tokens"),
        F.lit("system").alias("role"),
        F.col("system").alias("text"),
        F.lit(False).alias("fresh"),
    )
    told = own.unionByName(repeated).unionByName(systems).withColumn(
        "turn", F.concat(head(F.col("role")), escape(F.col("text")), F.lit(CLOSE))
    )
    entry = F.struct(
        "start",
        "turn",
        F.length(head(F.col("role"))).alias("skip"),
        F.length("turn").alias("long"),
        F.col("fresh").alias("fresh"),
        (F.col("fresh") & (F.col("role") == target)).alias("learn"),
    )
    joined = told.groupBy("conv_id", "window").agg(
        F.array_sort(F.collect_list(entry)).alias("list"), F.sum("tokens").alias("tokens")
    )
    spans = F.aggregate(
        "list",
        F.struct(
            F.lit(0).alias("at"),
            F.array().cast("array<struct<start:int,length:int>>").alias("loss"),
        ),
        lambda seen, x: F.struct(
            (seen["at"] + x["long"]).alias("at"),
            F.when(
                x["learn"],
                F.concat(
                    seen["loss"],
                    F.array(
                        F.struct(
                            (seen["at"] + x["skip"]).alias("start"),
                            (x["long"] - x["skip"] - len(CLOSE)).alias("length"),
                        )
                    ),
                ),
            )
            .otherwise(seen["loss"])
            .alias("loss"),
        ),
        lambda seen: seen["loss"],
    )
    return joined.select(
        "conv_id",
        "window",
        F.array_join(F.transform("list", lambda x: x["turn"]), "").alias("formatted"),
        F.size(F.filter("list", lambda x: ~x["fresh"])).alias("context_turns"),
        spans.alias("loss"),
        "tokens",
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted window, read back: array of (role, text)."""
    marked = F.slice(
        F.split(formatted, F.lit(CLOSE)), 1, F.size(F.split(formatted, F.lit(CLOSE))) - 1
    )

    def turn(one: Column) -> Column:
        role = F.substring_index(one, ": ", 1)
        return F.struct(
            unescape_role(F.substring(role, len(OPEN) + 1, 2147483647)).alias("role"),
            unescape(F.substr(one, F.length(role) + 3)).alias("text"),
        )

    return F.transform(marked, turn)


def read_loss(formatted: Column, loss: Column) -> Column:
    """The unescaped texts under the loss mask: array of strings."""
    return F.transform(
        loss, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["length"]))
    )
