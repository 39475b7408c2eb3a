"""Conversations as training texts, in windows of a token budget.

Every turn becomes ``<s>role[INST]text</s>``. In roles and texts each of the
characters < [ \\ is followed by a backslash, so no control string can arise inside
them, and taking the backslashes out again restores them exactly.

Running sums of the turns' tokens cut a conversation into windows at turns. They are
laid over slots of equal room: the turns that end in the slot they start in are one
window; a turn over a slot's border begins another, with the next slot's turns if they
fit its room. A window starts with the system turn and repeats the turns before it that
fit the history limit and leave the budget; both are masked, as is everything but the
texts of its own assistant turns. So every assistant text is a target once. A turn is
never cut: only a single turn of its own that exceeds the budget next to the system
turn makes a window longer, and then nothing else is repeated.

All of it is DataFrame functions. Running sums are taken in blocks of turn numbers
whose totals are summed in turn, and texts are put together per window, so a very
long conversation is spread as well. Only :func:`read_back`'s digests need a whole
conversation in one place, because they hash it as one string.

Defined results: a null text or role is empty; turns come in the order of their
number, then of role and text (a null number first); rows repeated in full are turns
of their own; rows without a conversation id are one conversation. An empty table
gives no window.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evlake.llm.common import NO_ID, stored

BUDGET = 512
#: Tokens of earlier turns a window may repeat.
HISTORY = 128
#: Tokens the marks of a turn count as.
MARKS = 3
BLOCK_TURNS = 256

#: The template: what opens a turn, follows its role and ends it.
OPEN, AFTER_ROLE, END = "<s>", "[INST]", "</s>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])", r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])\\", "$1")


def _turns(conversations: DataFrame) -> DataFrame:
    text, role = F.coalesce("text", F.lit("")), F.coalesce(F.col("role").cast("string"), F.lit(""))
    piece = F.concat(F.lit(OPEN), escaped(role), F.lit(AFTER_ROLE), escaped(text), F.lit(END))
    return conversations.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_ID)).alias("conv"),
        F.coalesce(F.col("turn").cast("long"), F.lit(NO_ID)).alias("turn"),
        role.alias("role"),
        piece.alias("piece"),
        (F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")) + MARKS).cast("long").alias("tokens"),
        # Where the text lies in its piece.
        (F.char_length(escaped(role)) + len(OPEN) + len(AFTER_ROLE)).alias("text_at"),
        F.char_length(piece).alias("length"),
    ).withColumn("block", F.floor(F.col("turn") / BLOCK_TURNS))


def _placed(turns: DataFrame, budget: int, history: int) -> tuple[DataFrame, DataFrame]:
    """Turns with their window, and one row per window that has turns of its own. A window
    is called by the tokens before it."""
    first = F.min("turn").over(Window.partitionBy("conv"))
    blocks = turns.groupBy("conv", "block").agg(F.min("turn").alias("turn")).withColumn("first", first)
    known = turns.join(blocks.select("conv", "block", "first"), ["conv", "block"])
    known = known.withColumn("system", (F.col("role") == "system") & (F.col("turn") == F.col("first")))
    own = F.when(~F.col("system"), F.col("tokens")).otherwise(0)
    totals = known.groupBy("conv", "block").agg(
        F.sum(own).alias("own"), F.sum(F.when(F.col("system"), F.col("tokens")).otherwise(0)).alias("system_tokens")
    )
    conv = Window.partitionBy("conv")
    before = conv.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    space = F.greatest(F.lit(budget) - F.sum("system_tokens").over(conv), F.lit(1))
    totals = totals.select(
        "conv", "block", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("offset"),
        # Without history where the system turn leaves little.
        F.when(space >= 2 * history + 1, space - history).otherwise(space).alias("room"), space.alias("space"),
    )
    order = Window.partitionBy("conv", "block").orderBy("turn", "role", "piece")
    inside = F.coalesce(F.sum(own).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    known = known.withColumn("inside", inside).withColumn("number", F.row_number().over(order))
    known = known.join(totals, ["conv", "block"]).withColumn("start", F.col("offset") + F.col("inside"))
    slot, last = (F.floor(F.col(c) / F.col("room")) for c in ("start", "last"))
    known = known.withColumn("last", F.col("start") + F.col("tokens") - 1)
    known = known.withColumn("part_no", 2 * slot + (slot != last).cast("int"))
    known = stored(known.drop("offset", "inside", "first", "last"), "turns")
    parts = known.where("not system").groupBy("conv", "part_no").agg(
        F.min("start").alias("begins"), F.sum("tokens").alias("own"), F.max("room").alias("room"), F.max("space").alias("space")
    )
    following = conv.orderBy("part_no")
    # A slot's turns go with the turn over the border before it if both fit.
    before = {c: F.lag(c).over(following) for c in ("part_no", "own", "begins")}
    joins = (F.col("part_no") % 2 == 0) & (before["part_no"] == F.col("part_no") - 1) & (before["own"] + F.col("own") <= F.col("room"))
    parts = stored(parts.withColumn("window", F.when(joins, before["begins"]).otherwise(F.col("begins"))), "parts")
    windows = parts.groupBy("conv", "window").agg(
        F.greatest(F.least(F.lit(history), F.max("space") - F.sum("own")), F.lit(0)).alias("limit")
    )
    windows = windows.withColumn("no", F.row_number().over(conv.orderBy("window")))
    # The windows near enough to repeat a turn; a window's turns begin within the budget.
    near = conv.orderBy("window").rangeBetween(1, budget + history)
    windows = windows.withColumn("after", F.collect_list(F.struct("window", "limit")).over(near))
    return known.join(parts.select("conv", "part_no", "window"), ["conv", "part_no"], "left"), windows


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """The training texts: conv, window, formatted, loss (code-point spans of the text
    that counts for the loss) and repeated (length of what earlier windows had)."""
    turns, every = _placed(_turns(conversations), budget, history)
    known = turns.where("not system").join(every, ["conv", "window"])
    near = F.filter("after", lambda w: w["window"] - F.col("start") <= w["limit"])
    again = F.transform(near, lambda w: F.struct(w["window"].alias("window"), F.lit(1).alias("part")))
    place = F.concat(F.array(F.struct(F.col("window"), F.lit(2).alias("part"))), again)
    shown = ["conv", "window", "part", "first_window", "turn", "block", "number", "role", "piece", "text_at", "length"]
    ordinary = (
        known.withColumn("place", F.explode(place)).withColumn("window", F.col("place.window"))
        .withColumn("part", F.col("place.part")).withColumn("first_window", F.lit(None).cast("boolean")).select(*shown)
    )
    # The system turn goes into each window of its conversation.
    system = turns.where("system").drop("window").join(every.select("conv", "window", "no"), "conv", "left")
    system = system.withColumn("window", F.coalesce("window", F.lit(0))).withColumn("part", F.lit(0))
    system = system.withColumn("first_window", F.coalesce("no", F.lit(1)) == 1).select(*shown)
    rows = ordinary.unionByName(system)
    order = Window.partitionBy("conv", "window").orderBy("part", "block", "turn", "number")
    before = F.coalesce(F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("at", before).withColumn("no", F.row_number().over(order))
    target = (F.col("part") == 2) & (F.col("role") == "assistant")
    begin = F.col("at") + F.col("text_at")
    span = F.struct(begin.alias("start"), (F.col("at") + F.col("length") - len(END)).alias("end"))
    earlier = (F.col("part") == 1) | ((F.col("part") == 0) & ~F.col("first_window"))
    return rows.groupBy("conv", "window").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("no", "piece"))), lambda x: x["piece"]), ""
        ).alias("formatted"),
        F.array_sort(F.collect_list(F.when(target, span))).alias("loss"),
        F.sum(F.when(earlier, F.col("length")).otherwise(0)).alias("repeated"),
    )


def read_back(made: DataFrame) -> DataFrame:
    """One row per conversation, all of it taken from the windows' texts and masks."""
    under_mask = F.transform(
        "loss", lambda s: unescaped(F.substring("formatted", (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    )
    own = made.select(
        "conv",
        F.struct(
            "window",
            F.expr("substring(formatted, cast(repeated AS int) + 1)").alias("own"),
            F.array_join(under_mask, "").alias("loss"),
        ).alias("w"),
        F.char_length("formatted").alias("chars"),
    )
    whole = own.groupBy("conv").agg(F.array_sort(F.collect_list("w")).alias("ws"), F.sum("chars").alias("formatted_chars"))
    text = F.array_join(F.transform("ws", lambda w: w["own"]), "")
    turns = F.slice(F.split(text, END, -1), 1, F.greatest(F.size(F.split(text, END, -1)) - 1, F.lit(0)))

    def plain(turn: Column) -> Column:
        role = F.substring_index(turn, AFTER_ROLE, 1)
        rest = F.substring(turn, F.char_length(role) + len(AFTER_ROLE) + 1, F.char_length(turn))
        return F.concat(unescaped(F.substring(role, F.lit(len(OPEN) + 1), F.char_length(role))), F.lit("\n"), unescaped(rest), F.lit("\n"))

    loss = F.array_join(F.transform("ws", lambda w: w["loss"]), "")
    return whole.select(
        F.when(F.col("conv") != NO_ID, F.col("conv")).alias("conv_id"),
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform(turns, plain), "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )
