"""Chat formatting by quotation linking: who answers whom, found by what is quoted.

Only DataFrame functions run. Lines are read with their quote level; runs of one
level are passages. A passage's normalised text is hashed and joined with
the hashes of what messages say themselves, as a whole, by paragraph and by line. The
message that is quoted is the parent of the one that quotes; without a known
quote the parent is the turn before. Parents come earlier in (conversation,
turn) order, so following them ends at a thread's first message; steps double each
round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidyloom.llm.store import saved
from tidyloom.operators.ordered import difference_to_previous

_MARKS = r"^(?:[ \t]?>)+"
_ATTRIBUTION = r"(?i)(?:wrote|writes|said|schrieb|a écrit|escribió)\s*:\s*$"


def normalised(text: Column) -> Column:
    """Lower case, white space as single blanks."""
    return F.trim(F.regexp_replace(F.lower(text), r"[\s ]+", " "))


def _lines(messages: DataFrame) -> DataFrame:
    """Every line of the messages with quotes: place, level, and content behind the marks; passages are numbered."""
    each = messages.select("row", F.posexplode(F.split("text", "\r?\n")).alias("at", "line"))
    level = F.length(F.regexp_replace(F.regexp_extract("line", _MARKS, 0), "[^>]", ""))
    each = each.select("row", "at", level.alias("level"), F.regexp_replace("line", _MARKS + "[ \t]?", "").alias("content"))
    inside = Window.partitionBy("row").orderBy("at")
    following = F.lead("level").over(inside)
    attributed = (F.col("level") == 0) & (following > 0) & F.col("content").rlike(_ATTRIBUTION)
    changed = F.coalesce((F.col("level") != F.lag("level").over(inside)).cast("int"), F.lit(0))
    each = each.withColumns({"attributed": F.coalesce(attributed, F.lit(False)), "changed": changed})
    return each.withColumn("passage", F.sum("changed").over(inside.rowsBetween(Window.unboundedPreceding, 0)))


def _joined(content: str = "content") -> Column:
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", content))), lambda line: line[content]), "\n")


def _hashed(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


def linked_conversations(
    messages: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Each message with its parent, its thread and its text without quotes.

    Columns: conversation, turn and role as given; ``n_quotes`` quoted passages
    and ``n_linked`` of them found; ``parent_conv``, ``parent_turn``;
    ``thread_conv``, ``thread_turn``: the first message of the thread;
    ``depth``: steps from it; ``text`` without quotes and their attribution.
    Ordered by (thread_conv, thread_turn, depth, conversation, turn), every
    message follows its parent.

    A quote is looked for in earlier turns of its conversation, then in the
    first conversation that says it. Of several quotes the least nested decides, then
    the longest.

    Defined cases: a null text is empty; an empty quote is no passage; rows with
    one conversation and turn are one place in the thread and are all returned; a
    row without conversation or turn has no parent and no thread and is never quoted; an empty
    table gives no row. Other columns are ignored.
    """
    rows = messages.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(conversation).alias("conv"),
        F.col(turn).alias("turn"),
        F.col(role).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    rows = saved(rows.withColumn("quoting", F.col("text").rlike("(?m)" + _MARKS)), "messages")
    nodes = saved(rows.where(F.col("conv").isNotNull() & F.col("turn").isNotNull()).select("conv", "turn").distinct(), "nodes")
    lines = saved(_lines(rows.where("quoting")), "lines")
    own = lines.where((F.col("level") == 0) & ~F.col("attributed")).groupBy("row").agg(_joined().alias("own"))
    own = rows.where("quoting").select("row").join(own, "row", "left").select("row", F.trim(F.regexp_replace(F.coalesce("own", F.lit("")), r"\n{3,}", "\n\n")).alias("own"))
    own = saved(own, "own")
    runs = lines.where("level > 0").groupBy("row", "passage", "level").agg(_joined().alias("content"))
    quotes = runs.unionByName(lines.where("level > 0").select("row", "passage", "level", "content"))
    quotes = quotes.withColumn("content", normalised(F.col("content"))).where("content <> ''")
    quotes = quotes.select("row", "passage", "level", F.length("content").alias("size"), F.sha2("content", 256).alias("hash")).distinct()
    quotes = saved(quotes.join(rows.select("row", "conv", "turn"), "row"), "quotes")
    texts = rows.where(F.col("conv").isNotNull() & F.col("turn").isNotNull()).join(own, "row", "left")
    texts = texts.select("conv", "turn", F.when(F.col("quoting"), F.col("own")).otherwise(F.col("text")).alias("said"))
    said = texts.select("conv", "turn", F.explode(F.array_distinct(F.concat(F.array("said"), F.split("said", r"\n[ \t\r]*\n"), F.split("said", "\r?\n")))).alias("part"))
    wanted = saved(quotes.select("hash").distinct(), "wanted")
    originals = said.select("conv", "turn", _hashed(F.col("part")).alias("hash")).join(wanted, "hash", "left_semi")
    # The first turn of each conversation that says it, and the first conversation: a common passage is one row for each.
    originals = saved(originals.groupBy("hash", "conv").agg(F.min("turn").alias("turn")), "originals")
    here = originals.select("hash", "conv", F.col("turn").alias("p_turn"))
    found = quotes.join(here, ["hash", "conv"]).where("p_turn < turn").withColumn("p_conv", F.col("conv"))
    first = originals.groupBy("hash").agg(F.min("conv").alias("conv")).join(originals, ["hash", "conv"])
    first = saved(first.select("hash", F.col("conv").alias("p_conv"), F.col("turn").alias("p_turn")), "first")
    elsewhere = quotes.join(first, "hash").where("p_conv < conv")
    columns = ["row", "conv", "turn", "passage", "level", "size", "p_conv", "p_turn"]
    found = saved(found.select(*columns, F.lit(0).alias("far")).unionByName(elsewhere.select(*columns, F.lit(1).alias("far"))), "found")
    best = found.groupBy("conv", "turn").agg(F.min(F.struct("level", "far", (-F.col("size")).alias("size"), "p_conv", "p_turn")).alias("best"))
    before = difference_to_previous(nodes, ["conv"], [F.col("turn")], F.col("turn"), "step")
    before = saved(before.select("conv", "turn", (F.col("turn") - F.col("step")).alias("previous")), "before")
    parents = before.join(best, ["conv", "turn"], "left").select(
        "conv",
        "turn",
        F.when(F.col("best").isNotNull(), F.col("best.p_conv")).when(F.col("previous").isNotNull(), F.col("conv")).alias("p_conv"),
        F.coalesce("best.p_turn", "previous").alias("p_turn"),
    )
    parents = saved(parents, "parents")
    threads = saved(_threads(parents), "threads")
    counts = quotes.groupBy("row").agg(F.count_distinct("passage").alias("n_quotes"))
    counts = counts.join(found.groupBy("row").agg(F.count_distinct("passage").alias("n_linked")), "row", "left")
    marked = saved(own.join(counts, "row", "left"), "marked")
    out = rows.join(threads, ["conv", "turn"], "left").join(marked, "row", "left")
    return out.select(
        F.col("conv").alias(conversation),
        F.col("turn").alias(turn),
        F.col("role").alias(role),
        F.coalesce("n_quotes", F.lit(0)).cast("long").alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        F.col("p_conv").alias("parent_conv"),
        F.col("p_turn").alias("parent_turn"),
        F.col("root_conv").alias("thread_conv"),
        F.col("root_turn").alias("thread_turn"),
        "depth",
        F.when(F.col("quoting"), F.col("own")).otherwise(F.col("text")).alias(text),
    )


def _threads(parents: DataFrame) -> DataFrame:
    """The first message above each, and the steps to it; each round doubles the steps of what is still under way."""
    root = F.col("p_turn").isNull()
    state = parents.select(
        "conv",
        "turn",
        F.when(root, F.col("conv")).otherwise(F.col("p_conv")).alias("up_conv"),
        F.when(root, F.col("turn")).otherwise(F.col("p_turn")).alias("up_turn"),
        F.when(root, 0).otherwise(1).cast("long").alias("depth"),
    )
    state = saved(state, "steps")
    done, active = state.where("depth = 0"), state.where("depth > 0")
    while not active.isEmpty():
        above = state.select(F.col("conv").alias("up_conv"), F.col("turn").alias("up_turn"), F.col("up_conv").alias("to_conv"), F.col("up_turn").alias("to_turn"), F.col("depth").alias("more"))
        moved = active.join(above, ["up_conv", "up_turn"])
        moved = saved(moved.select("conv", "turn", F.col("to_conv").alias("up_conv"), F.col("to_turn").alias("up_turn"), (F.col("depth") + F.col("more")).alias("depth"), (F.col("more") == 0).alias("ended")), "steps")
        done = done.unionByName(moved.where("ended").drop("ended"))
        active = moved.where(~F.col("ended")).drop("ended")
        state = done.unionByName(active)
    names = parents.select("conv", "turn", "p_conv", "p_turn")
    return names.join(done.withColumnsRenamed({"up_conv": "root_conv", "up_turn": "root_turn"}), ["conv", "turn"])
