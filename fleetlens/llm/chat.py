"""Chat formatting in budgeted windows.

A conversation is laid out on a line of token costs by prefix sums. The line is cut into cells; the turns that start in a
cell form a span, and a turn larger than a cell forms a span of its own. A window holds the system turn, as many turns before
the span as fit the history budget, and the span. It stays within the budget unless a single turn (with the system turn) is larger.
Turns are never cut. The loss covers the assistant texts of the span, so each is a target once, however often it is repeated as history.

Long conversations: prefix sums run within blocks of turns first, then over block totals; the blocks' rows, spans and
windows are spread over tasks, and no conversation is gathered by ``windows``.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn. Control strings of common chat formats inside texts and roles get
a backslash after their first character (after any that are there), which ``unescape`` takes away again.

Defined results: NULL role and text are empty; NULL conv_id is one conversation; turns are ordered by turn (NULL first), then role,
then text, and repeated rows are repeated turns; the first system turn is the one retained, from its own window on; an empty
table gives no windows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetlens.llm.common import WORD

# The template's marks.
START, END = "<|im_start|>", "<|im_end|>\n"
# What follows the first character (and backslashes) of a control string: <|...|>, <s>, </s>, [INST], [/INST], <<SYS>>, <</SYS>>.
_CONTROL = r"(?=\||/?s>|/?INST\]|</?SYS>>)"

TURNS_PER_BLOCK = 256
# Tokens that the template itself costs per turn.
TURN_OVERHEAD = 4

KEY = ["conv_id", "cell", "big"]


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[]\\*)" + _CONTROL, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[]\\*)\\" + _CONTROL, "$1")


def escape_role(role: Column) -> Column:
    """Roles end at the first line break, so they must not hold one."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\e")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("\\n"), F.lit("\n")), F.lit("\\e"), F.lit("\\"))


def token_cost(text: Column) -> Column:
    """Words and template overhead: the default measure of a turn."""
    return F.regexp_count(text, F.lit(WORD)).cast("long") + TURN_OVERHEAD


def _beside(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equality join in which NULL keys meet."""
    side = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    condition = on[0]
    for c in on[1:]:
        condition = condition & c
    return left.join(side, condition, how).drop(*[f"_r_{k}" for k in keys])


def laid_out(turns: DataFrame, cost: Column | None = None) -> DataFrame:
    """Turns with ``cost``, ``start`` (cost of the turns before) and ``pos`` (their number)."""
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("cost", F.greatest(token_cost(F.col("text")) if cost is None else cost, F.lit(1)).cast("long"))
    rows = rows.withColumn("block", F.floor(F.col("turn") / TURNS_PER_BLOCK))
    blocks = rows.groupBy("conv_id", "block").agg(F.sum("cost").alias("_cost"), F.count(F.lit(1)).alias("_turns"))
    before = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.select(
        "conv_id", "block", F.coalesce(F.sum("_cost").over(before), F.lit(0)).alias("_start"),
        F.coalesce(F.sum("_turns").over(before), F.lit(0)).alias("_pos"))
    within = W.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    rows = rows.withColumns({
        "_in": F.coalesce(F.sum("cost").over(within.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)),
        "_nth": F.row_number().over(within) - 1,
    })
    return _beside(rows, blocks, ["conv_id", "block"]).select(
        "conv_id", "turn", "role", "text", "cost", (F.col("_start") + F.col("_in")).alias("start"),
        (F.col("_pos") + F.col("_nth")).cast("long").alias("pos"))


def windows(turns: DataFrame, budget: int = 2048, history: int = 256, cost: Column | None = None) -> DataFrame:
    """A row per window: conv_id, first_pos, n_context, n_turns, tokens, formatted, loss.

    ``turns``: conv_id, turn, role, text. ``n_context`` is the number of leading turns that only give context;
    ``loss`` lists (start, length) in code points of ``formatted`` that are training targets.
    """
    rows = laid_out(turns, cost)
    system = rows.where(F.col("role") == "system").groupBy("conv_id").agg(
        F.min(F.struct("pos", "cost")).alias("_s")).select("conv_id", F.col("_s.pos").alias("sys_pos"), F.col("_s.cost").alias("sys_cost"))
    room = F.floor((F.lit(budget - history) - F.coalesce("sys_cost", F.lit(0))) / 2)
    rows = _beside(rows, system, ["conv_id"], "left").withColumn("size", F.greatest(room, F.lit(1)).cast("long"))
    rows = rows.withColumns({"cell": F.floor(F.col("start") / F.col("size")), "big": F.col("cost") > F.col("size")})

    spans = rows.groupBy(*KEY).agg(F.min("start").alias("span_start"), F.min("pos").alias("span_pos"))
    # A turn belongs to its own span and may be history of the large turn in its cell and of the spans of the next cell.
    key = lambda cell, big: F.struct(cell.alias("cell"), big.alias("big"))
    cell, big = F.col("cell"), F.col("big")
    places = F.when(big, F.array(key(cell, big))).otherwise(F.array(
        key(cell, F.lit(False)), key(cell, F.lit(True)), key(cell + 1, F.lit(False)), key(cell + 1, F.lit(True))))
    own = (F.col("own_cell") == F.col("cell")) & (F.col("own_big") == F.col("big"))
    near = F.col("span_start") - F.col("start") <= F.least(F.lit(history), F.col("size"))
    placed = rows.withColumn("_place", F.explode(places)).withColumns(
        {"own_cell": cell, "own_big": big}).withColumns({"cell": F.col("_place.cell"), "big": F.col("_place.big")})
    placed = _beside(placed, spans, KEY).withColumn("kind", F.when(own, 2).otherwise(1)).where(
        own | (near & ~F.coalesce(F.col("pos") == F.col("sys_pos"), F.lit(False))))
    item = ["conv_id", "cell", "big", "kind", "pos", "role", "text", "cost"]
    sys_turn = rows.where(F.col("pos") == F.col("sys_pos")).select("conv_id", "pos", "role", "text", "cost")
    retained = _beside(spans, sys_turn, ["conv_id"]).where(F.col("pos") < F.col("span_pos")).withColumn("kind", F.lit(0))
    # The system turn of a span that starts with it is the span's own.
    items = placed.select(*item).unionByName(retained.select(*item))

    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    items = items.withColumns({"_head": head, "_body": escape(F.col("text"))})
    items = items.withColumn("_turn", F.concat("_head", "_body", F.lit(END)))
    at = W.partitionBy(*KEY).orderBy("kind", "pos").rowsBetween(W.unboundedPreceding, -1)
    items = items.withColumn(
        "_at", F.coalesce(F.sum(F.length("_turn")).over(at), F.lit(0)) + F.length("_head"))
    target = (F.col("kind") == 2) & (F.col("role") == "assistant")
    loss = F.when(target, F.struct(F.col("_at").cast("long").alias("start"), F.length("_body").cast("long").alias("length")))
    gathered = items.groupBy(*KEY).agg(
        F.min(F.when(F.col("kind") == 2, F.col("pos"))).alias("first_pos"),
        F.count(F.when(F.col("kind") < 2, 1)).alias("n_context"), F.count(F.lit(1)).alias("n_turns"), F.sum("cost").alias("tokens"),
        F.array_sort(F.collect_list(F.struct("kind", "pos", "_turn"))).alias("_items"),
        F.array_sort(F.collect_list(loss)).alias("loss"))
    formatted = F.array_join(F.transform("_items", lambda x: x["_turn"]), "")
    return gathered.select("conv_id", "first_pos", "n_context", "n_turns", "tokens", formatted.alias("formatted"), "loss")


def turns_of(formatted: Column) -> Column:
    """Read a formatted text: array of (role, text) as they were before formatting."""
    parts = F.slice(F.split(formatted, r"<\|im_start\|>", -1), F.lit(2), F.size(F.split(formatted, r"<\|im_start\|>", -1)))
    return F.transform(parts, lambda p: F.struct(
        unescape_role(F.substring_index(p, "\n", 1)).alias("role"),
        unescape(F.substr(
            p, F.instr(p, "\n") + 1, F.length(p) - F.instr(p, "\n") - len(END))).alias("text")))


def targets_of(formatted: Column, loss: Column) -> Column:
    """The texts under the loss mask, unescaped."""
    return F.transform(loss, lambda s: unescape(F.substr(formatted, s["start"].cast("int") + 1, s["length"].cast("int"))))


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from the windows alone: n_turns, all turns as text, all targets, and the formatted length."""
    rows = formatted.withColumns({
        "_all": turns_of(F.col("formatted")), "_targets": targets_of(F.col("formatted"), F.col("loss"))})
    rows = rows.withColumn("_new", F.slice("_all", F.col("n_context").cast("int") + 1, F.size("_all")))
    newline = F.lit("\n")
    rows = rows.select(
        "conv_id", "first_pos", F.size("_new").alias("n"), F.length("formatted").alias("chars"),
        F.array_join(F.transform("_new", lambda t: F.concat(t["role"], newline, t["text"], newline)), "").alias("turns"),
        F.array_join("_targets", "").alias("targets"))
    ordered = F.array_sort(F.collect_list(F.struct("first_pos", "turns", "targets")))
    return rows.groupBy("conv_id").agg(
        F.sum("n").cast("long").alias("n_turns"), F.sum("chars").cast("long").alias("formatted_chars"), ordered.alias("_w"),
    ).select(
        "conv_id", "n_turns", "formatted_chars",
        F.array_join(F.transform("_w", lambda w: w["turns"]), "").alias("turns"),
        F.array_join(F.transform("_w", lambda w: w["targets"]), "").alias("targets"))
