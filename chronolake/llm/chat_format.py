"""Chat formatting of reply trees, in DataFrame operations only.

A message replies to its parent. Iterative self-joins double the distance that every message sees: after
k rounds it knows the ancestor 2^k replies above it, the replies and the score in between. The logarithm
of the deepest branch bounds the rounds, and each moves one short row a message. Leaves are ranked within
their tree by the mean score of their branch; the chosen ones walk down the same jump tables, from the
longest to the shortest, which names every message of a branch once. Texts join at the end only.

The template is ``<|im_start|>role\\ntext<|im_end|>\\n``. In texts ``<|`` gets a backslash before the bar, and
where backslashes stand between the two already, one more; so no control string is left in a text and the
way back is exact. Roles are percent-encoded. The output keeps its segments, those with ``loss`` being the
assistant's texts: that is the loss mask, and all segments together are the formatted string.

Defined cases: null texts and roles are empty; a parent that is null or missing makes a root; of repeated
message ids one stays, the smallest row; messages on a cycle of parents, or below one, have no root and
are left out; rows without conversation id are one conversation; ties in score go to the smaller leaf;
an empty table gives an empty result; other columns are ignored; very long texts stay whole. A conversation is one value of the
result, so its own size, not the table's, has to fit a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .._spark import checkpoint

START, END = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", "<$1|")


def reply_chain(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Messages of plain conversations: every turn replies to the one before; equal turns go by role and text."""
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    at = F.row_number().over(Window.partitionBy("conv").orderBy("turn", "role", "text")).cast("long")
    return rows.select("conv", at.alias("node"), (at - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def _jumps(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Each message with its root, depth and branch score; and the tables of 2^k-fold ancestors."""
    parents = nodes.select(F.col("conv").alias("p_conv"), F.col("node").alias("p_node"))
    found = nodes.join(parents, nodes["conv"].eqNullSafe(parents["p_conv"]) & (nodes["parent"] == parents["p_node"]), "left")
    state = checkpoint(found.select("conv", "node", F.col("p_node").alias("up"), F.lit(1).cast("long").alias("depth"), F.col("score").alias("total"), F.col("node").alias("root")))
    most = state.groupBy("conv").count().agg(F.max("count")).first()[0] or 0
    # messages that have reached their root take no further part but as targets
    done, climbing, tables = state.where("up IS NULL"), state.where("up IS NOT NULL"), []
    while climbing.limit(1).count():
        tables.append(climbing.select("conv", "node", "up"))
        if 2 ** (len(tables) - 1) > most:  # longer than any branch: what is left goes round
            break
        above = done.unionAll(climbing).select(*[F.col(c).alias(f"a_{c}") for c in state.columns])
        both = climbing.join(above, F.col("conv").eqNullSafe(F.col("a_conv")) & (F.col("up") == F.col("a_node")))
        moved = checkpoint(both.select("conv", "node", F.col("a_up").alias("up"), (F.col("depth") + F.col("a_depth")).alias("depth"), (F.col("total") + F.col("a_total")).alias("total"), F.col("a_root").alias("root")))
        done, climbing = done.unionAll(moved.where("up IS NULL")), moved.where("up IS NOT NULL")
    return done.drop("up"), tables


def branches(nodes: DataFrame, most: int = 1) -> DataFrame:
    """(conv, branch, leaf, rank, score, place, node): the messages of the ``most`` best branches of each tree, root first."""
    nodes = nodes.select("conv", "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    nodes = checkpoint(nodes.groupBy("conv", "node").agg(F.min(F.struct("parent", "score")).alias("m")).select("conv", "node", "m.parent", "m.score"))
    reached, tables = _jumps(nodes)
    replied = nodes.select(F.col("conv").alias("r_conv"), F.col("parent").alias("r_node")).where("r_node IS NOT NULL").distinct()
    leaves = reached.join(replied, reached["conv"].eqNullSafe(replied["r_conv"]) & (reached["node"] == replied["r_node"]), "left_anti")
    score = F.col("total") / F.col("depth")
    rank = F.row_number().over(Window.partitionBy("conv", "root").orderBy(score.desc(), "node"))
    chosen = leaves.withColumn("rank", rank).where(F.col("rank") <= most).select("conv", F.col("node").alias("leaf"), "root", "rank", score.alias("score"), "depth")
    walk = checkpoint(chosen.select("conv", "leaf", F.col("leaf").alias("node"), F.lit(0).cast("long").alias("up")))
    for k, table in reversed(list(enumerate(tables))):
        jump = table.select(F.col("conv").alias("j_conv"), F.col("node").alias("j_node"), F.col("up").alias("j_up"))
        further = walk.join(jump, walk["conv"].eqNullSafe(jump["j_conv"]) & (walk["node"] == jump["j_node"]))
        walk = checkpoint(walk.unionAll(further.select("conv", "leaf", F.col("j_up").alias("node"), F.col("up") + 2**k)))
    ends = chosen.select(F.col("conv").alias("c_conv"), F.col("leaf").alias("c_leaf"), "root", "rank", "score", "depth")
    return walk.join(ends, walk["conv"].eqNullSafe(ends["c_conv"]) & (walk["leaf"] == ends["c_leaf"])).select("conv", "root", "leaf", "rank", "score", (F.col("depth") - F.col("up")).alias("place"), "node")


def format_chats(nodes: DataFrame, most: int = 1, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(conv_id, root, rank, score, formatted, segments) for each chosen branch.

    ``nodes`` has conv, node, parent, role, text, score; ``segments`` is array<struct<text, loss>>.
    """
    texts = nodes.groupBy("conv", "node").agg(F.min(F.struct("parent", "score", "role", "text")).alias("m"))
    texts = texts.select(F.col("conv").alias("t_conv"), F.col("node").alias("t_node"), F.coalesce("m.role", F.lit("")).alias("role"), F.coalesce("m.text", F.lit("")).alias("text"))
    paths = branches(nodes, most)
    rows = paths.join(texts, paths["conv"].eqNullSafe(texts["t_conv"]) & (paths["node"] == texts["t_node"]))
    head, body, tail = F.concat(F.lit(START), F.url_encode("role"), F.lit("\n")), escape(F.col("text")), F.lit(END)

    def segment(text: Column, loss: bool) -> Column:
        return F.struct(text.alias("text"), F.lit(loss).alias("loss"))

    own = F.when(F.col("role").isin(*loss_roles), F.array(segment(head, False), segment(body, True), segment(tail, False))).otherwise(F.array(segment(F.concat(head, body, tail), False)))
    turns = F.array_sort(F.collect_list(F.struct("place", own.alias("segments"))))
    chats = rows.groupBy("conv", "root", "leaf", "rank", "score").agg(F.flatten(F.transform(turns, lambda t: t["segments"])).alias("segments"))
    formatted = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    return chats.select(F.col("conv").alias("conv_id"), "root", "rank", "score", formatted.alias("formatted"), "segments")


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted chat."""
    chunks = F.filter(F.split(formatted, r"<\|im_start\|>", -1), lambda _, i: i > 0)

    def turn(chunk: Column) -> Column:
        role = F.substring_index(chunk, "\n", 1)
        text = F.substring(chunk, F.char_length(role) + 2, F.char_length(chunk) - F.char_length(role) - 1 - len(END))
        return F.struct(F.url_decode(role).alias("role"), unescape(text).alias("text"))

    return F.transform(chunks, turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
