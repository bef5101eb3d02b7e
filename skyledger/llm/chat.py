"""Chat formatting of reply trees (operator 8), with DataFrame operations only.

Messages name their parent. Pointer tables are joined with themselves: after round k a message knows its ancestor 2^k
steps up, its distance and the score in between, so a tree of depth d takes log2(d) rounds. Leaves are ranked by the score
of their path within the tree, and the pointer tables, walked from the largest step to the smallest, list the messages of
each chosen path; the rows of a path double each time. Only ids and numbers travel until the texts are joined at the end.

A turn is written `<|turn|>role`, a line break, the text and `<|end|>`. Control strings inside texts (these two and any
`<|name|>`, `<s>`, `</s>`, `[INST]`, `[/INST]`) get a backslash after their first character, and one more if they have some
there already, which is undone without loss. The loss mask lists the texts of the assistant by code point.

Defined cases: null text and null role are empty; a message whose parent is missing is a root; equal scores rank by leaf;
parents in a circle raise an error; a null tree is a tree of its own; an empty table gives an empty result; further columns
of any name do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.sources.tables import stage

TURN, END = "<|turn|>", "<|end|>"
CONTROL = r"(\|\w+\|>|/?s>|/?INST\])"
ASSISTANT = "assistant"
MOST_ROUNDS = 40


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + CONTROL, r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)\\" + CONTROL, "$1$2$3")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def linear_messages(turns: DataFrame) -> DataFrame:
    """Conversations without branches as trees: the parent of a message is the one before it, by turn, role and text."""
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    placed = turns.select("conv_id", "role", "text", place.alias("node"))
    return placed.select(F.col("conv_id").alias("tree"), "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(1.0).alias("score"))


def key(tree: Column, node: Column) -> Column:
    return F.when(node.isNotNull(), F.concat_ws("/", F.coalesce(tree.cast("string"), F.lit("null")), node.cast("string")))


def pointer_tables(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """From (id, up, score): for each k a table (id, up, steps, score) of ancestors 2^k up, and at the end every id's
    depth and the score of its path from the root."""
    tables = []
    state = stage(nodes.select("id", "up", F.when(F.col("up").isNull(), 0).otherwise(1).alias("steps"), "score"), "pointers")
    while state.where("up IS NOT NULL").limit(1).count():
        if len(tables) == MOST_ROUNDS:
            raise ValueError("messages form a circle of parents")
        tables.append(state.where("up IS NOT NULL").select("id", "up"))
        over = state.select(F.col("id").alias("at"), F.col("up").alias("next"), F.col("steps").alias("more"), F.col("score").alias("gain"))
        going = state.where("up IS NOT NULL").join(over, F.col("up") == F.col("at"))
        going = going.select("id", F.col("next").alias("up"), (F.col("steps") + F.col("more")).alias("steps"), (F.col("score") + F.col("gain")).alias("score"))
        state = stage(going.union(state.where("up IS NULL")), "pointers")
    return tables, state.select("id", F.col("steps").alias("depth"), "score")


def paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(leaf, rank, score, id, back): the messages of the best paths of each tree, `back` steps before the leaf."""
    named = messages.select(F.col("tree").cast("string").alias("tree"), key(F.col("tree"), F.col("node")).alias("id"), key(F.col("tree"), F.col("parent")).alias("parent"), F.col("score").cast("double").alias("score"))
    named = stage(named, "messages")
    there = named.select(F.col("id").alias("up"))
    nodes = named.join(there, named.parent == there.up, "left").select("tree", "id", "up", F.coalesce("score", F.lit(0.0)).alias("score"))
    tables, ends = pointer_tables(nodes)
    parents = nodes.where("up IS NOT NULL").select("up").distinct()
    leaves = nodes.select("tree", "id").join(parents, F.col("id") == F.col("up"), "left_anti").join(ends, "id")
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), "id"))
    walked = leaves.withColumn("rank", rank).where(F.col("rank") <= branches).select(F.col("id").alias("leaf"), "rank", "score", "id", F.lit(0).alias("back"))
    for k in reversed(range(len(tables))):
        walked = stage(walked, "paths")
        up = tables[k].select(F.col("id").alias("at"), "up")
        above = walked.join(up, F.col("id") == F.col("at")).select("leaf", "rank", "score", F.col("up").alias("id"), (F.col("back") + 2**k).alias("back"))
        walked = walked.union(above)
    return stage(walked, "paths")


def format_conversations(messages: DataFrame, branches: int = 1) -> DataFrame:
    """Messages (tree, node, parent, role, text, score) to one row for each chosen path: tree, rank, score, n_turns,
    formatted, and loss_mask, an array of (begin, length) in code points."""
    texts = messages.select("tree", key(F.col("tree"), F.col("node")).alias("at"), escape_role(F.coalesce("role", F.lit(""))).alias("head"),
                            escape(F.coalesce("text", F.lit(""))).alias("body"), (F.col("role") == ASSISTANT).alias("is_loss"))
    rows = paths(messages, branches).join(texts, F.col("id") == F.col("at"))
    rows = rows.withColumn("piece", F.concat(F.lit(TURN), "head", F.lit("\n"), "body", F.lit(END)))
    before = Window.partitionBy("leaf").orderBy(F.desc("back")).rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)) + F.length("head") + len(TURN) + 1
    rows = rows.select("leaf", "tree", "rank", "score", (-F.col("back")).alias("place"), "piece", "is_loss", begin.cast("int").alias("begin"), F.length("body").alias("length"))
    turns = F.array_sort(F.collect_list(F.struct("place", "piece", "is_loss", "begin", "length")))
    grouped = rows.groupBy("leaf").agg(F.first("tree").alias("tree"), F.first("rank").alias("rank"), F.first("score").alias("score"), turns.alias("turns"))
    mask = F.transform(F.filter("turns", lambda t: t["is_loss"]), lambda t: F.struct(t["begin"].alias("begin"), t["length"].alias("length")))
    return grouped.select("tree", "rank", "score", F.size("turns").alias("n_turns"), F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"), mask.alias("loss_mask"))


def turns_of(formatted: Column) -> Column:
    """The (role, text) turns of a formatted conversation, as they were before formatting."""
    pieces = F.filter(F.split(formatted, r"<\|end\|>"), lambda p: p != "")

    def parsed(piece: Column) -> Column:
        body = F.substring(piece, len(TURN) + 1, 2**31 - 1)
        head = F.substring_index(body, "\n", 1)
        return F.struct(unescape_role(head).alias("role"), unescape(F.substring(body, F.length(head) + 2, F.lit(2**31 - 1))).alias("text"))

    return F.transform(pieces, parsed)


def loss_text(formatted: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped, end to end."""
    return F.array_join(F.transform(mask, lambda m: unescape(F.substring(formatted, m["begin"] + 1, m["length"]))), "")


def read_back(formatted: DataFrame) -> DataFrame:
    """What a reader of the formatted conversations gets: counts and digests of turns and of the loss text."""
    turns = F.transform(turns_of(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = formatted.select("tree", turns.alias("turns"), loss_text(F.col("formatted"), F.col("loss_mask")).alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
    return read.select("tree", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join("turns", ""), 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
