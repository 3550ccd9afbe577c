"""Reply trees to training conversations, in DataFrame functions only.

Messages name the message they reply to.  Every path from a root to a leaf is a branch.  Branches are enumerated by
iterative self-joins that double their reach: a table of pointers is joined with itself, so that after j rounds
it names each message's ancestor 2^j steps up, and each leaf's list of (leaf, message, height) rows is joined to it, so
that after j rounds it holds the lowest 2^j messages.  A tree of depth d takes log2(d) rounds, each written to the shared
folder, and rows are made for messages of branches only, never for pairs.  The first rounds also find every message's
root.  Branches of a root are ranked by the mean score of their messages; the best ones are formatted.

A template wraps each turn's text in control strings.  Control strings (and what looks like them, with backslashes
inside) in texts and roles get one more backslash, so a text holds none and reading back takes
one away: any text comes back as it was.  Spans of assistant texts, in code points, are the loss mask.

A null text or role counts as empty.  A message whose parent isn't there is a root, as one with a null parent is.  A message
without id is a root and leaf of its own.  Of rows with the same id the smallest counts (by parent, role, text, score); equal rows without
id each count.  A null score ranks last; ties go to the leaf's smaller id.  Messages whose ancestors form a circle have no
root and are in no branch.  Empty tables give empty results; other columns aren't read.  A very long text is a value
of one row, and so is a formatted conversation; a branch is gathered where it is formatted, a tree never is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.common import remove, scratch, written

#: Control strings of the template, as roles have them: before and after the text; fixed values.
USER, ASSISTANT, SYSTEM, OTHER = ("[INST]", "[/INST]"), ("<s>", "</s>"), ("<<SYS>>", "<</SYS>>"), ("[ROLE]", "[/ROLE]")
_HEAD, _TAIL = r"(<<?/?|\[/?)", r"(s>|SYS>>|INST\]|ROLE\])"
_LOOKS_LIKE, _ESCAPED = _HEAD + r"(\\*)" + _TAIL, _HEAD + r"\\(\\*)" + _TAIL
_TURN = r"(?s)(\[INST\]|<s>|<<SYS>>|\[ROLE\]) (.*?) (?:\[/INST\]|</s>|<</SYS>>|\[/ROLE\])\n"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _LOOKS_LIKE, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def _turn(role: Column, text: Column) -> tuple[Column, Column, Column]:
    """What stands before a turn's text, the text as it is written, and what stands behind it."""
    def by_role(i):
        return (F.when(role == "user", USER[i]).when(role == "assistant", ASSISTANT[i])
                .when(role == "system", SYSTEM[i]).otherwise(OTHER[i]))

    known = role.isin("user", "assistant", "system")
    # a role of its own: its name, tildes and line breaks replaced, is the first line
    name = F.replace(F.replace(escaped(role), F.lit("~"), F.lit("~0")), F.lit("\n"), F.lit("~1"))
    before = F.concat(by_role(0), F.lit(" "), F.when(known, "").otherwise(F.concat(name, F.lit("\n"))))
    return before, escaped(text), F.concat(F.lit(" "), by_role(1), F.lit("\n"))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation, an array of ``role`` and ``text``."""
    pattern = F.lit(_TURN)
    tags, bodies = F.regexp_extract_all(formatted, pattern, F.lit(1)), F.regexp_extract_all(formatted, pattern, F.lit(2))

    def turn(tag, body):
        other = tag == OTHER[0]
        name = F.replace(F.replace(F.substring_index(body, "\n", 1), F.lit("~1"), F.lit("\n")), F.lit("~0"), F.lit("~"))
        role = (F.when(tag == USER[0], "user").when(tag == ASSISTANT[0], "assistant").when(tag == SYSTEM[0], "system")
                .otherwise(unescaped(name)))
        text = F.when(other, F.substr(body, F.instr(body, F.lit("\n")) + 1)).otherwise(body)
        return F.struct(role.alias("role"), unescaped(text).alias("text"))

    return F.zip_with(tags, bodies, turn)


@dataclass(frozen=True)
class Columns:
    """Names of the columns of a table of messages."""

    id: str = "message_id"
    parent: str = "parent_id"
    role: str = "role"
    text: str = "text"
    score: str = "score"


def branches(messages: DataFrame, columns: Columns, work: str) -> DataFrame:
    """``leaf``, ``root``, ``node`` and ``height`` (of the node above its leaf) of every message of every branch.

    Written tables below ``work``; ids aren't null here.
    """
    links = messages.select(F.col(columns.id).alias("node"), F.col(columns.parent).alias("up"))
    known = links.select(F.col("node").alias("up"))
    nodes = written(links.join(known, "up", "left_semi").unionByName(
        links.join(known, "up", "left_anti").withColumn("up", F.lit(None).cast(links.schema["up"].dataType))), "nodes", work)
    n = nodes.count()
    # pointers[j]: node and its ancestor 2^j steps up, where there is one
    pointers, reach = [nodes.where("up is not null")], 1
    while not pointers[-1].isEmpty() and reach <= n:
        low, high = pointers[-1], pointers[-1].select(F.col("node").alias("up"), F.col("up").alias("top"))
        pointers.append(written(low.join(high, "up").select("node", F.col("top").alias("up")), f"up-{len(pointers)}", work))
        reach *= 2
    leaves = nodes.join(nodes.select(F.col("up").alias("node")).where("node is not null"), "node", "left_anti")
    # a leaf's root is found by the largest steps first; what still has a parent then hangs below a circle
    at = leaves.select(F.col("node").alias("leaf"), "node")
    for step in reversed(pointers):
        at = _climbed(at, step)
    rooted = written(at.join(pointers[0].select("node"), "node", "left_anti").select("leaf", F.col("node").alias("root")), "roots", work)
    rows = rooted.select("leaf", F.col("leaf").alias("node"), F.lit(0).cast("long").alias("height"))
    for j, step in enumerate(pointers):
        further = rows.join(step, "node").select("leaf", F.col("up").alias("node"), (F.col("height") + (1 << j)).alias("height"))
        rows = written(rows.unionByName(further), f"rows-{j}", work)
    return rows.join(rooted, "leaf").select("leaf", "root", "node", "height")


def _climbed(at: DataFrame, step: DataFrame) -> DataFrame:
    return at.join(step, "node", "left").select("leaf", F.coalesce("up", "node").alias("node"))


def conversations(messages: DataFrame, columns: Columns = Columns(), best: int | None = None) -> DataFrame:
    """A row for each chosen branch: ``leaf``, ``root``, ``rank`` among the root's branches, ``score``, ``turns`` (number),
    ``formatted``, and ``loss_spans``, start and end (exclusive) of each assistant text in it, in code points.

    ``best`` branches of each root are formatted, all if None.
    """
    spark = messages.sparkSession
    work = scratch(spark, "reply-trees")
    kept = messages.select(
        messages[columns.id].alias("id"), messages[columns.parent].alias("parent"),
        F.coalesce(messages[columns.role].cast("string"), F.lit("")).alias("role"),
        F.coalesce(messages[columns.text].cast("string"), F.lit("")).alias("text"),
        messages[columns.score].cast("double").alias("score"))
    content = F.struct("parent", "role", "text", "score")
    single = written(kept.where("id is not null").groupBy("id").agg(F.min(content).alias("m")).select("id", "m.*"), "messages", work)
    rows = branches(single, Columns("id", "parent"), work)
    scores = rows.join(single.select(F.col("id").alias("node"), "score"), "node").groupBy("leaf", "root").agg(F.avg("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("root").orderBy(F.col("score").desc_nulls_last(), "leaf"))
    ranked = scores.withColumn("rank", place)
    chosen = written(ranked if best is None else ranked.where(F.col("rank") <= best), "ranked", work)
    turns = rows.select("leaf", "node", "height").join(chosen, "leaf").join(
        single.select(F.col("id").alias("node"), "role", "text"), "node")
    alone = kept.where("id is null").select(  # each a conversation of its own
        F.col("id").alias("leaf"), F.col("id").alias("root"), F.lit(1).alias("rank"), "score", *_single(F.col("role"), F.col("text")))
    result = written(_formatted(turns, ["leaf", "root", "rank", "score"]).unionByName(alone), "conversations")
    remove(spark, work)
    return result


def _single(role: Column, text: Column) -> list[Column]:
    before, body, after = _turn(role, text)
    span = F.struct(F.length(before).cast("long").alias("start"), F.length(F.concat(before, body)).cast("long").alias("end"))
    return [F.lit(1).cast("long").alias("turns"), F.concat(before, body, after).alias("formatted"),
            F.when(role == "assistant", F.array(span)).otherwise(F.array().cast("array<struct<start:long,end:long>>")).alias("loss_spans")]


def _formatted(turns: DataFrame, key: list[str]) -> DataFrame:
    """Of each branch its turns from the root on, formatted; where a turn starts is a running sum over the branch."""
    before, body, after = _turn(F.col("role"), F.col("text"))
    pieces = turns.select(*key, "height", "role", before.alias("before"), body.alias("body"), after.alias("after"))
    down = Window.partitionBy(key[0]).orderBy(F.col("height").desc())
    size = F.length("before") + F.length("body") + F.length("after")
    start = F.coalesce(F.sum(size.cast("long")).over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.length("before")
    placed = pieces.withColumn("start", start.cast("long"))
    turn = F.struct((-F.col("height")).alias("at"), F.concat("before", "body", "after").alias("piece"))
    span = F.when(F.col("role") == "assistant", F.struct("start", (F.col("start") + F.length("body")).alias("end")))
    return placed.groupBy(*key).agg(
        F.count(F.lit(1)).alias("turns"),
        F.array_join(F.transform(F.sort_array(F.collect_list(turn)), lambda t: t["piece"]), "").alias("formatted"),
        F.sort_array(F.collect_list(span)).alias("loss_spans"))


def loss_text(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, as they were, one after another."""
    return F.array_join(F.transform(spans, lambda s: unescaped(
        F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")


def chains(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Linear conversations as messages: each turn replies to the one before it (order by turn, ties by role and text).

    ``message_id`` and ``parent_id`` are structs of the conversation and the turn's number in it.
    """
    order = Window.partitionBy(conv_col).orderBy(turn_col, role_col, text_col)
    numbered = rows.select(conv_col, turn_col, role_col, text_col).withColumn("n", F.row_number().over(order).cast("long"))

    def place(n):
        return F.struct(F.col(conv_col).alias("conv"), n.alias("n"))

    return numbered.select(
        place(F.col("n")).alias("message_id"),
        F.when(F.col("n") > 1, place(F.col("n") - 1)).alias("parent_id"),
        F.col(role_col).alias("role"), F.col(text_col).alias("text"), F.lit(None).cast("double").alias("score"))
