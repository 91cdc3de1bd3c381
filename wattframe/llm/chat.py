"""Chat formatting over reply trees.

Messages point to the message they answer.  Self-joins by doubling (the answer
to the answer, then four, eight ... steps up) give each message its distance
from the root and the score of its branch; branches, the paths from a root to
a leaf, are ranked by score within their conversation.  The chosen leaves
enumerate their paths by the same doubled links, and each path is formatted as
one conversation, turn by turn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattframe.llm.common import staged

# The template.
LABELS = {"system": "System", "user": "User", "assistant": "Assistant"}
OPEN, MIDDLE, CLOSE = "### ", ": ", " </turn>\n"


def escaped(text: Column) -> Column:
    """``text`` without control strings: a backslash stands before backslashes and #, and inside </turn>."""
    return F.regexp_replace(F.regexp_replace(text, r"([\\#])", r"\\$1"), "</turn>", r"<\\/turn>")


def label(role: Column) -> Column:
    """The name that marks a role; other roles than the three known ones are quoted behind a tilde."""
    known = F.create_map(*[F.lit(x) for pair in LABELS.items() for x in pair])
    other = F.concat(F.lit("~"), F.regexp_replace(F.regexp_replace(role, r"([\\#:])", r"\\$1"), "</turn>", r"<\\/turn>"))
    return F.coalesce(F.element_at(known, role), other)


def as_trees(conversations: DataFrame) -> DataFrame:
    """Conversations by turn as trees of one branch: each turn answers the one before.

    Rows with the same turn follow by role and text; rows without a turn come
    first.  All scores are zero.
    """
    columns = {c.lower(): c for c in conversations.columns}
    rows = conversations.select(
        F.col(columns["conv_id"]).cast("long").alias("conv_id"), F.col(columns["turn"]).cast("long").alias("turn"),
        F.coalesce(F.col(columns["role"]), F.lit("")).alias("role"),
        F.coalesce(F.col(columns["text"]), F.lit("")).alias("text"))
    number = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    return rows.withColumn("message", number.cast("long")).select(
        "conv_id", "message", F.when(F.col("message") > 1, F.col("message") - 1).alias("parent"), "role", "text",
        F.lit(0.0).alias("score"))


def _on(left: DataFrame, right: DataFrame, a: str, b: str) -> Column:
    return left["conv_id"].eqNullSafe(right["conv_id"]) & (left[a] == right[b])


def branches(messages: DataFrame, best: int = 1) -> DataFrame:
    """(conv_id, branch, position, role, text) of the ``best`` branches of each conversation.

    ``messages``: conv_id, message (unique in it), parent (null for a root, or
    one that is missing), role, text, score.  Branches rank by mean score of
    their messages, then by their leaf; position counts from 0 at the root.
    Messages that answer each other in a ring, or a message that answers itself,
    have no root; the ring is opened at its smallest message, which becomes one.
    """
    return _branches(staged(messages, "messages"), best)


def _branches(nodes: DataFrame, best: int, opened: bool = False) -> DataFrame:
    known = nodes.select("conv_id", F.col("message").alias("up"), F.lit(True).alias("there"))
    ids = nodes.select("conv_id", "message", "parent", "score")
    step = staged(ids.join(known, ids["conv_id"].eqNullSafe(known["conv_id"]) & (ids["parent"] == known["up"]), "left")
                  .select(ids["conv_id"], "message", F.when(F.col("there"), F.col("parent")).alias("up"),
                          F.col("score").cast("double").alias("total"), F.lit(1).cast("long").alias("length")), "steps")
    links = []
    longest = nodes.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    while not step.where("up is not null").isEmpty():
        if 2 ** len(links) > longest:  # no way to a root is that long
            if opened:
                raise RuntimeError("a ring of replies stayed closed")
            return _branches(_opened(nodes, links), best, True)
        links.append(step.select("conv_id", "message", "up"))
        upper = step.select(F.col("conv_id").alias("c"), F.col("message").alias("m"), F.col("up").alias("next"),
                            F.col("total").alias("more"), F.col("length").alias("further"))
        step = staged(step.join(upper, step["conv_id"].eqNullSafe(upper["c"]) & (step["up"] == upper["m"]), "left")
                      .select("conv_id", "message", F.col("next").alias("up"),
                              (F.col("total") + F.coalesce("more", F.lit(0.0))).alias("total"),
                              (F.col("length") + F.coalesce("further", F.lit(0))).alias("length")), "steps")
    answered = ids.where("parent is not null").select("conv_id", F.col("parent").alias("message")).distinct()
    leaves = step.join(answered, step["conv_id"].eqNullSafe(answered["conv_id"])
                       & (step["message"] == answered["message"]), "left_anti")
    rank = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.desc(F.col("total") / F.col("length")), "message"))
    path = leaves.withColumn("branch", rank).where(F.col("branch") <= best).select(
        "conv_id", "branch", "message", (F.col("length") - 1).alias("position"))
    for power, link in enumerate(links):  # with steps of 1, 2, 4 ... each message of a path is met once
        link = link.select(F.col("conv_id").alias("c"), F.col("message").alias("m"), "up")
        both = path.join(link, path["conv_id"].eqNullSafe(link["c"]) & (path["message"] == link["m"]), "left")
        path = both.select("conv_id", "branch", F.explode(F.array(
            F.struct(F.col("message"), F.col("position")),
            F.struct(F.col("up").alias("message"), (F.col("position") - 2**power).alias("position")))).alias("x")).select(
            "conv_id", "branch", "x.*").where("message is not null")
    texts = nodes.select(F.col("conv_id").alias("c"), F.col("message").alias("m"), "role", "text")
    return path.join(texts, path["conv_id"].eqNullSafe(texts["c"]) & (path["message"] == texts["m"])).select(
        "conv_id", "branch", "position", "role", "text")


def _opened(nodes: DataFrame, links: list[DataFrame]) -> DataFrame:
    """Messages whose ways end: the smallest message of each ring, which alone meets itself as the least above it.

    ``links`` lead 1, 2, 4 ... messages up, further than the longest way to a root.
    """
    def keyed(rows: DataFrame, *more: str) -> DataFrame:
        return rows.select(F.col("conv_id").alias("c"), F.col("message").alias("m"), *more)

    def met(rows: DataFrame, other: DataFrame, by: str) -> DataFrame:
        return rows.join(other, rows["conv_id"].eqNullSafe(other["c"]) & (rows[by] == other["m"]), "left").drop("c", "m")

    least = links[0].withColumn("least", F.col("up"))
    for link, onward in zip(links, links[1:]):
        own = met(link.withColumnRenamed("up", "via"), keyed(least, "least"), "message")
        upper = met(own, keyed(least, F.col("least").alias("lower")), "via")
        both = upper.select("conv_id", "message", F.least("least", "lower").alias("least"))
        least = staged(met(both, keyed(onward, "up"), "message"), "least")
    ends = least.where("up is not null and least = message").select(
        F.col("conv_id").alias("c"), F.col("message").alias("m"), F.lit(True).alias("opened"))
    both = nodes.join(ends, nodes["conv_id"].eqNullSafe(ends["c"]) & (nodes["message"] == ends["m"]), "left")
    return staged(both.withColumn("parent", F.when(F.col("opened").isNull(), F.col("parent")))
                  .select(*nodes.columns), "messages")


def formatted(paths: DataFrame, learn: str = "assistant") -> DataFrame:
    """Each turn of each path as it stands in the formatted conversation.

    Adds ``piece``; the conversation is its pieces by position.  ``loss_start``
    and ``loss_end`` bound the text to learn within a piece (null: none).
    """
    head = F.concat(F.lit(OPEN), label(F.col("role")), F.lit(MIDDLE))
    body = escaped(F.col("text"))
    learned = F.col("role") == learn
    return paths.select("conv_id", "branch", "position", F.concat(head, body, F.lit(CLOSE)).alias("piece"),
                        F.when(learned, F.length(head)).alias("loss_start"),
                        F.when(learned, F.length(head) + F.length(body)).alias("loss_end"))


_PIECE = re.compile(r"### (?:(System|User|Assistant)|~((?:\\.|[^\\:])*)): (.*) </turn>\n", re.DOTALL)
_ESCAPE = re.compile(r"\\(.)", re.DOTALL)
_ROLES = {v: k for k, v in LABELS.items()}


def read_piece(piece: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    named, other, body = _PIECE.fullmatch(piece).groups()
    return _ROLES[named] if named else _ESCAPE.sub(r"\1", other), _ESCAPE.sub(r"\1", body)


DIGEST = ("conv_id long, branch int, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
          "formatted_chars long")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations whose pieces come one after another; only one piece is held at a time."""
    names = [f.split()[0] for f in DIGEST.split(", ")]
    key, turns, loss, counts, done = None, None, None, [], []

    def close() -> None:
        if key is not None:
            done.append((*key, counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), counts[2]))

    def flush() -> pa.RecordBatch:
        types = [pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done), types)], names)

    for batch in batches:
        for conv, branch, piece, start, end in zip(*[c.to_pylist() for c in batch.columns]):
            if key != (conv, branch):
                close()
                key, turns, loss, counts = (conv, branch), hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
            role, text = read_piece(piece)
            turns.update(f"{role}\n{text}\n".encode())
            counts[0] += 1
            counts[2] += len(piece)
            if start is not None:
                learned = _ESCAPE.sub(r"\1", piece[start:end])
                loss.update(learned.encode())
                counts[1] += len(learned)
        if done:
            yield flush()
            done = []
    close()
    if done:
        yield flush()


def digests(pieces: DataFrame) -> DataFrame:
    """Per formatted conversation what reading it back gives; see DIGEST.

    A conversation is read as a sorted stream, so its length needs no memory.
    """
    parts = max(int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return (pieces.repartition(parts, "conv_id", "branch").sortWithinPartitions("conv_id", "branch", "position")
            .select("conv_id", "branch", "piece", "loss_start", "loss_end").mapInArrow(_read, DIGEST))
