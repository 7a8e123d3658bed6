"""Conversations from messages that quote each other."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tablewright.llm.common import running, stored

_MARKS = re.compile(r"[ \t]*((?:>[ \t]?)+)")


def levels(text: str) -> list[tuple[int, str]]:
    """The lines with their quote level, without the marks."""
    out = []
    for line in text.split("\n"):
        found = _MARKS.match(line)
        out.append((found.group(1).count(">"), line[found.end() :]) if found else (0, line))
    return out


def _key(kind: str, *parts: str) -> bytes:
    return hashlib.md5("\0".join((kind, *parts)).encode("utf-8", "surrogatepass")).digest()


def _plain(lines: list[str]) -> str:
    return " ".join(" ".join(lines).lower().split())


def _passages(lines: list[tuple[int, str]], level: int) -> list[str]:
    """Normalised passages of one level: what stands between blank lines and lines of other levels."""
    found, held = [], []
    for depth, line in [*lines, (-1, "")]:
        if depth == level and line.strip():
            held.append(line)
        elif held:
            found.append(_plain(held))
            held = []
    return found


def keys_of(text: str) -> tuple[str, list[bytes], list[bytes]]:
    """A message without quotes, the keys it can be found by, and those of what it quotes, best first.

    The best key is a whole message together with what that quotes in turn, then the whole
    message, then its passages.
    """
    lines = levels(text)
    at = [_plain([line for depth, line in lines if depth == level]) for level in range(3)]
    own = "\n".join(line for depth, line in lines if depth == 0).strip()

    def named(level: int) -> list[bytes]:
        if not at[level]:
            return []
        below = at[level + 1] if level < 2 else ""
        return [_key("context", at[level], below), _key("whole", at[level]), *(_key("part", p) for p in _passages(lines, level))]

    return own, list(dict.fromkeys(named(0))), list(dict.fromkeys(named(1)))


def linked(messages: DataFrame, id_col: str = "message_id", text_col: str = "text") -> DataFrame:
    """Messages without quotes, each with the one it answers and its place in the conversation.

    Returns ``id_col``, ``parent_id`` (NULL where a conversation begins), ``root_id``,
    ``depth``, ``position`` in the conversation from 0, and ``text`` without quotes. A
    message comes after the one it answers; ids tell which is earlier. Of equal originals
    the one with the smallest id is meant, unless what they quote themselves tells them
    apart. A message that quotes several answers the one that the best, then the first, of
    its passages leads to.

    NULL and empty texts quote nothing and are never quoted. Rows with NULL id are left
    out, as nothing can name them; of rows with one id that with the largest text counts.
    Other columns are not looked at.
    """
    rows = messages.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.filter("id is not null").groupBy("id").agg(F.max("text").alias("text"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, offers, asks = zip(*(keys_of(t.as_py()) for t in batch.column(1))) if batch.num_rows else ((), (), ())
            binary = pa.list_(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(own, pa.string()), pa.array(offers, binary), pa.array(asks, binary)],
                names=["id", "text", "offers", "asks"],
            )

    parsed = stored(rows.mapInArrow(parse, "id bigint, text string, offers array<binary>, asks array<binary>"), "messages")
    offers = parsed.select("id", F.explode("offers").alias("key")).groupBy("key").agg(F.min("id").alias("parent"))
    asks = parsed.select("id", F.posexplode("asks").alias("at", "key"))
    found = asks.join(offers, "key").filter("parent < id")
    found = found.groupBy("id").agg(F.min(F.struct("at", "parent")).alias("best")).select("id", F.col("best.parent").alias("parent"))
    nodes = parsed.select("id").join(found, "id", "left")
    nodes = stored(nodes.select("id", "parent", F.coalesce("parent", "id").alias("up"), F.col("parent").isNotNull().cast("bigint").alias("depth")), "replies")

    # Each round doubles how far up a message looks; those that see a beginning are done.
    open_ = nodes.select("id", "up", "depth").filter("parent is not null")
    above = nodes.select(F.col("id").alias("up"), F.col("up").alias("higher"), F.col("depth").alias("more"))
    done = nodes.filter("parent is null").select("id", "up", "depth")
    while not open_.isEmpty():
        step = open_.join(above, "up").select("id", F.col("higher").alias("up"), (F.col("depth") + F.col("more")).alias("depth"), (F.col("more") == 0).alias("over"))
        step = stored(step, "reply-steps")
        done = done.unionAll(step.filter("over").drop("over"))
        open_ = step.filter("not over").drop("over")
        doubled = open_.select(F.col("id").alias("up"), F.col("up").alias("higher"), F.col("depth").alias("more"))
        above = doubled.unionAll(done.select(F.col("id").alias("up"), F.col("up").alias("higher"), F.col("depth").alias("more")))

    placed = done.select("id", F.col("up").alias("root_id"), "depth").withColumn("one", F.lit(1))
    placed = stored(running(placed, ["root_id", "depth", "id"], "one", "place", "reply-order"), "reply-places")
    firsts = placed.groupBy("root_id").agg(F.min("place").alias("first"))
    placed = placed.join(firsts, "root_id").select("id", "root_id", "depth", (F.col("place") - F.col("first")).alias("position"))
    out = placed.join(nodes.select("id", "parent"), "id").join(parsed.select("id", "text"), "id")
    return out.select(F.col("id").alias(id_col), F.col("parent").alias("parent_id"), "root_id", "depth", "position", "text")


def as_messages(conversations: DataFrame) -> DataFrame:
    """Turns as mail: ``message_id`` and a text that quotes the turn before and, below it, the one before that.

    The id is the conversation's times 2^20 plus the turn. Nothing is quoted where a turn is missing.
    """
    turns = conversations.groupBy("conv_id", "turn").agg(F.coalesce(F.max("text"), F.lit("")).alias("text"))
    turns = stored(turns, "turns")
    quoted = lambda text: F.regexp_replace(text, "(?m)^", "> ")
    earlier = lambda back: turns.select("conv_id", (F.col("turn") + back).alias("turn"), F.col("text").alias(f"t{back}"))
    rows = turns.join(earlier(1), ["conv_id", "turn"], "left").join(earlier(2), ["conv_id", "turn"], "left")
    second = F.when(F.col("t2").isNotNull(), F.concat(F.lit("\n"), quoted(F.col("t2")))).otherwise("")
    first = F.when(F.col("t1").isNotNull(), F.concat(quoted(F.concat(F.col("t1"), second)), F.lit("\n\n"))).otherwise("")
    return rows.select((F.col("conv_id") * 2**20 + F.col("turn")).alias("message_id"), F.concat(first, F.col("text")).alias("text"))
