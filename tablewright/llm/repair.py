"""Conversations mended by the cheapest edits, found by bidirectional Dijkstra over the edit lattice."""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tablewright.llm.common import WORD, stored
from tablewright.llm.numbering import numbered
from tablewright.operators.joins import broadcast_join

# Fixed value: the characters of SPACE, written out.
_WHITE = " \t\n\x0b\x0c\r"
# What an edit costs, and what a kept row with an open end adds.
KEEP, REROLE, DELETE, INSERT, OPEN = 0, 2, 3, 2, 1

# A mended conversation is nothing, or (s?)(ua)+ in the initials of its roles. The states are
# what has been read of it: nothing, s, (..)u and (..)ua. By state, the state after an initial.
_AFTER = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
_ACCEPTED = (0, 3)
#: By state, the role that an edit may set or insert. The system's cannot be made.
_ROLE = ["user", "user", "assistant", "user"]
_MADE = [2, 2, 3, 2]
#: By state, the states and initials that lead to it; and the states that a made role leads from.
_BEFORE = [[(s, i) for s in range(4) for i, t in _AFTER[s].items() if t == state] for state in range(4)]
_MADE_FROM = [[s for s in range(4) if _MADE[s] == state] for state in range(4)]

_CHUNK_BYTES, _ROW_BYTES = 262_144, 512  # so that a chunk has at most 512 rows


class Lattice:
    """Rows by states. ``initials`` has a character of each row, ``drop`` and ``open`` its faults."""

    def __init__(self, initials: str, drop: Sequence[bool], open_: Sequence[bool]):
        self.initials, self.drop, self.open, self.n = initials, drop, open_, len(initials)

    def forward(self, i: int, state: int) -> Iterator[tuple[int, str, int, int]]:
        """Edits at a place: cost, initial, and where they lead."""
        yield INSERT, "I", i, _MADE[state]
        if i < self.n:
            extra = OPEN if self.open[i] else 0
            yield DELETE, "D", i + 1, state
            if not self.drop[i]:
                after = _AFTER[state].get(self.initials[i])
                if after is not None:
                    yield KEEP + extra, "K", i + 1, after
                yield REROLE + extra, "R", i + 1, _MADE[state]

    def backward(self, i: int, state: int) -> Iterator[tuple[int, str, int, int]]:
        """Edits that lead to a place: cost, initial, and where they come from."""
        for s in _MADE_FROM[state]:
            yield INSERT, "I", i, s
        if i:
            extra = OPEN if self.open[i - 1] else 0
            yield DELETE, "D", i - 1, state
            if not self.drop[i - 1]:
                for s, initial in _BEFORE[state]:
                    if initial == self.initials[i - 1]:
                        yield KEEP + extra, "K", i - 1, s
                for s in _MADE_FROM[state]:
                    yield REROLE + extra, "R", i - 1, s

    def cheapest(self, start: int, ends: Sequence[int]) -> tuple[int, str] | None:
        """Cost and least initials of the cheapest edits from a state before the rows to one of ``ends`` after them.

        Two heaps grow from both sides until their least costs together exceed the best
        crossing, so that every crossing of equal cost is there; of these the least
        concatenation wins. Edits lead from a place to one place each, so that two
        different strings of one cost between two places differ before either ends, and
        the least one has least parts. Places of one cost are taken in the order of
        rows, since only keeping is free and it goes to the next row.
        """
        heaps = ([(0, 0, "", start)], [(0, 0, "", e) for e in ends])
        heaps[1].sort()
        done: tuple[dict, dict] = ({}, {})
        best: tuple[int, str] | None = None

        def crossing(cost: int, audit: str) -> None:
            nonlocal best
            if best is None or (cost, audit) < best:
                best = (cost, audit)

        while heaps[0] and heaps[1] and (best is None or heaps[0][0][0] + heaps[1][0][0] <= best[0]):
            side = 0 if heaps[0][0][0] <= heaps[1][0][0] else 1
            cost, row, audit, state = heapq.heappop(heaps[side])
            i = self.n - row if side else row
            if (i, state) in done[side]:
                continue
            done[side][i, state] = (cost, audit)
            met = done[1 - side].get((i, state))
            if met:
                crossing(cost + met[0], met[1] + audit if side else audit + met[1])
            for more, initial, j, other in self.backward(i, state) if side else self.forward(i, state):
                longer = initial + audit if side else audit + initial
                met = done[1 - side].get((j, other))
                if met:
                    crossing(cost + more + met[0], met[1] + longer if side else longer + met[1])
                if (j, other) not in done[side]:
                    heapq.heappush(heaps[side], (cost + more, self.n - j if side else j, longer, other))
        return best


def mended(audit: str, state: int, rows: Sequence[tuple[str, str]]) -> tuple[list[tuple[str, str]], int]:
    """The rows (role, text) after the edits, from a state on, and the state they lead to."""
    out, i = [], 0
    for edit in audit:
        if edit == "I":
            out.append((_ROLE[state], ""))
            state = _MADE[state]
            continue
        role, text = rows[i]
        i += 1
        if edit == "K":
            out.append((role, text))
            state = _AFTER[state][role[:1]]
        elif edit == "R":
            out.append((_ROLE[state], text))
            state = _MADE[state]
    return out, state


def crc_of_turn(conv: Column, turn: Column) -> Column:
    """CRC-32 of ``conv:turn``; a NULL is one space."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    return F.crc32(F.concat(text(conv), F.lit(":"), text(turn)).cast("binary"))


def damaged(conversations: DataFrame, ways: int = 20) -> DataFrame:
    """Conversations with rows dropped, emptied, left open, repeated or given to the user, by a hash of their turn.

    Rows whose number, the hash modulo ``ways``, is 0 are gone, 1 lose their text, 2 lose ``.!?``, 3 come
    twice and 4 become the user's. NULL roles and texts are one space from then on.
    """
    kind = crc_of_turn(F.col("conv_id"), F.col("turn")) % ways
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("text", "role"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).filter("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.withColumns({"text": text, "role": F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))})
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", "role", "text", F.explode(copies).alias("copy")).drop("copy")


_CHUNK = """conv string, chunk bigint, rows bigint, first string, last string, blank bigint, duplicate bigint, truncated bigint,
illegal bigint, paths array<struct<start:int,stop:int,cost:bigint,audit:string>>, alone string"""
_LEGAL = {"su", "ua", "au"}


def _paths(chunks: DataFrame) -> DataFrame:
    """Faults of each chunk and its cheapest edits by the states before and after it.

    A chunk that is a whole conversation needs one search only, and has the hash of what it
    becomes in ``alone``.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        for batch in batches:
            out = {name: [] for name in ("conv", "chunk", "rows", "first", "last", "blank", "duplicate", "truncated", "illegal", "paths", "alone")}
            schema = schema or _arrow_schema()
            for i in range(batch.num_rows):
                conv, chunk, opens, closes, turns, again = (batch.column(c)[i].as_py() for c in ("conv", "chunk", "opens", "closes", "turns", "again"))
                again = set(again or ())
                initials = "".join(t["role"][:1] or " " for t in turns)
                blank = [t["blank"] for t in turns]
                twice = [t["at"] in again and not b for t, b in zip(turns, blank)]
                drop = [a or b for a, b in zip(blank, twice)]
                open_ = [t["open"] and not d for t, d in zip(turns, drop)]
                lattice = Lattice(initials, drop, open_)
                found = []
                for start in [0] if opens else range(4):
                    for stops in [_ACCEPTED] if closes else [(s,) for s in range(4)]:
                        best = lattice.cheapest(start, stops)
                        if best is not None:
                            found.append({"start": start, "stop": stops[0], "cost": best[0], "audit": best[1]})
                alone = None
                if opens and closes:
                    rows, _ = mended(found[0]["audit"], 0, [(t["role"], t["text"]) for t in turns])
                    alone = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in rows).encode()).hexdigest()
                for name, value in (
                    ("conv", conv), ("chunk", chunk), ("rows", len(turns)), ("first", initials[0]), ("last", initials[-1]),
                    ("blank", sum(blank)), ("duplicate", sum(twice)), ("truncated", sum(open_)),
                    ("illegal", sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:]))), ("paths", found), ("alone", alone),
                ):
                    out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    return chunks.mapInArrow(work, _CHUNK)


def _arrow_schema() -> pa.Schema:
    path = pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
    numbers = ("blank", "duplicate", "truncated", "illegal")
    return pa.schema(
        [("conv", pa.string()), ("chunk", pa.int64()), ("rows", pa.int64()), ("first", pa.string()), ("last", pa.string())]
        + [(n, pa.int64()) for n in numbers]
        + [("paths", pa.list_(path)), ("alone", pa.string())]
    )


def _joined(found: DataFrame) -> DataFrame:
    """The best way through the chunks of a conversation, and the edits of each.

    Chunks come in order, one at a time; four ways are kept, one for each state. What a
    task holds of a conversation is its edits, which are one value of the result anyway.
    """
    plan = "conv string, chunk bigint, start int, part string, illegal bigint, cost bigint, audit string"
    names = ["conv", "chunk", "start", "part", "illegal", "cost", "audit"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, ways, chunks, illegal, last = None, {}, [], 0, ""

        def done() -> pa.RecordBatch:
            cost, audit, cuts, starts = min(ways[s] for s in _ACCEPTED if s in ways)
            n, cuts = len(chunks), [*cuts, len(audit)]
            parts = [audit[a:b] for a, b in zip(cuts, cuts[1:])]
            first = [audit] + [None] * (n - 1)
            columns = [[conv] * n, chunks, list(starts), parts, [illegal] + [0] * (n - 1), [cost] + [0] * (n - 1), first]
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch in batches:
            for row in batch.to_pylist():
                if row["conv"] != conv:
                    if conv is not None:
                        yield done()
                    conv, ways, chunks, illegal, last = row["conv"], {0: (0, "", (), ())}, [], 0, ""
                illegal += bool(last) and last + row["first"] not in _LEGAL
                last = row["last"]
                chunks.append(row["chunk"])
                after: dict[int, tuple] = {}
                for p in row["paths"]:
                    if p["start"] in ways:
                        cost, audit, cuts, starts = ways[p["start"]]
                        way = (cost + p["cost"], audit + p["audit"], (*cuts, len(audit)), (*starts, p["start"]))
                        if p["stop"] not in after or way[:2] < after[p["stop"]][:2]:
                            after[p["stop"]] = way
                ways = after
        if conv is not None:
            yield done()

    ways = found.select("conv", "chunk", "first", "last", "paths")
    return ways.repartition("conv").sortWithinPartitions("conv", "chunk").mapInArrow(work, plan)


def _hashes(chunks: DataFrame, plans: DataFrame) -> DataFrame:
    """SHA-256 of mended conversations of several chunks; it is one pass over them by its definition."""

    def pour(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, some = None, hashlib.sha256(), False

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([conv], pa.string()), pa.array([state.hexdigest()])], names=["conv", "joined"])

        for batch in batches:
            for i in range(batch.num_rows):
                own, start, part, turns = (batch.column(c)[i].as_py() for c in ("conv", "start", "part", "turns"))
                if own != conv:
                    if conv is not None:
                        yield done()
                    conv, state, some = own, hashlib.sha256(), False
                for role, text in mended(part, start, [(t["role"], t["text"]) for t in turns])[0]:
                    state.update((("\n" if some else "") + f"{role}:{text}").encode())
                    some = True
        if conv is not None:
            yield done()

    rows = chunks.join(plans.select("conv", "chunk", "start", "part"), ["conv", "chunk"]).select("conv", "chunk", "start", "part", "turns")
    return rows.repartition("conv").sortWithinPartitions("conv", "chunk").mapInArrow(pour, "conv string, joined string")


def repaired(rows: DataFrame, originals: DataFrame, chunk_bytes: int = _CHUNK_BYTES) -> DataFrame:
    """One row per conversation of ``originals`` with its faults and the cheapest way to mend ``rows``.

    ``rows`` has ``conv_id``, ``turn``, ``role`` and ``text``; rows of a conversation go by
    turn, NULL first, then by role, the first 64 characters of the text and its hash. Returns
    ``gaps`` in the turns, rows whose first fault is ``blank``, ``duplicate`` or ``truncated``,
    ``illegal`` neighbours, the ``cost`` and ``audit`` of the edits, and ``repaired_sha256``.

    NULL is a conversation of its own; NULL roles and texts are one space. A conversation
    without rows has zeros and nothing to mend. A conversation above ``chunk_bytes`` is
    solved in chunks by the states at their ends, which are then joined; copies within it are found by
    counting, not by gathering them.
    """
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    flat = rows.select(
        conv.alias("conv"), "turn", role.alias("role"), text.alias("text"), F.substring(role, 1, 64).alias("r"), F.substring(text, 1, 64).alias("t"),
    )
    flat = flat.withColumn("same", F.md5(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text")))
    flat = flat.withColumn("size", F.greatest(F.lit(_ROW_BYTES), F.octet_length("role") + F.octet_length("text")).cast("bigint"))
    keep = ["conv", "turn", "role", "text", "same", "size"]
    flat = numbered(flat, "conv", ["conv", "turn", "r", "t", "same"], {"at": "size"}, "repair-rows", keep)
    flat = flat.withColumn("chunk", F.expr(f"at div {chunk_bytes}"))

    seen = flat.groupBy("conv", "same").agg(F.min("at").alias("first_at"), F.count("*").alias("n")).filter("n > 1")
    again = flat.select("conv", "same", "chunk", "at").join(seen, ["conv", "same"]).filter("at > first_at")
    again = again.groupBy("conv", "chunk").agg(F.collect_list("at").alias("again"))
    last = F.right(F.rtrim("text", F.lit(_WHITE)), F.lit(1))
    turns = F.struct("at", "role", "text", (~F.col("text").rlike(WORD)).alias("blank"), (~last.isin(".", "!", "?")).alias("open"))
    chunks = flat.groupBy("conv", "chunk").agg(F.array_sort(F.collect_list(turns)).alias("turns"))
    ends = flat.groupBy("conv").agg(
        F.max("chunk").alias("high"),
        (F.coalesce(F.max("turn") - F.min("turn") + 1, F.lit(0)) - F.count_distinct("turn")).alias("gaps"),
    )
    ends = stored(ends, "repair-ends")
    # Few conversations have several chunks; the first row of each is at 0.
    chunks = broadcast_join(chunks.join(again, ["conv", "chunk"], "left"), ends.filter("high > 0").select("conv", "high"), "conv", "left")
    chunks = chunks.select(
        "conv", "chunk", "turns", "again", (F.col("chunk") == 0).alias("opens"), (F.col("chunk") == F.coalesce("high", F.lit(0))).alias("closes")
    )
    chunks = stored(chunks, "repair-chunks")
    found = stored(_paths(chunks), "repair-paths")

    sums = found.groupBy("conv").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")], F.max("alone").alias("alone"),
        F.max(F.when(F.col("alone").isNotNull(), F.col("paths")[0])).alias("path"),
    )
    plans = stored(_joined(found.filter("alone is null")), "repair-plans")
    whole = plans.groupBy("conv").agg(F.sum("illegal").alias("between"), F.sum("cost").alias("joined_cost"), F.max("audit").alias("joined_audit"))
    whole = whole.join(_hashes(chunks.filter("not (opens and closes)"), plans), "conv", "left")
    mended_ = sums.join(whole, "conv", "left").join(ends.select("conv", "gaps"), "conv")

    all_ = originals.select("conv_id").distinct().withColumn("conv", conv)
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    return all_.join(mended_, "conv", "left").select(
        "conv_id", *[zero(F.col(c)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated")],
        (zero(F.col("illegal")) + zero(F.col("between"))).alias("illegal"),
        zero(F.coalesce("joined_cost", "path.cost")).alias("cost"),
        F.coalesce("joined_audit", "path.audit", F.lit("")).alias("audit"),
        F.coalesce("joined", "alone", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
