"""A trie of conversations by shared first turns, built from adaptive radix trees over turn ids."""

from __future__ import annotations

import hashlib
import os
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tablewright.llm.common import stored
from tablewright.llm.numbering import numbered

WIDTH = 16  # bytes of a turn id
_FLUSH_ROWS, _FLUSH_BYTES = 20_000, 8_000_000
_LANES = 4  # of 32 bits each, in which what stands before a segment is summed


class Node:
    """A node of an adaptive radix tree: a skipped path and 4, 16, 48 or 256 places for children.

    Up to 16 children lie beside their sorted bytes; 48 are found through a table of 256
    places; 256 have one place for each byte. A full node grows to the next layout.
    """

    __slots__ = ("skip", "places", "index", "children", "n", "least", "ends")

    def __init__(self, skip: bytes, n: int = 0, least: int | None = None):
        self.skip, self.n, self.least = skip, n, least
        self.places, self.index, self.children = 4, bytearray(), []
        self.ends: list[int] = []

    def find(self, byte: int) -> Node | None:
        if self.places <= 16:
            at = self.index.find(byte)
            return self.children[at] if at >= 0 else None
        if self.places == 48:
            at = self.index[byte]
            return self.children[at - 1] if at else None
        return self.children[byte]

    def put(self, byte: int, child: Node) -> None:
        if self.places < 256 and len(self.children) == self.places:
            self._grow()
        if self.places <= 16:
            at = sum(b < byte for b in self.index)
            self.index.insert(at, byte)
            self.children.insert(at, child)
        elif self.places == 48:
            self.children.append(child)
            self.index[byte] = len(self.children)
        else:
            self.children[byte] = child

    def _grow(self) -> None:
        found = list(self.items())
        if self.places == 4:
            self.places = 16
        elif self.places == 16:
            self.places, self.index, self.children = 48, bytearray(256), [c for _, c in found]
            for i, (byte, _) in enumerate(found):
                self.index[byte] = i + 1
        else:
            self.places, self.index, self.children = 256, bytearray(), [None] * 256
            for byte, child in found:
                self.children[byte] = child

    def items(self) -> Iterator[tuple[int, Node]]:
        """Children in the order of their bytes."""
        if self.places <= 16:
            yield from zip(self.index, self.children)
        elif self.places == 48:
            yield from ((b, self.children[at - 1]) for b, at in enumerate(self.index) if at)
        else:
            yield from ((b, c) for b, c in enumerate(self.children) if c is not None)

    def split(self, at: int) -> None:
        """Cut the skipped path: what lies below the cut moves into a child."""
        lower = Node(self.skip[at + 1 :], self.n, self.least)
        lower.places, lower.index, lower.children, lower.ends = self.places, self.index, self.children, self.ends
        byte, self.skip = self.skip[at], self.skip[:at]
        self.places, self.index, self.children, self.ends = 4, bytearray(), [], []
        self.put(byte, lower)


class RadixTree:
    """Members under byte strings. Each node counts the members below it and knows the smallest."""

    def __init__(self) -> None:
        self.root = Node(b"")

    def insert(self, key: bytes, member: int, ends: bool) -> None:
        """``ends`` says that the key is all of the member, not only its first part."""
        node, at = self.root, 0
        while True:
            if not key.startswith(node.skip, at):
                node.split(len(os.path.commonprefix([node.skip, key[at : at + len(node.skip)]])))
            at += len(node.skip)
            node.n += 1
            node.least = member if node.least is None else min(node.least, member)
            if at == len(key):
                if ends:
                    node.ends.append(member)
                return
            below = node.find(key[at])
            if below is None:
                node.put(key[at], below := Node(key[at + 1 :]))
            node, at = below, at + 1

    def aligned(self, width: int) -> Iterator[tuple[bytes, Node, list[int]]]:
        """For each byte depth that is a multiple of ``width``: the key so far, its node, and who ends there."""
        todo = [(b"", 0, self.root)]
        while todo:
            head, start, node = todo.pop()
            key = head + node.skip
            for depth in range(-(-start // width) * width, len(key) + 1, width):
                yield key[:depth], node, node.ends if depth == len(key) else []
            for byte, child in node.items():
                todo.append((key + bytes([byte]), len(key) + 1, child))


def turn_id(role: Column, text: Column) -> Column:
    """128 bits of a turn as a big-endian number of fixed width; the role's length keeps both apart."""
    return F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)))


def _lanes(data: bytes) -> tuple[int, ...]:
    return struct.unpack(f">{_LANES}I", data)


def _moved(prefix: bytes, k: int, path: bytes) -> bytes:
    """What stands before segment ``k + 1``: the sum over all segments before it."""
    own = hashlib.md5(struct.pack(">q", k) + path).digest()
    return struct.pack(f">{_LANES}I", *[(a + b) % 2**32 for a, b in zip(_lanes(prefix), _lanes(own))])


def _rows_of(tree: RadixTree, k: int, prefix: bytes, segment: int, chars: dict[bytes, int], out: dict[str, list]) -> None:
    """Nodes of one tree as rows; a key names a node by all turns from the root of the whole trie on."""
    top = hashlib.md5(prefix + struct.pack(">q", k))
    keys: dict[bytes, hashlib._Hash] = {b"": top}
    for path, node, ends in tree.aligned(WIDTH):
        depth = len(path) // WIDTH
        if depth:
            above = keys[path[:-WIDTH]]
            keys[path] = here = above.copy()
            here.update(path[-WIDTH:])
            if depth == segment:  # the same node as the root of the next segment
                here = hashlib.md5(_moved(prefix, k, path) + struct.pack(">q", k + 1))
        elif k:
            continue  # the segment before has this node
        ends = sorted(ends)
        out["node"].append((here if depth else top).digest())
        out["parent"].append(above.digest() if depth else None)
        out["depth"].append(k * segment + depth)
        out["chars"].append(chars[path[-WIDTH:]] if depth else 0)
        out["n"].append(node.n)
        out["member"].append(node.least)
        out["first_end"].append(ends[0] if ends else None)
        out["ends"].append(",".join(map(str, ends)) if ends else None)


_KIND = "node binary, parent binary, depth bigint, chars bigint, n bigint, member bigint, first_end bigint, ends string"
_ARROW = pa.schema(
    [("node", pa.binary()), ("parent", pa.binary())]
    + [(c, pa.int64()) for c in ("depth", "chars", "n", "member", "first_end")]
    + [("ends", pa.string())]
)


def _local_nodes(segments: DataFrame, segment: int) -> DataFrame:
    """Partial nodes from one radix tree per task, prefix and 20,000 rows; ranges keep shared paths together."""

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, at, rows, size, chars = RadixTree(), None, 0, 0, {}

        def made() -> pa.RecordBatch:
            out = {name: [] for name in _ARROW.names}
            _rows_of(tree, *at, segment, chars, out)
            return pa.RecordBatch.from_pydict(out, schema=_ARROW)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("k", "prefix", "path", "chars", "conv_id", "last")]
            for k, prefix, path, lengths, member, last in zip(*columns):
                if at != (k, prefix) or rows >= _FLUSH_ROWS or size >= _FLUSH_BYTES:
                    if rows:
                        yield made()
                    tree, at, rows, size, chars = RadixTree(), (k, prefix), 0, 0, {}
                tree.insert(path, member, last)
                for i, n in enumerate(lengths):
                    chars[path[i * WIDTH : (i + 1) * WIDTH]] = n
                rows, size = rows + 1, size + len(path)
        if rows:
            yield made()

    # The first four turns part the ranges, then the id, so that no path is too common to be split.
    dealt = segments.repartitionByRange("k", "prefix", F.substring("path", 1, 4 * WIDTH), "conv_id")
    return dealt.sortWithinPartitions("k", "prefix", "path", "conv_id").mapInArrow(grow, _KIND)


def _end_hashes(nodes: DataFrame) -> DataFrame:
    """SHA-256 of the ids that end at each node, from lists that are already joined and in order.

    The hash of a list is one pass by its definition; a common conversation's lists of up
    to 20,000 ids are streamed through it and never held together.
    """

    def pour(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for batch in batches:
            done = []
            for node, ids in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist()):
                if node == last:
                    state.update(b",")
                else:
                    if last is not None:
                        done.append((last, state.hexdigest()))
                    last, state = node, hashlib.sha256()
                state.update(ids.encode())
            yield pa.RecordBatch.from_arrays(
                [pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], names=["node", "ends_sha256"]
            )
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.binary()), pa.array([state.hexdigest()])], names=["node", "ends_sha256"])

    lists = nodes.filter("ends is not null").select("node", "first_end", "ends")
    return lists.repartition("node").sortWithinPartitions("node", "first_end").mapInArrow(pour, "node binary, ends_sha256 string")


def _chain_totals(rows: DataFrame) -> DataFrame:
    """Of each chain, its own sums and those of all chains below it, by pointer doubling.

    The nodes with the same smallest member are a chain, which hangs from a node of another
    chain. After round i a chain holds the sums of the chains less than 2^i levels below.
    """
    top = F.min(F.struct("depth", "parent_conv_id"))
    chains = rows.groupBy("conv_id").agg(top.alias("top"), F.sum("own_saved").alias("saved"), F.sum("own_leaf").alias("leaves"))
    chains = chains.select("conv_id", F.col("top.depth").alias("depth"), F.col("top.parent_conv_id").alias("parent"), "saved", "leaves")
    chains = stored(chains, "trie-chains")
    state = chains.select("conv_id", F.col("parent").alias("up"), "saved", "leaves")
    while not state.filter("up is not null").isEmpty():
        more = state.filter("up is not null").groupBy(F.col("up").alias("conv_id"))
        more = more.agg(F.sum("saved").alias("more_saved"), F.sum("leaves").alias("more_leaves"))
        higher = state.filter("up is not null").select(F.col("conv_id").alias("up"), F.col("up").alias("higher"))
        state = state.join(higher, "up", "left").join(more, "conv_id", "left")
        plus = lambda a: F.col(a) + F.coalesce(F.col(f"more_{a}"), F.lit(0))
        state = stored(state.select("conv_id", F.col("higher").alias("up"), plus("saved").alias("saved"), plus("leaves").alias("leaves")), "trie-totals")
    return chains.select("conv_id", "depth", "parent").join(state.drop("up"), "conv_id")


def trie_of(turns: DataFrame, members: DataFrame, segment: int = 256) -> DataFrame:
    """One row per distinct sequence of first turns, from the empty one at the root on.

    ``turns`` has ``conv_id``, ``at`` (from 1 without gaps), ``id`` (16 bytes) and ``chars``;
    ``members`` has ``conv_id`` and ``total``, its number of turns, for all conversations,
    also those without turns. Returns ``conv_id`` (the smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and
    ``ends_sha256``; the first two identify a node.

    Conversations are cut into segments of ``segment`` turns. A segment goes into a tree
    with those that have the same turns before it, named by the sum of the hashes of all
    earlier segments. Sums over subtrees run along chains of nodes with one smallest member.
    """
    k = F.expr(f"(at - 1) div {segment}").alias("k")
    cut = turns.groupBy("conv_id", k).agg(F.array_sort(F.collect_list(F.struct("at", "id", "chars"))).alias("turns"))
    cut = cut.select(
        "conv_id", "k", F.expr("aggregate(turns, X'', (a, t) -> concat(a, t.id))").alias("path"),
        F.expr("transform(turns, t -> t.chars)").alias("chars"),
    )
    empty = F.lit(bytes(4 * _LANES))
    cut = members.join(cut, "conv_id", "left").select(
        "conv_id", "total", F.coalesce("k", F.lit(0).cast("bigint")).alias("k"), F.coalesce("path", F.lit(b"")).alias("path"),
        F.coalesce("chars", F.expr("cast(array() as array<bigint>)")).alias("chars"),
    )
    cut = stored(cut.withColumn("last", F.expr(f"k = greatest(total - 1, 0) div {segment}")), "trie-segments")
    names = {f"before{i}": f"lane{i}" for i in range(_LANES)}
    own = F.md5(F.concat(F.unhex(F.lpad(F.hex("k"), 16, "0")), F.col("path")))
    lanes = {f"lane{i}": F.conv(F.substring(own, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(_LANES)}
    long = numbered(cut.filter(f"total > {segment}").withColumns(lanes), "conv_id", ["conv_id", "k"], names, "trie-long")
    sums = [F.lpad(F.hex(F.col(name) % 2**32), 8, "0") for name in names]
    long = long.withColumn("prefix", F.unhex(F.concat(*sums)))
    short = cut.filter(f"total <= {segment}").withColumn("prefix", empty)
    columns = ["conv_id", "k", "prefix", "path", "chars", "last"]
    local = stored(_local_nodes(short.select(*columns).unionAll(long.select(*columns)), segment), "trie-local")

    nodes = local.groupBy("node").agg(
        F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.max("chars").alias("chars"), F.sum("n").alias("n_convs"),
        F.min("member").alias("conv_id"),
    )
    nodes = stored(nodes, "trie-nodes")
    root = nodes.filter("depth = 0").agg(F.min("conv_id")).first()[0]
    kids = nodes.filter("parent is not null").groupBy("parent").agg(F.count("*").alias("n_children"))
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("found_parent"))
    # The root, which may have most nodes as children, takes no part in the join.
    deep = nodes.filter("depth > 1").join(above, "parent", "left")
    flat = nodes.filter("depth <= 1").withColumn("found_parent", F.when(F.col("depth") == 1, F.lit(root)))
    rows = deep.select(*nodes.columns, "found_parent").unionAll(flat.select(*nodes.columns, "found_parent"))
    rows = rows.join(kids.withColumnRenamed("parent", "node"), "node", "left").join(_end_hashes(local), "node", "left")
    rows = rows.select(
        "conv_id", "depth", F.col("found_parent").alias("parent_conv_id"), "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("own_saved"), F.col("n_children").isNull().cast("bigint").alias("own_leaf"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
    rows = stored(rows, "trie-rows")

    hung = _chain_totals(rows).filter("parent is not null").groupBy(F.col("parent").alias("conv_id"), (F.col("depth") - 1).alias("depth"))
    hung = hung.agg(F.sum("saved").alias("hung_saved"), F.sum("leaves").alias("hung_leaves"))
    rows = rows.join(hung, ["conv_id", "depth"], "left")
    rows = rows.withColumns({
        "saved": F.col("own_saved") + F.coalesce("hung_saved", F.lit(0)), "leaves": F.col("own_leaf") + F.coalesce("hung_leaves", F.lit(0)),
    })
    rows = numbered(rows.withColumn("up", -F.col("depth")), "conv_id", ["conv_id", "up"], {"saved_below": "saved", "leaves_below": "leaves"}, "trie-sums")
    return rows.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", (F.col("leaves") + F.col("leaves_below")).alias("n_leaves"),
        (F.col("saved") + F.col("saved_below")).alias("saved_tokens"), "ends_sha256",
    )


def ordered_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows as ``conv_id``, ``at`` (from 1), ``id`` and ``chars``, in order of the turn.

    NULL turns come first; rows of one turn are ordered by role and the first 64 characters
    of the text, then by id. NULL roles and texts are empty. Rows without a conversation are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = conversations.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("bigint").alias("conv_id"), F.col(turn_col).alias("turn"), F.substring(role, 1, 64).alias("role"),
        F.substring(text, 1, 64).alias("text"), turn_id(role, text).alias("id"), F.char_length(text).cast("bigint").alias("chars"),
        F.lit(1).cast("bigint").alias("one"),
    )
    rows = numbered(rows, "conv_id", ["conv_id", "turn", "role", "text", "id"], {"at": "one"}, "trie-turns", ["conv_id", "id", "chars", "one"])
    return rows.select("conv_id", (F.col("at") + 1).alias("at"), "id", "chars")


def conversation_trie(conversations: DataFrame, **names: str) -> DataFrame:
    """The trie of the conversations of a table, as ``trie_of`` returns it."""
    turns = ordered_turns(conversations, **names)
    return trie_of(turns, turns.groupBy("conv_id").agg(F.count("*").alias("total")))


def grafted_trie(conversations: DataFrame, block: int = 100, most: int = 5, **names: str) -> DataFrame:
    """The trie after each conversation has taken over first turns of the first one of its block.

    Conversation c begins with the first h turns of conversation ``c - c % block``, as far as
    there are any, and goes on with its own from turn h + 1; h is the CRC-32 of its decimal
    id modulo ``most + 1``. A conversation may be left without turns; it is a member of the root.
    """
    turns = ordered_turns(conversations, **names)
    sizes = stored(turns.groupBy("conv_id").agg(F.count("*").alias("n")), "trie-sizes")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)
    sizes = sizes.select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % block).alias("base"))
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    sizes = sizes.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
    sizes = sizes.withColumn("total", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    sizes = stored(sizes.select("conv_id", "base", "h", "taken", "total"), "trie-plans")

    heads = turns.filter(F.col("at") <= most).withColumnRenamed("conv_id", "base")
    wanted = sizes.filter("taken > 0").select("conv_id", "base", F.explode(F.expr("sequence(1L, taken)")).alias("at"))
    first = wanted.join(heads, ["base", "at"]).select("conv_id", "at", "id", "chars")
    own = turns.filter(F.col("at") > F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1))
    # Most conversations keep their places; only the others are looked up.
    moved = sizes.filter("taken < h").select("conv_id", (F.col("h") - F.col("taken")).alias("less"))
    own = own.join(moved, "conv_id", "left").select("conv_id", (F.col("at") - F.coalesce("less", F.lit(0))).alias("at"), "id", "chars")
    return trie_of(first.unionAll(own), sizes.select("conv_id", "total"))
