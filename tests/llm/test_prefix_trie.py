"""The trie of conversations against a plain dictionary of prefixes."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tablewright.llm.prefix_trie import RadixTree, conversation_trie, grafted_trie, ordered_turns, trie_of

KIND = "conv_id bigint, turn bigint, role string, text string, node string, n bigint"


def turns_of(rows):
    """The turns of each conversation, in order."""
    out = {}
    for conv, turn, role, text, *_ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        if conv is not None:
            out.setdefault(conv, []).append((role or "", text or ""))
    return out


def grafted(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = convs.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])
        out[c] = base[:h] + own[h:]
    return out


def brute(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    rows = set()
    for path, ids in members.items():
        below = [p for p in members if p[: len(path)] == path]
        kids = {p for p in below if len(p) == len(path) + 1}
        leaves = sum(not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below) for p in below)
        saved = sum((len(members[p]) - 1) * (len(p[-1][1]) if p else 0) for p in below)
        ends = ",".join(str(c) for c in sorted(ids) if len(convs[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        rows.add((min(ids), len(path), parent, len(ids), len(kids), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return rows


def made(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    found = [tuple(r) for r in df.select(*names).collect()]
    assert len(found) == len(set(found))
    return set(found)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = []
    for c in [*range(0, 12), 100, 101, 250, 251, 399, -1, -100, -105, 7_000_000_000_100]:
        for t in range(rng.choice([1, 2, 3, 5, 9, 14])):
            out.append((c, t, rng.choice(["user", "user", None]), rng.choice(["a", "", None, "é b", "long " * 9]), "x", 1))
    out += [(300 + i, t, "user", f"same {t}", None, None) for i in range(40) for t in range(6)]
    out += [(5, None, "user", "no turn", None, None), (5, 1, "user", "tie", None, None), (5, 1, "user", "tie", None, None), (None, 1, "user", "none", None, None)]
    out += [(8, t, "user", str(t % 3), None, None) for t in range(20, 90)]
    out += [(9, 0, "user", "x" * 300_000, None, None)]
    return out


def test_trie_against_brute_force(spark, rows):
    df = spark.createDataFrame(rows, KIND)
    assert made(conversation_trie(df)) == brute(turns_of(rows))


def test_grafted_trie_against_brute_force(spark, rows):
    df = spark.createDataFrame(rows, KIND).repartition(7)
    assert made(grafted_trie(df)) == brute(grafted(turns_of(rows)))


@pytest.mark.parametrize("segment", [1, 2, 7])
def test_long_conversations_go_through_segments(spark, rows, segment):
    turns = ordered_turns(spark.createDataFrame(rows, KIND))
    members = turns.groupBy("conv_id").agg(F.count("*").alias("total"))
    assert made(trie_of(turns, members, segment)) == brute(turns_of(rows))


def test_one_conversation_over_many_partitions(spark):
    rows = [(1, t, "user", str(t % 5), None, None) for t in range(3000)] + [(2, t, "user", str(t % 5), None, None) for t in range(2000)]
    found = made(conversation_trie(spark.createDataFrame(rows, KIND).repartition(16)))
    assert len(found) == 3001 and {r[3] for r in found} == {1, 2}
    assert next(r for r in found if r[1] == 0)[4:7] == (1, 1, 2000)
    assert next(r for r in found if r[1] == 1999)[6] == 2


def test_no_conversations(spark):
    none = spark.createDataFrame([], KIND)
    assert grafted_trie(none).count() == conversation_trie(none).count() == 0
    assert grafted_trie(spark.createDataFrame([(None, 1, "user", "a", "", 0)], KIND)).count() == 0


def test_turnless_conversations_are_members_of_the_root(spark):
    alone = next(c for c in range(501, 600) if zlib.crc32(str(c).encode()) % 6 >= 2)
    found = made(grafted_trie(spark.createDataFrame([(alone, 1, "user", "a", "", 0)], KIND)))
    assert found == {(alone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(alone).encode()).hexdigest())}


def test_radix_tree_layouts():
    rng = random.Random(1)
    keys = [bytes(rng.randrange(n) for _ in range(6)) for n in (2, 12, 40, 256) for _ in range(600)]
    tree = RadixTree()
    for i, key in enumerate(keys):
        tree.insert(key, i, True)
    expected = {}
    for i, key in enumerate(keys):
        for d in (0, 2, 4, 6):
            expected.setdefault(key[:d], []).append(i)
    found = {path: (node.n, node.least, sorted(ends)) for path, node, ends in tree.aligned(2)}
    assert found == {p: (len(m), min(m), m if len(p) == 6 else []) for p, m in expected.items()}
    sizes, todo = set(), [tree.root]
    while todo:
        node = todo.pop()
        sizes.add(node.places)
        todo += [child for _, child in node.items()]
    assert sizes == {4, 16, 48, 256}
