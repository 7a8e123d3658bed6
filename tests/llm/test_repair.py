"""Repair of conversations against plain dynamic programming over whole conversations."""

import hashlib
import random
import zlib

import pytest

from tablewright.llm.repair import Lattice, damaged, repaired

KIND = "conv_id bigint, turn bigint, role string, text string, chunk string, at int, conv string"
WHITE = " \t\n\x0b\x0c\r"
AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
MADE = {0: 2, 1: 2, 2: 3, 3: 2}


def cheapest(initials, drop, open_, start=0, ends=(0, 3)):
    """Cost and audit from each state before the last, second last, ... row to the end."""
    far = (10**9, "")
    below = {s: (0, "") if s in ends else far for s in range(4)}
    for i in range(len(initials), -1, -1):
        if i < len(initials):
            here = {}
            for s in range(4):
                ways = [(below[s][0] + 3, "D" + below[s][1])]
                if not drop[i]:
                    late = 1 if open_[i] else 0
                    ways.append((below[MADE[s]][0] + 2 + late, "R" + below[MADE[s]][1]))
                    if (s, initials[i]) in AFTER:
                        t = AFTER[s, initials[i]]
                        ways.append((below[t][0] + late, "K" + below[t][1]))
                here[s] = min(ways)
            below = here
        for _ in range(5):  # inserts lead to a state of the same place
            below = {s: min(below[s], (below[MADE[s]][0] + 2, "I" + below[MADE[s]][1])) for s in range(4)}
    return below[start]


def rebuilt(audit, rows):
    state, out, rows = 0, [], iter(rows)
    for edit in audit:
        if edit == "I":
            out.append(("assistant" if state == 2 else "user") + ":")
            state = MADE[state]
            continue
        role, text = next(rows)
        if edit == "K":
            out.append(f"{role}:{text}")
            state = AFTER[state, role[:1]]
        elif edit == "R":
            out.append(("assistant" if state == 2 else "user") + f":{text}")
            state = MADE[state]
    return "\n".join(out)


def damage(rows):
    for conv, turn, role, text, *_ in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else text.translate({ord(c): None for c in ".!?"}) if kind == 2 else text
        for _ in range(2 if kind == 3 else 1):
            yield conv, turn, "user" if kind == 4 else role, text


def brute(rows, originals):
    convs = {c: [] for c in originals}
    for conv, turn, role, text, *_ in rows:
        convs[conv].append((turn, role if role is not None else " ", text if text is not None else " "))
    out = set()
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = {t for t, _, _ in own if t is not None}
        initials = [r[:1] for _, r, _ in own]
        blank = [not t.strip(WHITE) for _, _, t in own]
        twice = [own[i][1:] in [o[1:] for o in own[:i]] and not blank[i] for i in range(len(own))]
        drop = [a or b for a, b in zip(blank, twice)]
        late = [not d and t.rstrip(WHITE)[-1:] not in ".!?" for d, (_, _, t) in zip(drop, own)]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = cheapest(initials, drop, late)
        text = rebuilt(audit, [o[1:] for o in own])
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.add((conv, gaps, sum(blank), sum(twice), sum(late), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return out


def made(df):
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    found = [tuple(r) for r in df.select(*names).collect()]
    assert len(found) == len(set(found))
    return set(found)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    texts = ["Yes.", "no", "Really?\n", "", None, "\t \n", "a.b", "é!", "long word " * 30, "x.  "]
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool"]
    out = []
    for c in [*range(60), None, -5, 10**15]:
        for t in range(rng.choice([1, 2, 3, 6, 12, 30])):
            out.append((c, rng.choice([t, t, t, t + 3, None]), rng.choice(roles), rng.choice(texts), "x", 1, "y"))
    out += [(5, 2, "user", "the same row", None, None, None)] * 40
    out += [(70, t, "user" if t % 3 else "assistant", f"turn {t % 50}.", None, None, None) for t in range(400)]
    out += [(71, 0, "user", "z" * 400_000, None, None, None), (71, 1, "assistant", "w" * 300_000 + ".", None, None, None)]
    return out


def test_search_is_the_least_of_the_cheapest():
    rng = random.Random(3)
    for n in [0, 1, 2, 3, 4, 5, 6, 7, 8, 12, 60] * 30:
        initials = [rng.choice("suaux") for _ in range(n)]
        drop, open_ = ([rng.random() < 0.25 for _ in range(n)] for _ in range(2))
        for start, ends in [(0, (0, 3)), (rng.randrange(4), (rng.randrange(1, 4),))]:
            expected = cheapest(initials, drop, open_, start, ends)
            found = Lattice("".join(initials), drop, open_).cheapest(start, ends)
            assert found == (expected if expected[0] < 10**8 else None)


@pytest.mark.parametrize("chunk_bytes", [512, 2048, 262_144])
def test_repair_against_brute_force(spark, rows, chunk_bytes):
    df = spark.createDataFrame(rows, KIND).repartition(6)
    expected = brute([r[:4] for r in rows], {r[0] for r in rows})
    assert made(repaired(df, df, chunk_bytes)) == expected


def test_damage_and_repair_against_brute_force(spark, rows):
    gone = next(c for c in range(1000, 9999) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    rows = [*rows, (gone, 1, "user", "Only this.", None, None, None)]
    df = spark.createDataFrame(rows, KIND)
    found = made(repaired(damaged(df), df))
    assert found == brute(damage(rows), {r[0] for r in rows})
    assert (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in found


def test_one_conversation_over_many_partitions(spark):
    rows = [(1, t, ["user", "assistant", "user"][t % 3], f"text {t}" + "." * (t % 2), "", 0, "") for t in range(1500)]
    df = spark.createDataFrame(rows, KIND).repartition(16)
    assert made(repaired(df, df)) == brute([r[:4] for r in rows], {1})


def test_no_conversations(spark):
    none = spark.createDataFrame([], KIND)
    assert repaired(damaged(none), none).count() == 0
    some = spark.createDataFrame([(None, None, None, None, None, None, None)], KIND)
    assert made(repaired(some, some)) == brute([(None, None, None, None)], {None})
    assert repaired(none, some.union(some)).count() == 1
