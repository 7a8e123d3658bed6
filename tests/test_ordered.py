"""Sliced windows against brute force, with a key that holds a third of the rows."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tablewright.operators.ordered import OrderedGroups, latest, rank_in_group, running_total, top_n

SMALL = {"parts": 32, "min_rows": 40}


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(3)
    data = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else (None if i % 3 == 1 and i % 2 else f"k{i % 200}")
        data.append((key, rng.choice([None, *range(60)]), i, rng.choice([None, 1, 2, 3])))
    rng.shuffle(data)
    return spark.createDataFrame(data, "k string, s int, id int, v int").repartition(4).cache(), data


def low(x):
    return (0, 0) if x is None else (1, x)


def groups(data):
    found = defaultdict(list)
    for row in data:
        found[row[0]].append(row)
    return found


def test_hot_groups_are_sliced(skewed):
    g = OrderedGroups(skewed[0], ["k"], ["s", "id"], **SMALL)
    assert g.sliced and not g.heavy_ties
    sizes = {(r["k"], r["__slice"]): r["count"] for r in g.df.groupBy("k", "__slice").count().collect()}
    hot = [n for (k, _), n in sizes.items() if k == "hot"]
    assert len(hot) > 5 and max(hot) < 300 and sum(sizes.values()) == 3000


def test_small_tables_are_left_alone(skewed):
    assert not OrderedGroups(skewed[0], ["k"], ["id"]).sliced


@pytest.mark.parametrize("sizing", [SMALL, {}])
def test_running_total(skewed, sizing):
    df, data = skewed
    found = {r.id: r.t for r in running_total(df, ["k"], ["-s", "id"], "v", "t", **sizing).collect()}
    for rows in groups(data).values():
        total = None
        for row in sorted(rows, key=lambda r: (tuple(-x for x in low(r[1])), r[2])):
            if row[3] is not None:
                total = (total or 0) + row[3]
            assert found[row[2]] == total
    assert len(found) == len(data)


@pytest.mark.parametrize("sizing", [SMALL, {}])
def test_rank(skewed, sizing):
    df, data = skewed
    found = {r.id: r.r for r in rank_in_group(df, ["k"], ["-s"], "r", **sizing).collect()}
    for rows in groups(data).values():
        for row in rows:
            assert found[row[2]] == 1 + sum(low(o[1]) > low(row[1]) for o in rows)
    assert len(found) == len(data)


@pytest.mark.parametrize("ahead", [False, True])
@pytest.mark.parametrize("sizing", [SMALL, {}])
def test_neighbours_in_a_subset(skewed, sizing, ahead):
    df, data = skewed
    g = OrderedGroups(df, ["k"], ["s", "id"], **sizing)
    subset = g.df.filter("v = 2")
    found = g.with_neighbour(subset, F.struct(F.col("id").alias("x")), "n", ahead)
    found = {r.id: r.n and r.n.x for r in found.collect()}
    for rows in groups([r for r in data if r[3] == 2]).values():
        ids = [r[2] for r in sorted(rows, key=lambda r: (low(r[1]), r[2]))]
        for i, x in enumerate(ids):
            j = i + 1 if ahead else i - 1
            assert found[x] == (ids[j] if 0 <= j < len(ids) else None)


def test_running_total_over_copies(spark):
    """One row a thousand times: the totals are those of any order."""
    df = spark.createDataFrame([("a", 1, 1)] * 1000 + [("a", 2, 5)], "k string, s int, v int").repartition(8)
    found = running_total(df, ["k"], ["s"], "v", "t", **SMALL)
    assert sorted(r.t for r in found.collect()) == [*range(1, 1001), 1005]


def test_rank_over_copies(spark):
    df = spark.createDataFrame([("a", 1)] * 1000 + [("a", 2)] * 5, "k string, s int").repartition(8)
    found = rank_in_group(df, ["k"], ["-s"], "r", **SMALL).groupBy("s", "r").count().collect()
    assert {tuple(r) for r in found} == {(2, 1, 5), (1, 6, 1000)}


def test_latest_and_top_n(skewed):
    df, data = skewed
    newest = {r.k: r.id for r in latest(df, ["k"], ["-s", "id"]).collect()}
    best = {(r.k, r.id) for r in top_n(df, ["k"], ["-s"], 2, "r").collect()}
    for key, rows in groups(data).items():
        order = sorted(rows, key=lambda r: (tuple(-x for x in low(r[1])), r[2]))
        assert newest[key] == order[0][2]
        for row in rows:
            rank = 1 + sum(low(o[1]) > low(row[1]) for o in rows)
            assert ((key, row[2]) in best) == (rank <= 2)


def test_neighbours_among_copies(spark):
    df = spark.createDataFrame([("a", 1)] * 1000 + [("a", 2)] * 3, "k string, s int").repartition(8)
    g = OrderedGroups(df, ["k"], ["s"], break_ties=True, **SMALL)
    found = g.with_neighbour(g.df, F.struct(F.col("s").alias("x")), "n")
    counts = {tuple(r) for r in found.groupBy("s", "n.x").count().collect()}
    assert g.sliced and counts == {(1, None, 1), (1, 1, 999), (2, 1, 1), (2, 2, 2)}


def test_slices_hold_the_rows_of_a_task(spark):
    """One key holds 90 % of the rows, half of them ties: the largest slice is at most three times the median."""
    key = F.when(F.col("id") % 10 > 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 70).cast("string")))
    order = F.when(F.col("id") % 2 == 0, F.lit(5)).otherwise(F.col("id"))
    df = spark.range(40_000).select(key.alias("k"), order.alias("s"), "id").repartition(8)
    g = OrderedGroups(df, ["k"], ["s", "id"], min_rows=1_000)
    sizes = sorted(r["count"] for r in g.df.filter("k = 'hot'").groupBy("__slice").count().collect())
    assert 25 <= len(sizes) <= 50 and sizes[-1] <= 3 * sizes[len(sizes) // 2] and sum(sizes) == 36_000
    found = running_total(df, ["k"], ["s"], "id", "t", min_rows=1_000).filter("k = 'hot'")
    last = found.agg(F.max("t")).first()[0]
    assert last == df.filter("k = 'hot'").agg(F.sum("id")).first()[0]
