"""CDC operators against a row-by-row replay."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tablewright.operators.cdc import cdc_refresh, cdc_scd1, cdc_scd2, cdc_validate
from tablewright.operators.scd import scd2_as_of, scd2_overlaps

SCHEMA = "id int, a string, b string, op string, seq int"
HOT = {"parts": 32, "min_rows": 40}
ARGS = dict(keys=["id"], sequence="seq", delete_when="op = 'D'", except_cols=["op", "seq"])


def events(seed=5, n=1500):
    rng = random.Random(seed)
    kinds = ["U", "U", "U", "U", "D", None]
    found = []
    for seq in range(n):
        key = 0 if rng.random() < 0.4 else rng.randrange(1, 40)
        found.append((key, rng.choice("xyz"), rng.choice(["p", "q", None]), rng.choice(kinds), seq))
    rng.shuffle(found)
    return found


def replay(data, tracked):
    """History by walking through the events of each key in order."""
    history = []
    by_key = defaultdict(list)
    for e in data:
        by_key[e[0]].append(e)
    for key, rows in by_key.items():
        row = None
        for _, a, b, op, seq in sorted(rows, key=lambda e: e[4]):
            values = {"a": a, "b": b}
            if op == "D":
                if row:
                    row["end"] = seq
                row = None
            elif row and all(row[c] == values[c] for c in tracked):
                row.update(values)
            else:
                if row:
                    row["end"] = seq
                row = dict(values, key=key, start=seq, end=None)
                history.append(row)
    return sorted((r["key"], r["a"], r["b"] or "", r["start"], r["end"] or -1) for r in history)


def as_rows(df):
    return sorted((r.id, r.a, r.b or "", r["__START_AT"], -1 if r["__END_AT"] is None else r["__END_AT"]) for r in df.collect())


@pytest.mark.parametrize("sizing", [{}, HOT])
@pytest.mark.parametrize("track", [None, ["a"], ["b"]])
def test_history_equals_replay(spark, track, sizing):
    data = events()
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    found = cdc_scd2(df, **ARGS, track=track, **sizing)
    assert as_rows(found) == replay(data, track or ["a", "b"])
    assert scd2_overlaps(found, ["id"], "__START_AT", "__END_AT", **sizing).count() == 0


@pytest.mark.parametrize("sizing", [{}, HOT])
def test_repeated_delivery_changes_nothing(spark, sizing):
    data = events(seed=8, n=300)
    often = data + [data[0]] * 2000
    df = spark.createDataFrame(often, SCHEMA).repartition(4)
    assert as_rows(cdc_scd2(df, **ARGS, **sizing)) == replay(data, ["a", "b"])


def test_open_history_is_current_state(spark):
    df = spark.createDataFrame(events(), SCHEMA)
    current = sorted((r.id, r.a, r.b or "") for r in cdc_scd1(df, **ARGS).collect())
    opened = cdc_scd2(df, **ARGS).filter("`__END_AT` IS NULL")
    assert current == sorted((r.id, r.a, r.b or "") for r in opened.collect())


def test_any_split_into_batches(spark):
    data = events(n=400)
    log = spark.createDataFrame(data, SCHEMA)
    rebuild = lambda e: cdc_scd2(e, **ARGS)
    seen, target = data[:100], rebuild(spark.createDataFrame(data[:100], SCHEMA))
    for start in (100, 250):
        batch = data[start : start + 150]
        seen = seen + batch
        target = cdc_refresh(
            target, spark.createDataFrame(seen, SCHEMA), spark.createDataFrame(batch, SCHEMA), ["id"], rebuild
        )
    assert as_rows(target) == as_rows(rebuild(log))


def test_state_at_every_point(spark):
    data = events(n=120)
    history = cdc_scd2(spark.createDataFrame(data, SCHEMA), **ARGS).cache()
    for at in (0, 37, 119):
        seen = spark.createDataFrame([e for e in data if e[4] <= at], SCHEMA)
        expected = sorted((r.id, r.a, r.b or "") for r in cdc_scd1(seen, **ARGS).collect())
        found = scd2_as_of(history, at, "__START_AT", "__END_AT").collect()
        assert expected == sorted((r.id, r.a, r.b or "") for r in found)


def test_truncate_and_ignore_nulls(spark):
    data = [
        (1, "x", "p", "U", 1), (1, None, "q", "U", 2), (1, "y", None, "U", 3),
        (2, "x", "p", "U", 4), (2, None, None, "D", 5), (2, None, "r", "U", 6),
        (3, "x", "p", "U", 7), (3, None, None, "D", 8),
        (4, None, None, "U", 9),
    ]
    df = spark.createDataFrame(data, SCHEMA)
    kept = {tuple(r) for r in cdc_scd1(df, **ARGS, ignore_nulls=True).collect()}
    assert kept == {(1, "y", "q"), (2, None, "r"), (4, None, None)}
    truncated = df.withColumn("op", F.when(F.col("seq") == 4, "T").otherwise(F.col("op")))
    left = cdc_scd1(truncated, **ARGS, truncate_when="op = 'T'")
    assert {tuple(r) for r in left.collect()} == {(2, None, "r"), (4, None, None)}


def test_sequence_of_two_columns(spark):
    data = [(1, "x", None, "U", 1, 9), (1, "y", None, "U", 2, 1), (1, "z", None, "D", 2, 3)]
    df = spark.createDataFrame(data, "id int, a string, b string, op string, day int, n int")
    found = cdc_scd2(df, ["id"], ["day", "n"], "op = 'D'", except_cols=["op", "day", "n"])
    bounds = sorted((r.a, tuple(r["__START_AT"]), tuple(r["__END_AT"])) for r in found.collect())
    assert bounds == [("x", (1, 9), (2, 1)), ("y", (2, 1), (2, 3))]


def test_violations(spark):
    data = [(1, "x", None, "U", 1), (1, "y", None, "U", 1), (2, "x", None, "U", None), (3, "x", None, "T", 5), (3, "x", None, "T", 5)]
    df = spark.createDataFrame(data, SCHEMA)
    found = {tuple(r) for r in cdc_validate(df, ["id"], "seq", 2, "op = 'T'").collect()}
    assert found == {(1, "ambiguous_sequence", 2), (2, "null_sequence", 1), (3, "truncate_in_history", 2)}
