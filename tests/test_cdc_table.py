"""Streams of changes with truncates, lost tasks, folding and pruning, against one run over all events."""

import os
import random

import pytest

from tablewright.operators.cdc import cdc_refresh, cdc_scd1, cdc_scd2
from tablewright.streaming.cdc_table import CdcTable

SCHEMA = "id int, v string, w string, op string, day int, seq int"
GONE = ["op", "day", "seq"]


def events(seed, n=400, truncates=5):
    rng = random.Random(seed)
    out = []
    for seq in range(n):
        key = 0 if rng.random() < 0.3 else rng.randrange(1, 25)
        out.append((key, rng.choice("abc"), rng.choice(["x", None]), rng.choice(["U", "U", "U", "D", None]), seq // 10, seq))
    for seq in rng.sample(range(n), truncates):
        out[seq] = (None, None, None, "T", seq // 10, seq)
    rng.shuffle(out)
    return out


def batches(rows, n):
    return [rows[i::n] for i in range(n)]


def scd1(nulls=False):
    return lambda e: cdc_scd1(e, ["id"], ["day", "seq"], "op = 'D'", except_cols=GONE, ignore_nulls=nulls)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


@pytest.mark.parametrize("seed,truncates,nulls", [(1, 5, True), (2, 1, False)])
def test_truncates_in_any_order(spark, folder, seed, truncates, nulls):
    rows = events(seed, truncates=truncates)
    table = CdcTable(f"{folder}/t", ["id"], scd1(nulls), ["day", "seq"], "op = 'T'", fold_every=3)
    seen = []
    for number, batch in enumerate(batches(rows, 4)):
        table.write(spark.createDataFrame(batch, SCHEMA), number)
        seen += batch
        if number in (1, 3):
            upto = spark.createDataFrame(seen, SCHEMA)
            expected = cdc_scd1(upto, ["id"], ["day", "seq"], "op = 'D'", "op = 'T'", GONE, nulls)
            assert rows_of(table.read(spark), "id", "v", "w") == rows_of(expected, "id", "v", "w")


@pytest.mark.parametrize("share", [3, 40])
def test_refresh_with_truncates(spark, share):
    rows = events(4, truncates=3)
    late = rows[::share]
    log, batch = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(late, SCHEMA)
    early = spark.createDataFrame([r for r in rows if r not in late], SCHEMA)
    args = (["id"], ["day", "seq"], "op = 'D'", "op = 'T'", GONE)
    found = cdc_refresh(cdc_scd1(early, *args), log, batch, ["id"], scd1(), ["day", "seq"], "op = 'T'")
    assert rows_of(found) == rows_of(cdc_scd1(log, *args))


def test_a_truncate_without_a_sequence_is_refused(folder):
    with pytest.raises(ValueError, match="sequence"):
        CdcTable(folder, ["id"], scd1(), truncate_when="op = 'T'")


def test_folding_changes_nothing_and_bounds_the_folders(spark, folder):
    rebuild = lambda e: cdc_scd2(e, ["id"], "seq", "op = 'D'", except_cols=GONE)
    rows = events(6, truncates=0)
    table = CdcTable(f"{folder}/t", ["id"], rebuild, fold_every=3)
    for number, batch in enumerate(batches(rows, 7)):
        table.write(spark.createDataFrame(batch, SCHEMA), number)
        table.write(spark.createDataFrame(batch, SCHEMA), number)
    before = rows_of(table.read(spark))
    assert before == rows_of(rebuild(spark.createDataFrame(rows, SCHEMA)).select(*table.read(spark).columns))
    reading = table.read(spark)
    table.fold(spark)
    assert rows_of(reading) == before == rows_of(table.read(spark))  # also for who began to read before
    path = f"{folder}/t".removeprefix("file:")
    generations = [d for d in os.listdir(path) if d.startswith("generation=")]
    assert len(generations) == 2
    for generation in generations:
        assert all(len([f for f in os.listdir(f"{path}/{generation}/{d}") if "=" in f]) <= 4 for d in os.listdir(f"{path}/{generation}"))


def test_a_batch_that_fails_halfway_is_neither_seen_nor_lost(spark, folder):
    broken = []

    def rebuild(e):
        if broken:
            raise RuntimeError("lost")
        return scd1()(e)

    table = CdcTable(f"{folder}/t", ["id"], rebuild, ["day", "seq"], "op = 'T'")
    first, second = batches(events(7), 2)
    table.write(spark.createDataFrame(first, SCHEMA), 0)
    before = rows_of(table.read(spark))
    broken.append(1)
    with pytest.raises(RuntimeError):
        table.write(spark.createDataFrame(second, SCHEMA), 1)
    assert rows_of(table.read(spark)) == before
    broken.clear()
    table.write(spark.createDataFrame(second, SCHEMA), 1)
    expected = cdc_scd1(spark.createDataFrame(first + second, SCHEMA), ["id"], ["day", "seq"], "op = 'D'", "op = 'T'", GONE)
    assert rows_of(table.read(spark)) == rows_of(expected)


def test_a_small_batch_reads_little_of_the_log(spark, folder):
    n = 1_000_000
    log = spark.range(0, n).selectExpr("cast(id as int) id", "'v' v", "'w' w", "'U' op", "0 day", "0 seq")
    table = CdcTable(f"{folder}/t", ["id"], scd1(), rows_per_file=10_000)
    table.write(log, 0)
    for keys in (range(500_000, 501_000), [*range(7_000, 7_500), *range(900_000, 900_500)], [3], [n + 5]):
        batch = spark.createDataFrame([(k, "new", None, "U", 1, 1) for k in keys], SCHEMA)
        read = sum(r["__rows"] for r in table.files_for(spark, batch).collect())
        assert read < 0.05 * n
    table.write(spark.createDataFrame([(k, "new", None, "U", 1, 1) for k in range(500_000, 501_000)], SCHEMA), 1)
    assert dict(table.read(spark).groupBy("v").count().collect()) == {"new": 1000, "v": n - 1000}


def test_composite_keys(spark, folder):
    schema = "a int, b string, v int, seq int"
    rebuild = lambda e: cdc_scd1(e, ["a", "b"], "seq", except_cols=["seq"])
    table = CdcTable(f"{folder}/t", ["a", "b"], rebuild, "seq", rows_per_file=2)
    rows = [(i % 5, "xyz"[i % 3], i, i * 7 % 40) for i in range(40)]
    for number, batch in enumerate(batches(rows, 4)):
        table.write(spark.createDataFrame(batch, schema), number)
    assert rows_of(table.read(spark)) == rows_of(rebuild(spark.createDataFrame(rows, schema)))
