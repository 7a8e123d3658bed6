import json

import pytest
from pyspark.sql import functions as F, types as T

from tablewright.operators.cdc import cdc_scd2
from tablewright.streaming import feed, ingest, sinks
from tablewright.streaming.cdc_table import CdcTable


def land(spark, path, *lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)


def run(spark, base, mode=ingest.ADD):
    ingest.ingest_stream(spark, f"{base}/in", f"{base}/schema", f"{base}/ckpt", f"{base}/out", mode).awaitTermination()
    return ingest.read_ingested(spark, f"{base}/out")


def test_schema_grows_and_keeps_its_types(spark, folder):
    land(spark, f"{folder}/in", '{"id": 1, "v": 1.25}', '{"id": 2}')
    assert run(spark, folder).count() == 2
    land(spark, f"{folder}/in", '{"id": "x", "v": 2, "tags": ["a"], "o": {"p": 1}}', "{torn", "[1]", '{"id": 3, "n": null}')
    found = run(spark, folder)
    assert dict(found.dtypes) == {
        "id": "bigint", "v": "double", "tags": "array<string>", "o": "struct<p:bigint>", "n": "string", "_rescued_data": "string",
    }
    assert run(spark, folder).count() == 6
    rescued = {r.id: r._rescued_data for r in found.filter("_rescued_data IS NOT NULL AND v IS NOT NULL").collect()}
    assert {k: json.loads(v) for k, v in rescued.items()} == {None: {"id": "x"}}
    whole = {r._rescued_data for r in found.filter("v IS NULL AND _rescued_data IS NOT NULL").collect()}
    assert whole == {"{torn", "[1]"}
    assert [r.tags for r in found.filter("v = 2").collect()] == [["a"]]


def test_rescue_mode_keeps_the_schema(spark, folder):
    land(spark, f"{folder}/in", '{"id": 1}')
    run(spark, folder, ingest.RESCUE)
    land(spark, f"{folder}/in", '{"id": 2, "new": true, "o": {"p": 1}}')
    found = run(spark, folder, ingest.RESCUE)
    assert found.columns == ["id", "_rescued_data"]
    assert json.loads(found.filter("id = 2").first()._rescued_data) == {"new": True, "o": {"p": 1}}


def test_nothing_is_lost_inside_structs_or_by_casts(spark, folder):
    schema = T.StructType.fromDDL("id bigint, d double, b boolean, o struct<p:bigint,s:struct<t:string>>, a array<struct<x:bigint>>")
    lost = [
        '{"id":1.5}', '{"id":true}', '{"id":"7"}', '{"id":12345678901234567890}', '{"d":"1.5"}', '{"d":123456789.123456789123}', '{"d":false}', '{"d":12345678901234567891}',
        '{"b":1}', '{"b":"true"}', '{"o":{"p":1,"q":2}}', '{"o":{"p":1.5,"s":{"t":"k"}}}', '{"o":{"s":{"t":"k","u":[1]}}}', '{"o":7}',
        '{"a":[{"x":1},{"x":2,"y":3}]}', '{"a":[{"x":true}]}', '{"a":{"x":1}}',
    ]
    kept = [
        '{"id":1,"d":2,"b":true,"o":{"p":100,"s":{"t":"k"}},"a":[{"x":1},null]}', '{"id":null,"o":{"p":null,"z":null},"a":[]}',
        '{"id":2.0,"d":0.30000000000000004}', '{"d":1e-7,"o":{}}', '{"d":-120,"id":-9223372036854775808}', "{}",
    ]
    rows = ingest.parse_json_lines(spark.createDataFrame([(x,) for x in lost + kept], "value string"), schema).collect()
    for line, row in zip(lost, rows):
        (name, value), = json.loads(line, parse_float=str, parse_int=int).items()
        rescued = json.loads(row._rescued_data)
        assert list(rescued) == [name], line
        assert json.loads(row._rescued_data, parse_float=str) == {name: value}, line
    assert [r._rescued_data for r in rows[len(lost):]] == [None] * len(kept)
    assert [r.id for r in rows[:4]] == [None] * 4 and rows[10].o.p == 1 and rows[11].o.p is None and rows[11].o.s.t == "k"
    assert [e.x for e in rows[14].a] == [1, 2]
    first = rows[len(lost)]
    assert (first.id, first.d, first.b, first.o.p, first.o.s.t, first.a[0].x, first.a[1]) == (1, 2.0, True, 100, "k", 1, None)
    assert rows[len(lost) + 2].d == 0.30000000000000004 and rows[len(lost) + 4].id == -(2**63)


def test_nested_fields_are_added(spark, folder):
    land(spark, f"{folder}/in", '{"id": 1, "o": {"p": 1}, "a": [{"x": 1}]}')
    run(spark, folder)
    land(spark, f"{folder}/in", '{"id": 2, "o": {"p": 2, "q": {"r": "s"}}, "a": [{"x": 1, "y": 2}]}')
    with pytest.raises(Exception, match="o.q"):
        run(spark, folder, ingest.FAIL)
    found = run(spark, folder)
    row = found.filter("id = 2").first()
    assert row.o.q.r == "s" and row.a[0].y == 2 and row._rescued_data is None
    assert found.filter("id = 1").first().o.q is None


def test_fail_mode_stops_and_can_go_on(spark, folder):
    land(spark, f"{folder}/in", '{"id": 1}')
    run(spark, folder, ingest.FAIL)
    land(spark, f"{folder}/in", '{"id": 2, "new": 1}')
    with pytest.raises(Exception, match="new"):
        run(spark, folder, ingest.FAIL)
    assert run(spark, folder, ingest.ADD).filter("new = 1").count() == 1


def test_a_replayed_batch_changes_nothing(spark, folder):
    lines = spark.createDataFrame([('{"id": 1}',), ('{"id": 2, "b": "x"}',)], "value string")
    for _ in range(2):
        ingest.ingest_batch(lines, 0, f"{folder}/out", f"{folder}/schema", ingest.ADD, ingest.RESCUED)
    assert ingest.read_ingested(spark, f"{folder}/out").count() == 2


def test_upserts_are_resolved_and_folded(spark, folder):
    write = sinks.upsert_sink(f"{folder}/t", ["id"], ["-at"])
    batches = [[(1, "a", 5), (1, "b", 4), (2, "c", 1)], [(2, "d", 0)], [(3, "e", 9)]]
    for number, batch in enumerate(batches):
        for _ in range(2):
            write(spark.createDataFrame(batch, "id int, v string, at int"), number)
    expected = {(1, "a", 5), (2, "d", 0), (3, "e", 9)}
    assert {tuple(r) for r in sinks.read_upserts(spark, f"{folder}/t", ["id"]).collect()} == expected
    sinks.fold_upserts(spark, f"{folder}/t", f"{folder}/folded", ["id"])
    sinks.upsert_sink(f"{folder}/folded", ["id"], ["-at"])(spark.createDataFrame([(3, "f", 0)], "id int, v string, at int"), 3)
    folded = {tuple(r) for r in sinks.read_upserts(spark, f"{folder}/folded", ["id"]).collect()}
    assert folded == {(1, "a", 5), (2, "d", 0), (3, "f", 0)}


def test_cdc_sink_takes_late_events_and_replays(spark, folder):
    schema = "id int, v string, op string, seq int"
    rebuild = lambda e: cdc_scd2(e, ["id"], "seq", "op = 'D'", except_cols=["op", "seq"])
    table = CdcTable(f"{folder}/dim", ["id"], rebuild)
    batches = [
        [(1, "a", "U", 1), (1, "c", "U", 9), (2, "x", "U", 2)],
        [(1, "b", "U", 5)],
        [(2, None, "D", 1), (3, None, "D", 3)],
        [(1, None, "D", 7)],
    ]
    for number, batch in enumerate(batches):
        for _ in range(2):
            table.write(spark.createDataFrame(batch, schema), number)
    everything = spark.createDataFrame([e for b in batches for e in b], schema)
    found = table.read(spark)
    expected = rebuild(everything)
    assert found.select(expected.columns).exceptAll(expected).count() == 0
    assert found.count() == expected.count() == 4


def test_latest_starts_behind_the_present(spark, folder):
    schema = "id int, _change_type string, _commit_version bigint"
    spark.createDataFrame([(1, "insert", 1), (2, "insert", 2)], schema).write.parquet(f"{folder}/log")
    stream = feed.stream_changes(spark, f"{folder}/log", "latest")
    spark.createDataFrame([(3, "insert", 3)], schema).write.mode("append").parquet(f"{folder}/log")
    sinks.append_stream(stream, f"{folder}/out", f"{folder}/ckpt").awaitTermination()
    assert [r.id for r in spark.read.parquet(f"{folder}/out").collect()] == [3]


def test_commits_with_changes_are_skipped_whole(spark, folder):
    schema = "id int, _change_type string, _commit_version bigint"
    log = [(1, "insert", 1), (2, "insert", 2), (1, "delete", 2), (3, "insert", 3)]
    for row in log:
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(f"{folder}/log")
    stream = feed.stream_changes(spark, f"{folder}/log", files_per_batch=1)
    write = feed.inserts_only(f"{folder}/log", feed.overwrite_batch(f"{folder}/out"))
    sinks.for_each_batch(stream, write, f"{folder}/ckpt").awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(f"{folder}/out").collect()) == [1, 3]
