"""Token ids in training order: a keyed permutation gives each sequence its slot in binary shards."""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from tablewright.llm.common import permuted
from tablewright.llm.tokens import VOCABULARY, encoder
from tablewright.session import scratch


def _sequences(batch: pa.RecordBatch, coder, length: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, bytes]]:
    """Ids, sequences and tokens of each document of a piece of the batch, and its records end to end."""
    stride, end = length * np.dtype(coder.kind).itemsize, np.array([coder.end], coder.kind).tobytes()
    ids, texts = batch.column(0), batch.column(1)
    begin, records, counts, tokens = 0, [], [], []
    held = 0
    for i in range(len(texts)):
        raw = coder.packed(texts[i].as_py()) + end
        n = -(-len(raw) // stride)
        records.append(raw + end * ((n * stride - len(raw)) // len(end)))
        counts.append(n)
        tokens.append(len(raw) // len(end))
        held += n * stride
        if held > 8_000_000 or i + 1 == len(texts):
            yield ids.slice(begin, i + 1 - begin), np.array(counts), np.array(tokens), b"".join(records)
            begin, records, counts, tokens, held = i + 1, [], [], [], 0


def training_order(
    docs: DataFrame,
    path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    key: int = 11,
    length: int = 256,
    shard_records: int = 32_768,
    vocabulary: str = VOCABULARY,
) -> DataFrame:
    """Write all texts as token ids, in an order drawn by ``key``, to shards of records of one size.

    A text is its ids and an end mark, cut into sequences of ``length`` ids; the last is
    filled up with end marks. NULL and empty texts are one sequence of end marks. With N
    sequences, sequence i goes to slot ``permuted(i, N, key)``: record slot mod
    ``shard_records`` of file slot div ``shard_records``. ``manifest.json`` beside the files
    has what a reader needs; ``read_slots`` begins at any slot with one seek. The result,
    a row for each sequence: ``slot``, ``shard``, ``position``, the id, ``part`` (which
    sequence of its text), ``n_tokens`` without filling and ``crc`` of the record.

    Two passes over ``docs``: the first counts the sequences of each partition, the second
    numbers them from there and shuffles each record once, straight to its range of slots.
    That asks for the same rows in the same order both times, as scans give; where they
    differ, the job stops. Files are moved into place when whole, so that a task that runs
    again changes nothing. Equal rows are separate documents; an empty table has a manifest
    with no slots. Other columns are not looked at.
    """
    spark = docs.sparkSession
    path = path or scratch(spark, "llm-shards")
    with open(vocabulary, "rb") as file:
        shared = spark.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    coder = encoder(shared.value)
    kind, end = np.dtype(coder.kind), coder.end
    stride = length * kind.itemsize

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, crc, coder = 0, 0, encoder(shared.value)
        for batch in batches:
            for ids, counts, _, _ in _sequences(batch, coder, length):
                total += int(counts.sum())
                crc = zlib.crc32(counts.tobytes(), zlib.crc32(str(ids.to_pylist()).encode(), crc))
        yield pa.RecordBatch.from_pydict({"task": [TaskContext.get().partitionId()], "n": [total], "crc": [crc]})

    parts = sorted(rows.mapInArrow(count, "task bigint, n bigint, crc bigint").collect())
    starts, total = {}, 0
    for task, n, crc in parts:
        starts[task] = (total, n, crc)
        total += n

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, n, expected = starts.get(TaskContext.get().partitionId(), (0, 0, 0))
        done, crc, coder = 0, 0, encoder(shared.value)
        for batch in batches:
            for ids, counts, tokens, data in _sequences(batch, coder, length):
                crc = zlib.crc32(counts.tobytes(), zlib.crc32(str(ids.to_pylist()).encode(), crc))
                m = int(counts.sum())
                if done + m > n:
                    break
                row = np.repeat(np.arange(len(counts)), counts)
                part = np.arange(m) - np.repeat(np.cumsum(counts) - counts, counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(permuted(np.arange(m) + at + done, total, key)),
                        ids.take(pa.array(row)),
                        pa.array(part.astype(np.int32)),
                        pa.array(np.minimum(length, tokens[row] - part * length).astype(np.int32)),
                        pa.Array.from_buffers(
                            pa.binary(), m,
                            [None, pa.py_buffer((np.arange(m + 1) * stride).astype(np.int32)), pa.py_buffer(data)],
                        ),
                    ],
                    names=["slot", "__id", "part", "n_tokens", "record"],
                )
                done += m
        if (done, crc) != (n, expected):
            raise RuntimeError("the rows changed between two passes; write them to a table first")

    plain = T.StructType([T.StructField("slot", T.LongType()), rows.schema["__id"]])
    plain = plain.add("part", T.IntegerType()).add("n_tokens", T.IntegerType())
    numbered = rows.mapInArrow(number, T.StructType(plain.fields + [T.StructField("record", T.BinaryType())]))
    shards = -(-total // shard_records)
    dealt = numbered.repartitionById(max(1, shards), F.floor(F.col("slot") / shard_records).cast("int"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pafs.FileSystem.from_uri(path)
        out = name = held = None
        want = 0
        for batch in batches:
            slots = batch.column(0).to_numpy()
            if not len(slots):
                continue
            if out is None:
                shard = int(slots[0]) // shard_records
                want = min(shard_records, total - shard * shard_records) * stride
                name, held = f"{root}/shard-{shard:08d}.bin", f"{root}/.shard-{shard:08d}-{uuid.uuid4().hex}"
                files.create_dir(root)
                out = files.open_output_stream(held)
            out.write(b"".join(batch.column(4).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:4],
                    pa.array(slots // shard_records),
                    pa.array(slots % shard_records),
                    pa.array([zlib.crc32(record) for record in batch.column(4).to_pylist()], pa.int64()),
                ],
                names=["slot", "__id", "part", "n_tokens", "shard", "position", "crc"],
            )
        if out is not None:
            size = out.tell()
            out.close()
            if size != want:
                raise RuntimeError(f"{name} would have {size} bytes instead of {want}")
            there = files.get_file_info(name)
            if there.type == pafs.FileType.File and there.size == want:
                files.delete_file(held)
            else:
                files.move(held, name)

    schema = plain.add("shard", T.LongType()).add("position", T.LongType()).add("crc", T.LongType())
    index = dealt.sortWithinPartitions("slot").mapInArrow(write, schema)
    index.write.parquet(f"{path}/index")
    files, root = pafs.FileSystem.from_uri(path)
    manifest = {
        "slots": total, "length": length, "type": kind.name, "end": int(end), "shard_records": shard_records, "key": key,
    }
    with files.open_output_stream(f"{root}/manifest.json") as out:
        out.write(json.dumps(manifest).encode())
    index = spark.read.schema(schema).parquet(f"{path}/index")
    return index.select("slot", "shard", "position", F.col("__id").alias(id_col), "part", "n_tokens", "crc")


def read_slots(path: str, start: int = 0, stop: int | None = None, at_once: int = 1024) -> Iterator[np.ndarray]:
    """Records from slot ``start`` on, in training order, as arrays of at most ``at_once`` rows.

    A training run that stopped after n records goes on with ``start=n``.
    """
    files, root = pafs.FileSystem.from_uri(path)
    with files.open_input_file(f"{root}/manifest.json") as file:
        manifest = json.loads(file.read())
    kind, length, per = np.dtype(manifest["type"]), manifest["length"], manifest["shard_records"]
    stop = manifest["slots"] if stop is None else min(stop, manifest["slots"])
    while start < stop:
        shard, upto = start // per, min(stop, (start // per + 1) * per)
        with files.open_input_file(f"{root}/shard-{shard:08d}.bin") as file:
            file.seek((start - shard * per) * length * kind.itemsize)
            while start < upto:
                n = min(at_once, upto - start)
                yield np.frombuffer(file.read(n * length * kind.itemsize), kind).reshape(n, length)
                start += n
