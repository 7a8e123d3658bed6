"""Substring dedup by sliding runs of sentences."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from tablewright.llm.common import stored, tidied

#: A sentence with its end marks and the white space after them; all of them together are the text.
SENTENCE = r"[^.!?\n]*[.!?\n]+[ \t\n\x0b\x0c\r]*|[^.!?\n]+"
_SENTENCE = re.compile(SENTENCE)
_SPACE = " \t\n\x0b\x0c\r"


def runs_of(text: str, run: int, min_words: int, long_words: int) -> tuple[list[int], list[int], list[bytes]]:
    """Where runs begin, how many sentences they have, and their 128-bit hashes.

    From each sentence a run goes on for ``run`` sentences at least and until it has
    ``min_words`` words; a sentence of ``long_words`` words is as long as several and a
    run by itself.
    """
    units = [sentence.lower().encode().split() for sentence in _SENTENCE.findall(text)]
    marks = [xxhash.xxh3_128_digest(b" ".join(words)) for words in units]
    sizes = np.array([len(words) for words in units], np.int64)
    ends = np.r_[0, np.cumsum(sizes)]
    begins = np.arange(len(units))
    stops = np.maximum(np.searchsorted(ends, ends[:-1] + min_words), begins + run)
    begins = begins[stops <= len(units)]
    at, length, hashes = [], [], []
    for i, j in zip(begins.tolist(), stops.tolist()):
        at.append(i)
        length.append(j - i)
        hashes.append(xxhash.xxh3_128_digest(b"".join(marks[i:j])))
    for i in np.flatnonzero(sizes >= long_words):
        at.append(int(i))
        length.append(1)
        hashes.append(xxhash.xxh3_128_digest(marks[i]))
    return at, length, hashes


def _unused(docs: DataFrame, *names: str) -> list[str]:
    """These names, with as many underscores behind them as it takes to be new to the table."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def without_repeated_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    run: int = 2,
    min_words: int = 16,
    long_words: int = 20,
) -> DataFrame:
    """The documents without sentences that a repeated run covers, except where it stands first.

    First is the smallest id, and in one text the first place; NULL ids come last. Runs are
    compared in lower case and without regard to white space. The text keeps everything else as it is.
    Adds ``n_sentences`` and ``n_removed``; columns of these names are replaced, all others
    kept. NULL and empty texts stay as they are, with 0 sentences. Rows with one id are one
    document as to what stands first: their runs are never removed on account of each other.

    Runs of short sentences go on until they have ``min_words`` words, so that everyday phrases
    of two sentences stay and a repeated passage goes whatever its sentences are like; at most a
    tail of it under ``min_words`` words stays.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("version"), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["id"], T.StructField("version", T.LongType())])
    for name, kind in (("h1", T.LongType()), ("h2", T.LongType()), ("at", T.IntegerType()), ("n", T.IntegerType()), ("again", T.BooleanType())):
        schema = schema.add(name, kind)

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, at, length, hashes, again = [], [], [], [], []

            def out() -> pa.RecordBatch:
                pair = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
                return pa.RecordBatch.from_arrays(
                    [
                        *(column.take(pa.array(row, pa.int64())) for column in batch.columns[:2]),
                        pa.array(pair[:, 0]), pa.array(pair[:, 1]),
                        pa.array(at, pa.int32()), pa.array(length, pa.int32()), pa.array(again, pa.bool_()),
                    ],
                    names=schema.names,
                )

            for i, text in enumerate(batch.column(2)):
                a, n, h = runs_of(text.as_py() or "", run, min_words, long_words)
                seen: set[bytes] = set()
                for mark in h:
                    again.append(mark in seen)
                    seen.add(mark)
                row += [i] * len(a)
                at += a
                length += n
                hashes += h
                if len(row) > 200_000:
                    yield out()
                    row, at, length, hashes, again = [], [], [], [], []
            if row:
                yield out()

    found = stored(rows.mapInArrow(tidied(spans), schema), "spans")
    fresh = found.filter(~F.col("again"))
    firsts = fresh.groupBy("h1", "h2").agg(F.min("id").alias("first"), F.count("*").alias("docs")).filter("docs > 1")
    later = fresh.join(firsts.drop("docs"), ["h1", "h2"]).filter(~F.col("id").eqNullSafe(F.col("first")))
    places = ["id", "version", "at", "n"]
    cuts = later.select(*places).unionAll(found.filter("again").select(*places))
    cuts = cuts.groupBy("id", "version").agg(F.collect_set(F.struct("at", "n")).alias("__cuts"))

    docs = docs.drop("n_sentences", "n_removed")
    own, version, hash_, places = _unused(docs, "own", "version", "hash", "places")
    cuts = cuts.withColumnsRenamed({"id": own, "version": version, "__cuts": places})
    kept = docs.withColumn(hash_, F.xxhash64(text_col))
    kept = kept.join(cuts, F.col(id_col).eqNullSafe(F.col(own)) & (F.col(hash_) == F.col(version)), "left")
    kept = kept.drop(own, version, hash_)
    result = T.StructType(docs.schema.fields)
    result = result.add("n_sentences", T.IntegerType()).add("n_removed", T.IntegerType())
    place = result.names.index(text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, removed = [], [], []
            for text, places in zip(batch.column(place).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                units = _SENTENCE.findall(text or "")
                counts.append(len(units))
                covered = {i for p in places or () for i in range(p["at"], p["at"] + p["n"])}
                removed.append(len(covered))
                texts.append("".join(u for i, u in enumerate(units) if i not in covered) if covered else text)
            columns = batch.columns[:-1]
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(counts, pa.int32()), pa.array(removed, pa.int32())], names=result.names
            )

    return kept.mapInArrow(tidied(cut), result)
