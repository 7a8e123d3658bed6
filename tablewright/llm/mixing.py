"""Mixing sources to target weights: Sainte-Laguë quotas of equal blocks, then seeded selection."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tablewright.llm.common import WORD, n_words, permuted, running, stored, tidied
from tablewright.operators.joins import broadcast_join

_TRIES = 32
_WORD = re.compile(WORD)


def _targets(sources: DataFrame, repeats: int) -> DataFrame:
    """Share the words of all sources by weight; what a source cannot take goes to the others by weight."""
    total, weight = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    limit = F.col("source_size") * repeats
    level = total / weight if total else 0.0
    while total:
        over = F.col("weight") * F.lit(level) > limit
        full, free = sources.agg(
            F.sum(F.when(over, limit).otherwise(0)), F.sum(F.when(over, 0).otherwise(F.col("weight")))
        ).first()
        higher = (total - full) / free if free else level
        if higher <= level:
            break
        level = higher
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(level), limit.cast("double")))


def _seats(divisor: Column, repeats: int) -> Column:
    """Seats of a source at a divisor: its quotient rounded. Earlier sources are ahead by a trifle in ties."""
    ahead = F.col("target") * (1 - F.col("tie") * 1e-9)
    return F.least(F.floor(ahead / divisor + 0.5), F.col("blocks") * repeats).cast("bigint")


def _quotas(sources: DataFrame, houses: Sequence[int], repeats: int) -> list[float]:
    """For each house size the divisor at which the highest quotients fill it.

    Sources stay in Spark: each round adds up the seats of all of them at a grid of
    divisors and narrows the range of every house. It ends with the smallest divisor that
    fills no house too far; what ties leave open is fewer seats than tied sources.
    """
    total, most, n = sources.agg(F.sum("target"), F.max("target"), F.count("*")).first()
    low = [total / (house + n) / 16 for house in houses]
    high = [2.0 * most + 1] * len(houses)
    while max(h / l for h, l in zip(high, low)) > 1 + 1e-13:
        grid = [[l * (h / l) ** (k / (_TRIES - 1)) for k in range(_TRIES)] for l, h in zip(low, high)]
        flat = F.array(*[F.lit(float(d)) for row in grid for d in row])
        sums = (
            sources.select("target", "tie", "blocks", F.posexplode(flat).alias("at", "divisor"))
            .groupBy("at").agg(F.sum(_seats(F.col("divisor"), repeats)).alias("seats")).collect()
        )
        found = {row["at"]: row["seats"] for row in sums}
        for i, house in enumerate(houses):
            fits = [k for k in range(_TRIES) if found[i * _TRIES + k] <= house]
            k = min(fits, default=_TRIES - 1)
            before = low[i], high[i]
            low[i], high[i] = grid[i][max(k - 1, 0)], grid[i][k]
            if (low[i], high[i]) == before:
                low[i] = high[i]
    return high


def mixed_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (1, 2, 3),
    repeats: int = 3,
    block: int = 32,
    shards: int = 16,
    seed: int = 7,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Which words of each document the mix takes, and for which of its shards.

    The words of a source, its documents laid end to end in seeded order, are cut into
    blocks of ``block`` words. Sainte-Laguë quotients give each source an integer number of
    seats in each shard of the mix: the method never takes a seat back when the house
    grows, so shard s gets what s+1 shards have more than s. A seeded permutation says
    which block sits on which seat; once all are seated it starts again, ``repeats`` times
    at most. One row per document: ``id_col``, ``size``, ``source_size``, ``target``,
    ``taken``, ``runs`` (epoch, shard, first word, words) and the columns in ``keep``.

    NULL or blank texts have size 0 and nothing taken; NULL is a source, the last one. Equal
    rows are separate documents. An empty table gives an empty result. Other columns are
    not looked at.
    """
    named = {c: f"__k{i}" for i, c in enumerate(keep)}
    rows = docs.select(
        F.col(id_col).alias("__id"),
        F.col(source_col).isNull().alias("__none"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("__source"),
        n_words(F.col(text_col)).alias("__size"),
        F.xxhash64(F.lit(seed), F.col(id_col)).alias("__order"),
        *[F.col(c).alias(k) for c, k in named.items()],
    )
    key = ["__none", "__source"]
    rows = running(rows, [*key, "__order", "__id", "__size"], "__size", "__start", "mix-order")
    sources = rows.groupBy(*key).agg(F.sum("__size").alias("source_size"), F.min("__start").alias("first"))
    sources = running(sources.withColumn("one", F.lit(1)), key, "one", "rank", "mix-sources")
    parts = F.array(*[F.lit(float(w)) for w in weights])
    sources = sources.withColumn("weight", F.element_at(parts, (F.col("rank") % len(weights)).cast("int") + 1))
    sources = stored(_targets(sources, repeats).withColumn("blocks", F.ceil(F.col("source_size") / block)), "mix-targets")

    total, count = sources.agg(F.sum("source_size"), F.count("*")).first()
    sources = sources.withColumn("tie", F.col("rank") / max(count or 0, 1))
    house = max(1, round((total or 0) / block))
    if total:
        divisors = _quotas(sources, [house * (s + 1) // shards for s in range(shards)], repeats)
        quotas = F.array(*[_seats(F.lit(d), repeats) for d in divisors])
    else:
        quotas = F.array(*[F.lit(0).cast("bigint")] * shards)
    sources = sources.select(*key, "source_size", "first", "target", "blocks", quotas.alias("quotas"))
    joined = broadcast_join(rows, sources, key).drop(*key, "__order")
    joined = joined.withColumn("__start", F.col("__start") - F.col("first")).drop("first")

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part in np.array_split(np.arange(len(frame)), max(1, int(frame["__size"].sum()) // 4_000_000 + 1)):
                piece = frame.iloc[part]
                yield _deal(piece, block, seed) if len(piece) else piece.assign(taken=[], runs=[]).drop(columns=_INNER)

    out = T.StructType(joined.drop(*_INNER).schema.fields + T.StructType.fromDDL(_DEALT).fields)
    dealt = joined.mapInPandas(tidied(deal), out)
    return dealt.select(
        F.col("__id").alias(id_col), F.col("__size").alias("size"), "source_size", "target", "taken", "runs",
        *[F.col(k).alias(c) for c, k in named.items() if c != id_col],
    )


_DEALT = "taken bigint, runs array<struct<epoch:int,shard:int,first:bigint,words:bigint>>"
_INNER = ["__start", "blocks", "quotas"]


def _deal(frame: pd.DataFrame, block: int, seed: int) -> pd.DataFrame:
    """Seat the blocks under each document and cut what is taken to the document's own words."""
    size, start = frame["__size"].to_numpy(np.int64), frame["__start"].to_numpy(np.int64)
    blocks = frame["blocks"].to_numpy(np.int64)
    quotas = np.stack([np.asarray(q, np.int64) for q in frame["quotas"]])
    begin, end = start // block, np.where(size > 0, (start + size - 1) // block + 1, start // block)
    count = end - begin
    row = np.repeat(np.arange(len(frame)), count)
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + begin[row]
    first = np.maximum(at * block, start[row]) - start[row]
    words = np.minimum((at + 1) * block, start[row] + size[row]) - start[row] - first
    seat = permuted(at, blocks[row], seed)
    taken = np.zeros(len(frame), np.int64)
    runs: list[list[dict]] = [[] for _ in range(len(frame))]
    epoch = 0
    while True:
        on = seat + epoch * blocks[row] < quotas[row, -1]
        if not on.any():
            break
        r, f, w = row[on], first[on], words[on]
        shard = (quotas[r] <= (seat[on] + epoch * blocks[r])[:, None]).sum(1)
        np.add.at(taken, r, w)
        joins = np.r_[False, (r[1:] == r[:-1]) & (shard[1:] == shard[:-1]) & (f[1:] == f[:-1] + w[:-1])]
        heads = np.flatnonzero(~joins)
        for i, total in zip(heads, np.add.reduceat(w, heads)):
            runs[r[i]].append({"epoch": epoch, "shard": int(shard[i]), "first": int(f[i]), "words": int(total)})
        epoch += 1
    return frame.drop(columns=_INNER).assign(taken=taken, runs=runs)


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options
) -> DataFrame:
    """The documents as the mix takes them: a row for each document and epoch with the words taken in it.

    The columns are those of ``docs``. What was taken stands in the order of the text with
    the white space between; a document of which nothing is taken, as an empty one, has no row.
    """
    named = docs.withColumnsRenamed({c: f"c{i}" for i, c in enumerate(docs.columns)})
    columns = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    i, t, s = (columns[c] for c in (id_col, text_col, source_col))
    rest = [c for c in named.columns if c != i]
    mix = mixed_sources(named, i, t, s, keep=rest, **options).filter("taken > 0").select(*named.columns, "runs")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index(t)
            row, texts = [], []
            for n, (text, runs) in enumerate(zip(batch.column(place), batch.column(batch.num_columns - 1))):
                text, parts = text.as_py(), {}
                begins = [m.start() for m in _WORD.finditer(text)] + [len(text)]
                for run in runs.as_py():
                    piece = text[begins[run["first"]] : begins[run["first"] + run["words"]]]
                    parts.setdefault(run["epoch"], []).append((run["first"], piece))
                row += [n] * len(parts)
                texts += ["".join(piece for _, piece in sorted(parts[epoch])) for epoch in sorted(parts)]
            kept = batch.select(batch.schema.names[:-1]).take(pa.array(row, pa.int64()))
            out = list(kept.columns)
            out[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(out, names=kept.schema.names)

    taken = mix.mapInArrow(tidied(cut), named.schema)
    return taken.withColumnsRenamed({k: c for c, k in columns.items()})
