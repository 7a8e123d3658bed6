"""Approximate nearest neighbours by inner product over balanced posting lists."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tablewright.llm.common import stored
from tablewright.operators.joins import broadcast_join

_SEEDS, _LINKS, _BLOCK = 64, 24, 2_048
_SAMPLE_BYTES = 128_000_000  # of vectors that the centroids are fitted on
_GROWTH = 16  # rows that a query looks at in a step, against all before
_CELLS = 16_000_000  # vectors times centroids that are looked at together


def _split(x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Which of two halves of about the same size each vector belongs to."""
    side = x[rng.integers(len(x))] - x[rng.integers(len(x))]
    for _ in range(4):
        along = x @ side
        high = along > np.median(along)
        if high.all() or not high.any():
            break
        side = x[high].mean(0) - x[~high].mean(0)
    along = x @ side
    order = np.argsort(along, kind="stable")
    high = np.zeros(len(x), bool)
    high[order[len(x) // 2 :]] = True
    return high


def fit_centroids(x: np.ndarray, size: int, seed: int = 3) -> np.ndarray:
    """Centroids of groups of at most ``size`` vectors: halves of halves, then two rounds of k-means and halves of what grew."""
    rng = np.random.default_rng(seed)

    def halved(rows: np.ndarray) -> list[np.ndarray]:
        todo, done = [rows], []
        while todo:
            part = todo.pop()
            if len(part) <= size:
                done.append(part)
            else:
                high = _split(x[part], rng)
                todo += [part[high], part[~high]]
        return done

    groups = halved(np.arange(len(x)))
    for _ in range(3):
        centroids = np.stack([x[g].mean(0) for g in groups])
        half = (centroids**2).sum(1) / 2
        near = np.concatenate([np.argmax(b @ centroids.T - half, 1) for b in np.array_split(x, len(x) // 4096 + 1)])
        order = np.argsort(near, kind="stable")
        parts = np.split(order, np.flatnonzero(np.diff(near[order])) + 1)
        groups = [small for g in parts for small in (halved(g) if len(g) > 2 * size else [g])]
    return np.stack([x[g].mean(0) for g in groups])


@dataclass
class Graph:
    """Centroids with links to near ones and to a few others, searched best first from fixed seeds."""

    centroids: np.ndarray
    links: np.ndarray
    seeds: np.ndarray

    @staticmethod
    def of(centroids: np.ndarray, seed: int = 3) -> Graph:
        n = len(centroids)
        half = (centroids**2).sum(1) / 2
        near = min(_LINKS, n)
        links = [np.argpartition(half - b @ centroids.T, near - 1, 1)[:, :near] for b in np.array_split(centroids, n // 1024 + 1)]
        far = np.random.default_rng(seed).integers(0, n, (n, 4))
        seeds = np.unique(np.linspace(0, n - 1, min(n, _SEEDS)).astype(int))
        return Graph(centroids, np.c_[np.concatenate(links), far], seeds)

    def search(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroids found for each vector, nearest first, and their distances."""
        n, k = len(x), len(self.centroids)
        beam = min(beam, k)
        if n > 1 and n * k > _CELLS:
            parts = [self.search(part, beam) for part in np.array_split(x, min(n, n * k // _CELLS + 1))]
            return np.concatenate([ids for ids, _ in parts]), np.concatenate([far for _, far in parts])
        half = (self.centroids**2).sum(1) / 2
        seen = np.zeros((n, k), bool)
        seen[:, self.seeds] = True
        ids = np.broadcast_to(self.seeds, (n, len(self.seeds)))
        gap = half[self.seeds] - x @ self.centroids[self.seeds].T
        if ids.shape[1] < beam:
            ids = np.c_[ids, np.zeros((n, beam - ids.shape[1]), int)]
            gap = np.c_[gap, np.full((n, beam - gap.shape[1]), np.inf)]
        keep = np.argsort(gap, 1, kind="stable")[:, :beam]
        ids, gap = np.take_along_axis(ids, keep, 1), np.take_along_axis(gap, keep, 1)
        fresh = np.isfinite(gap)
        live = np.arange(n)
        while len(live):
            first = np.argmax(fresh[live], 1)
            fresh[live, first] = False
            near = self.links[ids[live, first]]
            away = half[near] - np.einsum("nd,nkd->nk", x[live], self.centroids[near])
            away[seen[live[:, None], near]] = np.inf
            # A link may name one centroid twice: only its first place counts.
            order = np.argsort(near, 1, kind="stable")
            inorder = np.take_along_axis(near, order, 1)
            twice = np.zeros(near.shape, bool)
            np.put_along_axis(twice, order[:, 1:], inorder[:, 1:] == inorder[:, :-1], 1)
            away[twice] = np.inf
            seen[live[:, None], near] = True
            allids, allgap = np.c_[ids[live], near], np.c_[gap[live], away]
            allfresh = np.c_[fresh[live], np.isfinite(away)]
            keep = np.argsort(allgap, 1, kind="stable")[:, :beam]
            ids[live], gap[live] = np.take_along_axis(allids, keep, 1), np.take_along_axis(allgap, keep, 1)
            fresh[live] = np.take_along_axis(allfresh, keep, 1) & np.isfinite(gap[live])
            live = live[fresh[live].any(1)]
        far = np.sqrt(np.maximum(2 * gap + (x**2).sum(1)[:, None], 0))
        return ids, far


    def within(self, x: np.ndarray, ratio: float, beam: int, fill: np.ndarray, enough: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of vector and list: the lists at most ``ratio`` times as far as the nearest, and those nearest that hold ``enough`` rows."""
        return self.reads(x, ratio, beam, fill, enough)[:2]

    def reads(self, x: np.ndarray, ratio: float, beam: int, fill: np.ndarray, enough: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pairs of ``within``, and how many rows the lists nearer than each hold.

        The graph is searched for ``beam`` centroids. Where the last of them does not lie beyond
        the ratio, or they hold too few rows, all centroids are looked at instead.
        """
        ids, far = self.search(x, beam)
        held = np.cumsum(fill[ids] * np.isfinite(far), 1)
        read = ((far <= ratio * far[:, :1]) | (held - fill[ids] < enough)) & np.isfinite(far)
        whole = ~read[:, -1] & np.isfinite(far[:, -1])
        row, at = np.nonzero(read & whole[:, None])
        rows, lists, before = [row], [ids[row, at]], [(held - fill[ids])[row, at]]
        rest = np.flatnonzero(~whole)
        half = (self.centroids**2).sum(1) / 2
        for part in np.array_split(rest, len(rest) * len(half) // _CELLS + 1):
            if len(part):
                gap = half - x[part] @ self.centroids.T
                order = np.argsort(gap, 1, kind="stable")
                far = np.sqrt(np.maximum(2 * np.take_along_axis(gap, order, 1) + (x[part] ** 2).sum(1)[:, None], 0))
                held = np.cumsum(fill[order], 1)
                row, at = np.nonzero((far <= ratio * far[:, :1]) | (held - fill[order] < enough))
                rows.append(part[row])
                lists.append(order[row, at])
                before.append((held - fill[order])[row, at])
        return np.concatenate(rows), np.concatenate(lists), np.concatenate(before)


def _lifted(x: np.ndarray, reach: float) -> np.ndarray:
    """One more component, so that all vectors are equally long and the nearest has the largest inner product."""
    x = x / reach
    return np.c_[x, np.sqrt(np.maximum(1 - (x**2).sum(1), 0))]


def nearest(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    every: int = 20,
    k: int = 20,
    list_size: int = 256,
    max_sample: int = 65_536,
    copies: int = 4,
    edge: float = 1.15,
    beam: int = 64,
    ratio: float = 1.4,
) -> DataFrame:
    """For each id divisible by ``every`` the ``k`` other rows of largest inner product that the lists hold.

    Returns ``query_id``, ``rank`` from 1, ``vec_id``, ``score``; ties go to the smaller id.
    Centroids are fitted on a sample of at most ``max_sample`` distinct vectors or 128 MB; every
    vector is indexed, in the list of its nearest centroid and in up to ``copies`` lists
    whose centroids are at most ``edge`` times as far. A query reads all lists whose distance is
    at most ``ratio`` times the smallest, and the nearest ones until they hold ``copies * (k + 1)``
    rows; the graph finds them, or where there are more than ``beam`` of them a look at all
    centroids. The lists are read in a few steps, each of about 16 times as many rows as all
    before; of a later step only those entries come out that reach the (k + 1)-th best score
    so far, as no other can be in the result. Equal vectors are one entry with its k + 1 smallest ids, which is all that a
    result can need.

    NULL ids, and vectors that are NULL, zero, or hold NULL or non-finite components, take
    no part. Vectors of different lengths have no inner product: each length is searched by
    itself, one after the other. Repeated rows with one id and vector count once. Other columns are not looked at.
    """
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.transform(vector_col, lambda x: x.cast("double") + F.lit(0.0)).alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x)) & F.exists("v", lambda x: x != 0)
    rows = rows.filter(F.col("id").isNotNull() & sound)
    widths = sorted(r["n"] for r in rows.select(F.size("v").alias("n")).distinct().collect())
    found = [_nearest(rows.filter(F.size("v") == n), n, every, k, list_size, max_sample, copies, edge, beam, ratio) for n in widths]
    none = vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    return reduce(DataFrame.unionAll, found) if found else none


def _nearest(
    rows: DataFrame, width: int, every: int, k: int, list_size: int, max_sample: int, copies: int, edge: float, beam: int, ratio: float
) -> DataFrame:
    """The same for sound vectors ``v`` of one length."""
    spark = rows.sparkSession
    classes = stored(rows.groupBy("v").agg(F.min("id").alias("class"), F.max(F.expr(f"id % {every} = 0")).alias("asks")), "vector-classes")
    named = classes.select("v", "class")
    placed = stored(rows.join(named, "v").select("id", "class").distinct(), "vector-members")
    several = placed.withColumn("n", F.row_number().over(Window.partitionBy("class").orderBy("id"))).filter(F.col("n") <= k + 1)
    members = stored(several.select("class", "id"), "class-members")

    count, square = classes.agg(F.count("*"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).first()
    reach = float(np.sqrt(square or 1.0)) * (1 + 1e-12)
    most = max(1, min(max_sample, _SAMPLE_BYTES // (8 * width)))
    drawn = classes.orderBy(F.xxhash64("class")).limit(most) if count > most else classes
    vectors = drawn.select("v").toArrow().column("v").combine_chunks()
    sample = np.asarray(vectors.flatten(), np.float64).reshape(-1, width)
    graph = Graph.of(fit_centroids(_lifted(sample, reach), max(1, list_size * len(sample) // count)))
    shared = spark.sparkContext.broadcast(graph)

    def post(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if not len(frame):
                continue
            ids, far = shared.value.search(_lifted(np.stack(frame["v"].to_numpy()), reach), 16)
            close = (far <= edge * far[:, :1]) & np.isfinite(far)
            close[:, 0] = True
            row, at = np.nonzero(close[:, :copies])
            yield frame.iloc[row].assign(list=ids[row, at].astype(np.int32))

    postings = stored(classes.select("class", "v").mapInPandas(post, "class bigint, v array<double>, list int"), "postings")
    sizes = stored(postings.groupBy("list").agg(F.count("*").alias("n")), "list-sizes")
    held = {r["list"]: r["n"] for r in sizes.collect()}  # as many rows as centroids
    fill = np.array([held.get(i, 0) for i in range(len(graph.centroids))])
    enough = copies * (k + 1)

    def probe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if not len(frame):
                continue
            x = np.stack(frame["v"].to_numpy()) / np.array([max(np.linalg.norm(v), 1e-300) for v in frame["v"]])[:, None]
            row, lists, before = shared.value.reads(np.c_[x, np.zeros(len(x))], ratio, beam, fill, enough)
            step = np.ceil(np.log(np.maximum(before + 1, enough) / enough) / np.log(_GROWTH)).astype(np.int32)
            for part in np.array_split(np.arange(len(row)), len(row) * width // 2_000_000 + 1):
                yield frame.iloc[row[part]].assign(list=lists[part].astype(np.int32), step=step[part])

    asked = classes.filter("asks").select("class", "v").mapInPandas(probe, "class bigint, v array<double>, list int, step int")
    asked = stored(asked, "probes")

    def dealt(side: DataFrame, blocks: DataFrame, own: str, other: str, *more: str) -> DataFrame:
        cut = broadcast_join(side, blocks, "list")
        cut = cut.withColumn(own + "i", F.pmod(F.xxhash64("class"), F.col(own)).cast("int"))
        cut = cut.withColumn(other + "i", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        return cut.select("list", "ai", "bi", "class", "v", *more).groupBy("list", "ai", "bi")

    def compare(entries: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(entries) or not len(queries):
            return pd.DataFrame({"q": [], "class": [], "score": []})
        entries = entries.sort_values("class", kind="stable")
        v, names = np.stack(entries["v"].to_numpy()), entries["class"].to_numpy()
        q, ask = np.stack(queries["v"].to_numpy()), queries["class"].to_numpy()
        # What reaches the bound but for rounding; most queries find none in a list that is not near.
        bound = queries["bound"].to_numpy(np.float64, na_value=-np.inf)
        bound = bound - 1e-9 * np.linalg.norm(q, axis=1) * np.linalg.norm(v, axis=1).max()
        near = q @ v.T
        live = np.flatnonzero(near.max(1) >= bound)
        top = np.argsort(-near[live], 1, kind="stable")[:, : k + 8]
        exact = np.einsum("nd,nkd->nk", q[live], v[top])
        row, at = np.nonzero(exact >= bound[live, None])
        return pd.DataFrame({"q": ask[live[row]], "class": names[top[row, at]], "score": exact[row, at]})

    def compared(step: int, bounds: DataFrame | None) -> DataFrame:
        """Entries of the lists that each query reads in a step, the best of each list, with their scores."""
        some = asked.filter(F.col("step") == step)
        reads = some.groupBy("list").agg(F.count("*").alias("m"))
        cuts = [F.ceil(F.col(n) / _BLOCK).cast("int").alias(c) for n, c in (("n", "a"), ("m", "b"))]
        blocks = stored(sizes.join(reads, "list").select("list", *cuts), "list-blocks")
        bound = F.lit(None).cast("double").alias("bound")
        some = some.join(bounds, "class", "left") if bounds else some.select("*", bound)
        pairs = dealt(postings, blocks, "a", "b").cogroup(dealt(some, blocks, "b", "a", "bound"))
        return stored(pairs.applyInPandas(compare, "q bigint, class bigint, score double"), "near-vectors")

    def ranked(found: DataFrame) -> DataFrame:
        once = found.groupBy("q", "class").agg(F.max("score").alias("score"))
        return once.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "class"))).filter(F.col("n") <= k + 1)

    last = asked.agg(F.max("step")).first()[0] or 0
    best = stored(ranked(compared(0, None)), "best")
    for step in range(1, last + 1):
        bounds = best.filter(F.col("n") == k + 1).select(F.col("q").alias("class"), F.col("score").alias("bound"))
        best = stored(ranked(best.select("q", "class", "score").unionAll(compared(step, bounds))), "best")
    named = best.select("q", "class", "score").join(members, "class")
    named = named.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))).filter(F.col("n") <= k + 1)
    answers = stored(named.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("n", "id", "score"))).alias("found")), "answers")

    queries = placed.filter(F.expr(f"id % {every} = 0")).select(F.col("id").alias("query_id"), F.col("class").alias("q"))
    each = queries.join(answers, "q").select(
        "query_id", F.slice(F.filter("found", lambda x: x["id"] != F.col("query_id")), 1, k).alias("found")
    )
    each = each.select("query_id", F.posexplode("found").alias("rank", "f"))
    return each.select("query_id", (F.col("rank") + 1).alias("rank"), F.col("f.id").alias("vec_id"), F.col("f.score").alias("score"))
