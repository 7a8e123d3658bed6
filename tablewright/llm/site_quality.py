"""A quality classifier whose evidence is combined with the posterior of the host and of the path below it."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tablewright.llm.common import release, stored, tidied
from tablewright.operators.joins import broadcast_join

_TOKEN = re.compile(r"[^\W\d_]+")
#: Fixed value: punctuation that ordinary prose is full of.
_PLAIN = np.frombuffer(b".,;:'\"?()-", np.uint8)


def shape(text: str | None) -> list[float]:
    """What a text looks like, whatever its words mean."""
    text = text or ""
    words, lines = text.split(), text.split("\n")
    n, raw = max(1, len(words)), np.frombuffer(text.encode(), np.uint8)
    size = max(1, len(raw))
    counts = np.bincount(raw, minlength=256)
    upper, lower, digits, wide = counts[65:91].sum(), counts[97:123].sum(), counts[48:58].sum(), counts[128:].sum()
    white, plain = counts[[9, 10, 11, 12, 13, 32]].sum(), counts[_PLAIN].sum()
    symbols = size - upper - lower - digits - wide - white - plain if len(raw) else 0
    triples = max(1, len(words) - 2)
    return [
        np.log1p(len(words)) / 10,
        len(text) / n / 10,
        upper / size,
        digits / size,
        symbols / size,
        plain / size,
        len(set(words)) / n,
        len(set(zip(words, words[1:], words[2:]))) / triples if len(words) > 2 else 1.0,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        len(set(lines)) / len(lines),
        sum(not w[-1].isalnum() for w in words) / n,
        sum(len(w) == 1 and not w.isalnum() for w in words) / n,
    ]


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        self[word] = number = xxhash.xxh32_intdigest(word)
        return number


_HASHES = _Hashes()
_CACHE = 100_000  # words
_ROWS = 2_048  # that the fit looks at together


def _forget() -> None:
    _HASHES.clear()
    release()


def words_of(text: str | None) -> np.ndarray:
    """32-bit hashes of the distinct words of a text, lower-cased, in order."""
    found = set(_TOKEN.findall((text or "").lower()))
    if len(_HASHES) > _CACHE:
        _HASHES.clear()
    known = _HASHES if len(found) < _CACHE else _Hashes()
    return np.unique(np.fromiter(map(known.__getitem__, found), np.uint32, len(found)))


def features(rows: DataFrame) -> DataFrame:
    """``shape`` and ``words`` in place of ``text``, as packed numbers; each text is read once, one at a time."""
    kind = rows.drop("text").schema.add("shape", "binary").add("words", "binary")
    kept = [f.name for f in kind.fields[:-2]]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shapes, words = [], []
            for value in batch.column(batch.schema.get_field_index("text")):
                text = value.as_py()
                shapes.append(np.array(shape(text)).tobytes())
                words.append(words_of(text).tobytes())
            columns = [batch.column(batch.schema.get_field_index(name)) for name in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(shapes, pa.binary()), pa.array(words, pa.binary())], names=[*kept, "shape", "words"])

    return rows.mapInArrow(tidied(work, _forget), kind)


def _unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shapes as a matrix, the words of all rows, and the row that each word is of."""
    shapes, words = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("shape", "words"))
    flat = np.frombuffer(b"".join(words), np.uint32)
    return np.frombuffer(b"".join(shapes), np.float64).reshape(len(shapes), -1), flat, np.repeat(np.arange(len(words)), [len(w) // 4 for w in words])


def _parts(batch: pa.RecordBatch, most: int = 300_000) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about ``most`` words, or of one text that has more."""
    column = batch.column(batch.schema.get_field_index("words"))
    ends = np.cumsum([len(value.as_buffer()) // 4 for value in column])
    cuts = np.flatnonzero(np.diff(ends // most)) + 1 if len(ends) else []
    for i, j in zip([0, *cuts], [*cuts, batch.num_rows]):
        yield batch.slice(i, j - i)


def logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float, rounds: int = 25) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton's method; the last one is the intercept. Rows count ``n`` times."""
    w = np.zeros(x.shape[1] + 1)
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-3
    for _ in range(rounds):
        curve, slope = np.diag(penalty), -penalty * w
        for at in range(0, len(x), _ROWS):
            part = slice(at, at + _ROWS)
            own = np.c_[x[part], np.ones(len(x[part]))]
            p = 1 / (1 + np.exp(-np.clip(own @ w, -30, 30)))
            v = n[part] * np.maximum(p * (1 - p), 1e-6)
            curve += (own * v[:, None]).T @ own
            slope += own.T @ (n[part] * (y[part] - p))
        step = np.linalg.solve(curve, slope)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class Model:
    words: np.ndarray  # hashes in order
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # one column per label: shape, words, intercept

    def inputs(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scaled shapes, and the places (row, word) of the words that count."""
        shapes, words, rows = _unpacked(batch)
        at = np.searchsorted(self.words, words)
        at[at == len(self.words)] = 0
        hit = self.words[at] == words if len(self.words) else np.zeros(len(words), bool)
        return np.clip((shapes - self.mean) / self.scale, -8, 8), rows[hit], at[hit]

    def evidence(self, batch: pa.RecordBatch) -> np.ndarray:
        """Probability of each text that one of the labels holds against it."""
        x, rows, words = self.inputs(batch)
        logits = x @ self.weights[: x.shape[1]] + self.weights[-1]
        np.add.at(logits, rows, self.weights[x.shape[1] + words])
        return 1 - np.prod(1 / (1 + np.exp(np.clip(logits, -30, 30))), axis=1)


def train(labelled: DataFrame, max_rows: int = 20_000, max_words: int = 300, ridge: float = 1.0) -> Model | None:
    """Fit on ``shape``, ``words`` and ``against``, an array of 0 and 1 with an element for each label.

    Which words speak for a label is counted over all labelled texts; those with the
    strongest association, ``max_words`` per label, become features beside the shape. The
    weights are fitted on about ``max_rows`` texts at most, those with the smallest hashes; equal ones
    are one row that counts as often as they stand.
    """
    totals = labelled.agg(F.count("*"), F.array(*[F.sum(F.col("against")[i]) for i in range(2)])).first()
    n, positive = totals[0], totals[1]
    if not n:
        return None

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _parts(whole)):
            _, words, rows = _unpacked(batch)
            against = np.array(batch.column(batch.schema.get_field_index("against")).to_pylist(), np.int64).reshape(-1, 2)
            distinct, which = np.unique(words, return_inverse=True)
            sums = [np.bincount(which, against[rows, i], len(distinct)).astype(np.int64) for i in range(2)]
            all_ = np.bincount(which, minlength=len(distinct)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (distinct.astype(np.int64), all_, *sums)], names=["word", "n", "a", "b"])

    counts = labelled.select("shape", "words", "against").mapInArrow(tidied(count), "word bigint, n bigint, a bigint, b bigint")
    counts = stored(counts.groupBy("word").agg(F.sum("n").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b")), "label-words")
    chosen: set[int] = set()
    for name, label in zip("ab", positive):
        if not label or label == n:
            continue
        share = F.col("n") / n
        z = (F.col(name) / label - (F.col("n") - F.col(name)) / (n - label)) / F.sqrt(
            share * (1 - share) * (1 / label + 1 / (n - label))
        )
        best = counts.filter((F.col("n") >= 5) & (F.col("n") < n)).withColumn("z", z).filter("z > 5")
        chosen.update(row["word"] for row in best.orderBy(F.desc("z"), "word").limit(max_words).collect())

    part = F.pmod(F.xxhash64("shape", "words"), F.lit(1 << 32)) < int((1 << 32) * min(1.0, max_rows / n))
    drawn = labelled.filter(part).groupBy("shape", "words", "against").agg(F.count("*").cast("double").alias("times"))
    drawn = drawn.orderBy("shape", "words", "against").toArrow().combine_chunks()
    batch = drawn.to_batches()[0] if drawn.num_rows else None
    if batch is None:
        return None
    shapes, times = _unpacked(batch)[0], np.array(batch.column("times"))
    mean = np.average(shapes, 0, times)
    scale = np.sqrt(np.average((shapes - mean) ** 2, 0, times)) + 1e-3
    model = Model(np.array(sorted(chosen), np.uint32), mean, scale, np.zeros(0))
    x, rows, words = model.inputs(batch)
    full = np.zeros((len(x), x.shape[1] + len(chosen)))
    full[:, : x.shape[1]] = x
    full[rows, x.shape[1] + words] = 1
    y = np.array(batch.column("against").to_pylist(), float)

    def fitted(label: np.ndarray) -> np.ndarray:
        if label.min() == label.max():
            return np.r_[np.zeros(full.shape[1]), 9.0 if label[0] else -9.0]
        return logistic(full, label, times, ridge)

    model.weights = np.array([fitted(label) for label in y.T]).T
    return model


def strength(deviation: float, groups: int, n: float, squares: float, m: float, levels: int) -> float:
    """Pseudo-count of a beta prior from how far group means lie apart, by the method of moments."""
    free = n - squares - (groups - levels)
    if groups <= levels or free <= 0 or not 0 < m < 1:
        return 1e4
    rho = (deviation / (m * (1 - m)) - (groups - levels)) / free
    return 1 / min(max(rho, 1e-4), 0.5) - 1


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def site_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    path_col: str = "lang",
    limit: float = 0.5,
    max_rows: int = 20_000,
) -> DataFrame:
    """One row per document: the id, ``evidence``, ``host_rate``, ``path_rate``, ``posterior``, ``rejected``, ``version``.

    ``evidence`` is the probability, by text alone, that a document is of low quality or
    toxic. Its sums over hosts, and over paths below them, give posterior rates: a host is
    shrunk toward the global rate and a path toward its host, by as much as moments of all
    groups say that rates differ by chance. A document does not count for its own site, so that a site
    of one document has the rate of the level above. The posterior adds to the log odds of the evidence how
    far the odds of the path lie from the global ones; from ``limit`` on a document is rejected.

    Texts are read once, for their features; only these are joined with the labels, of which there may be
    as many as documents. NULL texts count as empty; NULL hosts and paths are groups of their own. Labels without
    a document, or with NULL, are not used; repeated ones are used as often as they stand.
    Without any label nothing is rejected. ``version`` is a hash of the text.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.col(host_col).cast("string").alias("host"), F.col(path_col).cast("string").alias("path"),
    )
    rows = stored(features(rows.withColumn("version", F.xxhash64("text"))), "features")
    against = F.array((F.col("quality") == 0).cast("int"), (F.col("toxic") == 1).cast("int"))
    known = labels.select(F.col(id_col).alias("id"), against.alias("against")).filter("array_position(transform(against, x -> x is null), true) = 0")
    labelled = broadcast_join(rows.select("id", "shape", "words"), known, "id").select("shape", "words", "against")
    model = train(labelled, max_rows)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _parts(whole)):
            found = model.evidence(batch) if model else np.zeros(batch.num_rows)
            kept = [batch.column(batch.schema.get_field_index(c)) for c in ("id", "host", "path", "version")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(np.round(found * 1e6).astype(np.int64))], names=["id", "host", "path", "version", "ppm"])

    scored = rows.mapInArrow(tidied(score), rows.select("id", "host", "path", "version").schema.add("ppm", "long"))
    scored = stored(scored, "evidence")
    scored = scored.withColumns({"host": F.coalesce(F.concat(F.lit("="), "host"), F.lit("")), "path": F.coalesce(F.concat(F.lit("="), "path"), F.lit(""))})

    paths = stored(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("ppm").alias("s")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"), F.sum(F.col("n") * F.col("n")).alias("sq"))
    hosts = stored(hosts, "hosts")
    n, s, count, squares = hosts.agg(F.sum("hn"), F.sum("hs"), F.count("*"), F.sum(F.col("hn").cast("double") ** 2)).first()
    m = (s or 0) / 1e6 / (n or 1)
    apart = hosts.agg(F.sum(F.col("hn") * (F.col("hs") / 1e6 / F.col("hn") - m) ** 2)).first()[0]
    host_prior = strength(apart or 0.0, count, n or 0, (squares or 0) / (n or 1), m, 1)
    below = paths.join(hosts, "host").agg(
        F.sum(F.col("n") * (F.col("s") / 1e6 / F.col("n") - F.col("hs") / 1e6 / F.col("hn")) ** 2), F.count("*"),
        F.sum(F.col("n").cast("double") ** 2 / F.col("hn")),
    ).first()
    path_prior = strength(below[0] or 0.0, below[1], n or 0, below[2] or 0.0, m, count)

    sites = paths.join(hosts.drop("sq"), "host")
    joined = broadcast_join(scored, sites, ["host", "path"])
    evidence = F.col("ppm") / 1e6
    host_rate = ((F.col("hs") - F.col("ppm")) / 1e6 + host_prior * m) / (F.col("hn") - 1 + host_prior)
    joined = joined.withColumn("evidence", evidence).withColumn("host_rate", host_rate)
    path_rate = ((F.col("s") - F.col("ppm")) / 1e6 + path_prior * F.col("host_rate")) / (F.col("n") - 1 + path_prior)
    joined = joined.withColumn("path_rate", path_rate)
    odds = _logit(F.col("evidence")) + _logit(F.col("path_rate")) - _logit(F.lit(m))
    joined = joined.withColumn("posterior", 1 / (1 + F.exp(-odds)))
    rejected = (F.col("posterior") >= limit) & F.lit(model is not None)
    return joined.select(
        F.col("id").alias(id_col), "evidence", "host_rate", "path_rate", "posterior", rejected.alias("rejected"), "version"
    )


def kept_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that ``site_quality`` does not reject, with all their columns."""
    judged = site_quality(docs, labels, id_col, text_col, **options).filter("not rejected")
    judged = judged.select(F.col(id_col).alias("__id"), F.col("version").alias("__version"))
    same = docs[id_col].eqNullSafe(judged["__id"]) & (F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == judged["__version"])
    return docs.join(judged, same, "left_semi")
