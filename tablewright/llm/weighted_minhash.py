"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tablewright.llm.common import mixed, release, stored, tidied
from tablewright.llm.graph import components

_KEY = 40  # bits of a shingle hash that tell shingles of one bucket apart
_TOGETHER = 2_000  # members of a bucket that are compared in one task
_BYTES = 64_000_000  # and the size of their sets
_BLOCK = 65_536  # shingles that are sampled at a time
_TEXTS = 64  # texts that are cut at a time
_HASHES: dict[bytes, int] = {}  # stays empty: hashing a word again is cheaper than looking it up


def _after(work: Callable, *frames: pd.DataFrame) -> pd.DataFrame:
    """What ``work`` makes of a group; its memory is given back."""
    made = work(*frames)
    release()
    return made


def _runs(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the runs of ``k`` words that begin at each word."""
    n = len(hashes) - k + 1
    total = np.full(n, k, np.uint64)
    for i in range(k):
        total *= np.uint64(0x9E3779B97F4A7C15)
        total += hashes[i : i + n]
    return mixed(total)


def shingles(texts: list[str], words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text the sorted hashes of the distinct runs of ``words`` words, lower-cased, and how often each occurs.

    They lie end to end; last is how many each text has. A shorter text is one shingle; a text
    without words has none.
    """
    if len(texts) > _TEXTS:
        parts = [shingles(texts[i : i + _TEXTS], words) for i in range(0, len(texts), _TEXTS)]
        return tuple(np.concatenate(column) for column in zip(*parts))
    marks = [list(map(xxhash.xxh3_64_digest, text.lower().encode().split())) for text in texts]
    hashes = np.frombuffer(b"".join(map(b"".join, marks)), ">u8").astype(np.uint64)
    sizes = np.fromiter(map(len, marks), np.int64, len(marks))
    starts, runs = np.cumsum(sizes) - sizes, np.maximum(sizes - words + 1, np.minimum(sizes, 1))
    found = np.zeros(runs.sum(), np.uint64)
    every = _runs(hashes, words) if len(hashes) >= words else found[:0]
    ends = np.cumsum(runs)
    heads = np.zeros(len(found) + 1, bool)
    heads[-1] = True
    for start, size, n, end in zip(starts.tolist(), sizes.tolist(), runs.tolist(), ends.tolist()):
        if n:
            own = found[end - n : end]
            own[:] = every[start : start + n] if size >= words else _runs(hashes[start : start + size], size)
            own.sort()
            heads[end - n] = True
    heads[1:-1] |= found[1:] != found[:-1]
    at = np.flatnonzero(heads)
    distinct = np.diff(np.r_[0, np.searchsorted(at, ends)])
    return found[at[:-1]], np.diff(at), distinct


def idf(df: np.ndarray, n: int) -> np.ndarray:
    """Inverse document frequency, smoothed by a tenth of all documents.

    Without that, the copies of a text make its own shingles so common that one changed
    word outweighs them. So the weight falls only for what a large part of all documents has.
    """
    return np.log1p(n / (df + n / 10))


def weighted_jaccard(a: np.ndarray, u: np.ndarray, b: np.ndarray, v: np.ndarray) -> float:
    """Of two sets of sorted hashes with their weights."""
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    both = np.minimum(u[i], v[j]).sum()
    total = u.sum() + v.sum() - both
    return float(both / total) if total else 1.0


def samples(hashes: np.ndarray, weights: np.ndarray, starts: np.ndarray, m: int, seed: int) -> np.ndarray:
    """``m`` consistent weighted samples of each set; two sets agree in one with their weighted Jaccard similarity.

    For each element: r, c ~ Gamma(2, 1) and b uniform from its hash; t = floor(ln w / r + b);
    the element with the least c / exp(r (t - b) + r) is drawn, as the pair of itself and t.
    Sets are taken a block at a time, which the numbers of an element do not depend on.
    """
    out = np.zeros((len(starts), m), np.uint64)
    ends = np.r_[starts[1:], len(hashes)]
    low, scale = np.uint64(2**32 - 1), 1 / 2**32
    begin = 0
    while begin < len(starts):
        end = max(begin + 1, int(np.searchsorted(ends, starts[begin] + _BLOCK, "right")))
        part = slice(starts[begin], ends[end - 1])
        own, log_w, heads = hashes[part], np.log(weights[part]), starts[begin:end] - starts[begin]
        sets = np.repeat(np.arange(end - begin), np.diff(np.r_[heads, len(own)]))
        for j in range(m):
            x = mixed(own ^ mixed(np.uint64(seed * 1_000_003 + j + 1)))
            y = mixed(x + np.uint64(0x9E3779B97F4A7C15))
            z = mixed(y + np.uint64(0x9E3779B97F4A7C15))
            uniform = [((v >> np.uint64(32)) + 0.5) * scale for v in (x, y)] + [((v & low) + 0.5) * scale for v in (x, y, z)]
            r = -np.log(uniform[0] * uniform[1])
            c = -np.log(uniform[2] * uniform[3])
            t = np.floor(log_w / r + uniform[4])
            a = np.log(c) - r * (t - uniform[4]) - r
            least = np.minimum.reduceat(a, heads)
            at = np.flatnonzero(a == least[sets])
            first = at[np.r_[True, sets[at][1:] != sets[at][:-1]]]
            out[begin:end, j] = mixed(own[first] ^ mixed(t[first].astype(np.int64).astype(np.uint64)))
        begin = end
    return out


def _packed(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys).view(np.uint8).reshape(-1, 8)[:, : _KEY // 8].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    parts = np.frombuffer(data, np.uint8).reshape(-1, _KEY // 8)
    out = np.zeros((len(parts), 8), np.uint8)
    out[:, : _KEY // 8] = parts
    return out.view(np.uint64).ravel()


def _typed(columns: dict[str, list]) -> pd.DataFrame:
    """Columns that keep their elements as they are, also where there are none."""
    return pd.DataFrame({name: pd.Series(values, dtype=object) for name, values in columns.items()})


def _texts(frame: pd.DataFrame) -> dict[str, int]:
    """Distinct texts of a batch and how many documents have each."""
    found: dict[str, int] = {}
    for text in frame["text"]:
        text = text or ""
        found[text] = found.get(text, 0) + 1
    return found


def shared_sets(docs: DataFrame, words: int, least: float, bands: int, rows: int, seed: int, batch_chars: int) -> DataFrame:
    """Weighted shingle sets, with band keys, of the texts that may have a near-duplicate.

    Documents are dealt out in batches. Each batch sends every distinct shingle once, with
    its count, to the bucket of its hash; the bucket adds up document frequencies and sends
    back those that are not 1. So a shingle that a third of all documents have is one entry
    per batch. A text can only be similar to another if shingles that others have too make
    up ``least`` of its weight, which leaves out most texts before anything is sampled.
    """
    n, chars = docs.agg(F.count("*"), F.sum(F.char_length("text"))).first()
    batches = max(1, -(-(chars or 0) // batch_chars))
    bits = max(0, ((chars or 0) // 6_000_000).bit_length())
    shift = np.uint64(64 - bits - _KEY)
    mask = np.uint64(2**_KEY - 1)
    dealt = docs.select("text", F.pmod(F.xxhash64("id", "text", F.spark_partition_id()), F.lit(batches)).alias("batch"))
    dealt = dealt.groupBy("batch")

    def send(frame: pd.DataFrame) -> pd.DataFrame:
        found = _texts(frame)
        hashes, _, sizes = shingles(list(found), words)
        hashes >>= shift
        copies = np.fromiter(found.values(), np.int64, len(found)) - 1
        more, copies = np.repeat(copies > 0, sizes), np.repeat(copies, sizes)
        more, copies = hashes[more], copies[more]
        hashes.sort()
        heads = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]]) if len(hashes) else np.zeros(0, np.int64)
        keys, counts = hashes[heads], np.diff(np.r_[heads, len(hashes)])
        np.add.at(counts, np.searchsorted(keys, more), copies)
        counts = counts.astype(np.uint32)
        bucket = (keys >> np.uint64(_KEY)).astype(np.int64)
        cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True]) if len(keys) else [0]
        pieces = list(zip(cuts[:-1], cuts[1:]))
        return _typed(
            {
                "batch": [frame["batch"].iloc[0]] * len(pieces),
                "bucket": [int(bucket[i]) for i, _ in pieces],
                "keys": [_packed(keys[i:j] & mask) for i, j in pieces],
                "counts": [counts[i:j].tobytes() for i, j in pieces],
            }
        )

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        keys = [_unpacked(k) for k in frame["keys"]]
        flat = np.concatenate(keys)
        counts = np.concatenate([np.frombuffer(c, np.uint32) for c in frame["counts"]]).astype(np.int64)
        order = np.argsort(flat, kind="stable")
        flat, counts = flat[order], counts[order]
        heads = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
        df = np.add.reduceat(counts, heads)
        known, df = flat[heads][df > 1], df[df > 1]
        out = {"batch": [], "bucket": [], "keys": [], "counts": []}
        for batch, own in zip(frame["batch"], keys):
            at = np.searchsorted(known, own)
            at[at == len(known)] = 0
            hit = known[at] == own if len(known) else np.zeros(len(own), bool)
            if hit.any():
                out["batch"].append(batch)
                out["bucket"].append(frame["bucket"].iloc[0])
                out["keys"].append(_packed(own[hit]))
                out["counts"].append(df[at[hit]].tobytes())
        return _typed(out)

    def weigh(frame: pd.DataFrame, back: pd.DataFrame) -> pd.DataFrame:
        out = {"mark": [], "hashes": [], "weights": [], "signature": [], "keys": []}
        if len(back) and len(frame):
            back = back.sort_values("bucket")
            known = np.concatenate(
                [_unpacked(k) | (np.uint64(b) << np.uint64(_KEY)) for k, b in zip(back["keys"], back["bucket"])]
            )
            dfs = np.concatenate([np.frombuffer(c, np.int64) for c in back["counts"]])
            kept, texts = [], list(_texts(frame))
            for begin in range(0, len(texts), _TEXTS):
                own = texts[begin : begin + _TEXTS]
                hashes, tf, sizes = shingles(own, words)
                at = np.searchsorted(known, hashes >> shift)
                at[at == len(known)] = 0
                hit = known[at] == hashes >> shift
                weights = tf * idf(np.where(hit, dfs[at], 1), n)
                for text, size, end in zip(own, sizes, np.cumsum(sizes)):
                    part = slice(end - size, end)
                    if size and weights[part][hit[part]].sum() >= least * weights[part].sum() * (1 - 1e-9):
                        kept.append((text, hashes[part].copy(), weights[part].astype(np.float32)))
            if kept:
                starts = np.cumsum([0] + [len(h) for _, h, _ in kept[:-1]])
                weights = np.concatenate([w for _, _, w in kept]).astype(np.float64)
                drawn = samples(np.concatenate([h for _, h, _ in kept]), weights, starts, bands * rows, seed)
                keys = drawn.reshape(len(kept), bands, rows)
                total = np.zeros(keys.shape[:2], np.uint64)
                for i in range(rows):
                    total = mixed(total * np.uint64(31) + keys[:, :, i])
                out = {
                    "mark": [hashlib.md5(text.encode()).hexdigest() for text, _, _ in kept],
                    "hashes": [h.tobytes() for _, h, _ in kept],
                    "weights": [w.tobytes() for _, _, w in kept],
                    "signature": [row.astype(np.uint32).tobytes() for row in drawn],
                    "keys": list(total.astype(np.int64)),
                }
        return _typed(out)

    kind = "batch bigint, bucket bigint, keys binary, counts binary"
    back = dealt.applyInPandas(lambda frame: _after(send, frame), kind)
    back = back.groupBy("bucket").applyInPandas(lambda frame: _after(add, frame), kind)
    return dealt.cogroup(back.groupBy("batch")).applyInPandas(
        lambda frame, back: _after(weigh, frame, back), "mark string, hashes binary, weights binary, signature binary, keys array<bigint>"
    )


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Those pairs ``a``, ``b`` whose sets are similar enough, with the similarity."""
    side = lambda x: sets.select(F.col("mark").alias(x), F.col("hashes").alias(f"h{x}"), F.col("weights").alias(f"w{x}"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, value = [], [], []
            for row in zip(*(batch.column(name) for name in ("a", "b", "ha", "wa", "hb", "wb"))):
                x, y = row[0].as_py(), row[1].as_py()
                ha, hb = (np.frombuffer(row[i].as_buffer(), np.uint64) for i in (2, 4))
                wa, wb = (np.frombuffer(row[i].as_buffer(), np.float32).astype(np.float64) for i in (3, 5))
                s = weighted_jaccard(ha, wa, hb, wb)
                if s >= least:
                    a.append(x)
                    b.append(y)
                    value.append(s)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(value, pa.float64())],
                names=["a", "b", "similarity"],
            )

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(tidied(measure), "a string, b string, similarity double")


def _across(members: DataFrame, buckets: DataFrame, sets: DataFrame, bands_rows: int, least: float) -> DataFrame:
    """Links within a bucket that join different components.

    A large bucket is cut into chunks by members and bytes, and each pair of chunks is a
    task. A pair is looked at in the first band that it shares, if its samples agree as
    those of a pair of ``least`` do but for one case in millions, and if no link found in
    the task joins it already: a task gives fewer links than it has members.
    """
    cut = F.greatest(F.lit(1), F.ceil(F.col("n") / _TOGETHER), F.ceil(F.col("bytes") / _BYTES)).cast("int")
    rest = members.join(buckets.select("band", "key", cut.alias("chunks")), ["band", "key"])
    rest = rest.withColumn("chunk", F.pmod(F.xxhash64("mark"), F.col("chunks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    rest = rest.withColumn("other", other)
    rest = rest.withColumns({"low": F.least("chunk", "other"), "high": F.greatest("chunk", "other")})
    rest = rest.select("band", "key", "low", "high", "chunk", "mark", "label")
    rest = rest.join(sets.select("mark", "signature", "keys", "hashes", "weights"), "mark")
    need = int(bands_rows * least * 0.6)

    def compare(table: pa.Table) -> pa.Table:
        column = lambda name: table[name].combine_chunks()
        signs = np.stack([np.frombuffer(s, np.uint32) for s in table["signature"].to_pylist()])
        band = table["band"][0].as_py()
        before = column("keys").flatten().to_numpy().reshape(len(signs), -1)[:, :band]
        hashes, weights = column("hashes"), column("weights")
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def set_of(i: int) -> tuple[np.ndarray, np.ndarray]:
            if i not in held:
                held[i] = np.frombuffer(hashes[i].as_buffer(), np.uint64), np.frombuffer(weights[i].as_buffer(), np.float32).astype(np.float64)
            return held[i]

        part = np.unique(np.array(table["label"].to_pylist(), object), return_inverse=True)[1]
        marks, chunk = table["mark"].to_pylist(), column("chunk").to_numpy()
        alone = table["low"][0].as_py() == table["high"][0].as_py()
        links = []
        for i in range(len(signs)):
            js = i + 1 + np.flatnonzero((part[i + 1 :] != part[i]) & (alone | (chunk[i + 1 :] != chunk[i])))
            agree = (signs[js] == signs[i]).sum(1)
            js, agree = js[agree >= need], agree[agree >= need]
            first = ~(before[js] == before[i]).any(1)
            for j in js[first][np.argsort(-agree[first], kind="stable")].tolist():
                if part[j] != part[i]:
                    s = weighted_jaccard(*set_of(i), *set_of(j))
                    if s >= least:
                        links.append((min(marks[i], marks[j]), max(marks[i], marks[j]), s))
                        part[part == part[j]] = part[i]
        kinds = zip(("a", "b", "similarity"), (pa.string(), pa.string(), pa.float64()), list(zip(*links)) or [(), (), ()])
        return pa.table({name: pa.array(values, kind) for name, kind, values in kinds})

    found = rest.groupBy("band", "key", "low", "high").applyInArrow(compare, "a string, b string, similarity double")
    return found.dropDuplicates(["a", "b"])


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    least: float = 0.8,
    bands: int = 16,
    rows: int = 3,
    seed: int = 5,
    batch_chars: int = 8_000_000,
    marked: bool = False,
) -> DataFrame:
    """One row per document: the id, ``class_id`` and ``group_id``.

    ``class_id`` is the smallest id with exactly this text, ``group_id`` the smallest id
    that can be reached over links of weighted Jaccard similarity ``least`` or more between
    the TF-IDF weighted shingles of ``words`` words. Texts that share a band of samples are
    compared with the first text of that band; what remains in different groups although it
    shares a band is compared pair by pair. With 16 bands of 3 samples, a pair of similarity
    0.8 shares none in 1 case of 100,000. Links are between different texts, so that copies
    are not multiplied.

    NULL texts count as empty; empty texts are one class. A text of fewer words is one
    shingle. NULL ids do not name a class or group; one without other ids has NULL. Equal
    rows have equal results. Other columns are not looked at. With ``marked`` there are ``mark``,
    the MD5 of the text, and ``group``, the smallest mark of the group, as well; they tell texts
    and groups apart where ids are NULL or repeated.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sets = stored(shared_sets(docs, words, least, bands, rows, seed, batch_chars), "sets").dropDuplicates(["mark"])
    sets = stored(sets, "distinct-sets")
    size = F.expr("octet_length(hashes) + octet_length(weights)").cast("bigint").alias("size")
    members = stored(sets.select("mark", size, F.posexplode("keys").alias("band", "key")), "bands")
    buckets = members.groupBy("band", "key").agg(F.min("mark").alias("a"), F.count("*").alias("n")).filter("n > 1")
    buckets = stored(buckets, "buckets")
    pairs = members.join(buckets, ["band", "key"]).filter("a <> mark").select("a", F.col("mark").alias("b")).distinct()
    links = stored(_verified(pairs, sets, least), "near-links")

    labels = components(links)
    placed = members.join(labels, F.col("mark") == F.col("node"), "left")
    placed = placed.select("band", "key", "mark", "size", F.coalesce("label", "mark").alias("label"))
    apart = placed.join(buckets.select("band", "key"), ["band", "key"]).groupBy("band", "key")
    apart = apart.agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count("*").alias("n"), F.sum("size").alias("bytes")).filter("x <> y")
    more = stored(_across(placed, apart, sets, bands * rows, least), "more-links")
    if not more.isEmpty():
        labels = components(links.unionAll(more))

    named = stored(docs.select("id", F.md5("text").alias("mark")), "marks")
    classes = named.groupBy("mark").agg(F.min("id").alias("class_id"))
    classes = classes.join(labels.withColumnRenamed("node", "mark"), "mark", "left")
    classes = classes.withColumn("label", F.coalesce("label", "mark"))
    groups = classes.groupBy("label").agg(F.min("class_id").alias("group_id"))
    classes = classes.join(groups, "label").select("mark", "class_id", "group_id", F.col("label").alias("group"))
    more = ["mark", "group"] if marked else []
    return named.join(classes, "mark").select(F.col("id").alias(id_col), "class_id", "group_id", *more)
