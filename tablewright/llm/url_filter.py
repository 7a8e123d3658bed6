"""Verdicts on URLs: rules first, then boosted trees on what a URL looks like."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tablewright.llm.boosting import Boosted, boost
from tablewright.llm.common import stored
from tablewright.operators.joins import broadcast_join

ALLOW, BLOCK = "allow", "block"
_SHAPE = ("length", "host_length", "path_length", "depth", "labels", "digits", "digit_run", "hyphens", "entropy", "parameters", "escapes", "fragment")
_COUNTS = ("zone_n", "zone_rate", "site_n", "site_rate")
FEATURES = _SHAPE + _COUNTS


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, with A to Z in lower case; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(F.coalesce(host, F.lit("")), upper, lower)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule (verdict, host, path) that fits, as a struct of ``rule`` and ``verdict``; else NULL.

    A rule fits its host and the hosts below it if the path starts with the rule's. Of two
    rules of one length the one that sorts first wins, and to block before to allow.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    ordered = sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2], r[0]))
    best: dict[str, tuple[str, str, str]] = {}
    for rule in ordered:
        best[rule[1] + rule[2]] = max(best.get(rule[1] + rule[2], rule), rule)  # "block" sorts after "allow"
    for verdict, at, start in sorted(best.values(), key=lambda r: (len(r[1] + r[2]), [-ord(c) for c in r[1] + r[2]])):
        fits = ((host == at) | F.endswith(host, F.lit("." + at))) & F.startswith(path, F.lit(start))
        found = F.when(fits, F.struct(F.lit(at + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def shape(urls: Sequence[str | None], hosts: Sequence[str], paths: Sequence[str]) -> np.ndarray:
    """What URLs look like: a row of ``_SHAPE`` for each."""
    out = np.zeros((len(urls), len(_SHAPE)))
    for i, (url, host, path) in enumerate(zip(urls, hosts, paths)):
        raw = np.frombuffer((url or "").encode(), np.uint8)
        n = max(1, len(raw))
        counts = np.bincount(raw, minlength=256)
        share = counts[counts > 0] / n
        digit = np.r_[0, (raw >= 48) & (raw <= 57), 0].astype(np.int8)
        edges = np.flatnonzero(np.diff(digit))
        query = (url or "").partition("?")[2].partition("#")[0]
        out[i] = (
            len(raw), len(host), len(path), path.count("/"), host.count(".") + 1 if host else 0, counts[48:58].sum() / n,
            (edges[1::2] - edges[::2]).max(initial=0), host.count("-"), -(share * np.log2(share)).sum(), query.count("&") + bool(query),
            counts[37], "#" in (url or ""),
        )
    return out


def _suffixes(host: Column) -> tuple[Column, Column]:
    """The last label of a host, and the last two."""
    return F.substring_index(host, ".", -1), F.substring_index(host, ".", -2)


def train(known: DataFrame, prior: float = 10.0, max_rows: int = 50_000) -> tuple[Boosted, float, DataFrame, DataFrame]:
    """Trees, the share to block, and the counts per zone and per site, from ``url, host, path, zone, site, y``.

    Equal URLs are counted first. The counts of suffixes cover all of them; the trees are
    fitted on at most about ``max_rows`` different URLs, those with the smallest hashes.
    A URL's own label does not count for its suffixes while the trees learn.
    """
    known = stored(known.groupBy("url", "host", "path", "zone", "site", "y").agg(F.count("*").cast("double").alias("w")), "url-labels")
    n, weight, positive = known.agg(F.count("*"), F.sum("w"), F.sum(F.col("w") * F.col("y"))).first()
    share = (positive or 0.0) / (weight or 1.0)

    def counts(name: str) -> DataFrame:
        sums = known.groupBy(name).agg(F.sum("w").alias(f"{name}_w"), F.sum(F.col("w") * F.col("y")).alias(f"{name}_p"))
        return stored(sums, f"url-{name}")

    zones, sites = counts("zone"), counts("site")
    part = F.pmod(F.xxhash64("url"), F.lit(1 << 32)) < int((1 << 32) * min(1.0, max_rows / max(n, 1)))
    drawn = known.filter(part).join(zones, "zone").join(sites, "site")
    rows = drawn.select("url", "host", "path", "y", "w", "zone_w", "zone_p", "site_w", "site_p").orderBy("url", "y").toPandas()
    x = shape(rows["url"], rows["host"], rows["path"])
    y, w = rows["y"].to_numpy(float), rows["w"].to_numpy(float)
    own = []
    for name in ("zone", "site"):
        others = rows[f"{name}_w"].to_numpy(float) - w
        own += [np.log1p(others), (rows[f"{name}_p"].to_numpy(float) - w * y + prior * share) / (others + prior)]
    return boost(np.c_[x, np.stack(own, 1)], y, w), share, zones, sites


def verdicts(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]],
    labelled: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    limit: float = 0.5,
    prior: float = 10.0,
    max_rows: int = 50_000,
) -> DataFrame:
    """One row per page: the id, ``host``, ``path``, ``rule``, ``verdict`` and the trees' ``probability`` to block.

    The longest rule that fits decides. Where none does, boosted trees judge the URL by its
    length, depth, digits, entropy and parameters, and by how often URLs under the same last
    one and two labels of the host are to be blocked; from ``limit`` on it is blocked.

    ``labelled`` has ``url_col`` and ``block`` (0 or 1); without it the URLs that a rule
    decides are the labelled ones. Repeated URLs weigh as often as they stand. URLs or labels
    that are NULL teach nothing; a NULL URL, or one without ``://``, has an empty host and path.
    Without labels, or with labels of one kind, the share of blocked labels decides alone.
    """
    url = F.col(url_col).cast("string")

    def parsed(df: DataFrame, *more: Column) -> DataFrame:
        rows = df.select(*more, url.alias("url")).withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
        zone, site = _suffixes(F.col("host"))
        return rows.withColumns({"zone": zone, "site": site})

    rows = parsed(pages, F.col(id_col).alias("id")).withColumn("found", rule_for(F.col("host"), F.col("path"), rules))
    if labelled is None:
        known = rows.filter("found is not null").withColumn("y", (F.col("found.verdict") == BLOCK).cast("int"))
    else:
        known = parsed(labelled, F.col("block").cast("int").alias("y")).filter("url is not null and y in (0, 1)")
    model, share, zones, sites = train(known.select("url", "host", "path", "zone", "site", "y"), prior, max_rows)
    counted = broadcast_join(broadcast_join(rows, zones, "zone", "left"), sites, "site", "left")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame: pd.DataFrame = batch.to_pandas()
            own = []
            for name in ("zone", "site"):
                n, p = (frame[f"{name}_{c}"].fillna(0.0).to_numpy(float) for c in "wp")
                own += [np.log1p(n), (p + prior * share) / (n + prior)]
            x = np.c_[shape(frame["url"], frame["host"], frame["path"]), np.stack(own, 1)]
            kept = [batch.column(c) for c in ("id", "host", "path", "rule", "ruled")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(model.probability(x))], names=["id", "host", "path", "rule", "ruled", "probability"])

    counted = counted.select(
        "id", "url", "host", "path", F.col("found.rule").alias("rule"), F.col("found.verdict").alias("ruled"), "zone_w", "zone_p", "site_w", "site_p"
    )
    kind = counted.select("id", "host", "path", "rule", "ruled").schema.add("probability", "double")
    judged = counted.mapInArrow(judge, kind)
    own = F.when(F.col("probability") >= limit, BLOCK).otherwise(ALLOW)
    return judged.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "probability")
