"""Rules against plain Python, trees on held-out URLs."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm.boosting import boost
from tablewright.llm.queries import QUERIES, URL_RULES
from tablewright.llm.url_filter import verdicts

KIND = "page_id bigint, url string, host string, zone string, found int"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:end], rest[end:]
    tail = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), tail


def ruled(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


ODD = [
    None, "", "no scheme", "://", "http://", "http://ORG", "http://org/", "http://notorg/es/", "HTTP://A.Example.ORG/es/1", "http://example.org/en/19",
    "http://example.org/en/2", "x://y://org/", "http://a.com/fr/?q=/de/", "http://a.com#/fr/", "http://b.com/de/x#y?z", "http://É.COM/de/", "http://a\nb.com/fr/\n1",
    "http://myexample.org/es/", "http://net/" + "a1" * 200_000, "http://a.net/%20%41?a=1&b=2#f", "http://com/fr/",
]


def test_hosts_paths_and_rules(spark):
    rows = [(i, u, "x", "y", 1) for i, u in enumerate(ODD)] + [(6, ODD[6], None, None, None), (None, ODD[6], None, None, None)]
    found = verdicts(spark.createDataFrame(rows, KIND), URL_RULES).collect()
    assert len(found) == len(rows)
    for r in found:
        url = ODD[6] if r["page_id"] is None else ODD[r["page_id"]]
        host, path = parts(url)
        rule, verdict = ruled(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), url
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")


def test_no_pages_and_no_labels(spark):
    none = spark.createDataFrame([], KIND)
    assert verdicts(none, URL_RULES).count() == 0
    some = spark.createDataFrame([(1, "http://a.net/", None, None, None)], KIND)
    assert verdicts(some, []).first()["verdict"] == "allow"
    allowed = spark.createDataFrame([(1, "http://a.net/", None, None, None), (2, "http://b.org/", None, None, None)], KIND)
    assert [r["verdict"] for r in verdicts(allowed, URL_RULES).collect()] == ["allow", "allow"]


def urls(n, seed):
    """Bad ones have more digits, hyphens or parameters, but none of these in all of them."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        bad = rng.random() < 0.35
        word = lambda k: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(k))
        host = f"{word(6)}.{rng.choice(['example', 'sample', word(5)])}.{rng.choice(['com', 'net'] if bad else ['com', 'net', 'edu'])}"
        path = "/".join(word(5) for _ in range(rng.randrange(1, 4)))
        if bad:
            kind = rng.randrange(3)
            host = f"{word(4)}-{word(4)}-{host}" if kind == 0 else host
            path = path + "/" + "".join(rng.choice("0123456789") for _ in range(14)) if kind == 1 else path
            path = path + "?" + "&".join(f"{word(2)}={word(3)}" for _ in range(6)) if kind == 2 else path
        out.append((i, f"https://{host}/{path}", int(bad)))
    return out


def test_trees_on_held_out_urls(spark):
    known, other = urls(3000, 1), urls(1000, 2)
    labelled = spark.createDataFrame(known, "page_id bigint, url string, block int").union(
        spark.createDataFrame([(1, None, 1), (2, "http://x.y/", None), (3, "http://x.y/", 7)], "page_id bigint, url string, block int")
    )
    pages = spark.createDataFrame(other, "page_id bigint, url string, truth int")
    found = {r["page_id"]: r["verdict"] == "block" for r in verdicts(pages, [], labelled).collect()}
    assert np.mean([found[i] == bool(bad) for i, _, bad in other]) > 0.95
    again = {r["page_id"]: r["verdict"] == "block" for r in verdicts(pages.repartition(5), [], labelled.repartition(7)).collect()}
    assert again == found
    few = {r["page_id"]: r["verdict"] == "block" for r in verdicts(pages, [], labelled, max_rows=500).collect()}
    assert np.mean([few[i] == bool(bad) for i, _, bad in other]) > 0.9


def test_boosting_learns_what_one_cut_cannot():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.5)).astype(float)
    model = boost(x[:3000], y[:3000], np.ones(3000))
    assert ((model.probability(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95
    weight = np.where(y[:3000] > 0, 5.0, 1.0)
    twice = boost(np.repeat(x[:3000], weight.astype(int), 0), np.repeat(y[:3000], weight.astype(int)), np.ones(int(weight.sum())))
    once = boost(x[:3000], y[:3000], weight)
    assert abs(once.base - twice.base) < 1e-9


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_against_sql(spark, folder):
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)
    expected = duckdb.sql(
        f"""WITH r(verdict, place, start) AS (VALUES {rules}),
        u AS (SELECT page_id, translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
          regexp_extract(url, '://[^/?#]*([^?#]*)', 1) AS path FROM read_parquet('{folder}/pages.parquet'))
        SELECT page_id, host, path, max_by(place || start, length(place || start)), max_by(verdict, length(place || start))
        FROM u LEFT JOIN r ON (host = place OR ends_with(host, '.' || place)) AND starts_with(path, start) GROUP BY ALL"""
    ).fetchall()
    found = QUERIES["op12_url_filter"](spark, folder).cache()
    assert found.filter("verdict not in ('allow', 'block') or verdict is null").count() == 0
    got = found.select("page_id", "host", "path", "rule", F.when(F.col("rule").isNotNull(), F.col("verdict"))).collect()
    assert sorted(tuple(r) for r in got) == sorted(expected, key=lambda r: r[0])
