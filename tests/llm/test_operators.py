"""The operators on small fixtures, against plain Python."""

import hashlib
import math
import random
import re
import string
import time
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from tablewright.llm.attention import END, START, WINDOW, Attention, packed, train, unpacked, windows
from tablewright.llm.common import WORD, permuted, stored
from tablewright.llm.lm_scores import scored, words_of
from tablewright.llm import attention, lm_scores, posting_lists, weighted_minhash
from tablewright.llm.mixing import mixed_documents, mixed_sources
from tablewright.llm.order_minhash import fingerprints, signature
from tablewright.llm.pieces import decoded, encoded
from tablewright.llm.posting_lists import Graph, _lifted, fit_centroids, nearest
from tablewright.llm.quotations import keys_of, linked
from tablewright.llm.sentence_spans import without_repeated_spans
from tablewright.llm.site_quality import logistic, site_quality
from tablewright.llm.tokens import PATTERN, VOCABULARY, encoder, ranks_of
from tablewright.llm.training_order import read_slots, training_order
from tablewright.llm.weighted_minhash import near_duplicates

KIND = "doc_id bigint, text string, lang string, source string, n_chars bigint, h1 int, `again` string"
PASSAGE = " ".join(f"word{i}" for i in range(60)) + "."
TEXTS = ["", None, "one", "x" * 50_000, PASSAGE, PASSAGE, f"Other start here. {PASSAGE} Other end follows now.", "a b c d\n\n e > f"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", [None, "s1", "s2"][i % 3], len(t or ""), 1, None) for i, t in enumerate(TEXTS)]
    rows += [rows[4], (None, "no id here", None, None, None, None, "z")]
    return spark.createDataFrame(rows, KIND)


def test_empty_tables(spark, docs):
    none, labels = docs.limit(0), spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    for made in (
        near_duplicates(none), without_repeated_spans(none), mixed_sources(none), mixed_documents(none), encoded(none),
        fingerprints(none), scored(none, steps=1), training_order(none), site_quality(none, labels),
        nearest(spark.createDataFrame([], "vec_id bigint, embedding array<float>")),
        linked(spark.createDataFrame([], "message_id bigint, text string")),
    ):
        assert made.count() == 0


def test_pieces_come_back(docs):
    rows = decoded(encoded(docs)).collect()
    assert len(rows) == 10 and all(r["text"] == r["decoded"] for r in rows)


def test_near_duplicates_join_copies_only(docs):
    found = {r["doc_id"]: r["group_id"] for r in near_duplicates(docs).collect()}
    assert found[4] == found[5] == 4 and found[0] == found[1] == 0
    assert found[2] == 2 and found[3] == 3 and found[7] == 7


def unique(n):
    return [(i, " ".join(f"w{i}x{j}" for j in range(30))) for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 20, 60])
@pytest.mark.parametrize("batch_chars", [300, 8_000_000])
def test_tables_without_any_copy(spark, n, batch_chars):
    rows = near_duplicates(spark.createDataFrame(unique(n), "doc_id bigint, text string"), batch_chars=batch_chars).collect()
    assert sorted((r["doc_id"], r["class_id"], r["group_id"]) for r in rows) == [(i, i, i) for i in range(n)]


def test_a_text_longer_than_a_batch(spark):
    long = " ".join(f"only{i}" for i in range(3000))
    rows = [*unique(5), (5, long), (6, f"another start {long}"), (7, " ".join(f"lone{i}" for i in range(3000)))]
    found = near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), batch_chars=2000).collect()
    assert {r["doc_id"]: r["group_id"] for r in found} == {**{i: i for i in range(6)}, 6: 5, 7: 7}


def test_links_against_all_pairs(spark):
    """Groups of all documents, by the weighted Jaccard similarity of every pair that shares a run of words."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}
    sets = {}
    for i, text in texts.items():
        words = text.lower().encode().split()
        runs = [tuple(words[j : j + 5]) for j in range(max(1, len(words) - 4))] if words else []
        sets[i] = Counter(runs)
    df = Counter(run for s in sets.values() for run in s)
    n = len(texts)
    weight = lambda run, tf: tf * math.log1p(n / (df[run] + n / 10))
    total = {i: sum(weight(run, tf) for run, tf in s.items()) for i, s in sets.items()}
    holders = {}
    for i, s in sets.items():
        for run in s:
            if df[run] > 1:
                holders.setdefault(run, []).append(i)
    both = Counter()
    for run, ids in holders.items():
        for a in range(len(ids)):
            for b in range(a):
                both[ids[b], ids[a]] += min(weight(run, sets[ids[a]][run]), weight(run, sets[ids[b]][run]))
    label = {i: i for i in texts}

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    empty = [i for i, s in sets.items() if not s]
    pairs = [p for p, w in both.items() if w / (total[p[0]] + total[p[1]] - w) >= 0.8] + [(empty[0], i) for i in empty[1:]]
    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        label[b] = a
    found = {r["doc_id"]: r["group_id"] for r in near_duplicates(docs).collect()}
    wrong = [i for i in texts if found[i] != top(i)]
    assert len({top(i) for i in texts}) < n - 50 and not wrong


def test_stored_rows_leave_no_shuffle_files(spark):
    """A query's shuffle files are not kept until the driver collects garbage."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles()
        return {files.apply(i).getName() for i in range(files.size())} - before

    before = set()
    before, kept = shuffled(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    rows = spark.range(5000).groupBy((F.col("id") % 100).alias("k")).agg(F.collect_list("id").alias("ids"))
    rows = stored(rows.repartition(3, "k"), "shuffled")
    until = time.time() + 20
    while time.time() < until and any(name.startswith("shuffle_") for name in shuffled()):
        time.sleep(0.2)
    assert not any(name.startswith("shuffle_") for name in shuffled())
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == kept
    assert rows.select(F.explode("ids")).distinct().count() == 5000


def test_shingles_of_many_texts_at_once():
    rng = random.Random(6)
    texts = ["", " ", "One", "a B c d", "x " * 40, *(" ".join(rng.choices("abc", k=rng.randrange(60))) for _ in range(200)), ""]
    hashes, counts, sizes = weighted_minhash.shingles(texts, 3)
    mark, ends = {}, np.cumsum(sizes)
    for text, size, end in zip(texts, sizes, ends):
        words = text.lower().split()
        runs = Counter(tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))) if words else {}
        own, n = hashes[end - size : end].tolist(), counts[end - size : end]
        assert own == sorted(set(own)) and sorted(n) == sorted(runs.values())
        for run in runs:  # a run alone is one shingle
            mark[run] = mark.get(run) or weighted_minhash.shingles([" ".join(run)], 3)[0][0]
        assert dict(zip(own, n)) == {mark[run]: k for run, k in runs.items()}
    assert len(set(mark.values())) == len(mark) and not weighted_minhash.shingles([], 3)[0].size


def test_small_groups_are_compared_without_pandas(spark):
    """Most bands that texts share have a few members; a data frame for each cost more than the comparison."""
    sets = "mark string, hashes binary, weights binary, signature binary, keys array<bigint>"
    hashes, weights = [np.arange(k, k + 100, dtype=np.uint64) for k in (0, 1, 50)], np.ones(100, np.float32).tobytes()
    signs = np.ones(12, np.uint32).tobytes()
    rows = [(f"m{i}", h.tobytes(), weights, signs, [7, 7 if i else 8]) for i, h in enumerate(hashes)]
    sets = spark.createDataFrame(rows, sets)
    members = spark.createDataFrame([(0, 7, f"m{i}", f"m{i}") for i in range(3)], "band int, key bigint, mark string, label string")
    buckets = spark.createDataFrame([(0, 7, 3, 3600)], "band int, key bigint, n bigint, bytes bigint")
    found = weighted_minhash._across(members, buckets, sets, 12, 0.8)
    assert [(r["a"], r["b"]) for r in found.collect()] == [("m0", "m1")]
    assert "Pandas" not in found._jdf.queryExecution().toString()


def test_repeated_passage_goes(docs):
    found = {r["doc_id"]: r["text"] for r in without_repeated_spans(docs).collect()}
    assert found[4] == PASSAGE and found[5] == "" and PASSAGE not in found[6] and "Other start" in found[6]
    assert found[1] is None and found[7] == TEXTS[7]


def test_repeated_short_sentences_go(spark):
    passage = " ".join(f"w{i} v{i}!" for i in range(30))  # 60 words, two in a sentence
    rows = [(0, f"An opening of one kind stands here. {passage} One end."), (1, f"Some other words come first. {passage} Other end."), (2, passage)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit(None).cast("string") for c in ("lang", "source", "n_chars")})
    made = {r["doc_id"]: r["text"] for r in corpus_pipeline.unrepeated(spark, docs, "").collect()}
    assert made == {0: rows[0][1], 1: "Some other words come first. Other end.", 2: ""}
    assert {r["doc_id"]: r["text"] for r in without_repeated_spans(docs).collect()} == made


def test_everyday_phrases_stay(spark):
    rows = [(i, f"Thank you so much. See you all next week. Only text {i} goes on about matter {i}.") for i in range(5)]
    kept = without_repeated_spans(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {(r["doc_id"], r["text"]) for r in kept.collect()} == set(rows)


def test_span_columns_with_clashing_names(spark):
    names = ["__id", "__version", "__hash", "__cuts", "own", "VERSION", "hash", "places", "at", "n"]
    rows = spark.createDataFrame([(1, PASSAGE), (2, f"Before it. {PASSAGE}")], "doc_id bigint, text string")
    rows = rows.withColumns({name: F.concat(F.lit(name), F.col("doc_id")) for name in names})
    found = without_repeated_spans(rows)
    assert found.columns == [*rows.columns, "n_sentences", "n_removed"]
    for row in found.collect():
        assert all(row[name] == f"{name}{row['doc_id']}" for name in names) and row["n_removed"] == row["doc_id"] - 1


def test_one_document_of_each_group_stays(spark):
    near = PASSAGE.replace("word30", "other").replace("word", "longer ")
    copies = [(None, PASSAGE), (None, PASSAGE + " End."), (None, PASSAGE), (7, "one text of its own"), (7, near), (9, near + " More.")]
    lone = [(None, "nobody else says this"), (None, None), (12, "")]
    docs = spark.createDataFrame(copies + lone, "doc_id bigint, text string")
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.single(spark, docs, "").collect()]
    assert len(kept) == 5 and {r for r in kept if r[0]} == {(7, "one text of its own"), (7, near), (12, "")}
    assert sum(t in (PASSAGE, PASSAGE + " End.") for _, t in kept) == 1 and (None, "nobody else says this") in kept


def test_mix_takes_no_more_than_thrice(docs):
    rows = mixed_sources(docs).collect()
    assert len(rows) == 10 and all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    assert sum(r["taken"] for r in rows) > 0
    made = mixed_documents(docs)
    assert made.columns == docs.columns
    words = sum(len(r["text"].split()) for r in made.collect())
    assert words == sum(r["taken"] for r in rows)


def test_order_is_a_permutation():
    for n in (1, 2, 7, 1000):
        there = permuted(np.arange(n), n, 5)
        assert sorted(there) == list(range(n))
        assert (permuted(there, n, 5, back=True) == np.arange(n)).all()


def test_without_labels_nothing_is_rejected(spark, docs):
    labels = spark.createDataFrame([(None, None, None)], "doc_id bigint, quality int, toxic int")
    rows = site_quality(docs, labels).collect()
    assert len(rows) == 10 and not any(r["rejected"] for r in rows)


def test_site_rates_against_plain_python(spark):
    """Trained on labels; rates and posteriors follow from the evidence as plain loops have them."""
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for i in range(900):
        site = f"h{i % 6}"
        bad = rng.random() < (0.7 if i % 6 == 0 else 0.1)
        words = rng.choice(["buy", "cheap", "pills", "now"] if bad else ["the", "river", "flows", "past"], 12)
        rows.append((i, " ".join([*words, *rng.choice(["a", "of", "and", "so"], 10)]), site, f"p{i % 4}", None))
        if i % 3:
            labels.append((i, int(not bad), 0))
    rows += [rows[0], (None, None, None, None, "x"), (901, "", "alone", None, "x"), (902, "river " * 50_000, "h1", "p1", "")]
    labels += [labels[0], (5000, 0, 0), (None, 1, 0), (2, None, 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string, `hn` string")
    found = site_quality(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).collect()
    assert len(found) == len(rows)
    where = {r[0]: ((r[2] is None, r[2]), (r[3] is None, r[3])) for r in rows}
    e = [(where[r["doc_id"]], round(r["evidence"] * 1e6)) for r in found]
    n, m = len(e), sum(p for _, p in e) / 1e6 / len(e)
    hosts, paths = {}, {}
    for (host, path), p in e:
        hosts.setdefault(host, []).append(p)
        paths.setdefault((host, path), []).append(p)
    mean = lambda v: sum(v) / 1e6 / len(v)

    def prior(deviation, groups, squares, levels):
        rho = (deviation / (m * (1 - m)) - (groups - levels)) / (n - squares - (groups - levels))
        return 1 / min(max(rho, 1e-4), 0.5) - 1

    host_prior = prior(sum(len(v) * (mean(v) - m) ** 2 for v in hosts.values()), len(hosts), sum(len(v) ** 2 for v in hosts.values()) / n, 1)
    path_prior = prior(
        sum(len(v) * (mean(v) - mean(hosts[k[0]])) ** 2 for k, v in paths.items()), len(paths), sum(len(v) ** 2 / len(hosts[k[0]]) for k, v in paths.items()), len(hosts)
    )
    logit = lambda p: math.log(min(max(p, 1e-6), 1 - 1e-6) / (1 - min(max(p, 1e-6), 1 - 1e-6)))
    for r, (key, p) in zip(found, e):
        host, path = hosts[key[0]], paths[key]
        host_rate = ((sum(host) - p) / 1e6 + host_prior * m) / (len(host) - 1 + host_prior)
        path_rate = ((sum(path) - p) / 1e6 + path_prior * host_rate) / (len(path) - 1 + path_prior)
        odds = logit(r["evidence"]) + logit(path_rate) - logit(m)
        assert math.isclose(r["host_rate"], host_rate, rel_tol=1e-9) and math.isclose(r["path_rate"], path_rate, rel_tol=1e-9)
        assert math.isclose(r["posterior"], 1 / (1 + math.exp(-odds)), rel_tol=1e-9) and r["rejected"] == (r["posterior"] >= 0.5)
    truth = {r[0]: r[1] is not None and "buy" in r[1] + "pills" and any(w in r[1] for w in ("buy", "cheap", "pills", "now")) for r in rows[:900]}
    unlabelled = [r for r in found if r["doc_id"] is not None and r["doc_id"] < 900 and r["doc_id"] % 3 == 0]
    assert np.mean([r["rejected"] == truth[r["doc_id"]] for r in unlabelled]) > 0.97


def test_quality_on_held_out_labels(spark):
    """Trained on half of the labels of sf0.01, judged on the other half."""
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    half = site_quality(docs, labels.filter("doc_id % 2 = 0")).select("doc_id", "rejected")
    rows = half.join(labels.filter("doc_id % 2 = 1"), "doc_id").collect()
    bad = [r["rejected"] for r in rows if r["quality"] == 0 or r["toxic"] == 1]
    good = [r["rejected"] for r in rows if r["quality"] == 1 and r["toxic"] == 0]
    assert np.mean(bad) > 0.75 and np.mean(good) < 0.02


def test_tokens_are_those_of_the_whole_text():
    with open(VOCABULARY, "rb") as file:
        data = file.read()
    coder = encoder(data)
    # Fixed value: the pattern as it was first published with the vocabulary.
    first = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    plain = tiktoken.Encoding("first", pat_str=first, mergeable_ranks=ranks_of(data), special_tokens={})
    rng = np.random.default_rng(8)
    parts = ["word", "Don't", "é", "12345", " ", "  ", "\n", " \n", "\t", "\u00a0", "\u2003", "...", "x" * 300, "日本", "'s", "a'll b", ""]
    texts = [" ".join(rng.choice(parts, n)) for n in rng.integers(0, 30, 300)] + ["".join(rng.choice(parts, n)) for n in rng.integers(0, 30, 300)]
    for text in [*texts, "", " ", "a ", " a", None]:
        assert np.frombuffer(coder.packed(text), coder.kind).tolist() == plain.encode_ordinary(text or "")


def test_shards_hold_every_text_in_the_drawn_order(spark, folder):
    rng = random.Random(3)
    rows = [(i % 37 if i % 5 else None, rng.choice([None, "", "short", "some words " * rng.randrange(1, 200), "é\n" * 900]), i) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, slot int").repartition(5).persist()
    path = f"file://{folder}" if "://" not in folder else folder
    index = training_order(docs, path, length=64, shard_records=100).collect()
    with open(VOCABULARY, "rb") as file:
        coder = encoder(file.read())
    expected = Counter()
    for i, text, _ in rows:
        ids = [*coder.coder.encode_ordinary(text or ""), coder.end]
        for part in range(-(-len(ids) // 64)):
            own = ids[part * 64 : part * 64 + 64]
            expected[i, part, len(own), tuple(own + [coder.end] * (64 - len(own)))] += 1
    n = sum(expected.values())
    records = [tuple(r) for block in read_slots(path) for r in block.tolist()]
    assert len(records) == n == len(index) and sorted(r["slot"] for r in index) == list(range(n))
    assert Counter((r["doc_id"], r["part"], r["n_tokens"], records[r["slot"]]) for r in index) == expected
    assert all((r["shard"], r["position"]) == divmod(r["slot"], 100) for r in index)
    assert [tuple(r) for block in read_slots(path, 131, 257, 7) for r in block.tolist()] == records[131:257]


def test_fingerprints_against_plain_python(spark):
    """Likeness follows from the signatures by its definition; equal signatures from equal runs."""
    rng = random.Random(2)
    rows = [(i // 2, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(0, 60)))) for i in range(120)] + [(None, None), (None, "a b")]
    found = fingerprints(spark.createDataFrame(rows * 2, "doc_id bigint, text string")).collect()
    assert len(found) == 2 * len(rows)
    read = lambda x: dict(p.split(":") for p in x.split(".")) if x else {}
    order, by = [], {}
    for r in found:
        a, b = read(r["fingerprint"]), read(r["edited_fingerprint"])
        same = sum(b.get(k) == v for k, v in a.items())
        assert math.isclose(r["near_edited"], same / len({*a, *b}) if a or b else 1.0)
        by.setdefault((r["doc_id"], r["n_chars"], r["edited_sha256"]), r)
    texts = {}
    for i, t in rows:
        texts.setdefault(i, set()).add(t or "")
    ends = {hashlib.sha256((t[: len(t) - len(t) // 2] + u[: len(t) // 2]).encode()).hexdigest() for v in texts.values() for t in v for w in texts.values() for u in w}
    assert all(r["edited_sha256"] in ends for r in found)
    # Within one id either order of two texts is allowed; every row is the next of exactly one other.
    assert len(by) == len({(i, t) for i, v in texts.items() for t in v})


def test_fingerprint_signature_by_definition(spark):
    """Ranges, minimal runs and their order in the text, rebuilt from the run hashes that Spark gives."""
    text = "one two one two three one two four five six seven one two"
    words = text.split()
    pairs = [" ".join(words[i : i + 2]) for i in range(len(words) - 1)]
    spark.createDataFrame([(text,)], "text string").createOrReplaceTempView("one_text")
    hashes = spark.sql("select transform(sequence(0, %d), i -> xxhash64(w[i], w[i + 1])) h from (select split(text, ' ') w from one_text)" % (len(words) - 2)).first()["h"]
    seen, numbered = Counter(), []
    for i, (pair, h) in enumerate(zip(pairs, hashes)):
        v = h if not seen[pair] else spark.range(1).select(F.xxhash64(F.lit(h), F.lit(seen[pair]))).first()[0]
        seen[pair] += 1
        numbered.append((v, i))
    numbered.sort()
    expected = {}
    for j, (v, _) in enumerate(numbered):
        if j == 0 or v >> 58 != numbered[j - 1][0] >> 58:
            two = sorted((numbered[(j + d) % len(numbered)] for d in range(2)), key=lambda x: x[1])
            made = spark.range(1).select(F.xxhash64(F.array(*[F.lit(x[0]).cast("bigint") for x in two]))).first()[0]
            expected[v >> 58] = made
    found = spark.createDataFrame([(text,)], "text string").select(signature(F.col("text")).alias("s")).first()["s"]
    assert {x["at"]: x["tuple"] for x in found} == expected


def test_fingerprints(docs):
    rows = fingerprints(docs).collect()
    assert len(rows) == 10
    by = {r["doc_id"]: r for r in rows}
    assert by[4]["fingerprint"] == by[5]["fingerprint"] and by[0]["fingerprint"] == by[1]["fingerprint"] == ""
    assert by[4]["near_next"] == 1.0 and by[0]["near_next"] == 1.0 and by[2]["near_next"] == 0.0
    edited = TEXTS[6][: len(TEXTS[6]) - len(TEXTS[6]) // 2] + TEXTS[7][: len(TEXTS[6]) // 2]
    assert by[6]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    last = TEXTS[7][: len(TEXTS[7]) - len(TEXTS[7]) // 2] + "no id here"[: len(TEXTS[7]) // 2]
    assert by[7]["edited_sha256"] == hashlib.sha256(last.encode()).hexdigest()


def test_fingerprint_feels_order(spark):
    words = [f"w{i}" for i in range(400)]
    moved = words[200:] + words[:200]
    rows = fingerprints(spark.createDataFrame([(0, " ".join(words)), (1, " ".join(moved)), (2, "w1 w2 " * 50)], "doc_id bigint, text string")).collect()
    near = {r["doc_id"]: r["near_next"] for r in rows}
    assert 0.2 < near[0] < 0.8  # nearly the same runs, but half of the pairs stand the other way round


def test_nearest_against_brute_force(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 8)).astype(np.float32)
    x[100:160] = x[100]
    rows = [(i, [float(v) for v in x[i]]) for i in range(600)]
    odd = [(600, None), (620, [0.0] * 8), (640, [float("nan")] * 8), (660, [1.0, None] * 4), (None, [1.0] * 8), (680, [1.0])]
    found = nearest(spark.createDataFrame(rows + odd + rows[:1], "vec_id bigint, embedding array<float>"), list_size=32).collect()
    v = x.astype(float)
    hits = 0
    for q in range(0, 600, 20):
        mine = sorted((r for r in found if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 21))
        assert all(abs(r["score"] - v[q] @ v[r["vec_id"]]) < 1e-12 for r in mine)
        best = [int(i) for i in np.lexsort((np.arange(600), -(v @ v[q]))) if i != q][:20]
        hits += len(set(best) & {r["vec_id"] for r in mine})
    assert len(found) == 600 and hits >= 0.9 * 600


def test_nearest_of_each_length(spark):
    rows = [(i, [float(i + 1), 1.0]) for i in range(41)] + [(i, [1.0, float(i)]) for i in (41, 60)] + [(i, [1.0, 0.0, float(i)]) for i in range(80, 103)]
    found = nearest(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), list_size=4).collect()
    for q, v in rows:
        if q % 20 == 0:
            others = [(-float(np.dot(v, w)), i) for i, w in rows if i != q and len(w) == len(v)]
            mine = sorted((r["rank"], r["vec_id"]) for r in found if r["query_id"] == q)
            assert [i for _, i in mine] == [i for _, i in sorted(others)[:20]]


@pytest.mark.parametrize("groups", [None, 600])
def test_recall_with_thousands_of_lists(groups):
    """Lists of centroids as queries choose them, without clusters and with 600: share of the 20 best that lie in them."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(30_000, 16))
    if groups:
        x = 0.4 * x + rng.normal(size=(groups, 16))[rng.integers(0, groups, len(x))]
    reach = np.linalg.norm(x, axis=1).max() * (1 + 1e-12)
    graph = Graph.of(fit_centroids(_lifted(x, reach), 7))
    assert len(graph.centroids) > 4_000
    ids, far = graph.search(_lifted(x, reach), 16)
    posted = np.zeros((len(x), len(graph.centroids)), bool)
    for c in range(4):
        near = (far[:, c] <= 1.15 * far[:, 0]) | (c == 0)
        posted[np.flatnonzero(near), ids[near, c]] = True
    asked = x[::300] / np.linalg.norm(x[::300], axis=1)[:, None]
    row, lists = graph.within(np.c_[asked, np.zeros(len(asked))], 1.4, 64, posted.sum(0), 84)
    hits = 0
    for i, q in enumerate(asked):
        best = np.argsort(-(x @ q))[:20]
        hits += posted[np.ix_(best, lists[row == i])].any(1).sum()
    assert hits >= 0.9 * 20 * len(asked)


def test_blocks_do_not_change_the_samples(monkeypatch):
    rng = np.random.default_rng(2)
    sizes = [1, 50, 3, 400, 7]
    hashes = rng.integers(0, 2**63, sum(sizes)).astype(np.uint64)
    weights, starts = rng.random(sum(sizes)) + 0.1, np.cumsum([0, *sizes[:-1]])
    whole = weighted_minhash.samples(hashes, weights, starts, 12, 5)
    monkeypatch.setattr(weighted_minhash, "_BLOCK", 52)
    assert (weighted_minhash.samples(hashes, weights, starts, 12, 5) == whole).all()


def test_quotes_lead_to_conversations(spark):
    rows = [
        (1, "First question\nof two lines"), (2, "> First question\n> of two lines\n\nAn answer"),
        (3, "> > First question\n> > of two lines\n> An  ANSWER\n\nThanks"), (4, "> of nowhere\nhello"),
        (5, "para one\n\npara two"), (6, "> para two\nonly that"), (7, None), (8, ""), (9, "An answer"), (None, "lost"), (9, "An"),
    ]
    found = {r["message_id"]: r for r in linked(spark.createDataFrame(rows, "message_id bigint, text string")).collect()}
    assert {i: r["parent_id"] for i, r in found.items()} == {1: None, 2: 1, 3: 2, 4: None, 5: None, 6: 5, 7: None, 8: None, 9: None}
    assert [found[i]["position"] for i in (1, 2, 3)] == [0, 1, 2] and found[3]["root_id"] == 1 and found[3]["depth"] == 2
    assert found[3]["text"] == "Thanks" and keys_of("")[1:] == ([], [])


def test_windows_score_each_token_once():
    starts = np.array([0, 1, 40, 140])
    _, place, fresh = windows(np.zeros(240, np.int32), starts)
    assert Counter(place[fresh].tolist()) == Counter(range(240))


def test_attention_is_causal_and_a_distribution():
    rng = np.random.default_rng(2)
    model = Attention.fresh(np.ones(4096), 8, 1)
    ids = rng.integers(0, 2000, 100).astype(np.int32)
    other = ids.copy()
    other[60:] = 5
    zero = np.zeros(1, np.int64)
    assert np.allclose(model.scores(ids, zero)[:60], model.scores(other, zero)[:60], atol=1e-4)
    h = rng.normal(size=(1, 8)).astype(np.float32)
    assert abs(np.exp(model.logs(np.repeat(h, 4096, 0), np.arange(4096))[0]).sum() - 1) < 1e-3


def test_gradients():
    rng = np.random.default_rng(3)
    model = Attention.fresh(np.ones(4096), 4, 1)
    model.p = {n: v.astype(np.float64) for n, v in model.p.items()}
    x, y = rng.integers(0, 50, (3, WINDOW)), rng.integers(0, 50, (3, WINDOW))
    use = rng.random((3, WINDOW)) < 0.8
    _, grads = model.step(x, y, use)
    for name, at in (("e", (x[0, 0], 1)), ("q", (0, 1)), ("k", (1, 2)), ("v", (2, 3)), ("o", (3, 0)), ("one", (0, 0)), ("two", (1, 1)), ("pos", (3, 2)), ("g", (1, 0))):
        model.p[name][at] += 1e-5
        up = model.step(x, y, use)[0]
        model.p[name][at] -= 2e-5
        down = model.step(x, y, use)[0]
        model.p[name][at] += 1e-5
        assert abs((up - down) / 2e-5 - grads[name][at]) < 1e-5, name


def test_training_helps():
    ids = np.tile(np.array([3, 7, 7, 9, END], np.int32), 200)
    starts = np.arange(0, 1000, 5)
    assert train(ids, starts, d=8, steps=400).scores(ids, starts).mean() > -0.2


def test_scores(docs):
    rows = scored(docs, steps=20).collect()
    assert len(rows) == 10 and all(r["score"] < 0 for r in rows)
    texts = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    held = {r["doc_id"]: r["held_out"] for r in rows}
    c = Counter()
    for i, t in texts:
        if not held[i]:
            c.update([*words_of(t), None])
    n, v = sum(c.values()), len(c)
    for r in rows:
        w = [*words_of(dict(texts)[r["doc_id"]]), None]
        assert r["n_tokens"] == len(w) and r["train_tokens"] == n and r["n_known"] == sum(c[x] > 0 for x in w)
        assert math.isclose(r["base_score"], sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w))


def test_every_training_piece_is_a_target_once():
    for n in (1, 31, 32, 33, 100):
        ids = np.arange(n)
        x, y, use = unpacked(packed(ids))
        assert y[use].tolist() == ids.tolist() and x[use].tolist() == [START, *ids[:-1]]


def test_long_texts_and_all_parts_train(spark, monkeypatch):
    monkeypatch.setattr(lm_scores, "_BATCH", 4)
    text = "alpha beta gamma delta. " * 40_000  # above what one text used to have at most
    rows = [(i, text if i == 0 else f"one two three {i}") for i in range(60)]
    made = scored(spark.createDataFrame(rows, "doc_id bigint, text string"), steps=40).collect()
    long = next(r for r in made if r["doc_id"] == 0)
    assert not long["held_out"] and long["score"] / long["n_tokens"] > math.log10(0.5)  # its word counts give below 0.25


def test_workers_keep_no_caches_between_tasks(spark):
    """Spark keeps Python workers; what one operator looked up is not held through the next ones."""
    rows = spark.createDataFrame([(i, f"word{i} again and again. Sentence {i} here.", "en", "s") for i in range(200)], "doc_id bigint, text string, lang string, source string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(200)], "doc_id bigint, quality int, toxic int")
    for made in (site_quality(rows, labels), near_duplicates(rows), decoded(encoded(rows))):
        made.write.format("noop").mode("overwrite").save()

    def held(batches):
        from tablewright.llm import pieces, site_quality, weighted_minhash

        for _ in batches:
            sizes = [len(site_quality._HASHES), len(weighted_minhash._HASHES), len(pieces._CODERS)]
            yield pa.RecordBatch.from_pydict({"n": [sum(sizes)]})

    found = spark.range(64).repartition(32).mapInArrow(held, "n bigint").collect()
    assert found and not any(row["n"] for row in found)


def test_tokens_by_a_pattern_without_look_ahead():
    with open(VOCABULARY, "rb") as file:
        coder = encoder(file.read())
    assert "(?!" not in coder.coder._pat_str and "++" not in coder.coder._pat_str
    plain = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=coder.coder._mergeable_ranks, special_tokens={})
    rng = np.random.default_rng(9)
    parts = [*"a1.'é 　�\x1c\x85\t\n ", "  ", "\r\n", "'ll", "<|end|>", " <", "\n\n\n"]
    for n in rng.integers(0, 12, 3000):
        text = "".join(rng.choice(parts, n))
        assert np.frombuffer(coder.packed(text), coder.kind).tolist() == plain.encode_ordinary(text)


def test_lists_give_only_entries_that_can_be_in_the_result(spark, monkeypatch):
    kept, made = posting_lists.stored, []

    def counted(df, label):
        rows = kept(df, label)
        if label == "near-vectors":
            made.append(rows.count())
        return rows

    monkeypatch.setattr(posting_lists, "stored", counted)
    x = np.random.default_rng(6).normal(size=(4_000, 8)).astype(np.float32)
    rows = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id bigint, embedding array<float>")
    found = nearest(rows, list_size=32, ratio=100.0).collect()  # every list is read
    v = x.astype(float)
    for q in range(0, 4_000, 20):
        best = [int(i) for i in np.lexsort((np.arange(4_000), -(v @ v[q]))) if i != q][:20]
        assert [r["vec_id"] for r in sorted((r for r in found if r["query_id"] == q), key=lambda r: r["rank"])] == best
    assert sum(made) < 200 * 600


def test_the_fit_needs_little_memory_beside_its_rows():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(20_000, 100))
    y = (rng.random(20_000) < 1 / (1 + np.exp(-x[:, 0]))).astype(float)
    tracemalloc.start()
    w = logistic(x, y, np.ones(len(x)), 1.0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    p = 1 / (1 + np.exp(-(x @ w[:-1] + w[-1])))
    assert abs(w[0] - 1) < 0.1 and np.abs(x.T @ (y - p) - w[:-1]).max() < 1e-3
    assert peak < x.nbytes / 2


def test_words_are_stored_once_a_batch_and_packs_are_given_back(spark, monkeypatch):
    """Disk of the scores: one row for each word of a batch, however Arrow cuts the texts, and no windows after training."""
    kept, made = lm_scores.stored, {}

    def counted(df, label, *more):
        rows = kept(df, label, *more)
        made[label] = rows.count()
        return rows

    paths = []
    monkeypatch.setattr(lm_scores, "stored", counted)
    place = lm_scores.scratch
    monkeypatch.setattr(lm_scores, "scratch", lambda *a: paths.append(place(*a)) or paths[-1])
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        texts = [f"alpha beta gamma {'odd' if i % 2 else 'even'}" for i in range(200)]
        rows = scored(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), steps=5).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len(rows) == 200 and all(r["n_known"] == 5 for r in rows)
    assert made["lm-words"] <= 2 * 6  # two batches, five words and the end
    assert len(paths) == 1 and spark.read.schema("key bigint").parquet(paths[0]).count() == 0


def test_pieces_of_many_texts_are_those_of_each_word():
    with open(VOCABULARY, "rb") as file:
        coder = lm_scores.words(file.read())
    texts = [["the", "of", "the"], [], ["unthinkable", "x" * 150, "the"], ["x" * 150]]
    ids, begins, first, starts = lm_scores._laid(texts, coder)
    plain = [[*(coder.ids(w).tolist() for w in t), [END]] for t in texts]
    assert ids.tolist() == [i for t in plain for w in t for i in w]
    assert np.split(ids, begins[1:])[5].tolist() == plain[2][0]
    assert first.tolist() == [0, 4, 5, 9] and starts.tolist() == begins[first].tolist()


def test_words_are_split_as_by_the_pattern():
    pattern, lower = re.compile(WORD), str.maketrans({c: c.lower() for c in string.ascii_uppercase})
    parts = ["A", "É", "İ", "b.", " ", "\t", "\r\n", "\x0b", "\x1c", "\x1f", "\x85", "\xa0", "\u2003", "\u3000", "\ud800", "\udc00", "漢"]
    rng = np.random.default_rng(4)
    for n in rng.integers(0, 12, 2000):
        text = "".join(rng.choice(parts, n))
        assert words_of(text) == pattern.findall(text.translate(lower))


def test_pieces_of_odd_words_are_those_of_each_word(monkeypatch):
    """Words that are encoded in one call have the pieces that each has by itself, also where the pattern sees white space in them."""
    with open(VOCABULARY, "rb") as file:
        coder = attention.Words(file.read())
    plain = lambda w: [*coder.coder.encode_ordinary(w)]
    parts = ["the", "ing", "é", "漢", "'s", "'S", "12", "<", "|", "\xa0", "\u2003", "\x85", "\x1c", "\ud800", "x" * 120]
    rng = np.random.default_rng(5)
    for kept in (attention._KEPT, 3):  # with and without what was looked up before
        monkeypatch.setattr(attention, "_KEPT", kept)
        for _ in range(200):
            texts = [["".join(rng.choice(parts, rng.integers(1, 5))) for _ in range(rng.integers(0, 6))] for _ in range(3)]
            ids, begins, first, starts = lm_scores._laid(texts, coder)
            want = [[*p[:-1], p[-1] + attention._LAST] if w is not None else [END] for t in texts for w in [*t, None] for p in [plain(w) if w is not None else []]]
            assert ids.tolist() == [i for w in want for i in w]
            assert begins.tolist() == np.cumsum([0, *map(len, want)])[:-1].tolist() and starts.tolist() == begins[first].tolist()


def test_new_words_are_encoded_in_one_call():
    with open(VOCABULARY, "rb") as file:
        coder = attention.Words(file.read())
    inner, calls = coder.coder, []

    class Counted:
        def __getattr__(self, name):
            return lambda *a, **b: calls.append(name) or getattr(inner, name)(*a, **b)

    coder.coder = Counted()
    lm_scores._laid([[f"word{i}" for i in range(1_000)]] * 3, coder)
    lm_scores._laid([[f"word{i}" for i in range(500, 1_500)]], coder)
    assert len(calls) <= 2


def test_a_training_step_makes_its_tables_once():
    fit = attention.Fit.fresh(np.ones(attention.SIZE))
    x, y = np.zeros((2, 1, WINDOW), np.int64)
    tracemalloc.start()
    fit.step(x, y, x == 0, 1, 10)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.5 * sum(t.nbytes for t in fit.model.p.values())


@pytest.mark.parametrize("width", [7, 8])
def test_a_training_step_is_that_of_its_definition(width):
    """Adam on the mean loss, in single precision, slice by slice as well as at once."""
    rng = np.random.default_rng(8)
    fit = attention.Fit.fresh(np.ones(attention.SIZE), width)
    first, second = ({n: np.zeros_like(v) for n, v in fit.model.p.items()} for _ in range(2))
    for t in (1, 2, 60):
        x, y = rng.integers(0, 4_000, (2, 5, WINDOW))
        use = rng.random((5, WINDOW)) < 0.8
        want = {n: v.copy() for n, v in fit.model.p.items()}
        grads = fit.model.step(x, y, use)[1]
        rate = np.float32(5e-3 * min(1, t / 50) * (1 - 0.9 * t / 100))
        for n, g in grads.items():
            first[n] += 0.1 * (g - first[n])
            second[n] += 0.01 * (g * g - second[n])
            want[n] -= rate * (first[n] / (1 - 0.9**t)) / (np.sqrt(second[n] / (1 - 0.99**t)) + 1e-8)
        fit.step(x, y, use, t, 100)
        assert all(np.array_equal(fit.model.p[n], want[n]) for n in want)
