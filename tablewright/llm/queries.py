"""The registered queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewright.llm.lm_scores import scored
from tablewright.llm.mixing import mixed_sources
from tablewright.llm.order_minhash import fingerprints
from tablewright.llm.pieces import decoded, encoded
from tablewright.llm.posting_lists import nearest
from tablewright.llm.prefix_trie import grafted_trie
from tablewright.llm.quotations import as_messages, linked
from tablewright.llm.repair import damaged, repaired
from tablewright.llm.sentence_spans import without_repeated_spans
from tablewright.llm.site_quality import site_quality
from tablewright.llm.training_order import training_order
from tablewright.llm.url_filter import ALLOW, BLOCK, verdicts
from tablewright.llm.weighted_minhash import near_duplicates

# CRC-32 of the ASCII text in place of {}, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({}, ''), lambda ch: ascii(ch)::BIGINT)),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of session and folder under its name."""

    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql.strip()
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by weights 1, 2, 3 over their sources."""
    return mixed_sources(table(spark, sf_dir, "documents")).drop("runs")


@query()
def op1_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token ids in shards of fixed-size records, in an order drawn by a key."""
    return training_order(table(spark, sf_dir, "documents"))


@query(
    r"""WITH cut AS (
      SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '[^.!?\n]*[.!?\n]+[ \t\n\x0b\x0c\r]*|[^.!?\n]+') AS raw
      FROM documents),
    unit AS (SELECT doc_id, unnest(raw) AS raw, generate_subscripts(raw, 1) AS i FROM cut),
    plain AS (
      SELECT doc_id, i, raw,
        trim(regexp_replace(lower(raw), '[ \t\n\x0b\x0c\r]+', ' ', 'g')) AS said,
        len(regexp_extract_all(raw, '[^ \t\n\x0b\x0c\r]+')) AS words
      FROM unit),
    sums AS (
      SELECT *, sum(words) OVER w AS upto, count(*) OVER (PARTITION BY doc_id) AS size
      FROM plain WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING)),
    ends AS (SELECT doc_id, upto, min(i) AS i FROM sums GROUP BY doc_id, upto),
    wide AS (
      SELECT s.doc_id, s.i, s.size, greatest(e.i, s.i + 1) AS stop
      FROM sums s ASOF JOIN ends e ON s.doc_id = e.doc_id AND s.upto - s.words + 16 <= e.upto),
    steps AS (SELECT doc_id, i, unnest(range(i, stop + 1)) AS k FROM wide WHERE stop <= size),
    runs AS (
      SELECT s.doc_id, s.i, count(*) AS n, string_agg(said, chr(10) ORDER BY k) AS run
      FROM steps s JOIN plain p ON s.doc_id = p.doc_id AND k = p.i GROUP BY s.doc_id, s.i
      UNION ALL SELECT doc_id, i, 1, said FROM plain WHERE words >= 20),
    placed AS (
      SELECT *, min(doc_id) OVER (PARTITION BY n, run) AS first, min(i) OVER (PARTITION BY n, run, doc_id) AS first_i
      FROM runs),
    covered AS (
      SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS i FROM placed WHERE doc_id <> first OR i <> first_i),
    kept AS (
      SELECT p.doc_id, count(*) AS n_sentences, count(c.i) AS n_removed,
        coalesce(string_agg(p.raw, '' ORDER BY p.i) FILTER (WHERE c.i IS NULL), '') AS text
      FROM plain p LEFT JOIN covered c ON p.doc_id = c.doc_id AND p.i = c.i GROUP BY p.doc_id)
    SELECT d.doc_id, coalesce(n_sentences, 0) AS n_sentences, coalesce(n_removed, 0) AS n_removed,
      length(coalesce(k.text, d.text)) AS kept_chars, md5(coalesce(k.text, d.text)) AS kept_md5
    FROM documents d LEFT JOIN kept k USING (doc_id)"""
)
def op6_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without sentences in a run of sentences that stood before."""
    kept = without_repeated_spans(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_sentences", "n_removed", F.char_length("text").alias("kept_chars"), F.md5("text").alias("kept_md5")
    )


@query()
def op10_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their class of copies and their group of near-duplicates."""
    return near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op9_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their evidence, their site's rates and whether they are rejected.

    There is no URL in the table: ``source`` stands in for the host and ``lang`` for the path.
    """
    return site_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("version")


@query()
def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as SentencePiece ids and back: digests of the ids and of the text that comes back."""
    rows = encoded(table(spark, sf_dir, "documents").select("doc_id", "text"), packed=True)
    rows = decoded(rows.select("doc_id", F.md5("text").alias("text_md5"), "piece_ids"))
    return rows.select(
        "doc_id", F.expr("octet_length(piece_ids) div 2").alias("n_pieces"), F.md5("piece_ids").alias("ids_md5"),
        F.md5("decoded").alias("decoded_md5"), F.md5("decoded").eqNullSafe(F.col("text_md5")).alias("restored"),
    )


@query()
def op4_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest other vectors of each vector whose id is divisible by 20."""
    return nearest(table(spark, sf_dir, "embeddings"))


@query()
def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, of their edited texts, and how alike these are."""
    return fingerprints(table(spark, sf_dir, "documents"))


@query(
    r"""WITH RECURSIVE turns AS (
      SELECT conv_id, turn, coalesce(max(text), '') AS text,
        nullif(trim(regexp_replace(lower(coalesce(max(text), '')), '[ \t\n\x0b\x0c\r]+', ' ', 'g')), '') AS plain
      FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY conv_id, turn),
    m AS (
      SELECT a.conv_id * 1048576 + a.turn AS id, a.text, a.plain AS own, b.plain AS first, c.plain AS second
      FROM turns a LEFT JOIN turns b ON a.conv_id = b.conv_id AND a.turn = b.turn + 1
        LEFT JOIN turns c ON a.conv_id = c.conv_id AND a.turn = c.turn + 2),
    offers AS (SELECT own, first, min(id) AS parent FROM m WHERE own IS NOT NULL GROUP BY own, first),
    links AS (
      SELECT m.id, m.text, parent FROM m LEFT JOIN offers o ON m.first = o.own AND m.second IS NOT DISTINCT FROM o.first),
    tree AS (
      SELECT id, id AS root, 0 AS depth FROM links WHERE parent IS NULL
      UNION ALL SELECT l.id, t.root, t.depth + 1 FROM links l JOIN tree t ON l.parent = t.id)
    SELECT id AS message_id, parent AS parent_id, root AS root_id, depth,
      row_number() OVER (PARTITION BY root ORDER BY depth, id) - 1 AS position,
      md5(trim(text, chr(10) || chr(9) || chr(13) || ' ')) AS text_md5
    FROM links JOIN tree USING (id)"""
)
def op8_quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All turns, written as mail with nested quotes, linked and ordered again without quotes."""
    found = linked(as_messages(table(spark, sf_dir, "conversations")))
    return found.select("message_id", "parent_id", "root_id", "depth", "position", F.md5("text").alias("text_md5"))


@query()
def op3_attention_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of all documents by the attention model, beside those of word counts."""
    return scored(table(spark, sf_dir, "documents"))


@query(
    r"""WITH t AS (
      SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
      FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
    plan AS (
      SELECT conv_id, n, conv_id - conv_id % 100 AS base, ({crc}) % 6 AS h
      FROM (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id)),
    built AS (
      SELECT p.conv_id, t.i AS d, role, text FROM plan p JOIN t ON t.conv_id = p.base AND t.i <= p.h
      UNION ALL
      SELECT p.conv_id, least(p.h, coalesce(b.n, 0)) + t.i - p.h, role, text
      FROM plan p JOIN t ON t.conv_id = p.conv_id AND t.i > p.h LEFT JOIN plan b ON b.conv_id = p.base),
    path AS (
      SELECT conv_id, d, length(text) AS chars,
        string_agg(md5(length(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY d) AS node
      FROM built
      UNION ALL SELECT conv_id, 0, 0, '' FROM plan),
    step AS (
      SELECT *, lag(node) OVER w AS parent, lead(node) OVER w IS NULL AS ends FROM path WINDOW w AS (PARTITION BY conv_id ORDER BY d)),
    nodes AS (
      SELECT node, min(conv_id) AS conv_id, any_value(d) AS depth, any_value(parent) AS parent, count(*) AS n_convs,
        any_value(chars) AS chars, coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ends
      FROM step GROUP BY node),
    kids AS (SELECT parent, count(*) AS n FROM nodes GROUP BY parent),
    whole AS (SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN kids k ON k.parent = n.node),
    sums AS (
      SELECT p.node, sum((w.n_convs - 1) * w.chars) AS saved, count(*) FILTER (WHERE w.n_children = 0) AS leaves
      FROM whole w JOIN path p ON p.conv_id = w.conv_id AND p.d <= w.depth GROUP BY p.node)
    SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, leaves AS n_leaves,
      saved::BIGINT AS saved_tokens, sha256(w.ends) AS ends_sha256
    FROM whole w LEFT JOIN nodes p ON p.node = w.parent JOIN sums s ON s.node = w.node""".replace("{crc}", _CRC32.format("conv_id::VARCHAR"))
)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, rebuilt on the first turns of their block's first one."""
    return grafted_trie(table(spark, sf_dir, "conversations"))


def _edit(state: str, cost: str, initial: str, out: str = "''") -> str:
    return f"{{'c': ({state}).c + {cost}, 'a': ({state}).a || '{initial}', 'o': ({state}).o || {out}}}"


def _least(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


_INSERTED_USER = _least("x2", *[_edit(x, "2", "I", "chr(10) || 'user:'") for x in ("x0", "x1", "x3")])
_FAR = "{'c': 1000000000::BIGINT, 'a': '', 'o': ''}"
_KEPT = lambda state, initial: _edit(state, f"(CASE WHEN NOT gone AND initial = '{initial}' THEN late ELSE 1000000000 END)", "K", "row")
_REROLED = lambda state, role: _edit(state, "(CASE WHEN gone THEN 1000000000 ELSE 2 + late END)", "R", f"chr(10) || '{role}:' || text")


@query(
    rf"""WITH RECURSIVE struck AS (
      SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, ({_CRC32.format("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")}) % 20 AS kind
      FROM conversations),
    damaged AS (
      SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
      FROM struck WHERE kind <> 0),
    ordered AS (
      SELECT coalesce('=' || conv_id, '') AS conv, turn, role, text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
    faulty AS (
      SELECT *, left(role, 1) AS initial, NOT regexp_matches(text, '[^ 	-
]') AS blank,
        row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 AS again,
        right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) NOT IN ('.', '!', '?') AS open,
        lag(left(role, 1)) OVER (PARTITION BY conv ORDER BY i) || left(role, 1) NOT IN ('su', 'ua', 'au') AS illegal
      FROM ordered),
    rows AS (
      SELECT *, blank OR again AS gone, (NOT blank AND NOT again AND open)::BIGINT AS late, chr(10) || role || ':' || text AS row FROM faulty),
    stats AS (
      SELECT conv, coalesce(max(turn) - min(turn) + 1, 0) - count(DISTINCT turn) AS gaps, count(*) FILTER (WHERE blank) AS blank,
        count(*) FILTER (WHERE again AND NOT blank) AS duplicate, sum(late) AS truncated, count(*) FILTER (WHERE illegal) AS illegal, count(*) AS n
      FROM rows GROUP BY conv),
    walk AS (
      SELECT conv, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 'o': ''}} AS x0, {_FAR} AS x1, {_FAR} AS x2, {_FAR} AS x3 FROM stats
      UNION ALL
      SELECT conv, i, {_edit("x0", "3", "D")}, {_least(_edit("x1", "3", "D"), _KEPT("x0", "s"))},
        {_least(_edit("y2", "3", "D"), *[_KEPT(x, "u") for x in ("x0", "x1", "y3")], *[_REROLED(x, "user") for x in ("x0", "x1", "y3")])},
        {_least(_edit("y3", "3", "D"), _KEPT("y2", "a"), _REROLED("y2", "assistant"))}
      FROM (SELECT *, {_least("x3", _edit("y2", "2", "I", "chr(10) || 'assistant:'"))} AS y3
        FROM (SELECT r.conv, r.i, initial, gone, late, row, text, x0, x1, x3, {_INSERTED_USER} AS y2
          FROM walk w JOIN rows r ON r.conv = w.conv AND r.i = w.i + 1))),
    done AS (
      SELECT conv, {_least("x0", "x3", _edit(f"({_INSERTED_USER})", "2", "I", "chr(10) || 'assistant:'"))} AS best
      FROM walk JOIN stats USING (conv) WHERE i = n)
    SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
      coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit,
      sha256(coalesce(best.o[2:], '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id, coalesce('=' || conv_id, '') AS conv FROM conversations) LEFT JOIN stats USING (conv) LEFT JOIN done USING (conv)"""
)
def op13_lattice_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged by a hash of each turn, with their faults and cheapest repair."""
    rows = table(spark, sf_dir, "conversations")
    return repaired(damaged(rows), rows)


# Verdict, host and path of each rule.
URL_RULES = [
    (ALLOW, "org", "/"), (BLOCK, "example.org", "/es/"), (BLOCK, "example.org", "/en/1"), (ALLOW, "com", "/fr/"), (BLOCK, "com", "/de/"),
]


@query()
def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All page URLs with the rule that decides them, or the verdict of boosted trees."""
    return verdicts(table(spark, sf_dir, "pages"), URL_RULES)
