"""Order MinHash: fingerprints that feel the edit distance, in built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tablewright.llm.common import SPACE, stored
from tablewright.operators.joins import broadcast_join


def signature(text: Column, words: int = 2, together: int = 2, bits: int = 6) -> Column:
    """For each of 2^bits hash ranges that a text reaches, the range and the hash of a tuple.

    The text's runs of ``words`` words are numbered by occurrence, and each run with its
    number gets one hash; this is the form of the method with one hash whose values are parted
    into ranges instead of many hashes. A range takes its minimal hash and the ones that follow in hash
    order, ``together`` in all, beyond the range where it holds fewer. These stand in the
    tuple in the order in which the text has them, so that moved parts change it.

    A text of fewer words is one run. NULL counts as empty; an empty text has no ranges.
    """
    held = F.filter(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), lambda w: w != "")

    def runs(w: Column) -> Column:
        last = F.greatest(F.size(w) - words, F.lit(0))
        one = lambda i: F.struct(F.xxhash64(*[F.get(w, i + j) for j in range(words)]).alias("h"), i.alias("i"))
        return F.when(F.size(w) > 0, F.sort_array(F.transform(F.sequence(F.lit(0), last), one)))

    def numbered(s: Column) -> Column:
        # Equal runs are neighbours. The first keeps its hash, the others get one with their number.
        def number(values: Column) -> Column:
            def one(x: Column, j: Column) -> Column:
                before = j - F.array_position(values, x["h"]).cast("int") + 1
                v = F.when((j > 0) & (F.get(values, j - 1) == x["h"]), F.xxhash64(x["h"], before)).otherwise(x["h"])
                return F.struct(v.alias("v"), x["i"].alias("i"))

            return F.sort_array(F.transform(s, one))

        return _let(F.transform(s, lambda x: x["h"]), number)

    def tuples(v: Column) -> Column:
        n = F.size(v)
        range_of = lambda j: F.shiftright(F.get(v, j)["v"], 64 - bits)
        heads = F.filter(F.sequence(F.lit(0), n - 1), lambda j: (j == 0) | (range_of(j) != range_of(j - 1)))

        def mark(j: Column) -> Column:
            members = F.transform(
                F.sequence(F.lit(0), F.least(F.lit(together), n) - 1),
                lambda d: F.struct(F.get(v, (j + d) % n)["i"].alias("i"), F.get(v, (j + d) % n)["v"].alias("v")),
            )
            return F.struct(
                range_of(j).alias("at"), F.xxhash64(F.transform(F.sort_array(members), lambda m: m["v"])).alias("tuple")
            )

        return F.transform(heads, mark)

    found = _let(held, lambda w: _let(runs(w), lambda s: _let(numbered(s), tuples)))
    return F.coalesce(found, F.expr("cast(array() as array<struct<at:bigint,tuple:bigint>>)"))


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times. NULL gives NULL."""
    return F.get(F.transform(F.filter(F.array(value), lambda x: x.isNotNull()), body), F.lit(0))


def likeness(a: Column, b: Column) -> Column:
    """Share of the ranges of either signature in which both have the same tuple; 1 for two without ranges."""
    ranges = F.size(F.array_union(F.transform(a, lambda x: x["at"]), F.transform(b, lambda x: x["at"])))
    return F.when(ranges == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / ranges)


def shown(signature: Column) -> Column:
    """A signature as text, hexadecimal."""
    return F.concat_ws(".", F.transform(signature, lambda x: F.concat(F.hex(x["at"] + 128), F.lit(":"), F.hex(x["tuple"]))))


def _bounds(keys: DataFrame, columns: list[str]) -> list:
    """The first keys of ranges that hold about as many keys each, two for each shuffle partition.

    Keys are far smaller than the rows they stand for; a number that is asked for is not cut down to their size.
    """
    n = 2 * int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = keys.select(*columns).repartitionByRange(n, *columns).withColumn("task", F.spark_partition_id())
    return [r["first"] for r in parts.groupBy("task").agg(F.min(F.struct(*columns)).alias("first")).orderBy("first").collect()]


def with_next(once: DataFrame, keys: DataFrame, columns: list[str], values: list[str], made: dict[str, Column]) -> DataFrame:
    """Rows with ``values`` of the row that follows in the order of ``columns`` as ``next_...``; after the last comes the first.

    Rows are dealt to ranges of keys, once. The first row of a range goes to the range before as well, where
    it stands last and is dropped again. ``made`` is computed between the shuffle and the look ahead.
    """
    firsts = _bounds(keys, columns)
    if not firsts:
        return once.withColumns(made).withColumns({f"next_{v}": F.col(v) for v in values}).limit(0)
    spark = once.sparkSession
    kind = keys.select(F.array(F.struct(*columns)).alias("firsts")).schema
    bounds = spark.createDataFrame([(firsts,)], kind).scalar()  # one value
    key, n = F.struct(*columns), len(firsts)
    # Two short searches, for a block and then inside it, instead of a long one.
    width = max(1, int(n**0.5))
    upto = lambda found: F.size(F.filter(found, lambda f: f <= key))
    heads = F.transform(F.sequence(F.lit(0), F.lit((n - 1) // width)), lambda i: F.get("firsts", i * width))
    rows = once.withColumn("firsts", bounds).withColumn("block", (upto(heads) - 1) * width)
    rows = rows.withColumn("range", F.col("block") + upto(F.slice("firsts", F.col("block") + 1, F.lit(width))) - 1)
    before = F.struct(F.pmod(F.col("range") - 1, F.lit(n)).alias("range"), F.lit(True).alias("extra"))
    own = F.struct(F.col("range"), F.lit(False).alias("extra"))
    places = F.when(F.get("firsts", F.col("range")) == key, F.array(own, before)).otherwise(F.array(own))
    rows = rows.withColumn("place", F.explode(places)).select(*once.columns, "place.range", "place.extra")
    rows = rows.repartition("range").withColumns(made)
    along = Window.partitionBy("range").orderBy("extra", *columns)
    rows = rows.withColumns({f"next_{v}": F.lead(v).over(along) for v in values})
    return rows.filter("not extra").drop("range", "extra")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Each document's fingerprint beside that of its edited text and that of the next document.

    The edited text has its last floor(n/2) of n characters replaced by the first as many
    of the next document, or all of them if that has fewer. Returns ``id_col``, ``n_chars``, ``edited_sha256``,
    ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``.

    Next is the following row by id and then by a hash of the text; NULL ids come first.
    NULL texts count as empty. Repeated rows count as one in this order and have equal
    results. An empty table gives none. Other columns are not looked at. Texts are shuffled once.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    docs = docs.withColumn("version", F.xxhash64("text"))
    keys = stored(docs.groupBy("id", "version").agg(F.count("*").alias("copies")), "fingerprint-keys")
    repeated = keys.filter("copies > 1").select(F.col("id").alias("cid"), F.col("version").alias("cversion"), "copies")
    once = docs.withColumn("copies", F.lit(1).cast("bigint"))
    if not repeated.isEmpty():
        same = F.col("id").eqNullSafe(F.col("cid")) & (F.col("version") == F.col("cversion"))
        found = broadcast_join(docs, repeated, same, "left").drop("cid", "cversion")
        several = found.filter("copies is not null").groupBy("id", "version", "copies").agg(F.first("text").alias("text"))
        once = found.filter("copies is null").withColumn("copies", F.lit(1).cast("bigint")).unionByName(several)

    both = with_next(once, keys, ["id", "version"], ["text", "signed"], {"signed": signature(F.col("text"), **options)})
    n = F.char_length("text")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), n - F.floor(n / 2).cast("int")), F.substring(F.col("next_text"), F.lit(1), F.floor(n / 2).cast("int"))
    )
    both = both.select("id", "copies", n.cast("bigint").alias("n_chars"), edited.alias("edited"), "signed", F.col("next_signed"))
    rows = both.withColumn("edited_signed", signature(F.col("edited"), **options)).select(
        F.col("id").alias(id_col), "copies", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), shown(F.col("signed")).alias("fingerprint"),
        shown(F.col("edited_signed")).alias("edited_fingerprint"),
        likeness(F.col("signed"), F.col("edited_signed")).alias("near_edited"),
        likeness(F.col("signed"), F.col("next_signed")).alias("near_next"),
    )
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return rows.drop("copies", "copy")
