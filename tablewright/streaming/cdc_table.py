"""A table kept up to date by a stream of change events in any order.

Below the table's folder, ``pointer`` names the current generation. A generation holds, in
one folder per batch, the ``log`` of all events, an ``index`` of the key range of each of
its files, ``truncates`` with the position up to which everything is forgotten, the rebuilt
``rows`` of the keys that the batch touched, and ``touched`` with these keys and the position
of their last event. A batch counts once its number stands in ``commits``, which is written
last: readers see all of a batch or nothing, and a batch that comes again is skipped or
written anew. Folding writes the table into a new generation, as a single batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tablewright.functions.columns import hashable, holds
from tablewright.operators.joins import BROADCAST_BYTES, measured_bytes, touched_rows

BATCH = "batch_id"
GENERATION = "generation"
_AT, _FILE, _LOW, _HIGH, _ROWS = "__at", "__file", "__low", "__high", "__rows"
#: Beyond so many files, which are replicated, or comparisons of keys with files only the range of all keys is looked at.
_FILES, _COMPARISONS = 100_000, 500_000_000


def _read(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame | None:
    """A table whose schema is known, so that no job has to look for it; None where there is none yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


class CdcTable:
    """The result of a CDC operator over all events that a stream has brought.

    ``rebuild`` turns the events of some keys into their rows. With ``truncate_when`` an
    event empties the table up to its place in the ``sequence``, whenever it arrives: events
    at or before the last such place do not count. Keys are not NULL. The log is sorted by
    key into files of ``rows_per_file`` rows; a batch reads those in whose range one of its keys lies. After
    ``fold_every`` batches the table is folded, and the generation before the last removed.
    """

    def __init__(
        self,
        path: str,
        keys: Sequence[str],
        rebuild: Callable[[DataFrame], DataFrame],
        sequence: str | Sequence[str] | None = None,
        truncate_when: Column | str | None = None,
        rows_per_file: int = 1_000_000,
        fold_every: int = 64,
    ):
        if truncate_when is not None and sequence is None:
            raise ValueError("a truncate needs a place in the sequence")
        self.path, self.keys, self.rebuild = path.rstrip("/"), list(keys), rebuild
        self.parts = [sequence] if isinstance(sequence, str) else list(sequence or [])
        self.truncate_when = truncate_when
        self.rows_per_file, self.fold_every = rows_per_file, fold_every

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """Take in one batch; to be called by ``foreachBatch``, which is the only writer."""
        spark = batch.sparkSession
        folder, reached, taken = self._state(spark)
        if reached is not None and batch_id <= reached:
            return
        events = batch
        if self.truncate_when is not None:
            truncates, events = batch.filter(holds(self.truncate_when)), batch.filter(~holds(self.truncate_when))
            newest = truncates.agg(F.max(self._position()).alias(_AT))
            newest.coalesce(1).write.mode("overwrite").parquet(f"{folder}/truncates/{BATCH}={batch_id}")
        self._write_log(spark, events, folder, batch_id)

        own = spark.read.schema(batch.schema).parquet(f"{folder}/log/{BATCH}={batch_id}")
        truncated = self._truncated(spark, folder, batch_id)
        if reached is None:
            alive = self._alive(own, truncated)
        elif self._emptied(spark, folder, batch_id):
            # What is left of every key has to be built from the events behind the truncate.
            alive = self._alive(self._log(spark, folder, batch_id), truncated)
        else:
            touched = own.select(*self.keys).distinct()
            n, size = touched.count(), measured_bytes(touched)
            alive = self._alive(self._matching(spark, folder, own, touched, n, batch_id), truncated)
            alive = alive.join(F.broadcast(touched) if size <= BROADCAST_BYTES else touched, self.keys, "left_semi")
        self.rebuild(alive).write.mode("overwrite").parquet(f"{folder}/rows/{BATCH}={batch_id}")
        found = alive.groupBy(*self.keys).agg(F.max(self._position()).alias(_AT))
        found.write.mode("overwrite").parquet(f"{folder}/touched/{BATCH}={batch_id}")
        self._commit(spark, folder, batch_id)
        if (taken or 0) + 1 >= self.fold_every:
            self.fold(spark)

    def read(self, spark: SparkSession) -> DataFrame:
        """The table as of the last committed batch."""
        folder, reached, _ = self._state(spark)
        if reached is None:
            raise ValueError(f"{self.path} holds no batch yet")
        return self._current(spark, folder, reached)

    def fold(self, spark: SparkSession) -> None:
        """Write what counts into a new generation and then make that the current one."""
        folder, reached, _ = self._state(spark)
        if reached is None:
            return
        number = int(folder.rsplit("=", 1)[1])
        fresh = f"{self.path}/{GENERATION}={number + 1}"
        truncated = self._truncated(spark, folder, reached)
        self._write_log(spark, self._alive(self._log(spark, folder, reached), truncated), fresh, reached)
        self._current(spark, folder, reached).write.mode("overwrite").parquet(f"{fresh}/rows/{BATCH}={reached}")
        last = self._last_touched(spark, folder, reached).drop(BATCH)
        last.write.mode("overwrite").parquet(f"{fresh}/touched/{BATCH}={reached}")
        if truncated is not None:
            marks = self._upto(spark.read.parquet(f"{folder}/truncates"), reached).agg(F.max(_AT).alias(_AT))
            marks.coalesce(1).write.mode("overwrite").parquet(f"{fresh}/truncates/{BATCH}={reached}")
        self._commit(spark, fresh, reached, "overwrite")
        pointer = spark.range(number + 1, number + 2).withColumnRenamed("id", GENERATION)
        pointer.coalesce(1).write.mode("append").parquet(f"{self.path}/pointer")
        if number:
            _remove(spark, f"{self.path}/{GENERATION}={number - 1}")

    def files_for(self, spark: SparkSession, keys: DataFrame) -> DataFrame:
        """Files of the log, with their rows, in whose key range one of ``keys`` lies."""
        folder, reached, _ = self._state(spark)
        keys = keys.select(*self.keys).distinct()
        return self._files(spark, folder, keys, keys.count(), -1 if reached is None else reached + 1)

    def _state(self, spark: SparkSession) -> tuple[str, int | None, int | None]:
        """The folder of the current generation, the last batch in it and the number of its batches."""
        pointer = _read(spark, f"{self.path}/pointer", f"{GENERATION} bigint")
        number = 0 if pointer is None else pointer.agg(F.max(GENERATION)).first()[0]
        folder = f"{self.path}/{GENERATION}={number}"
        commits = _read(spark, f"{folder}/commits", f"{BATCH} bigint")
        return folder, *((None, None) if commits is None else commits.agg(F.max(BATCH), F.count("*")).first())

    def _commit(self, spark: SparkSession, folder: str, batch_id: int, mode: str = "append") -> None:
        spark.range(batch_id, batch_id + 1).withColumnRenamed("id", BATCH).coalesce(1).write.mode(mode).parquet(f"{folder}/commits")

    def _position(self) -> Column:
        return F.struct(*self.parts) if self.parts else F.lit(None).cast("int")

    def _key(self) -> Column:
        return F.struct(*self.keys)

    def _upto(self, df: DataFrame, batch_id: int) -> DataFrame:
        return df.filter(F.col(BATCH) <= batch_id)

    def _log(self, spark: SparkSession, folder: str, batch_id: int) -> DataFrame:
        return self._upto(spark.read.parquet(f"{folder}/log"), batch_id).drop(BATCH)

    def _write_log(self, spark: SparkSession, events: DataFrame, folder: str, batch_id: int) -> None:
        """Events in key order, and the key range of each file they went to."""
        path = f"{folder}/log/{BATCH}={batch_id}"
        # The hash and the task part a key that holds most of the batch.
        spread = [F.xxhash64(*hashable(events)), F.spark_partition_id()]
        events = events.repartitionByRange(*self.keys, *spread).sortWithinPartitions(*self.keys)
        events.write.mode("overwrite").option("maxRecordsPerFile", self.rows_per_file).parquet(path)
        files = spark.read.schema(events.schema).parquet(path).select(F.col("_metadata.file_name").alias(_FILE), self._key().alias("key"))
        files = files.groupBy(_FILE).agg(F.min("key").alias(_LOW), F.max("key").alias(_HIGH), F.count("*").alias(_ROWS))
        files.coalesce(1).write.mode("overwrite").parquet(f"{folder}/index/{BATCH}={batch_id}")

    def _files(self, spark: SparkSession, folder: str, keys: DataFrame, n_keys: int, batch_id: int) -> DataFrame:
        key = keys.select(self._key().alias("key")).schema["key"].dataType
        schema = T.StructType().add(_FILE, "string").add(_LOW, key).add(_HIGH, key).add(_ROWS, "long").add(BATCH, "long")
        index = _read(spark, f"{folder}/index", schema)
        if index is None:
            return spark.createDataFrame([], schema).select(BATCH, _FILE, _ROWS)
        index = index.filter(F.col(BATCH) < batch_id)
        n_files = index.count()
        if n_files <= _FILES and n_keys * n_files <= _COMPARISONS:
            inside = (self._key() >= F.col(_LOW)) & (self._key() <= F.col(_HIGH))
            return keys.join(F.broadcast(index), inside).select(BATCH, _FILE, _ROWS).distinct()
        low, high = (keys.agg(end(self._key())).scalar() for end in (F.min, F.max))
        return index.filter((F.col(_HIGH) >= low) & (F.col(_LOW) <= high)).select(BATCH, _FILE, _ROWS)

    def _matching(self, spark: SparkSession, folder: str, own: DataFrame, keys: DataFrame, n_keys: int, batch_id: int) -> DataFrame:
        """The batch's own events and the files of the log that may hold its keys."""
        files = [f"{folder}/log/{BATCH}={r[BATCH]}/{r[_FILE]}" for r in self._files(spark, folder, keys, n_keys, batch_id).collect()]
        return own.unionByName(spark.read.schema(own.schema).parquet(*files)) if files else own

    def _truncated(self, spark: SparkSession, folder: str, batch_id: int) -> Column | None:
        """The place of the last truncate, as one value."""
        if self.truncate_when is None:
            return None
        return self._upto(spark.read.parquet(f"{folder}/truncates"), batch_id).agg(F.max(_AT)).scalar()

    def _emptied(self, spark: SparkSession, folder: str, batch_id: int) -> bool:
        """Does the batch truncate further than all batches before it?"""
        if self.truncate_when is None:
            return False
        marks = self._upto(spark.read.parquet(f"{folder}/truncates"), batch_id)
        before, now = (F.max(F.when(F.col(BATCH) == batch_id if own else F.col(BATCH) < batch_id, F.col(_AT))) for own in (False, True))
        return marks.agg(F.coalesce(now > before, now.isNotNull())).first()[0]

    def _alive(self, events: DataFrame, truncated: Column | None) -> DataFrame:
        if truncated is None:
            return events
        return events.filter(truncated.isNull() | (self._position() > truncated))

    def _last_touched(self, spark: SparkSession, folder: str, batch_id: int) -> DataFrame:
        """Of each key the last batch that rebuilt it, without keys that a truncate has removed since."""
        touched = self._upto(spark.read.parquet(f"{folder}/touched"), batch_id)
        last = touched.groupBy(*self.keys).agg(F.max(F.struct(BATCH, _AT)).alias("last"))
        last = last.select(*self.keys, f"last.{BATCH}", f"last.{_AT}")
        truncated = self._truncated(spark, folder, batch_id)
        return last if truncated is None else last.filter(truncated.isNull() | (F.col(_AT) > truncated))

    def _current(self, spark: SparkSession, folder: str, batch_id: int) -> DataFrame:
        rows = self._upto(spark.read.parquet(f"{folder}/rows"), batch_id)
        last = self._last_touched(spark, folder, batch_id).drop(_AT)
        return touched_rows(rows, last, [*self.keys, BATCH]).drop(BATCH)
