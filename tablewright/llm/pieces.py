"""SentencePiece ids by Viterbi over the matches of an Aho-Corasick automaton, and back to text."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tablewright.llm.common import release, tidied

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
# The sign that stands for a space, and how far below all pieces a character without one is.
_SPACE = "▁"
_UNKNOWN = 10.0
_CHUNK = re.compile(f"\n|{_SPACE}| *[^ \n{_SPACE}]+| +")
_CACHE, _LONGEST = 400_000, 64
_CODERS: dict[int, Pieces] = {}


class Pieces:
    """Pieces of a model with their scores; the best segmentation has the largest sum of scores."""

    def __init__(self, model: bytes):
        given = sentencepiece.SentencePieceProcessor()
        given.load_from_serialized_proto(model)
        self.automaton = ahocorasick.Automaton()
        self.bytes: dict[int, int] = {}
        self.plain: list[bytes] = []
        self.kind = np.uint16 if given.get_piece_size() <= 2**16 else np.uint32
        lowest, crossing = 0.0, False
        for i in range(given.get_piece_size()):
            piece = given.id_to_piece(i)
            if given.is_byte(i):
                value = int(piece[3:5], 16)
                self.bytes[value] = i
                self.plain.append(bytes([value]))
            elif given.is_control(i) or given.is_unknown(i) or given.is_unused(i):
                self.plain.append(b"")
            else:
                score = given.get_score(i)
                self.automaton.add_word(piece, (len(piece), score, i))
                self.plain.append(piece.replace(_SPACE, " ").encode())
                lowest = min(lowest, score)
                crossing |= "\n" in piece or _SPACE in piece.lstrip(_SPACE)
        self.automaton.make_automaton()
        self.lowest = lowest - _UNKNOWN
        # Where no piece goes on over a space after a word, the best way through a text is
        # the best way through each stretch up to there, which can be looked up.
        self.cut = not crossing
        self.cache: dict[str, bytes] = {}

    def best(self, text: str) -> list[int]:
        """Ids of the best way through a text in which spaces are signs.

        One pass: matches come by their end, the longest first and then, over output links,
        the shorter ones; each relaxes the best score of its end. Where no piece is just the
        character that ends there, its bytes are one more way. Of equal scores the longer last piece stays.
        """
        n, lowest = len(text), self.lowest
        score, back = [0.0] + [-np.inf] * n, [(0, 0)] * (n + 1)
        at, alone = 0, False

        def spell() -> None:
            if not alone and score[at] + lowest > score[at + 1]:
                score[at + 1], back[at + 1] = score[at] + lowest, (at, -1)

        for end, (length, gain, piece) in self.automaton.iter(text):
            while at < end:
                spell()
                at, alone = at + 1, False
            start = end + 1 - length
            if score[start] + gain > score[end + 1]:
                score[end + 1], back[end + 1] = score[start] + gain, (start, piece)
            alone |= length == 1
        while at < n:
            spell()
            at, alone = at + 1, False
        out: list[int] = []
        while n:
            start, piece = back[n]
            out += [piece] if piece >= 0 else [self.bytes[b] for b in reversed(text[start:n].encode())]
            n = start
        return out[::-1]

    def _chunk(self, chunk: str) -> bytes:
        ids = [self.bytes[b] for b in chunk.encode()] if chunk == _SPACE else self.best(chunk.replace(" ", _SPACE))
        return np.array(ids, self.kind).tobytes()

    def encode(self, text: str | None) -> bytes:
        """Packed ids. A space is put before the text, as these models want it; the space sign itself is spelled."""
        if not text:
            return b""
        chunks, cache = _CHUNK.findall(" " + text), self.cache
        if not self.cut:
            chunks = re.findall(f"{_SPACE}|[^{_SPACE}]+", " " + text)
        if len(cache) > _CACHE:
            cache.clear()
        for chunk in set(chunks):
            if chunk not in cache and len(chunk) <= _LONGEST:
                cache[chunk] = self._chunk(chunk)
        return b"".join([cache[c] if c in cache else self._chunk(c) for c in chunks])

    def decode(self, ids: bytes) -> str:
        plain = self.plain
        return b"".join([plain[i] for i in np.frombuffer(ids, self.kind).tolist()]).decode("utf-8", "replace")[1:]


def pieces(model: bytes) -> Pieces:
    """One for each Python worker."""
    key = hash(model)
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = Pieces(model)
    return _CODERS[key]


def _forget() -> None:
    _CODERS.clear()
    release()


def _shared(spark: SparkSession, model: str):
    with open(model, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encoded(
    docs: DataFrame, text_col: str = "text", ids_col: str = "piece_ids", model: str = MODEL, packed: bool = False
) -> DataFrame:
    """Adds the ids of the best segmentation of each text, in ``ids_col``.

    They are an array, or with ``packed`` a binary of 2 bytes each (4 for models of more
    than 65,536 pieces). Characters without a piece are spelled in bytes. NULL texts have
    NULL, empty ones no ids. A column named ``ids_col`` is replaced, all others are kept.
    """
    shared, docs = _shared(docs.sparkSession, model), docs.drop(ids_col)
    place = docs.columns.index(text_col)
    kind = T.BinaryType() if packed else T.ArrayType(T.IntegerType())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pieces(shared.value)
        for batch in batches:
            begin, held, rows = 0, 0, []
            for i, text in enumerate(batch.column(place)):
                rows.append(coder.encode(text.as_py()) if text.is_valid else None)
                held += len(rows[-1] or b"")
                if held > 16_000_000 or i + 1 == batch.num_rows:
                    ids = rows if packed else [None if r is None else np.frombuffer(r, coder.kind).astype(np.int32) for r in rows]
                    column = pa.array(ids, pa.binary() if packed else pa.list_(pa.int32()))
                    part = batch.slice(begin, i + 1 - begin)
                    yield pa.RecordBatch.from_arrays([*part.columns, column], names=[*part.schema.names, ids_col])
                    begin, held, rows = i + 1, 0, []

    return docs.mapInArrow(tidied(encode, _forget), T.StructType(docs.schema.fields + [T.StructField(ids_col, kind)]))


def decoded(docs: DataFrame, ids_col: str = "piece_ids", text_col: str = "decoded", model: str = MODEL) -> DataFrame:
    """Adds the text that ids, an array or packed, stand for. NULL gives NULL; bytes that are no UTF-8 give U+FFFD.

    What ``encoded`` made comes back exactly. A column named ``text_col`` is replaced.
    """
    shared, docs = _shared(docs.sparkSession, model), docs.drop(text_col)
    place = docs.columns.index(ids_col)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pieces(shared.value)
        for batch in batches:
            texts = []
            for ids in batch.column(place):
                value = ids.as_py()
                if value is not None and not isinstance(value, bytes):
                    value = np.array(value, coder.kind).tobytes()
                texts.append(None if value is None else coder.decode(value))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, text_col])

    return docs.mapInArrow(tidied(decode, _forget), T.StructType(docs.schema.fields + [T.StructField(text_col, T.StringType())]))
