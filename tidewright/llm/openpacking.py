"""Packing of token ids into sequences of a fixed length, online and in bounded space.

Each partition keeps a fixed number of open windows. A document goes whole into the tightest window that holds it. If none
does, the fullest is filled up with its head and emitted, and the rest of the document goes on with one window more that is
empty. What is left open at the end is merged: the windows of all partitions are laid end to end and cut anew.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tidewright.llm.common import batch, map_batches, small_batches
from tidewright.session import materialise

#: Tokens of a sequence, id after a document, open windows of a partition.
ROOM, END, OPEN = 4096, 2, 64
#: Stretches of text between blanks whose ids a worker remembers; then it forgets all.
REMEMBERED = 1 << 20
#: Sequences of merged windows are numbered from here.
MERGED = 1 << 62


#: A point or comma at the end of a word; it is a token of its own whatever stands before it.
_STOP = "([a-z0-9\u00df-\u00f6\u00f8-\u00ff])([.,;:!?])([ \n])"
#: Marks that combine with the letter before them: not every capital has a composed form where its small letter has one.
#: The strings of special tokens are told apart by case.
_ASIDE = "[\u0300-\u036f]|<\\|"
#: Words that normalisation and splitting leave as they are.
_PLAIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+").fullmatch


@lru_cache(maxsize=2)
def _encoder(vocabulary: str, whole: bool) -> Encoder:
    """One encoder of a worker, which goes on with what it remembers from task to task."""
    return Encoder(vocabulary, whole)


class Encoder:
    """Token ids of whole texts.

    The tokenizer lowers capitals, drops blanks and never joins a word with a point after it, so a text has the ids of its
    stretches between blanks, one after the other. Each stretch is encoded once and looked up from then on. ``whole``
    encodes texts as they are, for tokenizers with other rules.
    """

    def __init__(self, vocabulary: str, whole: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a worker for each core
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer, self.whole = Tokenizer.from_str(vocabulary), whole
        if not whole:
            self.words = Tokenizer.from_str(vocabulary)
            self.words.normalizer = normalizers.Sequence([])
            self.words.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.begin = np.zeros(1 << 16, np.int64)
        self.used = 0

    @staticmethod
    def _ids(tokenizer, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, stretches: list[str]) -> None:
        plain = [bool(_PLAIN(s)) for s in stretches]
        stretches = [*compress(stretches, plain), *(s for s, p in zip(stretches, plain, strict=True) if not p)]
        found = self._ids(self.words, stretches[: sum(plain)]) + self._ids(self.tokenizer, stretches[sum(plain) :])
        known = len(self.place)
        ends = self.used + np.cumsum([len(ids) for ids in found])
        if ends[-1] > len(self.flat):
            self.flat = np.resize(self.flat, 2 * ends[-1])
        if known + len(found) + 1 > len(self.begin):
            self.begin = np.resize(self.begin, 2 * (known + len(found) + 1))
        self.flat[self.used : ends[-1]] = list(chain.from_iterable(found))
        self.begin[known + 1 : known + 1 + len(found)] = ends
        self.used = int(ends[-1])
        self.place.update(zip(stretches, range(known, known + len(found)), strict=True))

    @staticmethod
    def stretches(texts: pa.Array) -> pa.ListArray:
        """The stretches of each text, with A to Z lowered and points set apart where that changes no token."""
        lowered = pc.replace_substring_regex(pc.ascii_lower(texts), _STOP, r"\1 \2\3")
        aside = pc.match_substring_regex(texts, _ASIDE)
        texts = pc.if_else(aside, texts, lowered) if pc.any(aside).as_py() else lowered
        return pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")

    def __call__(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text."""
        texts = pc.fill_null(texts, "")
        if self.whole or not len(texts):
            for text in texts.to_pylist():
                yield np.array(self._ids(self.tokenizer, [text])[0], np.uint32)
            return
        parts = self.stretches(texts)
        ends = np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False))
        coded = parts.flatten().dictionary_encode()
        different = coded.dictionary.to_pylist()
        found = list(map(self.place.get, different))
        if None in found:
            new = [p for p, at in zip(different, found, strict=True) if at is None]
            if len(self.place) + len(new) > REMEMBERED and self.place:
                self.forget()
                new = different
            self.learn(new)
            found = list(map(self.place.__getitem__, different))
        at = np.array(found, np.int64)[coded.indices.to_numpy()]
        first, sizes = self.begin[at], self.begin[at + 1] - self.begin[at]
        cut = np.cumsum(sizes)
        ids = self.flat[np.repeat(first - cut + sizes, sizes) + np.arange(cut[-1])]
        edges = cut[ends - 1].tolist()
        for a, b in zip([0, *edges[:-1]], edges, strict=True):
            yield ids[a:b]


def checksum(ids: np.ndarray) -> int:
    """crc32 of the ids as little-endian unsigned 32-bit numbers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


class OpenWindows:
    """The open windows of one partition; ``add`` gives the pieces of sequences that are full, ``rest`` those of the others.

    A piece is (document, start, ids, tokens of the document, sequence, offset).
    """

    def __init__(self, room: int = ROOM, open_windows: int = OPEN):
        self.room, self.used, self.held = room, [0] * open_windows, [[] for _ in range(open_windows)]
        self.sequences = 0

    def _emit(self, pieces: list[tuple]) -> list[tuple]:
        offset, out = 0, []
        for doc, start, ids, tokens in pieces:
            out.append((doc, start, ids, tokens, self.sequences, offset))
            offset += len(ids)
        self.sequences += 1
        return out

    def add(self, doc, ids: np.ndarray) -> list[tuple]:
        tokens, start, out = len(ids), 0, []
        while tokens - start >= self.room:
            out += self._emit([(doc, start, ids[start : start + self.room], tokens)])
            start += self.room
        while start < tokens:
            size, used = tokens - start, self.used
            at = max(range(len(used)), key=lambda w: used[w] if used[w] + size <= self.room else -1)
            if used[at] + size > self.room:
                at = max(range(len(used)), key=used.__getitem__)
                size = self.room - used[at]
            self.held[at].append((doc, start, ids[start : start + size].copy(), tokens))
            used[at] += size
            start += size
            if used[at] == self.room:
                out += self._emit(self.held[at])
                used[at], self.held[at] = 0, []
        return out

    def rest(self) -> list[tuple]:
        return [piece for pieces in self.held for piece in pieces]


def tail(total: int, room: int = ROOM) -> list[int]:
    """Where merged windows are cut after the last multiple of ``room``: at powers of two, so that no sequence is padded."""
    return list(accumulate((1 << b for b in range(room.bit_length(), -1, -1) if total % room >> b & 1), initial=total - total % room))


def pack(documents: DataFrame, vocabulary: str, room: int = ROOM, open_windows: int = OPEN, end: int = END, key: str = "doc_id", text: str = "text", whole: bool = False) -> DataFrame:
    """``key``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset`` and ``ids`` (null unless merged) of every piece.

    ``vocabulary`` is the path of a tokenizer file, read once by the driver. A null or empty text is the id ``end`` alone.
    Rows of one key are documents of their own, a null key is a key; other columns are not looked at. An empty table gives
    an empty result. A task holds a batch of texts and ``open_windows`` sequences, whatever the rows; no row is shuffled but
    those of open windows, at most ``open_windows`` sequences of a partition. Their totals, a number of each partition, go through
    the driver. All sequences have ``room`` ids but those of the last merged ones, whose lengths are powers of two.
    """
    spark = documents.sparkSession
    small_batches(spark)
    with open(vocabulary, encoding="utf-8") as file:
        shared = spark.sparkContext.broadcast(file.read())
    kind = documents.schema[key].dataType.simpleString()
    schema = T.StructType.fromDDL(f"key {kind}, start long, ids_crc32 long, length long, doc_tokens long, sequence_id long, offset long, part int, place long, ids binary")
    rows = documents.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))

    def run(parts):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoder, windows, last = _encoder(shared.value, whole), OpenWindows(room, open_windows), np.array([end], np.uint32)

        def columns(pieces, merged):
            docs, starts, ids, tokens, sequences, offsets = zip(*pieces, strict=True)
            n = len(pieces)
            return batch(schema, [
                pa.array(docs, schema_key), list(starts), [checksum(i) for i in ids], [len(i) for i in ids], list(tokens), [(part << 32) + s for s in sequences], list(offsets),
                [part] * n, list(range(n)), [i.astype("<u4").tobytes() for i in ids] if merged else [None] * n,
            ])

        schema_key = batch(schema, [pa.nulls(0)] + [[]] * 9).schema.field(0).type
        for rows in parts:
            full = []
            for doc, ids in zip(rows.column(0).to_pylist(), encoder(rows.column(1)), strict=True):
                full += windows.add(doc, np.concatenate([ids, last]))
                if len(full) >= 1 << 14:
                    yield columns(full, False)
                    full = []
            if full:
                yield columns(full, False)
        if left := windows.rest():
            yield columns([(*piece, 0, 0) for piece in left], True)

    packed = materialise(rows.mapInArrow(run, schema), "pieces")
    left = packed.where("ids is not null")
    totals = left.groupBy("part").agg(F.sum("length").alias("n")).orderBy("part").collect()
    ends = list(accumulate([r["n"] for r in totals], initial=0))
    base = spark.createDataFrame([(r["part"], b) for r, b in zip(totals, ends, strict=False)], "part int, base long")
    before = F.sum("length").over(Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1))
    left = left.withColumn("before", F.coalesce(before, F.lit(0))).join(F.broadcast(base), "part")
    left = left.select("key", "start", "doc_tokens", (F.col("base") + F.col("before")).alias("at"), "ids")
    edges = tail(ends[-1], room)

    def cut(part):
        out = [[] for _ in range(8)]
        for doc, start, tokens, at, raw in zip(*(c.to_pylist() for c in part.columns), strict=True):
            ids = np.frombuffer(raw, "<u4")
            done = 0
            while done < len(ids):
                now = at + done
                if now < edges[0]:
                    number = now // room
                    begin, stop = number * room, (number + 1) * room
                else:
                    i = bisect_right(edges, now)
                    number, begin, stop = edges[0] // room + i - 1, edges[i - 1], edges[i]
                size = min(stop - now, len(ids) - done)
                piece = ids[done : done + size]
                for column, value in zip(out, (doc, start + done, size, checksum(piece), tokens, MERGED + number, now - begin, piece.tobytes()), strict=True):
                    column.append(value)
                done += size
        yield out

    final = ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    merged = map_batches(left, cut, f"key {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary")
    return packed.where("ids is null").select(*final).union(merged.select(*final)).withColumnRenamed("key", key)
