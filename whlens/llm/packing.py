"""Bounded-space online packing of documents into fixed-length sequences.

Each task reads its documents once and keeps ``open_windows`` windows. A document
gives its full windows at once; its rest goes to the open window it fills best. If
none has room, the fullest is filled up with the head of the piece and emitted,
and the piece goes on. What stays open at a task's end is merged, first in the
task, then across tasks by one running sum over a row per task.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from whlens.llm.common import arrow_schema, slices, table, text_batches
from whlens.llm.tokens import default_tokenizer, encoder

LENGTH = 4096
OPEN_WINDOWS = 64

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, seq long, offset long, ids binary"
SEQUENCED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Packer:
    """Packs pieces (doc_id, doc_tokens, start, ids) of one task into windows."""

    def __init__(self, length: int, open_windows: int):
        self.length, self.most = length, open_windows
        self.room: list[tuple[int, int]] = []  # (free tokens, window), ascending
        self.windows: dict[int, list] = {}
        self.next, self.closed = 0, []

    def _close(self, pieces: list) -> None:
        self.closed.append(pieces)

    def add(self, key, ids: np.ndarray) -> None:
        total, at = len(ids), 0
        while total - at >= self.length:
            self._close([(key, total, at, ids[at:at + self.length])])
            at += self.length
        while at < total:
            piece = ids[at:]
            i = bisect_left(self.room, (len(piece), -1))
            if i < len(self.room):  # best fit: the least room that suffices
                free, w = self.room.pop(i)
            elif len(self.room) < self.most:
                free, w = self.length, self.next
                self.windows[w], self.next = [], self.next + 1
            else:  # none fits: the fullest takes the head and is emitted
                free, w = self.room.pop(0)
                piece = piece[:free]
            self.windows[w].append((key, total, at, piece))
            at += len(piece)
            if free > len(piece):
                insort(self.room, (free - len(piece), w))
            else:
                self._close(self.windows.pop(w))

    def finish(self) -> list:
        """Merge what is open, fullest windows first; returns the one window left over."""
        held, free = [], self.length
        for _, w in self.room:
            for key, total, start, ids in self.windows[w]:
                while len(ids):
                    held.append((key, total, start, ids[:free]))
                    start, ids, free = start + len(ids[:free]), ids[free:], free - len(ids[:free])
                    if not free:
                        self._close(held)
                        held, free = [], self.length
        self.room, self.windows = [], {}
        return held


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _pieces(docs: DataFrame, tokenizer: str, length: int, open_windows: int) -> DataFrame:
    text_batches(docs.sparkSession)
    schema = arrow_schema(PIECES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, seq = TaskContext.get().partitionId(), 0
        coder, packer = encoder(tokenizer), Packer(length, open_windows)

        def rows(windows: list, left: bool) -> pa.RecordBatch:
            nonlocal seq
            out = []
            for pieces in windows:
                offset = 0
                for key, total, start, ids in pieces:
                    out.append((key, start, len(ids), _crc(ids), total, part, None if left else seq, offset,
                                ids.astype("<u4").tobytes() if left else None))
                    offset += len(ids)
                seq += 1
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

        for batch in slices(batches):
            for key, ids in zip(batch.column(0).to_pylist(), coder.encode_all(batch.column(1).to_pylist())):
                packer.add(key, ids)
            if packer.closed:
                yield rows(packer.closed, False)
                packer.closed = []
        coder.forget()  # the process may go on with other operators
        rest = packer.finish()
        if packer.closed:
            yield rows(packer.closed, False)
        if rest:
            yield rows([rest], True)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES)


def _cuts(total: int, length: int) -> list[int]:
    """Where the last, unfilled stretch is cut: its size's powers of two, the largest first."""
    at, out = total // length * length, []
    for k in reversed(range((total - at).bit_length())):
        if (total - at) & (1 << k):
            out.append((out[-1] if out else at) + (1 << k))
    return out


def pack(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, open_windows: int = OPEN_WINDOWS) -> DataFrame:
    """Pack whole texts (null: empty; each with the end id) into sequences of
    ``length`` tokens, a power of two.

    Returns a row per piece: doc_id, start (ids of its document before it), length,
    ids_crc32, doc_tokens, sequence_id, offset. All sequences are full, but for the
    last of at most log2(length), which have powers of two as sizes: nothing is
    padded. Rows with a null or repeated doc_id are documents of their own. An
    empty table gives no rows.
    """
    pieces = table(_pieces(docs, tokenizer or default_tokenizer(), length, open_windows), "pieces")
    parts = pieces.groupBy("part").agg(
        F.coalesce(F.max("seq") + 1, F.lit(0)).alias("n"), F.sum(F.when(F.col("seq").isNull(), F.col("length")).otherwise(0)).alias("rest"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = table(parts.select("part", "n", "rest", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("seq_base"),
                               F.coalesce(F.sum("rest").over(before), F.lit(0)).alias("rest_base")), "parts")
    whole, rest = parts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("rest"), F.lit(0))).first()
    tail = _cuts(rest, length)
    schema = arrow_schema(SEQUENCED)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                ids, at, start = np.frombuffer(row["ids"], "<u4"), row["rest_base"] + row["offset"], row["start"]
                while len(ids):
                    if at < rest // length * length:
                        seq, first = at // length, at // length * length
                        end = first + length
                    else:
                        k = next(i for i, c in enumerate(tail) if at < c)
                        first, end = tail[k - 1] if k else rest // length * length, tail[k]
                        seq = rest // length + k
                    head = ids[:end - at]
                    out.append((row["doc_id"], start, len(head), _crc(head), row["doc_tokens"], whole + seq, at - first))
                    ids, at, start = ids[len(head):], at + len(head), start + len(head)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    full = (pieces.where("seq is not null").join(parts, "part")
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("seq_base") + F.col("seq")).cast("long").alias("sequence_id"), "offset"))
    merged = (pieces.where("seq is null").join(parts.select("part", "rest_base"), "part")
              .select("doc_id", "start", "doc_tokens", "rest_base", "offset", "ids").mapInArrow(merge, SEQUENCED))
    return full.union(merged)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
