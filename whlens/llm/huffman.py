"""Token ids as files of canonical length-limited Huffman codes.

A folder holds two Parquet tables. ``codebook``: (symbol, bits), the code length
of each id seen; canonical codes follow from the lengths. ``segments``: one row
per run of whole documents in ascending doc_id order, with the bit stream
(``payload``) and a bit offset (``checkpoints``) for every block of
``block`` ids, so that any block can be decoded by itself.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from whlens.llm.common import arrow_schema, drop, partitions, scratch, slices, table
from whlens.llm.tokens import default_tokenizer, token_table

MAX_BITS = 16
BLOCK = 1024
SEGMENT = 1 << 20

SEGMENTS = ("part int, seq int, local_start long, n_tokens long, block int, doc_ids array<long>, "
            "doc_sizes array<long>, checkpoints array<long>, payload_crc32 long, payload binary")


# Codes.

def code_lengths(counts: np.ndarray, max_bits: int) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` for positive ``counts`` (package-merge)."""
    n = len(counts)
    if n < 2:
        return np.ones(n, np.int64)
    if n > 1 << max_bits:
        raise ValueError(f"{n} ids need codes of more than {max_bits} bits")
    order = np.argsort(counts, kind="stable")
    leaves = np.asarray(counts, np.float64)[order]
    rows, made = [], np.empty(0)
    for _ in range(max_bits):
        both = np.concatenate([leaves, made])
        by = np.argsort(both, kind="stable")
        rows.append(by < n)
        whole = both[by]
        made = whole[0:len(whole) // 2 * 2:2] + whole[1::2]
    bits, need = np.zeros(n, np.int64), 2 * n - 2
    for is_leaf in reversed(rows):
        taken = int(is_leaf[:need].sum())
        bits[:taken] += 1
        need = 2 * (need - taken)
    out = np.empty(n, np.int64)
    out[order] = bits
    return out


def canonical_codes(bits: np.ndarray) -> np.ndarray:
    """Codes of symbols given in ascending order with these lengths."""
    order = np.lexsort((np.arange(len(bits)), bits))
    codes, code, last = np.zeros(len(bits), np.int64), 0, 0
    for i in order:
        code <<= int(bits[i]) - last
        last = int(bits[i])
        codes[i] = code
        code += 1
    return codes


class Codebook:
    def __init__(self, symbols: np.ndarray, bits: np.ndarray):
        order = np.argsort(symbols)
        self.symbols, self.bits = np.asarray(symbols, np.int64)[order], np.asarray(bits, np.int64)[order]
        self.codes = canonical_codes(self.bits)
        self.width = int(self.bits.max(initial=1))
        top = int(self.symbols.max(initial=0)) + 1
        self.code_of, self.bits_of = np.zeros(top, np.int64), np.zeros(top, np.int64)
        self.code_of[self.symbols], self.bits_of[self.symbols] = self.codes, self.bits
        # Every prefix of `width` bits gives the symbol it starts with.
        self.symbol_at, self.bits_at = np.zeros(1 << self.width, np.uint32), np.zeros(1 << self.width, np.int64)
        for s, c, b in zip(self.symbols, self.codes, self.bits):
            at = slice(c << (self.width - b), (c + 1) << (self.width - b))
            self.symbol_at[at], self.bits_at[at] = s, b

    def encode(self, ids: np.ndarray, block: int) -> tuple[bytes, np.ndarray]:
        """Bit stream and the bit offset at which each block starts."""
        bits = self.bits_of[ids]
        ends = np.cumsum(bits)
        starts = ends - bits
        total = int(ends[-1]) if len(ends) else 0
        size = (total + 7) // 8
        at, word = starts >> 3, self.code_of[ids] << (32 - bits - (starts & 7))
        out = np.zeros(size + 4, np.int64)
        for k in range(4):  # the bits that codes put into a byte don't overlap: their sum is the byte
            out += np.bincount(at + k, weights=(word >> (24 - 8 * k)) & 255, minlength=size + 4)[:size + 4].astype(np.int64)
        return out[:size].astype(np.uint8).tobytes(), starts[::block]

    def decode(self, payload: bytes, checkpoints: np.ndarray, n: int, block: int) -> np.ndarray:
        """All ids; the blocks are decoded side by side, each from its own checkpoint."""
        raw = np.concatenate([np.frombuffer(payload, np.uint8), np.zeros(8, np.uint8)]).astype(np.int64)
        window = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
        starts = np.asarray(checkpoints, np.int64)
        at, mask = starts.copy(), (1 << self.width) - 1
        out = np.zeros((len(at), block), np.uint32)
        last = n - (len(at) - 1) * block
        for i in range(block):
            live = at if i < last else at[:-1]
            if not len(live):
                break
            key = (window[live >> 3] >> (32 - self.width - (live & 7))) & mask
            out[:len(live), i] = self.symbol_at[key]
            live += self.bits_at[key]
        if not np.array_equal(at[:-1], starts[1:]):
            raise ValueError("a block doesn't end at the next block's checkpoint")
        return out.ravel()[:n]


# Files.

def id_counts(tokens: DataFrame) -> DataFrame:
    """(symbol, n): how often each id occurs in all documents. Tasks send a row
    per id at most."""
    schema = arrow_schema("symbol long, n long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in slices(batches):
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u2"), minlength=1 << 16)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], schema=schema)

    return (tokens.select("ids").mapInArrow(run, "symbol long, n long")
            .groupBy("symbol").agg(F.sum("n").cast("long").alias("n")))


def write_ids(tokens: DataFrame, path: str, max_bits: int = MAX_BITS, block: int = BLOCK, segment: int = SEGMENT) -> None:
    """Write a token table (``tokens.token_table``) under ``path``.

    Order: doc_id (null first), then n_tokens and ids, so repeated rows are kept
    side by side. A segment closes after ``segment`` ids at the end of a document.
    What the driver holds is the codebook, bounded by the vocabulary. An empty
    table gives two empty Parquet tables.
    """
    spark = tokens.sparkSession
    counts = id_counts(tokens).toPandas().sort_values("symbol")
    symbols = counts["symbol"].to_numpy()
    bits = code_lengths(counts["n"].to_numpy(), max_bits)
    (spark.createDataFrame([(int(s), int(b)) for s, b in zip(symbols, bits)], "symbol long, bits int")
     .coalesce(1).write.parquet(f"{path}/codebook"))
    schema = arrow_schema(SEGMENTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, seq, done = TaskContext.get().partitionId(), 0, 0
        book = Codebook(symbols, bits)
        keys, held, size = [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal seq, done, keys, held, size
            payload, checkpoints = book.encode(np.concatenate(held), block)
            row = [part, seq, done, size, block, keys, [len(x) for x in held], checkpoints.tolist(), zlib.crc32(payload), payload]
            seq, done, keys, held, size = seq + 1, done + size, [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

        for batch in batches:
            for key, ids in zip(batch.column(0), batch.column(1)):
                keys.append(key.as_py())
                held.append(np.frombuffer(ids.as_py(), "<u2"))
                size += len(held[-1])
                if size >= segment:
                    yield close()
        if keys:
            yield close()

    (tokens.repartitionByRange(partitions(spark), F.col("doc_id").asc_nulls_first())
     .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "n_tokens", "ids")
     .select("doc_id", "ids").mapInArrow(run, SEGMENTS)
     .write.option("compression", "none").parquet(f"{path}/segments"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids binary): the files' documents. ``ids`` are
    little-endian unsigned 32-bit integers; ``start`` counts the ids of all
    documents before. Raises where a payload's checksum or a block's end is wrong.

    A segment's start is its own offset in its part plus the sizes of the parts
    before, a table with a row per part (a write task), not per segment.
    """
    book_rows = spark.read.schema("symbol long, bits int").parquet(f"{path}/codebook").toPandas()
    symbols, bits = book_rows["symbol"].to_numpy(), book_rows["bits"].to_numpy()
    segments = spark.read.schema(SEGMENTS).parquet(f"{path}/segments")
    parts = segments.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("base"))
    ddl = "doc_id long, start long, n_tokens long, ids binary"
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Codebook(symbols, bits)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {k: batch.column(k)[i].as_py() for k in batch.schema.names}
                if zlib.crc32(row["payload"]) != row["payload_crc32"]:
                    raise ValueError(f"damaged segment {row['part']}/{row['seq']}")
                ids = book.decode(row["payload"], row["checkpoints"], row["n_tokens"], row["block"]).astype("<u4")
                ends = np.cumsum(row["doc_sizes"])
                starts = ends - row["doc_sizes"]
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["local_start"] + row["base"]),
                    pa.array(row["doc_sizes"], pa.int64()),
                    pa.array([ids[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary())], schema=schema)

    return segments.join(parts, "part").mapInArrow(run, ddl)


def encode_documents(docs: DataFrame, path: str, tokenizer: str | None = None) -> DataFrame:
    """Tokenize every whole text, write the ids under ``path`` and read them back."""
    tokens = table(token_table(docs, tokenizer or default_tokenizer()), "tokens")
    write_ids(tokens, path)
    drop(tokens)
    return read_ids(docs.sparkSession, path)


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return (encode_documents(docs, scratch(spark, "token-ids"))
            .select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")))
