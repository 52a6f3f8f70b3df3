"""Token files and packing: round trips against the tokenizers library."""

import random
import zlib

import numpy as np
import pytest
from helpers import LONG, documents, edge_docs, edge_rows, no_docs

from whlens.llm import huffman, packing, tokens
from whlens.llm.common import scratch


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokens.default_tokenizer())


def ids(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 2]


def crc(x):
    return zlib.crc32(np.array(x, "<u4").tobytes())


def test_words_one_by_one_give_the_librarys_ids(library, monkeypatch):
    monkeypatch.setattr(tokens, "KNOWN_WORDS", 400)  # forgets now and then
    coder, rng = tokens.WordEncoder(tokens.default_tokenizer()), random.Random(3)
    marks = "abXYZéÉßÿÀ×÷ .,!'\"sStTvVrReE  \n\t ́İΣς中文한\U0001f60009_-$\x1c\x85`^~[]\\ıſK"
    for _ in range(3000):
        text = "".join(rng.choice(marks) if rng.random() < .9 else rng.choice(["<|endoftext|>", "<|startoftext|>", "'ll", "don't", "é"]) for _ in range(rng.randint(0, 40)))
        assert coder.encode(text).tolist() == ids(library, text), repr(text)
    assert coder.encode("x" * 5000 + " y " + "é!" * 100).tolist() == ids(library, "x" * 5000 + " y " + "é!" * 100)
    assert coder.encode(None).tolist() == [2]


def test_each_stem_and_run_of_marks_is_encoded_once(library):
    coder = tokens.WordEncoder(tokens.default_tokenizer())
    texts = ["Élan élan, ÉLAN!! a1", None, "", "lan. Élan,\nLAN!! " + "y" * 60 + "! \x00"]
    for _ in range(2):
        assert [x.tolist() for x in coder.encode_all(texts)] == [ids(library, t) for t in texts]
        # No word put together from both is remembered, nor a long one.
        assert set(coder.known) == {"", "élan", "lan", ",", "!!", ".", "!", "a1", "\x00"}
    places = coder.places
    coder.encode_all(texts[:3])
    assert coder.places == places
    assert coder.encode_all([]) == []


def test_a_model_without_ends_of_words_is_asked_word_by_word(library):
    coder = tokens.WordEncoder(tokens.default_tokenizer())
    coder.is_last[:] = False
    assert coder.encode("Some words, été").tolist() == ids(library, "Some words, été")


def test_batches_are_cut_by_the_bytes_of_their_texts(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(tokens, "SLICE_BYTES", 10)
    texts = ["a" * 4, None, "b" * 5, "c" * 35, "", "d", "é" * 4, "e" * 9]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(texts)], names=["doc_id", "text"])
    cut = list(tokens.text_slices(iter([batch, batch.slice(0, 0), batch.slice(4)])))
    assert [t for b in cut for t in b.column(1).to_pylist()] == texts + texts[4:]
    assert all(b.num_rows == 1 or sum(len((t or "").encode()) for t in b.column(1).to_pylist()[1:]) < 10 for b in cut)
    assert len(cut) > 3


@pytest.mark.parametrize("max_bits", [4, 7, 16])
def test_code_lengths_are_optimal_and_limited(max_bits):
    rng = np.random.default_rng(max_bits)
    counts = np.sort(rng.integers(1, 4000, 14) ** 2)
    bits = huffman.code_lengths(counts, max_bits)
    assert bits.max() <= max_bits and np.isclose((0.5 ** bits).sum(), 1)
    if max_bits == 16:  # no limit at work: the cost of Huffman's own code
        import heapq
        heap, cost = [int(c) for c in counts], 0
        heapq.heapify(heap)
        while len(heap) > 1:
            both = heapq.heappop(heap) + heapq.heappop(heap)
            cost += both
            heapq.heappush(heap, both)
        assert (counts * bits).sum() == cost
    assert huffman.code_lengths(np.array([5]), 16).tolist() == [1]
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(17), 4)


@pytest.mark.parametrize("n", [1, 7, 8, 9, 5000])
def test_blocks_decode_by_themselves(n):
    rng = np.random.default_rng(n)
    x = (rng.pareto(1, n) * 3).astype(int) % 300
    symbols, counts = np.unique(x, return_counts=True)
    book = huffman.Codebook(symbols, huffman.code_lengths(counts, 12))
    payload, checkpoints = book.encode(x, 8)
    assert book.decode(payload, checkpoints, n, 8).tolist() == x.tolist()
    last = (n - 1) // 8
    assert book.decode(payload, checkpoints[last:], n - 8 * last, 8).tolist() == x[8 * last:].tolist()  # from a checkpoint alone


def test_files_give_back_all_ids(spark, library):
    docs = documents(spark)
    found = huffman.encode_documents(docs, scratch(spark, "ids")).toPandas().sort_values("doc_id")
    rows = sorted(docs.select("doc_id", "text").collect())
    start = 0
    for (doc_id, text), got in zip(rows, found.itertuples()):
        want = ids(library, text)
        assert (got.doc_id, got.start, got.n_tokens) == (doc_id, start, len(want))
        assert np.frombuffer(got.ids, "<u4").tolist() == want
        start += len(want)


def test_small_segments_edge_rows_and_damage(spark, library):
    path = scratch(spark, "ids")
    docs = edge_docs(spark, clash=True)
    huffman.write_ids(tokens.token_table(docs, tokens.default_tokenizer()), path, block=16, segment=50)
    found = sorted(huffman.read_ids(spark, path).toPandas().itertuples(), key=lambda r: r.start)
    want = sorted(([r[0] is not None, r[0] or 0, len(ids(library, r[1]))] for r in edge_rows()), key=lambda r: (r[0], r[1], r[2]))
    assert [(r.doc_id == r.doc_id, 0 if r.doc_id != r.doc_id else r.doc_id, r.n_tokens) for r in found] == [tuple(w) for w in want]
    assert [r.start for r in found] == np.cumsum([0, *[w[2] for w in want[:-1]]]).tolist()
    segments = spark.read.parquet(f"{path}/segments")
    from pyspark.sql import functions as F
    bad = scratch(spark, "ids")
    segments.withColumn("payload", F.encode(F.lit("damaged"), "utf-8")).write.parquet(f"{bad}/segments")
    spark.read.parquet(f"{path}/codebook").write.parquet(f"{bad}/codebook")
    with pytest.raises(Exception, match="damaged segment"):
        huffman.read_ids(spark, bad).collect()


def test_no_documents(spark):
    assert huffman.encode_documents(no_docs(spark), scratch(spark, "ids")).count() == 0
    assert packing.pack(no_docs(spark)).count() == 0


@pytest.mark.parametrize("which", ["table", "edges"])
def test_pieces_cover_each_id_once_without_padding(spark, library, which):
    docs = documents(spark).repartition(4) if which == "table" else edge_docs(spark, clash=True)
    length = 4096 if which == "table" else 64
    found = packing.pack(docs, length=length).toPandas()
    texts = {}
    for r in docs.select("doc_id", "text").collect():
        texts.setdefault(r[0], []).append(ids(library, r[1]))
    total = sum(len(x) for v in texts.values() for x in v)
    assert found.length.sum() == total
    for r in found.itertuples():
        key = None if r.doc_id != r.doc_id else r.doc_id
        assert any(len(x) == r.doc_tokens and crc(x[r.start:r.start + r.length]) == r.ids_crc32 for x in texts[key])
    if which == "table":
        own = found.sort_values(["doc_id", "start"])
        assert (own.groupby("doc_id").length.cumsum() - own.length == own.start).all()
    own = found.sort_values(["sequence_id", "offset"])
    assert (own.groupby("sequence_id").length.cumsum() - own.length == own.offset).all()
    sizes = found.groupby("sequence_id").length.sum()
    assert (sizes.index == range(len(sizes))).all()
    assert all(s == length or s & (s - 1) == 0 for s in sizes) and (sizes < length).sum() <= 13


def test_windows_are_bounded_and_best_fit():
    packer = packing.Packer(10, 2)
    for key, n in enumerate([6, 8, 2, 3, 5]):  # 2 goes to the window with 2 left, 3 to that with 4 left
        packer.add(key, np.arange(n, dtype=np.uint32))
        assert len(packer.windows) <= 2
    assert [[(k, len(x)) for k, _, _, x in w] for w in packer.closed] == [[(1, 8), (2, 2)]]
    packer.add(9, np.arange(9, dtype=np.uint32))  # none fits: the fullest takes the head
    assert [[(k, len(x)) for k, _, _, x in w] for w in packer.closed][1] == [(0, 6), (3, 3), (9, 1)]
    left = packer.finish()
    assert sum(len(x) for w in [*packer.closed, left] for *_, x in w) == 33 and len(LONG) > 5 * 4096
