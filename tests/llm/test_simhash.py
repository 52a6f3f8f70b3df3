"""SimHash links against all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash
from helpers import documents, edge_docs, no_docs

from whlens.llm import simhash
from whlens.llm.common import components


def brute_fingerprint(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode()))
    shingles = [b" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def brute_components(rows):
    """rows: (doc_id, fingerprint). Smallest doc_id reachable of each."""
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(rows[i][1] ^ rows[j][1]).count("1") <= 4:
                parent[top(i)] = top(j)
    low = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            low[top(i)] = min(low.get(top(i), doc_id), doc_id)
    return [low.get(top(i)) for i in range(len(rows))]


def test_documents(spark):
    rows = sorted((r.doc_id, r.text) for r in documents(spark).collect())
    prints = [(i, brute_fingerprint(t)) for i, t in rows]
    found = {r.doc_id: r for r in simhash.near_duplicates(documents(spark)).collect()}
    assert [found[i].fp % (1 << 64) for i, _ in rows] == [p for _, p in prints]
    assert [found[i].component_id for i, _ in rows] == brute_components(prints)


def test_edges(spark):
    docs = edge_docs(spark, clash=True)
    rows = [(r.doc_id, brute_fingerprint(r.text)) for r in docs.collect()]
    found = sorted((r.doc_id or -1, r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(docs).collect())
    assert found == sorted((i or -1, p, c) for (i, p), c in zip(rows, brute_components(rows)))
    kept = simhash.first_of_group(docs)
    assert kept.columns == docs.columns
    texts = sorted((r.doc_id or -1, r.text or "") for r in kept.collect())
    assert [i for i, _ in texts] == [-1, 1, 3, 5, 7, 8, 8]  # the two texts of 8 are in groups of their own
    assert simhash.near_duplicates(no_docs(spark)).count() == 0 and simhash.first_of_group(no_docs(spark)).count() == 0


@pytest.mark.parametrize("block_rows", [8192, 20])
def test_links_of_crowded_fingerprints(spark, block_rows):
    """Dense groups, chains of links and borders at 4 and 5 bits; with small blocks, buckets are dealt out by block pairs."""
    rng = random.Random(1)
    prints = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(70):
            x = centre
            for b in rng.sample(range(64), rng.choice([0, 1, 2, 3, 4, 5, 6])):
                x ^= 1 << b
            prints.add(x)
    at = rng.getrandbits(64)
    for k in range(12):  # a chain: neighbours differ in four bits
        for b in rng.sample(range(64), 4):
            at ^= 1 << b
        prints.add(at)
    prints |= {rng.getrandbits(64) for _ in range(60)}
    rows = sorted(prints)
    df = spark.createDataFrame([(simhash._signed(p),) for p in rows], "fp long").repartition(5)
    found = {r.node % (1 << 64): r.component for r in components(simhash.links(df, block_rows=block_rows)).collect()}
    want = brute_components(list(enumerate(rows)))
    groups = {}
    for p, w in zip(rows, want):
        groups.setdefault(w, set()).add(p)
    for members in groups.values():
        if len(members) == 1:
            assert not members & set(found)
        else:
            assert len({found[m] for m in members}) == 1
    assert len(set(found.values())) == sum(len(m) > 1 for m in groups.values())


def test_a_crowded_bucket_gives_few_edges():
    ring, rng = simhash.Ring(), np.random.default_rng(0)
    flips = np.unique(np.concatenate([[0], 1 << rng.integers(40, 64, 3000, dtype=np.uint64)]).astype(np.uint64))
    a, b = simhash._block_edges(flips, None, [(2**64 - 1, 4)])
    assert len(a) == len(flips) - 1 and max(np.unique(np.concatenate([a, b]), return_counts=True)[1]) <= 17
    assert [i for i, _ in ring.keys()] == [0, 0, 1, 1, 2, 2, 3, 3, 4, 4]


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 400)] + [(7, k) for k in range(1000, 1200)] + [(-5, -6), (9, 9)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 100 for i in range(100, 401)}, 7: 7, **{k: 7 for k in range(1000, 1200)}, -5: -6, -6: -6}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
