"""Hierarchical navigable small-world graph over one shard's vectors, in numpy.

Searches and insertions go many at a time: each step expands the best open candidates
of all beams at once.
"""

from __future__ import annotations

import io

import numpy as np

NEIGHBOURS = 12
BUILD_BEAM = 40
BATCH = 512
#: Candidates that each beam expands in a step.
EXPAND = 4


def merged(ids: np.ndarray, sims: np.ndarray, done: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``size`` best candidates of each row, without repeats; of a repeat the first stays."""
    by = np.argsort(ids, axis=1, kind="stable")
    ids, sims, done = (np.take_along_axis(x, by, 1) for x in (ids, sims, done))
    again = np.zeros(ids.shape, bool)
    again[:, 1:] = ids[:, 1:] == ids[:, :-1]
    sims = np.where(again | (ids < 0), -3.0, sims)
    best = np.argsort(-sims, axis=1, kind="stable")[:, :size]
    ids, sims, done = (np.take_along_axis(x, best, 1) for x in (ids, sims, done))
    return np.where(sims > -3, ids, -1), sims, done


class Graph:
    """``vectors``: unit rows. Row 0 has the highest level; ``links[k]`` are the
    neighbours on level k (-1: none)."""

    def __init__(self, vectors: np.ndarray, links: list[np.ndarray]):
        self.vectors, self.links = vectors, links

    # Search.

    def _sims(self, ids: np.ndarray, queries: np.ndarray) -> np.ndarray:
        sims = np.einsum("qkd,qd->qk", self.vectors[ids], queries)
        return np.where(ids < 0, -3.0, sims)

    def beam(self, level: int, queries: np.ndarray, ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Best ``size`` candidates (ids, similarities) of each query on a level, from ``ids``."""
        ids, sims, done = merged(ids, self._sims(ids, queries), np.zeros(ids.shape, bool), size)
        live = np.arange(len(queries))
        for _ in range(4 * size + 16):
            open_sims = np.where(done[live] | (ids[live] < 0), -4.0, sims[live])
            live, open_sims = live[(go := open_sims.max(axis=1) > -4)], open_sims[go]
            if not len(live):
                break
            k = min(EXPAND if size > 1 else 1, ids.shape[1])
            at = np.argpartition(-open_sims, k - 1, axis=1)[:, :k]
            chosen = np.where(np.take_along_axis(open_sims, at, 1) > -4, np.take_along_axis(ids[live], at, 1), -1)
            done_now = done[live]
            np.put_along_axis(done_now, at, True, 1)
            near = np.where(chosen[:, :, None] >= 0, self.links[level][chosen], -1).reshape(len(live), -1)
            new = merged(np.concatenate([ids[live], near], 1), np.concatenate([sims[live], self._sims(near, queries[live])], 1),
                         np.concatenate([done_now, np.zeros(near.shape, bool)], 1), size)
            if new[0].shape[1] > ids.shape[1]:
                grow = ((0, 0), (0, new[0].shape[1] - ids.shape[1]))
                ids, sims, done = np.pad(ids, grow, constant_values=-1), np.pad(sims, grow, constant_values=-3.0), np.pad(done, grow)
            ids[live], sims[live], done[live] = new
        return ids, sims

    def search(self, queries: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Descend level by level, then search the lowest with beams of ``size``."""
        ids = np.zeros((len(queries), 1), np.int64)
        for level in range(len(self.links) - 1, 0, -1):
            ids, _ = self.beam(level, queries, ids, 1)
        return self.beam(0, queries, ids, size)

    # Storage.

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, vectors=self.vectors, **{f"links{k}": x.astype(np.int32) for k, x in enumerate(self.links)})
        return out.getvalue()

    @staticmethod
    def from_bytes(data: bytes) -> Graph:
        with np.load(io.BytesIO(data)) as x:
            return Graph(x["vectors"], [x[f"links{k}"].astype(np.int64) for k in range(len(x.files) - 1)])


def diverse(vectors: np.ndarray, queries: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` neighbours a row out of its candidates, best first: those that are
    nearer to the query than to any neighbour chosen before, then the best of the rest."""
    order = np.argsort(-sims, axis=1, kind="stable")
    ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
    own = vectors[ids]
    between = np.einsum("qad,qbd->qab", own, own)
    chosen = np.zeros(ids.shape, bool)
    for j in range(ids.shape[1]):
        near = np.where(chosen, between[:, j], -3.0).max(axis=1)
        chosen[:, j] = (ids[:, j] >= 0) & (near < sims[:, j]) & (chosen.sum(axis=1) < most)
    rank = np.argsort(np.where(ids < 0, 2, np.where(chosen, 0, 1)), axis=1, kind="stable")[:, :most]
    out = np.take_along_axis(ids, rank, 1)
    return np.pad(out, ((0, 0), (0, max(0, most - out.shape[1]))), constant_values=-1)


def build(vectors: np.ndarray, neighbours: int = NEIGHBOURS, beam: int = BUILD_BEAM, seed: int = 5) -> tuple[np.ndarray, Graph]:
    """(order, graph): the graph's row i is ``vectors[order[i]]``. Rows go in by
    descending level, so that upper levels are whole before lower ones begin."""
    n = len(vectors)
    level = np.floor(-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(neighbours)).astype(int)
    order = np.argsort(-level, kind="stable")
    level = level[order]
    x = np.ascontiguousarray(vectors[order])
    top = int(level[0]) if n else 0
    graph = Graph(x, [np.full((n, neighbours * (1 if k else 2)), -1, np.int64) for k in range(top + 1)])
    at = min(1, n)
    while at < n:
        new = np.arange(at, min(n, at + min(BATCH, at)))  # no more than are there already
        new = new[level[new] == level[new[0]]]
        found = np.zeros((len(new), 1), np.int64)
        for k in range(top, -1, -1):
            if k > level[new[0]]:
                found, _ = graph.beam(k, x[new], found, 1)
                continue
            found, sims = graph.beam(k, x[new], found, beam)
            peers = x[new] @ x[new].T
            np.fill_diagonal(peers, -3.0)
            few = min(8, len(new))
            best = np.argpartition(-peers, few - 1, axis=1)[:, :few]
            peer_sims = np.take_along_axis(peers, best, 1)
            ids = np.concatenate([found, np.where(peer_sims > -3, new[best], -1)], 1)
            _link(graph, k, new, diverse(x, x[new], ids, np.concatenate([sims, peer_sims], 1), neighbours))
        at = int(new[-1]) + 1
    return order, graph


def _link(graph: Graph, k: int, new: np.ndarray, chosen: np.ndarray) -> None:
    """Set the new rows' neighbours, and theirs back; where there is no room, the diverse stay."""
    links, x = graph.links[k], graph.vectors
    links[new, :chosen.shape[1]] = chosen
    source, target = np.repeat(new, chosen.shape[1]), chosen.ravel()
    source, target = source[target >= 0], target[target >= 0]
    by = np.argsort(target, kind="stable")
    source, target = source[by], target[by]
    owners, first, count = np.unique(target, return_index=True, return_counts=True)
    for at in range(0, len(owners), BATCH):
        own, start, n = owners[at:at + BATCH], first[at:at + BATCH], count[at:at + BATCH]
        slot = start[:, None] + np.arange(n.max())
        more = np.where(np.arange(n.max()) < n[:, None], source[np.minimum(slot, len(source) - 1)], -1)
        ids, sims, _ = merged(np.concatenate([links[own], more], 1), np.einsum("qkd,qd->qk", x[np.concatenate([links[own], more], 1)], x[own]),
                              np.zeros((len(own), links.shape[1] + more.shape[1]), bool), links.shape[1] + more.shape[1])
        full = (ids >= 0).sum(axis=1) > links.shape[1]
        kept = ids[:, :links.shape[1]]
        if full.any():
            kept[full] = diverse(x, x[own[full]], ids[full], sims[full], links.shape[1])
        links[own] = kept
