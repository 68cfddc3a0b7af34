"""Greedy search and robust pruning on a directed neighbour graph (numpy).

Used inside the tasks that hold one shard.  Points are searched and pruned in
batches, so that every step is a few array operations over many points.
Nearness is the inner product.  Points are lifted to a sphere with one more
coordinate, where the nearest point is the one with the largest inner product;
a query gets 0 there, which leaves its products unchanged.
"""

from __future__ import annotations

import numpy as np


def lifted(x: np.ndarray) -> np.ndarray:
    x = x / max(float(np.abs(x).max(initial=0.0)), 1e-300)   # scale does not change any order
    norm = np.einsum("ij,ij->i", x, x)
    extra = np.sqrt(np.maximum(norm.max(initial=0.0) - norm, 0.0))
    return np.hstack([x, extra[:, None]]).astype(np.float32)


class Graph:
    """Points on a sphere, their out-neighbours (-1: none) and a start point."""

    def __init__(self, points: np.ndarray, degree: int = 32, beam: int = 64, relax: float = 1.2):
        self.points, self.degree, self.beam, self.relax = points, degree, beam, relax
        self.radius = float(np.einsum("ij,ij->i", points, points).max(initial=0.0))
        self.room = degree + degree // 2   # neighbours may exceed the degree until pruned
        self.near = np.full((len(points), self.room), -1, np.int32)
        self.start = 0

    # -- search -------------------------------------------------------------

    def search(self, queries: np.ndarray, beam: int, width: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """Beam search: ids (-1: none) and products, best first, per query."""
        n = len(queries)
        ids = np.full((n, beam), -1, np.int64)
        score = np.full((n, beam), -np.inf, np.float32)
        done = np.ones((n, beam), bool)
        ids[:, 0], done[:, 0] = self.start, False
        score[:, 0] = queries @ self.points[self.start]
        live = np.arange(n)
        while len(live):
            # The best points not yet expanded, ``width`` per query.
            open_score = np.where(done[live], -np.inf, score[live])
            pick = np.argpartition(-open_score, width - 1, axis=1)[:, :width] if beam > width \
                else np.tile(np.arange(beam), (len(live), 1))
            rows = live[:, None]
            fresh = ~done[rows, pick]
            some = fresh.any(1)
            live, pick, fresh, rows = live[some], pick[some], fresh[some], rows[some]
            if not len(live):
                break
            chosen = np.where(fresh, ids[rows, pick], -1)
            done[rows, pick] = True
            found = self.near[chosen].reshape(len(live), -1).astype(np.int64)
            found[np.repeat(chosen < 0, self.room, axis=1)] = -1
            found.sort(axis=1)
            found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
            got = np.einsum("qkd,qd->qk", self.points[found], queries[live])
            got[found < 0] = -np.inf
            # Only those better than the worst of the beam can enter it.
            floor = score[live].min(1)
            keep = min(beam, found.shape[1])
            top = np.argpartition(-got, keep - 1, axis=1)[:, :keep]
            r = np.arange(len(live))[:, None]
            found, got = found[r, top], got[r, top]
            got[got <= floor[:, None]] = -np.inf
            known = (found[:, :, None] == ids[live][:, None, :]).any(2)
            got[known] = -np.inf
            found[got == -np.inf] = -1
            all_ids = np.hstack([ids[live], found])
            all_score = np.hstack([score[live], got])
            all_done = np.hstack([done[live], found < 0])
            best = np.argpartition(-all_score, beam - 1, axis=1)[:, :beam]
            ids[live], score[live], done[live] = all_ids[r, best], all_score[r, best], all_done[r, best]
        order = np.argsort(-score, axis=1, kind="stable")
        r = np.arange(n)[:, None]
        return ids[r, order], score[r, order]

    # -- construction -------------------------------------------------------

    def _prune(self, centre: np.ndarray, cand: np.ndarray) -> np.ndarray:
        """Robust pruning of candidate rows: the nearest candidate stays and
        rules out those that are nearer to it, relaxed, than to the centre."""
        n = len(centre)
        out = np.full((n, self.degree), -1, np.int64)
        cand = np.sort(cand, axis=1)
        cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
        cand[cand == centre[:, None]] = -1
        vec = self.points[cand]
        apart = self.radius - np.einsum("nkd,nd->nk", vec, self.points[centre])
        apart[cand < 0] = np.inf
        order = np.argsort(apart, axis=1, kind="stable")
        r = np.arange(n)[:, None]
        cand, apart, vec = cand[r, order], apart[r, order], vec[r, order]
        between = self.radius - vec @ vec.transpose(0, 2, 1)
        between *= self.relax ** 2
        alive = cand >= 0
        line = np.arange(n)
        for slot in range(self.degree):
            first = alive.argmax(1)
            some = alive[line, first]
            if not some.any():
                break
            out[some, slot] = cand[line, first][some]
            alive &= between[line, first] > apart
            alive[line, first] = False
        return out

    def build(self, most: int = 512) -> Graph:
        n = len(self.points)
        if n == 0:
            return self
        self.start = int(np.argmax(self.points @ self.points.mean(0)))
        order = np.random.default_rng(7).permutation(n)   # fixed: the same graph on every attempt
        order = np.concatenate(([self.start], order[order != self.start]))
        at, size = 1, 1
        while at < n:
            batch = order[at:at + size]
            at += size
            size = min(most, 2 * size)
            found, _ = self.search(self.points[batch], self.beam)
            # Points of one batch cannot find each other; they are offered directly.
            near = self._prune(batch, self._with_batch(batch, found))
            self.near[batch, :self.degree] = near
            self._link_back(batch, near)
        return self

    def _with_batch(self, batch: np.ndarray, found: np.ndarray) -> np.ndarray:
        k = min(8, len(batch) - 1)
        if k <= 0:
            return found
        product = self.points[batch] @ self.points[batch].T
        np.fill_diagonal(product, -np.inf)
        mates = np.argpartition(-product, k - 1, axis=1)[:, :k]
        return np.hstack([found, batch[mates]])

    def _link_back(self, batch: np.ndarray, near: np.ndarray) -> None:
        """Edges back from the new neighbours, pruning those with too many."""
        source = np.repeat(batch, self.degree)
        target = near.reshape(-1)
        source, target = source[target >= 0], target[target >= 0]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        start = np.flatnonzero(np.r_[True, target[1:] != target[:-1]])
        rank = np.arange(len(target)) - np.repeat(start, np.diff(np.r_[start, len(target)]))
        for lap in range(0, int(rank.max(initial=-1)) + 1, self.degree):
            now = (rank >= lap) & (rank < lap + self.degree)
            nodes, row = np.unique(target[now], return_inverse=True)
            new = np.full((len(nodes), self.degree), -1, np.int64)
            new[row, rank[now] - lap] = source[now]
            cand = np.hstack([self.near[nodes].astype(np.int64), new])
            cand = -np.sort(-cand, axis=1)
            cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
            cand = -np.sort(-cand, axis=1)
            full = (cand[:, self.room:] >= 0).any(1) if cand.shape[1] > self.room else np.zeros(len(nodes), bool)
            self.near[nodes[~full]] = cand[~full, :self.room]
            for i in range(0, int(full.sum()), 1024):
                some = np.flatnonzero(full)[i:i + 1024]
                rows = np.full((len(some), self.room), -1, np.int64)
                rows[:, :self.degree] = self._prune(nodes[some], cand[some])
                self.near[nodes[some]] = rows
